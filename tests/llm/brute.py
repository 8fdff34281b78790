"""Plain restatements of the operators' contracts, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return SPACE.findall(text or "")


def base_scores(docs):
    """{row number: (held_out, n_tokens, n_known, train_tokens, base_score)} of op 1."""
    held = [zlib.crc32(("" if d["doc_id"] is None else str(d["doc_id"])).encode()) % 10 == 0 for d in docs]
    tokens = [[*words(low(d["text"])), None] for d in docs]
    c = Counter(t for ts, h in zip(tokens, held) if not h for t in ts)
    n, v = sum(c.values()), len(c)
    return [(h, len(ts), sum(c[t] > 0 for t in ts), n,
             sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)) for ts, h in zip(tokens, held)]


def ctw_scores(docs, depth):
    """Context-tree weighting straight from its definition: log10 per text."""
    def lg_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def stream(text):
        symbols = [*(text or "").encode(), 255]
        line = [254] * depth + symbols
        for i, s in enumerate(symbols):
            context = tuple(reversed(line[i:i + depth]))  # nearest first
            node = 1
            for k in range(7, -1, -1):
                bit = s >> k & 1
                yield context, node, bit
                node = 2 * node + bit

    counts, children = {}, {}
    for d, row in zip(docs, base_scores(docs)):
        if not row[0]:
            for context, node, bit in stream(d["text"]):
                for k in range(depth + 1):
                    counts.setdefault((context[:k], node), [0, 0])[bit] += 1
                    if k:
                        children.setdefault((context[:k - 1], node), set()).add((context[:k], node))
    memo = {}

    def log_w(key):
        if key not in memo:
            own = lg_kt(*counts[key])
            if len(key[0]) == depth:
                memo[key] = own, 1.0
            else:
                below = sum(log_w(c)[0] for c in children[key])
                top = max(own, below)
                both = top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2)
                memo[key] = both, math.exp(own - math.log(2) - both)
        return memo[key]

    out = []
    for d in docs:
        total = 0.0
        for context, node, bit in stream(d["text"]):
            p = None
            for k in range(depth, -1, -1):
                key = (context[:k], node)
                a, b = counts.get(key, (0, 0))
                kt = ((b if bit else a) + 0.5) / (a + b + 1)
                stop = 0.5 if key not in counts else log_w(key)[1]
                p = kt if k == depth else stop * kt + (1 - stop) * p
            total += math.log10(p)
        out.append(total)
    return out


def statistics(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) of op 3."""
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


def shingles(text):
    w = words(low(text))
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_components(docs):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs."""
    sets = [shingles(d["text"]) for d in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    lowest = {}
    for i, d in enumerate(docs):
        if d["doc_id"] is not None:
            r = find(i)
            lowest[r] = min(lowest.get(r, d["doc_id"]), d["doc_id"])
    return [(d["doc_id"], len(sets[i]), lowest.get(find(i))) for i, d in enumerate(docs)]


def contamination(docs, items, window=10):
    """[(doc_id, n_words, n_hit, n_items, sha, contaminated)] of op 7."""
    phrases = {}
    for item in items:
        w = SYMBOL_WORD.findall(low(item["text"]))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + window]), set()).add(
                "" if item["item_id"] is None else str(item["item_id"]))
    sizes = sorted({len(p) for p in phrases})
    out = []
    for d in docs:
        w, hit, found = SYMBOL_WORD.findall(low(d["text"])), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                ids = phrases.get(tuple(w[i:i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        out.append((d["doc_id"], len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out
