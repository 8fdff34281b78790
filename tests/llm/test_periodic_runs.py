"""Operator 13 against brute force."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import periodic_runs
from tests.llm import brute
from tests.llm.conftest import dicts


def runs(words):
    """Every run of a word list, period by period."""
    shortest = {}
    for q in range(1, len(words) // 2 + 1):
        j = 0
        while j < len(words) - q:
            start = j
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            length = j - start + q
            if j > start and length >= max(12, 2 * q):
                shortest.setdefault((start, length), q)
            j += j == start
    return sorted((s, n, q) for (s, n), q in shortest.items())


def expected(doc):
    words = brute.words(doc["text"])
    if doc["doc_id"] is not None and words:
        h = zlib.crc32(str(doc["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs(words)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return (doc["doc_id"], len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("name", ["documents", "edges", "empty"])
def test_digests(documents, edges, name):
    table = {"documents": documents, "edges": edges, "empty": edges.limit(0)}[name]
    got = periodic_runs.periodic_runs(table, alter=True)
    rows = [d for d in dicts(table) if name == "edges" or len(d["text"] or "") < 12_000]  # brute force is slow
    ids = {d["doc_id"] for d in rows} if name == "documents" else None
    found = [tuple(r) for r in got.select(COLUMNS).collect() if ids is None or r["doc_id"] in ids]
    assert sorted(found, key=str) == sorted(map(expected, rows), key=str)


def test_collapsed_texts(spark, edges):
    got = periodic_runs.collapsed(edges)
    assert got.schema.names == edges.schema.names
    new = {(d["doc_id"], d["n_chars"]): d for d in dicts(got)}
    for old in dicts(edges):
        words = brute.words(old["text"])
        found = runs(words)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        text = " ".join(w for i, w in enumerate(words) if i not in gone) if found else old["text"]
        assert new[old["doc_id"], old["n_chars"]] == old | {"text": text}


def found(documents):
    return [list(zip(*(x.tolist() for x in r))) for r in periodic_runs.Finder()(documents)]


@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=80), max_size=4))
@settings(max_examples=150, deadline=None)
def test_small_alphabets(documents):
    assert found(documents) == [runs(d) for d in documents]


def test_fibonacci_words_and_long_documents(monkeypatch):
    x, y = [b"a"], [b"a", b"b"]
    while len(y) < 600:
        x, y = y, y + x
    rng = random.Random(3)
    noise = [b"%d" % rng.randrange(400) for _ in range(700)]
    documents = [y, noise + noise[200:500] * 3, [b"w"] * 900, [], [b"one"], noise[:40] * 9]
    assert found(documents) == [runs(d) for d in documents]
    monkeypatch.setattr(periodic_runs, "GRID_WORDS", 64)  # candidates of long documents come in parts
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 300)
    assert found(documents) == [runs(d) for d in documents]


def test_equal_stretches_share_names():
    """The grammar of a repeated passage is much smaller than its text."""
    import numpy as np

    letters = np.r_[0, np.tile(np.arange(2, 66), 64), 1]
    levels = periodic_runs.grammar(letters, letters < 2)
    assert len(levels[-1].letters) == 3
    assert len(np.unique(np.concatenate([lv.letters for lv in levels]))) < 300
