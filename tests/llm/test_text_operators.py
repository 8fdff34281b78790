"""Operators 1, 3, 5, 7 and 10 against brute force."""

from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mercato.llm import ctw, decontaminate, neardup, quality_rules, substring
from tests.llm import brute
from tests.llm.conftest import SF, dicts


@pytest.fixture(scope="module", params=["documents", "edges", "empty"])
def table(request, documents, edges):
    return {"documents": documents, "edges": edges, "empty": edges.limit(0)}[request.param]


def test_contamination(spark, table):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").unionByName(spark.createDataFrame(
        [(None, "a b c d"), (900, None), (901, ""), (902, "one"), (902, "W w W")], "item_id long, text string"))
    got = decontaminate.report(decontaminate.contamination(table, items))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        brute.contamination(dicts(table), dicts(items)), key=str)


def test_contamination_in_groups_of_items(spark, documents, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.report(decontaminate.contamination(documents, items)).collect()))
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 2000)
    parts = sorted(map(tuple, decontaminate.report(decontaminate.contamination(documents, items)).collect()))
    assert whole == parts
    none = decontaminate.report(decontaminate.contamination(documents, items.limit(0)))
    assert none.where("contaminated").count() == 0


def test_decontaminated_texts_have_no_hits(spark, table):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = decontaminate.decontaminated(table, items)
    assert clean.columns == table.columns and clean.count() == table.count()
    before = {str(sorted(d.items(), key=str)) for d in dicts(table)}
    left = brute.contamination(dicts(clean), dicts(items))
    assert sum(r[2] for r in left) <= 0.05 * sum(r[2] for r in brute.contamination(dicts(table), dicts(items)))
    untouched = [d for d in dicts(clean) if str(sorted(d.items(), key=str)) in before]
    assert len(untouched) == sum(not r[5] for r in brute.contamination(dicts(table), dicts(items)))


def test_near_duplicates(table):
    got = neardup.components(table)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    expected = brute.near_components(dicts(table))
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == sorted(
        expected, key=str)
    for row in got.collect():
        assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_one_document_of_each_component_stays(spark, table):
    more = table.unionByName(table.where("doc_id is null or doc_id % 7 = 0").withColumn("doc_id", F.lit(None).cast("long")))
    got = neardup.deduplicated(more)
    assert got.schema == more.schema
    docs, kept = dicts(more), dicts(got)
    lowest = defaultdict(list)
    for d, (_, n, c), in zip(docs, brute.near_components(docs)):
        if n:
            lowest[c if c is not None else d["text"]].append(d)
    left = Counter(str(d) for d in kept if brute.shingles(d["text"]))
    assert sum(left.values()) == len(lowest)
    for members in lowest.values():
        ids = [d["doc_id"] for d in members if d["doc_id"] is not None]
        assert sum(left[s] for s in {str(d) for d in members if not ids or d["doc_id"] == min(ids)}) == 1


def test_near_duplicates_with_blocks_by_bytes(documents, monkeypatch):
    monkeypatch.setattr(neardup, "SET_BYTES", 4000)  # two or three sets
    got = neardup.components(documents)
    expected = brute.near_components(dicts(documents))
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == sorted(
        expected, key=str)


def test_near_duplicates_with_branching_and_blocks(documents, monkeypatch):
    expected = sorted(brute.near_components(dicts(documents)))
    monkeypatch.setattr(neardup, "LEAF", 2)
    monkeypatch.setattr(neardup, "BLOCK", 2)
    monkeypatch.setattr(neardup, "TREES", 16)
    got = neardup.components(documents).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == expected


def test_more_near_copies_than_a_leaf_that_never_part(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEAF", 4)
    monkeypatch.setattr(neardup, "MAX_LEVELS", 2)
    rows = [(i, bytes(4 * neardup.TOKENS)) for i in range(30)]
    rows += [(100 + i, bytes([i + 1] * 4 * neardup.TOKENS)) for i in range(5)]
    got = neardup.candidate_clusters(spark.createDataFrame(rows, "id long, tokens binary"))
    assert sorted(map(tuple, got.collect())) == [(i, 0) for i in range(30)]


def test_word_statistics(table):
    rows = quality_rules.word_statistics(table, ["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = [(d["doc_id"], *brute.statistics(d["text"])) for d in dicts(table)]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(expected, key=str)


def test_ctw_equals_its_definition(table):
    docs = [d for d in dicts(table) if len(d["text"] or "") < 2500]
    small = table.where("text is null or length(text) < 2500")
    got = ctw.scores(small, depth=3).collect()
    base, model = brute.base_scores(docs), brute.ctw_scores(docs, 3)
    expected = sorted([(d["doc_id"], *b, m) for d, b, m in zip(docs, base, model)], key=str)
    rows = sorted([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"],
                    r["score"]) for r in got], key=str)
    assert [r[:5] for r in rows] == [e[:5] for e in expected]
    for r, e in zip(rows, expected):
        assert r[5:] == pytest.approx(e[5:], rel=1e-5, abs=1e-5)


def test_words_and_grams_of_many_texts_at_once():
    texts = ["", " ", "A", "\t b  C\r\n", "\x1c\x1f\x85\xa0 x \x0b\x0cq", "\xc9 \xe9 \u0130", "\x00 \x00a b", "w " * 300]
    texts += [f"{chr(i)}a{chr(i)}B" for i in range(256)]
    for some in (texts, [], [""]):
        words, edges = ctw.all_words(pa.array(some, pa.string()))
        words = words.to_pylist()
        assert [words[a:b] for a, b in zip(edges, edges[1:])] == [t.encode().lower().split() for t in some]
    for depth in (1, 3, 5):
        lines = [bytes([ctw.START]) * depth + t.encode() + bytes([ctw.END]) for t in texts]
        expected = [sum(line[i - k] << 8 * k for k in range(depth + 1)) for line in lines for i in range(depth, len(line))]
        assert ctw.grams([t.encode() for t in texts], depth).tolist() == expected
    assert len(ctw.grams([])) == 0


def test_ctw_by_requests_alone_and_by_small_parts(documents, monkeypatch):
    """The broadcast part, the slices and the blocks change no score."""
    small = documents.where("length(text) < 4000")
    whole = {r["doc_id"]: tuple(r) for r in ctw.scores(small, 4).collect()}
    for name, value in (("TOP_GRAMS", 40), ("TOP_WORDS", 0), ("BLOCK_BYTES", 30_000), ("COUNTED_BYTES", 20_000),
                        ("SLICE_CODES", 5_000), ("TREE_GRAMS", 100)):
        monkeypatch.setattr(ctw, name, value)
    for r in ctw.scores(small, 4).collect():
        assert tuple(r) == pytest.approx(whole[r["doc_id"]], rel=1e-6)


def test_ctw_counts_leave_a_task_in_small_batches(monkeypatch):
    monkeypatch.setattr(ctw, "SENT_ROWS", 100, raising=False)
    texts = [f"Word{i} and a word {i % 7} \xe9" for i in range(400)]
    rows = pa.RecordBatch.from_arrays([pa.array([i % 10 > 0 for i in range(400)]), pa.array(texts)], names=["train", "text"])
    out = list(ctw._counts(3)(iter([rows] * 3)))
    assert len(out) > 5 and max(b.num_rows for b in out) <= 100
    got, expected = Counter(), Counter()
    for kind, key, n in zip(*(sum((b[c].to_pylist() for b in out), []) for c in ("kind", "key", "n"))):
        got[kind, key % 2**64] += n
    for i, text in enumerate(texts):
        for gram in ctw.grams([text.encode()], 3).tolist():
            expected[ctw.GRAM, gram] += 3 * (i % 10 > 0)
        for word in text.lower().encode().split() if i % 10 else ():
            expected[ctw.WORD, ctw.word_key(word)] += 3
    assert got == expected and set(got) == set(expected)


def test_ctw_beats_the_word_model_on_held_out_texts(spark):
    held = ctw.scores(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]


def own_chunks(text):
    """Chunk ends byte by byte: a gear hash of the last 32 bytes, 24 to 256 bytes a chunk."""
    gear, state, ends, at = substring.gear_table().tolist(), 0, [], 0

    def long_chunks(end):
        nonlocal at
        while end - at > 256:
            at += 256
            while text[at] & 0xC0 == 0x80:
                at -= 1
            ends.append(at)

    for i, byte in enumerate(text):
        state = (2 * state + gear[byte]) % 2**32
        end = i + 1
        if end < len(text) and state >> 27 == 0 and text[end] & 0xC0 != 0x80 and end - at >= 24:
            long_chunks(end)
            if end - at >= 24:
                ends.append(end)
                at = end
    long_chunks(len(text))
    return ends + ([len(text)] if at < len(text) else [])


def brute_substrings(docs):
    """Runs of chunks seen before, extended to agree with their first
    occurrence, over whole chunk lists in doc order."""
    first, out, texts = {}, {}, {}
    space = lambda b: b in b" \t\n\r\x0b\x0c"
    for i, d in sorted(enumerate(docs), key=lambda x: x[1]["doc_id"]):
        text = texts[i] = (d["text"] or "").encode()
        runs, last, starts = [], None, [0, *own_chunks(text)]
        for a, b in zip(starts, starts[1:]):
            chunk = text[a:b]
            if chunk not in first:
                first[chunk] = (i, a)
                continue
            j, at = first[chunk]
            if last == a:
                runs[-1][1], runs[-1][3] = b, (j, at + b - a)
            else:
                runs.append([a, b, (j, at), (j, at + b - a)])
            last = b
        spans = []
        for a, b, (j, x), (k, y) in runs:
            floor = spans[-1][1] if spans else 0
            for n in range(256):
                if a - 1 < floor or x - 1 < 0 or text[a - 1] != texts[j][x - 1]:
                    break
                a, x = a - 1, x - 1
            for n in range(256):
                if b >= len(text) or y >= len(texts[k]) or text[b] != texts[k][y]:
                    break
                b, y = b + 1, y + 1
            a, b = max(a, floor), max(b, floor)
            if spans and a == floor:
                spans[-1][1] = b
            else:
                spans.append([a, b])

        def at_word(p):
            return p in (0, len(text)) or space(text[p - 1]) or space(text[p])

        for a, b in reversed(spans):
            begin = next((p for p in range(a, min(b, a + 64) + 1) if at_word(p)), None)
            if begin is None:
                begin = next((p for p in range(a, b + 1) if p == b or text[p] & 0xC0 != 0x80))
            end = next((p for p in range(b, max(begin, b - 64) - 1, -1) if at_word(p)), None)
            if end is None:
                end = next(p for p in range(b, begin - 1, -1) if p in (begin, len(text)) or text[p] & 0xC0 != 0x80)
            if begin < end - 1 and space(text[begin]) and space(text[end - 1]):
                begin += 1
            if end - begin >= substring.MIN_RUN:
                text = text[:begin] + text[end:]
        out[i] = text.decode()
    return [out[i] for i in range(len(docs))]


def test_chunks_are_those_of_a_byte_loop(documents):
    texts = [(d["text"] or "").encode() for d in dicts(documents)[:60]] + [b"", b"a", b"x" * 3000, "é".encode() * 700]
    assert substring.chunk_ends(texts) == [own_chunks(t) for t in texts]


def test_substrings(documents):
    docs = dicts(documents)
    got = substring.dedup_substrings(documents)
    assert got.columns == documents.columns
    expected = sorted((d["doc_id"], t) for d, t in zip(docs, brute_substrings(docs)))
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect())


def test_substrings_with_many_blocks_in_a_slice(documents, monkeypatch):
    docs = dicts(documents)
    expected = sorted((d["doc_id"], t) for d, t in zip(docs, brute_substrings(docs)))
    monkeypatch.setattr(substring, "BLOCK_BYTES", 20_000)
    got = substring.dedup_substrings(documents.coalesce(1))
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == expected


def test_substrings_edges(edges):
    got = substring.dedup_substrings(edges)
    assert got.dtypes == edges.dtypes
    rows, old = dicts(got), dicts(edges)
    assert len(rows) == len(old)
    assert {(r["doc_id"], r["text"]) for r in rows if len(r["text"] or "") < 100 and r["doc_id"] in (7, 8, 9, 10)} == {
        (7, None), (8, ""), (9, " \t\n\r\x0b\x0c "), (10, "one")}
    assert substring.dedup_substrings(edges.limit(0)).collect() == []


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.mark.parametrize("n_words", [52, 60, 120, 900])
def test_passages_are_cut_whole_from_all_but_the_first(spark, n_words, monkeypatch):
    import random

    monkeypatch.setattr(substring, "BLOCK_BYTES", 30_000)
    rng = random.Random(n_words)
    passages = [prose(rng, n_words) for _ in range(8)]
    texts = [f"{prose(rng, 80 + i)} {passages[i % 8]} {prose(rng, 90)}" for i in range(48)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    out = {r["doc_id"]: r["text"] for r in substring.dedup_substrings(docs).collect()}
    left = total = 0
    for i, text in enumerate(texts):
        passage, rest = passages[i % 8], text.replace(passages[i % 8], "").split()
        if i < 8:
            assert out[i] == text
            continue
        total += len(passage)
        left += max(0, len(out[i]) - len(" ".join(rest)))
        assert [w for w in rest if w not in out[i].split()] == []  # nothing else is lost
    assert left <= 0.05 * total


def test_a_passage_in_every_document_is_no_hot_group(spark, monkeypatch):
    """A digest of all documents is joined, not gathered; places are read once."""
    import random

    monkeypatch.setattr(substring, "BLOCK_BYTES", 20_000)
    rng = random.Random(1)
    passage = prose(rng, 100)
    docs = spark.createDataFrame([(i, f"{prose(rng, 30)} {passage} {prose(rng, 30)}") for i in range(400)],
                                 "doc_id long, text string").repartition(8)
    out = {r["doc_id"]: r["text"] for r in substring.dedup_substrings(docs).collect()}
    assert [i for i in out if passage in out[i]] == [0] and all(len(out[i]) < 500 for i in range(1, 400))
    plan = substring.deduplicated(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_texts_of_one_id_and_without_id(spark):
    """Equal ids with different texts, null ids, and repeated rows."""
    import random

    rng = random.Random(2)
    passage = prose(rng, 80)
    rows = [(1, f"{prose(rng, 40)} {passage}") for _ in range(6)] + [(None, f"{passage} {prose(rng, 40)}") for _ in range(3)]
    rows += [(2, prose(rng, 90))] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = [r["text"] for r in substring.dedup_substrings(docs).collect()]
    assert len(out) == len(rows)
    assert sum(passage in t for t in out) == 1  # whichever comes first by hash
    assert sum(t == rows[-1][1] for t in out) == 1 and out.count("") == 4


def test_chunks_resist_an_insertion():
    text = ("".join(chr(97 + i * i % 23) for i in range(5000))).encode()
    import random

    rng = random.Random(1)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(5000))
    plain, shifted = (set(substring.digests(t, substring.chunk_ends([t])[0])) for t in (text, b"zz" + text))
    assert len(plain & shifted) >= 0.9 * len(plain)
    ends = substring.chunk_ends(["é".encode() * 4000])[0]
    assert ends[-1] == 8000 and all(e % 2 == 0 for e in ends)
