"""The corpus pipeline, stage by stage, against brute force."""

import os
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from mercato.llm import quality_rules as q
from mercato.llm.common import scratch_made, tidy, tidy_groups
from tests.llm import brute
from tests.llm.conftest import SF, dicts
from tests.llm.test_quality import distance, estimate, rates
from tests.llm.test_storage_operators import crc, token_ids
from tests.llm.test_text_operators import brute_substrings


@pytest.fixture(scope="module")
def results(spark, documents):
    out, docs = [documents], documents
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/stage-{len(out)}")
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "MinHash near-dedup", "substring dedup", "benchmark decontamination", "best-fit packing"]


def test_quality_stage(results):
    docs, groups = dicts(results[0]), {}
    for d in docs:
        n, chars, symbols, _, repeats, failed = brute.statistics(d["text"])
        d["x"] = None if failed else rates({
            "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_repeat_words": repeats,
            "n_capitals": len(re.findall("[A-Z]", d["text"])), "n_marks": len(re.findall("[.,;:!?]", d["text"]))})
        if not failed:
            groups.setdefault((d["lang"], d["source"]), []).append(d["x"])
    fitted = {g: estimate(np.array(x)) for g, x in groups.items()}
    expected = {d["doc_id"] for d in docs if d["x"] and distance(
        np.array([d["x"]]), fitted[(d["lang"], d["source"])])[0] <= q.CUTOFF}
    kept = dicts(results[1])
    assert {d["doc_id"] for d in kept} == expected and 0 < len(expected) < len(docs)
    assert all(d in [{k: v for k, v in o.items() if k != "x"} for o in docs] for d in kept[:20])


def test_near_dedup_stage(results):
    before = dicts(results[1])
    expected = {i for i, n, c in brute.near_components(before) if i == c}
    assert {d["doc_id"] for d in dicts(results[2])} == expected


def test_substring_stage(results):
    before = dicts(results[2])
    expected = {d["doc_id"]: t for d, t in zip(before, brute_substrings(before))}
    assert {d["doc_id"]: d["text"] for d in dicts(results[3])} == expected


def test_decontamination_stage(spark, results):
    items = dicts(spark.read.parquet(f"{SF}/benchmark.parquet"))
    before = dicts(results[3])
    hit = {r[0] for r in brute.contamination(before, items) if r[5]}
    after = {d["doc_id"]: d for d in dicts(results[4])}
    assert set(after) == {d["doc_id"] for d in before}
    for d in before:
        if d["doc_id"] in hit:
            assert len(after[d["doc_id"]]["text"]) < len(d["text"])
        else:
            assert after[d["doc_id"]] == d


def test_packing_stage(results):
    docs, rows = dicts(results[4]), dicts(results[5])
    expected = Counter()
    for d, ids in zip(docs, token_ids([d["text"] for d in docs])):
        for k, at in enumerate(range(0, len(ids), 4096)):
            expected[(d["doc_id"], k, len(ids[at:at + 4096]), crc(ids[at:at + 4096]))] += 1
    assert Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows) == expected


def test_columns_are_kept(results):
    for docs in results[:5]:
        assert docs.columns == results[0].columns


def test_run_returns_the_last_stage(spark, results):
    before = list(scratch_made(spark))
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == results[5].columns and got.count() == results[5].count()
    left = [p for p in scratch_made(spark) if p not in before]
    assert len(left) == 1 and "best-fit-packing" in left[0]  # the others are removed
    folders = os.listdir(spark.conf.get("spark.checkpoint.dir"))
    assert not [f for f in folders if f.startswith(("quality-rules", "MinHash", "substring-dedup", "benchmark"))]


def test_stages_take_edges_and_an_empty_table(spark, edges):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, edges, SF)
        assert out.dtypes == edges.dtypes, name
        assert stage(spark, edges.limit(0), SF).count() == 0, name


@pytest.mark.parametrize("wrapped", [lambda f: list(tidy(lambda batches: iter([f()]))([])),
                                     lambda f: [tidy_groups(lambda left, right: f())(None, None)]])
def test_a_task_gives_its_freed_memory_back(wrapped):
    """Also what lies below memory that is still held."""
    def resident():
        with open("/proc/self/smaps_rollup") as f:
            return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", f.read()))) / 1024

    def work():
        arrays = [np.ones(4000, np.uint8) for _ in range(40_000)]
        peaks.append(resident())
        return arrays[-1]

    peaks = []
    held = wrapped(work)
    assert len(held) == 1 and resident() < peaks[0] - 120
