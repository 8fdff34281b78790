"""Operators 2, 4, 6, 8 and 9."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import html_text, licences, orc_tokens, packing, sharding
from mercato.llm.queries import ORACLE_SQL, QUERIES
from mercato.llm.tokens import Encoder, tokenizer_path
from tests.llm.conftest import SF, dicts


@pytest.fixture(scope="module", params=["documents", "edges", "empty"])
def table(request, documents, edges):
    return {"documents": documents, "edges": edges, "empty": edges.limit(0)}[request.param]


def token_ids(texts):
    from tokenizers import Tokenizer

    encoded = Tokenizer.from_file(tokenizer_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, 1] for e in encoded]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library():
    rng = random.Random(2)
    odd = ["İstanbul <|endoftext|> x", "áb é", "don't it's ΣΑΣ", "ǅ x...y \"a,b.\" 12,3.", " x y \t z", "ß ẞ ÿ, Å.",
           "", " ", "\n\n", "ﬁ Å b", "日本語 \U0001f600,", "a . , b", "A,\nb.", "x.. y", "the, the. The THE"]
    letters = "abzéßÅ ,.\n'!<|1́"
    odd += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    encode = Encoder()
    for _ in range(2):  # from the library, then from the memo
        assert encode(odd) == [np.array(i, "<u4").tobytes() for i in token_ids(odd)]


def test_packing(table):
    rows, docs = packing.pack(table).collect(), dicts(table)
    expected = Counter()
    for d, ids in zip(docs, token_ids([d["text"] for d in docs])):
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            expected[(d["doc_id"], k, at, len(part), crc(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // 4096) + 2


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 64): rng.choice((1, 2, 3, 50, 700)) for _ in range(rng.randint(1, 40))}
    planned = packing.plan(histogram, 64)
    taken = defaultdict(list)
    for length, rank, n, first, offset in planned:
        for i in range(n):
            taken[length].append(rank + i)
    assert {k: sorted(v) for k, v in taken.items()} == {k: list(range(n)) for k, n in histogram.items()}
    bins = []  # best fit of single pieces, longest first
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [b for b in range(len(bins)) if bins[b] >= length]
            if fits:
                bins[min(fits, key=bins.__getitem__)] -= length
            else:
                bins.append(64 - length)
    assert max(first + n for _, _, n, first, _ in planned) == len(bins)


def test_orc_round_trip(spark, table, tmp_path):
    path = str(tmp_path / "orc")
    orc_tokens.write_token_orc(table, path)
    rows = orc_tokens.read_token_orc(spark, path).collect()
    docs = dicts(table)
    expected = Counter((d["doc_id"], tuple(i)) for d, i in zip(docs, token_ids([d["text"] for d in docs])))
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == expected
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    digests = orc_tokens.read_token_orc(spark, path, digest=True)
    assert sorted(map(tuple, digests.collect()), key=str) == sorted(
        ((r.doc_id, r.start, r.n_tokens, crc(r.ids)) for r in rows), key=str)


def test_orc_files_have_bloom_filters_and_prune(spark, documents, tmp_path):
    path = str(tmp_path / "orc")
    orc_tokens.write_token_orc(documents, path)
    rows = spark.read.orc(path).where("doc_id = 17")
    assert "EqualTo(doc_id,17)" in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 1
    from pyarrow import orc

    files = [str(f) for f in (tmp_path / "orc").glob("part-*.orc")]
    assert sum(orc.ORCFile(f).nrows for f in files) == documents.count()
    raw = b"".join(open(f, "rb").read() for f in files)
    assert len(raw) < 4 * sum(r.n_tokens for r in spark.read.orc(path).collect())  # run-length encoded


def brute_shards(docs, limit):
    import hashlib

    def bits(text):
        return "".join(f"{int(c, 16):04b}" for c in hashlib.md5(text.encode()).hexdigest())

    rows = [("" if d["doc_id"] is None else str(d["doc_id"]), d["text"] or "") for d in docs]
    rows = [(bits(i) + bits(t), len(t.encode())) for i, t in rows]
    out = [""] * len(rows)

    def split(members, depth):
        if sum(rows[i][1] for i in members) <= limit or len({rows[i][0] for i in members}) == 1:
            for i in members:
                out[i] = rows[members[0]][0][:depth]
        else:
            for b in "01":
                part = [i for i in members if rows[i][0][depth] == b]
                if part:
                    split(part, depth + 1)

    if rows:
        split(list(range(len(rows))), 0)
    return out


@pytest.mark.parametrize("limit", [1, 3000, 50_000, 1 << 30])
def test_shards(table, limit):
    docs = dicts(table)
    got = sharding.shards(sharding.addressed(table, ["doc_id", "text"]), limit).collect()
    expected = Counter((d["doc_id"], d["text"], s) for d, s in zip(docs, brute_shards(docs, limit)))
    assert Counter((r.row.doc_id, r.row.text, r.shard) for r in got) == expected


def test_shards_of_one_hot_id_split_on_its_texts(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "x" * 100)], "doc_id long, text string")
    rows = sharding.shards(sharding.addressed(docs, ["doc_id"]), 400).groupBy("shard").agg(F.sum("n_bytes").alias("n"))
    assert rows.agg(F.max("n")).first()[0] <= 400


def test_written_shards(spark, edges, tmp_path):
    sharding.write_shards(edges, str(tmp_path / "s"), 3000)
    back = spark.read.parquet(str(tmp_path / "s")).select("row.*")
    assert sorted(map(str, dicts(back))) == sorted(map(str, dicts(edges)))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_registered_sql(spark, name):
    con = duckdb.connect()
    for view in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{SF}/{view}.parquet')")
    expected = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(expected.fetchall())


def test_shards_against_sql_with_a_small_limit(spark, documents):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    expected = {r[0]: r[2] for r in con.execute(sharding.oracle(20_000)).fetchall()}
    rows = sharding.shards(sharding.addressed(documents, ["doc_id"]), 20_000).collect()
    assert {r.row.doc_id: r.shard for r in rows} == expected and len(set(expected.values())) > 20


def brute_licences(docs, threshold=licences.THRESHOLD):
    """Every window of every template, word by word."""
    import re

    def cut(text):
        return re.sub(r"\.( |$)", " ", re.sub("[^a-z0-9.]+", " ", text.lower())).split()

    def bigrams(w):
        return [f"{a} {b}" for a, b in zip(w, w[1:])]

    known, out = [(n, cut(t), set(bigrams(cut(t)))) for n, t in licences.TEMPLATES], []
    for d in docs:
        w, hits = cut(d["text"] or ""), []
        if not any(k in (d["text"] or "").lower() for k in ("licen", "permission", "permitted", "public", "author")):
            continue
        for name, own, pairs in known:
            for i, first in enumerate(bigrams(w)):
                if first in pairs:
                    window = bigrams(w[i:i + len(own)])
                    dice = 2 * len(pairs & set(window)) / (len(pairs) + len(set(window)))
                    if dice >= threshold:
                        end = min(len(w), i + len(own))
                        hits.append((-dice, i - end, i, name, end))
        for h in hits:
            if not any(g[2] < h[4] and h[2] < g[4] and g < h for g in hits):
                out.append((d["doc_id"], h[2], h[4] - h[2], h[3], -h[0]))
    return out


def wrapped(text, width):
    import textwrap

    return "\n".join(f" * {line}" for line in textwrap.wrap(text, width))


def test_licences(spark, table):
    full, words = dict(licences.TEMPLATES), "some other words of the file itself"
    more = spark.createDataFrame([
        (5000, "X\nreleased under the  MIT license\nnot a licence at all"), (5001, full["MIT-grant"].replace(",", "\t")),
        (5002, "Licensed under the Apache License, Version 2.0. twice over and over again"),
        (5003, "Released under the MIT License."), (5004, "Copyright 2021 Acme. Released under the MIT License."),
        (5005, f"{words}\n{wrapped(full['AGPL-3.0'], 40)}\n{words}"), (5006, wrapped("MIT License " + full["MIT-text"], 60)),
        (5007, f"{words}. {full['BSD-3-Clause-text']} {words}. {full['Apache-2.0-header']}"),
        (5008, wrapped(full["ISC-text"].replace("THE SOFTWARE", "THIS SOFTWARE"), 72)),
        (5009, "Released under the MIT License. Released under the BSD 2-Clause License. Licensed under CC BY 4.0."),
        (5010, "The license of the driver was taken; permission to copy it was not granted, in public.")],
        "doc_id long, text string")
    docs = table.withColumn("words", F.lit("clash")).withColumn("pairs", F.lit(1)).unionByName(more, allowMissingColumns=True)
    got = licences.scan(docs)
    assert got.columns == ["doc_id", "word", "n_words", "licence", "dice"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_licences(dicts(docs)), key=str)
    found = {}
    for r in got.where("doc_id >= 5000 and doc_id < 6000").orderBy("word").collect():
        found.setdefault(r.doc_id, []).append(r.licence)
    assert found == {5000: ["MIT"], 5001: ["MIT-grant"], 5002: ["Apache-2.0"], 5003: ["MIT"], 5004: ["MIT"], 5005: ["AGPL-3.0"],
                     5006: ["MIT-text"], 5007: ["BSD-3-Clause-text", "Apache-2.0-header"], 5008: ["ISC"],  # its unchanged part
                     5009: ["MIT", "BSD-2-Clause", "CC-BY-4.0"]}
    assert licences.scan(docs.limit(0)).collect() == []
    plan = licences.op8_licence_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.fixture(scope="module")
def trees(spark):
    return html_text.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def main_text(source):
    """The article's blocks of the given tables' pages, by their markup."""
    import html
    import re

    if "<article>" not in source:
        return ""
    inner = source.split("<article>")[1].split("</article>")[0]
    inner = re.sub("<!--.*?-->", "", inner)
    blocks = re.split(r"</?(?:p|h\d|li|ul|ol|div|blockquote)\b[^>]*>", inner)
    blocks = [" ".join(html.unescape(re.sub("<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_pages_of_the_table(spark):
    got = html_text.op9_html_extraction(spark, "/root/testdata/sf0.01")
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(pages)
    assert all(r.n_chars == len(r.text) for r in rows)
    wrong = [r.page_id for r in rows if r.text != main_text(pages[r.page_id])]
    assert wrong == []


def test_held_out_layouts(trees):
    rng = random.Random(99)
    texts = ["Some prose of a page, with commas and stops. It goes on for a while, and then it ends. " * 8]
    right = total = 0
    for _ in range(300):
        page = html_text.Page(html_text.layout(rng, texts), labelled=True)
        odds = trees(html_text.features([page]))
        kept = set(html_text.decoded(page, odds).split("\n"))
        for i, run in enumerate(page.run):
            if run:
                total += 1
                right += (run[0] in kept) == bool(page.label[page.parent[i]])
    assert right / total > 0.9


def test_pages_with_odd_markup(spark, trees):
    pages = [None, "", "no tags at all", "<p>cut off <b", "<!-- never closed", "<div><p>a<p>b</div></p></x>",
             "<script>var t='</p>'", "&lt;p&gt; &amp; &#233; &unknown; &am", "<p>" * 3000, "<ul><li>x" * 500,
             "<TABLE><TR><TD>a<TD>b", "<p class=\"a>b\">quoted", "<article></article>"]
    rows = [(i, f"u{i}", h, "extra") for i, h in enumerate(pages)] + [(None, None, "<p>x</p>", None), (3, "u3", "<p>", "e")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extracted(df).collect()
    assert len(got) == len(rows)
    assert all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert html_text.extracted(df.limit(0)).collect() == []


def test_text_after_self_closed_and_custom_elements_stays():
    page = html_text.Page("<p>a <svg class=icon /> b</p><title-card>c</title-card><p>d</p><svg><path/>no</svg>"
                          "<script src=x />no</script><SVG/><p>e</p>")
    assert " ".join(run[0] for run in page.run if run).split() == ["a", "b", "c", "d", "e"]


def test_decoding_keeps_no_node_inside_a_dropped_one(trees):
    page = html_text.Page("<div class='sidebar'><p>inner</p></div><article><h1>t</h1><p>text</p></article>")
    odds = np.full(len(page.parent), 1.0)
    odds[1] = -10.0  # the side bar
    assert html_text.decoded(page, odds) == "t\ntext"
    odds[1] = -0.5  # its content outweighs it
    assert html_text.decoded(page, odds) == "inner\nt\ntext"
