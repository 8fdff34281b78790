"""CSV files read in many tasks against the one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from mercato.sources import bronze, parquet, split_csv


@pytest.fixture
def small_splits(spark):
    """Scan splits of a few hundred bytes, so that small files have many."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "300")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def field(rng, wide):
    kind = rng.random()
    if kind < 0.15:
        return rng.choice(["", '""', "007", "  ", "x"])
    if kind < 0.5:
        return str(rng.randrange(10**6))
    text = "".join(rng.choice(["a", "é", ",", "\n", '""', " ", "b\n\n", "\r\n", "日"]) for _ in range(rng.randrange(wide)))
    return f'"{text}"'


def write(path, rng, rows, wide, end="\n"):
    lines = ["seller_id,seller_city,note", *(",".join([f"{k}", field(rng, wide), field(rng, wide)]) for k in range(rows))]
    path.write_bytes(end.join(lines).encode() + (end.encode() if rng.random() < 0.5 else b""))
    return str(path)


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.select("seller_id", "seller_city", "note").collect())))


@pytest.mark.parametrize("seed,wide,end", [(1, 8, "\n"), (2, 60, "\n"), (3, 400, "\n"), (4, 40, "\r\n"), (5, 1500, "\n")])
def test_many_tasks_read_what_one_task_reads(spark, tmp_path, small_splits, seed, wide, end):
    rng = random.Random(seed)
    for k in range(3):
        (tmp_path / "sellers").mkdir(exist_ok=True)
        write(tmp_path / "sellers" / f"part-{k}.csv", rng, rng.choice([1, 40, 90]), wide, end)
    path = str(tmp_path / "sellers")
    alone = bronze.read_text(spark, path, split=False)
    many = bronze.read_text(spark, path)
    assert split_csv.ODD in many.columns and many.where(split_csv.ODD).count() == 0
    assert many.rdd.getNumPartitions() > 3
    assert rows(many) == rows(alone)


def test_records_over_many_splits(spark, tmp_path, small_splits):
    """One field of 5,000 lines, and lines longer than several splits."""
    p = tmp_path / "sellers.csv"
    big, line = "\n".join(["row"] * 5000), "x" * 2000
    p.write_text(f'seller_id,seller_city,note\n1,"{big}",a\n2,"{line}\n{line}",b\n3,c,"d"\n')
    many = bronze.read_csv(spark, str(p), "sellers")
    assert sorted(map(tuple, many.collect())) == [("1", big, "a"), ("2", f"{line}\n{line}", "b"), ("3", "c", "d")]


def test_one_large_file_is_read_in_many_even_tasks(spark, tmp_path):
    """A file of some 40 MB in 1 MB splits: every task does its share, and none reads it all."""
    p, note = tmp_path / "sellers.csv", 'a ""quoted"", note\nof two lines ' * 20
    with open(p, "w") as f:
        f.write("seller_id,seller_city,note\n")
        for k in range(60_000):
            f.write(f'{k},"city {k}\n",{k}\n' if k % 3 else f'{k},city,"{note}"\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        many = bronze.read_csv(spark, str(p), "sellers")
        lines = split_csv.text_lines(spark, str(p))
        assert lines.rdd.getNumPartitions() >= 10
        per_task = lines.groupBy("split").count().collect()
        assert max(r["count"] for r in per_task) < 3 * lines.count() / len(per_task)
        assert many.count() == 60_000
        alone = bronze.read_csv(spark, str(p), "sellers", split=False)
        digest = F.sum(F.xxhash64("seller_id", "seller_city", "note").cast("decimal(38,0)"))
        assert many.agg(digest).first() == alone.agg(digest).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)



@pytest.mark.parametrize("record,odd", [
    ("a,b", False), ('"a","b"', False), ('"a ""b"" c",d', False), ('"""",x', False), ('"""a""",""', False),
    ('5" pipe,x', True), ('a,b"c"', True), ('"a"b,c', True), ('5" and 6",x', True), ('"x\ny",z', False)])
def test_odd_quotes(spark, record, odd):
    df = spark.createDataFrame([(record,)], "record string")
    assert df.select(split_csv.odd_quotes(F.col("record"))).first()[0] is odd


@pytest.mark.parametrize("extra", ['7,5" pipe,x\n', '7,5" pipe,x\n8,3" nail,y\n'])  # quotes add up or not
def test_a_table_with_odd_quotes_is_loaded_one_task_a_file(spark, tmp_path, small_splits, extra):
    p = tmp_path / "sellers.csv"
    p.write_text("seller_id,seller_city,note\n" + "".join(f'{k},"c\nd",n\n' for k in range(100)) + extra)
    status = bronze.ingest_csv(spark, "sellers", str(p), str(tmp_path / "bronze"))
    assert status.ok
    got = parquet.try_read(spark, parquet.bronze_path(str(tmp_path / "bronze"), "sellers"))
    assert rows(got) == rows(bronze.read_text(spark, str(p), split=False))


def test_ingest_in_splits(spark, tmp_path, small_splits):
    p = tmp_path / "order_reviews.csv"
    p.write_text("review_id,order_id,review_score,note\n" + "".join(
        f'{k},{k},{"five" if k == 50 else k % 5},"n\n{k}"\n' for k in range(200)))
    status = bronze.ingest_csv(spark, "order_reviews", str(p), str(tmp_path / "bronze"))
    assert (status.ok, status.rows, status.bad_values) == (True, 200, 1)
    got = parquet.try_read(spark, parquet.bronze_path(str(tmp_path / "bronze"), "order_reviews"))
    assert got.columns == ["review_id", "order_id", "review_score", "note"]
    assert {(r.review_id, r.note) for r in got.collect()} == {(str(k), f"n\n{k}") for k in range(200)}


def test_lines_carry_numbers_only(spark, tmp_path):
    """A path on every line is more than the line itself; Python gets numbers."""
    p = tmp_path / "some_rather_long_name_of_a_table.csv"
    p.write_bytes(b'a,b\n1,"x\ny\nz"\n\n2,w\n')
    lines = split_csv.text_lines(spark, str(p))
    assert dict(lines.dtypes) == {"value": "string", "file": "bigint", "block": "bigint", "split": "bigint"}
    split = lines.first()["split"]
    found = split_csv.records(lines, {split: False})
    assert [r["record"] for r in found.collect()] == ['1,"x\ny\nz"', "2,w"]
    assert all(t in ("string", "int", "bigint") for _, t in found.dtypes) and dict(found.dtypes)["file"] == "bigint"
