"""Replacing tables while others read them."""

import pytest
from pyspark.sql import functions as F

from mercato.plans import verify
from mercato.sources import bronze, parquet, versions


def numbers(spark, path):
    return sorted(r.id for r in parquet.try_read(spark, path).collect())


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert parquet.write_counted(spark.range(5), path, "t") == 5
    broken = spark.range(100, numPartitions=4).withColumn(
        "id", F.when(F.col("id") == 99, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stop"):
        parquet.write_counted(broken, path, "t")
    assert numbers(spark, path) == [0, 1, 2, 3, 4]
    assert [v.rows for v in versions.history(spark, path)] == [5]
    assert len([p for p in (tmp_path / "t.parquet").iterdir() if p.name.startswith("v-")]) == 1  # nothing left behind


def test_a_writer_that_dies_between_data_and_marker_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    parquet.write_counted(spark.range(3), path, "t")
    spark.range(50).write.parquet(f"{path}/v-unfinished")  # all data there, never made live
    assert numbers(spark, path) == [0, 1, 2]
    parquet.write_counted(spark.range(4), path, "t")
    assert numbers(spark, path) == [0, 1, 2, 3]


def test_readers_that_have_begun_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    parquet.write_counted(spark.range(3), path, "t")
    begun = parquet.try_read(spark, path)
    parquet.write_counted(spark.range(7), path, "t")
    assert begun.count() == 3 and parquet.try_read(spark, path).count() == 7
    parquet.write_counted(spark.range(9), path, "t")
    assert [v.rows for v in versions.history(spark, path)] == [7, 9]


def test_a_table_is_replaced_by_one_made_from_it(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    parquet.write_counted(spark.range(6), path, "t")
    parquet.write_counted(parquet.try_read(spark, path).where("id > 2"), path, "t")
    assert numbers(spark, path) == [3, 4, 5]


def test_two_writers_leave_one_table(spark, tmp_path):
    path = str(tmp_path / "t.parquet")

    def outer(folder):
        parquet.write_counted(spark.range(2), path, "inner")  # another writer ends first
        spark.range(8).write.parquet(folder)
        return 8

    versions.replace(spark, path, outer)
    assert numbers(spark, path) == list(range(8))


def test_plain_folders_are_read_as_they_are(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(4).write.parquet(path)
    assert numbers(spark, path) == [0, 1, 2, 3] and versions.live(spark, path) is None
    parquet.write_counted(spark.range(2), path, "t")
    assert numbers(spark, path) == [0, 1]
    assert parquet.try_read(spark, str(tmp_path / "absent")) is None


def test_a_load_that_fails_keeps_the_bronze_table(spark, tmp_path, monkeypatch):
    good, layer = tmp_path / "sellers.csv", str(tmp_path / "bronze")
    good.write_text("seller_id,seller_city,seller_state\n1,a,SP\n")
    assert bronze.ingest_csv(spark, "sellers", str(good), layer).ok
    monkeypatch.setattr(bronze, "_declared", lambda df, table: {})
    monkeypatch.setattr(bronze, "read_text", lambda *a, **k: spark.range(3).withColumn(
        "seller_id", F.raise_error(F.lit("broken file")).cast("string")))
    assert not bronze.ingest_csv(spark, "sellers", str(good), layer).ok
    assert parquet.try_read(spark, parquet.bronze_path(layer, "sellers")).count() == 1


def test_the_audit_takes_the_counts_of_the_writes(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    parquet.write_counted(spark.range(5), a, "a")
    spark.range(3).write.parquet(b)
    tables = {"a": parquet.try_read(spark, a), "b": parquet.try_read(spark, b)}
    assert verify.written_rows(spark, {"a": a, "b": b}, tables) == {"a": 5, "b": 3}
