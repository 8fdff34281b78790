"""CSV and JSON sources, and the whole job from files in a scratch folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from mercato.plans import job, registry
from mercato.sources import bronze, geo, parquet, testdata, versions

SF = "/root/testdata/sf0.001"


def test_table_names_from_files():
    assert bronze.table_name_for("/x/shop_orders_dataset.csv", prefix="shop_") == "orders"
    assert bronze.table_name_for("closed_deals.csv") == "closed_deals"


def test_csv_text_edge_cases(spark, tmp_path):  # T11
    p = tmp_path / "customers.csv"
    p.write_text('customer_id,customer_unique_id,customer_city,customer_state,extra\n'
                 '007,u1,"line one\nline two","a ""quoted"", state",x\n'
                 '008,u2,"",SP,\n')
    df = bronze.read_csv(spark, str(p), "customers")
    rows = {r.customer_id: r for r in df.collect()}
    assert set(rows) == {"007", "008"}
    assert rows["007"].customer_city == "line one\nline two"
    assert rows["007"].customer_state == 'a "quoted", state'
    assert rows["008"].customer_city == ""
    assert df.columns[-1] == "extra"


def test_csv_declared_types(spark, tmp_path):
    p = tmp_path / "order_items.csv"
    p.write_text("order_id,order_item_id,product_id,seller_id,price,freight_value\n"
                 "a1,1,p1,s1,10.5,2.25\n")
    df = bronze.read_csv(spark, str(p), "order_items")
    types = dict(df.dtypes)
    assert types["price"] == "double" and types["order_id"] == "string" and types["order_item_id"] == "string"


def test_numbers_in_other_forms_survive_and_misfits_are_counted(spark, tmp_path):
    p = tmp_path / "order_reviews.csv"
    p.write_text("review_id,order_id,review_score,note\n1,a,4.0,x\n2,b,5,x\n3,c,,x\n4,d,five,x\n5,e,2.5,\n")
    st = bronze.ingest_csv(spark, "order_reviews", str(p), str(tmp_path / "bronze"))
    rows = parquet.try_read(spark, str(tmp_path / "bronze" / "order_reviews.parquet")).orderBy("review_id").collect()
    assert [r.review_score for r in rows] == [4, 5, None, None, None]
    assert (st.ok, st.rows, st.bad_values) == (True, 5, 2) and "__bad" not in rows[0].asDict()


def test_a_table_of_many_files_is_read_in_many_tasks(spark, tmp_path):
    folder = tmp_path / "raw" / "shop_sellers_dataset"
    folder.mkdir(parents=True)
    for i in range(6):
        (folder / f"part-{i}.csv").write_text(f"seller_id,seller_city,seller_state\n{i},c,SP\n" + "9,d,RJ\n" * 50)
    (tmp_path / "raw" / "shop_orders_dataset.csv").write_text("order_id\n1\n")
    found = bronze.discover_tables(spark, str(tmp_path / "raw"), "shop_")
    assert set(found) == {"sellers", "orders"}
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        df = bronze.read_csv(spark, found["sellers"], "sellers")
        assert df.count() == 306 and df.rdd.getNumPartitions() > 1
        files = sorted(str(f) for f in folder.iterdir())
        assert bronze.read_csv(spark, files[:2], "sellers").count() == 102
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)


def test_unreadable_folder_is_not_a_missing_table(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    from mercato.sources import parquet

    (tmp_path / "empty").mkdir()
    assert parquet.try_read(spark, str(tmp_path / "absent")) is None
    with pytest.raises(AnalysisException):
        parquet.try_read(spark, str(tmp_path / "empty"))


def test_missing_csv_is_reported_not_raised(spark, tmp_path):
    st = bronze.ingest_csv(spark, "orders", str(tmp_path / "nope.csv"), str(tmp_path / "bronze"))
    assert not st.ok


def test_preview_of_missing_table_is_empty(spark, tmp_path):
    assert bronze.preview(spark, str(tmp_path / "missing")).count() == 0


def test_geojson_reader(spark, tmp_path):  # S11
    p = tmp_path / "states.json"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": "SP", "properties": {"name": "Sao Paulo", "x": 1}, "geometry": None},
        {"type": "Feature", "id": "RJ", "properties": {"name": "Rio"}}]}, indent=2))
    doc = geo.read_geojson(spark, str(p))
    assert doc.count() == 1
    from mercato.plans.gold import explode_states
    assert sorted(tuple(r) for r in explode_states(doc).collect()) == [("RJ", "Rio"), ("SP", "Sao Paulo")]


def _write_csvs(spark, out_dir):
    b = testdata.bronze_tables(spark, SF)
    paths = {}
    for t in bronze.RAW_TYPES:
        d = os.path.join(out_dir, f"{t}_dataset_csv")
        b[t].coalesce(1).write.option("header", True).option("escape", '"').csv(d)
        paths[t] = d
    return paths, b


def test_job_from_csv_files(spark, tmp_path):  # whole job (S1-S4, S8, S12, V1-V6)
    paths, b = _write_csvs(spark, str(tmp_path / "raw"))
    out = str(tmp_path / "out")
    res = job.run_job(spark, out, csv_tables=paths, geo=b["geo"], dedupe_order=testdata.DEDUPE_ORDER)
    assert all(s.ok for s in res.ingest)
    assert res.verified
    assert not [f for f in res.findings if f["severity"] in ("MISSING", "TYPE")]
    assert len(res.gold_rows) == 15 and all(n > 0 for n in res.gold_rows.values())
    # Text keys read from CSV give the same row counts as the typed stand-ins.
    qs = registry.queries()
    for name in ("state_performance", "logistics_flow", "sales_trends"):
        assert res.gold_rows[name] == qs[f"gold_{name}"](spark, SF).count()
    for name in ("orders", "customers", "order_items", "order_reviews"):
        assert res.silver_rows[name] == qs[f"silver_{name}"](spark, SF).count()
    report = "\n".join(r.value for r in spark.read.text(os.path.join(out, "reports", "data_health_summary.md")).collect())
    assert "## 1. Executive Summary" in report and "| Relational |" in report
    silver_orders = parquet.try_read(spark, os.path.join(out, "silver", "orders_cleaned.parquet"))
    assert dict(silver_orders.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    assert silver_orders.where(F.col("order_purchase_timestamp").isNull()).count() == 0


def test_job_reports_missing_raw_tables(spark, tmp_path):
    import pytest

    from mercato.sources import parquet

    paths, b = _write_csvs(spark, str(tmp_path / "raw"))
    del paths["sellers"]
    with pytest.raises(parquet.MissingTableError, match="sellers"):
        job.run_job(spark, str(tmp_path / "out"), csv_tables=paths, geo=b["geo"])


def test_single_line_csv_reads_the_same(spark, tmp_path):
    p = tmp_path / "sellers.csv"
    p.write_text("seller_id,seller_city,seller_state\n1, sao paulo ,SP\n2,\"rio, de janeiro\",RJ\n3,,\"\"\n")
    a = sorted(tuple(r) for r in bronze.read_csv(spark, str(p), "sellers").collect())
    b = sorted(tuple(r) for r in bronze.read_csv(spark, str(p), "sellers", multiline=False).collect())
    assert a == b and ("3", None, "") in a


def test_cli_runs_the_job(spark, tmp_path):
    from mercato.__main__ import main

    raw = tmp_path / "raw"
    raw.mkdir()
    b = testdata.bronze_tables(spark, SF)
    for t in bronze.RAW_TYPES:  # one CSV file per table, as raw drops arrive
        b[t].toPandas().to_csv(raw / f"shop_{t}_dataset.csv", index=False)
    rows = testdata.view(spark, SF, "geo_states").collect()
    (raw / "states.json").write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": r.state_id, "properties": {"name": r.state_name}} for r in rows]}))
    out = tmp_path / "out"
    args = ["--raw-dir", str(raw), "--geo", str(raw / "states.json"), "--out", str(out), "--prefix", "shop_"]
    assert main(args) == 0
    assert len(os.listdir(out / "gold")) == 15
    assert (out / "reports" / "data_health_summary.md").exists()
    # The scores, which pandas wrote as 4.0, are those of the given tables.
    for table, column in (("order_reviews", "review_score"), ("order_payments", "payment_installments")):
        written = parquet.try_read(spark, str(out / "silver" / f"{table}_cleaned.parquet"))
        given = registry.silver_for(spark, SF)[table]
        assert written.agg(F.sum(column), F.count(column)).collect() == given.agg(F.sum(column), F.count(column)).collect()
    # Without the prefix the table names do not resolve: a clean failure.
    assert main(args[:-2] + ["--out", str(tmp_path / "out2")]) == 1


def test_tasks_of_the_written_layers_follow_the_input(spark, monkeypatch):
    from mercato import session
    from mercato.plans import layers

    monkeypatch.setattr(session, "SHARED_FROM_BYTES", 1)
    monkeypatch.setattr(session, "SHARED_PARTITION_BYTES", 8192)

    def settings() -> dict:
        return {session.INITIAL_PARTITIONS: spark.conf.get(session.INITIAL_PARTITIONS, None) or None,
                **{k: spark.conf.get(k) for k in session.TASK_SETTINGS}}

    before, inside = settings(), []
    for stage in ("run_silver", "run_gold"):
        def watched(*args, run=getattr(job, stage)):
            inside.append(settings())
            return run(*args)
        monkeypatch.setattr(job, stage, watched)
    done = layers.run(spark, f"{SF}/.")
    assert len(inside) == 2
    for found in inside:
        assert int(found[session.INITIAL_PARTITIONS]) > int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert {k: found[k] for k in session.TASK_SETTINGS} == session.TASK_SETTINGS
    assert settings() == before
    # Items that were dealt by order give the same report.
    written = parquet.read_required(spark, parquet.gold_path(done.gold, "product_reviews"), "gold")
    want = registry.queries()["gold_product_reviews"](spark, SF)
    assert sorted(map(str, written.collect())) == sorted(map(str, want.collect()))
    files = spark.read.parquet(versions.live_path(spark, parquet.silver_path(done.silver, "order_items"))).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


@pytest.mark.parametrize("large_from, moved", [(1, True), (1 << 40, False)])
def test_only_large_tables_get_small_tasks(spark, monkeypatch, large_from, moved):
    from mercato import session

    monkeypatch.setattr(session, "SHARED_FROM_BYTES", large_from)
    before = {k: spark.conf.get(k) for k in session.TASK_SETTINGS}
    with session.small_tasks(spark, 1 << 30):
        inside = {k: spark.conf.get(k) for k in session.TASK_SETTINGS}
    assert (inside == session.TASK_SETTINGS) == moved and (moved or inside == before)
    assert {k: spark.conf.get(k) for k in session.TASK_SETTINGS} == before
