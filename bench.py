"""Benchmark: every registered query over the test tables, timed one by one.

Each query is run to completion with the ``noop`` sink (all rows and columns
computed, nothing collected), twice: a cold pass (first execution, which
includes plan construction and generated-code compilation) and a warm pass.
``value``/``queries`` are the warm pass; ``cold_value``/``cold_queries`` the
cold one.  Prints ONE JSON line.  The end-to-end job
(bronze -> quality -> silver -> gold -> verify through Parquet) is timed
separately as ``job_sec`` (stage split in ``job_stages``).

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_SKIP_JOB=1 to skip the end-to-end job, BENCH_EVENT_LOG=DIR
to write Spark's event log (stage and task times) into DIR.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from mercato.plans import registry
    from mercato.plans.job import run_job
    from mercato.session import build_session, scratch_dir
    from mercato.sources import testdata

    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        os.makedirs(os.environ["BENCH_EVENT_LOG"], exist_ok=True)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(f"local[{cpus}]", app="mercato-bench", shuffle_partitions=cpus, extra_conf=extra)
    # The written layers are what the job below times.
    qs = {name: q for name, q in registry.queries().items() if not name.startswith("layer_")}

    errors: dict[str, str] = {}

    def run_all() -> dict[str, float]:
        out: dict[str, float] = {}
        for name, q in qs.items():
            t0 = time.perf_counter()
            try:
                q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as e:  # noqa: BLE001 - reported in the JSON line
                errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
                continue
            out[name] = round(time.perf_counter() - t0, 3)
        return out

    cold = run_all()
    times = run_all()

    job_sec, stages = None, None
    if os.environ.get("BENCH_SKIP_JOB") != "1":
        out = scratch_dir(spark, f"bench-{uuid.uuid4().hex[:8]}")
        t0 = time.perf_counter()
        try:
            res = run_job(spark, out, bronze=testdata.bronze_tables(spark, sf_dir),
                          dedupe_order=testdata.DEDUPE_ORDER)
            job_sec = round(time.perf_counter() - t0, 3)
            stages = res.stage_seconds
        except Exception as e:  # noqa: BLE001 - reported in the JSON line
            errors["job"] = f"{type(e).__name__}: {str(e)[:300]}"

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold_value": round(sum(cold.values()), 3),
        "cold_queries": cold,
        "job_sec": job_sec,
        "job_stages": stages,
        "errors": errors,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
