"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    (optional BENCH_EVENT_LOG_DIR=<folder> writes Spark's event log there)

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.

Stage 1 builds and cleans the plan records from the driver tables and lands
them as Parquet in the shared checkpoint folder (the survey's "land the
plan file once" step).  Every later query scans that Parquet, the way a
scheduled job would, and is forced to full execution with the ``noop``
sink, or a collect where the result has a fixed, small number of rows
(funnel, report, profile, trend).  What was landed is deleted at the end.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ratecraft.operators import profile, quality, validate  # noqa: E402
from ratecraft.plans import end_to_end, nested, relational  # noqa: E402
from ratecraft.session import build_session, cut_lineage, release_scratch, scratch_path  # noqa: E402
from ratecraft.sources import publish  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # optional: stage/task times without the UI
    if event_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(
        f"local[{cpus}]",
        app_name="ratecraft-bench",
        shuffle_partitions=max(8, 2 * cpus),
        extra=extra,
    )
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    landed = scratch_path(spark, "bench-plans")
    timed(
        "land_clean_plans",
        lambda: publish.land_plans(end_to_end.clean_table_plans(spark, sf_dir), landed),
    )
    plans = spark.read.parquet(landed)

    timed("utility_rates", lambda: noop(end_to_end.hourly_rates(plans)))
    timed("published_rates", lambda: noop(end_to_end.published_rates(plans)))
    timed("rates_json_rows", lambda: noop(end_to_end.rate_json_rows(plans)))
    by_name = timed("land_by_name", lambda: relational.co_located(plans))
    timed("levelized_energy", lambda: noop(relational.costs(by_name)["energy"]))
    timed("levelized_demand", lambda: noop(relational.costs(by_name)["demand"]))
    timed("filter_funnel", lambda: quality.filter_funnel_cells(nested.rate_cells(plans)).collect())

    def validation():
        # Validated plan rows are checkpointed once to the shared folder; the
        # report then reads them three times without recomputing the rates.
        cells = cut_lineage(nested.kept_plans(end_to_end.published_cells(plans, drop_negative=True)))
        return validate.validation_report_cells(plans, cells).collect()

    timed("validation_report", validation)
    timed("rates_profile", lambda: profile.rates_profile(end_to_end.published_rates(plans)).collect())
    timed(
        "monthly_hourly_energy",
        lambda: profile.monthly_hourly_energy(end_to_end.published_rates(plans)).collect(),
    )
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
