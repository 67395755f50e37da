"""Plan records as JSON lines, in compressed parts of bounded size."""

import glob

from ratecraft.plans import catalog
from ratecraft.sources import publish, tpch

from .test_whole_plans import write_tables


def test_plans_are_written_compressed_in_bounded_parts(spark, tmp_path):
    sf, out = str(tmp_path), str(tmp_path / "json")
    write_tables(spark, sf)
    records = tpch.plan_records(spark, sf)
    publish.write_plans_json(records.coalesce(1), out, records_per_file=50)
    parts = glob.glob(f"{out}/part-*")
    assert len(parts) == 5 and all(p.endswith(".json.gz") for p in parts)
    back = publish.read_plans(spark, out)
    keep = ["label", "rateName", "energyWeekdaySched", "energyRateStrux", "flatDemandMonths"]
    text = lambda df: sorted(repr(r) for r in df.select(*keep).collect())
    assert back.count() == records.count() and text(back) == text(records)
    catalog.q_scan_plans(spark, sf)
    assert glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/plans-json-*/part-*.json.gz")
