"""The hourly Parquet table laid out by plan, and updated by its changed parts.

A plan's name picks one of ``parts`` directories (``plan_part``), whose rows
are sorted by plan, so a read of one plan opens one part and its row groups
are skipped by their statistics.  ``update_rates`` compares the plans with the
fingerprints of the last run and writes again only the parts that hold a new,
changed or removed plan.

``<path>/rates`` holds the hourly rows, ``<path>/plans`` a fingerprint a plan.
The fingerprints are deleted before any hourly row is replaced and written
after the last one, so a run that dies in between is followed by a full write.
One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import NAME_KEYS, PLAN_KEYS
from ..session import cut_lineage, landed
from . import nested

PARTS = 64
RATES = (
    "eiaId BIGINT, rateName STRING, utilityName STRING, fixedChargeFirstMeter DOUBLE, week_part STRING, month INT, "
    "hour INT, demand_period INT, total_demand_rate DOUBLE, multi_unit BOOLEAN, energy_period INT, "
    "total_energy_rate DOUBLE, plan_part INT"
)
FINGERPRINTS = "eiaId BIGINT, rateName STRING, utilityName STRING, parts INT, plan_part INT, fingerprint STRING"


def plan_part(parts: int, names: dict[str, Column] | None = None) -> Column:
    """The part of a plan's name; NULL names have one too."""
    names = names or {k: F.col(k) for k in NAME_KEYS}
    text = F.to_json(F.struct(*[names[k].alias(k) for k in NAME_KEYS]))
    return F.pmod(F.xxhash64(text), F.lit(parts)).cast("int")


def fingerprints(plan_cells: DataFrame, parts: int) -> DataFrame:
    """Per plan row: its keys, part, and a digest of everything that its hourly rows hold."""
    content = F.to_json(F.struct("fixedChargeFirstMeter", "cells"))
    return plan_cells.select(
        *PLAN_KEYS, F.lit(parts).alias("parts"), plan_part(parts).alias("plan_part"), F.sha2(content, 256).alias("fingerprint")
    )


def changed_parts(old: DataFrame, new: DataFrame) -> list[int]:
    """Parts whose plan rows, copies counted, differ; at most ``parts`` numbers come to the driver."""
    both = old.withColumn("n", F.lit(-1)).unionByName(new.withColumn("n", F.lit(1)))
    differ = both.groupBy(*new.columns).agg(F.sum("n").alias("n")).where("n != 0")
    return sorted(r["plan_part"] for r in differ.select("plan_part").distinct().collect())


def _path(spark: SparkSession, *names):
    return spark._jvm.org.apache.hadoop.fs.Path(*names)


def _delete(spark: SparkSession, path: str) -> None:
    p = _path(spark, path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _finished(spark: SparkSession, path: str) -> bool:
    done = _path(spark, path, "_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def update_rates(plan_cells: DataFrame, path: str, parts: int = PARTS) -> list[int]:
    """Bring the table at ``path`` to the hourly rows of ``plan_cells``; returns the parts written.

    ``plan_cells`` are all plan rows to be published, with their cells
    (``end_to_end.published_cells`` and ``nested.kept_plans``).  The first run,
    one with another number of parts and one after an unfinished run write
    everything.  A part without plans any more is removed.
    """
    spark = plan_cells.sparkSession
    rates, plans = f"{path}/rates", f"{path}/plans"
    rows = landed(plan_cells.withColumn("plan_part", plan_part(parts)))
    new = cut_lineage(fingerprints(rows, parts))
    stored = spark.read.schema(FINGERPRINTS).parquet(plans) if _finished(spark, plans) else None
    other = stored is None or stored.where(F.col("parts") != parts).first() is not None
    old = new.limit(0) if other else stored
    changed = changed_parts(old, new)
    if not changed and not other:
        return []
    _delete(spark, plans)
    if other:
        _delete(spark, rates)
    # rebalance: AQE splits a part with very many plans and joins small ones
    dealt = rows.where(F.col("plan_part").isin(changed)).hint("rebalance", "plan_part") if changed else rows.limit(0)
    hourly = nested.explode_cells(dealt).withColumn("plan_part", plan_part(parts))
    ordered = hourly.sortWithinPartitions("plan_part", *NAME_KEYS, "eiaId", "week_part", "month", "hour")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("plan_part").parquet(rates)
    filled = {r["plan_part"] for r in new.select("plan_part").distinct().collect()}
    for part in sorted(set(changed) - filled):
        _delete(spark, f"{rates}/plan_part={part}")
    new.write.mode("overwrite").parquet(plans)
    return changed


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """The hourly rows of a finished table."""
    if not _finished(spark, f"{path}/plans"):
        raise FileNotFoundError(f"{path}: no finished table")
    return spark.read.schema(RATES).parquet(f"{path}/rates").drop("plan_part")


def read_plan(spark: SparkSession, path: str, utility: str | None, name: str | None) -> DataFrame:
    """The hourly rows of one plan name: one part is listed, its row groups skipped by their statistics."""
    if not _finished(spark, f"{path}/plans"):
        raise FileNotFoundError(f"{path}: no finished table")
    first = spark.read.schema(FINGERPRINTS).parquet(f"{path}/plans").select("parts").first()
    parts = first["parts"] if first else 1
    wanted = {"utilityName": F.lit(utility).cast("string"), "rateName": F.lit(name).cast("string")}
    same = [F.col(k).eqNullSafe(wanted[k]) for k in NAME_KEYS]
    rows = spark.read.schema(RATES).parquet(f"{path}/rates").where(F.col("plan_part") == plan_part(parts, wanted))
    return rows.where(same[0] & same[1]).drop("plan_part")
