"""End-to-end entry points: plans in, hourly table / matrices / checks out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from ..sources import tpch
from ..session import landed
from . import nested, relational
from .relational import Load


def clean_plans(records: DataFrame, sector: str = "Commercial") -> DataFrame:
    return clean.clean_plans(records, sector=sector)


def clean_table_plans(spark: SparkSession, sf_dir: str, sector: str = "Commercial") -> DataFrame:
    """Cleaned plans of the driver tables; the payload is built for the plans that stay only, its schedules last."""
    records = tpch.plan_records(spark, sf_dir)
    return clean.clean_plans(
        records, sector, payload=lambda plans: tpch.plan_payload(spark, sf_dir, only=plans), finish=tpch.with_schedules
    )


def hourly_rates(plans: DataFrame, load: Load = Load()) -> DataFrame:
    """``utility_rates`` (unfiltered hourly table) via the nested path."""
    return nested.explode_cells(nested.rate_cells(plans, load.monthly_kwh, load.peak_kw))


def published_cells(plans: DataFrame, load: Load = Load(), drop_negative: bool = False) -> DataFrame:
    """Plan rows with a ``keep`` flag and their surviving hourly cells."""
    return nested.filter_plans(
        nested.rate_cells(plans, load.monthly_kwh, load.peak_kw), drop_negative=drop_negative
    )


def published_rates(plans: DataFrame, load: Load = Load(), drop_negative: bool = False) -> DataFrame:
    """Hourly table after the plan filters (what is written as Parquet)."""
    return nested.explode_cells(published_cells(plans, load, drop_negative))


def any_published_rates(plans: DataFrame, load: Load = Load(), drop_negative: bool = False) -> DataFrame:
    """``published_rates`` for landed plans that may have skipped K1.

    Where plans share a name, joins multiply rows and W4/W5 judge the whole
    name; the relational path does both.  Unique names (one narrow aggregate
    tells) take the path without shuffles, which then gives the same rows.
    """
    if nested.names_are_unique(plans):
        return published_rates(plans, load, drop_negative)
    return relational.published(landed(relational.utility_rates(plans, load)), drop_negative)


def rate_json_rows(plans: DataFrame, load: Load = Load(), drop_negative: bool = False) -> DataFrame:
    """One row per plan with four 12x24 matrices (the JSON document rows)."""
    return nested.rate_matrices(nested.kept_plans(published_cells(plans, load, drop_negative)))


def run_job(records: DataFrame, out_dir: str, load: Load = Load(), enforce: bool = True) -> dict:
    """The reference's whole target graph as one Spark job.

    Plans are cleaned and landed as Parquet; the published plan rows (after
    P13, P12, W4, P14) are computed once and landed in the shared
    folder; the hourly Parquet table and the JSON matrix rows are written
    from them; the validation report is computed on the rows that also pass
    W5 (what the reference validates), written, and only then enforced (V8).
    """
    from ..operators import validate
    from ..sources import publish

    spark = records.sparkSession
    paths = {
        "plans": f"{out_dir}/plans",
        "rates": f"{out_dir}/utility_rates",
        "json": f"{out_dir}/utility_rates_json",
        "report": f"{out_dir}/validation_report",
    }
    publish.land_plans(clean_plans(records), paths["plans"])
    plans = spark.read.parquet(paths["plans"])
    if not nested.names_are_unique(plans):
        raise ValueError("several plans share a name after K1: revision selection was skipped")
    published = landed(nested.kept_plans(published_cells(plans, load, drop_negative=False)))
    publish.write_rates_parquet(nested.explode_cells(published), paths["rates"])
    publish.write_rates_json(nested.rate_matrices(published), paths["json"])
    validated = published.where(
        F.expr(
            "forall(cells, c -> coalesce(c.total_energy_rate >= 0, true) "
            "AND coalesce(c.total_demand_rate >= 0, true))"
        )
    )
    report = validate.validation_report_cells(plans, validated)
    report.write.mode("overwrite").json(paths["report"])
    if enforce:
        validate.enforce(spark.read.json(paths["report"]))
    return paths
