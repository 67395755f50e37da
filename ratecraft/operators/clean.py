"""Plan-level cleaning, revision selection and defaults.

All operators are ``DataFrame -> DataFrame`` and chain with
``df.transform(op, **params)``.  Only K1/K2/K3 are wide; everything else is
a projection that Catalyst fuses into the scan's codegen stage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    any_instant,
    first_date,
    non_empty,
    null_safe_left_join,
    zero_matrix,
)
from ..constants import (
    BOUND_FILL,
    DAILY_UNIT,
    DAYS_PER_MONTH,
    DEFAULT_SECTOR,
    FIXED_CHARGE_FILL,
    LEGACY_SCHEDULE_FILL,
    MONTHLY_UNIT,
    SCHEDULE_FILL,
)
from ..schema import CLEAN_COLUMNS, NAME_KEYS, SCHEDULE_COLUMNS
from ..session import cut_lineage

BOUND_COLUMNS = ["demandMin", "demandMax", "energyMin", "energyMax"]
REQUIRED_FOR_IN_EFFECT = ["utilityName", "rateName", "effectiveDate_year", "endDate"]


# --- P1 -------------------------------------------------------------------
def sector_filter(df: DataFrame, sector: str = DEFAULT_SECTOR) -> DataFrame:
    """Keep one sector; NULL sector is dropped. Pushed into the scan."""
    return df.where(F.col("sector") == F.lit(sector))


# --- P2 -------------------------------------------------------------------
def parse_dates(df: DataFrame) -> DataFrame:
    """``effectiveDate`` / ``endDate`` JSON text -> UTC timestamp (bad -> NULL)."""
    return df.withColumns(
        {"effectiveDate": first_date("effectiveDate"), "endDate": first_date("endDate")}
    )


# --- K1 -------------------------------------------------------------------
def newest_revision(revisions: str = "revisions") -> Column:
    """The newest of a record's revision dates, in any orderable spelling."""
    return F.array_max(F.transform(revisions, lambda r: any_instant(r["date"])))


def revision_dates_report(df: DataFrame) -> DataFrame:
    """One row: records, those that K1 drops for having no revision date, and
    those that it drops because none of their dates can be read."""
    present = F.coalesce(F.exists("revisions", lambda r: F.trim(r["date"]) != ""), F.lit(False))
    dated = newest_revision().isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(~present, 1)).alias("without_date"),
        F.count(F.when(present & ~dated, 1)).alias("unreadable_date"),
    )


def latest_revision(
    df: DataFrame,
    keys: Sequence[str] = tuple(NAME_KEYS),
    tie_break: Sequence[Column] | None = None,
) -> DataFrame:
    """One record per ``keys`` with the newest revision date.

    ``revision_date`` is the newest parseable date of the record's
    ``revisions`` (computed inside the row, no explode); records without
    one are dropped.  Ties go to the smallest ``label`` (the record id),
    then to a content hash, so any input order or partitioning gives the
    same winner (records equal in every flat column, label included, are
    treated as copies).  ``row_number() = 1`` is planned as a WindowGroupLimit
    that keeps one row per key *before* the shuffle, so a hot key costs one
    row per input partition.
    """
    dated = df.withColumn("revision_date", newest_revision()).where(F.col("revision_date").isNotNull())
    if tie_break is None:
        full_hash = F.xxhash64(*[F.col(c) for c in df.columns])
        if "label" in df.columns:
            # The label is the record id.  Same-label duplicates are ordered by
            # a hash of the flat columns; the (costly) hash over the nested
            # arrays is only evaluated for records without a label.
            flat = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
            tie_break = [
                F.col("label").asc_nulls_last(),
                F.xxhash64(*[F.col(c) for c in flat]).asc(),
                F.when(F.col("label").isNull(), full_hash).asc(),
            ]
        else:
            tie_break = [full_hash.asc()]
    w = Window.partitionBy(*keys).orderBy(F.col("revision_date").desc(), *tie_break)
    return (
        dated.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


# --- K3 (legacy) ----------------------------------------------------------
def latest_per_utility(
    df: DataFrame, key: str = "utilityName", date_col: str = "revision_date"
) -> DataFrame:
    """All rows having the newest date per ``key`` (ties kept, NULL dates dropped).

    Aggregate-then-join instead of a rank window: the max is combined
    map-side, and AQE broadcasts the per-key result or splits a skewed key.
    """
    valid = df.where(F.col(date_col).isNotNull())
    newest = valid.groupBy(key).agg(F.max(date_col).alias("_newest"))
    return (
        null_safe_left_join(valid, newest, [key], how="inner")
        .where(F.col(date_col) == F.col("_newest"))
        .drop("_newest")
    )


# --- P3 / P11 -------------------------------------------------------------
def with_date_parts(df: DataFrame) -> DataFrame:
    """Year/month parts of the three dates, beside the other columns."""
    return df.withColumns(
        {
            "revision_year": F.year("revision_date"),
            "effectiveDate_year": F.year("effectiveDate"),
            "effectiveDate_month": F.month("effectiveDate"),
            "endDate_year": F.year("endDate"),
            "endDate_month": F.month("endDate"),
        }
    )


def date_parts(df: DataFrame) -> DataFrame:
    """Year/month parts of the three dates and the 29-column projection."""
    return with_date_parts(df).select(*CLEAN_COLUMNS)


def end_date_as_date(df: DataFrame) -> DataFrame:
    return df.withColumn("endDate", F.to_date("endDate"))


# --- P10 ------------------------------------------------------------------
def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError("plans_in_effect needs these columns, which the input lacks: " + ", ".join(missing))
    return df


# --- K2 -------------------------------------------------------------------
def newest_years(df: DataFrame, keys: Sequence[str] = ("eiaId", "utilityName")) -> DataFrame:
    """Newest ``revision_year`` per group (map-side combined aggregate)."""
    return df.groupBy(*keys).agg(F.max("revision_year").alias("_newest"))


def plans_as_of(df: DataFrame, day: str, keys: Sequence[str] = ("utilityName", "rateName")) -> DataFrame:
    """Per plan the version in effect on a day (``yyyy-mm-dd``), from versions with parsed dates.

    A version is in effect from its effective date on (NULL: ever since) until
    before its end date (NULL: open).  Of several, one with an open end comes first, then the
    latest effective date, then the smallest label.  The day is a parameter, so a
    rerun gives the same rows.  ``row_number() = 1`` is limited within each input
    partition before the shuffle, so a hot plan costs one row per partition.
    """
    require_columns(df, ["effectiveDate", "endDate", "label", *keys])
    on = F.lit(day).cast("date")
    began = F.col("effectiveDate").isNull() | (F.to_date("effectiveDate") <= on)
    lasts = F.col("endDate").isNull() | (F.to_date("endDate") > on)
    first = Window.partitionBy(*keys).orderBy(F.col("endDate").isNull().desc(), F.col("effectiveDate").desc_nulls_last(), "label")
    return df.where(began & lasts).withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def plans_in_effect(
    df: DataFrame,
    keys: Sequence[str] = ("eiaId", "utilityName"),
) -> DataFrame:
    """Per (eiaId, utilityName) keep every row of the newest revision year.

    NULL keys form their own group.  The group maximum is a map-side
    combined aggregate joined back on ``<=>`` keys (AQE: broadcast when
    small, skew split otherwise), so a hot utility never lands in one task.
    The input is read twice; pass a landed or checkpointed table.
    """
    require_columns(df, REQUIRED_FOR_IN_EFFECT)
    df = end_date_as_date(df)
    newest = newest_years(df, keys)
    return (
        null_safe_left_join(df, newest, list(keys), how="inner")
        .where(F.col("revision_year").eqNullSafe(F.col("_newest")))
        .drop("_newest")
        .select(*df.columns)
    )


# --- P4 -------------------------------------------------------------------
def fill_bounds(df: DataFrame, fill: float = BOUND_FILL) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(fill)) for c in BOUND_COLUMNS})


# --- P5 -------------------------------------------------------------------
def fill_fixed_charge(df: DataFrame, unit: str = MONTHLY_UNIT) -> DataFrame:
    return df.withColumns(
        {
            "fixedChargeFirstMeter": F.coalesce(F.col("fixedChargeFirstMeter"), F.lit(FIXED_CHARGE_FILL)),
            "fixedChargeUnits": F.coalesce(F.col("fixedChargeUnits"), F.lit(unit)),
        }
    )


# --- P6 -------------------------------------------------------------------
def daily_to_monthly(df: DataFrame, days_per_month: float = DAYS_PER_MONTH) -> DataFrame:
    daily = F.col("fixedChargeUnits") == F.lit(DAILY_UNIT)
    return df.withColumns(
        {
            "fixedChargeFirstMeter": F.when(
                daily, F.col("fixedChargeFirstMeter") * F.lit(days_per_month)
            ).otherwise(F.col("fixedChargeFirstMeter")),
            "fixedChargeUnits": F.when(daily, F.lit(MONTHLY_UNIT)).otherwise(
                F.col("fixedChargeUnits")
            ),
        }
    )


# --- P8 -------------------------------------------------------------------
def empty_to_null(df: DataFrame) -> DataFrame:
    """Zero-length array entries become NULL in every array column."""
    arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    return df.withColumns({c: non_empty(c) for c in arrays})


# --- P9 -------------------------------------------------------------------
def default_schedule(df: DataFrame, fill: int = SCHEDULE_FILL) -> DataFrame:
    """Missing 12x24 schedules become a matrix of ``fill`` (flat months untouched)."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), zero_matrix(fill=fill)) for c in SCHEDULE_COLUMNS if c in df.columns}
    )


# --- S5 (legacy defaulting of missing structures) --------------------------
def default_structures(df: DataFrame, fill: int = LEGACY_SCHEDULE_FILL) -> DataFrame:
    """Missing schedules -> 12x24 of ``fill``; months -> 12 x ``fill``;
    missing structures -> one period with one tier of rate 0."""

    def one_tier(field: str, strux_type) -> Column:
        tier_type = strux_type.elementType[field].dataType.elementType
        tier = F.struct(
            *[
                (F.lit(0.0) if f.name == "rate" else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in tier_type.fields
            ]
        )
        return F.array(F.struct(F.array(tier).alias(field)))

    types = {f.name: f.dataType for f in df.schema.fields}
    out = {c: F.coalesce(F.col(c), zero_matrix(fill=fill)) for c in SCHEDULE_COLUMNS}
    out["flatDemandMonths"] = F.coalesce(
        F.col("flatDemandMonths"), F.array_repeat(F.lit(fill).cast("int"), 12)
    )
    for col, field in (
        ("demandRateStrux", "demandRateTiers"),
        ("energyRateStrux", "energyRateTiers"),
        ("flatDemandStrux", "flatDemandTiers"),
    ):
        out[col] = F.coalesce(F.col(col), one_tier(field, types[col]))
    return df.withColumns(out)


# --- P17 ------------------------------------------------------------------
def current_plans(
    flat: DataFrame, sector: str = DEFAULT_SECTOR, tie_break: Sequence[Column] | None = None
) -> DataFrame:
    """P1, P2, K1, P3 and K2 on the narrow columns of the records.

    The winners of K1 are written to the shared folder (a few hundred bytes
    a plan), so the group maximum of K2 and the plans themselves come from
    one K1 pass.
    """
    dated = flat.transform(sector_filter, sector=sector).transform(parse_dates)
    winners = cut_lineage(latest_revision(dated, tie_break=tie_break))
    return with_date_parts(winners.drop("revisions")).transform(plans_in_effect)


def _nested_and_flat(df: DataFrame) -> tuple[list[str], list[str]]:
    nested = [
        f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct") and f.name != "revisions"
    ]
    return nested, [c for c in df.columns if c not in nested]


def _with_nested(plans: DataFrame, records: DataFrame, sector: str) -> DataFrame:
    """The plans with the nested columns of their records, met by the label and the hash
    of the flat columns; of equal records the one with the smallest hash of its nested columns."""
    nested, flat = _nested_and_flat(records)
    rows = records.transform(sector_filter, sector=sector).select(
        F.col("label").alias("_label"), F.xxhash64(*flat).alias("_rec"), *nested
    )
    same = plans["label"].eqNullSafe(rows["_label"]) & (plans["_record"] == rows["_rec"])
    w = Window.partitionBy("_record", "label").orderBy(F.xxhash64(*nested))
    # merged: both sides grow with the plans, and a broadcast is built in the driver
    return plans.hint("merge").join(rows, same).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")


def whole_plans_in_effect(
    df: DataFrame, records_of: Callable[[DataFrame], DataFrame], sector: str = DEFAULT_SECTOR
) -> DataFrame:
    """P1, P2, K1, P3 and K2 with every column of the plans, as the chain of these
    operators gives it on whole records.

    K1 and K2 run on the flat columns, which decide alone; ``records_of`` builds
    the whole records (any number a label) of given plans by their ``label``.
    So no nested column of a record that goes is shuffled or sorted.
    """
    _, flat = _nested_and_flat(df)
    scalar = [c for c in flat if c != "revisions"]
    # the order of K1 on whole records, where there is no ``_record``
    ties = [F.col("label").asc_nulls_last(), F.xxhash64(*scalar).asc()]
    plans = current_plans(df.select(*flat, F.xxhash64(*flat).alias("_record")), sector, ties)
    return _with_nested(plans, records_of(plans), sector).select(*CLEAN_COLUMNS)


def clean_plans(
    df: DataFrame,
    sector: str = DEFAULT_SECTOR,
    payload: Callable[[DataFrame], DataFrame] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Sector filter, dates, newest revision, date parts, plans in effect,
    bounds, fixed charges, daily->monthly, empty->NULL, default schedules.

    Which records stay is decided by the flat columns alone (the nested
    columns only order records whose flat columns are all equal), so the
    nested payload is fetched afterwards, for the plans that stay.  A source
    that can build it for given records passes ``payload``: from the plans
    (``label`` is their record id) to rows of ``label`` and nested columns,
    one per label.  Nested columns that follow from a few values of these
    rows are added by ``finish``, after the join, which then neither shuffles
    nor sorts them.  Otherwise the payload is joined from ``df`` by the label and a
    hash of the flat columns, and of records equal in all of these the one
    with the smallest hash of its nested columns stays.
    """
    nested, flat = _nested_and_flat(df)
    plans = current_plans(df.select(*flat, F.xxhash64(*flat).alias("_record")), sector)
    if payload is not None:
        # merged: both sides grow with the plans, and a broadcast is built in the driver
        rows = payload(plans)
        rows = rows if finish else rows.select("label", *nested)
        full = plans.hint("merge").join(rows, "label")
        full = finish(full) if finish else full
    else:
        full = _with_nested(plans, df, sector)
    return (
        full.select(*CLEAN_COLUMNS)
        .transform(fill_bounds)
        .transform(fill_fixed_charge)
        .transform(daily_to_monthly)
        .transform(empty_to_null)
        .transform(default_schedule)
    )
