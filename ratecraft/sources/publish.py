"""Sources and sinks: plan JSON scan, Parquet and JSON publication.

* S1: the tolerant JSON scan is in ``sources.plans``; records are landed
  once as Parquet (``land_plans``) and every later job scans the Parquet.
* S2/S4: outputs are written by the executors in parallel; nothing is
  collected on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import JSON_DECIMALS, WEEKDAY, WEEKEND
from ..session import landed
from .plans import read_plans  # noqa: F401  (part of this module's interface)


# --- S1 -------------------------------------------------------------------
def land_plans(records: DataFrame, path: str, mode: str = "overwrite") -> str:
    records.write.mode(mode).parquet(path)
    return path


def write_plans_json(records: DataFrame, path: str, records_per_file: int = 20000) -> str:
    """The records as JSON lines, compressed; a compressed file is one task's, so its records are bounded."""
    records.write.option("compression", "gzip").option("maxRecordsPerFile", records_per_file).json(path)
    return path


# --- S2 / S3 --------------------------------------------------------------
def write_rates_parquet(rates: DataFrame, path: str, mode: str = "overwrite") -> str:
    rates.write.mode(mode).parquet(path)
    return path


def read_rates_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- R1 / R2 ----------------------------------------------------------------
def grid_matrix_sql(cells: str, field: str) -> str:
    """SQL for a 12x24 matrix from ``cells``: array<struct<k: month*100+hour, v>>
    sorted by ``k``; a missing cell or NULL value gives 0.

    When the cells form the complete grid (the normal case) they are read
    by position; only a ragged grid falls back to map lookups, which Spark
    performs by linear scan.
    """
    complete = (
        f"(size({cells}) = 288 AND forall(zip_with({cells}, sequence(0, 287), "
        f"(e, i) -> e.k = (i div 24 + 1) * 100 + i % 24 + 1), b -> b))"
    )
    by_position = (
        f"transform(sequence(0, 11), m -> transform(sequence(0, 23), h -> "
        f"coalesce(get({cells}, m * 24 + h).v.{field}, 0D)))"
    )
    by_key = (
        f"transform(array(map_from_entries({cells})), mp -> transform(sequence(1, 12), m -> "
        f"transform(sequence(1, 24), h -> coalesce(try_element_at(mp, m * 100 + h).{field}, 0D))))[0]"
    )
    return f"IF({complete}, {by_position}, {by_key})"


# --- R1 / R2 (relational form) --------------------------------------------
#: The place of an hourly row among the 576 slots of a plan; a row off the grid has none.
SLOT = f"""
CASE WHEN month BETWEEN 1 AND 12 AND hour BETWEEN 1 AND 24 THEN CASE week_part
  WHEN '{WEEKDAY}' THEN CAST(month * 24 + hour - 25 AS INT) WHEN '{WEEKEND}' THEN CAST(month * 24 + hour + 263 AS INT) END END
"""


def nested_rates(rates: DataFrame) -> DataFrame:
    """Hourly long table -> one row per plan with four 12x24 matrices.

    A plan has few distinct pairs of rates, so its hours become bitmaps: one row
    per (plan, pair), whose bits are the slots that have the pair.  They are
    combined map-side under ``bit_or``, which removes duplicated rows; no hourly row
    is shuffled or sorted.  A slot with several pairs keeps the smallest.
    Missing cells and NULL rates become 0.
    """
    plan = ["eiaId", "rateName", "utilityName", "fixedChargeFirstMeter"]
    pair = ["total_demand_rate", "total_energy_rate"]
    words = [F.bit_or(F.expr(f"IF(_slot >> 6 = {w}, shiftleft(1L, _slot & 63), 0L)")).alias(f"w{w}") for w in range(9)]
    bitmaps = rates.select(*plan, *pair, F.expr(SLOT).alias("_slot")).groupBy(*plan, *pair).agg(*words)
    entry = F.struct(*pair, F.array(*[f"w{w}" for w in range(9)]).alias("bits"))
    keyed = bitmaps.groupBy(*plan).agg(F.array_sort(F.collect_list(entry)).alias("_pairs"))
    # a word of 64 slots looks at the pairs that occur in it
    of_word = "transform(sequence(0, 63), b -> get(filter(found, x -> getbit(get(x.bits, w), b) = 1), 0))"
    in_word = f"transform(array(filter(_pairs, x -> get(x.bits, w) != 0L)), found -> {of_word})[0]"
    slots = keyed.withColumn("_slots", F.expr(f"flatten(transform(sequence(0, 8), w -> {in_word}))"))

    def matrix(start: int, field: str):
        return F.expr(
            f"transform(sequence(0, 11), m -> transform(sequence(0, 23), h -> "
            f"coalesce(get(_slots, {start} + m * 24 + h).{field}, 0D)))"
        )

    return slots.select(
        F.col("eiaId").alias("eiaid"),
        F.col("rateName").alias("name"),
        F.col("utilityName").alias("utility"),
        F.col("fixedChargeFirstMeter").alias("fixedchargefirstmeter"),
        matrix(0, "total_demand_rate").alias("totaldemandweekdayschedule"),
        matrix(288, "total_demand_rate").alias("totaldemandweekendschedule"),
        matrix(0, "total_energy_rate").alias("energyweekdayschedule"),
        matrix(288, "total_energy_rate").alias("energyweekendschedule"),
    )


MATRIX_COLUMNS = [
    "totaldemandweekdayschedule",
    "totaldemandweekendschedule",
    "energyweekdayschedule",
    "energyweekendschedule",
]


def matrices_to_long(df: DataFrame) -> DataFrame:
    """Inverse of the nesting: (plan, week_part, month, hour, demand, energy)."""

    def cells(demand: str, energy: str, label: str):
        return F.expr(
            f"flatten(transform(sequence(1, 12), m -> transform(sequence(1, 24), h -> named_struct("
            f"'week_part', '{label}', 'month', m, 'hour', h, "
            f"'total_demand_rate', get(get({demand}, m - 1), h - 1), "
            f"'total_energy_rate', get(get({energy}, m - 1), h - 1)))))"
        )

    both = F.concat(
        cells("totaldemandweekdayschedule", "energyweekdayschedule", WEEKDAY),
        cells("totaldemandweekendschedule", "energyweekendschedule", WEEKEND),
    )
    return df.select("eiaid", "name", "utility", "fixedchargefirstmeter", F.inline(both))


# --- S4 -------------------------------------------------------------------
def round_numbers(df: DataFrame, decimals: int = JSON_DECIMALS) -> DataFrame:
    """Every number of the document rounded: the fixed charge and the matrices."""
    matrices = {
        c: F.transform(c, lambda row: F.transform(row, lambda x: F.round(x, decimals)))
        for c in MATRIX_COLUMNS
    }
    return df.withColumns({"fixedchargefirstmeter": F.round("fixedchargefirstmeter", decimals)} | matrices)


def write_rates_json(matrices: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines, one plan document per line; NULL fields are omitted."""
    round_numbers(matrices).write.mode(mode).json(path)
    return path


RATES_JSON = (
    "eiaid BIGINT, name STRING, utility STRING, fixedchargefirstmeter DOUBLE, "
    + ", ".join(f"{c} ARRAY<ARRAY<DOUBLE>>" for c in MATRIX_COLUMNS)
)


def read_rates_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RATES_JSON).json(path)


# --- S4 as one document -----------------------------------------------------
DOCUMENT_ORDER = ["utility", "name", "eiaid"]
#: Sorts after every numbered part.
CLOSING_PART = "part-end.txt"


def write_rates_document(matrices: DataFrame, path: str, order: Sequence[str] = DOCUMENT_ORDER) -> str:
    """All plans as one JSON array, written in parallel as ordered parts.

    The parts' texts one after the other, in the order of their names, are the
    document; the plans follow ``order``, ties by their own text.  Every record
    is a line that begins with its separator: ``[`` for the first record (the
    first row of the range partition 0, which isn't empty if there are rows),
    else ``,``.  The commit step adds the closing part, and only then
    ``_DOCUMENT``, whose absence marks an unfinished document.  The driver
    writes these few bytes alone.  Existing output is replaced.  NULL fields are
    omitted, as in the JSON lines; no plans give ``[]``.
    """
    spark = matrices.sparkSession
    # landed: the bounds of the ranges are sampled from all rows, which would be computed twice
    texts = landed(round_numbers(matrices).select(*order, F.to_json(F.struct(*matrices.columns)).alias("_text")))
    ordered = texts.orderBy(*[F.col(c).asc_nulls_first() for c in order], "_text")
    first = F.monotonically_increasing_id() == 0
    # one file a partition, so that a part's number is its place
    ordered.select(F.concat(F.when(first, "[").otherwise(","), "_text").alias("value")).write.mode("overwrite").option(
        "maxRecordsPerFile", 0
    ).text(path)
    _close_document(spark, path)
    return path


def _close_document(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    sizes = {s.getPath().getName(): s.getLen() for s in fs.listStatus(folder)}
    filled = sorted(n for n, size in sizes.items() if n.startswith("part-") and size > 0)
    if any(len(n.split("-")[1]) != 5 for n in filled):
        raise ValueError("more than 100,000 parts: their names no longer sort by number")
    if filled:
        head = fs.open(jvm.org.apache.hadoop.fs.Path(folder, filled[0]))
        begins = chr(head.read())
        head.close()
        if begins != "[":
            raise RuntimeError(f"{path}: the first part doesn't open the array")
    for name, text in ((CLOSING_PART, "]\n" if filled else "[]\n"), ("_DOCUMENT", "")):
        out = fs.create(jvm.org.apache.hadoop.fs.Path(folder, name), True)
        out.write(bytearray(text.encode()))
        out.close()


def read_rates_document(spark: SparkSession, path: str) -> DataFrame:
    """The plans of a finished document, a record a line; raises if it was not finished."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_DOCUMENT")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        raise FileNotFoundError(f"{path}: no finished document")
    record = F.from_json(F.substring("value", 2, 1 << 30), RATES_JSON, {"mode": "FAILFAST"})
    return spark.read.text(path).where(F.substring("value", 2, 1) == "{").select(record.alias("r")).select("r.*")
