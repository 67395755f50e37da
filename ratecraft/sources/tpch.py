"""Rate-plan records derived from the driver's star-schema tables.

The engine consumes nested plan records (``schema.PLAN_SCHEMA``).  To run
every operator on data whose volume grows with the given tables, one plan
record is derived per order:

* a customer is a *plan* (``utilityName`` = market segment, ``rateName`` =
  customer name plus a tag), every order of the customer is one *version*
  of that plan, dated by the order date;
* the order's lineitems are the price *tiers*: line status F/O selects
  energy/demand period 1/2, even/odd line number selects flat-demand
  period 0/1; tiers are ordered by line number (ties by part, supplier,
  quantity, price);
* schedules and flat-demand months are 12x24 / 12 patterns of the
  customer key.

The mapping deliberately produces every edge case the operators must
handle: missing or empty arrays, NULL ids and units, unparseable dates,
non-increasing caps, negative adjusted rates, mixed units and schedule
periods without a structure.  The same definitions are restated in plain
SQL in ``oracle/sql.py``.

Scale: one shuffle of ``lineitem`` by order key builds the tier arrays
(the array of one order is bounded by that order's lines).  ``customer``
joins ``orders`` with its flat columns alone.  The schedules, some kilobytes a
customer, are added to the joined records: before the join they would be in
what is shuffled, and in what a broadcast sends through the driver, whose size
Spark estimates from the files, where no schedule is stored.  A list of wanted
labels grows with the plans; it is merged with orders and lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PLAN_SCHEMA
from ..functions.columns import INSTANT_PATTERN

# Fixed values of the mapping (restated verbatim in oracle/sql.py).
IRRIGATION_TAG = " Irrigation Pumping"
CATFISH_TAG = " CATFISH farm"
GENERAL_TAG = " General"


def _iso(ts: Column) -> Column:
    return F.date_format(ts, INSTANT_PATTERN)


def _matrix(key: Column, weight: int, block: int) -> Column:
    """12x24 matrix: period0 = (key + month0*weight + hour0 div block) mod 2.

    The mapping knows the key modulo 2 only, so the matrix is one of two constants.
    """

    def of(parity: int) -> Column:
        rows = [[(parity + m * weight + h // block) % 2 for h in range(24)] for m in range(12)]
        return F.expr(f"array({', '.join('array' + str(tuple(row)) for row in rows)})")

    return F.when(F.pmod(key, F.lit(2)) == 0, of(0)).otherwise(of(1))


def _months(key: Column) -> Column:
    """12-vector: period = (key + month) mod 2, one of two constants."""
    even, odd = (F.expr(f"array{tuple((parity + m) % 2 for m in range(1, 13))}") for parity in (0, 1))
    return F.when(F.pmod(key, F.lit(2)) == 0, even).otherwise(odd)


def _periods(first: Column, second: Column, field: str) -> Column:
    """Periods array from the tiers of period 1 and 2 (either may be empty)."""
    return (
        F.when(
            F.size(second) > 0,
            F.array(
                F.struct(F.when(F.size(first) > 0, first).alias(field)),
                F.struct(second.alias(field)),
            ),
        )
        .when(F.size(first) > 0, F.array(F.struct(first.alias(field))))
    )


def tier_arrays(lineitem: DataFrame) -> DataFrame:
    """Per order: the sorted tier lists of each period (one shuffle)."""
    line = lineitem.select(
        "l_orderkey",
        F.struct(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
        ).alias("k"),
        F.col("l_linestatus").alias("ls"),
        (F.col("l_linenumber") % 2 == 0).alias("even"),
        (F.col("l_tax") + F.lit(0.0)).alias("rate"),
        F.expr("nullif(l_discount - 0.05, 0.0)").alias("adj"),
        F.expr(
            "CASE l_linenumber WHEN 7 THEN CAST(NULL AS DOUBLE) WHEN 6 THEN -1.0 "
            "ELSE 20 * l_quantity END"
        ).alias("max"),
        F.expr(
            "CASE WHEN l_returnflag = 'R' THEN CAST(NULL AS STRING) "
            "WHEN l_orderkey % 10 = 0 THEN 'kWh/kW' "
            "WHEN l_orderkey % 10 = 1 THEN 'kWh/hp' "
            "WHEN l_orderkey % 10 = 2 THEN 'kWh/kVA' "
            "WHEN l_orderkey % 10 = 3 AND l_linenumber = 3 THEN 'kWh/kW' "
            "ELSE 'kWh' END"
        ).alias("unit"),
        F.col("l_extendedprice").alias("sell"),
    )
    lines = F.sort_array(F.collect_list(F.struct(*line.columns[1:])))
    per_order = line.groupBy("l_orderkey").agg(lines.alias("lines"))

    def pick(pred, energy: bool) -> Column:
        kept = F.filter("lines", pred)
        if energy:
            return F.transform(
                kept, lambda x: F.struct(x.rate.alias("rate"), x.adj.alias("adj"), x["max"].alias("max"),
                                         x.unit.alias("unit"), x.sell.alias("sell"))
            )
        return F.transform(
            kept, lambda x: F.struct(x.rate.alias("rate"), x.adj.alias("adj"), x["max"].alias("max"))
        )

    is_f = lambda x: x.ls == "F"
    is_o = lambda x: x.ls == "O"
    is_even = lambda x: x.even
    is_odd = lambda x: ~x.even
    picked = per_order.select(
        "l_orderkey",
        pick(is_f, True).alias("ef"),
        pick(is_o, True).alias("eo"),
        pick(is_f, False).alias("df"),
        pick(is_o, False).alias("do"),
        pick(is_even, False).alias("fe"),
        pick(is_odd, False).alias("fo"),
    )
    return picked.select(
        "l_orderkey",
        _periods(F.col("ef"), F.col("eo"), "energyRateTiers").alias("energyRateStrux"),
        _periods(F.col("df"), F.col("do"), "demandRateTiers").alias("demandRateStrux"),
        _periods(F.col("fe"), F.col("fo"), "flatDemandTiers").alias("flatDemandStrux"),
    )


def _schedules(key: Column) -> dict[str, Column]:
    """The schedules and flat-demand months of a customer key."""
    missing_sched = key % 29 == 0
    return {
        "flatDemandMonths": F.when(key % 19 == 0, F.lit(None))
        .when(key % 37 == 0, F.array().cast("array<int>"))
        .otherwise(_months(key)),
        "demandWeekdaySched": F.when(~missing_sched, _matrix(key, 1, 1)),
        "demandWeekendSched": F.when(~missing_sched & (key % 31 != 0), _matrix(key, 2, 1)),
        "energyWeekdaySched": F.when(missing_sched, F.lit(None))
        .when(key % 41 == 0, F.array().cast("array<array<int>>"))
        .otherwise(_matrix(key, 1, 6)),
        "energyWeekendSched": F.when(~missing_sched, _matrix(key, 2, 6)),
    }


def _label() -> Column:
    return F.format_string("%012d", F.col("o_orderkey"))


def _order_rows(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """Orders with their customer and tier arrays; ``only``: those of these labels."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if only is not None:
        # the label of a NULL order key is no number; merged for the same reason as the customers below
        wanted = only.select(F.col("label").try_cast("long").alias("_wanted")).hint("merge")
        orders = orders.join(wanted, F.col("o_orderkey").eqNullSafe(F.col("_wanted")), "left_semi")
        lineitem = lineitem.join(wanted, F.col("l_orderkey") == F.col("_wanted"), "left_semi")

    # merged: a broadcast chosen by the size of compressed files is many times as large in the driver
    co = orders.join(customer.hint("merge"), orders.o_custkey == customer.c_custkey, "inner")
    tiers = tier_arrays(lineitem)
    return co.join(tiers, co.o_orderkey == tiers.l_orderkey, "left")


def plan_payload(spark: SparkSession, sf_dir: str, only: DataFrame) -> DataFrame:
    """``label``, customer key and tier structures of the records of ``only``; ``with_schedules`` adds the rest."""
    rows = _order_rows(spark, sf_dir, only)
    return rows.select(_label().alias("label"), "c_custkey", "energyRateStrux", "demandRateStrux", "flatDemandStrux")


def with_schedules(payload: DataFrame) -> DataFrame:
    """The schedules of the rows of ``plan_payload``: after the join with the plans, so it neither shuffles nor sorts them."""
    return payload.withColumns(_schedules(F.col("c_custkey")))


def plan_records(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """One nested plan record per order, in ``PLAN_SCHEMA``.

    ``only`` (rows with a ``label``) builds the records of these labels:
    orders and lineitems are restricted before anything is grouped or joined.
    """
    rec = _order_rows(spark, sf_dir, only)
    key = F.col("c_custkey")
    ok = F.col("o_orderkey")
    iso = _iso(F.col("o_orderdate"))
    date_json = lambda s: F.concat(F.lit('{"$date": "'), s, F.lit('"}'))

    cols = {
        "label": _label(),
        "eiaId": F.expr("nullif(c_nationkey, 0)"),
        "utilityName": F.col("c_mktsegment"),
        "rateName": F.concat(
            F.col("c_name"),
            F.when(key % 17 == 0, F.lit(IRRIGATION_TAG))
            .when(key % 23 == 0, F.lit(CATFISH_TAG))
            .otherwise(F.lit(GENERAL_TAG)),
        ),
        "sector": F.when(ok % 97 == 0, F.lit(None))
        .when((F.col("o_orderstatus") == "P") & (ok % 5 == 0), F.lit("Residential"))
        .otherwise(F.lit("Commercial")),
        "revisions": F.when(ok % 11 == 0, F.array(F.struct(F.lit(None).cast("string").alias("date"))))
        .when(
            ok % 13 == 0,
            F.array(
                F.struct(_iso(F.col("o_orderdate") - F.expr("INTERVAL 400 DAYS")).alias("date")),
                F.struct(iso.alias("date")),
            ),
        )
        .otherwise(F.array(F.struct(iso.alias("date")))),
        "effectiveDate": F.when(ok % 7 == 1, F.concat(F.lit('{"$date": ["'), iso, F.lit('"]}')))
        .when(ok % 7 == 2, F.lit('{"$date": []}'))
        .when(ok % 7 == 3, F.lit(None))
        .when(ok % 7 == 4, date_json(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'.000Z'")))
        .otherwise(date_json(iso)),
        "endDate": F.when(
            ok % 3 == 0, date_json(_iso(F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")))
        ),
        "demandMin": F.when(ok % 4 != 0, F.col("o_totalprice") / 10000),
        "demandMax": F.when(ok % 5 != 0, F.col("o_totalprice") / 1000),
        "energyMin": F.when(ok % 6 != 0, F.lit(0.0)),
        "energyMax": F.when(ok % 8 != 0, F.col("o_totalprice")),
        "fixedChargeFirstMeter": F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")),
        "fixedChargeUnits": F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("$/day"))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
        .otherwise(F.lit("$/month")),
        "flatDemandUnits": F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("kVA"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
        .otherwise(F.lit("kW")),
        "demandRateUnits": F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("kW"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("hp"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("kVA"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("daily")),
        "demandUnits": F.lit("kW"),
        "flatDemandStrux": F.col("flatDemandStrux"),
        "demandRateStrux": F.col("demandRateStrux"),
        "energyRateStrux": F.col("energyRateStrux"),
        **_schedules(key),
    }
    raw = rec.select(*[cols[f.name].alias(f.name) for f in PLAN_SCHEMA.fields])
    # Cast only where the type differs beyond nullability: a cast between
    # nested types that differ only in nullability copies every element.
    return raw.select(
        *[
            F.col(f.name)
            if raw.schema[f.name].dataType.simpleString() == f.dataType.simpleString()
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in PLAN_SCHEMA.fields
        ]
    )
