"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

from .sql import DIGEST_JOIN, digests, q

RATE_COLS = (
    "eiaId, rateName, utilityName, round(fixedChargeFirstMeter, 6) AS fixedChargeFirstMeter, "
    "week_part, month, hour, demand_period, round(total_demand_rate, 6) AS total_demand_rate, "
    "multi_unit, energy_period, round(total_energy_rate, 6) AS total_energy_rate"
)
MONTHS = "CASE WHEN r.ckey % 19 = 0 THEN {null} WHEN r.ckey % 37 = 0 THEN {empty} ELSE m.months END"


def _group_drop(src: str, cond: str) -> str:
    return (
        f"SELECT {RATE_COLS} FROM {src} r WHERE NOT EXISTS (SELECT 1 FROM {src} b WHERE ({cond}) "
        "AND b.utilityName IS NOT DISTINCT FROM r.utilityName AND b.rateName IS NOT DISTINCT FROM r.rateName)"
    )


def _densified(src: str, decimals: int, charge: str = "pl.fixedChargeFirstMeter") -> str:
    return q(
        f"""
, pl AS (SELECT DISTINCT eiaId, rateName, utilityName, fixedChargeFirstMeter FROM {src})
SELECT pl.eiaId AS eiaid, pl.rateName AS name, pl.utilityName AS utility,
  {charge} AS fixedchargefirstmeter, w.week_part, g.month, g.hour,
  round(coalesce(r.total_demand_rate, 0), {decimals}) AS total_demand_rate,
  round(coalesce(r.total_energy_rate, 0), {decimals}) AS total_energy_rate
FROM pl CROSS JOIN weekparts w CROSS JOIN grid g
LEFT JOIN {src} r ON r.eiaId IS NOT DISTINCT FROM pl.eiaId AND r.rateName = pl.rateName
  AND r.utilityName = pl.utilityName AND r.week_part = w.week_part AND r.month = g.month AND r.hour = g.hour
""".replace("\n, pl AS", ", pl AS", 1)
    )


def _profile(keys: str, col: str, name: str) -> str:
    return q(f"SELECT {keys}, round(avg({col}), 6) AS {name} FROM published GROUP BY {keys}")


def _profiles() -> str:
    stats = ", ".join(
        f"round(avg({c}), 6) AS avg_{t}, round(min({c}), 6) AS min_{t}, round(max({c}), 6) AS max_{t}, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS na_{t}"
        for c, t in (("total_energy_rate", "energy"), ("total_demand_rate", "demand"), ("fixedChargeFirstMeter", "fixed"))
    )
    return q(
        "SELECT CASE WHEN grouping(hour) = 1 THEN 'all' WHEN grouping(month) = 1 THEN 'hour' ELSE 'month_hour' END AS level, "
        f"month, hour, week_part, CAST(count(*) AS BIGINT) AS total_rows, {stats} FROM published "
        "GROUP BY GROUPING SETS ((), (hour, week_part), (month, hour, week_part))"
    )


FUNNEL = q(
    """, s1 AS (SELECT * FROM rates WHERE fixedChargeFirstMeter < 10000)
, s2 AS (SELECT * FROM s1 r WHERE NOT EXISTS (SELECT 1 FROM s1 b WHERE b.total_energy_rate > 100
          AND b.utilityName IS NOT DISTINCT FROM r.utilityName AND b.rateName IS NOT DISTINCT FROM r.rateName))
, s3 AS (SELECT * FROM s2 WHERE NOT regexp_matches(rateName,
          '(?i)irrigation|agricultur|agribusiness|pumping|furnace|heating|conditioning|catfish'))
, s4 AS (SELECT * FROM s3 WHERE multi_unit = false)
, s5 AS (SELECT * FROM s4 r WHERE NOT EXISTS (SELECT 1 FROM s4 b WHERE (b.total_energy_rate < 0 OR b.total_demand_rate < 0)
          AND b.utilityName IS NOT DISTINCT FROM r.utilityName AND b.rateName IS NOT DISTINCT FROM r.rateName))
, n AS (
  SELECT (SELECT count(*) FROM (SELECT DISTINCT eiaId, utilityName, rateName FROM rates)) AS n0,
         (SELECT count(*) FROM (SELECT DISTINCT eiaId, utilityName, rateName FROM s1)) AS n1,
         (SELECT count(*) FROM (SELECT DISTINCT eiaId, utilityName, rateName FROM s2)) AS n2,
         (SELECT count(*) FROM (SELECT DISTINCT eiaId, utilityName, rateName FROM s3)) AS n3,
         (SELECT count(*) FROM (SELECT DISTINCT eiaId, utilityName, rateName FROM s4)) AS n4,
         (SELECT count(*) FROM (SELECT DISTINCT eiaId, utilityName, rateName FROM s5)) AS n5)
SELECT CAST(step AS INTEGER) AS step, name, CAST(removed AS BIGINT) AS removed, CAST(remaining AS BIGINT) AS remaining
FROM (
  SELECT 1 AS step, 'high_fixed_charge' AS name, n0 - n1 AS removed, n1 AS remaining FROM n UNION ALL
  SELECT 2, 'high_energy_rate', n1 - n2, n2 FROM n UNION ALL
  SELECT 3, 'irrelevant_plans', n2 - n3, n3 FROM n UNION ALL
  SELECT 4, 'multi_unit_plans', n3 - n4, n4 FROM n UNION ALL
  SELECT 5, 'remove_negative_plans', n4 - n5, n5 FROM n)
"""
)


def _validation(rows: str, fixed: str, energy: str) -> str:
    return q(
        f""", v AS ({rows})
, agg AS (
  SELECT count(*) AS n,
    count(*) FILTER (WHERE NOT coalesce(fixedChargeFirstMeter <= {fixed}, false)) AS f1,
    count(*) FILTER (WHERE NOT coalesce(total_energy_rate <= {energy}, false)) AS f2,
    count(*) FILTER (WHERE NOT coalesce(NOT regexp_matches(rateName,
      '(?i)agriculture|agricultural|agribusiness|pumping|irrigation|furnace|heating|conditioning|catfish'), false)) AS f4,
    count(*) FILTER (WHERE NOT coalesce(total_demand_rate >= 0, false)) AS f5,
    count(*) FILTER (WHERE NOT coalesce(total_energy_rate >= 0, false)) AS f6
  FROM v)
, dup AS (SELECT coalesce(sum(c) FILTER (WHERE c > 1), 0) AS f3 FROM (
    SELECT count(*) AS c FROM v GROUP BY eiaId, utilityName, rateName, month, week_part, hour))
, cnt AS (SELECT (SELECT count(*) FROM (SELECT DISTINCT eiaId, utilityName, rateName FROM plans)) AS n_in,
                 (SELECT count(*) FROM (SELECT DISTINCT eiaId, utilityName, rateName FROM v)) AS n_out)
SELECT CAST(step AS INTEGER) AS step, check_name, severity, CAST(n AS BIGINT) AS n, CAST(n_failed AS BIGINT) AS n_failed,
  n_failed = 0 AS passed
FROM (
  SELECT 1 AS step, 'fixed_charge_lte_limit' AS check_name, 'critical' AS severity, n, f1 AS n_failed FROM agg UNION ALL
  SELECT 2, 'energy_rate_lte_limit', 'critical', n, f2 FROM agg UNION ALL
  SELECT 3, 'rows_distinct', 'critical', n, f3 FROM agg, dup UNION ALL
  SELECT 4, 'no_excluded_plan_names', 'critical', n, f4 FROM agg UNION ALL
  SELECT 5, 'demand_rate_gte_0', 'report', n, f5 FROM agg UNION ALL
  SELECT 6, 'energy_rate_gte_0', 'report', n, f6 FROM agg UNION ALL
  SELECT 7, 'plan_count_matches_input', 'warning', n, CASE WHEN n_in = n_out THEN 0 ELSE 1 END FROM agg, cnt)
"""
    )


ORACLE: dict[str, str] = {
    # sources
    "scan_plans": q(
        f"""
SELECT r.label, r.eiaId, r.utilityName, r.rateName, r.sector,
  CASE WHEN r.okey % 7 = 1 THEN '{{"$date": ["' || r.iso_date || '"]}}' WHEN r.okey % 7 = 2 THEN '{{"$date": []}}'
       WHEN r.okey % 7 = 3 THEN NULL WHEN r.okey % 7 = 4 THEN '{{"$date": "' || replace(r.iso_date, 'Z', '.000Z') || '"}}'
       ELSE '{{"$date": "' || r.iso_date || '"}}' END AS effectiveDate,
  '{{"$date": "' || strftime(r.endDate, '%Y-%m-%dT%H:%M:%SZ') || '"}}' AS endDate,
  round(r.demandMin, 6) AS demandMin, round(r.demandMax, 6) AS demandMax, round(r.energyMin, 6) AS energyMin,
  round(r.energyMax, 6) AS energyMax, round(r.fixedChargeFirstMeter, 6) AS fixedChargeFirstMeter, r.fixedChargeUnits,
  r.flatDemandUnits, r.demandRateUnits, 'kW' AS demandUnits,
  CASE WHEN r.okey % 11 = 0 THEN '-'
       WHEN r.okey % 13 = 0 THEN strftime(o.o_orderdate - INTERVAL 400 DAY, '%Y-%m-%dT%H:%M:%SZ') || ',' || r.iso_date
       ELSE r.iso_date END AS revisions,
  {digests("NULL", MONTHS.format(null="NULL", empty="0"))}
FROM rec r JOIN orders o ON o.o_orderkey = r.okey {DIGEST_JOIN}
"""
    ),
    "publish_parquet": q(f"SELECT {RATE_COLS} FROM published"),
    "rates_json": _densified("published", 4, "round(pl.fixedChargeFirstMeter, 4)"),
    "default_structures": q(
        f"SELECT r.eiaId, r.rateName, r.utilityName, "
        f"{digests('41616', MONTHS.format(null='78', empty='0'), '0', '1')} FROM k2 r {DIGEST_JOIN}"
    ),
    # cleaning
    "sector_filter": q("SELECT label, sector FROM rec WHERE sector = 'Commercial'"),
    "parse_dates": q("SELECT label, effectiveDate, endDate FROM rec"),
    "latest_revision": q("SELECT label, utilityName, rateName, revision_date FROM k1"),
    "latest_per_utility": q(
        "SELECT label, utilityName, revision_date FROM (SELECT *, max(revision_date) OVER "
        "(PARTITION BY utilityName) AS mx FROM p1 WHERE revision_date IS NOT NULL) WHERE revision_date = mx"
    ),
    "date_parts": q(
        "SELECT eiaId, rateName, utilityName, CAST(year(revision_date) AS INTEGER) AS revision_year, "
        "CAST(year(effectiveDate) AS INTEGER) AS effectiveDate_year, "
        "CAST(month(effectiveDate) AS INTEGER) AS effectiveDate_month, "
        "CAST(year(endDate) AS INTEGER) AS endDate_year, CAST(month(endDate) AS INTEGER) AS endDate_month FROM k1"
    ),
    "plans_as_of": q(
        """
SELECT eiaId, rateName, utilityName, label, CAST(CAST(effectiveDate AS DATE) AS VARCHAR) AS effectiveDate,
  CAST(CAST(endDate AS DATE) AS VARCHAR) AS endDate
FROM p1
WHERE (effectiveDate IS NULL OR CAST(effectiveDate AS DATE) <= DATE '1996-06-30')
  AND (endDate IS NULL OR CAST(endDate AS DATE) > DATE '1996-06-30')
QUALIFY row_number() OVER (PARTITION BY utilityName, rateName ORDER BY endDate IS NULL DESC, effectiveDate DESC NULLS LAST, label) = 1
"""
    ),
    "plans_in_effect": q("SELECT eiaId, rateName, utilityName, revision_year, endDate FROM plans"),
    "fill_bounds": q(
        "SELECT eiaId, rateName, utilityName, round(demandMin, 6) AS demandMin, round(demandMax, 6) AS demandMax, "
        "round(energyMin, 6) AS energyMin, round(energyMax, 6) AS energyMax FROM plans"
    ),
    "fill_fixed_charge": q(
        "SELECT eiaId, rateName, utilityName, round(coalesce(fixedChargeFirstMeter, 0), 6) AS fixedChargeFirstMeter, "
        "coalesce(fixedChargeUnits, '$/month') AS fixedChargeUnits FROM k2"
    ),
    "daily_to_monthly": q(
        "SELECT eiaId, rateName, utilityName, round(fixedChargeFirstMeter, 6) AS fixedChargeFirstMeter, "
        "fixedChargeUnits FROM plans"
    ),
    "empty_to_null": q(
        f"SELECT r.eiaId, r.rateName, r.utilityName, "
        f"{digests('NULL', MONTHS.format(null='NULL', empty='NULL'), empty='NULL')} FROM k2 r {DIGEST_JOIN}"
    ),
    "default_schedule": q("SELECT *, 'demand' AS kind FROM dsched UNION ALL SELECT *, 'energy' AS kind FROM esched"),
    "clean_plans": q(
        f"""
SELECT r.eiaId, r.revision_date, r.revision_year, r.effectiveDate, r.effectiveDate_year, r.effectiveDate_month,
  r.endDate, r.endDate_year, r.endDate_month, r.utilityName, r.rateName, r.sector,
  round(r.demandMin, 6) AS demandMin, round(r.demandMax, 6) AS demandMax,
  round(r.fixedChargeFirstMeter, 6) AS fixedChargeFirstMeter, r.fixedChargeUnits, r.flatDemandUnits,
  r.demandRateUnits, r.demandUnits, round(r.energyMin, 6) AS energyMin, round(r.energyMax, 6) AS energyMax,
  {digests("0", MONTHS.format(null="NULL", empty="NULL"))}
FROM plans r {DIGEST_JOIN}
"""
    ),
    "revision_dates": q(
        "SELECT CAST(count(*) AS BIGINT) AS records, CAST(count(*) FILTER (WHERE okey % 11 = 0) AS BIGINT) AS without_date, "
        "CAST(0 AS BIGINT) AS unreadable_date FROM rec"
    ),
    # reshape
    "schedule_long": q(
        "SELECT eiaId, rateName, utilityName, sector, month, hour, period FROM esched WHERE week_part = 'Weekday'"
    ),
    "demand_schedule": q("SELECT * FROM dsched"),
    "energy_schedule": q("SELECT * FROM esched"),
    "flat_schedule": q("SELECT * FROM fsched"),
    "rate_structure": q(
        "SELECT eiaId, rateName, utilityName, sector, round(energyMin, 6) AS energyMin, "
        "round(energyMax, 6) AS energyMax, period, tier, round(rate, 6) AS rate, round(adj, 6) AS adj, "
        "round(max, 6) AS max, unit, round(sell, 6) AS sell FROM e_raw"
    ),
    "fill_units": q("SELECT eiaId, rateName, utilityName, sector, period, tier, unit FROM e_filled"),
    "demand_structure": q(
        "SELECT eiaId, rateName, utilityName, sector, round(demandMin, 6) AS demandMin, "
        "round(demandMax, 6) AS demandMax, demandRateUnits, period, tier, round(rate, 6) AS rate, "
        "round(adj, 6) AS adj, round(max, 6) AS max, round(total_rate, 6) AS total_rate, unit FROM dstrux"
    ),
    "energy_structure": q(
        "SELECT eiaId, rateName, utilityName, sector, round(energyMin, 6) AS energyMin, "
        "round(energyMax, 6) AS energyMax, period, tier, round(rate, 6) AS rate, round(adj, 6) AS adj, "
        "round(max, 6) AS max, unit, round(total_rate, 6) AS total_rate FROM estrux"
    ),
    "flat_structure": q(
        "SELECT eiaId, rateName, utilityName, sector, flatDemandUnits, period, tier, round(rate, 6) AS rate, "
        "round(adj, 6) AS adj, round(max, 6) AS max, round(total_rate, 6) AS total_rate FROM fstrux"
    ),
    "distinct_tiers": q(
        "SELECT eiaId, rateName, utilityName, period, tier, unit, round(max, 6) AS max, "
        "round(total_rate, 6) AS total_rate FROM (SELECT DISTINCT eiaId, rateName, utilityName, period, tier, "
        "unit, max, total_rate FROM ecombo)"
    ),
    # joins and unit flag
    "demand_combo": q(
        "SELECT * EXCLUDE (total_rate, max), round(total_rate, 6) AS total_rate, round(max, 6) AS max FROM dcombo"
    ),
    "flat_combo": q(
        "SELECT * EXCLUDE (total_rate, max), round(total_rate, 6) AS total_rate, round(max, 6) AS max FROM fcombo"
    ),
    "energy_combo": q(
        "SELECT * EXCLUDE (total_rate, max), round(total_rate, 6) AS total_rate, round(max, 6) AS max FROM ecombo"
    ),
    "multi_unit": q(
        "SELECT * EXCLUDE (total_rate, max), round(total_rate, 6) AS total_rate, round(max, 6) AS max FROM emulti"
    ),
    # waterfall
    "tier_waterfall": q(
        "SELECT eiaId, rateName, utilityName, multi_unit, period, tier, unit, round(cap, 6) AS real_max, "
        "round(prev, 6) AS prev_max, round(least(rem, bucket), 6) AS tier_qty, "
        "round(least(rem, bucket) * coalesce(total_rate, 0), 6) AS tier_cost FROM e_wf"
    ),
    "levelized_demand": q(
        "SELECT eiaId, rateName, utilityName, period, round(total_demand_billed, 6) AS total_demand_billed, "
        "round(total_demand_cost, 6) AS total_demand_cost, round(levelized_demand_rate, 6) AS levelized_demand_rate "
        "FROM dcost"
    ),
    "levelized_flat_demand": q(
        "SELECT eiaId, rateName, utilityName, month, round(total_flat_demand_billed, 6) AS total_flat_demand_billed, "
        "round(total_flat_demand_cost, 6) AS total_flat_demand_cost, "
        "round(levelized_flat_demand_rate, 6) AS levelized_flat_demand_rate FROM fcost"
    ),
    "levelized_energy": q(
        "SELECT eiaId, rateName, utilityName, multi_unit, period, round(total_kWh_billed, 6) AS total_kWh_billed, "
        "round(total_energy_cost, 6) AS total_energy_cost, round(levelized_rate, 6) AS levelized_rate FROM ecost"
    ),
    "levelized_demand_billed": q(
        "SELECT eiaId, rateName, utilityName, period, round(total_demand_billed, 6) AS total_demand_billed, "
        "round(total_demand_cost, 6) AS total_demand_cost, "
        "round(total_demand_cost / nullif(total_demand_billed, 0), 6) AS levelized_demand_rate FROM dcost"
    ),
    "levelized_flat_demand_billed": q(
        "SELECT eiaId, rateName, utilityName, month, round(total_flat_demand_billed, 6) AS total_flat_demand_billed, "
        "round(total_flat_demand_cost, 6) AS total_flat_demand_cost, "
        "round(total_flat_demand_cost / nullif(total_flat_demand_billed, 0), 6) AS levelized_flat_demand_rate FROM fcost"
    ),
    "demand_total_billed": q(
        "SELECT eiaId, rateName, utilityName, sector, week_part, month, hour, "
        "round((total_demand_cost + total_flat_demand_cost) / nullif(total_demand_billed, 0), 6) "
        "AS levelized_total_demand_cost FROM dtotal"
    ),
    "energy_structure_dropped": q(
        "SELECT eiaId, rateName, utilityName, sector, round(energyMin, 6) AS energyMin, "
        "round(energyMax, 6) AS energyMax, period, tier, round(coalesce(rate, 0), 6) AS rate, "
        "round(coalesce(adj, 0), 6) AS adj, round(coalesce(max, -1), 6) AS max, unit, "
        "round(coalesce(rate, 0) + coalesce(adj, 0), 6) AS total_rate FROM e_filled WHERE tier IS NOT NULL"
    ),
    "demand_total": q(
        "SELECT eiaId, rateName, utilityName, sector, week_part, month, hour, period, "
        "round(total_demand_billed, 6) AS total_demand_billed, round(total_demand_cost, 6) AS total_demand_cost, "
        "round(levelized_demand_rate, 6) AS levelized_demand_rate, "
        "round(total_flat_demand_billed, 6) AS total_flat_demand_billed, "
        "round(total_flat_demand_cost, 6) AS total_flat_demand_cost, "
        "round(levelized_flat_demand_rate, 6) AS levelized_flat_demand_rate, "
        "round(levelized_total_demand_cost, 6) AS levelized_total_demand_cost FROM dtotal"
    ),
    "energy_total": q(
        "SELECT eiaId, rateName, utilityName, sector, week_part, month, hour, period, multi_unit, "
        "round(total_kWh_billed, 6) AS total_kWh_billed, round(total_energy_cost, 6) AS total_energy_cost, "
        "round(levelized_rate, 6) AS levelized_rate FROM etotal"
    ),
    "utility_rates": q(f"SELECT {RATE_COLS} FROM rates"),
    "utility_rates_stepwise": q(f"SELECT {RATE_COLS} FROM rates"),
    # filters
    "drop_irrelevant": q(f"SELECT {RATE_COLS} FROM r_irrel"),
    "drop_irrigation": q(
        f"SELECT {RATE_COLS} FROM rates WHERE NOT regexp_matches(rateName, "
        "'(?i)irrigation|agricultur|agribusiness|pumping|furnace|heating|conditioning')"
    ),
    "drop_high_fixed": q(f"SELECT {RATE_COLS} FROM rates WHERE fixedChargeFirstMeter < 10000"),
    "drop_high_energy": q(_group_drop("rates", "b.total_energy_rate > 0.1")),
    "drop_high_energy_long": q(_group_drop("rates", "b.total_energy_rate > 0.1")),
    "drop_multi_unit": q(f"SELECT {RATE_COLS} FROM rates WHERE multi_unit = false"),
    "keep_multi_unit": q(f"SELECT {RATE_COLS} FROM rates WHERE multi_unit = true"),
    "drop_negative": q(_group_drop("rates", "b.total_energy_rate < 0 OR b.total_demand_rate < 0")),
    "drop_negative_long": q(_group_drop("rates", "b.total_energy_rate < 0 OR b.total_demand_rate < 0")),
    "published_rates": q(f"SELECT {RATE_COLS} FROM published"),
    "published_rates_stepwise": q(f"SELECT {RATE_COLS} FROM published"),
    "count_plans": q(
        "SELECT CAST(count(*) AS BIGINT) AS n_plans FROM (SELECT DISTINCT eiaId, utilityName, rateName FROM rates)"
    ),
    "filter_funnel": FUNNEL,
    "filter_funnel_cells": FUNNEL,
    "validation_report": _validation("SELECT * FROM validated", "10000", "100"),
    "validation_report_cells": _validation("SELECT * FROM validated", "10000", "100"),
    "validation_failures": _validation(
        "SELECT * FROM rates UNION ALL SELECT * FROM rates WHERE month = 1 AND hour = 1", "5000", "0.1"
    ),
    # report
    "rates_profile": q(
        """
SELECT CAST(count(*) AS BIGINT) AS total_rows,
  round(avg(total_energy_rate), 6) AS avg_energy, round(min(total_energy_rate), 6) AS min_energy,
  round(max(total_energy_rate), 6) AS max_energy,
  CAST(count(*) FILTER (WHERE total_energy_rate IS NULL) AS BIGINT) AS na_energy,
  round(avg(total_demand_rate), 6) AS avg_demand, round(min(total_demand_rate), 6) AS min_demand,
  round(max(total_demand_rate), 6) AS max_demand,
  CAST(count(*) FILTER (WHERE total_demand_rate IS NULL) AS BIGINT) AS na_demand,
  round(avg(fixedChargeFirstMeter), 6) AS avg_fixed, round(min(fixedChargeFirstMeter), 6) AS min_fixed,
  round(max(fixedChargeFirstMeter), 6) AS max_fixed,
  CAST(count(*) FILTER (WHERE fixedChargeFirstMeter IS NULL) AS BIGINT) AS na_fixed
FROM published
"""
    ),
    "rates_profiles": _profiles(),
    "hourly_energy": _profile("hour, week_part", "total_energy_rate", "avg_energy_rate"),
    "monthly_hourly_energy": _profile("month, hour, week_part", "total_energy_rate", "avg_energy_rate"),
    "hourly_demand": _profile("hour, week_part", "total_demand_rate", "avg_demand_rate"),
    "monthly_hourly_demand": _profile("month, hour, week_part", "total_demand_rate", "avg_demand_rate"),
    # nesting
    "nested_rates": _densified("published", 6),
    "rate_matrix": _densified("published", 6),
}

#: The same records by way of array documents.
ORACLE["ingest_arrays"] = ORACLE["scan_plans"]
#: The same tables by other ways.
ORACLE["rates_layout"] = ORACLE["published_rates"]
ORACLE["utility_rates_joined"] = ORACLE["utility_rates_stepwise"]
ORACLE["fill_units_ranges"] = ORACLE["fill_units"]
ORACLE["validation_slots"] = ORACLE["validation_report"]
ORACLE["validation_slots_failures"] = ORACLE["validation_failures"]
ORACLE["rates_document"] = ORACLE["rates_json"]
