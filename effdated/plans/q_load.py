"""Load stage and exception runner on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from effdated.plans import load as ld
from effdated.plans.driver_queries import ORACLES, QUERIES, register, table
from effdated.plans.q_intervals import _EVENTS_SQL, events_periods


@register("exception_report", f"""
WITH e AS ({_EVENTS_SQL}),
o AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority AS priority, o_totalprice - 100000 AS due,
             CASE WHEN o_orderkey % 50 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS day,
             CASE WHEN o_orderkey % 40 = 0 THEN 'n/k' WHEN o_orderkey % 41 = 0 THEN 'é1' ELSE CAST(o_custkey AS VARCHAR) END AS ref FROM orders),
d AS (SELECT o_custkey, status FROM o WHERE status IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
m AS (SELECT *, max(end_ts) OVER (PARTITION BY user_id ORDER BY ts, end_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
i AS (SELECT *, count(*) FILTER (reach IS NULL OR ts >= reach) OVER (PARTITION BY user_id ORDER BY ts, end_ts ROWS UNBOUNDED PRECEDING) AS isl FROM m)
SELECT 'orders' AS dataset, 'non_nan' AS test, 'status' AS "column", NULL AS value, '{{"o_orderkey":' || o_orderkey || '}}' AS key FROM o WHERE status IS NULL
UNION ALL SELECT 'orders', 'non_numeric', 'ref', ref, '{{"o_orderkey":' || o_orderkey || '}}' FROM o WHERE try_cast(ref AS DOUBLE) IS NULL
UNION ALL SELECT 'orders', 'non_datetime', 'day', day, '{{"o_orderkey":' || o_orderkey || '}}' FROM o WHERE day = 'soon'
UNION ALL SELECT 'orders', 'non_isacii', 'ref', ref, '{{"o_orderkey":' || o_orderkey || '}}' FROM o WHERE ref = 'é1'
UNION ALL SELECT 'orders', 'inscope_priority', 'priority', priority, '{{"o_orderkey":' || o_orderkey || '}}' FROM o WHERE priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT 'events', 'non_overlapping', NULL, NULL, '{{"event_id":' || event_id || '}}' FROM i QUALIFY count(*) OVER (PARTITION BY user_id, isl) > 1
UNION ALL SELECT 'events', 'non_duplicate', NULL, NULL, '{{"event_id":' || event_id || '}}' FROM e QUALIFY count(*) OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) > 1
""")
def q_exception_report(spark, sf):
    """Two datasets, one configuration, one table of violations."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    orders = o.select(
        "o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.when(k % 50 == 0, "soon").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day"),
        F.when(k % 40 == 0, "n/k").when(k % 41 == 0, "é1").otherwise(F.col("o_custkey").cast("string")).alias("ref"))
    events = events_periods(spark, sf).withColumn("day", F.to_date("ts"))
    config = {
        "orders": {"keys": ["o_orderkey"],
                   "validation_tests": {"non_nan": ["status", "ref"], "exclude_nan": ["ref"], "non_numeric": ["ref"], "non_positive": [], "non_datetime": ["day"],
                                        "non_isacii": ["ref"], "non_duplicate": {"subset": []}, "broken_records": []},
                   "inscope_mappings": {"priority": {"client_columns": ["priority"]}, "region": {"client_columns": []}}},
        "events": {"keys": ["event_id"],
                   "validation_tests": {"non_overlapping": {"key": "user_id", "start": "ts", "end": "end_ts"},
                                        "non_duplicate": {"subset": ["user_id", "event_type", "day"]}}}}
    return ld.run_exception_tests({"orders": orders, "events": events}, config, {"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]})


#: Output tables whose datasets the driver tables carry, and the query that builds each.
_BUILDS = {"EmployeeBase": "build_employee_base", "EmployeeEmploymentType": "build_employment_type", "EmployeeSetoffStrategy": "build_setoff_strategy",
           "EmployeeRatesOverTime": "build_rates_over_time", "EmployeeCohortsOverTime": "build_employee_cohorts"}


def _counts_sql() -> str:
    rows = [f"SELECT '{t}' AS table_name, count(*) AS n_rows, {len(ld.LOAD_TABLES[t][1])}::BIGINT AS n_columns, count(DISTINCT \"EmployeeCode\") AS n_employees FROM ({ORACLES[q]})"
            for t, q in _BUILDS.items()]
    return " UNION ALL ".join([*rows, "SELECT 'Configuration', 1, 2, 0"])


@register("load_outputs", _counts_sql())
def q_load_outputs(spark, sf):
    """The declared projection of every output, summarised per table."""
    datasets = {ld.LOAD_TABLES[t][0]: QUERIES[q](spark, sf) for t, q in _BUILDS.items()}
    config = {"Configuration": {"switch": True, "ClientId": "client", "BypassVarianceValidators": False}, **ld.default_load_config(list(_BUILDS))}
    out = None
    for name, df in ld.load_outputs(spark, datasets, config).items():
        employees = F.count_distinct("EmployeeCode") if "EmployeeCode" in df.columns else F.lit(0).cast("long")
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), employees.alias("n_employees")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"), "n_employees")
        out = row if out is None else out.unionByName(row)
    return out


@register("load_tests", f"""
WITH b AS ({ORACLES["build_employee_base"]}), c AS ({ORACLES["build_employee_cohorts"]}),
p AS (SELECT EmployeeCode FROM c GROUP BY EmployeeCode HAVING count(*) > 1),
n AS (SELECT count(*) AS n FROM c JOIN p USING (EmployeeCode))
SELECT 'EmployeeBase' AS "table", 'duplicated' AS test, 0::BIGINT AS n_violations, 0::BIGINT AS tolerance, count(*) = count(DISTINCT EmployeeCode) AS passed FROM b
UNION ALL SELECT 'EmployeeCohortsOverTime', 'overlapping', count(*), 0, count(*) = 0 FROM c x JOIN c y
  ON x.EmployeeCode = y.EmployeeCode AND (x.StartDate, x.EndDate) <> (y.StartDate, y.EndDate) AND x.StartDate < y.EndDate AND y.StartDate < x.EndDate
UNION ALL SELECT 'EmployeeCohortsOverTime', 'duplicated', n, 5, n <= 5 FROM n
""")
def q_load_tests(spark, sf):
    """Load tests with tolerances; one of them is meant to fail."""
    tables = ["EmployeeBase", "EmployeeCohortsOverTime"]
    datasets = {ld.LOAD_TABLES[t][0]: QUERIES[_BUILDS[t]](spark, sf) for t in tables}
    outputs = ld.load_outputs(spark, datasets, ld.default_load_config(tables))
    return ld.check_outputs(outputs, {
        "EmployeeBase": {"duplicated": {"subset": ["EmployeeCode"]}},
        "EmployeeCohortsOverTime": {"overlapping": {"key": "EmployeeCode", "start": "StartDate", "end": "EndDate"},
                                    "duplicated": {"subset": ["EmployeeCode"], "tolerance": 5}}}).drop("column")


@register("load_tests_declared", f"""
WITH e AS ({_EVENTS_SQL}), o AS (SELECT o_custkey, o_orderstatus, o_orderdate FROM orders),
s AS (SELECT CAST(user_id AS VARCHAR) AS EmployeeCode, ts AS ClockedIn, CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL 1 HOUR ELSE end_ts END AS ClockedOut,
             nullif(event_type, 'click') AS Region, 'sheet' || event_id % 5 || ':row:' || event_id AS Source FROM e),
m AS (SELECT *, max(ClockedOut) OVER (PARTITION BY EmployeeCode ORDER BY ClockedIn, ClockedOut ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s WHERE EmployeeCode <> '7'),
i AS (SELECT *, count(*) FILTER (reach IS NULL OR ClockedIn >= reach) OVER (PARTITION BY EmployeeCode ORDER BY ClockedIn, ClockedOut ROWS UNBOUNDED PRECEDING) AS isl FROM m),
keys AS (SELECT EmployeeCode AS k, 1 AS b FROM s UNION SELECT CAST(o_custkey AS VARCHAR), 2 FROM orders UNION SELECT CAST(c_custkey AS VARCHAR), 4 FROM customer),
masks AS (SELECT k, sum(b) AS b FROM keys GROUP BY k),
n(test, "column", n_violations, tolerance) AS (
  SELECT 'test_null_values', 'Region', count(*) FILTER (Region IS NULL), 0 FROM s
  UNION ALL SELECT 'test_null_values', unnest(['EmployeeCode', 'ClockedIn', 'ClockedOut']), 0, 0
  UNION ALL SELECT 'test_enddate_before_startdate', NULL, count(*) FILTER (ClockedOut < ClockedIn AND EmployeeCode NOT IN ('1', '2')), 0 FROM s
  UNION ALL SELECT 'test_timesheet_short_shifts', NULL, count(*) FILTER (epoch(ClockedOut) - epoch(ClockedIn) < 1800), 0 FROM s
  UNION ALL SELECT 'test_timesheet_long_shifts', NULL, count(*) FILTER (epoch(ClockedOut) - epoch(ClockedIn) > 3 * 3600), 0 FROM s
  UNION ALL SELECT 'test_duplicated_data', 'EmployeeCode,Region', coalesce(sum(c), 0), 100 FROM (SELECT count(*) AS c FROM s GROUP BY EmployeeCode, Region HAVING count(*) > 1)
  UNION ALL SELECT 'test_duplicated_data', 'Source', 0, 100
  UNION ALL SELECT 'test_duplicated_data', 'EmployeeCode,ClockedIn,ClockedOut,Region,Source', 0, 100
  UNION ALL SELECT 'test_overlapping', NULL, count(*), 0 FROM (SELECT 1 FROM i QUALIFY count(*) OVER (PARTITION BY EmployeeCode, isl) > 1)
  UNION ALL SELECT 'test_column_and_datatype', 'Region,Source', 2, 0
  UNION ALL SELECT 'test_data_source', NULL, count(*), 0 FROM (VALUES ('sheet0'), ('sheet4'), ('sheet5'), ('sheet6')) f(f) WHERE f NOT IN (SELECT split_part(Source, ':', 1) FROM s)
  UNION ALL SELECT 'test_membership', NULL, count(*), 0 FROM masks WHERE b & 1 = 0 OR b & 6 = 0
  UNION ALL SELECT 'test_cross_dataset_period', 'orders', count(*), 0 FROM s
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE CAST(o_custkey AS VARCHAR) = EmployeeCode AND ClockedIn BETWEEN o_orderdate AND o_orderdate + INTERVAL 400 DAY))
SELECT 'Timesheet' AS "table", test, "column", n_violations::BIGINT AS n_violations, tolerance::BIGINT AS tolerance, n_violations <= tolerance AS passed FROM n
""")
def q_load_tests_declared(spark, sf):
    """Every declared load test on one output, with tolerances."""
    e = events_periods(spark, sf)
    sheet = e.select(F.col("user_id").cast("string").alias("EmployeeCode"), F.col("ts").alias("ClockedIn"),
                     F.when(F.col("event_id") % 97 == 0, F.col("ts") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("end_ts")).alias("ClockedOut"),
                     F.expr("nullif(event_type, 'click')").alias("Region"),
                     F.concat(F.lit("sheet"), (F.col("event_id") % 5).cast("string"), F.lit(":row:"), F.col("event_id").cast("string")).alias("Source"))
    orders = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("EmployeeCode"), F.col("o_orderdate").alias("from"),
                                               (F.col("o_orderdate") + F.expr("INTERVAL 400 DAY")).alias("to"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("EmployeeCode"))
    at = {"start": "ClockedIn", "end": "ClockedOut"}
    tests = {"Timesheet": {
        "test_null_values": {"tolerance_null_values": ["Source"]},
        "test_enddate_before_startdate": {**at, "tolerance_employee_code": ["1", "2"]},
        "test_timesheet_short_shifts": {**at, "tolerance_shift_minimum_length": 30},
        "test_timesheet_long_shifts": {**at, "tolerance_shift_maximum_length": 3},
        "test_duplicated_data": {"subset": [["EmployeeCode", "Region"], ["Source"], ["all"]], "tolerance_number_of_duplicate_records": 100},
        "test_overlapping": {"key": "EmployeeCode", **at, "tolerance_employee_code": ["7"]},
        "test_column_and_datatype": {"expected": {"EmployeeCode": "int", "ClockedIn": "timestamp_ntz", "ClockedOut": "timestamp_ntz", "Region": "int", "Other": "string"},
                                     "tolerance_change_dtype": {"EmployeeCode": "string"}, "tolerance_irrelevant_columns": ["Other"]},
        "test_data_source": {"files": ["sheet0", "sheet4", "sheet5", "sheet6", "notes"], "tolerance_irrelevant_file": ["notes"]},
        "test_membership": {"with": ["orders", "customers"], "key": "EmployeeCode", "groups": {"register": ["orders", "customers"]}},
        "test_cross_dataset_period": {"compare_with": ["orders"], "key": "EmployeeCode", "date": "ClockedIn", "p_start": "from", "p_end": "to"},
        "test_unused": {"switch": False}}}
    return ld.check_outputs({"Timesheet": sheet}, tests, {"orders": orders, "customers": customers})
