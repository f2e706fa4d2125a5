"""Dataset assembly (U1-U5) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from effdated.plans.q_intervals import sweep_sql
from effdated.plans.driver_queries import register, table
from effdated.plans.stage import run_stage, split_datasets, union_batches, union_distinct


def _batches(spark, sf):
    """orders as two source batches with different header spellings (before / from 1998)."""
    o = table(spark, sf, "orders")
    a = o.filter(F.year("o_orderdate") < 1998).select(
        F.col("o_orderkey").alias("DET_NUMBER"), F.col("o_custkey").alias("EMPLOYEE"),
        F.col("o_orderdate").alias("PIT_RUN_END_DATE"), F.col("o_totalprice").alias("PIT_AMOUNT"))
    b = o.filter(F.year("o_orderdate") >= 1998).select(
        F.col("o_orderkey").alias("Det Number"), F.col("o_custkey").alias("Employee"),
        F.col("o_orderdate").alias("Run End"), F.col("o_orderstatus").alias("Status"))
    return a, b


@register("union_batches", """
SELECT o_orderkey AS EmployeeLine, o_custkey AS EmployeeCode, o_orderdate AS PeriodEnd,
       CASE WHEN year(o_orderdate) < 1998 THEN o_totalprice END AS Amount,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderstatus END AS Status
FROM orders
""")
def q_union_batches(spark, sf):
    a, b = _batches(spark, sf)
    out = run_stage({"batch1": a, "batch2": b}, [
        {"function": "unified_columns", "sources": ["batch1"],
         "args": {"raw_column_names": [["DET_NUMBER", "EMPLOYEE", "PIT_RUN_END_DATE", "PIT_AMOUNT"]],
                  "unified_column_names": ["EmployeeLine", "EmployeeCode", "PeriodEnd", "Amount"]}},
        {"function": "unified_columns", "sources": ["batch2"],
         "args": {"raw_column_names": [["DET_NUMBER", "EMPLOYEE", "PIT_RUN_END_DATE", "PIT_AMOUNT"],
                                       ["Det Number", "Employee", "Run End", "create_Amount"]],
                  "unified_column_names": ["EmployeeLine", "EmployeeCode", "PeriodEnd", "Amount"]}},
    ])
    u = union_batches([out["batch1"], out["batch2"]])
    return u.withColumn("Amount", F.col("Amount").cast("double"))


@register("union_distinct", """
SELECT DISTINCT o_custkey AS k, o_orderstatus AS v FROM orders
UNION SELECT DISTINCT user_id, event_type FROM events
""")
def q_union_distinct(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("v"))
    e = table(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("v"))
    return union_distinct([o, e])


@register("stage_chain", """
WITH o AS (SELECT o_custkey AS EmployeeCode, nullif(o_orderstatus, 'P') AS Classification, o_orderdate AS EffectiveDate,
                  o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'),
f AS (SELECT *, CASE WHEN lag(o_orderkey) OVER w IS NULL OR Classification IS NULL OR lag(Classification) OVER w IS NULL
                       OR Classification <> lag(Classification) OVER w THEN 1 ELSE 0 END AS chg
      FROM o WINDOW w AS (PARTITION BY EmployeeCode ORDER BY EffectiveDate, o_orderkey)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY EmployeeCode ORDER BY EffectiveDate, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f),
g AS (SELECT EmployeeCode, run, max(Classification) AS Classification, min(EffectiveDate) AS StartDate FROM r GROUP BY ALL)
SELECT EmployeeCode, Classification, StartDate,
       coalesce(lead(StartDate) OVER (PARTITION BY EmployeeCode ORDER BY run), TIMESTAMP '2262-04-11 23:47:16.854775') AS EndDate
FROM g
""")
def q_stage_chain(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
                                          "o_orderdate", "o_orderkey", "o_orderpriority")
    steps = [
        {"function": "rename_columns", "args": {"name_map": {"o_custkey": "EmployeeCode", "o_orderstatus": "Classification",
                                                            "o_orderdate": "EffectiveDate"}}},
        {"function": "dataset_filter", "args": {"expression": "o_orderpriority <> '5-LOW'"}},
        {"function": "row_filter", "switch": False, "args": {"filters": []}},
        {"function": "flatten_effective_date", "targets": ["masterSMN"],
         "args": {"key_col": "EmployeeCode", "flat_col": "Classification", "effective_date": "EffectiveDate",
                  "agg_settings": {"Classification": "first", "EffectiveDate": "min"}, "order_by": ["o_orderkey"]}},
        {"function": "fill_null_with_max_date", "args": {"target_col": "EndDate"}},
    ]
    out = run_stage({"orders": o}, steps)
    return out["masterSMN"]


@register("split_datasets", """
SELECT o_orderkey, 'high' AS sub_dataset FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT o_orderkey, 'open' FROM orders WHERE o_orderstatus = 'O'
""")
def q_split_datasets(spark, sf):
    o = table(spark, sf, "orders")
    parts = split_datasets(o, {"high": "o_orderpriority IN ('1-URGENT', '2-HIGH')", "open": "o_orderstatus = 'O'"})
    return union_batches([d.select("o_orderkey", F.lit(n).alias("sub_dataset")) for n, d in parts.items()])


@register("build_employee_classification", """
WITH b AS (SELECT CAST(o_custkey AS VARCHAR) AS EmployeeCode, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d,
                  o_orderpriority AS c1, o_orderstatus AS c2,
                  CASE WHEN o_custkey % 10 = 0 THEN TIMESTAMP '2002-06-30' END AS term,
                  CAST(o_orderkey + 2 AS VARCHAR) AS rn, o_orderkey FROM orders),
f AS (SELECT *, CASE WHEN lag(o_orderkey) OVER w IS NULL
                       OR c1 IS NULL OR lag(c1) OVER w IS NULL OR c1 <> lag(c1) OVER w
                       OR c2 IS NULL OR lag(c2) OVER w IS NULL OR c2 <> lag(c2) OVER w
                       OR term IS NULL OR lag(term) OVER w IS NULL OR term <> lag(term) OVER w THEN 1 ELSE 0 END AS chg
      FROM b WINDOW w AS (PARTITION BY EmployeeCode ORDER BY d, o_orderkey)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY EmployeeCode ORDER BY d, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
             row_number() OVER (PARTITION BY EmployeeCode ORDER BY d, o_orderkey) AS pos FROM f),
firsts AS (SELECT EmployeeCode, run, rn, min(pos) AS pos FROM r GROUP BY ALL),
g AS (SELECT EmployeeCode, run, first(c1 ORDER BY pos) AS Classification, first(term ORDER BY pos) AS term,
             min(d) AS StartDate FROM r GROUP BY ALL),
src AS (SELECT EmployeeCode, run, '{''masterSMN:row:'': [' || string_agg('''' || rn || '''', ', ' ORDER BY pos) || ']}' AS Source
        FROM firsts GROUP BY ALL),
e AS (SELECT g.*, lead(StartDate) OVER (PARTITION BY EmployeeCode ORDER BY run) AS nxt FROM g)
SELECT e.EmployeeCode, StartDate,
       CASE WHEN nxt IS NULL THEN coalesce(term, TIMESTAMP '2262-04-11 23:47:16.854775') ELSE nxt END AS EndDate,
       Classification, src.Source, 'masterSMN.xlsx' AS source_file, term AS "Termination Date"
FROM e JOIN src USING (EmployeeCode, run)
""")
def q_build_employee_classification(spark, sf):
    from effdated.plans.datasets import bronze_master_smn, employee_classification
    bronze = bronze_master_smn(table(spark, sf, "orders"))
    return employee_classification(bronze, order_by=["o_orderkey"])


_LINE_ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_SMN_SQL = """
b AS (SELECT CAST(o_custkey AS VARCHAR) AS EmployeeCode, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d,
             o_orderpriority AS c1, o_orderstatus AS c2,
             CASE WHEN o_custkey % 10 = 0 THEN TIMESTAMP '2002-06-30' END AS term, o_orderkey FROM orders),
f AS (SELECT *, CASE WHEN lag(o_orderkey) OVER w IS NULL
                       OR c1 IS NULL OR lag(c1) OVER w IS NULL OR c1 <> lag(c1) OVER w
                       OR c2 IS NULL OR lag(c2) OVER w IS NULL OR c2 <> lag(c2) OVER w
                       OR term IS NULL OR lag(term) OVER w IS NULL OR term <> lag(term) OVER w THEN 1 ELSE 0 END AS chg
      FROM b WINDOW w AS (PARTITION BY EmployeeCode ORDER BY d, o_orderkey)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY EmployeeCode ORDER BY d, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
             row_number() OVER (PARTITION BY EmployeeCode ORDER BY d, o_orderkey) AS pos FROM f),
g AS (SELECT EmployeeCode, run, first(c1 ORDER BY pos) AS Classification, first(term ORDER BY pos) AS term,
             min(d) AS StartDate FROM r GROUP BY ALL),
e AS (SELECT g.*, lead(StartDate) OVER (PARTITION BY EmployeeCode ORDER BY run) AS nxt FROM g),
smn AS (SELECT EmployeeCode, StartDate, Classification,
               CASE WHEN nxt IS NULL THEN coalesce(term, TIMESTAMP '2262-04-11 23:47:16.854775') ELSE nxt END AS EndDate
        FROM e)"""


@register("build_payslips", f"""
WITH {_SMN_SQL},
ps AS (SELECT CAST(o_custkey AS VARCHAR) AS EmployeeCode, o_orderdate AS PeriodStart, o_orderdate + INTERVAL 13 DAY AS pe0,
              l_returnflag || l_linestatus AS PayCode, CAST(l_quantity AS VARCHAR) AS Hours0, l_extendedprice AS Amount,
              CASE WHEN l_returnflag = 'N' THEN '1' ELSE '0' END AS base,
              'payslips:row:' || CAST((l_orderkey * 10 + l_linenumber) * 1000 + nth AS VARCHAR) AS src
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS nth FROM lineitem)
       JOIN orders ON l_orderkey = o_orderkey),
p1 AS (SELECT *, sha256(EmployeeCode || '#' || strftime(pe0, '%Y-%m-%d %H:%M:%S')) AS PayslipCode0,
              sha256(src) AS PayslipLineCode, pe0 + INTERVAL 1 DAY AS PeriodEnd0
       FROM ps WHERE EmployeeCode IN (SELECT EmployeeCode FROM smn)),
j AS (SELECT p1.*, smn.StartDate, smn.EndDate, smn.Classification FROM p1 JOIN smn ON p1.EmployeeCode = smn.EmployeeCode
      AND (p1.PeriodStart BETWEEN smn.StartDate AND smn.EndDate OR p1.PeriodEnd0 BETWEEN smn.StartDate AND smn.EndDate)),
v AS (SELECT *, CASE base WHEN '1' THEN 'True' WHEN '0' THEN 'False' ELSE base END AS isbase FROM j),
v2 AS (SELECT *, CASE WHEN isbase = 'False' THEN '0' ELSE Hours0 END AS Hours FROM v),
per AS (SELECT DISTINCT EmployeeCode, PeriodStart AS s, PeriodEnd0 AS e FROM v2),
m AS (SELECT *, max(e) OVER (PARTITION BY EmployeeCode ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pme FROM per),
st AS (SELECT *, CASE WHEN pme IS NULL OR s >= pme THEN 1 ELSE 0 END AS fl FROM m),
isl AS (SELECT *, sum(fl) OVER (PARTITION BY EmployeeCode ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS overlapping_index FROM st),
ic AS (SELECT *, count(*) OVER (PARTITION BY EmployeeCode, overlapping_index) > 1 AS is_overlapping FROM isl),
u AS (SELECT v2.*, ic.overlapping_index, ic.is_overlapping FROM v2 JOIN ic
      ON v2.EmployeeCode = ic.EmployeeCode AND v2.PeriodStart = ic.s AND v2.PeriodEnd0 = ic.e),
spans AS (SELECT EmployeeCode, overlapping_index, min(PeriodStart) AS us, max(PeriodEnd0) AS ue,
                 arg_min(PayslipCode0, (PeriodStart, PeriodEnd0, PayslipCode0)) AS uc FROM u GROUP BY ALL),
uu AS (SELECT u.*, spans.us, spans.ue, spans.uc FROM u JOIN spans USING (EmployeeCode, overlapping_index)),
d AS (SELECT *, row_number() OVER (PARTITION BY PayslipLineCode
                 ORDER BY StartDate, Classification, Hours, Amount, PayCode) AS rk FROM uu)
SELECT EmployeeCode, us AS PeriodStart, ue AS PeriodEnd,
       CASE WHEN day(ue) <= 20 AND ue IN (SELECT o_orderdate + INTERVAL 14 DAY FROM orders) THEN strftime(ue, '%Y-%m') END AS PayCycle, PayCode, Hours, Amount, isbase AS "Is Base Hours?",
       '{{''payslips:row:'': [''' || substr(src, 14) || ''']}}' AS Source,
       uc AS PayslipCode, PayslipLineCode, StartDate, EndDate, Classification,
       CAST(overlapping_index AS BIGINT) AS overlapping_index, is_overlapping
FROM d WHERE rk = 1
""")
def q_build_payslips(spark, sf):
    from effdated.plans.datasets import (bronze_master_smn, employee_classification, payslip_batches, payslips,
                                         stage_payslips, staged_payslips)
    smn = employee_classification(bronze_master_smn(table(spark, sf, "orders")), order_by=["o_orderkey"])
    staged = stage_payslips(payslip_batches(staged_payslips(table(spark, sf, "lineitem"), table(spark, sf, "orders"))))
    runs = table(spark, sf, "orders").select((F.col("o_orderdate") + F.make_dt_interval(F.lit(14))).alias("run_end")).distinct()
    runs = runs.filter("day(run_end) <= 20").withColumn("cycle", F.date_format("run_end", "yyyy-MM"))
    out = payslips(staged, smn, payrun_index=runs)
    return out.select("EmployeeCode", "PeriodStart", "PeriodEnd", "PayCycle", "PayCode", "Hours", "Amount", "Is Base Hours?",
                      "Source", "PayslipCode", "PayslipLineCode", "StartDate", "EndDate", "Classification",
                      F.col("overlapping_index").cast("bigint").alias("overlapping_index"), "is_overlapping")


@register("build_employee_cohorts", f"""
WITH {_SMN_SQL},
m AS (SELECT EmployeeCode, StartDate, EndDate,
             CASE WHEN Classification IN ('1-URGENT', '2-HIGH') THEN 'Cohort A' WHEN Classification = '3-MEDIUM' THEN 'Cohort B' END AS c14,
             CASE WHEN Classification = '3-MEDIUM' THEN 'Cohort B' WHEN Classification IN ('4-NOT SPECIFIED', '5-LOW') THEN 'Cohort C' END AS c17
      FROM smn),
cut AS (SELECT EmployeeCode, StartDate, TIMESTAMP '1998-12-01' AS EndDate, c14, c17 FROM m
          WHERE StartDate < TIMESTAMP '1998-12-01' AND EndDate > TIMESTAMP '1998-12-01'
        UNION ALL SELECT EmployeeCode, TIMESTAMP '1998-12-01', EndDate, c14, c17 FROM m
          WHERE StartDate < TIMESTAMP '1998-12-01' AND EndDate > TIMESTAMP '1998-12-01'
        UNION ALL SELECT * FROM m WHERE NOT (StartDate < TIMESTAMP '1998-12-01' AND EndDate > TIMESTAMP '1998-12-01')),
mel AS (SELECT EmployeeCode, StartDate, EndDate, 'Region 2014 EA' AS EA, c14 AS Cohort FROM cut
        UNION ALL SELECT EmployeeCode, StartDate, EndDate, 'Region 2017 EA', c17 FROM cut),
k AS (SELECT * FROM mel WHERE (EndDate <= TIMESTAMP '1998-12-01' AND contains(EA, '2014'))
                           OR (StartDate >= TIMESTAMP '1998-12-01' AND contains(EA, '2017'))),
more AS (SELECT CAST(o_custkey AS VARCHAR) AS EmployeeCode, min(o_orderdate) + INTERVAL 90 DAY AS StartDate,
                min(o_orderdate) + INTERVAL 120 DAY AS EndDate, 'Added' AS EA, 'Cohort D' AS Cohort
         FROM orders WHERE o_custkey % 3 = 0 GROUP BY o_custkey),
recs AS (SELECT EmployeeCode, StartDate, EndDate, EA, Cohort FROM k UNION ALL SELECT * FROM more),{sweep_sql(
    "recs", "EmployeeCode", "StartDate", "EndDate", "Cohort", "StartDate, EndDate, EA, Cohort NULLS LAST")}
SELECT k AS EmployeeCode, v AS Cohort, s AS StartDate, e AS EndDate FROM swept
""")
def q_build_employee_cohorts(spark, sf):
    from effdated.plans.datasets import bronze_master_smn, cohort_mappings, employee_classification, employee_cohorts
    smn = employee_classification(bronze_master_smn(table(spark, sf, "orders")), order_by=["o_orderkey"])
    out = employee_cohorts(cohort_mappings(smn), ["Region 2014 EA award mapping", "Region 2017 EA award mapping"],
                           "1998-12-01", "2014", "2017", additional=_added_cohorts(table(spark, sf, "orders")))
    return out.select("EmployeeCode", "Cohort", "StartDate", "EndDate")


def _added_cohorts(orders):
    """Cohort periods from another list (T12): a month inside an ordinary period."""
    first = orders.filter(F.col("o_custkey") % 3 == 0).groupBy("o_custkey").agg(F.min("o_orderdate").alias("d"))
    return first.select(F.col("o_custkey").cast("string").alias("EmployeeCode"),
                        (F.col("d") + F.make_dt_interval(F.lit(90))).alias("StartDate"),
                        (F.col("d") + F.make_dt_interval(F.lit(120))).alias("EndDate"), F.lit("Added").alias("EA"), F.lit("Cohort D").alias("Cohort"))


@register("build_classification_final", f"""
WITH {_SMN_SQL},
mm AS (SELECT EmployeeCode, StartDate, EndDate, Classification AS c0, unnest([TIMESTAMP '1900-01-01', TIMESTAMP '1998-12-01']) AS lo,
             unnest([TIMESTAMP '1998-12-01', TIMESTAMP '9999-01-01']) AS hi, unnest([1, 2]) AS side FROM smn),
aw AS (SELECT EmployeeCode, greatest(StartDate, lo) AS s, least(EndDate, hi) AS e, CASE side WHEN 1 THEN 'Region 2014 EA' ELSE 'Region 2017 EA' END AS Award,
              CASE WHEN side = 1 AND c0 <> '5-LOW' THEN 'Award 2014' WHEN side = 2 AND c0 <> '1-URGENT' THEN 'Award 2017' END AS cls, StartDate
       FROM mm WHERE (StartDate < hi AND EndDate > lo) OR (StartDate = EndDate AND StartDate >= lo AND StartDate <= hi)),
ov AS (SELECT CAST(o_custkey AS VARCHAR) AS EmployeeCode, CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP) AS s FROM orders WHERE o_custkey % 5 = 0 GROUP BY o_custkey),
bb AS (SELECT aw.* EXCLUDE (cls), CASE WHEN ov.s IS NOT NULL THEN 'Award 2014 level 2' ELSE cls END AS cls FROM aw LEFT JOIN ov ON ov.EmployeeCode = aw.EmployeeCode AND ov.s = aw.s),
tt AS (SELECT CAST(user_id AS VARCHAR) AS EmployeeCode, ts, ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS te, event_type AS region FROM events WHERE value > 100),
rg AS (SELECT b.EmployeeCode, b.s, b.e, first(t.region ORDER BY ts, te, region) AS region
      FROM (SELECT DISTINCT EmployeeCode, s, e FROM bb WHERE cls = 'Award 2017') b JOIN tt t ON t.EmployeeCode = b.EmployeeCode AND ts >= b.s AND te <= b.e GROUP BY ALL)
SELECT b.EmployeeCode, b.s AS StartDate, b.e AS EndDate, Award, CASE WHEN region IS NOT NULL AND cls = 'Award 2017' THEN cls || ' - ' || region ELSE cls END AS Classification
FROM bb b LEFT JOIN rg USING (EmployeeCode, s, e)
""")
def q_build_classification_final(spark, sf):
    from effdated.plans.datasets import (bronze_master_smn, classification_awards, classification_final, cohort_mappings,
                                         employee_classification, timesheets_from_events)
    o = table(spark, sf, "orders")
    smn = employee_classification(bronze_master_smn(o), order_by=["o_orderkey"])
    awards = classification_awards(cohort_mappings(smn), "1998-12-01", "Region 2014 EA", "Region 2017 EA")
    first = o.filter("o_custkey % 5 = 0").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).cast("timestamp_ntz").alias("StartDate"))
    overrides = first.select(F.col("o_custkey").cast("string").alias("EmployeeCode"), "StartDate", F.lit("Award 2014 level 2").alias("Classification"))
    out = classification_final(awards, overrides, timesheets_from_events(table(spark, sf, "events")), "EA 2014", ["Award 2017"])
    return out.select("EmployeeCode", "StartDate", "EndDate", "Award", "Classification")


STATUS_MAPPING = {"Full Time": "FullTime", "Part Time": "PartTime"}


@register("build_employment_type", """
WITH b AS (SELECT CAST(o_custkey AS VARCHAR) AS EmployeeCode, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d,
                  CASE o_orderstatus WHEN 'F' THEN 'Full Time' WHEN 'O' THEN 'Part Time' ELSE 'Casual Staff' END AS es,
                  CASE WHEN o_custkey % 7 = 0 THEN TIMESTAMP '2001-12-31' END AS term,
                  CAST(o_orderkey + 2 AS VARCHAR) AS rn, o_orderkey FROM orders),
f AS (SELECT *, CASE WHEN lag(o_orderkey) OVER w IS NULL
                       OR es <> lag(es) OVER w
                       OR term IS NULL OR lag(term) OVER w IS NULL OR term <> lag(term) OVER w THEN 1 ELSE 0 END AS chg
      FROM b WINDOW w AS (PARTITION BY EmployeeCode ORDER BY d, o_orderkey)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY EmployeeCode ORDER BY d, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
             row_number() OVER (PARTITION BY EmployeeCode ORDER BY d, o_orderkey) AS pos FROM f),
firsts AS (SELECT EmployeeCode, run, rn, min(pos) AS pos FROM r GROUP BY ALL),
g AS (SELECT EmployeeCode, run, first(es ORDER BY pos) AS es, first(term ORDER BY pos) AS term, min(d) AS StartDate
      FROM r GROUP BY ALL),
src AS (SELECT EmployeeCode, run, '{''masterPOS:row:'': [' || string_agg('''' || rn || '''', ', ' ORDER BY pos) || ']}' AS Source
        FROM firsts GROUP BY ALL),
e AS (SELECT g.*, lead(StartDate) OVER (PARTITION BY EmployeeCode ORDER BY run) AS nxt FROM g)
SELECT e.EmployeeCode, StartDate,
       CASE WHEN nxt IS NULL THEN coalesce(term, TIMESTAMP '2262-04-11 23:47:16.854775') ELSE nxt END AS EndDate,
       CASE es WHEN 'Full Time' THEN 'FullTime' WHEN 'Part Time' THEN 'PartTime' ELSE es END AS EmploymentType,
       src.Source, 'masterPOS.xlsx' AS source_file
FROM e JOIN src USING (EmployeeCode, run) WHERE CAST(e.EmployeeCode AS BIGINT) % 4 <> 1
""")
def q_build_employment_type(spark, sf):
    from effdated.plans.datasets import bronze_master_pos, employment_type
    staged, _violations = employment_type(bronze_master_pos(table(spark, sf, "orders")), STATUS_MAPPING,
                                          order_by=["o_orderkey"], master_smn=_in_scope(spark, sf))
    return staged


def _in_scope(spark, sf):
    """masterSMN of the employees in scope, for the builds' F3."""
    from effdated.plans.datasets import bronze_master_smn, employee_classification
    return employee_classification(bronze_master_smn(table(spark, sf, "orders").filter("o_custkey % 4 <> 1")), order_by=["o_orderkey"])


@register("build_employment_type_inscope", """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS EmployeeCode, 'Casual Staff' AS EmploymentType FROM orders
WHERE o_orderstatus NOT IN ('F', 'O')
""")
def q_build_employment_type_inscope(spark, sf):
    from effdated.plans.datasets import bronze_master_pos, employment_type
    _staged, bad = employment_type(bronze_master_pos(table(spark, sf, "orders")), STATUS_MAPPING,
                                   order_by=["o_orderkey"])
    return bad.select("EmployeeCode", "EmploymentType").distinct()


@register("build_employee_base", """
SELECT CAST(c_custkey AS VARCHAR) AS EmployeeCode,
       CAST(make_date(1995, CAST(c_nationkey % 12 + 1 AS INTEGER), 1) AS TIMESTAMP) AS StartDate,
       coalesce(CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP '2002-06-30' END, TIMESTAMP '2262-04-11 23:47:16.854775') AS EndDate,
       CAST(make_date(CAST(1950 + c_nationkey AS INTEGER), 3, 15) AS TIMESTAMP) AS DateOfBirth,
       '{''masterEMP:row:'': [''' || CAST(c_custkey + 1 AS VARCHAR) || ''']}' AS Source, 'masterEMP.xlsx' AS source_file
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
""")
def q_build_employee_base(spark, sf):
    from effdated.plans.datasets import bronze_master_emp, bronze_master_smn, employee_base, employee_classification
    smn = employee_classification(bronze_master_smn(table(spark, sf, "orders")), order_by=["o_orderkey"])
    return employee_base(bronze_master_emp(table(spark, sf, "customer")), smn)


@register("build_pay_codes", f"""
WITH {_SMN_SQL},
ps AS (SELECT CAST(o_custkey AS VARCHAR) AS EmployeeCode, o_orderdate AS PeriodStart,
              o_orderdate + INTERVAL 14 DAY AS PeriodEnd, l_returnflag || l_linestatus AS PayCode,
              l_linestatus AS PayCategory, CASE WHEN l_returnflag = 'N' THEN '1' ELSE '0' END AS base,
              'Code ' || l_returnflag || l_linestatus AS ClientPayCodeDescription
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
j AS (SELECT ps.* FROM ps JOIN smn ON ps.EmployeeCode = smn.EmployeeCode
      AND ps.PeriodStart >= smn.StartDate AND ps.PeriodEnd <= smn.EndDate)
SELECT ClientPayCodeDescription, max(PayCode) AS PayCode, max(PayCategory) AS PayCategory,
       CASE max(base) WHEN '1' THEN 'True' WHEN '0' THEN 'False' END AS "Is Base Hours?",
       'False' AS IsPartOfOrdinaryTimeEarnings, 'False' AS IsPartOfTotalSalary, 'False' AS IsSubjectToPayrollTax,
       'False' AS IsBonusOrCommission, 'False' AS IsPartOfLslBase
FROM j GROUP BY ClientPayCodeDescription
""")
def q_build_pay_codes(spark, sf):
    from effdated.plans.datasets import bronze_master_smn, employee_classification, pay_codes, staged_payslips
    smn = employee_classification(bronze_master_smn(table(spark, sf, "orders")), order_by=["o_orderkey"])
    staged = staged_payslips(table(spark, sf, "lineitem"), table(spark, sf, "orders"))
    return pay_codes(staged, smn, ["PeriodStart", "Source"])


@register("build_attributes_over_time", """
WITH t AS (SELECT CAST(user_id AS VARCHAR) AS EmployeeCode, ts AS ClockedIn,
                  ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS ClockedOut,
                  event_type || ', k' || json_extract_string(props, '$.k') AS attr FROM events WHERE value > 100),
s AS (SELECT EmployeeCode, ClockedIn, ClockedOut, trim(unnest(string_split(attr, ','))) AS v,
             generate_subscripts(string_split(attr, ','), 1) AS pos FROM t)
SELECT EmployeeCode, ClockedIn, ClockedOut, 'Location Attribute' AS "Key", v AS "Value",
       CAST(pos AS BIGINT) AS attribute_position,
       '{"Key":"Location Attribute","Value":"' || v || '"}' AS Attribute
FROM s WHERE v <> ''
""")
def q_build_attributes_over_time(spark, sf):
    from effdated.plans.datasets import attributes_over_time_build, timesheets_from_events
    return attributes_over_time_build(timesheets_from_events(table(spark, sf, "events")), "EA 2014")


@register("build_setoff_strategy", """
SELECT CAST(c_custkey AS VARCHAR) AS EmployeeCode,
       CAST(make_date(1995, CAST(c_nationkey % 12 + 1 AS INTEGER), 1) AS TIMESTAMP) AS StartDate,
       coalesce(CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP '2002-06-30' END, TIMESTAMP '2262-04-11 23:47:16.854775') AS EndDate,
       'Financial Year Cross Pay Category' AS StrategyName
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
""")
def q_build_setoff_strategy(spark, sf):
    from effdated.plans.datasets import (bronze_master_emp, bronze_master_smn, employee_base,
                                         employee_classification, setoff_strategy)
    smn = employee_classification(bronze_master_smn(table(spark, sf, "orders")), order_by=["o_orderkey"])
    return setoff_strategy(employee_base(bronze_master_emp(table(spark, sf, "customer")), smn), smn)


@register("build_rates_over_time", """
WITH b AS (SELECT CAST(o_custkey AS VARCHAR) AS EmployeeCode, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d,
                  CAST(floor(o_totalprice / 100000) * 5 + 20 AS DOUBLE) AS rate,
                  CASE WHEN o_custkey % 10 <> 0 THEN TIMESTAMP '2002-12-31' END AS term,
                  CAST(o_orderkey + 2 AS VARCHAR) AS rn, o_orderkey FROM orders),
f AS (SELECT *, CASE WHEN lag(o_orderkey) OVER w IS NULL OR rate <> lag(rate) OVER w
                       OR term IS NULL OR lag(term) OVER w IS NULL OR term <> lag(term) OVER w THEN 1 ELSE 0 END AS chg
      FROM b WINDOW w AS (PARTITION BY EmployeeCode ORDER BY d, o_orderkey)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY EmployeeCode ORDER BY d, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
             row_number() OVER (PARTITION BY EmployeeCode ORDER BY d, o_orderkey) AS pos FROM f),
firsts AS (SELECT EmployeeCode, run, rn, min(pos) AS pos FROM r GROUP BY ALL),
g AS (SELECT EmployeeCode, run, first(rate ORDER BY pos) AS BaseRate, first(term ORDER BY pos) AS term,
             min(d) AS StartDate FROM r GROUP BY ALL),
src AS (SELECT EmployeeCode, run, '{''rates:row:'': [' || string_agg('''' || rn || '''', ', ' ORDER BY pos) || ']}' AS Source
        FROM firsts GROUP BY ALL),
e AS (SELECT g.*, lead(StartDate) OVER (PARTITION BY EmployeeCode ORDER BY run) AS nxt FROM g)
SELECT e.EmployeeCode, StartDate,
       CASE WHEN nxt IS NULL THEN coalesce(term, TIMESTAMP '2262-04-11 23:47:16.854775') ELSE nxt END AS EndDate, BaseRate,
       src.Source, 'rates.xlsx' AS source_file
FROM e JOIN src USING (EmployeeCode, run) WHERE CAST(e.EmployeeCode AS BIGINT) % 4 <> 1
""")
def q_build_rates_over_time(spark, sf):
    from effdated.plans.datasets import bronze_hourly_rates, rates_over_time
    return rates_over_time(bronze_hourly_rates(table(spark, sf, "orders")), order_by=["o_orderkey"], master_smn=_in_scope(spark, sf))


@register("build_leave", f"""
WITH {_SMN_SQL},
t AS (SELECT CAST(user_id AS VARCHAR) AS EmployeeCode, ts AS ClockedIn,
             ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS ClockedOut,
             CAST(value / 60 AS VARCHAR) AS net, 'timesheets:row:' || CAST(event_id + 2 AS VARCHAR) AS Source
      FROM events WHERE event_type IN ('view', 'signup')),
j AS (SELECT t.*, smn.StartDate, smn.EndDate,
             t.Source || '|' || strftime(smn.StartDate, '%Y-%m-%d %H:%M:%S') AS rid
      FROM t JOIN smn ON t.EmployeeCode = smn.EmployeeCode
       AND (t.ClockedIn BETWEEN smn.StartDate AND smn.EndDate OR t.ClockedOut BETWEEN smn.StartDate AND smn.EndDate)),
m AS (SELECT *, max(ClockedOut) OVER (PARTITION BY EmployeeCode ORDER BY ClockedIn, ClockedOut, rid
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pme FROM j),
s AS (SELECT *, CASE WHEN pme IS NULL OR ClockedIn >= pme THEN 1 ELSE 0 END AS st FROM m),
i AS (SELECT *, sum(st) OVER (PARTITION BY EmployeeCode ORDER BY ClockedIn, ClockedOut, rid
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM s),
l AS (SELECT *, row_number() OVER (PARTITION BY EmployeeCode, isl ORDER BY ClockedOut - ClockedIn DESC, ClockedIn, rid) AS lg
      FROM i),
k AS (SELECT *, CASE WHEN CAST(year(ClockedOut) + CASE WHEN month(ClockedOut) >= 7 THEN 1 ELSE 0 END AS INTEGER)
                          BETWEEN 2016 AND 2025
                     THEN CAST(year(ClockedOut) + CASE WHEN month(ClockedOut) >= 7 THEN 1 ELSE 0 END AS INTEGER) END AS fy
      FROM l WHERE lg = 1),
rk AS (SELECT *, row_number() OVER (PARTITION BY EmployeeCode, fy ORDER BY ClockedIn, rid) AS leave_rank FROM k),
lv AS (SELECT EmployeeCode, ClockedIn, ClockedIn + to_hours(CAST(trunc(CAST(net AS DOUBLE)) AS BIGINT)) AS ClockedOut,
              fy AS "financial year", CAST(leave_rank AS BIGINT) AS leave_rank,
              CASE WHEN leave_rank <= 2 THEN 'Personal leave with evidence' ELSE 'Annual leave' END AS pc,
              '{{''timesheets:row:'': [''' || substr(Source, 16) || ''']}}' AS Source, StartDate, EndDate
       FROM rk),
easter AS (SELECT DISTINCT EmployeeCode, CAST(DATE '2024-03-30' AS TIMESTAMP) AS ClockedIn,
                  'Manually Added Easter Saturday' AS Source
           FROM smn WHERE DATE '2024-03-30' BETWEEN CAST(StartDate AS DATE) AND CAST(EndDate AS DATE))
SELECT EmployeeCode, ClockedIn, ClockedOut, "financial year", leave_rank, pc AS "{'Paycode (under 14/17 EA)'}",
       pc AS LeaveType, Source, StartDate, EndDate FROM lv
UNION ALL SELECT EmployeeCode, ClockedIn, NULL, NULL, NULL, NULL, NULL, Source, NULL, NULL FROM easter
""")
def q_build_leave(spark, sf):
    from effdated.plans.datasets import (PAYCODE_COL, bronze_master_smn, employee_classification, leave,
                                         timesheet_leave_rows)
    smn = employee_classification(bronze_master_smn(table(spark, sf, "orders")), order_by=["o_orderkey"])
    ts = timesheet_leave_rows(table(spark, sf, "events"))
    easter = spark.createDataFrame([("2024-03-30",)], "day string")
    out = leave(ts, smn, smn, easter, 2016, 2025, 2)
    return out.select("EmployeeCode", "ClockedIn", "ClockedOut", "financial year", "leave_rank", PAYCODE_COL,
                      "LeaveType", "Source", "StartDate", "EndDate")


@register("build_timesheets", f"""
WITH {_SMN_SQL},
t AS (SELECT CAST(ev.user_id AS VARCHAR) AS EmployeeCode, ev.ts AS ClockedIn,
             ev.ts + to_seconds(CAST(round(ev.value * 60) AS BIGINT)) AS ClockedOut, ev.value / 100 AS brk_h,
             n.n_name AS Region, 'timesheets:row:' || CAST(ev.event_id + 2 AS VARCHAR) AS Source
      FROM events ev LEFT JOIN customer c ON ev.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
      WHERE ev.event_type NOT IN ('view', 'signup')),
j AS (SELECT t.*, smn.StartDate, smn.Classification, t.Source || '|' || strftime(smn.StartDate, '%Y-%m-%d %H:%M:%S') AS rid
      FROM t JOIN smn ON t.EmployeeCode = smn.EmployeeCode
       AND (t.ClockedIn BETWEEN smn.StartDate AND smn.EndDate OR t.ClockedOut BETWEEN smn.StartDate AND smn.EndDate)),
tm AS (SELECT *, max(ClockedOut) OVER (PARTITION BY EmployeeCode ORDER BY ClockedIn, ClockedOut, rid
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pme FROM j),
ts1 AS (SELECT *, CASE WHEN pme IS NULL OR ClockedIn >= pme THEN 1 ELSE 0 END AS st FROM tm),
ti AS (SELECT *, sum(st) OVER (PARTITION BY EmployeeCode ORDER BY ClockedIn, ClockedOut, rid
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM ts1),
tl AS (SELECT *, row_number() OVER (PARTITION BY EmployeeCode, isl ORDER BY ClockedOut - ClockedIn DESC, ClockedIn, rid) AS lg
      FROM ti),
tk AS (SELECT EmployeeCode, ClockedIn, ClockedOut, brk_h, Region, Source, Classification, rid,
             brk_h * 3600 AS secs, date_diff('second', ClockedIn, ClockedOut) AS shift_secs FROM tl WHERE lg = 1),
bk AS (SELECT *, CASE WHEN secs > 0 THEN CAST(trunc(secs) AS BIGINT) END AS break_seconds FROM tk),
cm AS (SELECT *, max(ClockedOut) OVER (PARTITION BY EmployeeCode ORDER BY ClockedIn, ClockedOut, rid
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cpme FROM bk),
cs AS (SELECT *, CASE WHEN cpme IS NULL OR ClockedIn >= cpme + INTERVAL 4 HOUR THEN 1 ELSE 0 END AS cst FROM cm),
ci AS (SELECT *, sum(cst) OVER (PARTITION BY EmployeeCode ORDER BY ClockedIn, ClockedOut, rid
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS shift_index,
              row_number() OVER (PARTITION BY EmployeeCode ORDER BY ClockedIn, ClockedOut, rid) AS pos,
              CAST(CASE WHEN cst = 0 AND ClockedIn > cpme THEN (epoch_us(ClockedIn) - epoch_us(cpme)) // 1000000 ELSE 0 END AS BIGINT)
                AS unpaid FROM cs),
firsts AS (SELECT EmployeeCode, shift_index, Source, min(pos) AS pos FROM ci GROUP BY ALL),
src AS (SELECT EmployeeCode, shift_index,
               '{{''timesheets:row:'': [' || string_agg('''' || substr(Source, 16) || '''', ', ' ORDER BY pos) || ']}}' AS Source
        FROM firsts GROUP BY ALL),
tg AS (SELECT EmployeeCode, shift_index, min(ClockedIn) AS ClockedIn, max(ClockedOut) AS ClockedOut,
             first(Classification ORDER BY pos) AS Classification, first(Region ORDER BY pos) AS Region,
             CAST(sum(unpaid) AS BIGINT) AS unpaid_break_seconds, CAST(sum(break_seconds) AS BIGINT) AS break_seconds,
             CAST(count(*) AS BIGINT) AS pieces
      FROM ci GROUP BY ALL),
gw AS (SELECT tg.*, pieces > 1 AS brk, EmployeeCode || '|' || CAST(shift_index AS VARCHAR) AS sid,
              CAST(weekofyear(ClockedIn) AS INTEGER) AS week_number, CAST(isodow(ClockedIn) - 1 AS INTEGER) AS week_day,
              CAST(isoyear(ClockedIn) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(ClockedIn) AS VARCHAR), 2, '0') AS week_info
       FROM tg),
w10 AS (SELECT *, row_number() OVER (PARTITION BY EmployeeCode, isoyear(ClockedIn) * 100 + weekofyear(ClockedIn), brk
                                     ORDER BY ClockedIn, sid) AS rk FROM gw),
hol AS (SELECT * FROM (VALUES ('ALL', 'New Year', DATE '2024-01-01'), ('NATION_1', 'Founding Day', DATE '2024-01-06'),
                            ('NATION_2', 'Harvest Day', DATE '2024-01-14'), ('NATION_3', 'Regional Day', DATE '2024-01-26'))
      hv(region, holiday_name, holiday_date)),
cal AS (SELECT region, holiday_name, holiday_date, false AS is_additional_holiday FROM hol
        UNION ALL SELECT region, holiday_name, holiday_date + CASE WHEN dayofweek(holiday_date) = 6 THEN 2 ELSE 1 END, true
        FROM hol WHERE dayofweek(holiday_date) IN (0, 6))
SELECT w10.EmployeeCode, shift_index, ClockedIn, ClockedOut, Classification, w10.Region, unpaid_break_seconds, break_seconds,
       pieces, brk AND rk = 1 AS is_Broken_Shift, week_number, week_day, week_info,
       cal.region AS holiday_regions, holiday_name, CAST(holiday_date AS TIMESTAMP) AS holiday_date, is_additional_holiday,
       CASE WHEN holiday_date IS NOT NULL THEN (SELECT count(DISTINCT CAST(p.ClockedIn AS DATE)) FROM gw p WHERE p.EmployeeCode = w10.EmployeeCode
         AND CAST(p.ClockedIn AS DATE) < CAST(w10.ClockedIn AS DATE) AND CAST(p.ClockedIn AS DATE) >= CAST(w10.ClockedIn AS DATE) - 182) / 182.0 END
         AS worked_percentage_in_last_6_month, src.Source
FROM w10 JOIN src USING (EmployeeCode, shift_index)
LEFT JOIN cal ON CAST(w10.ClockedIn AS DATE) = cal.holiday_date AND (cal.region = w10.Region OR cal.region = 'ALL')
""")
def q_build_timesheets(spark, sf):
    from effdated.plans.datasets import bronze_master_smn, employee_classification, timesheet_rows, timesheets
    from effdated.plans.q_shifts import HOLIDAYS
    smn = employee_classification(bronze_master_smn(table(spark, sf, "orders")), order_by=["o_orderkey"])
    ts = timesheet_rows(table(spark, sf, "events"), table(spark, sf, "customer"), table(spark, sf, "nation"))
    hol = spark.createDataFrame(HOLIDAYS, "region string, holiday_name string, holiday_date string") \
        .withColumn("holiday_date", F.col("holiday_date").cast("date"))
    out = timesheets(ts, smn, hol)
    return out.select("EmployeeCode", F.col("shift_index").cast("bigint").alias("shift_index"), "ClockedIn", "ClockedOut",
                      "Classification", "Region", F.col("unpaid_break_seconds").cast("bigint").alias("unpaid_break_seconds"),
                      F.col("break_seconds").cast("bigint").alias("break_seconds"),
                      F.col("pieces").cast("bigint").alias("pieces"), "is_Broken_Shift", "week_number", "week_day",
                      "week_info", "worked_percentage_in_last_6_month", "holiday_regions", "holiday_name",
                      F.col("holiday_date").cast("timestamp_ntz").alias("holiday_date"), "is_additional_holiday", "Source")


@register("timesheet_exceptions", """
WITH t AS (SELECT event_id, user_id, ts, ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS te, 'timesheets:row:' || CAST(event_id + 2 AS VARCHAR) AS src, n_name AS region
           FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT *, max(te) OVER (PARTITION BY user_id ORDER BY ts, te ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM t),
i AS (SELECT *, count(*) FILTER (reach IS NULL OR ts >= reach) OVER (PARTITION BY user_id ORDER BY ts, te ROWS UNBOUNDED PRECEDING) AS isl FROM m)
SELECT 'timesheets' AS dataset, 'non_overlapping' AS test, NULL AS "column", NULL AS value, '{"Source":"' || src || '"}' AS key FROM i QUALIFY count(*) OVER (PARTITION BY user_id, isl) > 1
UNION ALL SELECT 'timesheets', 'shift_length', NULL, NULL, '{"Source":"' || src || '"}' FROM t WHERE date_diff('second', ts, te) > 6 * 3600
UNION ALL SELECT 'timesheets', 'end_before_start', NULL, NULL, '{"Source":"' || src || '"}' FROM t WHERE te < ts
UNION ALL SELECT 'timesheets', 'inscope_region', 'Region', region, '{"Source":"' || src || '"}' FROM t WHERE region IS NOT NULL AND region NOT IN (SELECT n_name FROM nation WHERE n_nationkey < 20)
""")
def q_timesheet_exceptions(spark, sf):
    from effdated.plans.datasets import timesheet_exceptions, timesheet_rows
    n = table(spark, sf, "nation")
    ts = timesheet_rows(table(spark, sf, "events"), table(spark, sf, "customer"), n)
    return timesheet_exceptions(ts, n.filter("n_nationkey < 20").select("n_name"), max_hours=6.0)
