"""Columns, filters, joins, reshapes and aggregations on the driver tables
(P*, F*, J*, R*, A*, W4/W5, T7/T8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from effdated.functions import columns as cl
from effdated.functions import dates as dt
from effdated.functions import types as ty
from effdated.operators import aggregate as ag
from effdated.operators import filters as fl
from effdated.operators import intervals as iv
from effdated.operators import joins as jn
from effdated.operators import reshape as rs
from effdated.plans.driver_queries import hot_keys, register, table
from effdated.plans.q_intervals import _EVENTS_SQL, events_periods

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

_FY_SQL = "CAST(year({d}) + CASE WHEN month({d}) >= 7 THEN 1 ELSE 0 END AS INTEGER)"


def fy_sql(d: str) -> str:
    return _FY_SQL.format(d=d)


# ---------------------------------------------------------------- P22
@register("financial_year", f"""
SELECT o_orderkey, {fy_sql('o_orderdate')} AS fy,
       CASE WHEN {fy_sql('o_orderdate')} BETWEEN 1997 AND 2000 THEN {fy_sql('o_orderdate')} END AS fy_in_scope
FROM orders
""")
def q_financial_year(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    o = o.withColumn("fy", dt.financial_year("o_orderdate"))
    o = dt.matching_financial_year(o, "o_orderdate", 1997, 2000, out="fy_in_scope")
    return o.select("o_orderkey", "fy", "fy_in_scope")


# ---------------------------------------------------------------- T7 / T8 / W4
_ATTR_SQL = """
years AS (SELECT y, make_date(y - 1, 7, 1) AS first_day, make_date(y, 6, 30) AS last_day
          FROM (SELECT CAST(unnest(range(1995, 2003)) AS INTEGER) AS y)),
dated AS (SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) - 30 AS valid_from,
                 CAST(o_orderdate AS DATE) + 200 AS valid_to FROM orders),
graded AS (SELECT o_custkey, o_orderpriority, y, valid_from, valid_to,
                  CASE WHEN valid_to >= first_day AND valid_to <= last_day THEN 1
                       WHEN valid_from >= first_day AND valid_from <= last_day THEN 2 ELSE 3 END AS grade
           FROM dated, years WHERE valid_from <= last_day AND valid_to >= first_day),
resolved AS (SELECT o_custkey, CAST(y AS VARCHAR) AS fy,
                    first(o_orderpriority ORDER BY grade, valid_from DESC, valid_to DESC, o_orderpriority) AS o_orderpriority
             FROM graded GROUP BY o_custkey, y)"""


def _resolved(spark, sf):
    o = table(spark, sf, "orders")
    attrs = o.select("o_custkey", "o_orderpriority",
                     F.col("o_orderdate").cast("date").alias("effective_from"),
                     F.col("o_orderdate").cast("date").alias("effective_to"))
    attrs = iv.widen(attrs, "effective_from", "effective_to", 30, 200)
    attrs = attrs.withColumns({"effective_from": F.col("effective_from").cast("date"),
                               "effective_to": F.col("effective_to").cast("date")})
    fy = rs.financial_year_rules(spark, 1995, 2002)
    return iv.resolve_by_period(attrs, "o_custkey", "effective_from", "effective_to",
                                ["o_orderpriority"], fy)


@register("fy_rule_resolution", f"WITH {_ATTR_SQL} SELECT * FROM resolved")
def q_fy_rule_resolution(spark, sf):
    return _resolved(spark, sf)


@register("latest_fy_attribute", f"""
WITH {_ATTR_SQL}
SELECT o_custkey, max(fy) AS fy, last(o_orderpriority ORDER BY fy) AS o_orderpriority FROM resolved GROUP BY o_custkey
""")
def q_latest_fy_attribute(spark, sf):
    return iv.latest_per_key(_resolved(spark, sf), "o_custkey", "fy", ["o_orderpriority"])


# ---------------------------------------------------------------- J9 + JSON
@register("json_attribute_explode", """
WITH a AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS StartDate,
                  strftime(o_orderdate + INTERVAL 90 DAY, '%Y-%m-%d') AS EndDate,
                  'state' AS k, CASE WHEN o_orderpriority = '5-LOW' THEN 'ACT' ELSE o_orderpriority END AS v
           FROM orders)
SELECT o_custkey,
       row_number() OVER (PARTITION BY o_custkey ORDER BY StartDate, EndDate, k, v) AS position,
       CAST(StartDate AS TIMESTAMP) AS effective_from, CAST(EndDate AS TIMESTAMP) AS effective_to,
       k AS ref, v AS region
FROM a
""")
def q_json_attribute_explode(spark, sf):
    o = table(spark, sf, "orders")
    item = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("StartDate"),
                    F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(90)), "yyyy-MM-dd").alias("EndDate"),
                    F.struct(F.lit("state").alias("Key"),
                             F.when(F.col("o_orderpriority") == "5-LOW", F.lit("National"))
                             .otherwise(F.col("o_orderpriority")).alias("Value")).alias("Value"))
    emp = o.groupBy("o_custkey").agg(F.to_json(F.array_sort(F.collect_list(item))).alias("attributes_over_time"))
    ex = jn.explode_json_array(emp, "attributes_over_time", "StartDate:string,EndDate:string,Value:string")
    val = F.from_json(F.col("item.Value"), "Key string, Value string")
    ex = ex.withColumn("_v", val)
    region = F.when(F.col("_v.Value") == "National", F.lit("ACT")).otherwise(F.col("_v.Value"))
    return ex.filter(F.col("_v.Key") == "state").select(
        "o_custkey", F.col("position").cast("bigint").alias("position"),
        F.col("item.StartDate").cast("date").cast("timestamp_ntz").alias("effective_from"),
        F.col("item.EndDate").cast("date").cast("timestamp_ntz").alias("effective_to"),
        F.col("_v.Key").alias("ref"), region.alias("region"))


@register("json_props_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_props_extract(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


# ---------------------------------------------------------------- R2 / A9 / R1
def _supplier_wide(spark, sf):
    li = table(spark, sf, "lineitem")
    amt = F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))
    qty = F.sum(F.col("l_quantity").cast("decimal(18,2)"))
    return (li.groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"])
            .agg(amt.alias("(Amt)"), qty.alias("(Qty)")))


@register("melt_keyword", """
SELECT l_suppkey, l_returnflag AS pay_code,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Amount,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS Quantity
FROM lineitem GROUP BY l_suppkey, l_returnflag
""")
def q_melt_keyword(spark, sf):
    wide = _supplier_wide(spark, sf)  # columns like "A_(Amt)", "A_(Qty)"
    out = rs.melt_keyword(wide, ["l_suppkey"], {"Amount": "_(Amt)", "Quantity": "_(Qty)"}, "pay_code", dropna=True)
    return out.select("l_suppkey", "pay_code", F.col("Amount").cast("double").alias("Amount"),
                      F.col("Quantity").cast("double").alias("Quantity"))


@register("melt_aggregate", """
SELECT c_nationkey, l_returnflag AS pay_code,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Amount,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS Quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
     JOIN (SELECT c_nationkey FROM customer GROUP BY c_nationkey) c ON c.c_nationkey = s_nationkey
GROUP BY c_nationkey, l_returnflag
""")
def q_melt_aggregate(spark, sf):
    wide = _supplier_wide(spark, sf)
    sup = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                              F.col("s_nationkey").alias("c_nationkey"))
    nat = table(spark, sf, "customer").select("c_nationkey").distinct()
    wide = wide.join(sup, "l_suppkey").join(nat, "c_nationkey", "left_semi")
    out = rs.melt_keyword(wide, ["c_nationkey"], {"Amount": "_(Amt)", "Quantity": "_(Qty)"}, "pay_code",
                          aggregate_rows=True, dropna=True)
    return out.select("c_nationkey", "pay_code", F.col("Amount").cast("double").alias("Amount"),
                      F.col("Quantity").cast("double").alias("Quantity"))


_YEARS = [str(y) for y in range(2015, 2022)]


@register("unpivot_rates", """
WITH w AS (SELECT n_name AS region, """ + ", ".join(
    f"CAST(CAST(n_nationkey AS DECIMAL(10,4)) * {y - 2014} / 100 AS DECIMAL(10,4)) AS \"{y}\""
    for y in range(2015, 2022)) + """ FROM nation)
SELECT region, fy, CAST(rate AS DOUBLE) AS tax_rate FROM w
UNPIVOT (rate FOR fy IN (""" + ", ".join(f'"{y}"' for y in _YEARS) + "))")
def q_unpivot_rates(spark, sf):
    n = table(spark, sf, "nation")
    wide = n.select(F.col("n_name").alias("region"), *[
        (F.col("n_nationkey").cast("decimal(10,4)") * F.lit(int(y) - 2014) / F.lit(100)).cast("decimal(10,4)").alias(y)
        for y in _YEARS])
    long = rs.unpivot(wide, ["region"], _YEARS, "fy", "rate")
    return long.select("region", "fy", F.col("rate").cast("double").alias("tax_rate"))


# ---------------------------------------------------------------- A8 / R4 / R5
_CT_SQL = ", ".join(
    f"CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '{p}') AS DOUBLE) AS \"{p}_total\", "
    f"CAST(count(o_orderkey) FILTER (WHERE o_orderpriority = '{p}') AS BIGINT) AS \"{p}_orders\""
    for p in PRIORITIES)


@register("crosstab_struct", f"""
SELECT o_custkey, CAST({fy_sql('o_orderdate')} AS VARCHAR) AS fy, {_CT_SQL}
FROM orders GROUP BY o_custkey, fy
""")
def q_crosstab_struct(spark, sf):
    o = table(spark, sf, "orders").withColumn("fy", dt.financial_year("o_orderdate").cast("string"))
    ct = ag.crosstab(o, ["o_custkey", "fy"], "o_orderpriority", PRIORITIES,
                     {"total": F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"),
                      "orders": F.count("o_orderkey")})
    out = ag.expand_cells(ct, ["o_custkey", "fy"], PRIORITIES, ["total", "orders"])
    # absent category -> null struct; counts of an absent category are 0 in SQL
    return out.withColumns({f"{p}_orders": F.coalesce(F.col(f"`{p}_orders`"), F.lit(0)).cast("bigint")
                            for p in PRIORITIES})


# ---------------------------------------------------------------- A2-A6 / F8 / F9
_VAR = "CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(l_tax AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2)))"
_BUCKET = "('R', 'A')"


def _line_variance(spark, sf):
    li = table(spark, sf, "lineitem")
    var = F.col("l_extendedprice").cast("decimal(18,2)") * (
        F.col("l_tax").cast("decimal(18,2)") - F.col("l_discount").cast("decimal(18,2)"))
    return li.withColumn("variance", var).withColumn("fy", dt.financial_year("l_shipdate"))


@register("filtered_sums", f"""
SELECT l_suppkey, {fy_sql('l_shipdate')} AS fy,
  CAST(COALESCE(sum({_VAR}) FILTER (WHERE l_returnflag IN {_BUCKET}), 0) AS DOUBLE) AS ote_variance,
  CAST(COALESCE(sum({_VAR}) FILTER (WHERE l_returnflag NOT IN {_BUCKET}), 0) AS DOUBLE) AS non_ote_variance,
  CAST(COALESCE(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag IN {_BUCKET}), 0) AS DOUBLE) AS ote_actual
FROM lineitem GROUP BY l_suppkey, fy
""")
def q_filtered_sums(spark, sf):
    li = _line_variance(spark, sf)
    in_b = F.col("l_returnflag").isin("R", "A")
    return li.groupBy("l_suppkey", "fy").agg(
        ag.filtered_sum("variance", in_b).cast("double").alias("ote_variance"),
        ag.filtered_sum("variance", ~in_b).cast("double").alias("non_ote_variance"),
        ag.filtered_sum(F.col("l_extendedprice").cast("decimal(18,2)"), in_b).cast("double").alias("ote_actual"))


@register("pos_neg_parts", f"""
SELECT l_suppkey, {fy_sql('l_shipdate')} AS fy,
  CAST(sum(greatest({_VAR}, 0)) AS DOUBLE) AS excess,
  CAST(sum(least({_VAR}, 0)) AS DOUBLE) AS shortfall,
  CAST(COALESCE(sum(least({_VAR}, 0)) FILTER (WHERE l_returnflag IN {_BUCKET}), 0) AS DOUBLE) AS ote_shortfall
FROM lineitem GROUP BY l_suppkey, fy
""")
def q_pos_neg_parts(spark, sf):
    li = _line_variance(spark, sf)
    in_b = F.col("l_returnflag").isin("R", "A")
    return li.groupBy("l_suppkey", "fy").agg(
        ag.positive_part_sum("variance").cast("double").alias("excess"),
        ag.negative_part_sum("variance").cast("double").alias("shortfall"),
        F.coalesce(ag.negative_part_sum("variance", in_b), F.lit(0)).cast("double").alias("ote_shortfall"))


@register("count_distinct_filtered", f"""
SELECT l_suppkey, CAST(count(DISTINCT l_orderkey) FILTER (WHERE {_VAR} < 0) AS BIGINT) AS n_short_orders
FROM lineitem GROUP BY l_suppkey
""")
def q_count_distinct_filtered(spark, sf):
    li = _line_variance(spark, sf)
    return li.groupBy("l_suppkey").agg(
        ag.count_distinct_where("l_orderkey", F.col("variance") < 0).cast("bigint").alias("n_short_orders"))


# ---------------------------------------------------------------- J3 / A5
@register("full_outer_rollup", f"""
WITH o AS (SELECT o_custkey AS k, CAST({fy_sql('o_orderdate')} AS VARCHAR) AS fy,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS order_total FROM orders GROUP BY ALL),
e AS (SELECT user_id AS k, CAST({fy_sql('ts')} AS VARCHAR) AS fy,
             sum(CAST(value AS DECIMAL(18,2))) AS event_total FROM events GROUP BY ALL),
c AS (SELECT c_custkey AS k, '2024' AS fy, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS balance
      FROM customer GROUP BY ALL)
SELECT k, fy, CAST(coalesce(order_total, 0) AS DOUBLE) AS order_total,
       CAST(coalesce(event_total, 0) AS DOUBLE) AS event_total,
       CAST(coalesce(balance, 0) AS DOUBLE) AS balance,
       CAST(coalesce(order_total, 0) + coalesce(event_total, 0) + coalesce(balance, 0) AS DOUBLE) AS gross
FROM o FULL JOIN e USING (k, fy) FULL JOIN c USING (k, fy)
""")
def q_full_outer_rollup(spark, sf):
    def dec(c):
        return F.col(c).cast("decimal(18,2)")
    o = (table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k"),
                                            dt.financial_year("o_orderdate").cast("string").alias("fy"))
         .agg(F.sum(dec("o_totalprice")).alias("order_total")))
    e = (table(spark, sf, "events").groupBy(F.col("user_id").alias("k"),
                                            dt.financial_year("ts").cast("string").alias("fy"))
         .agg(F.sum(dec("value")).alias("event_total")))
    c = (table(spark, sf, "customer").groupBy(F.col("c_custkey").alias("k"), F.lit("2024").alias("fy"))
         .agg(F.sum(dec("c_acctbal")).alias("balance")))
    j = jn.full_outer_chain([o, e, c], ["k", "fy"])
    z = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("order_total", "event_total", "balance")}
    return j.select("k", "fy", *[v.cast("double").alias(k) for k, v in z.items()],
                    (z["order_total"] + z["event_total"] + z["balance"]).cast("double").alias("gross"))


# ---------------------------------------------------------------- J5 / J6 / F7
_PERIODS_SQL = f"""
e AS ({_EVENTS_SQL}),
f AS (SELECT *, CASE WHEN lag(event_id) OVER w IS NULL OR event_type IS NULL
                       OR lag(event_type) OVER w IS NULL OR event_type <> lag(event_type) OVER w
                     THEN 1 ELSE 0 END AS chg
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f),
g AS (SELECT user_id, run, max(event_type) AS period_type, min(ts) AS StartDate FROM r GROUP BY ALL),
p AS (SELECT user_id, period_type, StartDate,
             coalesce(lead(StartDate) OVER (PARTITION BY user_id ORDER BY run),
                      TIMESTAMP '{dt.MAX_DATE}') AS EndDate FROM g)"""


def _event_periods(spark, sf):
    e = events_periods(spark, sf)
    p = iv.flatten_effective_date(e, "user_id", "event_type", "ts",
                                  {"event_type": "first", "ts": "min"}, order_by=["event_id"])
    p = dt.fill_null_with_max_date(p, "EndDate")
    return e, p.withColumnRenamed("event_type", "period_type")


@register("interval_join_either_end", f"""
WITH {_PERIODS_SQL}
SELECT e.event_id, p.user_id, p.period_type, p.StartDate, p.EndDate
FROM e JOIN p ON e.user_id = p.user_id
 AND (e.ts BETWEEN p.StartDate AND p.EndDate OR e.end_ts BETWEEN p.StartDate AND p.EndDate)
""")
def q_interval_join_either_end(spark, sf):
    e, p = _event_periods(spark, sf)
    j = jn.interval_join(e, p, "user_id", "ts", "end_ts", "StartDate", "EndDate", "either_end")
    return j.select("event_id", "user_id", "period_type", "StartDate", "EndDate")


@register("containment_join", f"""
WITH {_PERIODS_SQL}
SELECT e.event_id, p.user_id, p.period_type, p.StartDate, p.EndDate
FROM e JOIN p ON e.user_id = p.user_id AND e.ts >= p.StartDate AND e.end_ts <= p.EndDate
""")
def q_containment_join(spark, sf):
    e, p = _event_periods(spark, sf)
    j = jn.interval_join(e, p, "user_id", "ts", "end_ts", "StartDate", "EndDate", "contained")
    return j.select("event_id", "user_id", "period_type", "StartDate", "EndDate")


@register("point_in_interval", f"""
WITH fy AS (SELECT CAST(y AS VARCHAR) AS fy, make_date(CAST(y AS INTEGER) - 1, 7, 1) AS start_of_fy,
                   make_date(CAST(y AS INTEGER), 7, 1) - INTERVAL 1 DAY AS end_of_fy FROM range(1995, 2003) t(y))
SELECT o_orderkey, fy FROM orders JOIN fy ON CAST(o_orderdate AS DATE) BETWEEN start_of_fy AND end_of_fy
""")
def q_point_in_interval(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    fy = rs.financial_year_rules(spark, 1995, 2002)
    return jn.point_in_interval(o, "d", fy, "start_of_fy", "end_of_fy").select("o_orderkey", "fy")


# ---------------------------------------------------------------- F1-F6, J7
@register("semi_in_other", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def q_semi_in_other(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return fl.keep_keys_in(o, c, "o_custkey", "c_custkey")


@register("out_of_scope_anti", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
  AND o_orderstatus NOT IN ('P')
""")
def q_out_of_scope_anti(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    oos = table(spark, sf, "customer").filter(F.col("c_acctbal") < 0)
    return fl.out_of_scope_filter(o, "o_custkey", oos, "c_custkey", {"o_orderstatus": ["P"]})


@register("dedupe_keep_first", """
WITH k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                    l_returnflag, l_linestatus) AS rk FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM k WHERE rk = 1
""")
def q_dedupe_keep_first(spark, sf):
    li = table(spark, sf, "lineitem")
    d = fl.dedupe_keep_first(li, ["l_orderkey", "l_linenumber"],
                             ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                              "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@register("row_filter", """
WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority FROM orders)
SELECT * FROM o
WHERE ((status IN ('F') OR status IS NULL) AND NOT coalesce(o_orderpriority IN ('5-LOW'), false))
   OR (o_orderpriority IN ('1-URGENT'))
""")
def q_row_filter(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"),
                                          "o_orderpriority")
    return fl.row_filter(o, [
        {"col": "status", "include": {"logic": "and", "value": ["F", "nan value"]}},
        {"col": "o_orderpriority", "exclude": {"logic": "and", "value": ["5-LOW"]}},
        {"col": "o_orderpriority", "include": {"logic": "or", "value": ["1-URGENT"]}},
    ])


@register("dataset_filter", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000 AND o_orderpriority LIKE '%HIGH%'
""")
def q_dataset_filter(spark, sf):
    o = table(spark, sf, "orders")
    return fl.dataset_filter(o, "o_totalprice > 200000 AND o_orderpriority LIKE '%HIGH%'").select(
        "o_orderkey", "o_totalprice")


@register("cutover_predicate", """
WITH o AS (SELECT o_orderkey, o_orderpriority AS award, o_orderdate AS s, o_orderdate + INTERVAL 900 DAY AS e
           FROM orders),
pts AS (SELECT o_orderkey, award, s, e, TIMESTAMP '1998-01-01' AS c FROM o
        WHERE TIMESTAMP '1998-01-01' > s AND TIMESTAMP '1998-01-01' < e
        UNION ALL SELECT o_orderkey, award, s, e, s FROM o
        UNION ALL SELECT o_orderkey, award, s, e, e FROM o),
seg AS (SELECT o_orderkey, award, c AS start_date, lead(c) OVER (PARTITION BY o_orderkey ORDER BY c) AS end_date
        FROM pts)
SELECT * FROM seg WHERE end_date IS NOT NULL
  AND ((end_date <= TIMESTAMP '1998-01-01' AND award = '1-URGENT')
       OR (start_date >= TIMESTAMP '1998-01-01' AND award = '2-HIGH')
       OR contains(award, 'MEDIUM'))
""")
def q_cutover_predicate(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("award"), F.col("o_orderdate").alias("start_date"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(900))).alias("end_date"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    pieces = iv.cut_at_points(o, "start_date", "end_date", [cut])
    cond = fl.cutover_predicate("start_date", "end_date", cut, "award", "1-URGENT", "2-HIGH") | \
        fl.text_contains("award", "MEDIUM")
    return pieces.filter(cond)


# ---------------------------------------------------------------- P1-P21
@register("value_mapper", """
SELECT o_orderkey,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Urgent' WHEN o_orderpriority = '2-HIGH' THEN 'High'
       ELSE o_orderpriority END AS priority_label,
  CASE WHEN regexp_matches(o_orderpriority, '^[45]') THEN 'Low'
       WHEN regexp_matches(o_orderpriority, 'MEDIUM') THEN 'Medium' ELSE o_orderstatus END AS o_orderstatus
FROM orders
""")
def q_value_mapper(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    o = cl.value_mapper(o, {"1-URGENT": "Urgent", "2-HIGH": "High"}, "o_orderpriority", "priority_label")
    o = cl.value_mapper(o, {"^[45]": "Low", "MEDIUM": "Medium"}, "o_orderpriority", "o_orderstatus",
                        use_regex=True)
    return o.select("o_orderkey", "priority_label", "o_orderstatus")


@register("default_columns", """
SELECT c_custkey, 'client-1' AS client_id, CAST(NULL AS DOUBLE) AS amount, 'Day Worker' AS employee_status
FROM customer
""")
def q_default_columns(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    c = cl.create_columns_with_default_value(c, ["client_id"], "client-1")
    c = cl.create_columns(c, {"amount": {"value": "None", "dtype": "float64"},
                              "employee_status": {"value": "Day Worker", "dtype": "string"}})
    return c


@register("rename_cast", """
SELECT c_custkey AS EmployeeCode, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS BaseRate,
       CAST(c_nationkey AS BIGINT) AS RegionCode
FROM customer
""")
def q_rename_cast(spark, sf):
    c = table(spark, sf, "customer")
    c = cl.rename_columns(c, {"c_custkey": "EmployeeCode", "c_acctbal": "BaseRate",
                              "c_nationkey": "RegionCode", "no_such_column": "x"})
    c = ty.define_datatype(c, {"BaseRate": "decimal(18,2)", "RegionCode": "int64"})
    return c.select("EmployeeCode", F.col("BaseRate").cast("string").alias("BaseRate"), "RegionCode")


@register("surrogate_codes", """
SELECT o_orderkey, sha256(concat_ws('#', CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'))) AS payslip_code
FROM orders
""")
def q_surrogate_codes(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return cl.payslip_code(o, "payslip_code", ["o_custkey", "o_orderdate"]).select("o_orderkey", "payslip_code")


@register("date_parse_dayfirst", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS parsed,
       CAST(NULL AS TIMESTAMP) AS junk_parsed
FROM orders
""")
def q_date_parse_dayfirst(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "d/M/yyyy").alias("parsed"),
        F.concat(F.lit("day "), F.col("o_orderkey").cast("string")).alias("junk_parsed"))
    o = dt.change_date_format(o, "parsed", dayfirst=True)
    return dt.change_date_format(o, "junk_parsed", dayfirst=True, errors="coerce")


@register("add_days", """
SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY AS o_orderdate FROM orders
""")
def q_add_days(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return dt.add_n_days(o, "o_orderdate", 1)


@register("max_date_fill", f"""
WITH {_PERIODS_SQL} SELECT user_id, period_type, StartDate, EndDate FROM p
""")
def q_max_date_fill(spark, sf):
    _, p = _event_periods(spark, sf)
    return p.select("user_id", "period_type", "StartDate", "EndDate")


@register("week_parts", """
SELECT event_id, CAST(weekofyear(ts) AS INTEGER) AS week_number, CAST(isodow(ts) - 1 AS INTEGER) AS week_day,
       CAST(isoyear(ts) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') AS week_info
FROM events
""")
def q_week_parts(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    return dt.week_parts(e, "ts").select("event_id", "week_number", "week_day", "week_info")


@register("forward_fill", """
SELECT o_orderkey, o_custkey,
       last_value(nullif(o_orderstatus, 'P') IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS status
FROM orders
""")
def q_forward_fill(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                          F.expr("nullif(o_orderstatus, 'P')").alias("status"))
    return cl.forward_fill(o, ["status"], ["o_custkey"], ["o_orderdate", "o_orderkey"], hot_rows=hot_keys(spark, sf, "orders", "o_custkey")).select(
        "o_orderkey", "o_custkey", "status")


@register("fill_end_with_termination", """
WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate,
                  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + INTERVAL 30 DAY END AS end_date,
                  CASE WHEN o_custkey % 2 = 0 THEN TIMESTAMP '2002-06-30' END AS termination FROM orders),
l AS (SELECT *, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt FROM o)
SELECT o_orderkey, CASE WHEN nxt IS NULL AND end_date IS NULL
                        THEN coalesce(termination, TIMESTAMP '2262-04-11 23:47:16.854775') ELSE end_date END AS end_date
FROM l
""")
def q_fill_end_with_termination(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderstatus") == "O", F.lit(None))
        .otherwise(F.col("o_orderdate") + F.make_dt_interval(F.lit(30))).alias("end_date"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("2002-06-30").cast("timestamp_ntz")).alias("termination"))
    out = cl.fill_end_with_termination(o, "o_custkey", "o_orderdate", "end_date", "termination",
                                       order_by=["o_orderkey"], hot_rows=hot_keys(spark, sf, "orders", "o_custkey"))
    return out.select("o_orderkey", "end_date")


@register("attributes_over_time", """
SELECT c_custkey, 'Key' AS dummy_check, k AS "Key", v AS "Value",
       '{"Key":"' || k || '","Value":"' || v || '"}' AS Attribute
FROM (SELECT c_custkey, 'segment' AS k, c_mktsegment AS v FROM customer
      UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer)
""")
def q_attributes_over_time(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"),
                                            F.col("c_nationkey").cast("string").alias("nation"))
    out = cl.attributes_over_time(c, ["c_custkey"], ["segment", "nation"])
    return out.select("c_custkey", F.lit("Key").alias("dummy_check"), "Key", "Value", "Attribute")


# ---------------------------------------------------------------- A1 (simple_pandas_grouper)
@register("grouper_settings", """
WITH o AS (SELECT o_custkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority, o_totalprice, o_orderdate, o_orderkey,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos FROM orders),
u AS (SELECT o_custkey, o_orderpriority, min(pos) AS pos FROM o GROUP BY ALL)
SELECT o.o_custkey,
       arg_max(status, pos) FILTER (WHERE status IS NOT NULL) AS last_status,
       arg_min(o_orderpriority, pos) AS first_priority,
       CAST(min(o_totalprice) AS DOUBLE) AS min_price, CAST(max(o_totalprice) AS DOUBLE) AS max_price,
       CAST(count(o_orderkey) AS BIGINT) AS n_orders,
       (SELECT string_agg(o_orderpriority, '|' ORDER BY pos) FROM u WHERE u.o_custkey = o.o_custkey) AS priorities
FROM o GROUP BY o.o_custkey
""")
def q_grouper_settings(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_custkey", F.expr("nullif(o_orderstatus, 'P')").alias("last_status"),
        F.col("o_orderpriority").alias("first_priority"), F.col("o_orderpriority").alias("priorities"),
        F.col("o_totalprice").alias("min_price"), F.col("o_totalprice").alias("max_price"),
        F.col("o_orderkey").alias("n_orders"), "o_orderdate", "o_orderkey")
    g = ag.grouper(o, ["o_custkey"], {"last_status": "last", "first_priority": "first", "min_price": "min",
                                      "max_price": "max", "n_orders": "count", "priorities": "unique"},
                   order_by=["o_orderdate", "o_orderkey"])
    return g.select("o_custkey", "last_status", "first_priority", "min_price", "max_price",
                    F.col("n_orders").cast("bigint").alias("n_orders"),
                    F.array_join("priorities", "|").alias("priorities"))


# ---------------------------------------------------------------- J10 / J11
@register("inscope_lookup", """
WITH m AS (SELECT DISTINCT lower(trim(' ' || o_orderpriority || ' ')) AS k, upper(substr(o_orderpriority, 3)) AS mapped
           FROM orders WHERE o_orderpriority <> '3-MEDIUM')
SELECT o_orderkey, m.mapped AS pay_code FROM orders LEFT JOIN m ON lower(trim(o_orderpriority)) = m.k
""")
def q_inscope_lookup(spark, sf):
    o = table(spark, sf, "orders")
    mapping = (o.filter(F.col("o_orderpriority") != "3-MEDIUM")
               .select(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("client_value"),
                       F.upper(F.substring("o_orderpriority", 3, 100)).alias("mapped")).distinct())
    out = jn.lookup(o.select("o_orderkey", "o_orderpriority"), "o_orderpriority", mapping, "client_value",
                    "mapped", out="pay_code")
    return out.select("o_orderkey", "pay_code")


# ---------------------------------------------------------------- P13 / F11
@register("parse_fixed_format", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed FROM orders
""")
def q_parse_fixed_format(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("txt"))
    return o.select("o_orderkey", dt.parse_with_format("txt", "%Y-%m-%d %H:%M:%S").alias("parsed"))


@register("drop_rows", """
SELECT o_orderkey FROM orders WHERE 'orders:row:' || CAST(o_orderkey + 2 AS VARCHAR) NOT IN ('orders:row:2', 'orders:row:41170')
""")
def q_drop_rows(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("orders:row:"), (F.col("o_orderkey") + 2).cast("string")).alias("Source"))
    return fl.drop_rows(o, "Source", ["orders:row:2", "orders:row:41170"]).select("o_orderkey")
