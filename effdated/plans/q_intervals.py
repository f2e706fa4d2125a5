"""Interval operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from effdated.operators import intervals as iv
from effdated.operators import lineage
from effdated.plans.driver_queries import hot_keys, register, table

# ---------------------------------------------------------------- shared SQL
_EVENTS_SQL = ("SELECT event_id, user_id, event_type, ts, "
               "ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS end_ts FROM events")


def events_periods(spark, sf):
    """events as periods [ts, ts + value minutes) (value rounded to whole seconds)."""
    e = table(spark, sf, "events")
    secs = F.round(F.col("value") * 60).cast("int")
    return e.select("event_id", "user_id", "event_type", "ts",
                    (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)).alias("end_ts"))


def orders_status(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_custkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"),
                    "o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice")


# ---------------------------------------------------------------- T1
@register("flatten_effective_date", """
WITH o AS (SELECT o_custkey, nullif(o_orderstatus, 'P') AS status, o_orderdate, o_orderkey
           FROM orders WHERE o_custkey IS NOT NULL),
f AS (SELECT *, CASE WHEN lag(o_orderkey) OVER w IS NULL OR status IS NULL
                       OR lag(status) OVER w IS NULL OR status <> lag(status) OVER w
                     THEN 1 ELSE 0 END AS chg
      FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f),
g AS (SELECT o_custkey, run, max(status) AS status, min(o_orderdate) AS StartDate,
             count(o_orderkey) AS n_rows FROM r GROUP BY o_custkey, run)
SELECT o_custkey, status, StartDate, n_rows,
       lead(StartDate) OVER (PARTITION BY o_custkey ORDER BY run) AS EndDate FROM g
""")
def q_flatten_effective_date(spark, sf):
    o = orders_status(spark, sf)
    out = iv.flatten_effective_date(
        o, "o_custkey", "status", "o_orderdate",
        {"status": "first", "o_orderdate": "min", "o_orderkey": "count"}, order_by=["o_orderkey"],
        hot_rows=hot_keys(spark, sf, "orders", "o_custkey"))
    return out.select("o_custkey", "status", "StartDate", F.col("o_orderkey").cast("bigint").alias("n_rows"),
                      "EndDate")


# ---------------------------------------------------------------- T2
_LI_ORDER = ("l_shipdate, l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, "
             "l_discount, l_tax, l_linestatus")


@register("group_multiple_date", f"""
WITH l AS (SELECT *, l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS l_enddate FROM lineitem),
f AS (SELECT *, CASE WHEN lag(l_orderkey) OVER w IS NULL OR l_suppkey IS NULL OR l_returnflag IS NULL
                       OR lag(l_returnflag) OVER w IS NULL OR l_returnflag <> lag(l_returnflag) OVER w
                     THEN 1 ELSE 0 END AS chg
      FROM l WINDOW w AS (PARTITION BY l_suppkey ORDER BY {_LI_ORDER})),
r AS (SELECT *, sum(chg) OVER (PARTITION BY l_suppkey ORDER BY {_LI_ORDER}
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f)
SELECT l_suppkey, max(l_returnflag) AS l_returnflag, min(l_shipdate) AS l_shipdate,
       max(l_enddate) AS l_enddate, count(*) AS n_lines
FROM r GROUP BY l_suppkey, run
""")
def q_group_multiple_date(spark, sf):
    li = table(spark, sf, "lineitem")
    li = li.withColumn("l_enddate", F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int")))
    out = iv.group_multiple_date(
        li, "l_suppkey", "l_returnflag", "l_shipdate", "l_enddate",
        {"l_returnflag": "first", "l_orderkey": "size"},
        order_by=[c.strip() for c in _LI_ORDER.split(",")[1:]],
        hot_rows=hot_keys(spark, sf, "lineitem", "l_suppkey"))
    return out.select("l_suppkey", "l_returnflag", "l_shipdate", "l_enddate",
                      F.col("l_orderkey").cast("bigint").alias("n_lines"))


# ---------------------------------------------------------------- T3
@register("flatten_multi_column", """
WITH o AS (SELECT * FROM orders WHERE o_custkey IS NOT NULL),
f AS (SELECT *, CASE WHEN lag(o_orderkey) OVER w IS NULL
                       OR o_orderstatus IS NULL OR lag(o_orderstatus) OVER w IS NULL
                       OR o_orderstatus <> lag(o_orderstatus) OVER w
                       OR o_orderpriority IS NULL OR lag(o_orderpriority) OVER w IS NULL
                       OR o_orderpriority <> lag(o_orderpriority) OVER w
                     THEN 1 ELSE 0 END AS chg
      FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f),
g AS (SELECT o_custkey, run, max(o_orderstatus) AS o_orderstatus, max(o_orderpriority) AS o_orderpriority,
             min(o_orderdate) AS o_orderdate FROM r GROUP BY o_custkey, run)
SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY run) AS end_date FROM g
""")
def q_flatten_multi_column(spark, sf):
    o = table(spark, sf, "orders")
    return iv.flatten(o, "o_custkey", "o_orderdate", "end_date",
                      ["o_orderstatus", "o_orderpriority"], order_by=["o_orderkey"],
                      hot_rows=hot_keys(spark, sf, "orders", "o_custkey"))


# ---------------------------------------------------------------- L1
@register("list_source_to_dict", """
WITH b AS (SELECT o_custkey, o_orderpriority || ':row:' AS p, CAST(year(o_orderdate) AS VARCHAR) AS n,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos
           FROM orders),
pn AS (SELECT o_custkey, p, n, min(pos) AS pos FROM b GROUP BY ALL),
pp AS (SELECT o_custkey, p, min(pos) AS pos,
              string_agg('''' || n || '''', ', ' ORDER BY pos) AS ns FROM pn GROUP BY o_custkey, p)
SELECT o_custkey, '{' || string_agg('''' || p || ''': [' || ns || ']', ', ' ORDER BY pos) || '}' AS Source
FROM pp GROUP BY o_custkey
""")
def q_list_source_to_dict(spark, sf):
    o = table(spark, sf, "orders")
    labelled = o.withColumn("Source", lineage.source_label("o_orderpriority", F.year("o_orderdate")))
    return lineage.collapse_sources(labelled, ["o_custkey"], "Source", ["o_orderdate", "o_orderkey"])


@register("lineage_ranges", """
WITH b AS (SELECT DISTINCT l_linestatus, l_returnflag || ':row:' AS p, l_orderkey AS n FROM lineitem),
r AS (SELECT l_linestatus, p, n, CASE WHEN lag(n) OVER w = n - 1 THEN 0 ELSE 1 END AS st FROM b WINDOW w AS (PARTITION BY l_linestatus, p ORDER BY n)),
pp AS (SELECT l_linestatus, p, sum(st) AS k, string_agg('''' || n || '''', ', ' ORDER BY n) AS ns FROM r GROUP BY l_linestatus, p)
SELECT l_linestatus, CAST(sum(k) AS BIGINT) AS n_ranges, '{' || string_agg('''' || p || ''': [' || ns || ']', ', ' ORDER BY p) || '}' AS Source
FROM pp GROUP BY l_linestatus
""")
def q_lineage_ranges(spark, sf):
    """L1, L2 over two groups that hold the whole table: row numbers as ranges, written out at last."""
    li = table(spark, sf, "lineitem").withColumn("Source", lineage.source_label("l_returnflag", F.col("l_orderkey")))
    out = lineage.collapse_ranges(li, ["l_linestatus"])
    n = F.aggregate("Source", F.lit(0).cast("long"), lambda a, e: a + F.size(e["ranges"]))
    return out.select("l_linestatus", n.alias("n_ranges"), lineage.render_ranges(F.col("Source")).alias("Source"))


# ---------------------------------------------------------------- T4
@register("cut_at_cutover", """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate AS s, o_orderdate + INTERVAL 900 DAY AS e FROM orders),
c AS (SELECT * FROM (VALUES (TIMESTAMP '1998-01-01'), (TIMESTAMP '2000-01-01')) t(c)),
pts AS (SELECT o_orderkey, o_custkey, s, e, c FROM o JOIN c ON c.c > o.s AND c.c < o.e
        UNION ALL SELECT o_orderkey, o_custkey, s, e, s FROM o
        UNION ALL SELECT o_orderkey, o_custkey, s, e, e FROM o),
seg AS (SELECT o_orderkey, o_custkey, c AS start_date,
               lead(c) OVER (PARTITION BY o_orderkey ORDER BY c) AS end_date FROM pts)
SELECT o_orderkey, o_custkey, start_date, end_date FROM seg WHERE end_date IS NOT NULL
""")
def q_cut_at_cutover(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").alias("start_date"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(900))).alias("end_date"))
    cuts = [F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("2000-01-01").cast("timestamp_ntz")]
    return iv.cut_at_points(o, "start_date", "end_date", cuts)


# ---------------------------------------------------------------- W6
_ISL = f"""
e AS ({_EVENTS_SQL}),
m AS (SELECT *, max(end_ts) OVER (PARTITION BY user_id ORDER BY ts, end_ts, event_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pme FROM e),
s AS (SELECT *, CASE WHEN pme IS NULL OR ts >= pme THEN 1 ELSE 0 END AS st FROM m),
i AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, end_ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM s)"""


@register("overlap_identifier", f"""
WITH {_ISL}
SELECT event_id, user_id, ts, end_ts, isl AS overlapping_index,
       count(*) OVER (PARTITION BY user_id, isl) > 1 AS is_overlapping FROM i
""")
def q_overlap_identifier(spark, sf):
    e = events_periods(spark, sf)
    out = iv.add_overlapping_identifier(e, "user_id", "ts", "end_ts", order_by=["event_id"],
                                        hot_rows=hot_keys(spark, sf, "events", "user_id"))
    return out.select("event_id", "user_id", "ts", "end_ts", "overlapping_index", "is_overlapping")


@register("overlap_pick_longest", f"""
WITH {_ISL},
k AS (SELECT *, row_number() OVER (PARTITION BY user_id, isl
                                   ORDER BY end_ts - ts DESC, ts, event_id) AS rk FROM i)
SELECT event_id, user_id, ts, end_ts, event_type FROM k WHERE rk = 1
""")
def q_overlap_pick_longest(spark, sf):
    e = events_periods(spark, sf)
    out = iv.pick_longest(e, "user_id", "ts", "end_ts", "event_id", hot_rows=hot_keys(spark, sf, "events", "user_id"))
    return out.filter("is_longest").select("event_id", "user_id", "ts", "end_ts", "event_type")


@register("unify_overlaps", f"""
WITH {_ISL}
SELECT event_id, user_id,
       min(ts) OVER (PARTITION BY user_id, isl) AS ts,
       max(end_ts) OVER (PARTITION BY user_id, isl) AS end_ts,
       first(event_type ORDER BY ts, end_ts, event_id) OVER (PARTITION BY user_id, isl) AS event_type
FROM i
""")
def q_unify_overlaps(spark, sf):
    e = events_periods(spark, sf)
    out = iv.unify_overlapping(e, "user_id", "ts", "end_ts", "event_type", order_by=["event_id"],
                               hot_rows=hot_keys(spark, sf, "events", "user_id"))
    return out.select("event_id", "user_id", "ts", "end_ts", "event_type")


def sweep_sql(records: str, key: str, start: str, end: str, value: str, order: str) -> str:
    """Oracle of T6 from endpoints: the winner of every elementary period, then islands of
    equal neighbours (``records``: a CTE name; gives ``swept(key, value, s, e)``)."""
    return f"""
ends AS (SELECT {key} AS k, {start} AS t FROM {records} WHERE {end} > {start}
         UNION SELECT {key}, {end} FROM {records} WHERE {end} > {start}),
elem AS (SELECT k, t AS a, (SELECT min(u.t) FROM ends u WHERE u.k = ends.k AND u.t > ends.t) AS z FROM ends),
cover AS (SELECT k, a, z, last(r.{value} ORDER BY {order}) AS v
          FROM elem JOIN {records} r ON r.{key} = k AND r.{start} <= a AND r.{end} >= z AND r.{end} > r.{start}
          WHERE z IS NOT NULL GROUP BY k, a, z),
joined AS (SELECT *, v IS NOT NULL AND EXISTS (SELECT 1 FROM cover p WHERE p.k = c.k AND p.z = c.a AND p.v = c.v) AS goes_on FROM cover c),
swept AS (SELECT k, any_value(v) AS v, min(a) AS s, max(z) AS e
          FROM (SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY a) AS run FROM joined)
          GROUP BY k, run)"""


@register("remove_overlaps", f"""
WITH recs AS ({_EVENTS_SQL}),{sweep_sql("recs", "user_id", "ts", "end_ts", "event_type", "ts, end_ts, event_id")}
SELECT k AS user_id, v AS event_type, s AS ts, e AS end_ts FROM swept
""")
def q_remove_overlaps(spark, sf):
    e = events_periods(spark, sf)
    out = iv.remove_overlaps_and_flatten(e, "user_id", "ts", "end_ts", ["event_type"], order_by=["event_id"],
                                         hot_rows=hot_keys(spark, sf, "events", "user_id"))
    return out.select("user_id", "event_type", "ts", "end_ts")
