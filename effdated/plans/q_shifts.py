"""Shift and leave rules (T9-T15, W8-W10, P23-P24) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from effdated.functions import columns as cl
from effdated.functions import dates as dt
from effdated.operators import intervals as iv
from effdated.operators import shifts as sh
from effdated.operators.scan import key_statistics
from effdated.plans.driver_queries import STATISTICS, hot_keys, register, table
from effdated.plans.q_intervals import _EVENTS_SQL, events_periods

_CHAIN_SQL = f"""
e AS ({_EVENTS_SQL}),
m AS (SELECT *, max(end_ts) OVER (PARTITION BY user_id ORDER BY ts, end_ts, event_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pme FROM e),
s AS (SELECT *, CASE WHEN pme IS NULL OR ts >= pme + INTERVAL 4 HOUR THEN 1 ELSE 0 END AS st FROM m),
i AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, end_ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS shift_index FROM s),
c AS (SELECT *, count(*) OVER (PARTITION BY user_id, shift_index) > 1 AS is_Broken_Shift,
             CAST(CASE WHEN st = 0 AND ts > pme THEN (epoch_us(ts) - epoch_us(pme)) // 1000000 ELSE 0 END AS BIGINT)
               AS unpaid_break_seconds FROM i)"""


def _chains(spark, sf):
    e = events_periods(spark, sf)
    return sh.broken_shifts(e, "user_id", "ts", "end_ts", 4.0, order_by=["event_id"], hot_rows=hot_keys(spark, sf, "events", "user_id"))


@register("broken_shift_chain", f"""
WITH {_CHAIN_SQL}
SELECT event_id, user_id, ts, end_ts, shift_index, is_Broken_Shift, unpaid_break_seconds FROM c
""")
def q_broken_shift_chain(spark, sf):
    return _chains(spark, sf).select("event_id", "user_id", "ts", "end_ts", "shift_index", "is_Broken_Shift",
                                     "unpaid_break_seconds")


@register("broken_shift_summary", f"""
WITH {_CHAIN_SQL}
SELECT user_id, shift_index, min(ts) AS ts, max(end_ts) AS end_ts, CAST(count(*) AS BIGINT) AS pieces,
       CAST(sum(unpaid_break_seconds) AS BIGINT) AS unpaid_break_seconds, count(*) > 1 AS is_Broken_Shift,
       CAST(count(*) AS VARCHAR) || ' pieces, ' || CAST(sum(unpaid_break_seconds) AS VARCHAR) || 's unpaid'
         AS broken_shift_detail
FROM c GROUP BY user_id, shift_index
""")
def q_broken_shift_summary(spark, sf):
    return sh.summarize_broken_shifts(_chains(spark, sf), "user_id", "ts", "end_ts")


@register("one_per_week", f"""
WITH {_CHAIN_SQL},
k AS (SELECT *, row_number() OVER (PARTITION BY user_id, isoyear(ts) * 100 + weekofyear(ts), is_Broken_Shift
                                   ORDER BY ts, event_id) AS rk FROM c)
SELECT event_id, is_Broken_Shift AND rk = 1 AS is_Broken_Shift FROM k
""")
def q_one_per_week(spark, sf):
    ch = _chains(spark, sf)
    return sh.one_flag_per_week(ch, "user_id", "ts", "is_Broken_Shift", "event_id").select(
        "event_id", "is_Broken_Shift")


@register("leave_rank_convert", """
WITH e AS (SELECT event_id, user_id, ts, event_type,
                  CAST(year(ts) + CASE WHEN month(ts) >= 7 THEN 1 ELSE 0 END AS INTEGER) AS fy FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id, fy ORDER BY ts, event_id) AS leave_rank FROM e)
SELECT event_id, CAST(leave_rank AS BIGINT) AS leave_rank,
       CASE WHEN leave_rank <= 3 THEN 'personal_leave' ELSE event_type END AS event_type FROM k
""")
def q_leave_rank_convert(spark, sf):
    e = _event_years(spark, sf)
    out = sh.rank_and_convert(e, ["user_id", "fy"], ["ts", "event_id"], "event_type", "personal_leave", 3,
                              hot_rows=_year_statistics(spark, sf))
    return out.select("event_id", "leave_rank", "event_type")


@register("trailing_six_month_share", """
WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
n AS (SELECT *, date_diff('day', DATE '1970-01-01', day) AS dn FROM d)
SELECT o_custkey, CAST(day AS TIMESTAMP) AS day,
       count(*) OVER (PARTITION BY o_custkey ORDER BY dn RANGE BETWEEN 182 PRECEDING AND 1 PRECEDING) / 182.0
         AS worked_share
FROM n
""")
def q_trailing_six_month_share(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate")
    out = sh.trailing_day_share(o, "o_custkey", "o_orderdate", 182)
    return out.select("o_custkey", F.col("day").cast("timestamp_ntz").alias("day"), "worked_share")


# The fixture's holiday calendar (region, name, date).
HOLIDAYS = [
    ("ALL", "New Year", "2024-01-01"),
    ("NATION_1", "Founding Day", "2024-01-06"),
    ("NATION_2", "Harvest Day", "2024-01-14"),
    ("NATION_3", "Regional Day", "2024-01-26"),
]


@register("holiday_enrich", """
WITH h AS (SELECT * FROM (VALUES ('ALL', 'New Year', DATE '2024-01-01'), ('NATION_1', 'Founding Day', DATE '2024-01-06'),
                                 ('NATION_2', 'Harvest Day', DATE '2024-01-14'), ('NATION_3', 'Regional Day', DATE '2024-01-26'))
           t(region, holiday_name, holiday_date)),
cal AS (SELECT region, holiday_name, holiday_date, false AS is_additional_holiday FROM h
        UNION ALL SELECT region, holiday_name, holiday_date + CASE WHEN dayofweek(holiday_date) = 6 THEN 2 ELSE 1 END, true
        FROM h WHERE dayofweek(holiday_date) IN (0, 6)),
e AS (SELECT event_id, ts, n_name AS region FROM events LEFT JOIN customer ON user_id = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT event_id, cal.region AS holiday_regions, holiday_name, CAST(holiday_date AS TIMESTAMP) AS holiday_date,
       is_additional_holiday
FROM e LEFT JOIN cal ON CAST(e.ts AS DATE) = cal.holiday_date AND (cal.region = e.region OR cal.region = 'ALL')
""")
def q_holiday_enrich(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id")
    geo = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("region"))
    e = e.join(geo, "user_id", "left")
    hol = spark.createDataFrame(HOLIDAYS, "region string, holiday_name string, holiday_date string") \
        .withColumn("holiday_date", F.col("holiday_date").cast("date"))
    out = sh.add_public_holidays(e, "ts", "region", sh.holiday_calendar(hol))
    return out.select("event_id", "holiday_regions", "holiday_name",
                      F.col("holiday_date").cast("timestamp_ntz").alias("holiday_date"), "is_additional_holiday")


# Easter Saturdays of the fixture years.
EASTER_SATURDAYS = ["1995-04-15", "1996-04-06", "1997-03-29", "1998-04-11", "1999-04-03", "2000-04-22", "2001-04-14"]


@register("synthetic_days", """
WITH d AS (SELECT CAST(x AS DATE) AS day FROM (VALUES ('1995-04-15'), ('1996-04-06'), ('1997-03-29'), ('1998-04-11'),
                                                 ('1999-04-03'), ('2000-04-22'), ('2001-04-14')) t(x))
SELECT DISTINCT o_custkey, CAST(day AS TIMESTAMP) AS day, 'Manually Added Easter Saturday' AS Source
FROM orders JOIN d ON d.day BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate + INTERVAL 90 DAY AS DATE)
""")
def q_synthetic_days(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").alias("s"),
                                          (F.col("o_orderdate") + F.make_dt_interval(F.lit(90))).alias("e"))
    days = spark.createDataFrame([(d,) for d in EASTER_SATURDAYS], "day string")
    out = sh.add_synthetic_days(o, "o_custkey", "s", "e", days, lineage="Manually Added Easter Saturday")
    return out.select("o_custkey", F.col("day").cast("timestamp_ntz").alias("day"), "Source")


@register("split_attribute", """
SELECT p_partkey, trim(tok) AS p_type, CAST(pos AS BIGINT) AS attribute_position
FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS tok,
             generate_subscripts(string_split(p_type, ' '), 1) AS pos FROM part)
WHERE trim(tok) <> ''
""")
def q_split_attribute(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return sh.split_attribute(p, "p_type", " ")


@register("override_values", """
WITH u AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT c_custkey, CASE WHEN u.o_custkey IS NOT NULL THEN 'PRIORITY' ELSE c_mktsegment END AS c_mktsegment
FROM customer LEFT JOIN u ON c_custkey = u.o_custkey
""")
def q_override_values(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    urgent = (table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
              .select(F.col("o_custkey").alias("c_custkey")).distinct()
              .withColumn("c_mktsegment", F.lit("PRIORITY")))
    return sh.override_values(c, urgent, ["c_custkey"], ["c_mktsegment"])


@register("append_intervals", f"""
WITH e AS ({_EVENTS_SQL})
SELECT o_custkey AS k, o_orderdate AS s, o_orderdate + INTERVAL 30 DAY AS e, o_orderpriority, NULL AS event_type FROM orders
UNION ALL SELECT user_id, ts, end_ts, NULL, event_type FROM e
""")
def q_append_intervals(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("s"),
                                          (F.col("o_orderdate") + F.make_dt_interval(F.lit(30))).alias("e"),
                                          "o_orderpriority")
    ev = events_periods(spark, sf).select(F.col("user_id").alias("k"), F.col("ts").alias("s"),
                                          F.col("end_ts").alias("e"), "event_type")
    return sh.append_intervals(o, ev)


@register("region_classification", """
WITH f AS (SELECT o_custkey, o_orderdate, o_orderkey,
                  CASE WHEN lag(o_orderkey) OVER w IS NULL OR o_orderpriority <> lag(o_orderpriority) OVER w THEN 1 ELSE 0 END AS chg
           FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
r AS (SELECT f.*, o.o_orderpriority, sum(chg) OVER (PARTITION BY f.o_custkey ORDER BY f.o_orderdate, f.o_orderkey
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f JOIN orders o USING (o_orderkey)),
g AS (SELECT o_custkey, run, first(o_orderpriority ORDER BY o_orderdate, o_orderkey) AS cls, min(o_orderdate) AS s
      FROM r GROUP BY ALL),
span AS (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY ALL),
p AS (SELECT g.o_custkey, cls, s, coalesce(lead(s) OVER (PARTITION BY g.o_custkey ORDER BY run), span.last_order) AS e
      FROM g JOIN span USING (o_custkey)),
facts AS (SELECT o_orderkey, o_custkey, o_orderdate + INTERVAL 45 DAY AS d, n_name FROM orders
          JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT f.o_orderkey, p.cls, row_number() OVER (PARTITION BY f.o_orderkey ORDER BY p.s, p.e, p.cls) AS rk
      FROM facts f JOIN p ON f.o_custkey = p.o_custkey AND f.d >= p.s AND f.d <= p.e)
SELECT f.o_orderkey, CASE WHEN m.cls IS NOT NULL THEN m.cls || '-' || f.n_name END AS region_classification
FROM facts f LEFT JOIN m ON f.o_orderkey = m.o_orderkey AND m.rk = 1
""")
def q_region_classification(spark, sf):
    o = table(spark, sf, "orders")
    runs = iv.flatten_effective_date(o, "o_custkey", "o_orderpriority", "o_orderdate",
                                     {"o_orderpriority": "first", "o_orderdate": "min"}, order_by=["o_orderkey"])
    span = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    periods = runs.join(span, "o_custkey").withColumn("EndDate", F.coalesce("EndDate", "last_order"))
    geo = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    facts = o.join(geo, o["o_custkey"] == geo["c_custkey"]).select(
        "o_orderkey", "o_custkey", (F.col("o_orderdate") + F.make_dt_interval(F.lit(45))).alias("d"), "n_name")
    out = sh.qualify_by_period(facts, "o_orderkey", "o_custkey", "d", periods, "o_custkey", "StartDate", "EndDate",
                               "o_orderpriority", F.col("n_name"), "region_classification")
    return out.select("o_orderkey", "region_classification")


@register("unpaid_break_placement", f"""
WITH e AS ({_EVENTS_SQL}),
b AS (SELECT *, value / 100 * 3600 AS secs FROM events JOIN e USING (event_id)),
c AS (SELECT event_id, secs, ts + to_seconds(CAST(trunc((date_diff('second', ts, end_ts) - secs) / 2) AS BIGINT)) AS bs FROM b)
SELECT event_id, CASE WHEN secs > 0 THEN bs END AS break_start,
       CASE WHEN secs > 0 THEN bs + to_seconds(CAST(trunc(secs) AS BIGINT)) END AS break_end FROM c
""")
def q_unpaid_break_placement(spark, sf):
    e = events_periods(spark, sf).join(table(spark, sf, "events").select("event_id", "value"), "event_id")
    e = e.withColumn("break_hours", F.col("value") / 100)
    out = cl.unpaid_break(e, "brk", "ts", "end_ts", "break_hours", "hours")
    return out.select("event_id", F.col("brk.start").alias("break_start"), F.col("brk.end").alias("break_end"))


@register("leave_end_from_hours", """
SELECT event_id, ts + to_hours(CAST(trunc(value / 60) AS BIGINT)) AS leave_end FROM events
""")
def q_leave_end_from_hours(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", (F.col("value") / 60).alias("hours"))
    out = cl.leave_end_from_hours(e, "ts", "leave_end", "hours")
    return out.select("event_id", "leave_end")


def _event_years(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type").withColumn("fy", dt.financial_year("ts"))


def _year_statistics(spark, sf):
    return key_statistics(_event_years(spark, sf), ["user_id", "fy"], name=f"{sf}/events by year")


STATISTICS.append(_year_statistics)
