"""Data-quality tests (Q1-Q17) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from effdated.functions import dates as dt
from effdated.operators import intervals as iv
from effdated.operators import quality as dq
from effdated.plans.driver_queries import register, table
from effdated.plans.q_intervals import _EVENTS_SQL, events_periods


@register("dq_nulls", """
WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority,
                  o_clerk_blank FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN ' ' ELSE 'x' END AS o_clerk_blank FROM orders))
SELECT o_orderkey, 'status' AS "column", status AS value, 'non_nan' AS test FROM o WHERE status IS NULL
UNION ALL SELECT o_orderkey, 'priority', priority, 'non_nan' FROM o WHERE priority IS NULL
UNION ALL SELECT o_orderkey, 'o_clerk_blank', o_clerk_blank, 'non_nan' FROM o WHERE trim(o_clerk_blank) = ''
""")
def q_dq_nulls(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"),
        F.when(F.col("o_orderstatus") == "F", F.lit(" ")).otherwise(F.lit("x")).alias("o_clerk_blank"))
    return dq.non_nan(o, ["status", "priority", "o_clerk_blank", "o_orderkey"], ["o_orderkey"],
                      exclude_nan=["o_orderkey"])


@register("dq_numeric", """
SELECT doc_id, 'source' AS "column", source AS value, 'non_numeric' AS test FROM documents
WHERE source IS NOT NULL AND trim(source) <> '' AND TRY_CAST(replace(trim(source), ',', '') AS DOUBLE) IS NULL
UNION ALL
SELECT doc_id, 'n_chars_text', CAST(n_chars AS VARCHAR), 'non_numeric' FROM documents WHERE false
""")
def q_dq_numeric(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source",
                                             F.col("n_chars").cast("string").alias("n_chars_text"))
    return dq.non_numeric(d, ["source", "n_chars_text"], ["doc_id"])


@register("dq_positive", """
SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount' AS "column", CAST(l_discount AS VARCHAR) AS value,
       'non_positive' AS test
FROM lineitem WHERE l_discount <= 0
""")
def q_dq_positive(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                             F.col("l_discount").cast("string").alias("l_discount"))
    return dq.non_positive(li, ["l_discount"], ["l_orderkey", "l_linenumber", "l_partkey"])


@register("dq_datetime", """
WITH o AS (SELECT o_orderkey,
                  CASE WHEN o_orderstatus = 'P' THEN 'not a date ' || o_orderkey ELSE strftime(o_orderdate, '%d/%m/%Y') END AS d
           FROM orders)
SELECT o_orderkey, 'd' AS "column", d AS value, 'non_datetime' AS test FROM o WHERE d LIKE 'not a date%'
""")
def q_dq_datetime(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("not a date "), F.col("o_orderkey").cast("string")))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("d"))
    return dq.non_datetime(o, ["d"], ["o_orderkey"])


@register("dq_ascii", """
SELECT doc_id, 'text' AS "column", text AS value, 'non_ascii' AS test FROM documents
WHERE regexp_matches(text, '[^\\x00-\\x7F]')
""")
def q_dq_ascii(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return dq.non_ascii(d, ["text"], ["doc_id"])


@register("dq_duplicates", """
WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n_copies FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(d.n_copies AS BIGINT) AS n_copies, 'duplicate' AS test
FROM lineitem l JOIN d USING (l_orderkey, l_linenumber)
""")
def q_dq_duplicates(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dq.duplicated(li, ["l_orderkey", "l_linenumber"]).withColumn("n_copies", F.col("n_copies").cast("bigint"))


@register("dq_duplicates_sets", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_returnflag, 'N') AS flag FROM lineitem),
a AS (SELECT l_orderkey, l_linenumber, 'l_orderkey,l_linenumber' AS s, count(*) AS n FROM l GROUP BY ALL HAVING count(*) > 1),
b AS (SELECT l_partkey, l_suppkey, flag, 'l_partkey,l_suppkey,flag' AS s, count(*) AS n FROM l GROUP BY ALL HAVING count(*) > 1),
c AS (SELECT *, 'l_orderkey,l_linenumber,l_partkey,l_suppkey,flag' AS s, count(*) AS n FROM l GROUP BY ALL HAVING count(*) > 1)
SELECT l.*, a.s AS duplicate_of, a.n AS n_copies, 'duplicate' AS test FROM l JOIN a USING (l_orderkey, l_linenumber)
UNION ALL SELECT l.*, b.s, b.n, 'duplicate' FROM l JOIN b ON l.l_partkey = b.l_partkey AND l.l_suppkey = b.l_suppkey AND l.flag IS NOT DISTINCT FROM b.flag
UNION ALL SELECT l.*, c.s, c.n, 'duplicate' FROM l JOIN c ON l.l_orderkey = c.l_orderkey AND l.l_linenumber = c.l_linenumber AND l.l_partkey = c.l_partkey
  AND l.l_suppkey = c.l_suppkey AND l.flag IS NOT DISTINCT FROM c.flag
""")
def q_dq_duplicates_sets(spark, sf):
    """Q7: several subsets, one of them all columns, counted in one aggregation."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.expr("nullif(l_returnflag, 'N')").alias("flag"))
    out = dq.duplicated(li, [["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "flag"], ["all"]])
    return out.withColumn("n_copies", F.col("n_copies").cast("bigint"))


@register("dq_overlaps", f"""
WITH e AS ({_EVENTS_SQL}),
m AS (SELECT *, max(end_ts) OVER (PARTITION BY user_id ORDER BY ts, end_ts, event_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pme FROM e),
s AS (SELECT *, CASE WHEN pme IS NULL OR ts >= pme THEN 1 ELSE 0 END AS st FROM m),
i AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, end_ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM s),
c AS (SELECT *, count(*) OVER (PARTITION BY user_id, isl) AS n FROM i)
SELECT event_id, user_id, ts, end_ts, isl AS overlapping_index, 'overlapping' AS test FROM c
WHERE n > 1 AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def q_dq_overlaps(spark, sf):
    e = events_periods(spark, sf).select("event_id", "user_id", "ts", "end_ts")
    tol = table(spark, sf, "customer").filter(F.col("c_acctbal") < 0).select("c_custkey")
    return dq.overlapping(e, "user_id", "ts", "end_ts", order_by=["event_id"], tolerance_keys=tol)


@register("dq_overlaps_grouped", """
WITH p AS (SELECT DISTINCT l_suppkey, l_shipdate AS s, l_shipdate + INTERVAL 3 DAY AS e FROM lineitem),
m AS (SELECT *, max(e) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pme FROM p),
st AS (SELECT *, CASE WHEN pme IS NULL OR s >= pme THEN 1 ELSE 0 END AS f FROM m),
i AS (SELECT *, sum(f) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM st),
c AS (SELECT *, count(*) OVER (PARTITION BY l_suppkey, isl) AS n FROM i)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, c.isl AS overlapping_index
FROM lineitem l JOIN c ON l.l_suppkey = c.l_suppkey AND l.l_shipdate = c.s WHERE c.n > 1
""")
def q_dq_overlaps_grouped(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").alias("s"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(3))).alias("e"))
    out = dq.overlapping(li, "l_suppkey", "s", "e", group_records=True)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "overlapping_index")


@register("dq_inscope", """
SELECT c_custkey, c_mktsegment, 'in_scope' AS test FROM customer
WHERE c_mktsegment IS NOT NULL AND lower(trim(c_mktsegment)) NOT IN ('building', 'machinery', 'household')
""")
def q_dq_inscope(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return dq.not_in_scope(c, "c_mktsegment", ["BUILDING", "Machinery ", "household"])


@register("dq_inscope_mapping", """
SELECT o_orderkey, o_orderpriority, 'in_scope' AS test FROM orders
WHERE lower(trim(o_orderpriority)) NOT IN (SELECT DISTINCT lower(trim(o_orderpriority)) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW')
""")
def q_dq_inscope_mapping(spark, sf):
    o = table(spark, sf, "orders")
    mapping = o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")).select("o_orderpriority")
    return dq.not_in_scope(o.select("o_orderkey", "o_orderpriority"), "o_orderpriority", mapping)


@register("dq_length", f"""
WITH e AS ({_EVENTS_SQL})
SELECT event_id, user_id, ts, end_ts, date_diff('second', ts, end_ts) AS length_seconds, 'shift_length' AS test
FROM e WHERE date_diff('second', ts, end_ts) < 60 OR date_diff('second', ts, end_ts) > 4 * 3600
""")
def q_dq_length(spark, sf):
    e = events_periods(spark, sf).select("event_id", "user_id", "ts", "end_ts")
    return dq.shift_length(e, "ts", "end_ts", min_minutes=1, max_hours=4)


@register("dq_end_before_start", """
SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, l_shipdate, 'end_before_start' AS test
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate + INTERVAL 30 DAY
""")
def q_dq_end_before_start(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).withColumn(
        "start_guard", F.col("o_orderdate") + F.make_dt_interval(F.lit(30)))
    return dq.end_before_start(j, "start_guard", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "l_shipdate", "test")


@register("dq_null_summary", """
WITH o AS (SELECT nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice FROM orders)
SELECT 'status' AS "column", CAST(count(*) - count(status) AS BIGINT) AS n_null, CAST(count(*) AS BIGINT) AS n_rows FROM o
UNION ALL SELECT 'priority', CAST(count(*) - count(priority) AS BIGINT), CAST(count(*) AS BIGINT) FROM o
UNION ALL SELECT 'o_totalprice', CAST(count(*) - count(o_totalprice) AS BIGINT), CAST(count(*) AS BIGINT) FROM o
""")
def q_dq_null_summary(spark, sf):
    o = table(spark, sf, "orders").select(F.expr("nullif(o_orderstatus, 'P')").alias("status"),
                                          F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"),
                                          "o_totalprice")
    return dq.null_counts(o)


@register("dq_broken", """
SELECT o_orderkey, status, priority, 'broken_record' AS test
FROM (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status, nullif(o_orderpriority, '1-URGENT') AS priority FROM orders)
WHERE status IS NULL AND priority IS NULL
""")
def q_dq_broken(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'F')").alias("status"),
                                          F.expr("nullif(o_orderpriority, '1-URGENT')").alias("priority"))
    return dq.broken_records(o, ["status", "priority"])


@register("dq_membership", """
WITH a AS (SELECT DISTINCT doc_id AS key FROM documents), b AS (SELECT DISTINCT doc_id AS key FROM labels)
SELECT key, coalesce(a.key IS NOT NULL, false) AS in_documents, coalesce(b.key IS NOT NULL, false) AS in_labels,
       'membership' AS test
FROM a FULL JOIN b USING (key) WHERE NOT (a.key IS NOT NULL AND b.key IS NOT NULL)
""")
def q_dq_membership(spark, sf):
    return dq.membership({"documents": table(spark, sf, "documents"),
                          "labels": table(spark, sf, "labels")}, "doc_id")


@register("dq_membership_groups", """
WITH k AS (SELECT DISTINCT 1 AS b, doc_id AS key FROM documents UNION ALL SELECT DISTINCT 2, doc_id FROM labels
           UNION ALL SELECT DISTINCT 4, page_id FROM pages UNION ALL SELECT DISTINCT 8, vec_id FROM embeddings),
m AS (SELECT key, sum(b) AS b FROM k GROUP BY key)
SELECT key, b & 1 > 0 AS in_documents, b & 2 > 0 AS in_labels, b & 4 > 0 AS in_pages, b & 8 > 0 AS in_embeddings,
       concat_ws(',', CASE WHEN b & 6 = 0 THEN 'side' END, CASE WHEN b & 1 = 0 THEN 'documents' END, CASE WHEN b & 8 = 0 THEN 'embeddings' END) AS missing,
       'membership' AS test
FROM m WHERE b & 6 = 0 OR b & 1 = 0 OR b & 8 = 0
""")
def q_dq_membership_groups(spark, sf):
    """Q16 with a group of datasets that stand for each other."""
    ids = {"documents": "doc_id", "labels": "doc_id", "pages": "page_id", "embeddings": "vec_id"}
    datasets = {n: table(spark, sf, n).select(F.col(c).alias("id")) for n, c in ids.items()}
    return dq.membership(datasets, "id", {"side": ["labels", "pages"]})


@register("dq_cross_period", """
WITH f AS (SELECT o_custkey, o_orderdate, o_orderkey,
                  CASE WHEN lag(o_orderkey) OVER w IS NULL OR o_orderstatus <> lag(o_orderstatus) OVER w THEN 1 ELSE 0 END AS chg
           FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f),
g AS (SELECT o_custkey, run, min(o_orderdate) AS s FROM r GROUP BY ALL),
span AS (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY ALL),
p AS (SELECT g.o_custkey, s, coalesce(lead(s) OVER (PARTITION BY g.o_custkey ORDER BY run), span.last_order) AS e
      FROM g JOIN span USING (o_custkey)),
facts AS (SELECT l_orderkey * 100 + l_linenumber AS fact_id, o_custkey, l_shipdate
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT f.fact_id, f.o_custkey, f.l_shipdate, 'cross_dataset_period' AS test FROM facts f
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.o_custkey = f.o_custkey AND f.l_shipdate >= p.s AND f.l_shipdate <= p.e)
""")
def q_dq_cross_period(spark, sf):
    o = table(spark, sf, "orders")
    runs = iv.flatten_effective_date(o, "o_custkey", "o_orderstatus", "o_orderdate",
                                     {"o_orderstatus": "first", "o_orderdate": "min"}, order_by=["o_orderkey"])
    span = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    periods = runs.join(span, "o_custkey").withColumn("EndDate", F.coalesce("EndDate", "last_order"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    facts = li.join(o.select("o_orderkey", "o_custkey"), li["l_orderkey"] == o["o_orderkey"]).select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("fact_id"), "o_custkey", "l_shipdate")
    return dq.outside_periods(facts, "o_custkey", "l_shipdate", periods,
                              "o_custkey", "StartDate", "EndDate").select("fact_id", "o_custkey", "l_shipdate", "test")


@register("dq_source_coverage", """
SELECT DISTINCT source AS file, 'source_coverage' AS test FROM documents d
WHERE source NOT IN (SELECT DISTINCT d2.source FROM documents d2 JOIN labels l ON l.doc_id = d2.doc_id
                     WHERE l.quality = 1 AND l.toxic = 0 AND d2.source NOT LIKE '%7')
""")
def q_dq_source_coverage(spark, sf):
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels").filter((F.col("quality") == 1) & (F.col("toxic") == 0))
    expected = d.select(F.col("source").alias("file")).distinct()
    out = d.filter(~F.col("source").endswith("7")).join(lab, "doc_id", "left_semi").select(
        F.concat(F.col("source"), F.lit(":row:"), F.col("doc_id").cast("string")).alias("Source"))
    return dq.source_coverage(expected, out, "file", "Source")


@register("dq_summary", """
WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT 'duplicate' AS test, CAST(sum(n) AS BIGINT) AS n_violations, CAST(100 AS BIGINT) AS tolerance,
       sum(n) <= 100 AS passed FROM d
""")
def q_dq_summary(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return dq.summarize(dq.duplicated(li, ["l_orderkey", "l_linenumber"]), "duplicate", 100)


_ = dt  # dates used by callers of this module
