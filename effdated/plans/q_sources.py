"""Sources on the driver tables (S1-S12): files are written by the query itself into a
staging folder under the session's checkpoint dir (a shared folder on a cluster),
then read back through the ingest path."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from effdated.functions import columns as cl
from effdated.session import ensure_checkpoint_dir
from effdated.operators import filters as fl
from effdated.operators import joins as jn
from effdated.sources import catalog
from effdated.sources import csv as csvsrc
from effdated.sources import files as fs
from effdated.plans.driver_queries import register, table


def _staging(spark, name: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/staging/{name}-{uuid.uuid4().hex[:12]}"


FILES = 8  # files per priority: writing is spread over priorities x FILES tasks


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("part", F.col("o_orderkey") % FILES)


def write_orders_csv(spark, sf) -> str:
    """orders as CSV, one file per priority and part, rows in o_orderkey order (header line first)."""
    path = _staging(spark, "orders-csv")
    (_orders(spark, sf).repartition("o_orderpriority", "part").sortWithinPartitions("o_orderpriority", "part", "o_orderkey")
     .write.option("header", "true").partitionBy("o_orderpriority", "part").csv(path))
    return path


def _write_lines(lines, path: str) -> None:
    """``part, line`` rows as text, one file per part, lines in (place, o_orderkey) order."""
    (lines.repartition("part").sortWithinPartitions("part", "place", "o_orderkey").select("part", "line")
     .write.partitionBy("part").text(path))


def _parts(spark):
    """One row per file."""
    return spark.range(FILES).select(F.col("id").alias("part"))


def _priority():
    """The priority in the folder name (URL-encoded by the writer)."""
    return F.expr("reflect('java.net.URLDecoder', 'decode', "
                  "regexp_extract(source_path, 'o_orderpriority=([^/]+)', 1), 'UTF-8')")


@register("ingest_csv_lineage", f"""
SELECT o_orderkey, o_orderpriority AS priority,
       CAST(row_number() OVER (PARTITION BY o_orderpriority, o_orderkey % {FILES} ORDER BY o_orderkey) + 1 AS BIGINT) AS record_no,
       o_orderstatus
FROM orders
""")
def q_ingest_csv_lineage(spark, sf):
    bronze = csvsrc.read_csv_with_lineage(spark, write_orders_csv(spark, sf))
    label_no = F.regexp_extract(F.col("Source"), r":row:(\d+)$", 1).cast("bigint")
    return bronze.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), _priority().alias("priority"),
        F.when(label_no == F.col("record_no"), F.col("record_no")).alias("record_no"), "o_orderstatus")


@register("csv_preamble", f"""
SELECT o_orderkey, o_orderstatus, CAST(row_number() OVER (PARTITION BY o_orderkey % {FILES} ORDER BY o_orderkey) + 4 AS BIGINT) AS record_no
FROM orders
""")
def q_csv_preamble(spark, sf):
    """A blank, a wide and a short physical line before the header; blank and too-wide
    lines among the rows are dropped and not numbered."""
    path = _staging(spark, "orders-preamble")
    text = ["", "Orders,as,of,today,and,more", "exported", "o_orderkey,o_orderstatus", "", "9,F,too,wide"]
    head = _parts(spark).select("part", F.posexplode(F.array(*[F.lit(t) for t in text])).alias("place", "line")).withColumn("o_orderkey", F.lit(0).cast("long"))
    rows = _orders(spark, sf).select("part", F.lit(len(text)).alias("place"), F.concat_ws(",", "o_orderkey", "o_orderstatus").alias("line"), "o_orderkey")
    _write_lines(head.unionByName(rows), path)
    return csvsrc.read_csv_with_lineage(spark, path, skiprows=3).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus", "record_no")


@register("csv_mixed_headers", f"""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % {FILES} % 2 = 1 THEN o_orderpriority END AS o_orderpriority FROM orders
""")
def q_csv_mixed_headers(spark, sf):
    """Files whose headers name other columns in another order, read together."""
    path = _staging(spark, "orders-mixed")
    odd = F.col("part") % 2 == 1
    head = _parts(spark).select("part", F.lit(0).alias("place"), F.when(odd, "o_orderstatus,o_orderkey,o_orderpriority").otherwise("o_orderkey,o_orderstatus").alias("line"),
                                F.lit(0).cast("long").alias("o_orderkey"))
    line = F.when(odd, F.concat_ws(",", "o_orderstatus", "o_orderkey", "o_orderpriority")).otherwise(F.concat_ws(",", "o_orderkey", "o_orderstatus"))
    _write_lines(head.unionByName(_orders(spark, sf).select("part", F.lit(1).alias("place"), line.alias("line"), "o_orderkey")), path)
    return csvsrc.read_csv_with_lineage(spark, path).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus", "o_orderpriority")


@register("bronze_same_basename", """
SELECT o_orderkey, o_orderpriority AS priority, 2::BIGINT AS n_priorities_loaded_twice FROM orders
""")
def q_bronze_same_basename(spark, sf):
    """Every task writes its rows of all priorities into files of one name, one folder
    each; loading them twice keeps each row once."""
    path, bronze = _staging(spark, "orders-same-name"), f"bronze_orders_{uuid.uuid4().hex[:12]}"
    _orders(spark, sf).write.option("header", "true").partitionBy("o_orderpriority").csv(path)
    loads = 2
    for _ in range(loads):
        catalog.write_bronze(spark, csvsrc.read_csv_with_lineage(spark, path), bronze)
    return spark.table(bronze).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), _priority().alias("priority"), F.lit(loads).cast("bigint").alias("n_priorities_loaded_twice"))


@register("list_and_assign_files", f"""
SELECT 'all_csv' AS dataset, '{{"sep": ","}}' AS read_options, count(DISTINCT (o_orderpriority, o_orderkey % {FILES})) AS n_files FROM orders
""")
def q_list_and_assign_files(spark, sf):
    """The last rule that fits a file wins."""
    listing = fs.require_files(fs.list_files(spark, write_orders_csv(spark, sf)))
    rules = {"parts": {"filename_include": ["part-"], "options": {"dtype": "object"}},
             "all_csv": {"filename_include": [".csv"], "filename_exclude": ["crc"], "options": {"sep": ","}},
             "none": {"filename_include": ["part-"], "filename_exclude": [".csv"]}}
    return (fs.assign_datasets(fs.filelist_filter(listing), rules).groupBy("dataset", "read_options")
            .agg(F.count(F.lit(1)).alias("n_files")))


@register("lookup_duplicate_mapping", """
SELECT o_orderkey, n_name AS nation FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
""")
def q_lookup_duplicate_mapping(spark, sf):
    """A mapping whose repeated rows agree is one mapping; orders are not multiplied."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    mapping = c.select(F.col("c_custkey").cast("string").alias("code"), "n_name")
    twice = mapping.unionByName(mapping.withColumn("code", F.concat(F.lit(" "), "code")))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("code"))
    return jn.lookup(o, "code", twice, "code", "n_name", out="nation").select("o_orderkey", "nation")


@register("payslip_same_basename", """
SELECT l_orderkey, l_linenumber, l_quantity, count(*) OVER () AS distinct_labels FROM lineitem
""")
def q_payslip_same_basename(spark, sf):
    """Line files of one name in many folders; every line keeps a label and a code of its
    own, so removing duplicate line codes loses none."""
    path = _staging(spark, "lines-same-name")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    lines.write.option("header", "true").partitionBy("l_returnflag", "l_linestatus").csv(path)
    bronze = cl.payslip_line_code(csvsrc.read_csv_with_lineage(spark, path), "PayslipLineCode")
    lines = bronze.select("PayslipLineCode", "Source", "l_orderkey", "l_linenumber", "l_quantity")  # paths and file names end here
    kept = fl.dedupe_keep_first(lines, ["PayslipLineCode"], ["Source"], digests=["PayslipLineCode"])
    labels = bronze.agg(F.count_distinct("Source").alias("distinct_labels"))
    return jn.attach_constants(kept, labels).select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"), F.col("l_quantity").cast("double").alias("l_quantity"), "distinct_labels")


@register("csv_multiline_preamble", f"""
SELECT o_orderkey, o_orderpriority || chr(10) || o_orderstatus AS note,
       CAST(row_number() OVER (PARTITION BY o_orderkey % {FILES} ORDER BY o_orderkey) + 2 AS BIGINT) AS record_no
FROM orders
""")
def q_csv_multiline_preamble(spark, sf):
    """S8, multiline: a preamble wider than the data, quoted line feeds, and rows that are too long."""
    path = _staging(spark, "orders-multiline")
    text = ["Orders,as,of,today,and,more", "o_orderkey,note", "9,F,too,wide"]
    head = _parts(spark).select("part", F.posexplode(F.array(*[F.lit(t) for t in text])).alias("place", "line")).withColumn("o_orderkey", F.lit(0).cast("long"))
    note = F.concat(F.lit('"'), "o_orderpriority", F.lit("\n"), "o_orderstatus", F.lit('"'))
    rows = _orders(spark, sf).select("part", F.lit(len(text)).alias("place"), F.concat_ws(",", "o_orderkey", note).alias("line"), "o_orderkey")
    _write_lines(head.unionByName(rows), path)
    return csvsrc.read_csv_with_lineage(spark, path, skiprows=1, multiline=True).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "note", "record_no")


@register("csv_faults", f"""
SELECT o_orderkey % {FILES} AS part, count(*) AS n_rows, 'no header line after 0 lines' AS only_error, 3::BIGINT AS n_faults
FROM orders GROUP BY ALL
""")
def q_csv_faults(spark, sf):
    """Files without any header line are listed, the others load."""
    path = _staging(spark, "orders-faults")
    head = _parts(spark).select("part", F.lit(0).alias("place"), F.lit("o_orderkey").alias("line"), F.lit(0).cast("long").alias("o_orderkey"))
    _write_lines(head.unionByName(_orders(spark, sf).select("part", F.lit(1).alias("place"), F.col("o_orderkey").cast("string").alias("line"), "o_orderkey")), path)
    blank = spark.range(3).select(F.concat(F.lit("blank"), F.col("id").cast("string")).alias("part"), F.lit("  ").alias("line"))
    blank.write.mode("append").partitionBy("part").text(path)
    faults = csvsrc.csv_faults(spark, path).agg(F.max("error").alias("only_error"), F.count(F.lit(1)).alias("n_faults"))
    rows = csvsrc.read_csv_with_lineage(spark, path).groupBy((F.col("o_orderkey").cast("bigint") % FILES).alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))
    return jn.attach_constants(rows, faults).select("part", "n_rows", "only_error", "n_faults")
