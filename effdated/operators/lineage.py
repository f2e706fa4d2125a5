"""Row lineage.

A lineage value is ``"<file>[:<sheet>]:row:<n>"``. Collapsed lineage is a map from
the ``"<file>[:<sheet>]:row:"`` prefix to the row numbers, distinct, in first-seen
order. It is rendered as the text ``{'f:row:': ['1', '2'], 'g:row:': ['1']}``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effdated.operators.scan import _order_struct

MARK = ":row:"


def source_label(prefix: Column | str, row_number: Column) -> Column:
    """``<prefix>:row:<n>``."""
    p = F.col(prefix) if isinstance(prefix, str) else prefix
    return F.concat(p, F.lit(MARK), row_number.cast("string"))


def _render(entries: Column) -> Column:
    """entries: array<struct<p: string, ns: array<string>>> -> dict-like text."""
    body = F.transform(entries, lambda e: F.concat(
        F.lit("'"), e["p"], F.lit("': ["),
        F.array_join(F.transform(e["ns"], lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", "),
        F.lit("]")))
    return F.concat(F.lit("{"), F.array_join(body, ", "), F.lit("}"))


def list_source_to_dict(df: DataFrame, source_col_name: str = "Source") -> DataFrame:
    """L1 on an array column: each row's list of lineage labels becomes its map text.

    Row-local (no shuffle). Cost is O(labels x distinct prefixes) per row; for
    lineage gathered from huge groups prefer :func:`collapse_sources`, which does
    the grouping as a distributed aggregation.
    """
    src = F.col(source_col_name)
    prefixes = F.array_distinct(F.transform(src, lambda x: F.concat(F.substring_index(x, MARK, 1), F.lit(MARK))))
    entries = F.transform(prefixes, lambda p: F.struct(
        p.alias("p"),
        F.array_distinct(F.transform(
            F.filter(src, lambda x: F.concat(F.substring_index(x, MARK, 1), F.lit(MARK)) == p),
            lambda x: F.element_at(F.split(x, MARK), 2))).alias("ns")))
    return df.withColumn(source_col_name, _render(entries))


def collapse_sources(df: DataFrame, keys: Sequence[str], source_col: str = "Source",
                     order_by: Sequence[str] | None = None, out: str = "Source") -> DataFrame:
    """L1 as a grouped aggregation: one map text per ``keys`` group.

    First-seen order follows ``order_by`` (default: the label text). Two aggregation
    levels, (keys, prefix, number) then keys, pre-aggregate map-side, so a huge
    group is reduced before the shuffle. The output is one text per group and holds
    every distinct row number of the group.
    """
    o = _order_struct(list(order_by)) if order_by else F.struct(F.col(source_col))
    lab = F.col(source_col)
    base = df.select(*keys, o.alias("_o"),
                     F.concat(F.substring_index(lab, MARK, 1), F.lit(MARK)).alias("_p"),
                     F.element_at(F.split(lab, MARK), 2).alias("_n")).filter(F.col("_p").isNotNull())
    per_num = base.groupBy(*keys, "_p", "_n").agg(F.min("_o").alias("_o"))
    per_prefix = per_num.groupBy(*keys, "_p").agg(
        F.min("_o").alias("_o"),
        F.transform(F.array_sort(F.collect_list(F.struct("_o", "_n"))), lambda x: x["_n"]).alias("ns"))
    per_key = per_prefix.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_o", F.col("_p").alias("p"), "ns"))),
                    lambda x: F.struct(x["p"].alias("p"), x["ns"].alias("ns"))).alias("_e"))
    return per_key.select(*keys, _render(F.col("_e")).alias(out))


#: Row numbers that meet in one array before they become ranges.
RANGE_BLOCK = 4096


def _joined(items: Column, lo, hi) -> Column:
    """Sorted ``items`` as ranges ``(lo, hi)``: neighbours without a gap are one."""
    last = F.size(items) - 1
    first_of = F.filter(items, lambda x, i: (i == 0) | (hi(F.get(items, i - 1)) + 1 != lo(x)))
    last_of = F.filter(items, lambda x, i: (i == last) | (lo(F.get(items, i + 1)) != hi(x) + 1))
    return F.zip_with(first_of, last_of, lambda a, b: F.struct(lo(a).alias("lo"), hi(b).alias("hi")))


def collapse_ranges(df: DataFrame, keys: Sequence[str], source_col: str = "Source", out: str = "Source") -> DataFrame:
    """L1 / L2 for huge groups: per ``keys`` the labels as ``array<struct<p, ranges: array<struct<lo, hi>>>>``,
    prefixes by name, distinct row numbers as ranges.

    Numbers meet in blocks of ``RANGE_BLOCK`` (a shuffle key of its own, so a huge group is many
    tasks' work) and leave them as ranges; ranges of neighbouring blocks are then joined. A group
    of consecutive rows is one range however long it is. :func:`render_ranges` writes the text
    out. Null labels are left out; a label without a whole number raises.
    """
    lab = F.col(f"`{source_col}`")
    base = df.select(*[F.col(f"`{k}`") for k in keys], F.concat(F.substring_index(lab, MARK, 1), F.lit(MARK)).alias("_p"),
                     F.element_at(F.split(lab, MARK), 2).cast("bigint").alias("_n")).filter(F.col("_p").isNotNull())
    blocks = (base.withColumn("_b", F.floor(F.col("_n") / RANGE_BLOCK)).groupBy(*keys, "_p", "_b")
              .agg(F.array_sort(F.collect_set("_n")).alias("_ns")))
    blocks = blocks.select(*keys, "_p", "_b", _joined(F.col("_ns"), lambda x: x, lambda x: x).alias("_r"))
    whole = blocks.groupBy(*keys, "_p").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_b", "_r"))), lambda x: x["_r"])).alias("_r"))
    whole = whole.select(*keys, "_p", _joined(F.col("_r"), lambda x: x["lo"], lambda x: x["hi"]).alias("_r"))
    named = F.struct(F.substring_index("_p", MARK, 1).alias("name"), F.col("_p").alias("p"), F.col("_r").alias("ranges"))
    listed = F.array_sort(F.collect_list(named))
    return whole.groupBy(*keys).agg(F.transform(listed, lambda e: F.struct(e["p"].alias("p"), e["ranges"].alias("ranges"))).alias(out))


def render_ranges(entries: Column) -> Column:
    """The map text of :func:`collapse_ranges`: every row number written out, as :func:`collapse_sources` does."""
    numbers = lambda e: F.flatten(F.transform(e["ranges"], lambda r: F.transform(F.sequence(r["lo"], r["hi"]), lambda n: n.cast("string"))))
    return _render(F.transform(entries, lambda e: F.struct(e["p"].alias("p"), numbers(e).alias("ns"))))


def source_files(df: DataFrame, source_col: str = "Source") -> DataFrame:
    """L3: distinct source files (text before the first ``:``) represented in ``df``."""
    return (df.select(F.substring_index(F.col(source_col), ":", 1).alias("source_file"))
            .filter(F.col("source_file").isNotNull()).distinct())
