"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from effdated.session import ensure_checkpoint_dir

#: Characters that part words: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Whole texts that go to a Python task at once.
TEXT_ROWS = 500

#: A group counts as hot when it holds more than 1 / HOT_SHARE of all rows, so there
#: are fewer than HOT_SHARE hot groups at any input size and they can be broadcast.
HOT_SHARE = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_table(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    Cuts the lineage without tying rows to an executor: a lost executor re-reads
    the files instead of recomputing (or losing) what came before. ``batch_rows``: for
    this write, the most rows that go to a Python task at once (whole texts are large).
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    was = spark.conf.get(_BATCH)
    try:
        if batch_rows:
            spark.conf.set(_BATCH, str(min(batch_rows, int(was))))
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, was)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, **named: str) -> DataFrame:
    """All columns of ``docs`` in one struct ``_row``, beside the named ones under names of our
    own, so that no column of the input can clash with one that an operator adds."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(row, *[F.col(f"`{c}`").alias(n) for n, c in named.items()])


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("_row.*")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body`` (evaluated per row)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size_col: str, n_rows: int) -> DataFrame:
    """Inner join of ``rows`` with one row per group on ``key``, safe against hot groups.

    Groups holding more than 1/HOT_SHARE of the ``n_rows`` rows are fewer than
    HOT_SHARE, so they are broadcast and their rows never meet in one task; the
    rest is a shuffle join whose largest group is bounded by n_rows / HOT_SHARE.
    """
    is_hot = F.col(size_col) * HOT_SHARE > n_rows
    hot = F.broadcast(groups.filter(is_hot))
    at_hot = rows.join(hot, key)
    cold = rows.join(F.broadcast(groups.filter(is_hot).select(key)), key, "left_anti")
    return at_hot.unionByName(cold.join(groups.filter(~is_hot), key))


#: Bits of a Bloom filter that is broadcast: 16 to 32 a key, 32 MB at most (past that it fills
#: up and lets more rows through), and the bits that one 4 KB bitmap row holds.
MAX_FILTER_BITS, MIN_FILTER_BITS, BITMAP_BITS = 1 << 28, 1 << 15, 1 << 15


def filter_bits(n_keys: int) -> int:
    return min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, 1 << (16 * max(n_keys, 1) - 1).bit_length()))


def key_filter(keys: DataFrame, columns: list[str], label: str) -> tuple[DataFrame, int, list[str]]:
    """A Bloom filter (one probe a key) of ``columns`` as a table of bitmaps."""
    bits = filter_bits(keys.count())
    cell = F.pmod(F.xxhash64(*columns), F.lit(bits))
    rows = keys.select(F.floor(cell / BITMAP_BITS).alias("_bucket"), (cell % BITMAP_BITS).alias("_bit"))
    return shared_table(rows.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")), label), bits, columns


def flag_members(rows: DataFrame, known: tuple[DataFrame, int, list[str]], flag: str = "_maybe") -> DataFrame:
    """Add ``flag``, false only for rows whose key is certainly not in the filter. No shuffle."""
    cells, bits, columns = known
    out = rows.withColumn("_cell", F.pmod(F.xxhash64(*columns), F.lit(bits))).withColumn("_bucket", F.floor(F.col("_cell") / BITMAP_BITS))
    out = out.join(F.broadcast(cells), "_bucket", "left")
    bit = F.col("_cell") % BITMAP_BITS
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return out.withColumn(flag, hit).select(*[F.col(f"`{c}`") for c in rows.columns], flag)


def members(rows: DataFrame, known: tuple[DataFrame, int, list[str]]) -> DataFrame:
    """The rows whose key may be in the filter."""
    return flag_members(rows, known).filter("_maybe").drop("_maybe")


def hash_table(entries: DataFrame, buckets: int) -> DataFrame:
    """One row: ``table``, the rows ``(t long, w)`` of ``entries`` as ``buckets`` short lists by ``t``.

    For tables of a fixed greatest size: as a scalar subquery every row can look values
    up without a join, see :func:`hash_get`.
    """
    lists = entries.groupBy(F.pmod("t", F.lit(buckets)).cast("int").alias("b")).agg(F.sort_array(F.collect_list(F.struct("t", "w"))).alias("l"))
    every = entries.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b")).join(lists, "b", "left")
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("b", "l"))), lambda x: x["l"]).alias("table"))


def hash_get(table: Column, key: Column, buckets: int) -> Column:
    """The ``w`` of ``key`` in a ``hash_table``, or null. ``key`` should be a cheap expression."""
    found = F.filter(F.get(table, F.pmod(key, F.lit(buckets)).cast("int")), lambda e: e["t"] == key)
    return F.get(found, F.lit(0))["w"]
