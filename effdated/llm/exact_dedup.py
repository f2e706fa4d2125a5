"""Exact dedup (operator 2): two-pass Bloom filtering, DataFrame functions only.

Pass 1 counts how often each cell of a Bloom filter is hit (two probes a row, partial
aggregation before the shuffle) and keeps the cells hit twice or more as bitmaps.
Pass 2 probes every row against these bits: a row with a probe on a clear bit is
certainly unique and passes straight through. Only rows whose probes are all set
shuffle, on the SHA-256 of the normalised text, so a false positive of the filter
costs a shuffled row and never a wrong result.

The filter has 16 to 32 bits a row up to ``MAX_FILTER_BITS`` (32 MB as bitmaps, the
bound of what is broadcast). Past that it fills up and more rows shuffle; results stay
the same.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal
texts the row with the largest id stays; null ids stay only in a group without other
ids; of rows with equal text and equal id one stays. Extra columns are ignored by
:func:`exact_dedup` and carried by :func:`drop_exact_copies`. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, lower_ascii, packed, shared_table, unpacked

MAX_FILTER_BITS = 1 << 28
MIN_FILTER_BITS = 1 << 15
#: Bits that ``bitmap_construct_agg`` keeps in one 4 KB bitmap.
BITMAP_BITS = 1 << 15


def text_sha256(text):
    """Lowercase hex SHA-256 of the normalised text in UTF-8; null counts as empty."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def _filter_bits(n_rows: int) -> int:
    return min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, 1 << (16 * max(n_rows, 1) - 1).bit_length()))


def _cells(bits: int):
    key = F.col("_sha")
    return [F.pmod(F.xxhash64(key), F.lit(bits)), F.pmod(F.xxhash64(key, F.lit(1)), F.lit(bits))]


def repeated_cells(hashed: DataFrame, bits: int) -> DataFrame:
    """Pass 1: ``(_bucket, _bits)`` bitmaps of the cells that two or more probes hit."""
    cells = hashed.select(F.explode(F.array_distinct(F.array(*_cells(bits)))).alias("_cell"))
    repeated = cells.groupBy("_cell").count().filter("count > 1")
    return (repeated.select(F.floor(F.col("_cell") / BITMAP_BITS).alias("_bucket"), (F.col("_cell") % BITMAP_BITS).alias("_bit"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")))


def flag_repeated(hashed: DataFrame, cells: DataFrame, bits: int) -> DataFrame:
    """Pass 2: add ``_maybe``, false only for rows whose text occurs once."""
    out, flags = hashed, []
    for i, cell in enumerate(_cells(bits)):
        side = F.broadcast(cells.select(F.col("_bucket").alias(f"_b{i}"), F.col("_bits").alias(f"_bits{i}")))
        out = out.withColumn(f"_c{i}", cell)
        out = out.join(side, F.floor(F.col(f"_c{i}") / BITMAP_BITS) == F.col(f"_b{i}"), "left")
        bit = F.col(f"_c{i}") % BITMAP_BITS
        byte = F.conv(F.hex(F.substring(F.col(f"_bits{i}"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        flags.append(F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False)))
    return out.withColumn("_maybe", flags[0] & flags[1]).select(*hashed.columns, "_maybe")


def _decide(hashed: DataFrame) -> DataFrame:
    """Rows ``_id, _sha`` to ``_id, _sha, _keep, _n, _copies``: one row per (text, id)."""
    n = hashed.count()
    bits = _filter_bits(n)
    flagged = flag_repeated(hashed, shared_table(repeated_cells(hashed, bits), "exact-cells"), bits)
    unique = flagged.filter(~F.col("_maybe")).select(
        "_id", "_sha", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_n"), F.lit(1).cast("long").alias("_copies"))
    maybe = shared_table(flagged.filter("_maybe").groupBy("_sha", "_id").agg(F.count(F.lit(1)).alias("_copies")), "exact-maybe")
    groups = shared_table(maybe.groupBy("_sha").agg(F.max("_id").alias("_keep"), F.sum("_copies").alias("_n")), "exact-groups")
    repeated = join_groups(maybe, groups, "_sha", "_n", n)
    return unique.unionByName(repeated.select(*unique.columns))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``."""
    hashed = shared_table(docs.select(F.col(f"`{id_col}`").alias("_id"), text_sha256(F.col(f"`{text_col}`")).alias("_sha")), "exact-hashed")
    each = _decide(hashed).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return each.select(F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"),
                       (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_i") == 1)).alias("kept"),
                       F.col("_sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that the filter proves unique are only scanned. Of each other text
    ``max_by`` keeps one row, with partial aggregation, so a hot text is reduced in
    every task before it shuffles.
    """
    keyed = packed(docs, _id=id_col, _text=text_col).select("_row", "_id", text_sha256(F.col("_text")).alias("_sha"))
    hashed = shared_table(keyed.select("_id", "_sha"), "exact-hashed")
    bits = _filter_bits(hashed.count())
    flagged = flag_repeated(keyed, shared_table(repeated_cells(hashed, bits), "exact-cells"), bits)
    unique = flagged.filter(~F.col("_maybe")).select("_row")
    # null ids order below every other id
    order = F.struct(F.col("_id").isNotNull(), F.col("_id"))
    kept = flagged.filter("_maybe").groupBy("_sha").agg(F.max_by("_row", order).alias("_row")).select("_row")
    return unpacked(unique.unionByName(kept))
