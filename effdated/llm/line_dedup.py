"""Line dedup (operator 6): deletion-neighbourhood join over the lines of all documents.

A line is its sequence of words. A line goes if an earlier line (by id, then text hash, then
line number; null ids last) equals it or, for lines of ``MIN_WORDS`` words or more, is
within one word edit: one word inserted, deleted or replaced. Chains count link by link, so
of a chain the earliest line stays. Lines without a word stay.

1. Lines become 128-bit hashes; each distinct line has one first place.
2. Partition filter: within one word edit, the first or the last half of the shorter line is
   untouched. Only lines that share such a half with another distinct line go on; a
   Bloom filter of their places picks their texts out of a second scan.
3. Deletion neighbourhood: those lines emit the hash of every variant with one word deleted.
   Equal variants at the same place are a replacement; a variant equal to a whole line is
   an insertion or deletion. Per variant only the earliest line matters, so groups are
   reduced by ``min`` with partial aggregation and no pairs are made.
4. The edit distance of each line to its earliest partner is verified on the words.

Null text counts as empty. Rows with equal id and equal text are one document: all of them
lose the same lines. Extra columns are carried. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXT_ROWS, flag_members, join_groups, key_filter, members, packed, shared_table

MIN_WORDS = 8
_WORD_BREAK = "[\\x20\\x09-\\x0D]+"
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_HASH = ["h1", "h2"]
_PLACE = ["_null", "_id", "_th", "_no"]


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text, ident = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.col(f"`{id_col}`").cast("long")
    return docs.select(ident.isNull().alias("_null"), F.coalesce(ident, F.lit(0)).alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))


def _halves(words: list[bytes]) -> list[int]:
    """Hashes of the halves of a line. Of two lines within one word edit, with lengths n or n and
    n + 1, one has as many untouched words at its start or end as both emit here."""
    n, keys = len(words), []
    for t in {(n - 1) // 2, n // 2}:
        for side, part in ((b"<", words[:t]), (b">", words[n - t:])):
            keys.append(xxhash.xxh64_intdigest(side + b" ".join(part)) - (1 << 63))
    return keys


def _hashed(documents: DataFrame, min_words: int) -> DataFrame:
    """``_null, _id, _th, _no, h1, h2, halves`` per line with a word; no halves for short lines."""
    names = [*_PLACE, *_HASH, "halves"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, no, h1, h2, halves = [], [], [], [], []
            for i, text in enumerate(batch.column(3)):
                for k, line in enumerate(text.as_py().encode("utf-8", "replace").split(b"\n")):
                    words = line.split()  # ASCII white space
                    if words:
                        h = xxhash.xxh3_128_intdigest(b" ".join(words))
                        of.append(i), no.append(k)
                        h1.append((h >> 64) - (1 << 63)), h2.append((h & ((1 << 64) - 1)) - (1 << 63))
                        halves.append(_halves(words) if len(words) >= min_words else [])
            rows = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(j).take(rows) for j in range(3)), pa.array(no, pa.int32()), pa.array(h1, pa.int64()),
                                              pa.array(h2, pa.int64()), pa.array(halves, pa.list_(pa.int64()))], names=names)

    return documents.mapInArrow(run, "_null boolean, _id long, _th long, _no int, h1 long, h2 long, halves array<long>")


def _place() -> Column:
    return F.struct(*_PLACE)


def _candidates(first: DataFrame) -> DataFrame:
    """Distinct lines (``h1, h2, place``) that share a half with another distinct line."""
    keyed = first.filter(F.size("halves") > 0).select(*_HASH, "place", F.explode("halves").alias("half"))
    shared = keyed.groupBy("half").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    shared = shared_table(shared, "lines-shared")
    likely = members(keyed, key_filter(shared, ["half"], "lines-shared-filter"))
    near = join_groups(likely, shared, "half", "_n", first.count()).select(*_HASH, "place")
    return shared_table(near.dropDuplicates(_HASH), "lines-near")


def _pick(documents: DataFrame, near: DataFrame) -> DataFrame:
    """``rank, h1, h2, line`` of the candidate lines. Their texts are found by a Bloom filter of
    their places (one probe a line); ``rank`` is a number that follows the places' order."""
    known = key_filter(near.select("place.*"), _PLACE, "lines-places")
    lines = documents.select("_null", "_id", "_th", F.posexplode(F.split("_text", "\n")).alias("_no", "line"))
    maybe = members(lines, known).select(_place().alias("place"), "line")
    found = maybe.join(near, "place").dropDuplicates(_HASH)
    words = F.array_join(F.array_remove(F.split("line", _WORD_BREAK), ""), " ")
    ranked = found.orderBy("place").withColumn("rank", F.monotonically_increasing_id())
    return shared_table(ranked.select("rank", *_HASH, words.alias("line")), "lines-texts")


def _variants(texts: DataFrame) -> DataFrame:
    """``key, role, rank`` per line and deleted word. Role 2: the variant at its place, equal for
    replacements of one word. Role 1: the variant as a whole line, which meets the lines that
    are that variant (role 0)."""

    def one(line: str) -> tuple[np.ndarray, int]:
        h = np.array([xxhash.xxh64_intdigest(w) for w in line.encode("utf-8", "replace").split(b" ")], dtype=np.uint64)
        powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(h) - 1, _BASE, np.uint64))))
        sums = np.cumsum(h * powers)  # modulo 2**64
        before = sums - h * powers
        return before + (sums[-1] - sums) * _INVERSE, int(sums[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                keys, roles, ranks = [], [], []
                for line, rank in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    without, whole = one(line)
                    places = (np.arange(1, len(without) + 1, dtype=np.uint64) * _INVERSE) ^ (without * _BASE)
                    # a run of equal words gives equal variants: one of them is enough as a whole line
                    key = np.concatenate([places, np.unique(without), np.array([whole], np.uint64)])
                    role = np.ones(len(key), np.int8)
                    role[: len(places)], role[-1] = 2, 0
                    keys.append(key), roles.append(role), ranks.append(np.full(len(key), rank))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(roles)), pa.array(np.concatenate(ranks))],
                                                     names=["key", "role", "rank"])

    return texts.select("line", "rank").mapInArrow(run, "key long, role byte, rank long")


def _partners(texts: DataFrame) -> DataFrame:
    """``rank`` and ``other``, the rank of the earliest line one word edit away, if earlier."""
    rows = shared_table(_variants(texts), "lines-variants", 5 * TEXT_ROWS)
    least = lambda role: F.min(F.when(F.col("role") == role, F.col("rank")))
    groups = rows.groupBy("key").agg(least(0).alias("_whole"), least(1).alias("_cut"), least(2).alias("_swap"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    groups = shared_table(groups, "lines-groups")
    likely = members(rows, key_filter(groups, ["key"], "lines-keys"))
    met = join_groups(likely, groups, "key", "_n", rows.count())
    other = F.when(F.col("role") == 2, F.col("_swap")).when(F.col("role") == 1, F.col("_whole")).otherwise(F.col("_cut"))
    return met.withColumn("other", other).filter("other < rank").groupBy("rank").agg(F.min("other").alias("other"))


def _within_one_edit(a: Column, b: Column) -> Column:
    """Word sequences that differ by one insertion, deletion or replacement at most."""
    def common(x: Column, y: Column) -> Column:
        step = lambda s, i: F.when((s == i) & (F.get(x, i) == F.get(y, i)), s + 1).otherwise(s)
        return F.aggregate(F.sequence(F.lit(0), F.least(F.size(x), F.size(y)) - 1), F.lit(0), step)

    return common(a, b) + common(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``_null, _id, _th, _gone``: numbers of the lines that go, per document that loses any."""
    documents = _documents(docs, id_col, text_col)
    table = shared_table(_hashed(documents, min_words), "lines-hashed", TEXT_ROWS).withColumn("place", _place()).drop(*_PLACE)
    n = table.count()
    first = shared_table(table.groupBy(*_HASH).agg(F.min("place").alias("place"), F.first("halves").alias("halves"), F.count(F.lit(1)).alias("_n")), "lines-first")
    texts = _pick(documents, _candidates(first))
    words = texts.select("rank", F.split("line", " ").alias("w"))
    both = _partners(texts).join(texts.select("rank", *_HASH, F.split("line", " ").alias("w")), "rank")
    both = both.join(words.select(F.col("rank").alias("other"), F.col("w").alias("pw")), "other")
    late = shared_table(both.filter(_within_one_edit(F.col("w"), F.col("pw"))).select(*_HASH, F.lit(True).alias("_late")), "lines-late")
    # distinct lines of which something goes: they stand in several places, or have an earlier partner
    fate = first.select(*_HASH, F.col("place").alias("_first"), "_n").join(late, _HASH, "left").filter("_n > 1 OR _late")
    fate = shared_table(fate.select(F.struct(*_HASH).alias("h"), "_first", "_n", F.coalesce("_late", F.lit(False)).alias("_late")), "lines-fate")
    likely = members(table.select("place", F.struct(*_HASH).alias("h")), key_filter(fate.select("h"), ["h"], "lines-fates"))
    at = join_groups(likely, fate, "h", "_n", n)
    gone = at.filter(F.col("_late") | (F.col("place") != F.col("_first"))).select("place.*")
    return gone.groupBy("_null", "_id", "_th").agg(F.array_sort(F.collect_set("_no")).alias("_gone"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the lines that go taken out of the text, plus ``n_lines`` and ``dropped_lines``
    (0-based numbers); these two replace columns of the same name."""
    gone = shared_table(dropped_lines(docs, id_col, text_col, min_words), "lines-gone")
    ident = F.col("_id").cast("long")
    rows = packed(docs, _id=id_col, _text=text_col).select(
        "_row", ident.isNull().alias("_null"), F.coalesce(ident, F.lit(0)).alias("_id"), F.xxhash64(F.coalesce("_text", F.lit(""))).alias("_th"))
    # documents that lose nothing pass straight through; only the others meet their line numbers
    key = ["_null", "_id", "_th"]
    rows = flag_members(rows, key_filter(gone, key, "lines-losers"))
    whole = rows.filter(~F.col("_maybe")).withColumn("_gone", F.lit(None).cast("array<int>"))
    out = whole.unionByName(rows.filter("_maybe").join(gone, key, "left")).withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>")))
    text = F.col("_row")[text_col]
    out = out.withColumn("_lines", F.split(F.coalesce(text, F.lit("")), "\n"))
    # the numbers that stay come from one set difference, so long texts are not searched line by line
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    left = F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    shorter = F.when(F.size("_gone") > 0, left).otherwise(text)
    own = [shorter.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "dropped_lines")]
    return out.select(*own, F.size("_lines").alias("n_lines"), F.col("_gone").alias("dropped_lines"))
