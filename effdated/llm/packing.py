"""Packing (operator 8): shortest-pack-first over the length histogram.

1. Tasks tokenise whole texts and cut each document into full pieces of ``capacity`` ids
   and one remainder; of the ids only length and checksum leave the task.
2. The histogram of piece lengths (at most ``capacity`` rows, whatever the corpus) goes to
   the driver. Lengths are placed longest first, each into the shortest packs that have
   room, a count of equal packs at a time; the result is a bounded list of pack patterns
   with counts, never a list of packs.
3. Patterns go back as ranges of ranks per length. Pieces get their rank within their
   length from counts per (length, block), so one very common length is numbered by many
   tasks, and a broadcast join of the ranges gives sequence and offset.

A document's ids are those of its text (null or empty text: none) followed by ``end_id``,
so every row has at least one id. Rows are packed one by one: repeated rows and null ids
are packed like any other. Extra columns are ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import TEXT_ROWS, shared_table

CAPACITY = 2048
END_ID = 1
#: Words whose ids a task remembers, twice as many at most.
CACHE_WORDS = 120_000
#: Pieces of one length that one task numbers, about.
BLOCK_ROWS = 50_000
#: The split of which the word cache is an exact shortcut (the tokenizer file's own pattern).
_WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_LETTERS, _NUMBERS, _BLANKS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+")

#: Byte-level BPE writes each byte as one character: printable ones stand for themselves,
#: the others for 256, 257, ... in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Words(dict):
    """Ids of single words as bytes, straight from the tokenizer's model (no offsets and the like)."""

    def __init__(self, tokenize):
        self.tokenize, self.older = tokenize, {}

    def age(self) -> None:
        """Forget the words not used since the last time; the others stay."""
        self.older = dict(self)
        self.clear()

    def __missing__(self, word: str) -> bytes:
        if word in self.older:
            self[word] = found = self.older.pop(word)
            return found
        if not (word.isascii() and word.isprintable()):
            ids = [t.id for t in self.tokenize(word.encode().decode("latin-1").translate(_BYTE_LEVEL))]
        else:
            ids = [t.id for t in self.tokenize(word)]
        self[word] = found = struct.pack(f"<{len(ids)}I", *ids)
        return found


class Encoder:
    """Ids of texts as little-endian uint32 bytes, equal to the tokenizer's own.

    Where the file splits a lower-cased text into words that are encoded one by one, the
    ids of a Latin-1 text are those of its words; each new word is encoded once. Any other
    text (one with the string of a special token too), or another kind of tokenizer, is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        names = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = names == ["NFC", "Replace", "Lowercase"] and splits[:1] == [
            {"type": "Split", "pattern": {"Regex": _WORD_SPLIT}, "behavior": "Removed", "invert": True}]
        self.special = [t["content"].lower() for t in spec.get("added_tokens") or []]  # a text that holds one is encoded whole
        self.words = _Words(self.tokenizer.model.tokenize)

    def encode(self, text: str) -> bytes:
        lowered = text.lower()
        if self.by_word and _is_latin(text) and not any(t in lowered for t in self.special):
            if len(self.words) > CACHE_WORDS:
                self.words.age()
            return b"".join(map(self.words.__getitem__, _LATIN_WORDS.findall(lowered)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """``_id, start, length, ids_crc32, doc_tokens``: full pieces and the remainder of every row."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for i, text in zip(batch.column(0), batch.column(1)):
                view = memoryview(encoder.encode(text.as_py() or "") + end)
                n = len(view) // 4
                for start in range(0, n, capacity):
                    piece = view[4 * start : 4 * (start + capacity)]
                    for column, x in zip(out, (i.as_py(), start, len(piece) // 4, zlib.crc32(piece), n)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["_id", "start", "length", "ids_crc32", "doc_tokens"])

    return rows.mapInArrow(run, "_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """``(lengths of the pack, how many such packs)`` from ``length: count``.

    Longest first; equal pieces go to the shortest packs so far, and a new pack takes as
    many of them as it holds. Work depends on the number of patterns, not of pieces.
    """
    room: list[list[tuple[tuple, int]]] = [[] for _ in range(capacity + 1)]  # by free space
    most = 0

    def put(free: int, pack: tuple, count: int) -> None:
        nonlocal most
        room[free].append((pack, count))
        most = max(most, free)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while most and not room[most]:
                most -= 1
            if most >= length:
                pack, count = room[most].pop()
                used = min(left, count)
                if count > used:
                    room[most].append((pack, count - used))
                put(most - length, (pack, length), used)
                left -= used
                continue
            fit = capacity // length
            full, rest = divmod(left, fit)
            for copies, count in ((fit, full), (rest, 1)):
                if copies and count:
                    pack = None
                    for _ in range(copies):
                        pack = (pack, length)
                    put(capacity - copies * length, pack, count)
            left = 0
    packs = []
    for bucket in room:
        for pack, count in bucket:
            lengths = []
            while pack is not None:
                pack, length = pack
                lengths.append(length)
            packs.append((lengths[::-1], count))
    return packs


def rank_ranges(packs: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first rank, past the last, first sequence, offset, copies)`` per pattern and length.

    Rank r of a range is copy ``(r - first) % copies`` in sequence ``(r - first) // copies``.
    """
    taken: dict[int, int] = {}
    ranges, sequence = [], 0
    for lengths, count in packs:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            copies = lengths.count(length)
            first = taken.get(length, 0)
            taken[length] = first + copies * count
            ranges.append((length, first, taken[length], sequence, offset, copies))
            offset += copies * length
        sequence += count
    return ranges


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id, offset`` to the rows of ``cut``, a table with ``length`` and a unique ``_row``."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    ranges = rank_ranges(pack_histogram(histogram, capacity))
    schema = "length long, _from long, _to long, _first long, _offset long, _copies long"
    table = F.broadcast(spark.createDataFrame(ranges, schema))
    blocks = max(16, max(histogram.values(), default=0) // BLOCK_ROWS)
    rows = cut.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    counts = rows.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "length", "_block", (F.sum("_n").over(Window.partitionBy("length").orderBy("_block")) - F.col("_n")).alias("_before"))
    ranked = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("length", "_block").orderBy("_row")))
    ranked = ranked.join(before, ["length", "_block"]).withColumn("_rank", F.col("_before") + F.col("_nth") - 1)
    at = (ranked["length"] == table["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    nth = F.col("_rank") - F.col("_from")
    return ranked.join(table, at).select(
        *[ranked[c] for c in cut.columns if c != "_row"], (F.col("_first") + F.floor(nth / F.col("_copies"))).alias("sequence_id"),
        (F.col("_offset") + (nth % F.col("_copies")) * ranked["length"]).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    cut = pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id).withColumn("_row", F.monotonically_increasing_id())
    return place(shared_table(cut, "packing-pieces", TEXT_ROWS), capacity).withColumnRenamed("_id", id_col)
