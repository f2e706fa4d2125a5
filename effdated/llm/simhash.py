"""SimHash near-dedup (operator 1) with pigeonring filtering.

Fingerprint: A-Z lower-cased, words between ASCII white space, shingles of ``SHINGLE``
words (fewer words: the whole sequence; none: fingerprint zero), repeats included; a bit
is set when it is set in over half of the shingles' XXH64 hashes. Two fingerprints link
at ``MAX_BITS`` or fewer differing bits; a document's component is the smallest id
reachable over links.

Links are searched between *distinct* fingerprints only, cut into ``SEGMENTS`` segments
on a ring. Pigeonring principle: if two fingerprints differ in at most t bits, there is a
segment from which every chain of l consecutive segments has at most l * t / m differing
bits. With t = 4, m = 5 the chain budgets are 0, 1, 2, 3, 4. The first two give the join
keys without loss: the first segment is equal and the second differs in one bit at most,
so of its ``PIECES`` pieces at most one differs: a key is (segment, the second segment
without one piece). Equal keys are only candidates; the remaining chain budgets prune
them before the full Hamming check.

Keys shared by very many fingerprints are dealt into blocks, and blocks are compared two
by two in separate tasks, so no task holds a large group. Within a block pair only the
links of a spanning forest are given out, never all pairs: connectivity is the same.

Null text counts as empty; empty texts have fingerprint zero and link like any other.
Null ids keep their row; they never name a component unless no id is reachable. Repeated
rows give repeated rows. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TEXT_ROWS, join_groups, packed, shared_table, unpacked
from .graph import connected_components

SHINGLE = 4
MAX_BITS = 4
SEGMENTS = 5
PIECES = 3
#: Fingerprints of one key in a block; up to MOST_PER_GROUP blocks are compared as one group.
BLOCK, MOST_PER_GROUP = 1024, 4
#: Common keys that are broadcast at most (a few MB).
MAX_BROADCAST_KEYS = 100_000
_SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, _SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: len(words) - shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    total, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 65536):  # bounded memory for very long texts
        h = np.array([digest(view[a:b], _SEED) for a, b in zip(starts[at : at + 65536], stops[at : at + 65536])], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(_id, _fp)`` per row; ``_fp`` is the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["_id", "_fp"])

    return rows.mapInArrow(run, "_id long, _fp long")


def _ring(segments: int, bits: int = 64) -> list[tuple[int, int]]:
    """(offset, width) of the segments; the first ones are a bit wider if need be."""
    wide, rest = divmod(bits, segments)
    widths = [wide + (i < rest) for i in range(segments)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _key_masks(max_bits: int, segments: int, pieces: int) -> list[int]:
    """Bit masks of the keys: equal bits under one mask make a candidate.

    Needs budgets 0 and 1 for chains of one and two segments, i.e. max_bits < segments.
    """
    if not max_bits < segments:
        raise ValueError("pigeonring keys need more segments than differing bits")
    one_error = 2 * max_bits >= segments  # chain of two may differ in a bit
    ring, masks = _ring(segments), []
    mask = lambda off, width: ((1 << width) - 1) << off
    for i, (off, width) in enumerate(ring):
        off2, width2 = ring[(i + 1) % segments]
        if not one_error:
            masks.append(mask(off, width) | mask(off2, width2))
            continue
        cuts = [off2 + width2 * p // pieces for p in range(pieces + 1)]
        for p in range(pieces):
            masks.append(mask(off, width) | (mask(off2, width2) & ~mask(cuts[p], cuts[p + 1] - cuts[p])))
    return masks


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _linked(a: np.ndarray, b: np.ndarray, slot: np.ndarray, max_bits: int, segments: int, pieces: int) -> np.ndarray:
    """Which candidate pairs pass the chain budgets from their key's segment and the Hamming check."""
    diff, ring = a ^ b, _ring(segments)
    alive = np.ones(len(diff), bool)
    first = slot // pieces if 2 * max_bits >= segments else slot
    per_segment = np.stack([_popcount(diff & np.uint64(((1 << w) - 1) << o)) for o, w in ring]).astype(np.int64)
    chain = np.zeros(len(diff), np.int64)
    for length in range(1, segments + 1):
        chain += per_segment[(first + length - 1) % segments, np.arange(len(diff))]
        alive &= chain * segments <= length * max_bits
    return alive & (_popcount(diff) <= max_bits)


def _forest(group: tuple, max_bits: int, segments: int, pieces: int) -> list[tuple[int, int]]:
    """Spanning-forest links of one block pair; memory is bounded by the block size."""
    slot, same, fp, rep, half = group
    n, parent = len(fp), list(range(len(fp)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i in range(n) if same else np.flatnonzero(~half).tolist():  # the halves of a pair lie in any order
        js = np.arange(i + 1, n) if same else np.flatnonzero(half)
        hit = js[_linked(np.full(len(js), fp[i]), fp[js], np.full(len(js), slot), max_bits, segments, pieces)]
        for j in hit.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                links.append((int(rep[i]), int(rep[j])))
    return links


def _compare(max_bits: int, segments: int, pieces: int):
    """Rows sorted by (slot, key, lo, hi) to links; groups may span Arrow batches."""
    names = ["slot", "key", "lo", "hi", "half", "fp", "rep"]

    def links_of(cols: dict[str, np.ndarray], edge: np.ndarray) -> list[np.ndarray]:
        fp, rep, slot = cols["fp"].view(np.uint64), cols["rep"], cols["slot"]
        starts = np.flatnonzero(edge)
        sizes = np.diff(np.append(starts, len(edge)))
        run_of = np.cumsum(edge) - 1
        small = (sizes <= 32) & (cols["lo"][starts] == cols["hi"][starts])
        found: list[np.ndarray] = []
        for shift in range(1, int(sizes[small].max(initial=1))):  # all small groups at once
            i = np.flatnonzero((run_of[:-shift] == run_of[shift:]) & small[run_of[:-shift]])
            if len(i):
                i = i[_linked(fp[i], fp[i + shift], slot[i], max_bits, segments, pieces)]
                found.append(np.stack([rep[i], rep[i + shift]], axis=1))
        for g in np.flatnonzero(~small):
            at = slice(starts[g], starts[g] + sizes[g])
            k = starts[g]
            pairs = _forest((int(slot[k]), cols["lo"][k] == cols["hi"][k], fp[at], rep[at], cols["half"][at].astype(bool)), max_bits, segments, pieces)
            if pairs:
                found.append(np.array(pairs, dtype=np.int64))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None

        def out(cols):
            key = [cols[c] for c in names[:4]]
            edge = np.ones(len(key[0]), bool)
            edge[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
            found = links_of(cols, edge)
            if found:
                pairs = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

        for b in batches:
            cols = {c: b.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(names)}
            if held is not None:
                cols = {c: np.concatenate([held[c], cols[c]]) for c in names}
            n = len(cols["key"])
            if not n:
                continue
            # the last group may go on in the next batch
            last = np.flatnonzero(np.any([cols[c] != cols[c][-1] for c in names[:4]], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = {c: v[cut:] for c, v in cols.items()}
            if cut:
                yield from out({c: v[:cut] for c, v in cols.items()})
        if held is not None and len(held["key"]):
            yield from out(held)

    return run


def links(classes: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, pieces: int = PIECES, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` between the representatives of ``classes(_fp, _rep)``, enough to connect
    exactly what the full set of links connects."""
    masks = _key_masks(max_bits, segments, pieces)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("slot"), F.col("_fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    rows = classes.select(F.col("_fp").alias("fp"), F.col("_rep").alias("rep"), F.explode(keys).alias("k")).select("k.slot", "k.key", "fp", "rep")
    # keys too common for one group in a task's memory, whatever the size of the table
    hot = rows.groupBy("slot", "key").count().filter(F.col("count") > MOST_PER_GROUP * block)
    hot = shared_table(hot.select("slot", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "simhash-hot")
    side = F.broadcast(hot) if hot.count() <= MAX_BROADCAST_KEYS else hot  # else AQE splits the skewed side
    dealt = rows.join(side, ["slot", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("slot", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                         (F.col("mine") > F.col("other")).alias("half"), "fp", "rep")
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = dealt.repartition(parts, "slot", "key", "lo", "hi").sortWithinPartitions("slot", "key", "lo", "hi")
    return sorted_rows.mapInArrow(_compare(max_bits, segments, pieces), "u long, v long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       max_bits: int = MAX_BITS, segments: int = SEGMENTS, pieces: int = PIECES, block: int = BLOCK) -> DataFrame:
    """``id_col, fingerprint, component_id`` per row of ``docs``."""
    fps = shared_table(fingerprints(docs, id_col, text_col, shingle), "simhash-fps", TEXT_ROWS)
    n = fps.count()
    groups = fps.groupBy("_fp").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_n"))
    # a class without any id still links others: its fingerprint stands in, below every id
    classes = shared_table(groups, "simhash-classes")
    nodes = classes.select("_fp", F.col("_fp").alias("_rep"))
    comp = connected_components(links(nodes, max_bits, segments, pieces, block)).withColumnsRenamed({"node": "_fp", "component": "_c"})
    known = classes.join(comp, "_fp", "left").withColumn("_c", F.coalesce("_c", "_fp"))
    sizes = known.groupBy("_c").agg(F.min("_least").alias("component_id"), F.count(F.lit(1)).alias("_members"))
    named = shared_table(join_groups(known, sizes, "_c", "_members", n).select("_fp", "_n", "component_id"), "simhash-named")
    out = join_groups(fps, named, "_fp", "_n", n)
    return out.select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id.

    What goes is a row and not an id: rows are told apart by their id and a 64-bit hash of id and text, so of
    rows that share an id one may go while another, of another component, stays. Of rows with equal
    id and text one stays, of texts with the component's smallest id the one with the least hash. Rows
    without an id stay (they cannot be named). Only the keys of lost rows meet the texts.
    """
    rows = packed(docs, _id=id_col, _text=text_col)
    rows = rows.withColumn("_key", F.when(F.col("_id").isNotNull(), F.xxhash64("_id", "_text")))
    found = simhash_components(rows.select("_key", "_text"), "_key", "_text", **parameters)
    ids = shared_table(rows.filter("_id IS NOT NULL").groupBy("_id", "_key").agg(F.count(F.lit(1)).alias("_n")), "simhash-ids")
    named = shared_table(found.select("_key", "component_id").distinct().join(ids, "_key"), "simhash-rows")
    keepers = named.groupBy("component_id").agg(F.min(F.struct("_id", "_key")).alias("_k")).select("_k.*")
    lost = shared_table(named.join(keepers, ["_id", "_key"], "left_anti").select("_id", "_key"), "simhash-lost")
    twice = shared_table(ids.filter("_n > 1").select("_id", "_key"), "simhash-twice")
    left = rows.filter("_id IS NOT NULL").drop("_text").join(lost, ["_id", "_key"], "left_anti")
    once = left.join(twice, ["_id", "_key"], "left_anti").select("_row")
    first = left.join(twice, ["_id", "_key"], "left_semi").groupBy("_id", "_key").agg(F.first("_row").alias("_row")).select("_row")
    return unpacked(rows.filter("_id IS NULL").select("_row").unionByName(once).unionByName(first))
