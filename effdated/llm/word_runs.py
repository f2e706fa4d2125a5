"""Periodic run detection (operator 12): multi-scale minimizers, lag scans for short periods.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbour
extends and that is at least ``min_length`` words and three periods long.

* Periods up to ``DIRECT`` are scanned lag by lag: every run holds a stretch of equal words
  at distance p that a scan with half its least length as stride cannot miss.
* Longer periods are dealt into scales ``lo..hi``, ``hi = 1.5 lo``. Per scale every window of
  ``2 lo - hi + 1`` places gives its minimizers, the places with the least hash of the next ``hi``
  words (all of them if equal). Inside a run of period p windows p apart agree, so a minimizer is
  followed by an equal one at distance p, and, as p <= hi, by none in between (two equal grams of
  hi >= p words at distance d < p would give the run the period gcd(d, p)). So
  only neighbours in the order (hash, place) are paired: as many pairs as minimizers.
* A pair at a distance of lo..hi is a seed. It is extended both ways by comparing words, so a
  clash of hashes (62 bits) never makes a run. Stretches found with a multiple of their
  smallest period have the bounds of the run with that period, of which the least is kept.

A task takes the documents of a batch together, with a word of its own between them, so that the
work is done by numpy; only texts long enough for a scale take part in it.

Null text counts as empty, texts without words have no runs. Very long texts are scanned whole, at
n log n; one text is the least that a task holds. Runs that overlap, tie or nest are all
kept. Repeated rows, null ids and extra columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, MIN_PERIODS = 24, 3
#: Longest period that is scanned lag by lag.
DIRECT = 16
#: Words that are scanned together; a longer text is scanned alone.
BATCH_WORDS = 1 << 19
#: Two primes and bases of the polynomial hashes.
_PRIMES, _BASES = (2_147_483_647, 2_147_483_629), (1_103_515_245, 69_069_069)
_RUNS = "array<struct<start:long,length:long,period:long>>"


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """``(lo, hi)`` of the periods from ``DIRECT + 1`` to ``longest``."""
    lo = DIRECT + 1
    while lo <= longest:
        yield lo, 3 * lo // 2
        lo = 3 * lo // 2 + 1


def _extend(w: np.ndarray, at: int, p: int) -> tuple[int, int]:
    """Bounds of the longest stretch around ``at`` in which words p apart are equal."""
    right, step, last = at, 64, len(w) - p
    while right < last:
        stop = min(last, right + step)
        off = np.flatnonzero(w[right:stop] != w[right + p:stop + p])
        if off.size:
            right += int(off[0])
            break
        right, step = stop, 2 * step
    left, step = at, 64
    while left > 0:
        stop = max(0, left - step)
        off = np.flatnonzero(w[stop:left] != w[stop + p:left + p])
        if off.size:
            left = stop + int(off[-1]) + 1
            break
        left, step = stop, 2 * step
    return left, right + p


def _windows(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least (or greatest) value of every window of ``width`` places."""
    out, size = values, 1
    while 2 * size <= width:
        out, size = pick(out[:-size], out[size:]), 2 * size
    return pick(out[:len(values) - width + 1], out[width - size:width - size + len(values) - width + 1]) if size < width else out


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    got = _POWERS.get((base, prime))
    if got is None or len(got) < n:
        got, size = np.ones(1, np.uint64), 1
        while size < n:
            got, size = np.concatenate([got, got * np.uint64(pow(base, size, prime)) % np.uint64(prime)]), 2 * size
        _POWERS[base, prime] = got
    return got[:n]


class _Hashes:
    """Hashes of any number of following words."""

    def __init__(self, w: np.ndarray):
        self.sums = []
        code = (w.astype(np.uint64) + np.uint64(1 << 40)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        code ^= code >> np.uint64(32)
        for prime, base in zip(_PRIMES, _BASES):
            terms = code % np.uint64(prime) * _powers(base, prime, len(w)) % np.uint64(prime)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)]))

    def grams(self, k: int, n: int) -> np.ndarray:
        """Hash of the ``k`` words from each place on, among the first ``n`` words."""
        out = None
        for sums, prime, base in zip(self.sums, _PRIMES, _BASES):
            p = np.uint64(prime)
            h = (sums[k:n + 1] - sums[:n + 1 - k]) % p * _powers(pow(base, -1, prime), prime, n + 1 - k) % p
            out = h if out is None else out << np.uint64(31) | h
        return out.astype(np.int64)


def minimizers(h: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least value of some window of ``width`` places."""
    if len(h) < width:
        return np.zeros(0, np.int64)
    least = _windows(h, width, np.minimum)
    edge = np.full(width - 1, -1, np.int64)
    return np.flatnonzero(_windows(np.concatenate([edge, least, edge]), width, np.maximum) == h)


def _lag_seeds(w: np.ndarray, p: int, stretch: int) -> np.ndarray:
    """Places that every run of period ``p`` with ``stretch`` equal pairs holds one of."""
    stride = (stretch + 1) // 2
    stop = len(w) - p - stride + 1
    if stop <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(w[:stop:stride] == w[p:p + stop:stride]) * stride
    for t in range(1, stride):
        if not at.size:
            break
        at = at[w[at + t] == w[at + t + p]]
    return at


def runs_of(w: np.ndarray, sizes: list[int], min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of all runs in ``w``: texts of the given numbers of words, longest
    first, each followed by a number found nowhere else."""
    found: dict[tuple[int, int], int] = {}

    def grow(places: np.ndarray, periods: np.ndarray) -> None:
        known: dict[int, int] = {}  # by period: up to where pairs are known
        for at, p in zip(places.tolist(), periods.tolist()):
            if at < known.get(p, 0):
                continue
            start, end = _extend(w, at, p)
            known[p] = max(known.get(p, 0), end - p)
            if end - start >= max(min_length, MIN_PERIODS * p):
                found[start, end] = min(p, found.get((start, end), p))

    longest = max(sizes, default=0)
    for p in range(1, min(DIRECT, longest // MIN_PERIODS) + 1):
        at = _lag_seeds(w, p, max(min_length - p, (MIN_PERIODS - 1) * p))
        grow(at, np.full(len(at), p))
    hashes, ends = None, np.cumsum([s + 1 for s in sizes])
    for lo, hi in scales(longest // MIN_PERIODS):
        long = sum(s >= MIN_PERIODS * lo for s in sizes)
        n = int(ends[long - 1])
        if n < hi:
            continue
        hashes = hashes or _Hashes(w)
        h = hashes.grams(hi, n)
        at = minimizers(h, 2 * lo - hi + 1)
        at = at[np.argsort(h[at], kind="stable")]
        step = at[1:] - at[:-1]
        pair = np.flatnonzero((h[at[1:]] == h[at[:-1]]) & (step >= lo) & (step <= hi))
        place, period = at[pair], step[pair]
        order = np.lexsort((place, period))
        grow(place[order], period[order])
    return [(s, e, p) for (s, e), p in found.items()]


def _scan(texts: list[bytes], min_length: int) -> list[tuple[list[tuple[int, int, int]], bytes, int]]:
    """Per text its runs ``(start, length, period)``, the text without repeats, and its words."""
    words = [t.split() for t in texts]  # bytes: ASCII white space only
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    number: dict[bytes, int] = defaultdict(count().__next__)
    w = np.empty(sum(len(x) + 1 for x in words), np.int64)
    at, starts = 0, []
    for k, i in enumerate(order):
        n = len(words[i])
        w[at:at + n] = np.fromiter(map(number.__getitem__, words[i]), np.int64, n)
        w[at + n] = -1 - k
        starts.append(at)
        at += n + 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, e, p in runs_of(w, [len(words[i]) for i in order], min_length):
        k = int(np.searchsorted(starts, s, "right")) - 1
        runs[order[k]].append((s - starts[k], e - s, p))
    out = []
    for own, found in zip(words, runs):
        found.sort(key=lambda r: (r[0], r[2]))
        if found:
            gone = np.zeros(len(own) + 1, np.int64)
            for s, n, p in found:
                gone[s + p] += 1
                gone[s + n] -= 1
            gone = np.cumsum(gone)
            kept = b" ".join([x for x, g in zip(own, gone) if not g])
        else:
            kept = b" ".join(own)
        out.append((found, kept, len(own)))
    return out


def find_runs(docs: DataFrame, id_col: str = "doc_id", text: str | Column = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_words, runs`` (structs start, length, period, by
    start and period; word numbers from 0) and ``collapsed``, the text's words without those
    that a run holds after its first period, joined by one space."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), (F.col(f"`{text}`") if isinstance(text, str) else text).cast("binary").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    entry = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1)]
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop]) <= 6 * BATCH_WORDS):
                    size += len(texts[stop])
                    stop += 1
                found = _scan(texts[at:stop], min_length)
                spans = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs, _, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, stop - at), pa.array([n for _, _, n in found], pa.int64()), pa.array(spans, entry),
                     pa.array([t for _, t, _ in found], pa.binary()).cast(pa.string())], names=["_id", "n_words", "runs", "collapsed"])
                at = stop

    return rows.mapInArrow(run, f"_id {kind}, n_words long, runs {_RUNS}, collapsed string").withColumnRenamed("_id", id_col)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first."""
    return F.reduce(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
                    lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def run_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the strongest one, and SHA-256 of the runs and of the collapsed text."""
    best = strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = found.select(id_col, F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("_best"),
                       F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
    b = F.col("_best")
    return out.select(id_col, "n_runs", b["start"].alias("start"), b["length"].alias("length"), b["period"].alias("period"),
                      "runs_sha256", "collapsed_sha256", "n_words").withColumn("exponent_milli", F.expr("1000 * length div period"))
