"""Plane sweep over overlapping records with an active set (the engine of T6).

Records of a key are read in order (start, end, tie-break). The active set is a stack: a record
covers all earlier ones while it lasts, so the last one is on top, and an earlier record that
ends no later can never show again and leaves at once. Ends therefore grow from the
top down, every record is pushed and popped once, and the sweep is linear in the records,
however many overlap; its memory is the stack, not the key.

Python sees sorted streams of Arrow batches and works on two integer columns; other columns are
taken over by position. Rows that the stack still needs are the only ones kept between batches.

A hot key is cut into sub-buckets of time at points of its starts *and* ends. A record is swept in
the bucket of its start, once more in that of its end if that is another one, and between
them only the last record in order that spans a whole bucket can show, which is one row per
bucket. So no bucket holds more than its own points and one row, even if all records of a key
are open (equal starts and equal ends are reduced to what can show, before they meet).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from heapq import heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from effdated.operators import scan
from effdated.operators.scan import _join_on, _order_struct, qc


def _ints(column: pa.Array) -> list[int | None]:
    if pa.types.is_date32(column.type):
        column = column.cast(pa.int32())
    return column.cast(pa.int64()).to_pylist()


def _as(values: list[int], kind: pa.DataType) -> pa.Array:
    ints = pa.array(values, pa.int64())
    return ints.cast(pa.int32()).cast(kind) if pa.types.is_date32(kind) else ints.cast(kind)


def _group_starts(columns: list[pa.Array]) -> list[bool]:
    """Whether a row's group differs from the row before; nulls are equal to each other."""
    n = len(columns[0])
    new = [False] * n
    for c in columns:
        codes = c.dictionary_encode().indices.fill_null(-1)
        differs = pc.not_equal(codes.slice(1), codes.slice(0, n - 1)).to_pylist() if n > 1 else []
        for i, d in enumerate(differs, 1):
            new[i] = new[i] or d
    return new


class _Sweep:
    """The active set of one group and the pieces found so far."""

    def __init__(self):
        self.stack: list[tuple[int, int, int, bool]] = []  # end, row, high, cut; the last record in order on top
        self.ends: list[int] = []  # heap of the ends still to come, hidden ones too
        self.now = 0
        self.clear()

    def clear(self) -> None:
        self.src: list[int] = []
        self.begin: list[int] = []
        self.stop: list[int] = []

    def show(self, row: int, to: int, cut: bool) -> None:
        """``row`` is what shows from now to ``to``. With ``cut`` in one piece per elementary period."""
        while cut and self.ends and self.ends[0] < to:
            end = heappop(self.ends)
            if end > self.now:
                self.show(row, end, False)
        if to > self.now:
            self.src.append(row)
            self.begin.append(self.now)
            self.stop.append(to)
            self.now = to

    def settle(self, at: int | None) -> None:
        """Show what there is up to ``at`` (None: to the end of the group)."""
        stack = self.stack
        while stack and (at is None or stack[-1][0] <= at):
            end, row, high, cut = stack.pop()
            self.show(row, min(end, high), cut)
        if stack:
            self.show(stack[-1][1], at, stack[-1][3])

    def add(self, row: int, start: int, end: int, high: int, cut: bool, new: bool) -> None:
        if new:
            self.settle(None)
            self.ends.clear()
            self.now = start
        self.settle(start)
        self.now = max(self.now, start)
        while self.ends and self.ends[0] <= start:
            heappop(self.ends)
        heappush(self.ends, end)
        while self.stack and self.stack[-1][0] <= end:
            self.stack.pop()  # hidden from now on
        self.stack.append((end, row, high, cut))


#: Columns between those of the group and the values.
_FIXED = ["_start", "_end", "_low", "_high", "_cut"]


def _sweep_batches(batches: Iterator[pa.RecordBatch], n_groups: int) -> Iterator[pa.RecordBatch]:
    """Columns in: groups, ``_FIXED``, values; out: groups, values, from, to."""
    sweep = _Sweep()
    held: pa.Table | None = None  # rows of the stack
    last: tuple | None = None  # group of the row before
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        own = pa.Table.from_batches([batch])
        rows = own if held is None else pa.concat_tables([held, own])
        base = rows.num_rows - n
        starts, ends, lows, highs = (_ints(batch.column(n_groups + i)) for i in range(4))
        cuts = batch.column(n_groups + 4).to_pylist()
        new = _group_starts([batch.column(i) for i in range(n_groups)])
        new[0] = tuple(batch.column(i)[0].as_py() for i in range(n_groups)) != last
        last = tuple(batch.column(i)[n - 1].as_py() for i in range(n_groups))
        for i in range(n):
            low, high = lows[i], highs[i]
            start = starts[i] if low is None or starts[i] > low else low
            sweep.add(base + i, start, ends[i], ends[i] if high is None else high, cuts[i], new[i])
        if sweep.src:
            yield _pieces(rows, sweep, n_groups)
            sweep.clear()
        held = rows.take(pa.array([row for _, row, _, _ in sweep.stack], pa.int64()))
        sweep.stack = [(end, k, high, cut) for k, (end, _, high, cut) in enumerate(sweep.stack)]
    sweep.settle(None)
    if sweep.src:
        yield _pieces(held, sweep, n_groups)


def _pieces(rows: pa.Table, sweep: _Sweep, n_groups: int) -> pa.RecordBatch:
    kind = rows.schema.field(n_groups).type
    got = rows.take(pa.array(sweep.src, pa.int64()))
    wanted = [*range(n_groups), *range(n_groups + len(_FIXED), got.num_columns)]
    columns = [c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in (got.column(i).combine_chunks() for i in wanted)]
    return pa.RecordBatch.from_arrays([*columns, _as(sweep.begin, kind), _as(sweep.stop, kind)],
                                      names=[*[got.schema.names[i] for i in wanted], "_from", "_to"])


def _run(sorted_rows: DataFrame, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sweep rows that lie in one partition per group and are sorted; see ``_sweep_batches``."""
    fields = {f.name: f.dataType.simpleString() for f in sorted_rows.schema}
    quoted = ", ".join([*(f"`{c}` {fields[c]}" for c in (*groups, *values)), f"_from {fields['_start']}", f"_to {fields['_start']}"])
    n = len(groups)
    return sorted_rows.select(*groups, *_FIXED, *values).mapInArrow(lambda batches: _sweep_batches(batches, n), quoted)


def _columns(df: DataFrame, key: str, start: str, end: str, value_cols: Sequence[str]) -> DataFrame:
    """Names of our own, so that nothing clashes: ``_g, _start, _end, _v0...`` and the order ``_o``."""
    return df.select(qc(key).alias("_g"), qc(start).alias("_start"), qc(end).alias("_end"),
                     *[qc(c).alias(f"_v{i}") for i, c in enumerate(value_cols)], "_o")


def visible_pieces(df: DataFrame, key: str, start: str, end: str, value_cols: Sequence[str], order: Sequence[str],
                   hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """``key, value_cols, start, end``: what each record covers that no later one (in ``order``, which
    begins with start and end) covers too. Starts and ends are set and start < end.

    A record with a null among its values gives a piece per elementary period (between two starts or
    ends of the key), since nulls are never merged; any other one a piece per stretch."""
    values = [f"_v{i}" for i in range(len(value_cols))]
    rows = _columns(df.withColumn("_o", _order_struct(list(order))), key, start, end, value_cols)
    rows = rows.withColumn("_cut", reduce(lambda a, b: a | b, [F.col(v).isNull() for v in values], F.lit(False)))
    nothing = F.lit(None).cast(rows.schema["_start"].dataType)
    stats = scan._hot_keys(rows, ["_g"], hot_rows)
    if stats is None:
        spread = rows.withColumn("_sub", F.lit(0)).withColumn("_low", nothing).withColumn("_high", nothing)
    else:
        rows = scan.stored(rows, "sweep-input")  # read by the sample and by the sweep
        spread = _bucketed(rows, scan.split_points(rows, ["_g"], F.col("_start"), F.col("_end"), stats), nothing)
    laid = spread.repartition(F.col("_g"), F.col("_sub")).sortWithinPartitions("_g", "_sub", "_o")
    out = _run(laid, ["_g", "_sub"], values)
    return out.select(F.col("_g").alias(key), *[F.col(v).alias(c) for v, c in zip(values, value_cols)], F.col("_from").alias(start), F.col("_to").alias(end))


def _bucketed(rows: DataFrame, splits: DataFrame, nothing) -> DataFrame:
    """Rows dealt into buckets of time; ``_low`` and ``_high`` bound what a bucket of a hot key shows."""
    known = (_join_on(rows, splits, ["_g"], "left")
             .withColumn("_first", scan.bucket_of(F.col("_splits"), F.col("_start")))
             .withColumn("_last", scan.bucket_of(F.col("_splits"), F.col("_end"))).drop("_splits"))
    placed = scan.stored(known, "sweep")
    cold, hot = placed.filter("_first = 0"), placed.filter("_first > 0")
    base = [c for c in placed.columns if c not in ("_first", "_last")]
    every = F.struct(*[F.col(c) for c in base if c != "_g"])
    last_of = F.max_by(every, F.col("_o")).alias("_r")
    # of records that start together only the last in order can show, and so of those that end together in a later bucket
    own = hot.groupBy("_g", "_start", "_first").agg(last_of).select("_g", "_r.*", F.col("_first").alias("_sub"))
    # (those that start in the bucket apart: they hide nothing before they start, but their ends count)
    ending = (hot.groupBy("_g", "_end", "_last", (F.col("_first") == F.col("_last")).alias("_inside")).agg(last_of)
              .select("_g", "_r.*", F.col("_last").alias("_sub")))
    # of those that span a bucket: the last in order per (first, last), then per bucket between them
    spans = hot.filter("_last > _first + 1").groupBy("_g", "_first", "_last").agg(last_of)
    between = spans.select("_g", "_r", F.explode(F.sequence(F.col("_first") + 1, F.col("_last") - 1)).alias("_sub"))
    spanning = between.groupBy("_g", "_sub").agg(F.max_by("_r", F.col("_r._o")).alias("_r")).select("_g", "_r.*", "_sub")
    columns = own.columns
    union = own.unionByName(ending.select(*columns)).unionByName(spanning.select(*columns))
    # a bucket of a hot key shows from its split point to the next one
    edges = splits.select("_g", F.posexplode("_splits").alias("_at", "_low")).select("_g", (F.col("_at") + 2).alias("_sub"), "_low")
    edges = splits.select("_g", F.lit(1).alias("_sub"), nothing.alias("_low")).unionByName(edges)
    edges = edges.withColumn("_high", F.lead("_low").over(Window.partitionBy("_g").orderBy("_sub")))
    whole = cold.select(*base, F.lit(0).alias("_sub"), nothing.alias("_low"), nothing.alias("_high"))
    return _join_on(union, edges, ["_g", "_sub"], "left").unionByName(whole)
