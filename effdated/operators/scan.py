"""Skew-safe ordered scans per key (the engine under every gaps-and-islands operator).

Runs, overlap islands, shift chains and ranks are prefix scans over the rows of
one key in time order. ``Window.partitionBy(key)`` computes them, but places every
row of a key in one task: if one employee code holds a third of all rows, one task
sorts a third of the data. A :class:`ScanLayout` therefore can split *hot* keys into ordered
sub-buckets. Which keys are hot is a statistic of a table, taken once in a step of its own:
:func:`key_statistics` counts rows per key and writes the keys of more than ``limit`` rows (what a
task should hold) as a small table, and all scans on that key take it as ``hot_rows``. Without hot
keys, and without statistics, a scan is the plain window plan and building it runs no job.
(``hot_rows`` may also be a number, or the setting ``effdated.scan.hotKeyRows``: then each
scan counts for itself.) With hot keys (null keys too):

1. The statistics name them (``groupBy(key).count()`` with map-side partial aggregation). There are
   at most ``rows / limit`` of them, which bounds the broadcast.
2. A deterministic sample of each hot key's rows (``rand(seed)`` at a rate giving
   ~``SAMPLES_PER_SPLIT`` rows per sub-bucket) gives ordered split points.
3. Each row gets ``_sub`` = 1 + number of split points <= its order value. The lookup
   is a binary search written as an ``aggregate`` lambda, so it stays JVM-side and
   costs O(log splits). Rows of ordinary keys get ``_sub = 0``.
4. Window functions partition by ``(key, _sub)``: no window group holds more than
   about ``hotKeyRows`` rows, and a hot key is spread over many tasks.
5. The sub-buckets of a hot key are joined up through small carry tables. Each has
   one row per hot sub-bucket (bounded by rows / hotKeyRows) and is broadcast-joined
   back on ``(key, _sub)``, so no extra shuffle of the data is needed.

``_sub`` is a pure function of the row and of a seeded sample, so a stage
recomputed after an executor loss assigns every row to the same sub-bucket.

Ordering is ascending with nulls last (the order pandas ``sort_values`` uses).
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from effdated.session import ensure_checkpoint_dir

HOT_ROWS_CONF = "effdated.scan.hotKeyRows"
SAMPLES_PER_SPLIT = 8
SAMPLE_SEED = 7177
MAX_BROADCAST_ROWS = 1_000_000  # carry / split tables above this many sub-buckets are not broadcast


#: Rows of one key that a task should hold.
DEFAULT_LIMIT = 4_000_000


@dataclass(frozen=True)
class KeyStatistics:
    """The keys of a table with more than ``limit`` rows: ``_k0, ..., _n``, and the sub-buckets they need."""

    hot: DataFrame
    limit: int
    n_sub: int

    def named(self, keys: list[str]) -> DataFrame:
        """``keys, _n, _nsub`` under the names that a scan uses."""
        if len(self.hot.columns) != len(keys) + 1:
            raise ValueError(f"statistics of {len(self.hot.columns) - 1} key columns for a scan on {keys}")
        sized = self.hot.withColumn("_nsub", F.ceil(F.col("_n") / F.lit(self.limit)).cast("int"))
        return sized.withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keys)})


#: Named statistics by session and path.
_TAKEN: dict[tuple[str, str], KeyStatistics] = {}


def key_statistics(df: DataFrame, keys: list[str], limit: int | None = None, name: str | None = None) -> KeyStatistics:
    """Count the rows of ``df`` per key, write the hot keys to the session's shared folder, and return
    them for any number of scans. A step of its own: it runs a job when called. With ``name``
    (e.g. of the table) a later call in the same folder reads what is written, and one in the
    same session runs no job at all."""
    spark = df.sparkSession
    limit = limit or int(spark.conf.get(HOT_ROWS_CONF, None) or DEFAULT_LIMIT)
    label = "key-statistics-" + (hashlib.md5(repr((name, keys, limit)).encode()).hexdigest() if name else uuid.uuid4().hex)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}"
    known = (spark.sparkContext.applicationId, path)
    if known in _TAKEN:
        return _TAKEN[known]
    counts = df.groupBy(*[qc(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    if not (name and _is_written(spark, path)):
        counts.coalesce(1).write.mode("overwrite").parquet(path)
    hot = spark.read.schema(counts.schema).parquet(path)
    stats = KeyStatistics(hot, limit, hot.agg(F.sum(F.ceil(F.col("_n") / F.lit(limit)))).first()[0] or 0)
    if name:
        _TAKEN[known] = stats
    return stats


def _is_written(spark, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _hot_keys(df: DataFrame, keys: list[str], hot_rows: int | KeyStatistics | None) -> KeyStatistics | None:
    """The statistics that a scan splits by, or None."""
    if hot_rows is None:
        v = df.sparkSession.conf.get(HOT_ROWS_CONF, None)
        hot_rows = int(v) if v else None
    if isinstance(hot_rows, int):
        hot_rows = key_statistics(df, keys, hot_rows)
    return hot_rows if hot_rows is not None and hot_rows.n_sub else None


def qc(name: str) -> Column:
    """Column by literal name: backquoted, so names with dots or spaces (raw headers such
    as ``Current Class.1``) are not read as struct access."""
    return F.col("`" + name.replace("`", "``") + "`")


def qcs(names) -> list[Column]:
    return [qc(n) for n in names]


def _order_struct(order: list[str]) -> Column:
    # (c IS NULL, c) pairs make struct comparison order nulls last.
    parts = []
    for i, c in enumerate(order):
        parts.append(qc(c).isNull().alias(f"n{i}"))
        parts.append(qc(c).alias(f"v{i}"))
    return F.struct(*parts)


# upper_bound(_splits, _o): number of split points <= _o, by bisection.
_UPPER_BOUND = (
    "aggregate(sequence(1, cast(ceil(log2(size(_splits) + 1)) as int) + 1), "
    "named_struct('lo', 0, 'hi', size(_splits)), "
    "(acc, i) -> if(acc.lo >= acc.hi, acc, "
    "if(element_at(_splits, cast((acc.lo + acc.hi) div 2 as int) + 1) <= _o, "
    "named_struct('lo', cast((acc.lo + acc.hi) div 2 as int) + 1, 'hi', acc.hi), "
    "named_struct('lo', acc.lo, 'hi', cast((acc.lo + acc.hi) div 2 as int)))), "
    "acc -> acc.lo)"
)


def _settled(df: DataFrame) -> DataFrame:
    """The size check reads ``df`` before the scan does. If ``df`` is a computed plan (joins,
    windows, aggregates), it is checkpointed first, so that neither the check nor the scan
    repeats what came before; a plain file scan is read twice. Nothing stays cached."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if not any(op in plan for op in ("Join ", "Window ", "Aggregate ", "Repartition")):
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys are equal, keeping the left key columns."""
    other = right.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)})
    cond = reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(other[f"_r{i}"]) for i, k in enumerate(keys)])
    return left.join(other, cond, how).drop(*[f"_r{i}" for i in range(len(keys))])


@dataclass
class ScanLayout:
    """A DataFrame plus the (keys, sub-bucket, order) it is scanned by."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    sub: str = "_sub"
    extra: dict = field(default_factory=dict)
    split: bool = True  # False: no hot key, every _sub is 0 and no carry is needed
    small: bool = True  # carry tables (one row per hot sub-bucket) are below MAX_BROADCAST_ROWS

    def bcast(self, df: DataFrame) -> DataFrame:
        """Broadcast a carry table only when its checked size allows; else a plain join
        (AQE picks sort-merge and splits skew)."""
        return F.broadcast(df) if self.small else df

    @property
    def part(self) -> list[str]:
        # unsplit: partition by the key alone so later groupBy(key, ...) reuses it
        return [*self.keys, self.sub] if self.split else list(self.keys)

    def window(self) -> Window:
        return Window.partitionBy(*qcs(self.part)).orderBy(
            *[qc(c).asc_nulls_last() for c in self.order])

    def with_df(self, df: DataFrame) -> "ScanLayout":
        return ScanLayout(df, self.keys, self.order, self.sub, self.extra, self.split, self.small)

    def hot(self, df: DataFrame | None = None) -> DataFrame:
        d = self.df if df is None else df
        return d.filter(F.col(self.sub) > 0)

    def sub_window(self) -> Window:
        return Window.partitionBy(*qcs(self.keys)).orderBy(self.sub)


def layout(df: DataFrame, keys: list[str], order: list[str],
           hot_rows: int | KeyStatistics | None = None) -> ScanLayout:
    """Assign ``_sub`` sub-buckets so that no (key, _sub) group exceeds about the limit of the statistics."""
    if isinstance(hot_rows, int) or (hot_rows is None and df.sparkSession.conf.get(HOT_ROWS_CONF, None)):
        df = _settled(df)
    stats = _hot_keys(df, list(keys), hot_rows)
    if stats is None:
        # No hot key, or no statistics: a plain per-key window plan, and no job while it is built.
        return ScanLayout(df.withColumn("_sub", F.lit(0)), list(keys), list(order), split=False)
    if isinstance(hot_rows, KeyStatistics):
        df = _settled(df)  # read by the sample and by the scan
    # The number of sub-buckets bounds every table this layout broadcasts.
    hot, n_sub = stats.named(list(keys)), stats.n_sub
    small = n_sub <= MAX_BROADCAST_ROWS
    bc = F.broadcast if small else (lambda x: x)
    with_o = df.withColumn("_o", _order_struct(order))
    sample = (_join_on(with_o.select(*qcs(keys), "_o"), bc(hot), keys)
              .filter(F.rand(SAMPLE_SEED) <
                      F.least(F.lit(1.0), F.lit(SAMPLES_PER_SPLIT) * F.col("_nsub") / F.col("_n"))))
    splits = (sample.groupBy(*qcs(keys))
              .agg(F.array_sort(F.collect_list("_o")).alias("_s"), F.first("_nsub").alias("_nsub"))
              .filter(F.size("_s") > 0)
              .select(*qcs(keys), F.expr(
                  "array_distinct(transform(sequence(1, greatest(_nsub - 1, 1)), "
                  "i -> _s[cast(floor(i * size(_s) / _nsub) as int)]))").alias("_splits")))
    out = (_join_on(with_o, bc(splits), keys, "left")
           .withColumn("_sub", F.when(F.col("_splits").isNull(), F.lit(0))
                       .otherwise(F.expr(_UPPER_BOUND) + 1))
           .drop("_splits", "_o"))
    # Every carry table re-reads this frame; stacked scans would otherwise copy the
    # upstream plan into each branch (exponential plan size). A reliable checkpoint in
    # the session's checkpoint dir (shared on a cluster) makes it a leaf and also cuts
    # the lineage that a lost executor would replay. This runs only when a hot key exists.
    ensure_checkpoint_dir(df.sparkSession)
    out = out.checkpoint(eager=True)
    return ScanLayout(out, list(keys), list(order), small=small)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the session's shared folder and read it back: a leaf for several readers,
    which a lost executor re-reads instead of recomputing."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_points(df: DataFrame, keys: list[str], low: Column, high: Column, stats: KeyStatistics) -> DataFrame:
    """``keys, _splits`` for the hot keys of ``stats``: sorted points, taken from a seeded sample of both
    ``low`` and ``high``, that cut a key into parts of about ``stats.limit`` rows."""
    hot = stats.named(keys).withColumn("_nsub", 2 * F.col("_nsub"))
    n_sub = 2 * stats.n_sub
    side = F.broadcast(hot) if n_sub <= MAX_BROADCAST_ROWS else hot
    points = df.select(*qcs(keys), F.explode(F.array(low, high)).alias("_p"))
    sample = _join_on(points, side, keys).filter(
        F.rand(SAMPLE_SEED) < F.least(F.lit(1.0), F.lit(SAMPLES_PER_SPLIT) * F.col("_nsub") / (2 * F.col("_n"))))
    splits = (sample.groupBy(*qcs(keys)).agg(F.array_sort(F.collect_list("_p")).alias("_s"), F.first("_nsub").alias("_nsub"))
              .select(*qcs(keys), F.expr(
                  "array_distinct(transform(sequence(1, greatest(_nsub - 1, 1)), "
                  "i -> _s[cast(floor(i * size(_s) / _nsub) as int)]))").alias("_splits")))
    return stored(splits, "split-points")


def bucket_of(splits: Column, point: Column) -> Column:
    """1 + number of split points <= ``point`` by bisection; 0 where ``splits`` is null."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(splits) + 1)).cast("int") + 1)

    def halve(acc, _):
        mid = ((acc["lo"] + acc["hi"]) / 2).cast("int")
        right = F.get(splits, mid) <= point
        return F.when(acc["lo"] >= acc["hi"], acc).otherwise(
            F.struct(F.when(right, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(right, acc["hi"]).otherwise(mid).alias("hi")))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(splits).alias("hi")), halve, lambda acc: acc["lo"])
    return F.when(splits.isNull(), 0).otherwise(found + 1)


def with_prev(lay: ScanLayout, cols: list[str], prefix: str = "_prev_") -> ScanLayout:
    """Add ``_prev_<c>`` (value on the previous row of the same key) and ``_has_prev``."""
    w = lay.window()
    if not lay.split:
        d = lay.df
        for c in cols:
            d = d.withColumn(prefix + c, F.lag(qc(c)).over(w))
        return lay.with_df(d.withColumn("_has_prev", F.lag(F.lit(1)).over(w).isNotNull()))
    tail = (lay.hot().groupBy(*qcs(lay.part))
            .agg(F.max_by(F.struct(*qcs(cols)), _order_struct(lay.order)).alias("_last")))
    carry = (tail.withColumn("_carry", F.lag("_last").over(lay.sub_window()))
             .select(*qcs(lay.part), "_carry"))
    d = _join_on(lay.df, lay.bcast(carry), lay.part, "left")
    first = F.lag(F.lit(1)).over(w).isNull()
    for c in cols:
        d = d.withColumn(prefix + c, F.when(first, F.col("_carry")[c]).otherwise(F.lag(qc(c)).over(w)))
    d = d.withColumn("_has_prev", ~first | F.col("_carry").isNotNull()).drop("_carry")
    return lay.with_df(d)


def with_next(lay: ScanLayout, cols: list[str], prefix: str = "_next_") -> ScanLayout:
    """Add ``_next_<c>`` (value on the next row of the same key) and ``_has_next``."""
    w = lay.window()
    if not lay.split:
        d = lay.df
        for c in cols:
            d = d.withColumn(prefix + c, F.lead(qc(c)).over(w))
        return lay.with_df(d.withColumn("_has_next", F.lead(F.lit(1)).over(w).isNotNull()))
    head = (lay.hot().groupBy(*qcs(lay.part))
            .agg(F.min_by(F.struct(*qcs(cols)), _order_struct(lay.order)).alias("_first")))
    carry = (head.withColumn("_carry", F.lead("_first").over(lay.sub_window()))
             .select(*qcs(lay.part), "_carry"))
    d = _join_on(lay.df, lay.bcast(carry), lay.part, "left")
    last = F.lead(F.lit(1)).over(w).isNull()
    for c in cols:
        d = d.withColumn(prefix + c, F.when(last, F.col("_carry")[c]).otherwise(F.lead(qc(c)).over(w)))
    d = d.withColumn("_has_next", ~last | F.col("_carry").isNotNull()).drop("_carry")
    return lay.with_df(d)


def with_prefix_max_prev(lay: ScanLayout, col: str, out: str) -> ScanLayout:
    """``out`` = max of ``col`` over all earlier rows of the same key (null if none)."""
    w = lay.window().rowsBetween(Window.unboundedPreceding, -1)
    if not lay.split:
        return lay.with_df(lay.df.withColumn(out, F.max(qc(col)).over(w)))
    sub_max = lay.hot().groupBy(*qcs(lay.part)).agg(F.max(qc(col)).alias("_m"))
    carry = (sub_max.withColumn("_cm", F.max("_m").over(
        lay.sub_window().rowsBetween(Window.unboundedPreceding, -1)))
        .select(*qcs(lay.part), "_cm"))
    d = (_join_on(lay.df, lay.bcast(carry), lay.part, "left")
         .withColumn(out, F.greatest(F.max(qc(col)).over(w), F.col("_cm"))).drop("_cm"))
    return lay.with_df(d)


def with_prefix_count(lay: ScanLayout, flag: Column | None, out: str) -> ScanLayout:
    """``out`` = running count (inclusive) of rows (or of rows where ``flag``) in key order."""
    ind = F.lit(1) if flag is None else F.when(flag, 1).otherwise(0)
    d = lay.df.withColumn("_ind", ind)
    if not lay.split:
        w = lay.window().rowsBetween(Window.unboundedPreceding, 0)
        return lay.with_df(d.withColumn(out, F.sum("_ind").over(w)).drop("_ind"))
    sub_n = lay.hot(d).groupBy(*qcs(lay.part)).agg(F.sum("_ind").alias("_c"))
    carry = (sub_n.withColumn("_cc", F.sum("_c").over(
        lay.sub_window().rowsBetween(Window.unboundedPreceding, -1)))
        .select(*qcs(lay.part), "_cc"))
    w = lay.window().rowsBetween(Window.unboundedPreceding, 0)
    d = (_join_on(d, lay.bcast(carry), lay.part, "left")
         .withColumn(out, F.sum("_ind").over(w) + F.coalesce(F.col("_cc"), F.lit(0)))
         .drop("_ind", "_cc"))
    return lay.with_df(d)


def with_segments(lay: ScanLayout, starts: Column, out: str) -> ScanLayout:
    """Number segments (runs / islands) 1, 2, 3, ... per key in order.

    A new segment begins on rows where ``starts`` (it must be true on the first row
    of every key): the id is the running count of segment starts, carried across the
    sub-buckets of a hot key, so ids do not depend on how a key was split.
    """
    return with_prefix_count(lay, starts, out)


def runs_layout(df: DataFrame, keys: list[str], seg: str, sub: str = "_sub",
                split: bool = True, small: bool = True) -> ScanLayout:
    """Layout for a table with one row per segment; ``sub`` is the segment's first sub-bucket."""
    return ScanLayout(df, list(keys), [seg], sub, split=split, small=small)


def with_last_non_null(lay: ScanLayout, col: str, out: str) -> ScanLayout:
    """``out`` = last non-null value of ``col`` at or before each row (forward fill)."""
    w = lay.window().rowsBetween(Window.unboundedPreceding, 0)
    if not lay.split:
        return lay.with_df(lay.df.withColumn(out, F.last(qc(col), ignorenulls=True).over(w)))
    keep = F.when(qc(col).isNotNull(), _order_struct(lay.order))
    sub_last = lay.hot().groupBy(*qcs(lay.part)).agg(F.max_by(qc(col), keep).alias("_l"))
    carry = (sub_last.withColumn("_cl", F.last("_l", ignorenulls=True).over(
        lay.sub_window().rowsBetween(Window.unboundedPreceding, -1)))
        .select(*qcs(lay.part), "_cl"))
    d = (_join_on(lay.df, lay.bcast(carry), lay.part, "left")
         .withColumn(out, F.coalesce(F.last(qc(col), ignorenulls=True).over(w), F.col("_cl")))
         .drop("_cl"))
    return lay.with_df(d)
