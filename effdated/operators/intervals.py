"""Effective-dated interval operators.

All run / island logic goes through :mod:`effdated.operators.scan`, so a key holding a
large share of all rows is split over many tasks. Null rules follow the pandas
originals this toolkit replaces (see README "Semantics"):

* a null value never equals its predecessor, so every null starts its own run;
* ``first`` / ``last`` aggregates skip nulls; ``unique`` keeps them;
* order is ascending with nulls last; callers pass tie-break columns for determinism.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effdated.operators import scan
from effdated.operators.aggregate import agg_expr
from effdated.operators.scan import _order_struct, qc, qcs
from effdated.operators.sweep import visible_pieces


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _value_changed(cols: Sequence[str], prefix: str = "_prev_") -> Column:
    """True when any column differs from the previous row; null on either side counts as a change."""
    terms = [~F.coalesce(qc(c) == qc(prefix + c), F.lit(False)) for c in cols]
    return reduce(lambda a, b: a | b, terms)


def _drop_prev(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return df.drop(*[prefix + c for c in cols], "_has_prev", "_has_next")


def mark_runs(df: DataFrame, key_col: str, value_cols: Sequence[str], order: Sequence[str],
              out: str = "run_id", hot_rows: int | scan.KeyStatistics | None = None) -> scan.ScanLayout:
    """W1 + W2: change flag versus the previous row of the key, running run id."""
    lay = scan.layout(df, [key_col], list(order), hot_rows)
    lay = scan.with_prev(lay, list(value_cols))
    starts = ~F.col("_has_prev") | qc(key_col).isNull() | _value_changed(value_cols)
    lay = scan.with_segments(lay, starts, out)
    return lay.with_df(_drop_prev(lay.df, value_cols, "_prev_"))


def _aggregate_runs(lay: scan.ScanLayout, key_col: str, run: str,
                    settings: Mapping[str, str]) -> DataFrame:
    order = _order_struct(lay.order)
    aggs = [agg_expr(c, how, order).alias(c) for c, how in settings.items() if c != key_col]
    return lay.df.groupBy(qc(key_col), qc(run)).agg(*aggs, F.min(lay.sub).alias(lay.sub))


def flatten_effective_date(df: DataFrame, key_col: str, flat_col: str | Sequence[str],
                           effective_date: str, agg_settings: Mapping[str, str] | None = None,
                           order_by: Sequence[str] = (), hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """Collapse consecutive rows with equal ``flat_col`` into one effective-dated row.

    Rows with a null key are dropped. Output: ``key_col``, the ``agg_settings``
    columns (the effective date renamed ``StartDate``, default aggregate ``min``) and
    ``EndDate`` = the next run's ``StartDate`` for the same key (null on the last run).
    """
    flat_cols = _as_list(flat_col)
    settings = dict(agg_settings or {c: "first" for c in flat_cols})
    settings.setdefault(effective_date, "min")
    d = df.filter(qc(key_col).isNotNull())
    lay = mark_runs(d, key_col, flat_cols, [effective_date, *order_by], "_run", hot_rows)
    runs = _aggregate_runs(lay, key_col, "_run", settings)
    rl = scan.with_next(scan.runs_layout(runs, [key_col], "_run", split=lay.split, small=lay.small),
                        [effective_date])
    end = F.when(F.col("_has_next"), qc("_next_" + effective_date))
    cols = [qc(key_col)] + [
        qc(c).alias("StartDate") if c == effective_date else qc(c)
        for c in settings if c != key_col]
    return rl.df.select(*cols, end.alias("EndDate"))


def flatten(df: DataFrame, index: str, start_date: str, end_date: str,
            flatcol: Sequence[str], agg_settings: Mapping[str, str] | None = None,
            order_by: Sequence[str] = (), hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """T3 (YAML ``flatten``): runs over several value columns; keeps the column names
    ``start_date`` / ``end_date`` instead of StartDate / EndDate."""
    settings = dict(agg_settings or {})
    for c in flatcol:
        settings.setdefault(c, "first")
    out = flatten_effective_date(df, index, list(flatcol), start_date, settings, order_by, hot_rows)
    return out.withColumnRenamed("StartDate", start_date).withColumnRenamed("EndDate", end_date)


def group_multiple_date(df: DataFrame, key_col: str, group_col: str | Sequence[str],
                        period_start: str, period_end: str,
                        agg_settings: Mapping[str, str] | None = None,
                        order_by: Sequence[str] = (), hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """Consecutive rows (by start) with equal ``group_col`` become one row with
    ``min(start)`` / ``max(end)``. Gaps do not break a run; null keys each form their own run."""
    groups = _as_list(group_col)
    settings = dict(agg_settings or {})
    for g in groups:
        settings.setdefault(g, "first")
    settings[period_start] = "min"
    settings[period_end] = "max"
    lay = mark_runs(df, key_col, groups, [period_start, *order_by], "_run", hot_rows)
    runs = _aggregate_runs(lay, key_col, "_run", settings)
    return runs.select(qc(key_col), *[qc(c) for c in settings if c != key_col])


def _island_layout(df: DataFrame, key: str | Sequence[str], start: str, end: str, order: Sequence[str],
                   gap: Column | None, out: str, hot_rows: int | scan.KeyStatistics | None,
                   keep_pme: bool = False) -> scan.ScanLayout:
    lay = scan.layout(df, _as_list(key), list(order), hot_rows)
    lay = scan.with_prefix_max_prev(lay, end, "_pme")
    reach = F.col("_pme") if gap is None else F.col("_pme") + gap
    starts = ~F.coalesce(F.col(start) < reach, F.lit(False))
    lay = lay.with_df(lay.df.withColumn("_isl_start", starts))
    lay = scan.with_segments(lay, F.col("_isl_start"), out)
    lay = scan.with_next(lay, ["_isl_start"])
    multi = ~F.col("_isl_start") | (F.col("_has_next") & ~F.col("_next__isl_start"))
    d = (lay.df.withColumn("_multi", multi)
         .drop(*([] if keep_pme else ["_pme"]), "_next__isl_start", "_has_next"))
    return lay.with_df(d)


def add_overlapping_identifier(df: DataFrame, key: str | Sequence[str], start: str, end: str,
                               group_records: bool = False, order_by: Sequence[str] = (),
                               index_col: str = "overlapping_index",
                               flag_col: str = "is_overlapping",
                               hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """Number overlap islands per key and flag rows whose island has > 1 member.

    Intervals are half-open: an interval starting exactly at the running maximum end
    of the earlier ones starts a new island (touching is not overlapping). A nested
    interval does not end the island (running max, not plain ``lag``).
    With ``group_records`` rows sharing (key, start, end) count as one period, so
    several lines of one payslip do not overlap each other.
    """
    if not group_records:
        lay = _island_layout(df, key, start, end, [start, end, *order_by], None, index_col, hot_rows)
        return (lay.df.withColumnRenamed("_multi", flag_col).drop("_isl_start", "_sub"))
    keys = _as_list(key)
    periods = df.groupBy(*qcs(keys), qc(start), qc(end)).agg(F.count(F.lit(1)).alias("_rows"))
    lay = _island_layout(periods, keys, start, end, [start, end], None, index_col, hot_rows)
    flags = lay.df.select(*[qc(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          qc(start).alias("_s"), qc(end).alias("_e"), index_col, F.col("_multi").alias(flag_col))
    cond = qc(start).eqNullSafe(F.col("_s")) & qc(end).eqNullSafe(F.col("_e"))
    for i, k in enumerate(keys):
        cond = cond & qc(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(flags, cond, "left").drop(*[f"_k{i}" for i in range(len(keys))], "_s", "_e")


def chain_with_gap(df: DataFrame, key: str, start: str, end: str, gap: Column,
                   order_by: Sequence[str] = (), index_col: str = "chain_index",
                   flag_col: str = "is_chained", hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """T9 core: like W6 but rows whose start lies less than ``gap`` after the running
    max end join the same chain (``session_window`` semantics per key)."""
    lay = _island_layout(df, key, start, end, [start, end, *order_by], gap, index_col, hot_rows)
    return lay.df.withColumnRenamed("_multi", flag_col).drop("_isl_start", "_sub")


def _duration(start: str, end: str) -> Column:
    return F.col(end) - F.col(start)


def pick_longest(df: DataFrame, key: str, start: str, end: str, id_col: str,
                 order_by: Sequence[str] = (), flag_col: str = "is_longest",
                 hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """Within each overlap island flag the longest record (ties: earlier start, then
    smaller ``id_col``). Non-overlapping rows are their own island and are kept.

    The survivor is chosen with ``min_by`` (partial aggregation, so a large island
    is pre-reduced map-side) and joined back on (key, island); ``id_col`` need only be unique
    among records of equal period in an island.
    """
    isl = add_overlapping_identifier(df, key, start, end, False, [*order_by, id_col],
                                     "_island", "_ov", hot_rows)
    dur = _duration(start, end)
    rank = F.struct(dur.isNull().alias("a"), (-dur).alias("b"), F.col(start).isNull().alias("c"),
                    F.col(start).alias("d"), F.col(id_col).alias("e"))
    won = (isl.groupBy(qc(key).alias("_wkey"), F.col("_island").alias("_wisland"))
           .agg(F.min_by(F.struct(F.col(start), F.col(end), F.col(id_col).alias("id")), rank).alias("_win")))
    same = qc(key).eqNullSafe(F.col("_wkey")) & (F.col("_island") == F.col("_wisland"))
    picked = (F.col(id_col).eqNullSafe(F.col("_win.id")) & F.col(start).eqNullSafe(F.col("_win")[start])
              & F.col(end).eqNullSafe(F.col("_win")[end]))
    return (isl.join(won, same, "left").withColumn(flag_col, F.coalesce(picked, F.lit(False)))
            .drop("_win", "_wkey", "_wisland", "_island", "_ov"))


def unify_overlapping(df: DataFrame, key: str, start: str, end: str, code_col: str | None = None,
                      order_by: Sequence[str] = (), hot_rows: int | scan.KeyStatistics | None = None,
                      group_records: bool = False) -> DataFrame:
    """T5: every row of an overlap island gets the island's min start, max end and the
    first ``code_col`` value (in start order)."""
    isl = add_overlapping_identifier(df, key, start, end, group_records, order_by, "_island", "_ov", hot_rows)
    order = _order_struct([start, end, *order_by])
    aggs = [F.min(start).alias("_ustart"), F.max(end).alias("_uend")]
    if code_col:
        aggs.append(agg_expr(code_col, "first", order).alias("_ucode"))
    spans = isl.groupBy(qc(key).alias("_ukey"), F.col("_island").alias("_uisland")).agg(*aggs)
    out = (isl.join(spans, qc(key).eqNullSafe(F.col("_ukey")) & (F.col("_island") == F.col("_uisland")), "left")
           .withColumn(start, F.col("_ustart")).withColumn(end, F.col("_uend")))
    if code_col:
        out = out.withColumn(code_col, F.col("_ucode"))
    return out.drop("_ustart", "_uend", "_ucode", "_ukey", "_uisland", "_island", "_ov")


_OPEN_END = "9999-12-31 00:00:00"  # stands for a null end while periods are compared


def remove_overlaps_and_flatten(df: DataFrame, key: str, start: str, end: str,
                                value_cols: Sequence[str], order_by: Sequence[str] = (),
                                hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """Per key, non-overlapping periods that cover exactly what the records cover.

    Where records overlap, the one that comes last in (start, end, ``order_by``) order
    wins; an earlier record goes on after a shorter later one ends. Then consecutive
    pieces with equal values and no gap between them are merged. A null end is open and
    stays null; empty periods are dropped; records without a start are kept as they are.

    Records that overlap nothing pass through; the others are swept with an active set
    (:mod:`effdated.operators.sweep`), linear after the sort, whatever the size of an island.
    """
    kind = df.schema[start].dataType
    far = F.lit(_OPEN_END).cast("timestamp_ntz").cast(kind)
    order = [start, "_end", *order_by]
    d = df.filter(F.col(start).isNotNull()).withColumn("_end", F.coalesce(F.col(end).cast(kind), far))
    d = d.filter(F.col("_end") > F.col(start))
    isl = add_overlapping_identifier(d, key, start, "_end", False, order_by, "_island", "_multi", hot_rows)
    cols = [qc(key), *qcs(value_cols), F.col(start), F.col("_end")]
    alone = isl.filter(~F.col("_multi")).select(*cols)
    pieces = alone.unionByName(visible_pieces(isl.filter("_multi"), key, start, "_end", value_cols, order, hot_rows))
    lay = scan.layout(pieces, [key], [start], hot_rows)
    lay = scan.with_prev(lay, [*value_cols, "_end"])
    starts = (~F.col("_has_prev") | _value_changed(value_cols)
              | ~F.coalesce(F.col(start) <= F.col("_prev__end"), F.lit(False)))
    lay = scan.with_segments(lay, starts, "_run")
    out = (lay.df.groupBy(qc(key), "_run")
           .agg(*[F.first(qc(c)).alias(c) for c in value_cols], F.min(start).alias(start), F.max("_end").alias("_end"))
           .select(qc(key), *qcs(value_cols), F.col(start), F.when(F.col("_end") < far, F.col("_end")).alias(end)))
    undated = df.filter(F.col(start).isNull()).select(qc(key), *qcs(value_cols), F.col(start), F.col(end).cast(kind).alias(end))
    return out.unionByName(undated)


def cut_at_points(df: DataFrame, start: str, end: str, cutover: Sequence) -> DataFrame:
    """T4: split each [start, end] at every cut-over point strictly inside it.

    Both pieces touch the cut point ([s, c] and [c, e]), matching downstream filters
    ``end <= c`` / ``start >= c``. A row with a null bound is kept whole. No shuffle.
    """
    pts = F.array(*[F.lit(c) for c in cutover])
    inner = F.array_sort(F.filter(pts, lambda p: (p > F.col(start)) & (p < F.col(end))))
    bounds = F.concat(F.array(F.col(start)), inner, F.array(F.col(end)))
    pieces = F.transform(F.sequence(F.lit(1), F.size(bounds) - 1),
                         lambda i: F.struct(F.element_at(bounds, i).alias("s"),
                                            F.element_at(bounds, i + 1).alias("e")))
    others = [c for c in df.columns if c not in (start, end)]
    return (df.withColumn("_piece", F.explode(pieces))
            .select(*others, F.col("_piece.s").alias(start), F.col("_piece.e").alias(end)))


def widen(df: DataFrame, start: str | None = None, end: str | None = None,
          before_days: int = 0, after_days: int = 0) -> DataFrame:
    """Move an interval's start back and its end forward by whole days."""
    out = df
    if start and before_days:
        out = out.withColumn(start, F.col(start) - F.make_dt_interval(F.lit(before_days)))
    if end and after_days:
        out = out.withColumn(end, F.col(end) + F.make_dt_interval(F.lit(after_days)))
    return out


def resolve_by_period(attrs: DataFrame, key: str | Sequence[str], eff_from: str, eff_to: str,
                      value_cols: Sequence[str], periods: DataFrame, period_col: str = "fy",
                      period_start: str = "start_of_fy", period_end: str = "end_of_fy") -> DataFrame:
    """T7 + W4: the attribute value that applies to each (key, period).

    Rule 1: ``eff_to`` falls in the period; rule 2: ``eff_from`` falls in it; rule 3: the
    period end lies inside [eff_from, eff_to]. The lowest rule wins; ties go to the
    later ``eff_from``, then later ``eff_to``, then the smaller value.
    The period table (financial years) has a fixed, tiny size, so it is broadcast and
    the range join runs as a nested loop over it without shuffling ``attrs``. The pick
    is a ``min`` aggregate (partial, skew-safe), not a window.
    """
    p = F.broadcast(periods.select(period_col, period_start, period_end))
    in_p = lambda c: F.col(c).between(F.col(period_start), F.col(period_end))
    spans = F.col(period_end).between(F.col(eff_from), F.col(eff_to))
    j = attrs.join(p, in_p(eff_to) | in_p(eff_from) | spans, "inner")
    rule = (F.when(in_p(eff_to), 1).when(in_p(eff_from), 2).otherwise(3))
    neg_from = F.datediff(F.lit("1900-01-01").cast("date"), F.col(eff_from).cast("date"))
    neg_to = F.datediff(F.lit("1900-01-01").cast("date"), F.col(eff_to).cast("date"))
    # the values are the end of the rank, so the least rank has them: no row carries them twice
    rank = F.struct(rule.alias("r"), neg_from.alias("f"), neg_to.alias("t"),
                    *[F.col(c).alias(f"v{i}") for i, c in enumerate(value_cols)])
    keys = _as_list(key)
    best = j.groupBy(*keys, period_col).agg(F.min(rank).alias("_best"))
    return best.select(*keys, period_col, *[F.col("_best")[f"v{i}"].alias(c) for i, c in enumerate(value_cols)])


def latest_per_key(df: DataFrame, key: str, order_col: str, value_cols: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_col`` per key (``max_by``, skew-safe)."""
    vals = F.struct(F.col(order_col), *[F.col(c) for c in value_cols])
    rank = F.struct(F.col(order_col), *[F.col(c) for c in value_cols])
    best = df.groupBy(key).agg(F.max_by(vals, rank).alias("_b"))
    return best.select(key, F.col("_b")[order_col].alias(order_col),
                       *[F.col("_b")[c].alias(c) for c in value_cols])
