"""Shift and leave rules.

The semantics of these rules are inferred from their declared arguments and outputs
(see README "Semantics"). Thresholds are parameters. Rank and chain logic use the
skew-safe scan. Per-employee calendars are pre-aggregated to one row per (key, day)
before any window, so a window group never exceeds the number of calendar days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from effdated.operators import intervals as iv
from effdated.operators import scan


def broken_shifts(df: DataFrame, key: str, start: str, end: str, shift_length_hours: float = 4.0,
                  order_by: Sequence[str] = (), index_col: str = "shift_index",
                  flag_col: str = "is_Broken_Shift", hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """Chain a key's shifts while the gap to the running latest end is below
    ``shift_length_hours``. Adds ``shift_index`` (chain number per key), ``is_Broken_Shift``
    (chain of more than one shift), ``unpaid_break_seconds`` (the gap before this
    shift inside its chain) and ``broken_shift_detail`` (``"<n> pieces"`` text, filled
    in by :func:`summarize_broken_shifts`)."""
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(shift_length_hours * 3600).cast("decimal(18,6)"))
    lay = iv._island_layout(df, key, start, end, [start, end, *order_by], gap, index_col, hot_rows,
                            keep_pme=True)
    pme = F.col("_pme")
    d = lay.df
    brk = F.when(~F.col("_isl_start") & (F.col(start) > pme), F.timestamp_diff("SECOND", pme, F.col(start))) \
        .otherwise(F.lit(0)).cast("bigint")
    return (d.withColumn("unpaid_break_seconds", brk)
            .withColumnRenamed("_multi", flag_col)
            .drop("_isl_start", "_pme", "_sub"))


def summarize_broken_shifts(df: DataFrame, key: str, start: str, end: str,
                            index_col: str = "shift_index") -> DataFrame:
    """T9 follow-up grouper: one row per (key, shift chain); partial aggregation."""
    return (df.groupBy(key, index_col).agg(
        F.min(start).alias(start), F.max(end).alias(end),
        F.count(F.lit(1)).cast("bigint").alias("pieces"),
        F.sum("unpaid_break_seconds").cast("bigint").alias("unpaid_break_seconds"))
        .withColumn("is_Broken_Shift", F.col("pieces") > 1)
        .withColumn("broken_shift_detail", F.concat(F.col("pieces").cast("string"), F.lit(" pieces, "),
                                                    F.col("unpaid_break_seconds").cast("string"),
                                                    F.lit("s unpaid"))))


def one_flag_per_week(df: DataFrame, key: str, date: str, flag_col: str, id_col: str) -> DataFrame:
    """Keep ``flag_col`` only on the earliest flagged record of each (key, ISO week).
    The earliest is a ``min`` (partial aggregation), joined back on (key, week); ``id_col``
    breaks ties of one day."""
    wk = F.expr(f"extract(YEAROFWEEK FROM `{date}`)") * 100 + F.weekofyear(F.col(date))
    first = (df.filter(F.col(flag_col)).groupBy(F.col(key).alias("_fkey"), wk.alias("_fwk"))
             .agg(F.min(F.struct(F.col(date).alias("d"), F.col(id_col).alias("id"))).alias("_first")))
    d = df.withColumn("_wk", wk)
    same = d[key].eqNullSafe(F.col("_fkey")) & F.col("_wk").eqNullSafe(F.col("_fwk"))
    keep = F.col(date).eqNullSafe(F.col("_first.d")) & F.col(id_col).eqNullSafe(F.col("_first.id"))
    return (d.join(first, same, "left")
            .withColumn(flag_col, F.coalesce(F.col(flag_col) & F.col("_first").isNotNull() & keep, F.lit(False)))
            .drop("_first", "_fkey", "_fwk", "_wk"))


def rank_and_convert(df: DataFrame, group_keys: Sequence[str], sort_keys: Sequence[str],
                     target_col: str, value, first_n: int, rank_col: str = "leave_rank",
                     hot_rows: int | scan.KeyStatistics | None = None) -> DataFrame:
    """Rank records per group (employee, FY) in ``sort_keys`` order; the first
    ``first_n`` get ``target_col = value``. Skew-safe running count."""
    lay = scan.layout(df, list(group_keys), list(sort_keys), hot_rows)
    lay = scan.with_prefix_count(lay, None, rank_col)
    return (lay.df.withColumn(rank_col, F.col(rank_col).cast("bigint"))
            .withColumn(target_col, F.when(F.col(rank_col) <= first_n, F.lit(value)).otherwise(F.col(target_col)))
            .drop("_sub"))


def trailing_day_share(df: DataFrame, key: str, date: str, days: int = 182, out: str = "worked_share") -> DataFrame:
    """Per (key, day) the share of the previous ``days`` days (excluding the day)
    on which the key has any record. The data is first reduced to distinct
    (key, day); the range window then spans at most ``days`` rows per key."""
    daily = df.select(F.col(key), F.to_date(F.col(date)).alias("_day")).distinct() \
        .withColumn("_dn", F.datediff(F.col("_day"), F.lit("1970-01-01").cast("date")))
    w = Window.partitionBy(key).orderBy("_dn").rangeBetween(-days, -1)
    return daily.select(key, F.col("_day").alias("day"),
                        (F.count(F.lit(1)).over(w) / F.lit(float(days))).alias(out))


def with_trailing_day_share(df: DataFrame, key: str, date: str, days: int = 182, out: str = "worked_share") -> DataFrame:
    """W9 on the rows themselves: each row gets the share of :func:`trailing_day_share` of its (key, day),
    null without key or date. A window over the key counts the first row of every day, so the rows
    are neither computed a second time nor joined back."""
    w = Window.partitionBy(key).orderBy("_dn")
    d = df.withColumn("_dn", F.datediff(F.to_date(F.col(date)), F.lit("1970-01-01").cast("date")))
    d = d.withColumn("_first", F.when(F.lag("_dn").over(w).eqNullSafe(F.col("_dn")), 0).otherwise(1))
    share = F.coalesce(F.sum("_first").over(w.rangeBetween(-days, -1)), F.lit(0)) / F.lit(float(days))
    return d.withColumn(out, F.when(F.col(key).isNotNull() & F.col("_dn").isNotNull(), share)).drop("_dn", "_first")


def holiday_calendar(holidays: DataFrame, date_col: str = "holiday_date",
                     add_substitute: bool = True) -> DataFrame:
    """T10 helper: a holiday on a Saturday or Sunday adds the following Monday as an
    additional (substitute) holiday, flagged ``is_additional_holiday``."""
    base = holidays.withColumn("is_additional_holiday", F.lit(False))
    if not add_substitute:
        return base
    dow = F.dayofweek(F.col(date_col))  # 1 = Sunday, 7 = Saturday
    shift = F.when(dow == 7, 2).when(dow == 1, 1)
    extra = (holidays.filter(shift.isNotNull())
             .withColumn(date_col, F.date_add(F.col(date_col), shift))
             .withColumn("is_additional_holiday", F.lit(True)))
    return base.unionByName(extra)


def add_public_holidays(df: DataFrame, date_col: str, region_col: str, calendar: DataFrame,
                        all_regions: str = "ALL") -> DataFrame:
    """Attach ``holiday_regions``, ``holiday_name``, ``holiday_date`` and
    ``is_additional_holiday`` to rows falling on a holiday of their region (or a
    holiday of every region). One row per input row: all holidays of a day are gathered
    into one calendar row, and those of the row's region are listed, comma-joined and in
    order, in ``holiday_regions`` and ``holiday_name``; the day is additional only if all of
    them are. The calendar has one row per day, so AQE broadcasts it; rows are not shuffled."""
    one = F.struct(F.col("region"), F.col("holiday_name"), F.col("is_additional_holiday"))
    days = (calendar.groupBy(F.col("holiday_date").cast("date").alias("_day"))
            .agg(F.array_sort(F.collect_set(one)).alias("_all")))
    mine = F.filter("_all", lambda h: (h["region"] == F.col(region_col)) | (h["region"] == all_regions))
    d = df.join(days, F.to_date(F.col(date_col)) == F.col("_day"), "left").withColumn("_mine", mine)
    hit = F.size("_mine") > 0
    text = lambda f: F.array_join(F.array_distinct(F.transform("_mine", lambda h: h[f])), ",")
    return (d.withColumn("holiday_regions", F.when(hit, text("region")))
            .withColumn("holiday_name", F.when(hit, text("holiday_name")))
            .withColumn("holiday_date", F.when(hit, F.col("_day")))
            .withColumn("is_additional_holiday", F.when(hit, F.forall("_mine", lambda h: h["is_additional_holiday"])))
            .drop("_day", "_all", "_mine"))


def add_synthetic_days(cohort: DataFrame, key: str, start: str, end: str, days: DataFrame,
                       day_col: str = "day", lineage: str = "Manually Added",
                       source_col: str = "Source") -> DataFrame:
    """One synthetic record per (key, day) for every key with a cohort period
    covering one of ``days`` (e.g. Easter Saturdays); lineage marks it as added.
    The day list is a fixed calendar and is broadcast."""
    d = F.broadcast(days.select(F.col(day_col).cast("date").alias("_day")))
    hits = cohort.join(d, F.col("_day").between(F.to_date(F.col(start)), F.to_date(F.col(end))))
    return (hits.select(F.col(key), F.col("_day").alias(day_col)).distinct()
            .withColumn(source_col, F.lit(lineage)))


def append_intervals(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Append rows from another interval table (missing columns become null)."""
    return df.unionByName(extra, allowMissingColumns=True)


def override_values(df: DataFrame, overrides: DataFrame, keys: Sequence[str],
                    cols: Sequence[str]) -> DataFrame:
    """Values from ``overrides`` replace ``cols``; others unchanged. Repeated rows of a key
    are fine if they agree; keys with different values raise."""
    from effdated.operators.joins import one_per_key
    o = one_per_key(overrides.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols]), list(keys), "override")
    out = df.join(o, list(keys), "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(f"_new_{c}"), F.col(c))).drop(f"_new_{c}")
    return out


def split_attribute(df: DataFrame, col: str, sep: str = ",", out: str | None = None,
                    pos_col: str = "attribute_position") -> DataFrame:
    """A multi-valued attribute cell becomes one row per trimmed, non-empty value. A row
    whose cell is null or holds no value stays once, with a null attribute and position."""
    values = F.filter(F.transform(F.split(F.col(col), sep), lambda x, i: F.struct(F.trim(x).alias("v"), (i + 1).alias("p"))),
                      lambda x: x["v"] != "")
    o = out or col
    return (df.select("*", F.explode_outer(values).alias("_x"))
            .withColumn(o, F.col("_x.v")).withColumn(pos_col, F.col("_x.p").cast("bigint")).drop("_x"))


def qualify_by_period(df: DataFrame, row_id: str, key: str, date: str, periods: DataFrame,
                      p_key: str, p_start: str, p_end: str, value_col: str, qualifier: Column,
                      out: str) -> DataFrame:
    """For each row, the ``value_col`` of the period (same key) containing ``date``
    (earliest period start wins), joined with ``qualifier`` as ``"<value>-<qualifier>"``.
    Uses the month-bucketed interval join; one pick per row via ``min_by``."""
    from effdated.operators.joins import interval_join
    f = df.select(F.col(row_id).alias("_rid"), F.col(key).alias("_k"), F.col(date).alias("_d0"),
                  F.col(date).alias("_d1"))
    p = periods.select(F.col(p_key).alias("_k"), F.col(p_start).alias("_ps"), F.col(p_end).alias("_pe"),
                       F.col(value_col).alias("_val"))
    m = interval_join(f, p, "_k", "_d0", "_d1", "_ps", "_pe", "contained")
    pick = m.groupBy("_rid").agg(F.min_by("_val", F.struct("_ps", "_pe", "_val")).alias("_val"))
    out_df = df.join(pick, df[row_id] == pick["_rid"], "left").drop("_rid")
    return out_df.withColumn(out, F.when(F.col("_val").isNotNull(),
                                         F.concat_ws("-", F.col("_val"), qualifier))).drop("_val")
