"""Joins (J1-J12).

Broadcast policy: only tables whose size is fixed by construction are broadcast with
an explicit hint: financial-year rules, rate tables, constants, and the bounded
carry tables of the scan. Lookups of unknown size are plain joins. AQE measures them
at run time, turns small ones into broadcast joins
(``spark.sql.adaptive.autoBroadcastJoinThreshold``) and splits skewed partitions of
large ones. That is the size-checked broadcast, with a sort-merge fallback.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_using(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``JOIN ... USING (keys)``; for ``full`` the key columns are coalesced."""
    return left.join(right, list(keys), how)


def full_outer_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``a FULL JOIN b USING (k) FULL JOIN c USING (k)``."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), frames)


def attach_constants(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row table of scalars (``(select ...)`` subqueries) to every row. No row
    gives nulls, more than one raises, as a scalar subquery does."""
    n = F.count(F.lit(1))
    checked = one_row.agg(
        F.when(n > 1, F.raise_error(F.lit("a scalar table has more than one row"))).alias("_many"),
        *[F.first(F.col(f"`{c}`")).alias(c) for c in one_row.columns])
    return df.crossJoin(F.broadcast(checked.filter(F.col("_many").isNull()).drop("_many")))


def one_per_key(table: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Distinct rows of a lookup table; a key with two different rows raises instead of an
    arbitrary one being used."""
    rest = [c for c in table.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    low, high = F.min(row), F.max(row)
    # struct comparison is null-safe, so rows that agree in their nulls are equal
    clash = F.when(~low.eqNullSafe(high), F.raise_error(F.concat(
        F.lit(f"conflicting {what} rows for key "), F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys])))))
    got = table.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(low.alias("_row"), clash.alias("_clash"))
    return got.filter(F.col("_clash").isNull()).select(*[F.col(f"`{k}`") for k in keys], *[F.col("_row")[c].alias(c) for c in rest])


def point_in_interval(facts: DataFrame, point: str, rules: DataFrame, start: str, end: str,
                      how: str = "inner") -> DataFrame:
    """``point BETWEEN start AND end`` against a small rule table (FY rules, rates).

    The rule table has a fixed size, so it is broadcast and the join is a nested
    loop over it; ``facts`` is not shuffled.
    """
    return facts.join(F.broadcast(rules), F.col(point).between(F.col(start), F.col(end)), how)


#: Periods of a key that its facts are compared with one by one; only keys with more use the tree.
DIRECT_PERIODS = 128

#: Children of a node of the interval index, its levels (level 0: one bucket of time; the last: all of it),
#: and the first month it tells apart. Months before and after count as its first and last.
FANOUT, LEVELS, FIRST_MONTH = 8, 5, 1800 * 12


def _bucket(c: Column, months: int) -> Column:
    at = F.floor((F.year(c) * 12 + F.month(c) - 1 - FIRST_MONTH) / months).cast("int")
    return F.greatest(F.lit(0), F.least(F.lit(FANOUT ** (LEVELS - 1) - 1), at))


def _node(level: int, number: Column) -> Column:
    return (number * LEVELS + level).cast("int")


def _level_ranges(first: Column, last: Column) -> list[tuple[int, Column, Column]]:
    """``(level, from, to)``: the node numbers that make up the buckets ``first..last``. A level has those
    whole nodes of the range whose parent is not whole: some at either end, at most ``FANOUT - 1``."""
    size = [FANOUT ** level for level in range(LEVELS + 1)]
    low = [F.ceil(first / n).cast("int") for n in size]
    high = [F.floor((last + 1) / n).cast("int") for n in size]
    out = []
    for level in range(LEVELS):
        up, down = low[level + 1] * FANOUT, high[level + 1] * FANOUT
        whole = up < down
        out.append((level, low[level], F.when(whole, up).otherwise(high[level])))
        out.append((level, F.when(whole, down).otherwise(high[level]), high[level]))
    return out


def covering_nodes(first: Column, last: Column) -> Column:
    """Nodes that make up the buckets ``first..last``, each bucket once."""
    parts = [F.when(lo < hi, F.transform(F.sequence(lo, hi - 1), partial(_node, level))).otherwise(F.array().cast("array<int>"))
             for level, lo, hi in _level_ranges(first, last)]
    return F.concat(*parts)


def _levels_used(first: Column, last: Column) -> Column:
    return reduce(lambda x, y: x.bitwiseOR(y), [F.when(lo < hi, 1 << level).otherwise(0) for level, lo, hi in _level_ranges(first, last)])


def ancestor_nodes(bucket: Column, levels: Column) -> Column:
    """The node of ``bucket`` at each level whose bit is set in ``levels``."""
    each = [F.when(F.getbit(levels, F.lit(level)) == 1, _node(level, F.floor(bucket / FANOUT ** level))) for level in range(LEVELS)]
    return F.array_except(F.array(*each), F.array(F.lit(None).cast("int")))


def interval_join(facts: DataFrame, periods: DataFrame, key: str, f_start: str, f_end: str,
                  p_start: str, p_end: str, mode: str = "either_end", f_key: str | None = None,
                  bucket_months: int = 1) -> DataFrame:
    """Equi join on the key plus a range condition, both sides large.

    ``mode='either_end'``: the fact's start or end lies in the period (J5 merge-then-filter,
    as one inner join; a fact spanning two periods matches both).
    ``mode='contained'``: the fact lies inside the period (J6).

    A key with up to ``DIRECT_PERIODS`` periods is one node: its facts and periods go out once each
    and meet on the key alone, where a fact costs at most that many comparisons (AQE splits a key
    of many facts). A key holding many facts and many periods would pair all of them that way. Its
    two sides meet in the nodes of a tree over time (months, 8 months, 64 months, ...): a period
    emits the nodes that make it up, O(log span) of them however long it is, and a fact the nodes
    above the month of its start (in ``either_end`` mode also of its end). A period holds whole
    nodes, so what meets in a node matches but for the months at its ends: long and open periods
    share no bucket of their own. Levels that no period of the key uses are left out of the facts' rows.
    The keys with more periods and their levels, at most ``periods / DIRECT_PERIODS`` rows, are
    broadcast within the join (no job while the plan is built). Each (fact, period) pair comes out of
    exactly one node, so nothing needs deduplicating. Facts and periods without a bound match
    nothing through it.
    """
    fk = f_key or key
    # pandas merge suffixes ["", "_x"]: period columns that collide with fact columns
    clash = [c for c in periods.columns if c in facts.columns and c != key]
    if clash:
        periods = periods.withColumnsRenamed({c: f"{c}_x" for c in clash})
        p_start = f"{p_start}_x" if p_start in clash else p_start
        p_end = f"{p_end}_x" if p_end in clash else p_end

    def bucket(c: str) -> Column:
        return _bucket(F.col(c), bucket_months)

    dated = periods.filter(F.col(p_start).isNotNull() & F.col(p_end).isNotNull() & (F.col(p_start) <= F.col(p_end)))
    levels = F.bit_or(_levels_used(bucket(p_start), bucket(p_end))).alias("_levels")
    crowded = F.broadcast(dated.groupBy(F.col(f"`{key}`").alias("_ck")).agg(F.count(F.lit(1)).alias("_n"), levels)
                          .filter(F.col("_n") > DIRECT_PERIODS).select("_ck", "_levels"))
    whole = F.array(F.lit(-1))  # the only node of the other keys

    def nodes(of_crowded: Column) -> Column:
        return F.when(F.col("_levels").isNull(), whole).otherwise(of_crowded)

    p = dated.join(crowded, dated[key] == crowded["_ck"], "left").withColumns({"_p0": bucket(p_start), "_p1": bucket(p_end)})
    p = p.withColumn("_pb", F.explode(nodes(covering_nodes(F.col("_p0"), F.col("_p1"))))).drop("_p0", "_p1", "_ck", "_levels")
    used = F.col("_levels")
    facts = facts.join(crowded, facts[fk] == crowded["_ck"], "left").drop("_ck")
    if mode == "contained":
        f = facts.withColumn("_b", F.explode(nodes(ancestor_nodes(bucket(f_start), used))))
        cond = (F.col(f_start) >= F.col(p_start)) & (F.col(f_end) <= F.col(p_end))
    elif mode == "either_end":
        f = (facts.withColumn("_fbs", nodes(ancestor_nodes(bucket(f_start), used))).withColumn("_fbe", nodes(ancestor_nodes(bucket(f_end), used)))
             .withColumn("_b", F.explode(F.array_union(F.coalesce("_fbs", F.array().cast("array<int>")), F.coalesce("_fbe", F.array().cast("array<int>")))))
             .withColumn("_by_start", F.coalesce(F.array_contains("_fbs", F.col("_b")), F.lit(False)))
             .withColumn("_by_end", F.coalesce(F.array_contains("_fbe", F.col("_b")), F.lit(False))).drop("_fbs", "_fbe"))
        s_in = F.coalesce(F.col(f_start).between(F.col(p_start), F.col(p_end)), F.lit(False))
        e_in = F.coalesce(F.col(f_end).between(F.col(p_start), F.col(p_end)), F.lit(False))
        # through its start if that lies in the period, else through its end
        cond = (s_in & F.col("_by_start")) | (~s_in & e_in & F.col("_by_end"))
    else:
        raise ValueError(f"unknown interval join mode {mode!r}")
    if fk == key:
        p = p.withColumnRenamed(key, "_pk")
    j = f.join(p, (f[fk] == p["_pk" if fk == key else key]) & (F.col("_b") == F.col("_pb")) & cond, "inner")
    out = j.drop("_b", "_pb", "_by_start", "_by_end", "_levels")
    return out.drop("_pk") if fk == key else out


def lookup(df: DataFrame, col: str, mapping: DataFrame, from_col: str, to_col: str,
           out: str | None = None, normalise: bool = True) -> DataFrame:
    """Map ``col`` values through a lookup table (left join, unmatched -> null).
    With ``normalise`` both sides are compared trimmed and lower-cased. A value with two
    different targets raises."""
    norm = (lambda c: F.lower(F.trim(c))) if normalise else (lambda c: c)
    m = one_per_key(mapping.select(norm(F.col(from_col)).alias("_lk"), F.col(to_col).alias(out or to_col)), ["_lk"], "lookup")
    return df.join(m, norm(df[col]) == m["_lk"], "left").drop("_lk")


def explode_json_array(df: DataFrame, json_col: str, element_schema: str,
                       pos_col: str = "position", item_col: str = "item") -> DataFrame:
    """``jsonb_array_elements(...) WITH ORDINALITY`` -> posexplode (1-based position)."""
    elem = element_schema if element_schema.strip().lower().startswith(("struct<", "string", "map<")) \
        else f"struct<{element_schema}>"
    arr = F.from_json(F.col(json_col), f"array<{elem}>")
    return (df.select("*", F.posexplode_outer(arr).alias("_pos", item_col))
            .withColumn(pos_col, F.col("_pos") + 1).drop("_pos"))
