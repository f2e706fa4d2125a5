"""Data-quality tests (Q1-Q17). Each returns a DataFrame of violations; the
:func:`summarize` helper turns violations into a pass/fail row against a tolerance.

Every test is one pass over the data (row-local predicates) or a partial
aggregation plus a join back on the aggregated keys, never a window over a
(possibly hot) group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effdated.functions.dates import parse_datetime
from effdated.operators.intervals import add_overlapping_identifier
from effdated.operators.joins import interval_join


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _flag_columns(df: DataFrame, keys: Sequence[str], tests: Mapping[str, Column],
                  test: str) -> DataFrame:
    """One row per (row, failing column): keys + ``column`` + ``value`` + ``test``."""
    hits = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in tests.items()]),
                    lambda x: x.isNotNull())
    vals = F.create_map(*[x for name in tests for x in (F.lit(name), _c(name).cast("string"))])
    return (df.select(*[_c(k) for k in keys], F.explode(hits).alias("column"), vals.alias("_vals"))
            .select(*keys, "column", F.element_at("_vals", F.col("column")).alias("value"),
                    F.lit(test).alias("test")))


def non_nan(df: DataFrame, cols: Sequence[str], keys: Sequence[str],
            exclude_nan: Sequence[str] = ()) -> DataFrame:
    """Q1: null (or blank text) cells in ``cols`` except those in ``exclude_nan``."""
    def blank(c):
        t = dict(df.dtypes)[c]
        return _c(c).isNull() | ((F.trim(_c(c)) == "") if t == "string" else F.lit(False))
    return _flag_columns(df, keys, {c: blank(c) for c in cols if c not in exclude_nan}, "non_nan")


def _as_number(c: str) -> Column:
    return F.regexp_replace(F.trim(_c(c).cast("string")), ",", "").try_cast("double")


def non_numeric(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Q2: non-empty cells that do not parse as a number (thousands commas allowed)."""
    t = {c: _c(c).isNotNull() & (F.trim(_c(c).cast("string")) != "") & _as_number(c).isNull() for c in cols}
    return _flag_columns(df, keys, t, "non_numeric")


def non_positive(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Q3: numeric cells <= 0."""
    return _flag_columns(df, keys, {c: F.coalesce(_as_number(c) <= 0, F.lit(False)) for c in cols},
                         "non_positive")


def non_datetime(df: DataFrame, cols: Sequence[str], keys: Sequence[str], dayfirst: bool = True) -> DataFrame:
    """Q4: non-empty cells that parse as no known date layout."""
    t = {c: _c(c).isNotNull() & (F.trim(_c(c).cast("string")) != "")
         & parse_datetime(_c(c).cast("string"), dayfirst).isNull() for c in cols}
    return _flag_columns(df, keys, t, "non_datetime")


def implausible_dob(df: DataFrame, col: str, keys: Sequence[str], as_of: str,
                    min_age: int = 14, max_age: int = 100) -> DataFrame:
    """Q5: date of birth giving an age outside [min_age, max_age] at ``as_of``."""
    age = F.floor(F.months_between(F.lit(as_of).cast("date"), _c(col).cast("date")) / 12)
    bad = _c(col).isNotNull() & ~age.between(min_age, max_age)
    return _flag_columns(df, keys, {col: bad}, "dob")


def non_ascii(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Q6: text cells holding any non-ASCII character (whole text is scanned)."""
    return _flag_columns(df, keys, {c: F.coalesce(_c(c).rlike("[^\\x00-\\x7F]"), F.lit(False)) for c in cols},
                         "non_ascii")


def _subsets(df: DataFrame, subset) -> list[list[str]]:
    """``None`` / ``"all"`` / ``["all"]``, a list of columns, or a list of those, as a list of column lists."""
    sets = [subset] if subset is None or isinstance(subset, str) or all(isinstance(c, str) for c in subset) else list(subset)
    whole = lambda s: s is None or s == "all" or list(s) in ([], ["all"])
    return [list(df.columns) if whole(s) else list(s) for s in sets]


def duplicate_counts(df: DataFrame, subsets: Sequence) -> DataFrame:
    """Q7 counts: ``(duplicate_of, n_rows, n_groups)`` per subset: rows in groups of two or more, and such
    groups. One aggregation with GROUPING SETS, whatever the number of subsets."""
    groups = _duplicate_groups(df, _subsets(df, subsets))
    found = groups.groupBy("_set").agg(F.sum("n_copies").alias("n"), F.count(F.lit(1)).alias("g"))
    names = df.sparkSession.createDataFrame([(i, ",".join(s)) for i, s in enumerate(_subsets(df, subsets))], "_set int, duplicate_of string")
    return F.broadcast(names).join(found, "_set", "left").select(
        "duplicate_of", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"), F.coalesce("g", F.lit(0)).cast("bigint").alias("n_groups"))


def _duplicate_groups(df: DataFrame, sets: list[list[str]]) -> DataFrame:
    """``_set, _d0, ..., n_copies``: groups of two or more rows of each set of columns (``_d<i>``: the
    i-th of all columns named; null outside the set)."""
    used = list(dict.fromkeys(c for s in sets for c in s))
    rows = df.select(*[_c(c).alias(f"_d{i}") for i, c in enumerate(used)])
    columns = [[F.col(f"_d{used.index(c)}") for c in s] for s in sets]
    every = [F.col(f"_d{i}") for i in range(len(used))]
    counted = rows.groupingSets(columns, *every).agg(F.count(F.lit(1)).alias("n_copies"), F.grouping_id(*every).alias("_gid")).filter("n_copies > 1")
    # a bit of grouping_id is set where a column is not in the set
    number = {}
    for k, s in enumerate(sets):
        number.setdefault(sum(1 << (len(used) - 1 - i) for i, c in enumerate(used) if c not in s), k)
    which = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
    return counted.withColumn("_set", F.element_at(which, F.col("_gid").cast("int")))


def duplicated(df: DataFrame, subset: Sequence | str | None = None) -> DataFrame:
    """Q7: rows whose ``subset`` values (default: all columns) occur more than once.

    ``subset``: a list of columns, ``"all"``, or a list of such lists; then a row comes out once per subset
    in which it is repeated, named in ``duplicate_of``. All subsets are counted in one aggregation
    (GROUPING SETS, partial); only keys seen twice or more are joined back, and AQE splits
    a hot duplicate key in that join.
    """
    sets = _subsets(df, subset)
    several = subset is not None and not isinstance(subset, str) and any(not isinstance(c, str) for c in subset)
    used = list(dict.fromkeys(c for s in sets for c in s))
    if len({frozenset(s) for s in sets}) < len(sets):
        raise ValueError(f"the same subset twice in {sets}")
    dup = _duplicate_groups(df, sets)
    keys = [F.struct(F.lit(k).alias("_set"), *[(_c(c) if c in s else F.lit(None).cast(df.schema[c].dataType)).alias(f"_k{i}") for i, c in enumerate(used)])
            for k, s in enumerate(sets)]
    rows = df.withColumn("_key", F.explode(F.array(*keys)))
    cond = F.col("_key._set") == F.col("_set")
    for i in range(len(used)):
        cond = cond & F.col(f"_key._k{i}").eqNullSafe(F.col(f"_d{i}"))
    names = F.element_at(F.array(*[F.lit(",".join(s)) for s in sets]), F.col("_set") + 1)
    out = rows.join(dup, cond, "inner").withColumn("duplicate_of", names).drop("_key", "_set", "_gid", *[f"_d{i}" for i in range(len(used))])
    return (out if several else out.drop("duplicate_of")).withColumn("test", F.lit("duplicate"))


def overlapping(df: DataFrame, key: str, start: str, end: str, group_records: bool = False,
                order_by: Sequence[str] = (), tolerance_keys: DataFrame | None = None) -> DataFrame:
    """Q8: rows in an overlap island of their key (W6), minus tolerated keys."""
    isl = add_overlapping_identifier(df, key, start, end, group_records, order_by)
    out = isl.filter("is_overlapping").drop("is_overlapping")
    if tolerance_keys is not None:
        tk = tolerance_keys.select(F.col(tolerance_keys.columns[0]).alias("_tk")).distinct()
        out = out.join(tk, out[key] == tk["_tk"], "left_anti")
    return out.withColumn("test", F.lit("overlapping"))


def broken_records(df: DataFrame, cols: Sequence[str], overflow_col: str | None = "_overflow") -> DataFrame:
    """Q9: rows that overflowed their header (CSV policy) or miss every listed column."""
    missing = None
    for c in cols:
        m = _c(c).isNull() | (F.trim(_c(c).cast("string")) == "")
        missing = m if missing is None else missing & m
    bad = missing if missing is not None else F.lit(False)
    if overflow_col and overflow_col in df.columns:
        bad = bad | _c(overflow_col).isNotNull()
    return df.filter(bad).withColumn("test", F.lit("broken_record"))


def not_in_scope(df: DataFrame, col: str, allowed: Sequence[str] | DataFrame,
                 allowed_col: str | None = None, normalise: bool = True) -> DataFrame:
    """Q10: values of ``col`` outside the in-scope list / mapping table (nulls are Q1's job)."""
    norm = (lambda c: F.lower(F.trim(c))) if normalise else (lambda c: c)
    v = df.filter(_c(col).isNotNull())
    if isinstance(allowed, DataFrame):
        a = allowed.select(norm(F.col(allowed_col or allowed.columns[0])).alias("_ok")).distinct()
        out = v.join(a, norm(v[col]) == a["_ok"], "left_anti")
    else:
        ok = [norm(F.lit(x)) for x in allowed]
        out = v.filter(~norm(_c(col)).isin(*ok))
    return out.withColumn("test", F.lit("in_scope"))


def shift_length(df: DataFrame, start: str, end: str, min_minutes: float | None = None,
                 max_hours: float | None = None) -> DataFrame:
    """Q11: periods shorter than ``min_minutes`` or longer than ``max_hours``."""
    secs = F.timestamp_diff("SECOND", _c(start), _c(end))
    bad = F.lit(False)
    if min_minutes is not None:
        bad = bad | (secs < F.lit(min_minutes * 60))
    if max_hours is not None:
        bad = bad | (secs > F.lit(max_hours * 3600))
    return df.filter(F.coalesce(bad, F.lit(False))).withColumn("length_seconds", secs) \
        .withColumn("test", F.lit("shift_length"))


def end_before_start(df: DataFrame, start: str, end: str) -> DataFrame:
    """Q12: end earlier than start."""
    return df.filter(F.coalesce(_c(end) < _c(start), F.lit(False))).withColumn("test", F.lit("end_before_start"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q13: nulls per column in one aggregation pass: rows (column, n_null, n_rows)."""
    cs = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.sum(F.when(_c(c).isNull(), 1).otherwise(0)).alias(f"n{i}") for i, c in enumerate(cs)])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("bigint").alias("n_null"))
                                  for i, c in enumerate(cs)]))
    return agg.select(stacked.alias("s"), F.col("_rows").cast("bigint").alias("n_rows")).select(
        "s.column", "s.n_null", "n_rows")


def source_coverage(expected_files: DataFrame, output: DataFrame, file_col: str = "file",
                    source_col: str = "Source") -> DataFrame:
    """Q14: expected source files not represented in ``output``'s lineage labels."""
    seen = output.select(F.substring_index(_c(source_col), ":", 1).alias("_f")).distinct()
    exp = expected_files.select(_c(file_col).alias("file")).distinct()
    return exp.join(seen, exp["file"] == seen["_f"], "left_anti").withColumn("test", F.lit("source_coverage"))


def schema_changes(before: DataFrame, after: DataFrame) -> list[dict]:
    """Q15: column / data type differences between two schemas (driver-side metadata only)."""
    a, b = dict(before.dtypes), dict(after.dtypes)
    out = [{"column": c, "change": "removed", "before": a[c], "after": None} for c in a if c not in b]
    out += [{"column": c, "change": "added", "before": None, "after": b[c]} for c in b if c not in a]
    out += [{"column": c, "change": "dtype", "before": a[c], "after": b[c]} for c in a if c in b and a[c] != b[c]]
    return out


def membership(datasets: Mapping[str, DataFrame], key: str, groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Q16: keys with one presence flag per dataset; violations are keys absent from at least one.

    ``groups`` (``group_datasets``): ``{name: datasets}``; the datasets of a group stand for each other, so
    a key counts as present if any of them has it, and ``missing`` names the groups that lack it
    (inferred from the declaration). Ungrouped datasets are groups of their own. One union with a bit per
    dataset and ``bit_or``: one shuffle of distinct (key, dataset) pairs, whatever their number.
    """
    names = list(datasets)
    if len(names) > 63:
        raise ValueError("at most 63 datasets")
    bit = {n: 1 << i for i, n in enumerate(names)}
    unknown = [n for g in (groups or {}).values() for n in g if n not in bit]
    if unknown:
        raise ValueError(f"groups name unknown datasets {unknown}")
    parts = [d.select(F.col(f"`{key}`").alias("key"), F.lit(bit[n]).cast("long").alias("_bit")) for n, d in datasets.items()]
    masks = reduce(DataFrame.unionByName, parts).filter(F.col("key").isNotNull()).groupBy("key").agg(F.bit_or("_bit").alias("_mask"))
    grouped = {n for g in (groups or {}).values() for n in g}
    every = {**{g: list(m) for g, m in (groups or {}).items()}, **{n: [n] for n in names if n not in grouped}}
    has = {g: F.col("_mask").bitwiseAND(F.lit(sum(bit[n] for n in set(m))).cast("long")) != 0 for g, m in every.items()}
    out = masks.select("key", *[(F.col("_mask").bitwiseAND(F.lit(bit[n]).cast("long")) != 0).alias(f"in_{n}") for n in names],
                       F.array_compact(F.array(*[F.when(~h, F.lit(g)) for g, h in has.items()])).alias("missing"))
    out = out.filter(F.size("missing") > 0)
    return (out.withColumn("missing", F.array_join("missing", ",")) if groups else out.drop("missing")).withColumn("test", F.lit("membership"))


def outside_periods(facts: DataFrame, key: str, date: str, periods: DataFrame,
                    p_key: str, p_start: str, p_end: str) -> DataFrame:
    """Q17: facts whose date lies in no period of the same key.

    Coverage depends only on (key, date), so the distinct pairs are checked with the
    month-bucketed interval join and the facts are then ``left_anti`` joined on the
    covered pairs. No row id is needed.
    """
    pairs = facts.select(F.col(key).alias("_fk"), F.col(date).alias("_d0")).distinct() \
        .withColumn("_d1", F.col("_d0"))
    p = periods.select(F.col(p_key).alias("_fk"), F.col(p_start).alias("_ps"), F.col(p_end).alias("_pe"))
    covered = interval_join(pairs, p, "_fk", "_d0", "_d1", "_ps", "_pe", "contained") \
        .select("_fk", "_d0").distinct()
    cond = (facts[key] == covered["_fk"]) & (facts[date] == covered["_d0"])
    return facts.join(covered, cond, "left_anti").withColumn("test", F.lit("cross_dataset_period"))


def summarize(violations: DataFrame, test: str, tolerance: int = 0) -> DataFrame:
    """Pass/fail row: ``(test, n_violations, tolerance, passed)``."""
    return violations.agg(F.count(F.lit(1)).cast("bigint").alias("n_violations")).select(
        F.lit(test).alias("test"), "n_violations", F.lit(tolerance).cast("bigint").alias("tolerance"),
        (F.col("n_violations") <= tolerance).alias("passed"))
