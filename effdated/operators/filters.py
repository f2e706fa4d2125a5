"""Filters and predicates (F1-F11). Row-local filters push down to the scan; key
filters are semi / anti joins, which AQE turns into broadcast joins when the lookup
side is small at run time and keeps as sort-merge joins (with skew splitting) when not."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effdated.operators.scan import _order_struct

NAN_TOKEN = "nan value"  # YAML literal standing for null inside filter value lists


def isin_nullable(col: Column, values: Sequence) -> Column:
    """``col IN values`` where the token ``'nan value'`` (or None) in ``values`` matches null."""
    vals = list(values)
    want_null = any(v is None or v == NAN_TOKEN for v in vals)
    plain = [v for v in vals if v is not None and v != NAN_TOKEN]
    cond = col.isin(plain) if plain else F.lit(False)
    if want_null:
        cond = cond | col.isNull()
    return F.coalesce(cond, F.lit(False))


def row_filter(df: DataFrame, filters: Sequence[Mapping]) -> DataFrame:
    """``[{col, include: {logic, value: [...]}, exclude: {logic, value: [...]}}]``.

    Each item's condition is ``include AND NOT exclude`` for its column; the item's
    ``logic`` (``and`` / ``or``, default ``and``) combines it with the conditions before it.
    """
    cond: Column | None = None
    for item in filters:
        col = F.col(f"`{item['col']}`")
        c = F.lit(True)
        logic = "and"
        if item.get("include"):
            c = c & isin_nullable(col, item["include"]["value"])
            logic = item["include"].get("logic", logic)
        if item.get("exclude"):
            c = c & ~isin_nullable(col, item["exclude"]["value"])
            logic = item["exclude"].get("logic", logic)
        logic = item.get("logic", logic)
        cond = c if cond is None else (cond | c if logic == "or" else cond & c)
    return df if cond is None else df.filter(cond)


def dataset_filter(df: DataFrame, expression: str) -> DataFrame:
    """filter by a SQL predicate text (never Python ``eval``)."""
    return df.filter(F.expr(expression))


def keep_keys_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """rows whose key occurs in ``other`` (``left_semi``)."""
    ok = other_key or key
    right = other.select(F.col(ok).alias("_k")).distinct() if ok != key else other.select(key)
    if ok != key:
        return df.join(right, df[key] == right["_k"], "left_semi")
    return df.join(right, key, "left_semi")


def out_of_scope_filter(df: DataFrame, employee_code_field: str,
                        out_of_scope: DataFrame | None = None, scope_key: str | None = None,
                        exclude_value_out_of_scope: Mapping[str, Sequence] | None = None) -> DataFrame:
    """drop out-of-scope employees (``left_anti`` against the scope list) and rows
    whose columns hold excluded values."""
    out = df
    if out_of_scope is not None:
        sk = scope_key or employee_code_field
        scope = out_of_scope.select(F.col(sk).alias("_oos")).distinct()
        out = out.join(scope, out[employee_code_field] == scope["_oos"], "left_anti")
    for col, vals in (exclude_value_out_of_scope or {}).items():
        out = out.filter(~isin_nullable(F.col(f"`{col}`"), vals))
    return out


def dedupe_keep_first(df: DataFrame, subset: Sequence[str], order_by: Sequence[str], digests: Sequence[str] = ()) -> DataFrame:
    """keep the first row (in ``order_by``, then of the other columns) of each ``subset`` group.

    The least struct of a group is a partial aggregate: each mapper keeps one candidate per
    group before the shuffle, so a hot group costs nothing extra. The struct begins with the
    order columns, so that no row carries them twice. ``digests``: text columns of ``subset`` that
    hold lower-case hex as a rule; such values travel as bytes, any other one as it is.
    """
    order = list(order_by)
    rest = [c for c in df.columns if c not in subset and c not in order]
    keys, back = [], {}
    for i, c in enumerate(subset):
        text = F.col(f"`{c}`")
        if c in digests:
            as_bytes = F.try_to_binary(text, F.lit("hex"))
            exact = F.coalesce(F.lower(F.hex(as_bytes)) == text, F.lit(False))
            keys += [F.when(exact, as_bytes).alias(f"_b{i}"), F.when(~exact, text).alias(f"_k{i}")]
            back[c] = F.coalesce(F.col(f"_k{i}"), F.lower(F.hex(F.col(f"_b{i}"))))
        else:
            keys.append(text.alias(f"_k{i}"))
            back[c] = F.col(f"_k{i}")
    row = F.struct(_order_struct(order).alias("o"), *[F.col(f"`{c}`").alias(f"r{i}") for i, c in enumerate(rest)])
    best = df.groupBy(*keys).agg(F.min(row).alias("_r"))
    back.update({c: F.col("_r.o")[f"v{i}"] for i, c in enumerate(order) if c not in subset})
    back.update({c: F.col("_r")[f"r{i}"] for i, c in enumerate(rest)})
    return best.select(*[back[c].alias(c) for c in df.columns])


#: Keys that come again, up to which they are broadcast.
REPEATED_KEYS = 1_000_000


def mark_repeated(df: DataFrame, key: Column, out: str) -> DataFrame:
    """Add ``out``, false only on rows that no other row shares its ``key`` with: the rest may have to be
    compared (F5), these need not move.

    The shuffle counts hashes of the keys, not rows. Hashes that come again are broadcast, at most
    ``REPEATED_KEYS`` of them; if there are more, ``out`` is true on every row, and so it is without a key.
    """
    df = df.withColumn("_hash", F.xxhash64(key))
    again = (df.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
             .select("_hash", F.lit(True).alias("_hit")).limit(REPEATED_KEYS + 1))
    many = again.agg((F.count(F.lit(1)) > REPEATED_KEYS).alias("_many"))
    d = df.join(F.broadcast(again), "_hash", "left").crossJoin(F.broadcast(many))
    return d.withColumn(out, key.isNull() | F.col("_many") | F.col("_hit").isNotNull()).drop("_hash", "_hit", "_many")


def cutover_predicate(start: str, end: str, cutover, award_col: str,
                      before_award: str, after_award: str) -> Column:
    """(end <= cut and award = before) or (start >= cut and award = after)."""
    c = F.lit(cutover) if not isinstance(cutover, Column) else cutover
    return (((F.col(end) <= c) & (F.col(award_col) == before_award))
            | ((F.col(start) >= c) & (F.col(award_col) == after_award)))


def text_contains(col: str, needle: str) -> Column:
    """``str.contains`` (literal, null -> false)."""
    return F.coalesce(F.col(col).contains(needle), F.lit(False))


def drop_rows(df: DataFrame, lineage_col: str, labels: Sequence[str]) -> DataFrame:
    """remove specific rows identified by their lineage label."""
    return df.filter(~F.col(lineage_col).isin(list(labels)) | F.col(lineage_col).isNull())
