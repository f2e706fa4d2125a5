"""Aggregations: per-column agg settings (A1), filtered sums (A2-A6), crosstab (A8), melt-sum.

Every aggregate here is partial-aggregatable (map-side combine), so a hot group key
is pre-aggregated on each mapper before the shuffle. The exceptions are ``unique`` and
``list``: these return the group's values themselves, so their output grows with the group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effdated.operators.scan import _order_struct, qc, qcs


def _ordered_values(c: str, order: Column | None) -> Column:
    """Values of the group in ``order``; without one, in the values' own order, nulls last."""
    o = order if order is not None else F.struct(qc(c).isNull().alias("n"), qc(c).alias("v"))
    return F.transform(F.array_sort(F.collect_list(F.struct(o.alias("o"), qc(c).alias("v")))),
                       lambda x: x["v"])


def agg_expr(c: str, how: str, order: Column | None = None) -> Column:
    """One column aggregate with pandas ``groupby.agg`` meaning.

    ``first`` / ``last`` are the first / last **non-null** value in ``order``;
    ``unique`` is the distinct values in order of appearance, nulls included;
    ``list`` is every value in order. Without an order these two follow the values' own
    order, so the result does not depend on how rows were dealt out.
    """
    col = qc(c)
    if how == "min":
        return F.min(col)
    if how == "max":
        return F.max(col)
    if how == "sum":
        return F.sum(col)
    if how == "mean":
        return F.avg(col)
    if how == "count":
        return F.count(col)
    if how == "size":
        return F.count(F.lit(1))
    if how == "nunique":
        return F.count_distinct(col)
    if how in ("first", "last"):
        if order is None:
            raise ValueError(f"'{how}' needs an order")
        keep = F.when(col.isNotNull(), order)
        return F.min_by(col, keep) if how == "first" else F.max_by(col, keep)
    if how == "unique":
        return F.array_distinct(_ordered_values(c, order))
    if how == "list":
        return _ordered_values(c, order)
    raise ValueError(f"unsupported aggregate {how!r} for column {c!r}")


def grouper(df: DataFrame, keys: Sequence[str], group_settings: Mapping[str, str],
            order_by: Sequence[str] | None = None) -> DataFrame:
    """``simple_pandas_grouper``: ``groupBy(keys).agg({col: how})`` keeping column names."""
    order = _order_struct(list(order_by)) if order_by else None
    aggs = [agg_expr(c, how, order).alias(c) for c, how in group_settings.items() if c not in keys]
    return df.groupBy(*qcs(keys)).agg(*aggs)


def filtered_sum(value: Column | str, cond: Column, zero_if_empty: bool = True) -> Column:
    """``coalesce(sum(v) FILTER (WHERE cond), 0)``."""
    v = F.col(value) if isinstance(value, str) else value
    s = F.sum(F.when(cond, v))
    return F.coalesce(s, F.lit(0)) if zero_if_empty else s


def positive_part_sum(value: Column | str, cond: Column | None = None) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    x = F.greatest(v, F.lit(0))
    return F.sum(x if cond is None else F.when(cond, x))


def negative_part_sum(value: Column | str, cond: Column | None = None) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    x = F.least(v, F.lit(0))
    return F.sum(x if cond is None else F.when(cond, x))


def crosstab(df: DataFrame, row_keys: Sequence[str], category: str, categories: Sequence[str],
             measures: Mapping[str, Column]) -> DataFrame:
    """Crosstab with a struct cell per category.

    ``pivot`` with an explicit category list needs no extra pass to discover values;
    each cell is a struct of the named measures (``None`` when the category is absent).
    """
    cell = F.struct(*[m.alias(name) for name, m in measures.items()])
    return df.groupBy(*row_keys).pivot(category, list(categories)).agg(cell)


def expand_cells(df: DataFrame, row_keys: Sequence[str], categories: Sequence[str],
                 measure_names: Sequence[str], sep: str = "_") -> DataFrame:
    """One column per (category, measure) — ``<category>_<measure>``."""
    cols = [F.col(k) for k in row_keys]
    for cat in categories:
        for m in measure_names:
            cols.append(F.col(f"`{cat}`.`{m}`").alias(f"{cat}{sep}{m}"))
    return df.select(*cols)


def count_distinct_where(col: str, cond: Column) -> Column:
    """``count(distinct col) FILTER (WHERE cond)``."""
    return F.count_distinct(F.when(cond, F.col(col)))
