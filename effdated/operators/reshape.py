"""Reshapes (R1-R6, A9): unpivot, keyword melt, aggregating melt, constant tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str],
            var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide -> long; null cells are kept (as ``UNNEST`` of parallel arrays does)."""
    return df.unpivot(list(ids), list(value_cols), var_name, value_name)


def melt_keyword(df: DataFrame, id_vars: Sequence[str], keywords: Mapping[str, str],
                 var_name: str = "variable", extra_columns: Sequence[str] = (),
                 aggregate_rows: bool = False, dropna: bool = False) -> DataFrame:
    """R2 (+A9 with ``aggregate_rows``): melt columns picked by keyword.

    ``keywords`` maps an output value column to the keyword marking its source columns,
    e.g. ``{"Amount": " (Amt)", "Hours": " (Hrs)"}``: columns ``"X (Amt)"`` and
    ``"X (Hrs)"`` become one row with ``var_name = "X"``, ``Amount`` and ``Hours``.
    The melts line up on the name with the keyword removed. A name missing for one
    keyword gives null there. It is one ``explode`` of an array of structs, with no
    join between the melts. Empty cells are kept, as pandas ``melt`` keeps them, unless
    ``dropna``. ``aggregate_rows`` sums the value columns per (ids, variable).
    """
    bases: list[str] = []
    for c in df.columns:
        for kw in keywords.values():
            if kw in c:
                b = c.replace(kw, "").strip()
                if b not in bases:
                    bases.append(b)
    if not bases:
        raise ValueError(f"no column matches keywords {list(keywords.values())}")
    cols = set(df.columns)

    def src(b: str, kw: str):
        for cand in (b + kw, f"{b} {kw.strip()}", f"{b}{kw.strip()}"):
            if cand in cols:
                return F.col(f"`{cand}`")
        return F.lit(None)

    items = F.array(*[F.struct(F.lit(b).alias(var_name),
                               *[src(b, kw).alias(name) for name, kw in keywords.items()])
                      for b in bases])
    keep = [*id_vars, *extra_columns]
    out = df.select(*[F.col(f"`{c}`") for c in keep], F.explode(items).alias("_m"))
    out = out.select(*keep, F.col(f"_m.{var_name}").alias(var_name),
                     *[F.col(f"_m.`{n}`").alias(n) for n in keywords])
    if dropna:
        out = out.filter(" OR ".join(f"`{n}` IS NOT NULL" for n in keywords))
    if aggregate_rows:
        out = out.groupBy(*keep, var_name).agg(
            *[F.sum(F.col(f"`{n}`")).alias(n) for n in keywords])  # in the column's own type
    return out


def constant_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """An inline ``VALUES`` table (rates, buckets, FY rules)."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def financial_year_rules(spark: SparkSession, first_fy: int, last_fy: int, start_month: int = 7) -> DataFrame:
    """FY rule table ``(fy string, start_of_fy date, end_of_fy date)`` generated from a
    range (no driver-side rows): FY y runs from 1 <start_month> y-1 to the day before
    1 <start_month> y."""
    return (spark.range(first_fy, last_fy + 1)
            .select(F.col("id").cast("string").alias("fy"),
                    F.make_date(F.col("id").cast("int") - 1, F.lit(start_month), F.lit(1)).alias("start_of_fy"),
                    F.date_sub(F.make_date(F.col("id").cast("int"), F.lit(start_month), F.lit(1)), 1).alias("end_of_fy")))
