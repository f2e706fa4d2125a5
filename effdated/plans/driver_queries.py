"""Operators exercised on the driver tables, each with an equivalent DuckDB SQL.

Domain stand-ins (see FIXTURES.md): customer = employee, nation = region,
orders = effective-dated status rows (key o_custkey, date o_orderdate, tie
o_orderkey), events = periods (key user_id, [ts, ts + value minutes)), lineitem =
payslip lines. Money is summed as DECIMAL(18,2) and returned as DOUBLE so that
both engines give bit-identical values. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from effdated.operators.scan import KeyStatistics, key_statistics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hot_keys(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> KeyStatistics:
    """Key statistics of a driver table, taken once per session folder and read by all scans on the key."""
    return key_statistics(table(spark, sf_dir, name), list(keys), name=f"{sf_dir}/{name}")


#: What takes the statistics of a table or of a derived frame; queries on others add theirs.
STATISTICS: list[Callable[[SparkSession, str], KeyStatistics]] = [
    lambda spark, sf: hot_keys(spark, sf, "orders", "o_custkey"),
    lambda spark, sf: hot_keys(spark, sf, "events", "user_id"),
    lambda spark, sf: hot_keys(spark, sf, "lineitem", "l_suppkey"),
]


def take_statistics(spark: SparkSession, sf_dir: str) -> list[KeyStatistics]:
    """The explicit statistics step for all that is scanned by key. After it, building a query
    runs no job; without it, the first query on a table takes the statistics that it needs."""
    all_queries()
    return [take(spark, sf_dir) for take in STATISTICS]


def money(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def as_double(c: F.Column) -> F.Column:
    return c.cast("double")


def all_queries() -> tuple[dict, dict]:
    """Import every query module (they register themselves) and return the registries."""
    from effdated.plans import q_intervals  # noqa: F401
    for mod in ("q_columns", "q_report", "q_quality", "q_sources", "q_shifts", "q_stage", "q_load"):
        try:
            __import__(f"effdated.plans.{mod}")
        except ModuleNotFoundError as e:  # module not written yet
            if mod not in str(e):
                raise
    return QUERIES, ORACLES
