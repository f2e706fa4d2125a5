"""Catalog, sinks and audit.

Tables live in the session catalog as parquet data-source tables. Bronze loads are
idempotent: the table is partitioned by the source file's path id and written with dynamic
partition overwrite, so re-ingesting a file replaces only its own rows. That
replaces the reference's input-hash task cache. External databases are read through
the JDBC source (``read_query``); no server is started by this library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_IDENTIFIER = 63  # Postgres identifier length the source tables were named under


def normalise_table_name(name: str, max_len: int = MAX_IDENTIFIER) -> str:
    """Runs of non-alphanumerics -> ``_``, truncated to ``max_len``."""
    return re.sub(r"[^a-zA-Z0-9]+", "_", name)[:max_len]


def normalised_names(names: Sequence[str]) -> dict[str, str]:
    """S16 with a collision check: two source names may not map to one table."""
    out: dict[str, str] = {}
    for n in names:
        t = normalise_table_name(n)
        if t in out.values():
            raise ValueError(f"table name collision after normalising {n!r} -> {t!r}")
        out[n] = t
    return out


def ensure_schema(spark: SparkSession, name: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def ensure_table(spark: SparkSession, table: str, structure: T.StructType | Mapping[str, str],
                 partition_by: Sequence[str] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with a given structure (parquet)."""
    if isinstance(structure, T.StructType):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in structure.fields)
    else:
        cols = ", ".join(f"`{c}` {t}" for c, t in structure.items())
    part = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{part}")


def add_missing_columns(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    """Add every column of ``df`` missing from ``table`` (schema evolution)."""
    have = {c.name.lower() for c in spark.catalog.listColumns(table)}
    missing = [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name.lower() not in have]
    if missing:
        cols = ", ".join(f"`{n}` {t}" for n, t in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return [n for n, _ in missing]


def write_bronze(spark: SparkSession, df: DataFrame, table: str, partition_col: str | None = None) -> None:
    """Append all-text rows by name; re-running a file replaces its partition only. The
    partition is the file's path id where the rows have one: files of equal name in
    different folders do not replace each other.

    New columns are added first (S21); columns the table has but ``df`` lacks are
    written as null.
    """
    partition_col = partition_col or ("source_id" if "source_id" in df.columns else "source_file")
    if not spark.catalog.tableExists(table):
        (df.write.format("parquet").partitionBy(partition_col).mode("overwrite").saveAsTable(table))
        return
    add_missing_columns(spark, table, df)
    target = [c.name for c in spark.catalog.listColumns(table)]
    types = {c.name: c.dataType for c in spark.catalog.listColumns(table)}
    aligned = df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(types[c])).alias(c)
                          for c in target])
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        aligned.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """Query -> DataFrame (catalog tables)."""
    return spark.sql(sql)


def read_query(spark: SparkSession, url: str, sql: str, properties: Mapping[str, str] | None = None,
               fetchsize: int = 10000) -> DataFrame:
    """Query an external database over JDBC (the driver jar must be on the
    classpath). Credentials come from ``properties`` / cluster config, never from code."""
    r = spark.read.format("jdbc").option("url", url).option("query", sql).option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def inspect_table(spark: SparkSession, table: str) -> dict[str, str]:
    """Column -> type."""
    return {c.name: c.dataType for c in spark.catalog.listColumns(table)}


def schema_exists(spark: SparkSession, name: str) -> bool:
    """S23."""
    return spark.catalog.databaseExists(name)


def table_exists(spark: SparkSession, table: str) -> bool:
    """S23."""
    return spark.catalog.tableExists(table)


def table_shape(spark: SparkSession, table: str) -> dict[str, int]:
    """``{row, column}`` (row count from one aggregation)."""
    t = spark.table(table)
    return {"row": t.count(), "column": len(t.columns)}


def reading_audit(df: DataFrame, dataset: str, filename_col: str = "source_file",
                  options: Mapping | None = None) -> DataFrame:
    """One audit row per ingested file: (dataset, filename, read options, rows,
    columns, loaded_at), from one aggregation of the bronze rows."""
    ncols = len([c for c in df.columns if c not in (filename_col, "Source", "record_no", "source_id")])
    return (df.groupBy(F.col(filename_col).alias("filename"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
            .select(F.lit(dataset).alias("dataset"), "filename",
                    F.lit(json.dumps(dict(options or {}), sort_keys=True)).alias("pandas_attributes"),
                    "rows", F.lit(ncols).cast("int").alias("columns"),
                    F.current_timestamp().alias("loaded_at")))


def build_audit(spark: SparkSession, dataset: str, batch: str, tables: Sequence[str],
                function_used: Sequence[str]) -> DataFrame:
    """Raw-dataset build audit rows (dataset, batch, filename, function_used)."""
    rows = [(dataset, batch, t, ",".join(function_used)) for t in tables]
    return spark.createDataFrame(rows, "dataset string, batch string, filename string, function_used string")


def append_audit(df: DataFrame, table: str) -> None:
    """S25 / S26 sink: append-only audit table."""
    df.write.mode("append").format("parquet").saveAsTable(table)


def dataset_tables(spark: SparkSession, schema: str, filename_include: Sequence[str] = (),
                   filename_exclude: Sequence[str] = ()) -> list[str]:
    """Tables of ``schema`` whose names pass the include / exclude keywords."""
    names = [t.name for t in spark.catalog.listTables(schema)]
    return [n for n in names if all(k in n for k in filename_include if k)
            and not any(k in n for k in filename_exclude if k)]


def save_dict_to_folder(frames: Mapping[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """One parquet directory per key (a shared folder on a cluster)."""
    for key, df in frames.items():
        df.write.mode(mode).parquet(f"{folder.rstrip('/')}/{normalise_table_name(key)}")


def write_exception_report(violations: DataFrame, table: str | None = None, csv_path: str | None = None) -> None:
    """Exception report to a table and / or CSV folder."""
    if table:
        violations.write.mode("overwrite").format("parquet").saveAsTable(table)
    if csv_path:
        violations.write.mode("overwrite").option("header", "true").csv(csv_path)


def load_output(df: DataFrame, final_columns: Sequence[str] | Mapping[str, str], iso_columns: Sequence[str] = (),
                switch: bool = True) -> DataFrame | None:
    """The load projection: fixed final columns (``{source: output}`` renames
    allowed); ``iso`` columns rendered as ISO-8601 text. ``switch=False`` skips."""
    if not switch:
        return None
    cols = list(final_columns.items() if isinstance(final_columns, Mapping) else [(c, c) for c in final_columns])
    missing = [src for src, _ in cols if src not in df.columns]
    if missing:
        raise ValueError(f"load columns {missing} are not in the dataset")
    out = []
    for src, name in cols:
        c = F.col(f"`{src}`")
        if name in iso_columns or src in iso_columns:
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        out.append(c.alias(name))
    return df.select(*out)
