"""Type lattice (P3-P6): pandas dtype names <-> SQL names <-> Spark types."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The pandas dtype families the staging layer knows and their SQL names.
PANDAS_TO_SQL = {
    "object": "text",
    "int": "INT",
    "float": "numeric",
    "bool": "boolean",
    "datetime": "timestamp",
    "timedelta": "interval",
    "UUID": "UUID",
}

SQL_TO_SPARK = {
    "text": T.StringType(),
    "int": T.LongType(),
    "numeric": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "interval": T.DayTimeIntervalType(),
    "uuid": T.StringType(),
    "date": T.DateType(),
}

# YAML logical types used in staging settings.
LOGICAL_TO_SPARK = {
    "string": T.StringType(),
    "datetime": T.TimestampNTZType(),
    "numeric": T.DoubleType(),
    "decimal": T.DecimalType(18, 2),
    "integer": T.LongType(),
    "int": T.LongType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "object": T.StringType(),
    "float": T.DoubleType(),
    "iso": T.StringType(),
}


def pandas_family(dtype: str) -> str:
    """``int64`` -> ``int``, ``datetime64[ns]`` -> ``datetime`` (digits and units stripped)."""
    return re.sub(r"\d+(\[.*\])?$", "", re.sub(r"\[.*\]$", "", dtype))


def spark_type(name: str) -> T.DataType:
    """Resolve a pandas dtype, SQL name or YAML logical type to a Spark type."""
    key = name.strip()
    if key in LOGICAL_TO_SPARK:
        return LOGICAL_TO_SPARK[key]
    fam = pandas_family(key)
    if fam in PANDAS_TO_SQL:
        return SQL_TO_SPARK[PANDAS_TO_SQL[fam].lower()]
    if key.lower() in SQL_TO_SPARK:
        return SQL_TO_SPARK[key.lower()]
    try:
        return T._parse_datatype_string(key)
    except Exception as exc:  # noqa: BLE001
        raise KeyError(f"unknown data type {name!r}") from exc


def align_datatype(obj: DataFrame | Mapping[str, str], output_dtypes: str = "sql") -> dict[str, str]:
    """Column -> type name, as ``sql`` (Postgres-style), ``spark`` or ``pandas`` names. For
    ``pandas`` the given names are SQL types (or the schema of a DataFrame)."""
    if output_dtypes == "pandas":
        names = align_datatype(obj, "sql") if isinstance(obj, DataFrame) else dict(obj)
        back = {sql.lower(): pandas for pandas, sql in reversed(PANDAS_TO_SQL.items())}
        unknown = [c for c, t in names.items() if t.strip().lower() not in back]
        if unknown:
            raise KeyError(f"no pandas dtype for the SQL types of {unknown}")
        return {c: back[t.strip().lower()] for c, t in names.items()}
    if isinstance(obj, DataFrame):
        pairs = [(f.name, f.dataType) for f in obj.schema.fields]
        if output_dtypes == "spark":
            return {n: t.simpleString() for n, t in pairs}
        inverse = {T.StringType: "text", T.LongType: "int", T.IntegerType: "int", T.DoubleType: "numeric",
                   T.DecimalType: "numeric", T.BooleanType: "boolean", T.TimestampNTZType: "timestamp",
                   T.TimestampType: "timestamp", T.DayTimeIntervalType: "interval", T.DateType: "date"}
        out = {}
        for n, t in pairs:
            if type(t) not in inverse:
                raise KeyError(f"column {n!r}: no SQL type for {t.simpleString()}")
            out[n] = inverse[type(t)]
        return out
    if output_dtypes == "sql":
        out = {}
        for c, d in obj.items():
            fam = pandas_family(d)
            if fam not in PANDAS_TO_SQL:
                raise KeyError(f"column {c!r}: unknown pandas dtype {d!r}")
            out[c] = PANDAS_TO_SQL[fam]
        return out
    return {c: spark_type(d).simpleString() for c, d in obj.items()}


def change_data_type(df: DataFrame, dtype_map: Mapping[str, str]) -> DataFrame:
    """Cast columns; under ANSI mode (Spark 4 default) a bad value raises at run time."""
    return df.withColumns({c: F.col(c).cast(spark_type(t)) for c, t in dtype_map.items()})


def inspect_datatype(df: DataFrame) -> dict[str, str]:
    """P5: column -> Spark type name."""
    return dict(df.dtypes)


def define_datatype(df: DataFrame, dtype_map: Mapping[str, str]) -> DataFrame:
    """Cast, then verify the schema holds exactly the requested types (driver-side
    schema check only, no data is read)."""
    out = change_data_type(df, dtype_map)
    want = {(c, spark_type(t).simpleString()) for c, t in dtype_map.items()}
    have = {(c, t) for c, t in out.dtypes if c in dtype_map}
    diff = want ^ have
    if diff:
        raise TypeError(f"data types differ from request: {sorted(diff)}")
    return out
