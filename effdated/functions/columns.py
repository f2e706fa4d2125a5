"""Column operators (P1-P2, P7-P11, P15, P17-P20, P23-P25). All row-local except P11/P15."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effdated.functions.dates import MAX_DATE
from effdated.functions.types import spark_type

NULL_TOKEN = "None"  # YAML value meaning "null" in create_columns


def create_columns_with_default_value(df: DataFrame, column_name: Sequence[str] | str,
                                      default_value=None) -> DataFrame:
    """Add columns holding a constant (default null)."""
    names = [column_name] if isinstance(column_name, str) else list(column_name)
    return df.withColumns({n: F.lit(default_value) for n in names})


def rename_columns(df: DataFrame, name_map: Mapping[str, str]) -> DataFrame:
    """Rename by map; keys that are not columns are ignored."""
    present = {k: v for k, v in name_map.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def unify_headers(df: DataFrame, raw_column_names: Sequence[Sequence[str]],
                  unified_column_names: Sequence[str]) -> DataFrame:
    """Several raw header layouts -> one unified column list, by position.

    The first layout whose columns are all present is used. A raw name starting
    with ``create_`` means "not in this layout": the unified column is null.
    Columns outside the layout are kept after the unified ones.
    """
    cols = set(df.columns)
    for variant in raw_column_names:
        needed = [c for c in variant if not c.startswith("create_")]
        if all(c in cols for c in needed):
            sel = [(F.lit(None).cast("string") if raw.startswith("create_") else F.col(f"`{raw}`")).alias(u)
                   for raw, u in zip(variant, unified_column_names)]
            rest = [F.col(f"`{c}`") for c in df.columns if c not in variant and c not in unified_column_names]
            return df.select(*sel, *rest)
    raise ValueError(f"no header layout matches columns {sorted(cols)}")


def create_columns(df: DataFrame, spec: Mapping[str, Mapping]) -> DataFrame:
    """``{NAME: {column: src} | {value: v}, dtype: t}``; value ``'None'`` is null."""
    new = {}
    for name, s in spec.items():
        if s.get("column") is not None:
            c = F.col(f"`{s['column']}`")
        else:
            v = s.get("value")
            c = F.lit(None if v == NULL_TOKEN else v)
        if s.get("dtype"):
            c = c.cast(spark_type(s["dtype"]))
        new[name] = c
    return df.withColumns(new)


def staging_projection(df: DataFrame, settings: Sequence[Mapping], keep: str = "staging") -> DataFrame:
    """One typed projection ``raw -> staging`` for a list of column settings
    ``{raw, staging, type}``. ``type: iso`` renders a timestamp as ISO-8601 text."""
    cols = []
    for s in settings:
        src = s.get("raw") or s.get("staging")
        c = F.col(f"`{src}`")
        t = s.get("type")
        if t == "iso":
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif t:
            c = c.cast(spark_type(t))
        cols.append(c.alias(s.get(keep) or src))
    return df.select(*cols)


def value_mapper(df: DataFrame, value_mapping: Mapping[str, str], source_col: str,
                 target_col: str | None = None, use_regex: bool = False,
                 map_to_col_value: bool = False) -> DataFrame:
    """P10: map values of ``source_col`` into ``target_col`` (default in place).

    Exact match by default; with ``use_regex`` the keys are patterns tried in order.
    Unmatched values keep the target's current value (or the source value when the
    target is new). With ``map_to_col_value`` the mapped value names a column whose
    value is taken.
    """
    target = target_col or source_col
    src = F.col(f"`{source_col}`")
    fallback = F.col(f"`{target}`") if target in df.columns else src
    expr = None
    for k, v in value_mapping.items():
        cond = src.rlike(k) if use_regex else (src == F.lit(k))
        val = F.col(f"`{v}`") if map_to_col_value else F.lit(v)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    if expr is None:
        return df
    return df.withColumn(target, expr.otherwise(fallback))


def surrogate_code(keys: Sequence[str]) -> Column:
    """Deterministic code per key group (sha-256 of the keys; nulls tagged)."""
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("∅")) for k in keys]
    return F.sha2(F.concat_ws("#", *parts), 256)


def payslip_code(df: DataFrame, target: str, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(target, surrogate_code(keys))


def line_label(df: DataFrame, source_col: str = "Source", id_col: str = "source_id") -> Column:
    """What P18 hashes: the lineage label, behind the file's ``id_col`` where the rows carry one."""
    label = F.col(source_col).cast("string")
    return F.concat_ws("|", F.col(id_col), label) if id_col in df.columns else label


def payslip_line_code(df: DataFrame, target: str, source_col: str = "Source", id_col: str = "source_id") -> DataFrame:
    """Per-line code from the lineage label; survives fan-out joins unchanged. Where the rows carry the
    file's ``id_col`` (a hash of its path) it counts too, so that equal labels of two loads give two codes."""
    return df.withColumn(target, F.sha2(line_label(df, source_col, id_col), 256))


def report_projection(df: DataFrame, columns: Sequence[tuple[str | Column, str]]) -> DataFrame:
    """P20: final projection with display names; a repeated display name gets `` (2)``,
    `` (3)`` ... so that parquet / table sinks accept it."""
    seen: dict[str, int] = {}
    out = []
    for src, name in columns:
        n = seen.get(name, 0) + 1
        seen[name] = n
        c = F.col(src) if isinstance(src, str) else src
        out.append(c.alias(name if n == 1 else f"{name} ({n})"))
    return df.select(*out)


def leave_end_from_hours(df: DataFrame, leave_start: str, leave_end: str,
                         leave_hour_taken: str) -> DataFrame:
    """Leave end = start + hours taken (hours truncated to whole hours)."""
    hrs = F.col(leave_hour_taken).cast("double").cast("int")
    return df.withColumn(leave_end, F.col(leave_start) + F.make_dt_interval(F.lit(0), hrs))


# Seconds per unit of a break length.
BREAK_UNITS = {"hour": 3600.0, "hours": 3600.0, "minute": 60.0, "minutes": 60.0}


def unpaid_break(df: DataFrame, target_col: str, pay_start: str, pay_end: str,
                 break_length: str, break_length_format: str = "hours") -> DataFrame:
    """Unpaid break placed in the middle of the shift, as struct {start, end}; null
    when the break length is not positive. ``break_length_format``: hour(s) or minute(s)."""
    if break_length_format not in BREAK_UNITS:
        raise ValueError(f"unknown break length format {break_length_format!r}; one of {sorted(BREAK_UNITS)}")
    secs = F.col(break_length).cast("double") * F.lit(BREAK_UNITS[break_length_format])
    shift_secs = F.timestamp_diff("SECOND", F.col(pay_start), F.col(pay_end))
    lead_secs = ((shift_secs - secs) / 2).cast("long")
    b_start = F.col(pay_start) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), lead_secs)
    b_end = b_start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("long"))
    return df.withColumn(target_col, F.when(secs > 0, F.struct(b_start.alias("start"), b_end.alias("end"))))


def attributes_over_time(df: DataFrame, key_col_list: Sequence[str],
                         attributes_col_list: Sequence[str], out: str = "Attribute",
                         name_col: str = "Key", value_col: str = "Value") -> DataFrame:
    """P25: unpivot attribute columns; each row's payload is ``{"Key": name, "Value": value}``
    as JSON text. Null attribute values are dropped."""
    long = df.unpivot(list(key_col_list), list(attributes_col_list), name_col, value_col)
    long = long.filter(F.col(value_col).isNotNull())
    return long.withColumn(out, F.to_json(F.struct(F.col(name_col).alias("Key"),
                                                   F.col(value_col).cast("string").alias("Value"))))


def fill_end_with_termination(df: DataFrame, key: str, start: str, end: str, termination: str,
                              order_by: Sequence[str] = (), sentinel: str | None = MAX_DATE, hot_rows=None) -> DataFrame:
    """On the last row of each key (by start) a null end becomes the termination
    date, else the open-end sentinel. Uses the skew-safe scan for "last row of key"."""
    from effdated.operators import scan
    lay = scan.layout(df, [key], [start, *order_by], hot_rows)
    lay = scan.with_next(lay, [start])
    fill = F.coalesce(F.col(f"`{termination}`").cast("timestamp_ntz"),
                      F.lit(sentinel).cast("timestamp_ntz") if sentinel else F.lit(None))
    new_end = F.when(~F.col("_has_next") & F.col(f"`{end}`").isNull(), fill).otherwise(F.col(f"`{end}`"))
    return lay.df.withColumn(end, new_end).drop("_has_next", "_next_" + start, "_sub")


def forward_fill(df: DataFrame, id_vars: Sequence[str], group: Sequence[str],
                 order: Sequence[str], hot_rows=None) -> DataFrame:
    """Blank ``id_vars`` cells take the last non-null value above them within
    ``group`` (usually the source file) in ``order`` (record number). Skew-safe scan."""
    from effdated.operators import scan
    lay = scan.layout(df, list(group), list(order), hot_rows)
    for c in id_vars:
        lay = scan.with_last_non_null(lay, c, c)
    return lay.df.drop("_sub")
