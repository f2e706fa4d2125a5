"""Dataset assembly and operator chains.

A stage is an ordered list of steps over a dict of named DataFrames. Every step
names a function, its arguments, the source dataset(s) and the target name, and
can be switched off. Steps only compose lazy DataFrames; nothing runs until the
caller writes or collects a result, so Catalyst optimises the whole chain as one
plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from effdated.functions import columns as cl
from effdated.functions import dates as dt
from effdated.functions import types as ty
from effdated.operators import aggregate as ag
from effdated.operators import filters as fl
from effdated.operators import intervals as iv
from effdated.operators import joins as jn
from effdated.operators import lineage as ln
from effdated.operators import quality as dq
from effdated.operators import reshape as rs
from effdated.operators import shifts as sh


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """Union same-shaped tables by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """``UNION`` (distinct)."""
    return union_batches(frames).distinct()


def split_datasets(df: DataFrame, filters: Mapping[str, str]) -> dict[str, DataFrame]:
    """Named sub-datasets, each a SQL predicate over ``df``."""
    return {name: df.filter(F.expr(pred)) for name, pred in filters.items()}


# Names a stage may use, mapped to operators: (function, takes extra source frames)
REGISTRY: dict[str, Callable] = {
    "create_columns_with_default_value": cl.create_columns_with_default_value,
    "rename_columns": cl.rename_columns,
    "change_data_type": ty.change_data_type,
    "define_datatype": ty.define_datatype,
    "unified_columns": cl.unify_headers,
    "create_columns": cl.create_columns,
    "value_mapper": cl.value_mapper,
    "fill": cl.forward_fill,
    "change_date_format": dt.change_date_format,
    "fill_null_with_max_date": dt.fill_null_with_max_date,
    "add_n_extra_day_to_date_value": dt.add_n_days,
    "add_week_number_and_week_day_to_date": dt.week_parts,
    "matching_financial_year": dt.matching_financial_year,
    "payslip_code": cl.payslip_code,
    "payslip_line_code": cl.payslip_line_code,
    "attributes_over_time_formatter": cl.attributes_over_time,
    "row_filter": fl.row_filter,
    "dataset_filter": fl.dataset_filter,
    "out_of_scope_filter": fl.out_of_scope_filter,
    "flatten_effective_date": iv.flatten_effective_date,
    "flatten": iv.flatten,
    "group_multiple_date": iv.group_multiple_date,
    "add_overlapping_identifier": iv.add_overlapping_identifier,
    "cut_time_interval_by_cutover_point": iv.cut_at_points,
    "unify_overlapping": iv.unify_overlapping,
    "pick_longest": iv.pick_longest,
    "remove_overlapping_and_flatten": iv.remove_overlaps_and_flatten,
    "simple_pandas_grouper": ag.grouper,
    "melt": rs.melt_keyword,
    "unpivot": rs.unpivot,
    "list_source_to_dict": ln.list_source_to_dict,
    "reformat_source": ln.list_source_to_dict,
    "broken_shifts": sh.broken_shifts,
    "split_shift_attribute": sh.split_attribute,
    "personal_leave_conversion": sh.rank_and_convert,
    "one_flag_per_week": sh.one_flag_per_week,
    "summarize_broken_shifts": sh.summarize_broken_shifts,
    "worked_share": sh.trailing_day_share,
    "unpaid_break": cl.unpaid_break,
    "leave_end_from_hours": cl.leave_end_from_hours,
    "fill_end_with_termination": cl.fill_end_with_termination,
    "staging_projection": cl.staging_projection,
    "non_nan": dq.non_nan,
    "non_numeric": dq.non_numeric,
    "non_positive": dq.non_positive,
    "non_datetime": dq.non_datetime,
    "non_isacii": dq.non_ascii,
    "non_duplicate": dq.duplicated,
    "non_overlapping": dq.overlapping,
    "broken_records": dq.broken_records,
    "inscope": dq.not_in_scope,
    "shift_length": dq.shift_length,
    "end_before_start": dq.end_before_start,
    "implausible_dob": dq.implausible_dob,
}

# Steps that take a second dataset (``sources: [dataset, other]``).
_TWO_FRAME: dict[str, Callable] = {
    "keep_keys_in": fl.keep_keys_in,
    "combine_auxiliary_dataset": jn.interval_join,
    "interval_join": jn.interval_join,
    "file_lookup": lambda df, other, **a: jn.lookup(df, mapping=other, **a),
    "inscope_lookup": lambda df, other, **a: jn.lookup(df, mapping=other, **a),
    "attach_constants": jn.attach_constants,
    "union": lambda df, other: union_batches([df, other]),
    "union_distinct": lambda df, other: union_distinct([df, other]),
    "add_public_holidays": lambda df, other, **a: sh.add_public_holidays(df, calendar=other, **a),
    "append_intervals": sh.append_intervals,
    "override_values": sh.override_values,
    "add_region_to_classification": lambda df, other, qualifier, **a: sh.qualify_by_period(df, periods=other, qualifier=F.col(f"`{qualifier}`"), **a),
    "add_synthetic_days": lambda df, other, **a: sh.add_synthetic_days(df, days=other, **a),
    "cross_dataset_period": lambda df, other, **a: dq.outside_periods(df, periods=other, **a),
}


def run_stage(datasets: Mapping[str, DataFrame], steps: Sequence[Mapping],
              registry: Mapping[str, Callable] | None = None) -> dict[str, DataFrame]:
    """U4: apply ``steps`` in order.

    A step is ``{"function": name, "args": {...}, "sources": [ds, (other)], "targets":
    [ds], "switch": True}``. ``sources`` defaults to the previous target, ``targets``
    to the first source. The result is a new dict of (lazy) DataFrames.
    """
    reg = dict(REGISTRY)
    reg.update(registry or {})
    out = dict(datasets)
    last: str | None = next(iter(out), None)
    for step in steps:
        if not step.get("switch", True):
            continue
        name = step["function"]
        sources = list(step.get("sources") or [last])
        targets = list(step.get("targets") or sources[:1])
        args = dict(step.get("args") or {})
        if name in _TWO_FRAME:
            result = _TWO_FRAME[name](out[sources[0]], out[sources[1]], **args)
        elif name in reg:
            result = reg[name](out[sources[0]], **args)
        else:
            raise KeyError(f"unknown stage function {name!r}")
        for t in targets:
            out[t] = result
        last = targets[0]
    return out
