"""Load stage (S30) and exception-test runner: configuration in, tables out.

Both take plain dictionaries in the shape of the declared configuration, so a user's
settings carry over. Nothing is computed until a returned DataFrame is used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from effdated.operators import quality as dq
from effdated.sources.catalog import load_output, normalise_table_name

VIOLATION = ["dataset", "test", "column", "value", "key"]


def _violations(found: DataFrame, dataset: str, test: str, keys: Sequence[str], column: str | None = None) -> DataFrame:
    """Any test's result in one shape; ``key`` is the JSON text of the key columns."""
    has = found.columns
    named = F.lit(column) if column else F.col("column") if "column" in has else F.lit(None).cast("string")
    value = (F.col(f"`{column}`").cast("string") if column and column in has
             else F.col("value") if "value" in has else F.lit(None).cast("string"))
    key = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]))
    return found.select(F.lit(dataset).alias("dataset"), F.lit(test).alias("test"), named.alias("column"), value.alias("value"), key.alias("key"))


def run_exception_tests(datasets: Mapping[str, DataFrame], config: Mapping[str, Mapping],
                        mappings: Mapping[str, Sequence[str] | DataFrame] | None = None) -> DataFrame:
    """One table of violations (``dataset, test, column, value, key``) for all datasets.

    ``config``: ``{dataset: {keys: [...], validation_tests: {...}, inscope_mappings: {...}}}``
    with the tests ``non_nan, non_numeric, non_positive, non_datetime, non_isacii`` (lists of
    columns), ``exclude_nan``, ``non_duplicate: {subset}``, ``non_overlapping: {key, start, end,
    group_records}``, ``shift_length: {start, end, min_minutes, max_hours}``, ``end_before_start:
    {start, end}`` and ``broken_records`` (columns). ``inscope_mappings``: ``{mapping:
    {client_columns: [...]}}``, with the allowed values of each mapping in ``mappings``. Empty
    lists and false switches test nothing; an unknown test raises.
    """
    simple = {"non_nan": dq.non_nan, "non_numeric": dq.non_numeric, "non_positive": dq.non_positive,
              "non_datetime": dq.non_datetime, "non_isacii": dq.non_ascii}
    parts: list[DataFrame] = []
    for name, spec in config.items():
        df, keys = datasets[name], list(spec["keys"])
        tests = dict(spec.get("validation_tests") or {})
        excluded = tests.pop("exclude_nan", None) or []
        for test, args in tests.items():
            if not args:
                continue
            if test in simple:
                more = {"exclude_nan": excluded} if test == "non_nan" else {}
                parts.append(_violations(simple[test](df, list(args), keys, **more), name, test, keys))
            elif test == "non_duplicate":
                if args.get("subset"):
                    found = dq.duplicated(df, args["subset"])
                    if "duplicate_of" in found.columns:  # a list of subsets: the column names the one repeated
                        found = found.withColumn("column", F.col("duplicate_of"))
                    parts.append(_violations(found, name, test, keys))
            elif test == "non_overlapping":
                parts.append(_violations(dq.overlapping(df, args["key"], args["start"], args["end"], bool(args.get("group_records"))), name, test, keys))
            elif test == "broken_records":
                parts.append(_violations(dq.broken_records(df, list(args), "_overflow" if "_overflow" in df.columns else None), name, test, keys))
            elif test == "shift_length":
                parts.append(_violations(dq.shift_length(df, args["start"], args["end"], args.get("min_minutes"), args.get("max_hours")), name, test, keys))
            elif test == "end_before_start":
                parts.append(_violations(dq.end_before_start(df, args["start"], args["end"]), name, test, keys))
            else:
                raise ValueError(f"unknown validation test {test!r} of dataset {name!r}")
        for mapping, args in (spec.get("inscope_mappings") or {}).items():
            for column in (args or {}).get("client_columns") or []:
                if mapping not in (mappings or {}):
                    raise ValueError(f"no values given for the mapping {mapping!r}")
                found = dq.not_in_scope(df, column, mappings[mapping])
                parts.append(_violations(found, name, f"inscope_{mapping}", keys, column))
    if not parts:
        raise ValueError("the configuration asks for no test")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# The declared output tables, each with its source dataset and final columns.
LOAD_TABLES = {
    "EmployeeBase": ("masterEMP", ["EmployeeCode", "StartDate", "EndDate", "DateOfBirth", "Source"]),
    "EmployeeClassification": ("masterSMN", ["EmployeeCode", "StartDate", "EndDate", "Classification", "Award"]),
    "EmployeeEmploymentType": ("masterPOS", ["EmployeeCode", "StartDate", "EndDate", "EmploymentType"]),
    "EmployeeSetoffStrategy": ("setoffstrategy", ["EmployeeCode", "StartDate", "EndDate", "StrategyName"]),
    "EmployeeRatesOverTime": ("masterSMN_Hourly_Rate", ["EmployeeCode", "StartDate", "EndDate", "BaseRate"]),
    "EmployeeCohortsOverTime": ("cohort", ["EmployeeCode", "StartDate", "EndDate", "Cohort"]),
    "Leave": ("leave", ["EmployeeCode", "Start", "End", "PayCode", "ClientPayCodeDescription", "Source", "LeaveType"]),
    "Payslip": ("payslips", ["EmployeeCode", "PayslipCode", "PayslipLineCode", "PeriodStart", "PeriodEnd", "PayCode", "Description",
                             "ClientPayCodeDescription", "Hours", "Amount", "Classification", "Source"]),
    "Timesheet": ("timesheets", ["EmployeeCode", "ClockedIn", "ClockedOut", "RosteredIn", "RosteredOut", "UnpaidBreaks", "Region", "Source"]),
    "PayCodes": ("paycodes", ["ClientPayCodeDescription", "PayCode", "PayCategory", "IsPartOfOrdinaryTimeEarnings", "IsPartOfTotalSalary",
                              "IsSubjectToPayrollTax", "IsBonusOrCommission", "IsPartOfLslBase", "IsBaseHours"]),
    "EmployeeAttributesOverTime": ("paycodes", ["EmployeeCode", "StartDate", "EndDate", "Attribute"]),
}


def default_load_config(tables: Sequence[str] | None = None) -> dict[str, dict]:
    """The declared load settings, all switched on, for some or all tables."""
    return {t: {"switch": True, "transform_dataset": d, "final_columns": list(c)}
            for t, (d, c) in LOAD_TABLES.items() if tables is None or t in tables}


def load_outputs(spark: SparkSession, datasets: Mapping[str, DataFrame], config: Mapping[str, Mapping]) -> dict[str, DataFrame]:
    """``{table: DataFrame}`` of the switched-on outputs.

    An entry with ``transform_dataset`` is that dataset's final columns (``final_columns``: list,
    or ``{source: output}``; ``iso``: columns as ISO-8601 text). An entry without one, like
    ``Configuration``, is a table of one row with its constants. A dataset or a column
    that does not exist raises.
    """
    out: dict[str, DataFrame] = {}
    for table, spec in config.items():
        if not spec.get("switch", True):
            continue
        if "transform_dataset" not in spec:
            constants = {k: v for k, v in spec.items() if k != "switch"}
            out[table] = spark.range(1).select(*[F.lit(v).alias(k) for k, v in constants.items()])
            continue
        if spec["transform_dataset"] not in datasets:
            raise ValueError(f"output {table!r} needs the dataset {spec['transform_dataset']!r}")
        out[table] = load_output(datasets[spec["transform_dataset"]], spec["final_columns"], spec.get("iso", ()))
    return out


def row_metrics(table: str, df: DataFrame, spec: Mapping[str, Mapping]) -> dict[tuple[str, str | None], tuple[Column, int]]:
    """``{(test, column): (count of violations, tolerance)}`` of the tests that look at one row at a time.

    They are plain aggregates, so one pass answers all of them: :func:`check_outputs` puts them in one
    ``agg``, :func:`write_outputs` in ``observe``, so that writing an output also tests it.
    """
    def tolerated(args: Mapping) -> Column:
        codes = list(args.get("tolerance_employee_code") or args.get("tolarance_employee_code") or [])
        return ~F.coalesce(F.col(f"`{args.get('key', 'EmployeeCode')}`").isin(codes), F.lit(False)) if codes else F.lit(True)

    def count(bad: Column) -> Column:
        return F.count_if(F.coalesce(bad, F.lit(False)))

    out: dict[tuple[str, str | None], tuple[Column, int]] = {}
    for test, args in spec.items():
        if test == "test_null_values":
            allowed = set(args.get("tolerance_null_values") or [])
            for c in df.columns:
                if c not in allowed:
                    blank = F.trim(F.col(f"`{c}`")) == "" if df.schema[c].dataType.simpleString() == "string" else F.lit(False)
                    out[test, c] = (count(F.col(f"`{c}`").isNull() | blank), 0)
        elif test == "test_enddate_before_startdate":
            out[test, None] = (count((F.col(f"`{args['end']}`") < F.col(f"`{args['start']}`")) & tolerated(args)), 0)
        elif test in ("test_timesheet_short_shifts", "test_timesheet_long_shifts"):
            seconds = F.timestamp_diff("SECOND", F.col(f"`{args['start']}`"), F.col(f"`{args['end']}`"))
            bad = (seconds < args["tolerance_shift_minimum_length"] * 60 if test == "test_timesheet_short_shifts"
                   else seconds > args["tolerance_shift_maximum_length"] * 3600)
            out[test, None] = (count(bad & tolerated(args)), 0)
    return out


#: Tests of :func:`row_metrics`.
ROW_TESTS = {"test_null_values", "test_enddate_before_startdate", "test_timesheet_short_shifts", "test_timesheet_long_shifts"}


def _schema_faults(df: DataFrame, args: Mapping) -> list[str]:
    """Columns that are missing, not expected, or of another type than expected and tolerated."""
    found, wanted = dict(df.dtypes), dict(args["expected"])
    allowed, extra = args.get("tolerance_change_dtype") or {}, set(args.get("tolerance_irrelevant_columns") or [])
    bad = [c for c, kind in wanted.items() if c not in extra and found.get(c) not in (kind, allowed.get(c, kind))]
    return bad + [c for c in found if c not in wanted and c not in extra]


def check_outputs(outputs: Mapping[str, DataFrame], tests: Mapping[str, Mapping[str, Mapping]],
                  datasets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Load tests: ``(table, test, column, n_violations, tolerance, passed)`` per declared test.

    ``tests``: ``{table: {test: arguments}}`` with the declared names and tolerances. An entry with
    ``switch: false`` is left out.

    * ``test_null_values {tolerance_null_values}``, ``test_enddate_before_startdate {start, end}``,
      ``test_timesheet_short_shifts`` / ``_long_shifts {start, end, tolerance_shift_...}``: row by row, all in
      one scan of the table (``tolerance_employee_code`` excuses employees);
    * ``test_duplicated_data {subset, tolerance_number_of_duplicate_records}``: all subsets in one
      aggregation; ``test_overlapping {key, start, end, group_records, tolerance_employee_code}``;
    * ``test_column_and_datatype {expected, tolerance_change_dtype, tolerance_irrelevant_columns}``: schema only;
    * ``test_data_source {files, tolerance_irrelevant_file}``: files (a DataFrame or a list) without a row;
    * ``test_membership {with, key, groups}``: keys of the table and of the ``datasets`` named in ``with``;
    * ``test_cross_dataset_period {compare_with, key, date, p_key, p_start, p_end}``: rows outside all periods.
    """
    rows = []

    def add(table: str, test: str, column: str | None, df: DataFrame, n, tolerance: int) -> None:
        rows.append(df.select(F.lit(table).alias("table"), F.lit(test).alias("test"), F.lit(column).cast("string").alias("column"),
                              n.cast("bigint").alias("n_violations"), F.lit(tolerance).cast("bigint").alias("tolerance")))

    total = F.count(F.lit(1)).alias("n")
    for table, declared in tests.items():
        spec, df = {t: a for t, a in declared.items() if (a or {}).get("switch", True)}, outputs[table]
        metrics = row_metrics(table, df, spec)
        if metrics:
            seen = df.agg(*[m.alias(f"m{i}") for i, (m, _) in enumerate(metrics.values())])
            each = F.explode(F.array(*[F.struct(F.lit(t).alias("test"), F.lit(c).cast("string").alias("column"), F.col(f"m{i}").alias("n_violations"), F.lit(tol).cast("bigint").alias("tolerance"))
                                       for i, ((t, c), (_, tol)) in enumerate(metrics.items())]))
            rows.append(seen.select(each.alias("e")).select(F.lit(table).alias("table"), "e.*"))
        for test, args in spec.items():
            if test in ROW_TESTS:
                continue
            if test in ("test_duplicated_data", "duplicated"):
                tol = int(args.get("tolerance_number_of_duplicate_records", args.get("tolerance", 0)))
                found = dq.duplicate_counts(df, args["subset"])
                rows.append(found.select(F.lit(table).alias("table"), F.lit(test).alias("test"), F.col("duplicate_of").alias("column"),
                                         F.col("n_rows").alias("n_violations"), F.lit(tol).cast("bigint").alias("tolerance")))
            elif test in ("test_overlapping", "overlapping"):
                codes = args.get("tolerance_employee_code") or args.get("tolarance_employee_code")
                excused = df.sparkSession.createDataFrame([(c,) for c in codes], "code string") if codes else None
                found = dq.overlapping(df, args["key"], args["start"], args["end"], bool(args.get("group_records")), tolerance_keys=excused)
                add(table, test, None, found.agg(total), F.col("n"), int(args.get("tolerance", 0)))
            elif test == "test_column_and_datatype":
                bad = _schema_faults(df, args)
                add(table, test, ",".join(bad) or None, df.sparkSession.range(1), F.lit(len(bad)), 0)
            elif test == "test_data_source":
                files = args["files"] if isinstance(args["files"], DataFrame) else df.sparkSession.createDataFrame([(f,) for f in args["files"]], "file string")
                files = files.filter(~F.col("file").isin(list(args.get("tolerance_irrelevant_file") or [])))
                add(table, test, None, dq.source_coverage(files, df, source_col=args.get("source", "Source")).agg(total), F.col("n"), 0)
            elif test == "test_membership":
                others = {n: datasets[n] for n in args["with"]}
                found = dq.membership({table: df, **others}, args["key"], args.get("groups"))
                add(table, test, None, found.agg(total), F.col("n"), int(args.get("tolerance", 0)))
            elif test == "test_cross_dataset_period":
                for other in args["compare_with"]:
                    found = dq.outside_periods(df, args["key"], args["date"], datasets[other], args.get("p_key", args["key"]), args["p_start"], args["p_end"])
                    codes = args.get("tolerance_employee_code") or []
                    found = found.filter(~F.col(f"`{args['key']}`").isin(list(codes))) if codes else found
                    add(table, test, other, found.agg(total), F.col("n"), int(args.get("tolerance", 0)))
            else:
                raise ValueError(f"unknown load test {test!r} of table {table!r}")
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out.withColumn("passed", F.col("n_violations") <= F.col("tolerance"))


def write_outputs(outputs: Mapping[str, DataFrame], schema: str, tests: Mapping[str, Mapping[str, Mapping]] | None = None) -> list[str] | DataFrame:
    """Save every output as a catalog table of ``schema``; gives the table names. With ``tests`` the
    row-by-row tests are observed while the tables are written, without another scan, and the
    result is their table, as :func:`check_outputs` gives it."""
    names, found = [], []
    for table, df in outputs.items():
        name = f"{schema}.{normalise_table_name(table)}"
        metrics = row_metrics(table, df, {t: a for t, a in (tests or {}).get(table, {}).items() if (a or {}).get("switch", True)})
        seen = Observation(f"load {table}")
        observed = df.observe(seen, *[m.alias(f"m{i}") for i, (m, _) in enumerate(metrics.values())]) if metrics else df
        observed.write.mode("overwrite").format("parquet").saveAsTable(name)
        names.append(name)
        if metrics:
            got = seen.get
            found += [(table, t, c, got[f"m{i}"], tol, got[f"m{i}"] <= tol) for i, ((t, c), (_, tol)) in enumerate(metrics.items())]
    if tests is None:
        return names
    spark = next(iter(outputs.values())).sparkSession
    return spark.createDataFrame(found, "table string, test string, column string, n_violations long, tolerance long, passed boolean")
