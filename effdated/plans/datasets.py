"""Declared dataset builds as compositions of the operators.

A build takes the bronze (all-text) DataFrame of its source and returns the typed
staging DataFrame. Column names are the source extracts' headers (fixed values).
Steps run in the declared order, except that dates are parsed before flattening:
the original flattened the raw text, which sorts day-first dates wrongly (we build
the intent, not that bug).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from effdated.functions import columns as cl
from effdated.functions import dates as dt
from effdated.operators import intervals as iv
from effdated.operators import lineage as ln

# masterSMN extract headers and their staging names.
SMN_KEY = "Staff Member"
SMN_DATE = "Effective Date"
SMN_FLAT = ["Current Class", "Current Class.1", "Termination Date"]
SMN_SETTINGS = [
    {"staging": "EmployeeCode", "raw": "Staff Member", "type": "string"},
    {"staging": "StartDate", "raw": "Effective Date", "type": "datetime"},
    {"staging": "EndDate", "raw": "end_date", "type": "datetime"},
    {"staging": "Classification", "raw": "Current Class", "type": "string"},
    {"staging": "Source", "raw": "Source", "type": "string"},
    {"staging": "source_file", "raw": "source_file", "type": "string"},
    {"staging": "Termination Date", "raw": "Termination Date", "type": "datetime"},
]


def effective_dated_master(bronze: DataFrame, key: str, date: str, flat_cols: list[str],
                           settings: list[dict], termination: str = "Termination Date",
                           order_by: list[str] | None = None) -> DataFrame:
    """The shared shape of the master-data builds: P12 day-first dates, T3 flatten per
    key on ``flat_cols`` (``end_date`` = next run's start), P15 open last run ->
    termination date or sentinel, L2 lineage text, P9 staging projection."""
    d = dt.change_date_format(bronze, date, dayfirst=True)
    if termination in bronze.columns:
        d = dt.change_date_format(d, termination, dayfirst=True)
    agg = {c: "first" for c in flat_cols}
    agg.update({"Source": "unique", "source_file": "first"})
    agg.update({s["raw"]: "first" for s in settings if s["raw"] in bronze.columns and s["raw"] not in agg
                and s["raw"] not in (key, date)})
    runs = iv.flatten(d, key, date, "end_date", flat_cols, agg, order_by or [])
    # flatten leaves end_date null exactly on each key's last run, so P15 reduces to a
    # row-local coalesce here (the general P15 operator needs an ordered scan)
    fill = [F.col(f"`{termination}`").cast("timestamp_ntz")] if termination in bronze.columns else []
    runs = runs.withColumn("end_date", F.coalesce(F.col("end_date"), *fill, F.lit(dt.MAX_DATE).cast("timestamp_ntz")))
    runs = ln.list_source_to_dict(runs, "Source")
    return cl.staging_projection(runs, settings)


def employee_classification(bronze: DataFrame, order_by: list[str] | None = None,
                            hot_rows: int | None = None) -> DataFrame:
    """EmployeeClassification (masterSMN): T3 flatten on (class, class.1, termination)
    per staff member in effective-date order, P12 day-first parse, P15 null end ->
    termination date (last run only, else the open-end sentinel), L2 lineage text,
    P9 staging projection."""
    return effective_dated_master(bronze, SMN_KEY, SMN_DATE, SMN_FLAT, SMN_SETTINGS, order_by=order_by)


def classification_awards(mapped: DataFrame, cutover: str, before_award: str, after_award: str,
                          keyword: str = " award mapping") -> DataFrame:
    """EmployeeClassification, stage one: T4 cut every period at the cut-over; R2 melt the
    ``<award> award mapping`` columns into (Award, Classification); F6 keep the award that
    applies on each side of the cut-over. Later builds use these cut periods."""
    from effdated.operators import reshape as rs
    cut = F.lit(cutover).cast("timestamp_ntz")
    ids = [c for c in mapped.columns if not c.endswith(keyword) and "mapping" not in c and c != "Classification"]
    d = iv.cut_at_points(mapped, "StartDate", "EndDate", [cut])
    d = rs.melt_keyword(d, ids, {"Classification": keyword}, var_name="Award")
    before = (F.col("EndDate") <= cut) & (F.col("Award") == before_award)
    after = (F.col("StartDate") >= cut) & (F.col("Award") == after_award)
    return d.filter(before | after)


def classification_final(awards: DataFrame, overrides: DataFrame | None, timesheets: DataFrame,
                         timesheet_award: str, region_classes: list[str]) -> DataFrame:
    """EmployeeClassification, stage two: T13 progression overrides per (EmployeeCode,
    StartDate); F2 / P25 / T15 the first location attribute of each timesheet of one award;
    T14 classifications in ``region_classes`` get the attribute of the employee's earliest such
    timesheet that lies in the period, as ``<classification> - <attribute>``."""
    from effdated.operators import joins as jn
    from effdated.operators import shifts as sh
    d = awards if overrides is None else sh.override_values(awards, overrides, ["EmployeeCode", "StartDate"], ["Classification"])
    attrs = attributes_over_time_build(timesheets, timesheet_award).filter("attribute_position = 1")
    own = d.filter(F.col("Classification").isin(region_classes)).select("EmployeeCode", "StartDate", "EndDate", "Classification").distinct()
    inside = jn.interval_join(attrs.select("EmployeeCode", "ClockedIn", "ClockedOut", F.col("Value").alias("_region")), own,
                              "EmployeeCode", "ClockedIn", "ClockedOut", "StartDate", "EndDate", "contained")
    ids = ["EmployeeCode", "StartDate", "EndDate", "Classification"]
    first = inside.groupBy(*ids).agg(F.min_by("_region", F.struct("ClockedIn", "ClockedOut", "_region")).alias("_region"))
    d = d.join(first, ids, "left")
    named = F.when(F.col("_region").isNotNull(), F.concat_ws(" - ", "Classification", "_region")).otherwise(F.col("Classification"))
    return d.withColumn("Classification", named).drop("_region")


# masterPOS headers, staging names and the in-scope employment types.
POS_SETTINGS = [
    {"staging": "EmployeeCode", "raw": "Staff Member", "type": "string"},
    {"staging": "StartDate", "raw": "Position Start", "type": "datetime"},
    {"staging": "EndDate", "raw": "end_date", "type": "datetime"},
    {"staging": "EmploymentType", "raw": "Employment Status", "type": "string"},
    {"staging": "Source", "raw": "Source", "type": "string"},
    {"staging": "source_file", "raw": "source_file", "type": "string"},
]
EMPLOYMENT_TYPES = ["FullTime", "PartTime", "Casual"]


def employment_type(bronze: DataFrame, status_mapping: dict[str, str],
                    order_by: list[str] | None = None, master_smn: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """EmployeeEmploymentType (masterPOS): the master build on (Employment Status,
    Termination Date), J10 map client statuses to in-scope types, then F3 keep employees
    present in masterSMN. Returns (staging, Q10 in-scope violations)."""
    from effdated.operators import filters as fl
    from effdated.operators import quality as dq
    staged = effective_dated_master(bronze, "Staff Member", "Position Start",
                                    ["Employment Status", "Termination Date"], POS_SETTINGS, order_by=order_by)
    staged = cl.value_mapper(staged, status_mapping, "EmploymentType")
    if master_smn is not None:
        staged = fl.keep_keys_in(staged, master_smn, "EmployeeCode")
    return staged, dq.not_in_scope(staged, "EmploymentType", EMPLOYMENT_TYPES)


# masterEMP headers and staging names.
EMP_SETTINGS = [
    {"staging": "EmployeeCode", "raw": "Staff Member", "type": "string"},
    {"staging": "StartDate", "raw": "Joined", "type": "datetime"},
    {"staging": "EndDate", "raw": "Termination Date", "type": "datetime"},
    {"staging": "DateOfBirth", "raw": "Birth Date", "type": "datetime"},
    {"staging": "Source", "raw": "Source", "type": "string"},
    {"staging": "source_file", "raw": "source_file", "type": "string"},
]


def employee_base(bronze: DataFrame, master_smn: DataFrame) -> DataFrame:
    """EmployeeBase (masterEMP): P12 day-first dates, P14 null termination -> open-end
    sentinel, P9 staging projection, F3 keep employees present in masterSMN, L2 lineage
    text."""
    from effdated.operators import filters as fl
    d = bronze
    for c in ("Joined", "Termination Date", "Birth Date"):
        d = dt.change_date_format(d, c, dayfirst=True)
    d = dt.fill_null_with_max_date(d, "Termination Date")
    d = cl.staging_projection(d, EMP_SETTINGS)
    d = fl.keep_keys_in(d, master_smn.select("EmployeeCode").distinct(), "EmployeeCode")
    return ln.list_source_to_dict(d.withColumn("Source", F.array("Source")), "Source")


def bronze_master_smn(orders: DataFrame) -> DataFrame:
    """Bronze masterSMN-shaped rows derived from a status table (used by the driver
    queries): all text, day-first dates, lineage per source row."""
    return orders.select(
        F.col("o_custkey").cast("string").alias("Staff Member"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Effective Date"),
        F.col("o_orderpriority").alias("Current Class"),
        F.col("o_orderstatus").alias("Current Class.1"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit("30/06/2002")).alias("Termination Date"),
        F.concat(F.lit("masterSMN:row:"), (F.col("o_orderkey") + 2).cast("string")).alias("Source"),
        F.lit("masterSMN.xlsx").alias("source_file"),
        F.col("o_orderkey"))


#: What the classification, the island and the pay run of a payslip line depend on.
PAYSLIP_PERIOD = ["EmployeeCode", "PeriodStart", "PeriodEnd"]


def payslips(staged: DataFrame, master_smn: DataFrame, payrun_index: DataFrame | None = None,
             dedupe_order: list[str] | None = None) -> DataFrame:
    """Payslip build. Stage 1: P8 empty code columns, P17 ``PayslipCode`` over
    (EmployeeCode, PeriodEnd), P18 ``PayslipLineCode`` from the lineage label, P16 closed
    period end + 1 day. Stage 2: F3 keep employees present in masterSMN; J5 join each
    line to the classification periods its start or end falls in (one inner bucketed
    interval join; a line spanning two periods meets both); P10 value mappers on
    ``Is Base Hours?`` (1 -> True, 0 -> False; False -> Hours 0); W6 overlap islands over
    distinct pay periods (``group_records``); T5 unify each island's period and code
    (min start, max end, code of the earliest period);
    J11 optional pay-run lookup; F5 keep the first row per ``PayslipLineCode``; L2 lineage
    text.

    F3, J5, W6, T5 and J11 look at a line's employee and period only, so they run on the distinct
    pay periods (:func:`payslip_periods`), which the lines then meet once. Hashes do not compress, so the
    codes come last: F5 groups by the label that P18 hashes, and T5 carries the period end that P17 hashes.
    Only lines whose label comes again are dealt out for F5."""
    from effdated.operators import filters as fl
    order = dedupe_order or ["StartDate", "Classification", "Hours", "Amount", "PayCode"]
    d = cl.create_columns(staged, {"PayslipCode": {"value": "None", "dtype": "string"},
                                   "PayslipLineCode": {"value": "None", "dtype": "string"}})
    d = dt.add_n_days(d, "PeriodEnd", 1)
    smn = master_smn.select("EmployeeCode", "StartDate", "EndDate", "Classification")
    p = payslip_periods(d.select(*PAYSLIP_PERIOD), smn, payrun_index, order)
    d = fl.mark_repeated(d, cl.line_label(d, "Source"), "_again")
    d = cl.value_mapper(d, {"1": "True", "0": "False"}, "Is Base Hours?")
    d = cl.value_mapper(d, {"False": "0"}, "Is Base Hours?", "Hours")
    own = [d[f"`{c}`"] for c in d.columns if c not in PAYSLIP_PERIOD]
    met = [p[c] for c in p.columns if c not in ("_employee", "_from", "_to", "overlapping_index", "PeriodStart", "PeriodEnd")]
    same = (d["EmployeeCode"] == p["_employee"]) & d["PeriodStart"].eqNullSafe(p["_from"]) & d["PeriodEnd"].eqNullSafe(p["_to"])
    d = d.join(p, same).select(d["EmployeeCode"], p["overlapping_index"], p["PeriodStart"], p["PeriodEnd"], *own, *met)
    again = d.filter("_again").withColumn("_label", cl.line_label(d, "Source"))
    d = d.filter("NOT _again").unionByName(fl.dedupe_keep_first(again, ["_label"], order).drop("_label"))
    d = dt.add_n_days(d, "_first", -1).withColumn("_first", F.col("_first").cast(staged.schema["PeriodEnd"].dataType))
    d = cl.payslip_code(d, "PayslipCode", ["EmployeeCode", "_first"])
    d = cl.payslip_line_code(d, "PayslipLineCode", "Source")
    return ln.list_source_to_dict(d.withColumn("Source", F.array("Source")), "Source").drop("_first", "_again")


def payslip_periods(lines: DataFrame, smn: DataFrame, payrun_index: DataFrame | None, order: list[str]) -> DataFrame:
    """The steps of the Payslip build that depend on a line's period: one row per distinct period
    ``(_employee, _from, _to)`` that F3 and J5 keep, with the unified ``PeriodStart`` and ``PeriodEnd``,
    ``_first`` (end of the island's earliest period), the island, the pay cycle, and of the classification
    periods found by J5 the one that F5 would keep of any line of the period."""
    from effdated.operators import filters as fl
    from effdated.operators import joins as jn
    p = fl.keep_keys_in(lines.distinct(), smn, "EmployeeCode")
    p = jn.interval_join(p, smn, "EmployeeCode", "PeriodStart", "PeriodEnd", "StartDate", "EndDate", "either_end")
    p = fl.dedupe_keep_first(p, PAYSLIP_PERIOD, [c for c in order if c in smn.columns and c != "EmployeeCode"])
    # one row per period, which is what group_records is for
    p = iv.add_overlapping_identifier(p, "EmployeeCode", "PeriodStart", "PeriodEnd")
    island = Window.partitionBy("EmployeeCode", "overlapping_index")
    p = p.withColumns({"_s": F.min("PeriodStart").over(island), "_e": F.max("PeriodEnd").over(island),
                       "_first": F.min_by("PeriodEnd", F.struct("PeriodStart", "PeriodEnd")).over(island)})
    p = p.withColumnsRenamed({"EmployeeCode": "_employee", "PeriodStart": "_from", "PeriodEnd": "_to", "_s": "PeriodStart", "_e": "PeriodEnd"})
    if payrun_index is not None:
        p = jn.lookup(p, "PeriodEnd", payrun_index, payrun_index.columns[0], payrun_index.columns[1],
                      out="PayCycle", normalise=False)
    return p


# The two header layouts of the payslip extracts, their unified names and staging names.
PAYSLIP_HEADERS = [
    ["DET_NUMBER", "PIT_RUN_START_DATE", "PIT_RUN_END_DATE", "PIT_CODEA", "create_PIT_CODEA_DESC", "PIT_HOURS", "PIT_AMOUNT", "PIT_RUN_NO"],
    ["DET_NUMBERA", "PIT_RUN_START_DATE", "PIT_RUN_END_DATE", "PIT_CODEAA", "create_PIT_CODEA_DESC", "PIT_HOURSN", "PIT_AMOUNTN", "PIT_RUN_NOA"],
]
PAYSLIP_UNIFIED = ["DET_NUMBER", "PIT_RUN_START_DATE", "PIT_RUN_END_DATE", "PIT_CODEA", "PIT_CODEA_DESC", "PIT_HOURS", "PIT_AMOUNT", "PIT_RUN_NO"]
PAYSLIP_STAGING = ["EmployeeCode", "PeriodStart", "PeriodEnd", "PayCode", "Description", "Hours", "Amount", "RunNumber"]


def stage_payslips(batches: list[DataFrame]) -> DataFrame:
    """Payslip staging: P7 unify the headers of every batch, U1 union them, P12 day-first period
    dates, P2 staging names."""
    from effdated.plans.stage import union_batches
    d = union_batches([cl.unify_headers(b, PAYSLIP_HEADERS, PAYSLIP_UNIFIED) for b in batches])
    for c in ("PIT_RUN_START_DATE", "PIT_RUN_END_DATE"):
        d = dt.change_date_format(d, c, dayfirst=True)
    return cl.rename_columns(d, dict(zip(PAYSLIP_UNIFIED, PAYSLIP_STAGING)))


def payslip_batches(staged: DataFrame) -> list[DataFrame]:
    """Staged lines as two raw batches, one of each header layout (driver queries)."""
    day = lambda c: F.date_format(c, "dd/MM/yyyy")
    raw = staged.withColumns({"PeriodStart": day("PeriodStart"), "PeriodEnd": day("PeriodEnd"), "RunNumber": F.lit("1")})
    rest = [c for c in raw.columns if c not in PAYSLIP_STAGING]
    out = []
    for i, layout in enumerate(PAYSLIP_HEADERS):
        own = raw.filter(F.pmod(F.xxhash64("Source"), F.lit(2)) == i)
        names = [(s, h) for s, h in zip(PAYSLIP_STAGING, layout) if not h.startswith("create_")]
        out.append(own.select(*[F.col(s).alias(h) for s, h in names], *[F.col(f"`{c}`") for c in rest]))
    return out


def staged_payslips(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Staged payslip lines derived from order lines (used by the driver queries). A few lines
    share order and line number, so the lineage number has their ordinal behind these. Lines that are
    equal up to the last column used here give equal rows, so the ordinal's order needs no column
    behind it, and the lines are dealt out once, by order, for the ordinal and the join."""
    used = ("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    columns = lineitem.columns[:1 + max(lineitem.columns.index(c) for c in used)]
    every = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*[c for c in columns if c not in ("l_orderkey", "l_linenumber")])
    lineitem = lineitem.repartition("l_orderkey").withColumn("_nth", F.row_number().over(every))
    j = lineitem.join(orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                      lineitem["l_orderkey"] == orders["o_orderkey"])
    return j.select(
        F.col("o_custkey").cast("string").alias("EmployeeCode"),
        F.col("o_orderdate").alias("PeriodStart"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(13))).alias("PeriodEnd"),
        F.concat("l_returnflag", "l_linestatus").alias("PayCode"),
        F.col("l_quantity").cast("string").alias("Hours"),
        F.col("l_extendedprice").alias("Amount"),
        F.when(F.col("l_returnflag") == "N", F.lit("1")).otherwise(F.lit("0")).alias("Is Base Hours?"),
        F.concat(F.lit("Code "), F.col("l_returnflag"), F.col("l_linestatus")).alias("ClientPayCodeDescription"),
        F.col("l_linestatus").alias("PayCategory"),
        F.concat(F.lit("payslips:row:"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000 + F.col("_nth")).cast("string")).alias("Source"))


def employee_cohorts(classification: DataFrame, award_mapping_cols: list[str], cutover: str,
                     before_tag: str, after_tag: str, cohort_keyword: str = " Cohort mapping",
                     additional: DataFrame | None = None) -> DataFrame:
    """EmployeeCohortsOverTime (from masterSMN). Stage 1: F2 keep rows with an award
    mapping; T4 cut periods at the cut-over; R2 melt the ``... Cohort mapping`` columns
    into (EA, Cohort); F6 / F10 keep the EA that applies on each side of the cut-over.
    Stage 2: T12 append additional cohort periods; T6 remove overlaps between cohorts (its
    sweep numbers the overlap islands, W6) and merge adjacent equal ones. Output: EmployeeCode, Cohort, StartDate, EndDate."""
    from effdated.operators import filters as fl
    from effdated.operators import reshape as rs
    from effdated.operators import shifts as sh
    has_award = None
    for c in award_mapping_cols:
        cond = F.col(f"`{c}`").isNotNull()
        has_award = cond if has_award is None else has_award | cond
    d = classification.filter(has_award)
    cut = F.lit(cutover).cast("timestamp_ntz")
    d = iv.cut_at_points(d, "StartDate", "EndDate", [cut])
    d = rs.melt_keyword(d, ["EmployeeCode", "StartDate", "EndDate"], {"Cohort": cohort_keyword}, var_name="EA")
    keep = (((F.col("EndDate") <= cut) & fl.text_contains("EA", before_tag))
            | ((F.col("StartDate") >= cut) & fl.text_contains("EA", after_tag)))
    d = d.filter(keep)
    if additional is not None:
        d = sh.append_intervals(d, additional)
    return iv.remove_overlaps_and_flatten(d, "EmployeeCode", "StartDate", "EndDate", ["Cohort"],
                                          order_by=["EA", "Cohort"])


def cohort_mappings(classification: DataFrame) -> DataFrame:
    """Award / cohort mapping columns derived from the classification (driver queries)."""
    c = F.col("Classification")
    return classification.select(
        "EmployeeCode", "StartDate", "EndDate",
        F.when(c != "5-LOW", F.lit("Award 2014")).alias("Region 2014 EA award mapping"),
        F.when(c != "1-URGENT", F.lit("Award 2017")).alias("Region 2017 EA award mapping"),
        F.when(c.isin("1-URGENT", "2-HIGH"), F.lit("Cohort A")).when(c == "3-MEDIUM", F.lit("Cohort B"))
        .alias("Region 2014 EA Cohort mapping"),
        F.when(c == "3-MEDIUM", F.lit("Cohort B")).when(c.isin("4-NOT SPECIFIED", "5-LOW"), F.lit("Cohort C"))
        .alias("Region 2017 EA Cohort mapping"))


def bronze_master_pos(orders: DataFrame) -> DataFrame:
    """Bronze masterPOS-shaped rows derived from a status table (driver queries)."""
    st = F.col("o_orderstatus")
    return orders.select(
        F.col("o_custkey").cast("string").alias("Staff Member"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Position Start"),
        F.when(st == "F", "Full Time").when(st == "O", "Part Time").otherwise("Casual Staff").alias("Employment Status"),
        F.when(F.col("o_custkey") % 7 == 0, F.lit("31/12/2001")).alias("Termination Date"),
        F.concat(F.lit("masterPOS:row:"), (F.col("o_orderkey") + 2).cast("string")).alias("Source"),
        F.lit("masterPOS.xlsx").alias("source_file"), "o_orderkey")


def bronze_master_emp(customer: DataFrame) -> DataFrame:
    """Bronze masterEMP-shaped rows derived from a customer table (driver queries)."""
    return customer.select(
        F.col("c_custkey").cast("string").alias("Staff Member"),
        F.date_format(F.make_date(F.lit(1995), (F.col("c_nationkey") % 12 + 1).cast("int"), F.lit(1)),
                      "dd/MM/yyyy").alias("Joined"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit("30/06/2002")).alias("Termination Date"),
        F.date_format(F.make_date((1950 + F.col("c_nationkey")).cast("int"), F.lit(3), F.lit(15)),
                      "dd/MM/yyyy").alias("Birth Date"),
        F.concat(F.lit("masterEMP:row:"), (F.col("c_custkey") + 1).cast("string")).alias("Source"),
        F.lit("masterEMP.xlsx").alias("source_file"))


# Default flag columns of the pay-code build and the set-off strategy name.
PAYCODE_FLAGS = ["IsPartOfOrdinaryTimeEarnings", "IsPartOfTotalSalary", "IsSubjectToPayrollTax",
                 "IsBonusOrCommission", "IsPartOfLslBase"]
SETOFF_STRATEGY = "Financial Year Cross Pay Category"


def pay_codes(staged: DataFrame, master_smn: DataFrame, order_by: list[str]) -> DataFrame:
    """PayCodes: F3 keep employees present in masterSMN; J6 keep lines whose pay period
    lies inside a classification period (bucketed containment join); A1 one row per
    client pay-code description with the last non-null PayCode / PayCategory /
    Is Base Hours? (in ``order_by``); P8 default flag columns; P10 1/0 -> True/False."""
    from effdated.operators import aggregate as ag
    from effdated.operators import filters as fl
    from effdated.operators import joins as jn
    smn = master_smn.select("EmployeeCode", "StartDate", "EndDate")
    d = dt.add_n_days(staged, "PeriodEnd", 1)
    d = fl.keep_keys_in(d, smn, "EmployeeCode")
    d = jn.interval_join(d, smn, "EmployeeCode", "PeriodStart", "PeriodEnd", "StartDate", "EndDate", "contained")
    g = ag.grouper(d, ["ClientPayCodeDescription"],
                   {"PayCode": "last", "PayCategory": "last", "Is Base Hours?": "last"}, order_by=order_by)
    g = cl.create_columns(g, {f: {"value": "False", "dtype": "string"} for f in PAYCODE_FLAGS})
    return cl.value_mapper(g, {"1": "True", "0": "False"}, "Is Base Hours?")


def attributes_over_time_build(timesheets: DataFrame, award: str, sep: str = ",") -> DataFrame:
    """EmployeeAttributesOverTime (from timesheets): F2 keep one award; P25 the
    ``Location Attribute`` as an attribute payload per (employee, clock-in, clock-out);
    T15 split multi-valued attributes into one row (and payload) per value."""
    from effdated.operators import shifts as sh
    d = timesheets.filter(F.col("Award") == award)
    d = cl.attributes_over_time(d, ["EmployeeCode", "ClockedIn", "ClockedOut"], ["Location Attribute"])
    d = sh.split_attribute(d, "Value", sep)
    return d.withColumn("Attribute", F.to_json(F.struct(F.col("Key"), F.col("Value"))))


def setoff_strategy(employee_base_df: DataFrame, master_smn: DataFrame,
                    strategy: str = SETOFF_STRATEGY) -> DataFrame:
    """EmployeeSetoffStrategy: F3 employees present in masterSMN; P8 strategy name."""
    from effdated.operators import filters as fl
    d = fl.keep_keys_in(employee_base_df, master_smn.select("EmployeeCode").distinct(), "EmployeeCode")
    d = cl.create_columns(d, {"StrategyName": {"value": strategy, "dtype": "string"}})
    return d.select("EmployeeCode", "StartDate", "EndDate", "StrategyName")


def timesheets_from_events(events: DataFrame) -> DataFrame:
    """Timesheet-shaped rows derived from an event stream (driver queries)."""
    secs = F.round(F.col("value") * 60).cast("int")
    return events.select(
        F.col("user_id").cast("string").alias("EmployeeCode"), F.col("ts").alias("ClockedIn"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)).alias("ClockedOut"),
        F.when(F.col("value") > 100, F.lit("EA 2014")).otherwise(F.lit("EA 2017")).alias("Award"),
        F.concat(F.col("event_type"), F.lit(", k"), F.get_json_object("props", "$.k")).alias("Location Attribute"))


# masterSMN hourly-rate headers and staging names.
RATE_SETTINGS = [
    {"staging": "EmployeeCode", "raw": "Staff Member", "type": "string"},
    {"staging": "StartDate", "raw": "Effective Date", "type": "datetime"},
    {"staging": "EndDate", "raw": "end_date", "type": "datetime"},
    {"staging": "BaseRate", "raw": "Hourly", "type": "numeric"},
    {"staging": "Source", "raw": "Source", "type": "string"},
    {"staging": "source_file", "raw": "source_file", "type": "string"},
]


def rates_over_time(bronze: DataFrame, order_by: list[str] | None = None, master_smn: DataFrame | None = None) -> DataFrame:
    """EmployeeRatesOverTime (masterSMN hourly rate): the master build on ``Hourly``, then F3
    keep employees present in masterSMN."""
    from effdated.operators import filters as fl
    out = effective_dated_master(bronze, "Staff Member", "Effective Date", ["Hourly", "Termination Date"],
                                 RATE_SETTINGS, order_by=order_by)
    return out if master_smn is None else fl.keep_keys_in(out, master_smn, "EmployeeCode")


def bronze_hourly_rates(orders: DataFrame) -> DataFrame:
    """Bronze hourly-rate rows derived from a status table (driver queries)."""
    return orders.select(
        F.col("o_custkey").cast("string").alias("Staff Member"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Effective Date"),
        F.format_string("%.2f", (F.floor(F.col("o_totalprice") / 100000) * 5 + 20).cast("double")).alias("Hourly"),
        F.when(F.col("o_custkey") % 10 != 0, F.lit("31/12/2002")).alias("Termination Date"),
        F.concat(F.lit("rates:row:"), (F.col("o_orderkey") + 2).cast("string")).alias("Source"),
        F.lit("rates.xlsx").alias("source_file"), "o_orderkey")


# Leave-record markers and the personal-leave pay code of the leave build.
LEAVE_MARKERS = ["yes", "Yes", "YES"]
PERSONAL_LEAVE = "Personal leave with evidence"
PAYCODE_COL = "Paycode (under 14/17 EA)"


def leave(timesheets: DataFrame, master_smn: DataFrame, cohort: DataFrame, easter_saturdays: DataFrame,
          fy_start: int, fy_end: int, personal_leave_first_n: int) -> DataFrame:
    """Leave (from timesheets). F1 leave records; F3 + J5 lines whose clock-in or clock-out
    falls in a classification period; W6 + W7 keep the longest of overlapping records;
    P22 financial year of the clock-out; W8 the first ``personal_leave_first_n`` records
    per (employee, FY) become personal leave; P8 LeaveType; P23 leave end = clock-in +
    hours taken; L2 lineage text; T11 Easter Saturdays for cohort members active that day."""
    from effdated.operators import filters as fl
    from effdated.operators import joins as jn
    from effdated.operators import shifts as sh
    d = fl.row_filter(timesheets, [{"col": "Leave Record", "include": {"logic": "and", "value": LEAVE_MARKERS}}])
    smn = master_smn.select("EmployeeCode", "StartDate", "EndDate")
    d = fl.keep_keys_in(d, smn, "EmployeeCode")
    d = jn.interval_join(d, smn, "EmployeeCode", "ClockedIn", "ClockedOut", "StartDate", "EndDate", "either_end")
    d = d.withColumn("_rid", F.concat_ws("|", "Source", F.col("StartDate").cast("string")))
    d = iv.pick_longest(d, "EmployeeCode", "ClockedIn", "ClockedOut", "_rid").filter("is_longest").drop("is_longest")
    d = dt.matching_financial_year(d, "ClockedOut", fy_start, fy_end, out="financial year")
    d = sh.rank_and_convert(d, ["EmployeeCode", "financial year"], ["ClockedIn", "_rid"], PAYCODE_COL,
                            PERSONAL_LEAVE, personal_leave_first_n)
    d = cl.create_columns(d, {"LeaveType": {"column": PAYCODE_COL, "dtype": "string"}})
    d = cl.leave_end_from_hours(d, "ClockedIn", "ClockedOut", "Net Length")
    d = ln.list_source_to_dict(d.withColumn("Source", F.array("Source")), "Source").drop("_rid")
    added = sh.add_synthetic_days(cohort, "EmployeeCode", "StartDate", "EndDate", easter_saturdays,
                                  lineage="Manually Added Easter Saturday")
    added = added.select("EmployeeCode", F.col("day").cast("timestamp_ntz").alias("ClockedIn"), "Source")
    return sh.append_intervals(d, added)


def timesheet_leave_rows(events: DataFrame) -> DataFrame:
    """Timesheet rows with leave markers derived from an event stream (driver queries);
    one projection of the events, no self-join."""
    secs = F.round(F.col("value") * 60).cast("int")
    return events.select(
        F.col("user_id").cast("string").alias("EmployeeCode"), F.col("ts").alias("ClockedIn"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)).alias("ClockedOut"),
        F.when(F.col("event_type").isin("view", "signup"), F.lit("Yes")).otherwise(F.lit("no")).alias("Leave Record"),
        F.lit("Annual leave").alias(PAYCODE_COL),
        (F.col("value") / 60).cast("string").alias("Net Length"),
        (F.col("value") / 100).alias("Breaks Length"),
        F.concat(F.lit("timesheets:row:"), (F.col("event_id") + 2).cast("string")).alias("Source"))


def timesheets(ts: DataFrame, master_smn: DataFrame, holidays: DataFrame, shift_gap_hours: float = 4.0) -> DataFrame:
    """Timesheet build. F1 drop leave records; F3 + J5 shifts whose clock-in or clock-out
    falls in a classification period; W7 keep the longest of overlapping shifts; P24
    unpaid break placed mid-shift (``Breaks Length`` hours); T9 chain shifts with gaps
    under ``shift_gap_hours``; A1 one row per (employee, shift chain); P21 week parts;
    W10 at most one broken shift flagged per employee-week; T10 public holidays of the
    shift's region (weekend holidays add a Monday); W9 share of the last six months' days that
    the employee worked, on holiday shifts; P8 empty columns; L2 lineage text."""
    from effdated.operators import aggregate as ag
    from effdated.operators import filters as fl
    from effdated.operators import joins as jn
    from effdated.operators import shifts as sh
    d = fl.row_filter(ts, [{"col": "Leave Record", "exclude": {"logic": "and", "value": LEAVE_MARKERS}}])
    d = cl.create_columns(d, {"Training": {"value": "None", "dtype": "string"}})
    smn = master_smn.select("EmployeeCode", "StartDate", "EndDate", "Classification")
    d = fl.keep_keys_in(d, smn, "EmployeeCode")
    d = jn.interval_join(d, smn, "EmployeeCode", "ClockedIn", "ClockedOut", "StartDate", "EndDate", "either_end")
    d = d.withColumn("_rid", F.concat_ws("|", "Source", F.col("StartDate").cast("string")))
    d = iv.pick_longest(d, "EmployeeCode", "ClockedIn", "ClockedOut", "_rid").filter("is_longest").drop("is_longest")
    d = cl.unpaid_break(d, "_brk", "ClockedIn", "ClockedOut", "Breaks Length", "hours")
    d = d.withColumn("break_seconds", F.timestamp_diff("SECOND", F.col("_brk.start"), F.col("_brk.end"))).drop("_brk")
    d = sh.broken_shifts(d, "EmployeeCode", "ClockedIn", "ClockedOut", shift_gap_hours, order_by=["_rid"])
    g = ag.grouper(d, ["EmployeeCode", "shift_index"], {
        "ClockedIn": "min", "ClockedOut": "max", "Classification": "first", "Region": "first",
        "Source": "unique", "unpaid_break_seconds": "sum", "break_seconds": "sum", "_rid": "count"},
        order_by=["ClockedIn", "ClockedOut", "_rid"])
    g = (g.withColumnRenamed("_rid", "pieces").withColumn("is_Broken_Shift", F.col("pieces") > 1)
         .withColumn("_sid", F.concat_ws("|", "EmployeeCode", F.col("shift_index").cast("string"))))
    g = dt.week_parts(g, "ClockedIn")
    g = sh.one_flag_per_week(g, "EmployeeCode", "ClockedIn", "is_Broken_Shift", "_sid").drop("_sid")
    g = sh.add_public_holidays(g, "ClockedIn", "Region", sh.holiday_calendar(holidays))
    g = sh.with_trailing_day_share(g, "EmployeeCode", "ClockedIn", out="_share")
    g = g.withColumn("worked_percentage_in_last_6_month", F.when(F.col("holiday_date").isNotNull(), F.col("_share"))).drop("_share")
    return ln.list_source_to_dict(g, "Source")


def timesheet_exceptions(ts: DataFrame, regions: list[str], max_hours: float = 24.0) -> DataFrame:
    """The declared timesheet checks as one violations table: Q8 overlapping shifts of an
    employee, Q11 shift length, Q12 end before start, Q10 region in scope."""
    from effdated.plans.load import run_exception_tests
    config = {"timesheets": {"keys": ["Source"], "validation_tests": {
        "non_overlapping": {"key": "EmployeeCode", "start": "ClockedIn", "end": "ClockedOut"},
        "shift_length": {"start": "ClockedIn", "end": "ClockedOut", "max_hours": max_hours},
        "end_before_start": {"start": "ClockedIn", "end": "ClockedOut"}},
        "inscope_mappings": {"region": {"client_columns": ["Region"]}}}}
    return run_exception_tests({"timesheets": ts}, config, {"region": regions})


def timesheet_rows(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Timesheet rows (with leave markers, break length and region) derived from an
    event stream (driver queries)."""
    geo = (customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
           .select(F.col("c_custkey").cast("string").alias("EmployeeCode"), F.col("n_name").alias("Region")))
    return timesheet_leave_rows(events).join(geo, "EmployeeCode", "left")
