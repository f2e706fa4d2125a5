"""The remediation (under/over-payment) report, Spark-first.

Inputs are in the staging shapes the report reads:

* ``lines``: one row per (pay period, pay line): ``employee_code, client_id, end,
  pay_code, actual, calculated, variance, actual_hours, calculated_hours``. The
  period-to-payslip-to-line fan-out is already applied, and repeated lines count
  again, as in the source model.
* ``pil`` / ``km``: additional payments ``employee_code, date, [pay_code,] variance,
  actual, calculated``.
* ``employees``: ``employee_code, client_id`` and three JSON columns:
  ``attributes_over_time`` (array of {StartDate, EndDate, Value:{Key, Value}}),
  ``classifications`` (Value:{Classification, Award}) and ``employment_types``
  (scalar Value).
* ``fy_rules`` (fy, start_of_fy, end_of_fy), ``fy_rates`` (fy, rm_interests, sm_date),
  ``region_rates`` (region, fy, tax_rate, penalty_rate, interest_rate), and scalars
  ``super_rate``, ``scg_rate``.

Plan shape: the line-level data is read once. One aggregation per (employee, FY,
pay code) (partial aggregation map-side) feeds one aggregation per (employee, FY)
that computes the filtered summary sums and the pay-code crosstab together, as
conditional sums. Everything after that works on one row per (employee, FY). The
rule and rate tables have a fixed size (FYs x regions) and are broadcast. Each
attribute resolution is one broadcast range join against the FY rules plus a
``min_by`` pick, instead of three unions and a window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from effdated.functions.columns import report_projection
from effdated.functions.dates import financial_year
from effdated.operators import aggregate as ag
from effdated.operators.intervals import resolve_by_period

MEASURES = ["actual_hours", "calculated_hours", "calculated", "gross_Variance", "payslip"]

# Amounts are aggregated as exact longs of 10^-scale units: sums of DECIMAL(12,2) widen past
# 18 digits and leave Spark's compact-long decimal path (BigDecimal buffers), while long
# sums stay in generated code. The scale is that of the widest amount column, so nothing is
# cut off; amounts must be integers or decimals of at most MAX_SCALE places.
MIN_SCALE, MAX_SCALE = 2, 8
AMOUNTS = ("variance", "actual", "calculated", "actual_hours", "calculated_hours")


def unit_scale(*frames: DataFrame) -> int:
    """Decimal places that hold every amount column of the frames exactly."""
    scale = MIN_SCALE
    for frame in frames:
        for f in frame.schema.fields:
            if f.name not in AMOUNTS:
                continue
            if isinstance(f.dataType, T.DecimalType) and f.dataType.scale <= MAX_SCALE:
                scale = max(scale, f.dataType.scale)
            elif not isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
                raise ValueError(f"amount column {f.name!r} is {f.dataType.simpleString()}; "
                                 f"cast it to a decimal of at most {MAX_SCALE} places")
    return scale


def units(c: Column | str, scale: int) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return (col * F.lit(10 ** scale)).cast("long")  # exact: the column has at most ``scale`` places


def from_units(c: Column | str, scale: int) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col / F.lit(float(10 ** scale))


@dataclass
class ReportParams:
    ote_bucket: Sequence[str]                  # pay codes that count as ordinary-time earnings
    pay_codes: Sequence[str]                   # crosstab categories
    pil_ote_codes: Sequence[str] = ("TC", "TLSC")
    dropped_fy: str | None = None              # FY left out of the summary (open year)
    region_widen_days: int = 720
    widen_days: int = 720
    national_region: tuple[str, str] = ("National", "ACT")
    employee_type_codes: dict = field(default_factory=lambda: {"4": "Full Time", "3": "Casual", "2": "Part Time"})
    employee_status: str = "Day Worker"
    company_fallback: str | None = None
    super_rate: float = 0.1
    scg_rate: float = 0.1
    client_id: str | None = None               # only this client's rows enter the report
    scale: int = 4                             # set from the inputs' schemas, see unit_scale


def _z(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def line_facts(lines: DataFrame, p: ReportParams) -> DataFrame:
    """The single pass over line-level data: sums per (employee, FY, pay code), including
    the positive / negative parts. Both the FY summary and the pay-code crosstab derive
    from this much smaller table, so the line data is scanned and shuffled once (the
    plan reuses this aggregation's exchange)."""
    v = units("variance", p.scale)
    # hours are optional inputs: absent columns give null sums in the crosstab
    lines = lines.withColumns({c: F.lit(None).cast("decimal(12,2)") for c in ("actual_hours", "calculated_hours")
                               if c not in lines.columns})
    return (lines.withColumn("fyear", financial_year("end").cast("string"))
            .groupBy("employee_code", "fyear", "pay_code").agg(
                F.sum(v).alias("v"), F.sum(F.greatest(v, F.lit(0))).alias("v_pos"),
                F.sum(F.least(v, F.lit(0))).alias("v_neg"),
                F.sum(units("actual", p.scale)).alias("actual"), F.sum(units("calculated", p.scale)).alias("calculated"),
                F.sum(units("actual_hours", p.scale)).alias("actual_hours"),
                F.sum(units("calculated_hours", p.scale)).alias("calculated_hours")))


def _line_summary(facts: DataFrame, p: ReportParams) -> DataFrame:
    in_b = F.col("pay_code").isin(list(p.ote_bucket))
    not_b = ~F.col("pay_code").isin(list(p.ote_bucket))
    return facts.groupBy("employee_code", "fyear").agg(
        _z(F.sum(F.when(in_b, F.col("v_pos")))).alias("wage_pos"),
        _z(F.sum(F.when(in_b, F.col("v_neg")))).alias("wage_neg"),
        _z(F.sum(F.when(in_b, F.col("v")))).alias("wage_net"),
        _z(F.sum(F.when(not_b, F.col("v_pos")))).alias("other_pos"),
        _z(F.sum(F.when(not_b, F.col("v_neg")))).alias("other_neg"),
        _z(F.sum(F.when(not_b, F.col("v")))).alias("other_net"),
        _z(F.sum(F.when(in_b, F.col("actual")))).alias("wage_paid"),
        _z(F.sum(F.when(in_b, F.col("calculated")))).alias("wage_due"),
        *_detail_aggs(p))


_MEASURE_COL = {"actual_hours": "actual_hours", "calculated_hours": "calculated_hours",
                "calculated": "calculated", "gross_Variance": "v", "payslip": "actual"}


def _detail_names(p: ReportParams) -> list[str]:
    return [f"{c}_{m}" for c in p.pay_codes for m in MEASURES]


def _detail_aggs(p: ReportParams) -> list[Column]:
    """The pay-code crosstab as conditional sums in the same aggregation as the summary
    (this is what ``pivot`` compiles to), so the line facts are read once."""
    return [F.sum(F.when(F.col("pay_code") == F.lit(c), F.col(_MEASURE_COL[m]))).alias(f"{c}_{m}")
            for c in p.pay_codes for m in MEASURES]


def _pil_summary(pil: DataFrame, p: ReportParams) -> DataFrame:
    tc = F.col("pay_code").isin(list(p.pil_ote_codes))
    v = units("variance", p.scale)
    return (pil.withColumn("fyear", financial_year("date").cast("string"))
            .groupBy("employee_code", "fyear").agg(
                F.sum(v).alias("pil_net"),
                ag.positive_part_sum(v).alias("pil_pos"),
                ag.negative_part_sum(v).alias("pil_neg"),
                _z(F.sum(F.when(tc, v))).alias("pil_ote_net"),
                _z(ag.positive_part_sum(v, tc)).alias("pil_ote_pos"),
                _z(ag.negative_part_sum(v, tc)).alias("pil_ote_neg"),
                F.sum(units("actual", p.scale)).alias("pil_paid"),
                F.sum(units("calculated", p.scale)).alias("pil_due")))


def _km_summary(km: DataFrame, p: ReportParams) -> DataFrame:
    v = units("variance", p.scale)
    return (km.withColumn("fyear", financial_year("date").cast("string"))
            .groupBy("employee_code", "fyear").agg(
                F.sum(v).alias("km_net"),
                ag.positive_part_sum(v).alias("km_pos"),
                ag.negative_part_sum(v).alias("km_neg"),
                F.sum(units("actual", p.scale)).alias("km_paid"),
                F.sum(units("calculated", p.scale)).alias("km_due")))


def group_by_fyear(lines: DataFrame, pil: DataFrame, km: DataFrame, p: ReportParams,
                   facts: DataFrame | None = None) -> DataFrame:
    """``base_group_fyear``: line, PIL and KM summaries, full outer joined per (employee, FY),
    with the variance formulas."""
    j = (_line_summary(facts if facts is not None else line_facts(lines, p), p)
         .join(_pil_summary(pil, p), ["employee_code", "fyear"], "full")
         .join(_km_summary(km, p), ["employee_code", "fyear"], "full"))
    if p.dropped_fy is not None:
        j = j.filter(F.col("fyear") != p.dropped_fy)
    c = {n: _z(F.col(n)) for n in [
        "wage_pos", "wage_neg", "wage_net", "other_pos", "other_neg",
        "other_net", "wage_paid", "wage_due", "pil_ote_net", "pil_ote_pos",
        "pil_ote_neg", "pil_net", "pil_pos", "pil_neg",
        "pil_paid", "pil_due", "km_net", "km_pos",
        "km_neg", "km_paid", "km_due"]}
    gross_ote = c["wage_net"] + c["pil_ote_net"]
    gross_non_ote = c["other_net"] + c["km_net"] + c["pil_net"]
    gross = c["wage_net"] + c["pil_ote_net"] + c["other_net"] + c["km_net"] + c["pil_net"]
    sign = F.least(gross, gross_ote)
    return j.select(
        "employee_code", F.col("fyear").alias("fy"),
        (c["wage_pos"] + c["pil_ote_pos"]).alias("ote_excess"),
        (c["wage_neg"] + c["pil_ote_neg"]).alias("ote_shortfall"),
        gross_ote.alias("gross_ote_variance"),
        (c["other_pos"] + c["km_pos"] + c["pil_pos"]).alias("non_ote_excess"),
        (c["other_neg"] + c["km_neg"] + c["pil_neg"]).alias("non_ote_shortfall"),
        gross_non_ote.alias("gross_non_ote_variance"),
        F.least(gross_ote, F.lit(0)).alias("ote_variance"),
        F.least(gross_non_ote, F.lit(0)).alias("non_ote_variance"),
        gross.alias("gross_variance"),
        F.least(gross, F.lit(0)).alias("variance"),
        F.least(F.least(gross, F.lit(0)), F.least(gross_ote, F.lit(0))).alias("remediation_payment"),
        F.when(sign > 0, "EXCESS").when(sign < 0, "SHORTFALL").otherwise("No Variance").alias("status"),
        c["wage_pos"].alias("ote_wage_excess"), c["pil_ote_pos"].alias("ote_pil_excess"),
        c["wage_neg"].alias("ote_wage_shortfall"), c["pil_ote_neg"].alias("ote_pil_shortfall"),
        c["wage_net"].alias("ote_wage"), c["pil_ote_net"].alias("ote_pil"),
        c["other_pos"].alias("non_ote_wage_excess"), c["km_pos"].alias("non_ote_km_excess"),
        c["pil_pos"].alias("non_ote_pil_excess"),
        c["other_neg"].alias("non_ote_wage_shortfall"),
        c["km_neg"].alias("non_ote_km_shortfall"),
        c["pil_neg"].alias("non_ote_pil_shortfall"),
        c["other_net"].alias("non_ote_wage"), c["km_net"].alias("non_ote_km"),
        c["pil_net"].alias("non_ote_pil"),
        c["wage_paid"].alias("ote_actual"), c["wage_due"].alias("ote_calculated"),
        c["km_paid"].alias("km_actual"), c["km_due"].alias("km_calculated"),
        c["pil_paid"].alias("pil_actual"), c["pil_due"].alias("pil_calculated"),
        *[F.col(f"`{n}`") for n in _detail_names(p)])


_ITEM = "StartDate:string,EndDate:string,Value:string"
_VALUES = {"attribute": "Key:string,Value:string", "classification": "Classification:string,Award:string", "employment": None}


def _items(employees: DataFrame) -> DataFrame:
    """All attribute items of an employee, tagged by the column they come from: the three JSON
    arrays become one array, exploded once, so the employee rows are read once. The JSON in an
    item's value is parsed here, in the array: behind the explode Spark would copy the parser
    into every expression that uses a part of it."""
    def tagged(column: str, kind: str) -> Column:
        def item(x: Column) -> Column:
            parts = [(F.from_json(x["Value"], f"struct<{fields}>") if k == kind else F.lit(None).cast(f"struct<{fields}>")).alias(f"_{k}")
                     for k, fields in _VALUES.items() if fields]
            return F.struct(F.lit(kind).alias("_kind"), x["StartDate"].alias("_from"), x["EndDate"].alias("_to"), x["Value"].alias("_value"), *parts)
        return F.transform(F.coalesce(F.from_json(F.col(column), f"array<struct<{_ITEM}>>"), F.array().cast(f"array<struct<{_ITEM}>>")), item)

    every = F.concat(tagged("attributes_over_time", "attribute"), tagged("classifications", "classification"), tagged("employment_types", "employment"))
    ex = employees.select("employee_code", F.explode(every).alias("i")).select("employee_code", "i.*")
    return ex.withColumns({"_from": F.col("_from").cast("date"), "_to": F.col("_to").cast("date")})


def base_info(employees: DataFrame, fy_rules: DataFrame, p: ReportParams) -> DataFrame:
    """Attributes per (employee, FY): region, contract hours, position, classification,
    award, employee type and company (company: the latest FY's value per employee).

    All attribute kinds are resolved in one pass. Their items are unioned with a
    ``ref`` tag (each kind widened by its own rule), so there is one broadcast range
    join against the FY rules and one ``min_by`` aggregation keyed by
    (employee, ref, FY), then one pivot back to a row per (employee, FY). The rows
    are those with a classification, as in the source model.
    """
    is_a, is_c, is_e = (F.col("_kind") == k for k in ("attribute", "classification", "employment"))
    key, value = F.col("_attribute.Key"), F.col("_attribute.Value")
    nat_from, nat_to = p.national_region
    refs_of = {"state": "region", "WeeklyContractedHours": "weeklycontractedhours", "POSITION": "positions", "COMPANY": "company"}
    ref = F.when(is_c, "classification").when(is_e, "employee_type")
    for k, r in refs_of.items():
        ref = ref.when(is_a & (key == k), r)
    code, employee_type = F.regexp_replace("_value", '"', ""), F.lit(None).cast("string")
    for k, v in p.employee_type_codes.items():
        employee_type = F.when(code == k, v).otherwise(employee_type)
    is_state = is_a & (key == "state")
    v1 = (F.when(is_c, F.col("_classification.Classification")).when(is_e, employee_type)
          .when(is_state & (value == nat_from), F.lit(nat_to)).otherwise(value))
    items = (_items(employees)
             .select("employee_code", ref.alias("ref"), "_from", "_to", F.when(is_state, p.region_widen_days).otherwise(0).alias("_before"),
                     v1.alias("v1"), F.col("_classification.Award").alias("v2"))
             .filter(F.col("ref").isNotNull())
             .withColumn("effective_from", F.date_sub("_from", F.col("_before")))
             .withColumn("effective_to", F.date_add("_to", p.widen_days)))
    resolved = resolve_by_period(items, ["employee_code", "ref"], "effective_from", "effective_to",
                                 ["v1", "v2"], fy_rules)
    refs = ["region", "weeklycontractedhours", "positions", "company", "classification", "employee_type"]
    wide = (resolved.groupBy("employee_code", "fy").pivot("ref", refs)
            .agg(F.first(F.struct("v1", "v2"))))
    # the latest year's company, from the rows at hand: the attributes are resolved once
    own = Window.partitionBy("employee_code")
    wide = wide.withColumn("_latest", F.max_by(F.col("company.v1"), F.when(F.col("company").isNotNull(), F.col("fy"))).over(own))
    info = wide.filter(F.col("classification").isNotNull()).select(
        "employee_code", "fy", F.col("_latest").alias("company"),
        F.col("region.v1").alias("region"), F.col("weeklycontractedhours.v1").alias("weeklycontractedhours"),
        F.col("positions.v1").alias("positions"), F.col("classification.v1").alias("classification"),
        F.col("classification.v2").alias("award"), F.col("employee_type.v1").alias("employee_type"))
    clients = employees.select("employee_code", "client_id")
    info = info.join(clients, ["employee_code"], "left")
    if p.company_fallback is not None:
        info = info.withColumn("company", F.coalesce(F.col("company"), F.lit(p.company_fallback)))
    return info


def pay_code_detail(lines: DataFrame, p: ReportParams, facts: DataFrame | None = None) -> DataFrame:
    """Crosstab (employee, FY) x pay code of five sums, expanded to ``<code>_<measure>``
    columns (the JSON-cell crosstab of the source, as one pivot aggregation over the
    per-pay-code facts)."""
    f = (facts if facts is not None else line_facts(lines, p)).withColumnRenamed("fyear", "fy")
    measures = {"actual_hours": F.sum("actual_hours"), "calculated_hours": F.sum("calculated_hours"),
                "calculated": F.sum("calculated"), "gross_Variance": F.sum("v"),
                "payslip": F.sum("actual")}
    ct = ag.crosstab(f, ["employee_code", "fy"], "pay_code", p.pay_codes, measures)
    return ag.expand_cells(ct, ["employee_code", "fy"], p.pay_codes, MEASURES)


def for_client(frames: Sequence[DataFrame], client_id: str | None) -> list[DataFrame]:
    """F8: only one client's rows of each input; a frame without ``client_id`` raises."""
    if client_id is None:
        return list(frames)
    missing = [f.columns for f in frames if "client_id" not in f.columns]
    if missing:
        raise ValueError(f"no client_id column among {missing[0]}")
    return [f.filter(F.col("client_id") == client_id) for f in frames]


def remediation_report(lines: DataFrame, pil: DataFrame, km: DataFrame, employees: DataFrame,
                       fy_rules: DataFrame, fy_rates: DataFrame, region_rates: DataFrame,
                       p: ReportParams) -> DataFrame:
    """The report: one row per (employee, FY) with client and region."""
    lines, pil, km = for_client([lines, pil, km], p.client_id)
    p = replace(p, scale=unit_scale(lines, pil, km))
    summary = group_by_fyear(lines, pil, km, p)
    info = base_info(employees, fy_rules, p)
    final = (summary.join(info, ["employee_code", "fy"], "left")
             .join(F.broadcast(fy_rates), ["fy"], "left")
             .join(F.broadcast(region_rates), ["region", "fy"], "left")
             .withColumn("sr", F.lit(p.super_rate)).withColumn("scg", F.lit(p.scg_rate)))
    d = {n: F.col(n).cast("double") for n in [
        "rm_interests", "sr", "scg", "sm_date", "tax_rate", "penalty_rate", "interest_rate"]}
    d["remediation_payment"] = from_units("remediation_payment", p.scale)
    d["ote_variance"] = from_units("ote_variance", p.scale)
    rp, ov = d["remediation_payment"], d["ote_variance"]
    tax_base = rp + ov * d["sr"] + ov * d["sr"] * d["scg"] * d["sm_date"] / 365
    tail = ["ote_wage_shortfall", "ote_pil_shortfall", "ote_wage", "ote_pil", "non_ote_wage_excess",
            "non_ote_km_excess", "non_ote_pil_excess", "non_ote_wage_shortfall", "non_ote_km_shortfall",
            "non_ote_pil_shortfall", "non_ote_wage", "non_ote_km", "non_ote_pil", "ote_actual",
            "ote_calculated", "km_actual", "km_calculated", "pil_actual", "pil_calculated"]
    dbl = lambda c: from_units(c, p.scale)
    cols: list = [
        ("employee_code", "Employee Code"), ("client_id", "Client ID"), ("fy", "Financial Year"),
        ("region", "State"), ("company", "Entity"), ("award", "Award"),
        (rp, "Remediation Payments"), (rp * d["rm_interests"], "Interest on Remediation Payments"),
        (ov, "OTE Variance"), (ov * d["sr"], "Superannuation"),
        (ov * d["sr"] * d["scg"] * d["sm_date"] / 365, "Voluntary Interest on Super"),
        (tax_base * d["tax_rate"], "Payroll Tax"),
        (tax_base * d["tax_rate"] * d["penalty_rate"], "Penalty on Payroll Tax"),
        (tax_base * d["tax_rate"] * d["penalty_rate"] * d["interest_rate"], "Interest on Payroll Tax"),
        ("status", "Status"), (d["rm_interests"], "Interest Rate on Remediation Payments"),
        (F.col("sm_date").cast("bigint"), "Settlement Date"), (d["sr"], "Superannuation Rate"),
        (d["scg"], "SCG Rate"), (d["tax_rate"], "Payroll Tax Rate"),
        (d["penalty_rate"], "Payroll Tax Penalty Rate"), (d["interest_rate"], " Payroll Tax Interest Rate"),
        ("positions", "Position Title"), ("classification", "Classification in the Award"),
        ("employee_type", "Employee Type"), (F.lit(p.employee_status), "Employee Status"),
        ("weeklycontractedhours", "Contract Hours"),
        (dbl("ote_excess"), "OTE Excess"), (dbl("ote_shortfall"), "OTE Shortfall"),
        (dbl("gross_ote_variance"), "Gross OTE Variance"), (dbl("ote_variance"), "OTE Variance"),
        (dbl("non_ote_excess"), "Non OTE Excess"), (dbl("non_ote_shortfall"), "Non OTE Shortfall"),
        (dbl("gross_non_ote_variance"), "Gross Non OTE Variance"),
        (dbl("non_ote_variance"), "Non OTE Variance"), (dbl("gross_variance"), "Gross Variance"),
        (dbl("variance"), "Variance"),
        *[(dbl(n), n) for n in tail],
        *[(dbl(F.col(f"`{n}`")), n) for n in _detail_names(p)],
    ]
    report = report_projection(final, cols)
    return report.filter(F.col("`Client ID`").isNotNull() & F.col("State").isNotNull())
