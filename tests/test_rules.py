"""Lineage text, quality tests with planted violations, report sign rules, stage runner."""

import datetime as dtm

from pyspark.sql import functions as F

from effdated.operators import lineage, quality as dq
from effdated.plans.report import ReportParams, group_by_fyear
from effdated.plans.stage import run_stage


def test_lineage_list_and_collapse(spark):
    df = spark.createDataFrame([(["f:row:1", "f:row:2", "g:row:1", "f:row:1"],)], "Source array<string>")
    assert lineage.list_source_to_dict(df).collect()[0].Source == "{'f:row:': ['1', '2'], 'g:row:': ['1']}"
    flat = spark.createDataFrame([("k", s, i) for i, s in enumerate(["f:row:1", "f:row:2", "g:row:1", "f:row:1"])],
                                 "k string, Source string, o int")
    out = lineage.collapse_sources(flat, ["k"], "Source", ["o"]).collect()[0].Source
    assert out == "{'f:row:': ['1', '2'], 'g:row:': ['1']}"


def test_quality_planted_violations(spark):
    df = spark.createDataFrame([
        ("E1", "12", "2020-01-31", "abc", dtm.datetime(2020, 1, 1, 9), dtm.datetime(2020, 1, 1, 17)),
        ("E2", "x1", "31/02/2020", "café", dtm.datetime(2020, 1, 2, 9), dtm.datetime(2020, 1, 2, 8)),
        ("E2", "-3", None, "ok", dtm.datetime(2020, 1, 2, 7), dtm.datetime(2020, 1, 2, 23)),
    ], "emp string, num string, dt string, txt string, s timestamp_ntz, e timestamp_ntz")
    assert [r.emp for r in dq.non_numeric(df, ["num"], ["emp"]).collect()] == ["E2"]
    assert [r.value for r in dq.non_positive(df, ["num"], ["emp"]).collect()] == ["-3"]
    assert [r.value for r in dq.non_datetime(df, ["dt"], ["emp"]).collect()] == ["31/02/2020"]
    assert [r.value for r in dq.non_ascii(df, ["txt"], ["emp"]).collect()] == ["café"]
    assert [r.emp for r in dq.non_nan(df, ["dt"], ["emp"]).collect()] == ["E2"]
    assert dq.end_before_start(df, "s", "e").count() == 1
    assert dq.shift_length(df, "s", "e", max_hours=14).count() == 1
    assert dq.duplicated(df, ["emp"]).count() == 2
    assert dq.overlapping(df.filter(F.col("e") > F.col("s")), "emp", "s", "e").count() == 0
    summary = dq.summarize(dq.duplicated(df, ["emp"]), "duplicate", 1).collect()[0]
    assert (summary.n_violations, summary.passed) == (2, False)


def test_report_status_signs(spark):
    lines = spark.createDataFrame([
        ("a", dtm.datetime(2020, 1, 1), "BasePay", -5.0, 0.0, 0.0),
        ("a", dtm.datetime(2020, 1, 2), "Other", 20.0, 0.0, 0.0),
        ("b", dtm.datetime(2020, 1, 1), "BasePay", 3.0, 0.0, 0.0),
        ("c", dtm.datetime(2020, 1, 1), "BasePay", 0.0, 0.0, 0.0),
    ], "employee_code string, end timestamp_ntz, pay_code string, variance double, actual double, calculated double")
    empty_pil = spark.createDataFrame([], "employee_code string, date timestamp_ntz, pay_code string, variance double, "
                                          "actual double, calculated double")
    empty_km = empty_pil.drop("pay_code")
    p = ReportParams(ote_bucket=["BasePay"], pay_codes=["BasePay", "Other"])
    got = {r.employee_code: r.status for r in group_by_fyear(lines, empty_pil, empty_km, p).collect()}
    assert got == {"a": "SHORTFALL", "b": "EXCESS", "c": "No Variance"}


def test_stage_runner_switch_and_targets(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    out = run_stage({"src": df}, [
        {"function": "dataset_filter", "args": {"expression": "v > 1"}, "targets": ["big"]},
        {"function": "dataset_filter", "args": {"expression": "v > 100"}, "switch": False},
        {"function": "rename_columns", "sources": ["big"], "args": {"name_map": {"k": "key"}}},
    ])
    assert [r.key for r in out["big"].collect()] == ["b"]
    assert out["src"].count() == 2


def test_varying_header_dob_sources_schema_types(spark, tmpdir_path):
    import os
    from effdated.functions import types as ty
    from effdated.sources.csv import find_varying_header, read_csv_with_lineage
    p = os.path.join(tmpdir_path, "vh", "report.csv")
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as f:
        f.write("Payroll export,,\nPrinted 2021,,\nStaff Member,Joined,Birth\nE1,01/02/2020,01/01/1990\nE2,05/03/2020,01/01/2015\n")
    raw = read_csv_with_lineage(spark, os.path.dirname(p), names=["c1", "c2", "c3"], header=-1)
    body = find_varying_header(raw, ["Staff Member", "Joined"])
    assert sorted(r.c1 for r in body.collect()) == ["E1", "E2"]
    dob = body.withColumn("dob", F.to_date("c3", "dd/MM/yyyy"))
    assert [r.c1 for r in dq.implausible_dob(dob, "dob", ["c1"], "2021-06-30").collect()] == ["E2"]
    files = lineage.source_files(body.select("Source"))
    assert [r.source_file for r in files.collect()] == ["report"]
    changes = dq.schema_changes(body, body.drop("c3").withColumn("c2", F.lit(1)))
    assert {c["column"]: c["change"] for c in changes} == {"c3": "removed", "c2": "dtype"}
    assert ty.align_datatype({"a": "int64", "b": "datetime64[ns]", "c": "object"}) == \
        {"a": "INT", "b": "timestamp", "c": "text"}
    assert ty.align_datatype(spark.createDataFrame([(1, "x")], "a long, b string")) == {"a": "int", "b": "text"}


def test_interval_join_matches_brute_force_with_sentinels(spark):
    import datetime as dtm
    from effdated.operators.joins import interval_join
    big = dtm.datetime(2262, 4, 11)
    facts = spark.createDataFrame([
        (1, "a", dtm.datetime(2020, 1, 5), dtm.datetime(2020, 1, 20)),
        (2, "a", dtm.datetime(2020, 3, 1), big),                       # open-ended fact
        (3, "a", dtm.datetime(2019, 12, 30), dtm.datetime(2020, 2, 2)),
        (4, "b", dtm.datetime(2020, 6, 1), dtm.datetime(2020, 6, 2)),
        (5, "a", dtm.datetime(2021, 1, 1), dtm.datetime(2021, 1, 1))],
        "fid int, k string, fs timestamp_ntz, fe timestamp_ntz")
    periods = spark.createDataFrame([
        (10, "a", dtm.datetime(2019, 1, 1), dtm.datetime(2020, 1, 10)),
        (11, "a", dtm.datetime(2020, 1, 10), big),                      # open-ended period
        (12, "a", dtm.datetime(2030, 1, 1), big),                       # starts after every fact
        (13, "b", dtm.datetime(2020, 1, 1), dtm.datetime(2020, 12, 31))],
        "pid int, k string, ps timestamp_ntz, pe timestamp_ntz")
    for mode in ("either_end", "contained"):
        got = sorted((r.fid, r.pid) for r in
                     interval_join(facts, periods, "k", "fs", "fe", "ps", "pe", mode).collect())
        f, p = facts.alias("f"), periods.alias("p")
        if mode == "either_end":
            cond = ((F.col("f.fs").between(F.col("p.ps"), F.col("p.pe")))
                    | (F.col("f.fe").between(F.col("p.ps"), F.col("p.pe"))))
        else:
            cond = (F.col("f.fs") >= F.col("p.ps")) & (F.col("f.fe") <= F.col("p.pe"))
        want = sorted((r.fid, r.pid) for r in
                      f.join(p, (F.col("f.k") == F.col("p.k")) & cond).select("f.fid", "p.pid").collect())
        assert got == want, mode


def test_report_shows_additional_payments(spark):
    """The PIL branch reaches the report: in both the ordinary-time and the PIL figures."""
    from pyspark.sql import functions as F

    from effdated.plans.q_report import build_report
    r = build_report(spark, "/root/testdata/sf0.001").agg(*[F.sum(c).alias(c) for c in ("pil_actual", "ote_pil", "non_ote_pil")]).first()
    assert r.pil_actual > 0 and r.ote_pil != 0 and r.non_ote_pil != 0


def test_report_rejects_amounts_it_would_cut(spark):
    import pytest

    from effdated.plans.report import unit_scale
    frame = lambda kind: spark.createDataFrame([], f"variance {kind}, actual decimal(12,2)")
    assert unit_scale(frame("decimal(12,5)")) == 5 and unit_scale(frame("int")) == 2
    for kind in ("double", "decimal(20,9)", "string"):
        with pytest.raises(ValueError, match="variance"):
            unit_scale(frame(kind))


def test_overlaps_keep_their_coverage(spark):
    import datetime as dt

    from effdated.operators import intervals as iv
    d = lambda n: dt.datetime(2020, 1, n)
    rows = [("k", d(1), d(20), "x"), ("k", d(5), d(8), "y"), (None, d(1), d(4), "a"), (None, d(2), d(3), "b"), ("n", d(1), None, "p"), ("n", d(6), d(9), "q"),
            ("s", d(3), d(9), "u"), ("s", d(3), d(5), "v"), ("u", None, d(2), "w"), ("t", d(2), d(2), "z")]
    df = spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz, v string")
    for hot in (None, 1):
        got = {(r.k, r.v, r.s and r.s.day, r.e and r.e.day) for r in iv.remove_overlaps_and_flatten(df, "k", "s", "e", ["v"], ["v"], hot_rows=hot).collect()}
        assert got == {("k", "x", 1, 5), ("k", "y", 5, 8), ("k", "x", 8, 20), (None, "a", 1, 2), (None, "b", 2, 3), (None, "a", 3, 4),
                       ("n", "p", 1, 6), ("n", "q", 6, 9), ("n", "p", 9, None), ("s", "u", 3, 9), ("u", "w", None, 2)}, hot


def test_null_keys_repeated_ids_and_duplicates(spark):
    import datetime as dt

    import pytest
    from pyspark.sql import functions as F

    from effdated.functions import columns as cl
    from effdated.operators import aggregate as ag, intervals as iv, joins as jn, reshape as rs, shifts as sh
    d = lambda n, h=0: dt.datetime(2020, 1, n, h)
    df = spark.createDataFrame([(None, d(1), d(5), "a", 1), (None, d(2), d(3), "b", 1), ("k", d(1), d(2), "c", 1)], "k string, s timestamp_ntz, e timestamp_ntz, c string, id int")
    got = sorted((r.k or "", r.s.day, r.e.day, r.c) for r in iv.unify_overlapping(df, "k", "s", "e", "c").collect())
    assert got == [("", 1, 5, "a"), ("", 1, 5, "a"), ("k", 1, 2, "c")]  # T5 with a null key
    longest = iv.pick_longest(df, "k", "s", "e", "id").collect()
    assert sorted((r.k or "", r.c, r.is_longest) for r in longest) == [("", "a", True), ("", "b", False), ("k", "c", True)]  # W7, one id in all rows
    flags = spark.createDataFrame([("k", d(6), True, 1), ("k", d(7), True, 1), (None, d(7), True, 1)], "k string, t timestamp_ntz, f boolean, id int")
    assert sorted((r.k or "", r.t.day, r.f) for r in sh.one_flag_per_week(flags, "k", "t", "f", "id").collect()) == [("", 7, True), ("k", 6, True), ("k", 7, False)]
    cal = spark.createDataFrame([("ALL", "New", dt.date(2020, 1, 1), False), ("A", "Local", dt.date(2020, 1, 1), False)], "region string, holiday_name string, holiday_date date, is_additional_holiday boolean")
    shifts = spark.createDataFrame([("A", d(1, 9)), ("B", d(1, 9)), ("A", d(2, 9))], "r string, t timestamp_ntz")
    days = sorted((r.r, r.t.day, r.holiday_regions) for r in sh.add_public_holidays(shifts, "t", "r", cal).collect())
    assert days == [("A", 1, "A,ALL"), ("A", 2, None), ("B", 1, "ALL")]  # T10: one row per shift
    cells = spark.createDataFrame([(1, "a, b"), (2, None), (3, " , ")], "i int, v string")
    assert sorted((r.i, r.v or "") for r in sh.split_attribute(cells, "v").collect()) == [(1, "a"), (1, "b"), (2, ""), (3, "")]
    three = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    with pytest.raises(Exception, match="more than one row"):
        jn.attach_constants(cells, three).collect()
    assert [r.x for r in jn.attach_constants(cells, three.filter("x = 2")).collect()] == [2, 2, 2]
    assert [r.x for r in jn.attach_constants(cells, three.filter("x = 9")).collect()] == [None] * 3
    lookup = spark.createDataFrame([("a", "1"), ("A ", "1"), ("b", "2")], "k string, v string")
    assert sorted(r.v or "" for r in jn.lookup(cells.withColumnRenamed("v", "c"), "c", lookup, "k", "v").collect()) == ["", "", ""]
    with pytest.raises(Exception, match="conflicting lookup"):
        jn.lookup(cells.withColumnRenamed("v", "c"), "c", lookup.union(spark.createDataFrame([("a", "9")], "k string, v string")), "k", "v").collect()
    with pytest.raises(Exception, match="conflicting override"):
        sh.override_values(df, spark.createDataFrame([("k", "x"), ("k", "y")], "k string, c string"), ["k"], ["c"]).collect()
    both = ag.grouper(df, ["id"], {"c": "unique", "k": "list"}).first()  # A1 without an order
    assert list(both.c) == ["a", "b", "c"] and list(both.k) == ["k", None, None]
    assert ag.grouper(df, ["id"], {"c": "list"}, ["s", "c"]).first().c == ["a", "c", "b"]
    wide = spark.createDataFrame([(1, "2.125"), (1, "1.0005")], "i int, `X (Amt)` string").withColumn("X (Amt)", F.col("`X (Amt)`").cast("decimal(12,4)"))
    assert str(rs.melt_keyword(wide, ["i"], {"Amt": " (Amt)"}, aggregate_rows=True).first().Amt) == "3.1255"
    shift = spark.createDataFrame([(d(1, 8), d(1, 16), 0.5)], "s timestamp_ntz, e timestamp_ntz, b double")
    for unit, minutes in (("hour", 30), ("hours", 30), ("minutes", 0)):
        got = cl.unpaid_break(shift, "u", "s", "e", "b", unit).first().u
        assert (got.end - got.start).total_seconds() == (minutes or 0.5) * 60
    with pytest.raises(ValueError, match="fortnight"):
        cl.unpaid_break(shift, "u", "s", "e", "b", "fortnight")


def test_building_a_query_runs_no_job(spark):
    """Plans are lazy once key statistics are taken; only the source queries write the files that they then read."""
    from effdated.plans.driver_queries import all_queries, take_statistics
    take_statistics(spark, "/root/testdata/sf0.001")
    sc = spark.sparkContext
    busy = {}
    for name, query in all_queries()[0].items():
        sc.setJobGroup(f"build-{name}", name)
        query(spark, "/root/testdata/sf0.001")
        track = sc.statusTracker()
        stages = [track.getStageInfo(x) for j in track.getJobIdsForGroup(f"build-{name}") for x in track.getJobInfo(j).stageIds]
        jobs = [x.name for x in stages if x and not x.name.startswith("parquet at")]  # the table's schema
        if jobs:
            busy[name] = jobs
    sc.setJobGroup("", "")
    assert set(busy) <= WRITES_FILES, busy


WRITES_FILES = {"ingest_csv_lineage", "list_and_assign_files", "csv_preamble", "csv_mixed_headers", "bronze_same_basename",
                "payslip_same_basename", "csv_multiline_preamble", "csv_faults"}


def test_hot_null_key_is_split(spark):
    from pyspark.sql import functions as F

    from effdated.operators import scan
    df = spark.range(1000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("v"))
    lay = scan.layout(df, ["k"], ["t"], hot_rows=10)
    assert lay.df.groupBy("_sub").count().agg(F.max("count")).first()[0] < 100
    got = scan.with_prefix_count(scan.with_prev(lay, ["v"]), None, "n").df.orderBy("t").collect()
    assert [r.n for r in got] == list(range(1, 1001))
    assert [r._prev_v for r in got] == [None] + [i % 7 for i in range(999)]
