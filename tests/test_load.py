"""Load tests: observed while writing, equal to a separate scan; duplicates in several subsets; membership in one shuffle."""

import pytest
from pyspark.sql import functions as F

from effdated.operators import quality as dq
from effdated.plans import load as ld


def _sheet(spark):
    return spark.sql("""select * from values ('a', timestamp_ntz'2020-01-01 08:00', timestamp_ntz'2020-01-01 09:00', 'x'),
        ('a', timestamp_ntz'2020-01-02 08:00', timestamp_ntz'2020-01-02 07:00', null), ('b', timestamp_ntz'2020-01-01 08:00', timestamp_ntz'2020-01-03 08:00', ' '),
        ('b', timestamp_ntz'2020-01-05 08:00', null, 'y') as t(EmployeeCode, s, e, Region)""")


TESTS = {"Sheet": {"test_null_values": {"tolerance_null_values": ["e"]}, "test_enddate_before_startdate": {"start": "s", "end": "e", "tolerance_employee_code": ["a"]},
                   "test_timesheet_long_shifts": {"start": "s", "end": "e", "tolerance_shift_maximum_length": 14},
                   "test_timesheet_short_shifts": {"switch": False}}}


def test_tests_are_observed_while_writing(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS load_test_db")
    rows = sorted(map(tuple, ld.write_outputs({"Sheet": _sheet(spark)}, "load_test_db", TESTS).collect()), key=str)
    assert rows == sorted(map(tuple, ld.check_outputs({"Sheet": _sheet(spark)}, TESTS).collect()), key=str)
    found = {(r[1], r[2]): (r[3], r[5]) for r in rows}
    assert found == {("test_null_values", "EmployeeCode"): (0, True), ("test_null_values", "s"): (0, True), ("test_null_values", "Region"): (2, False),
                     ("test_enddate_before_startdate", None): (0, True), ("test_timesheet_long_shifts", None): (1, False)}
    assert spark.table("load_test_db.sheet").count() == 4
    assert ld.write_outputs({"Sheet": _sheet(spark)}, "load_test_db") == ["load_test_db.Sheet"]
    with pytest.raises(ValueError, match="unknown load test"):
        ld.check_outputs({"Sheet": _sheet(spark)}, {"Sheet": {"test_other": {}}})


def test_row_tests_take_one_scan(spark):
    plan = ld.check_outputs({"Sheet": _sheet(spark).repartition(2)}, TESTS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition") == 1


def test_duplicate_subsets(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "x", None), (1, "y", 2), (2, None, 2), (2, None, 3)], "a int, b string, c int")
    rows = dq.duplicated(df, [["a"], ["a", "b"], "all"])
    assert {r.duplicate_of: r["count"] for r in rows.groupBy("duplicate_of").count().collect()} == {"a": 5, "a,b": 4, "a,b,c": 2}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Aggregate ") == 1
    counts = {r.duplicate_of: (r.n_rows, r.n_groups) for r in dq.duplicate_counts(df, [["a"], ["c"], ["all"]]).collect()}
    assert counts == {"a": (5, 2), "c": (4, 2), "a,b,c": (2, 1)}
    assert dq.duplicated(df, "all").count() == 2 == dq.duplicated(df).count() and dq.duplicated(df, ["a"]).columns == ["a", "b", "c", "n_copies", "test"]
    assert dq.duplicate_counts(df.limit(0), [["a"]]).first()["n_rows"] == 0
    with pytest.raises(ValueError, match="twice"):
        dq.duplicated(df, [["a", "b"], ["b", "a"]])


def test_membership_takes_one_shuffle(spark):
    frames = {n: spark.createDataFrame([(k,) for k in ks], "k string") for n, ks in {"p": ["a", "b", None], "q": ["b", "c", "c"], "r": ["a", "b"]}.items()}
    out = dq.membership(frames, "k", {"either": ["q", "r"]})
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r.key: r.missing for r in out.collect()} == {"c": "p"}
    assert {r.key: (r.in_p, r.in_q, r.in_r) for r in dq.membership(frames, "k").collect()} == {"a": (True, False, True), "c": (False, True, False)}
    with pytest.raises(ValueError, match="unknown"):
        dq.membership(frames, "k", {"g": ["z"]})


def test_lineage_of_consecutive_rows_is_one_range(spark):
    """L1: a huge group of consecutive rows stays one range; the text is that of the plain operator."""
    from effdated.operators import lineage
    many = spark.range(2, 2_000_002).select(F.lit("k").alias("k"), F.concat(F.lit("f:row:"), F.col("id").cast("string")).alias("Source"))
    assert [tuple(r) for r in lineage.collapse_ranges(many, ["k"]).selectExpr("k", "Source[0].p", "size(Source[0].ranges)", "Source[0].ranges[0].lo", "Source[0].ranges[0].hi").collect()] \
        == [("k", "f:row:", 1, 2, 2_000_001)]
    rows = [(i % 3, f, n) for i, (f, n) in enumerate([("a", 4095), ("b", 7), ("a", 4096), ("a", 1), ("a", 1), ("b", 9), ("a", 2), ("b", 8), ("a:S1", 3)] * 3)]
    df = spark.createDataFrame([*rows, (5, None, None)], "k int, f string, n int").withColumn("Source", lineage.source_label("f", F.col("n")))
    want = {r.k: r.Source for r in lineage.collapse_sources(df, ["k"], "Source", ["f", "n"]).collect()}
    got = lineage.collapse_ranges(df, ["k"]).select("k", lineage.render_ranges(F.col("Source")).alias("Source"))
    assert {r.k: r.Source for r in got.collect()} == want
    assert lineage.collapse_ranges(df.limit(0), ["k"]).count() == 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        lineage.collapse_ranges(df.withColumn("Source", F.lit("f:row:x")), ["k"]).collect()
