"""Interval operators on hand-computed frames (FIXTURES.md part C)."""

import datetime as dtm

import pytest
from pyspark.sql import functions as F

from effdated.operators import intervals as iv
from effdated.operators.aggregate import grouper


def d(n):
    return dtm.datetime(2020, 1, n)


@pytest.mark.parametrize("hot", [None, 1])
def test_null_flat_value_starts_own_run(spark, hot):
    df = spark.createDataFrame([("a", "x", d(1)), ("a", None, d(2)), ("a", None, d(3)), ("b", "y", d(4))],
                               "k string, v string, t timestamp_ntz")
    out = iv.flatten_effective_date(df, "k", "v", "t", {"v": "first", "t": "min"}, hot_rows=hot)
    rows = sorted(out.collect(), key=lambda r: (r.k, r.StartDate))
    assert len(rows) == 4
    assert [(r.k, r.v, r.StartDate.day, r.EndDate.day if r.EndDate else None) for r in rows] == [
        ("a", "x", 1, 2), ("a", None, 2, 3), ("a", None, 3, None), ("b", "y", 4, None)]


def test_null_key_dropped_by_flatten_kept_by_group(spark):
    df = spark.createDataFrame([(None, "x", d(1), d(2)), (None, "x", d(2), d(3))],
                               "k string, v string, s timestamp_ntz, e timestamp_ntz")
    assert iv.flatten_effective_date(df, "k", "v", "s").count() == 0
    assert iv.group_multiple_date(df, "k", "v", "s", "e").count() == 2


def test_last_is_last_non_null_and_unique_keeps_null_in_order(spark):
    df = spark.createDataFrame([("g", "p", "s2", 1), ("g", None, None, 2), ("g", None, "s2", 3), ("g", None, "s1", 4)],
                               "k string, v string, u string, o int")
    r = grouper(df, ["k"], {"v": "last", "u": "unique"}, order_by=["o"]).collect()[0]
    assert r.v == "p"
    assert r.u == ["s2", None, "s1"]


def test_end_date_chain(spark):
    df = spark.createDataFrame([("a", "x", d(1)), ("a", "y", d(5)), ("a", "z", d(9))], "k string, v string, t timestamp_ntz")
    out = sorted(iv.flatten_effective_date(df, "k", "v", "t").collect(), key=lambda r: r.StartDate)
    assert [(r.StartDate.day, r.EndDate.day if r.EndDate else None) for r in out] == [(1, 5), (5, 9), (9, None)]


@pytest.mark.parametrize("hot", [None, 1])
def test_touching_intervals_are_not_overlapping(spark, hot):
    df = spark.createDataFrame([("a", d(1), d(5), 1), ("a", d(5), d(9), 2)], "k string, s timestamp_ntz, e timestamp_ntz, id int")
    out = iv.add_overlapping_identifier(df, "k", "s", "e", order_by=["id"], hot_rows=hot).collect()
    assert sorted(r.overlapping_index for r in out) == [1, 2]
    assert not any(r.is_overlapping for r in out)


@pytest.mark.parametrize("hot", [None, 1])
def test_nested_overlap_uses_running_max(spark, hot):
    df = spark.createDataFrame([("a", d(1), d(9), 1), ("a", d(2), d(3), 2), ("a", d(4), d(5), 3), ("a", d(9), d(10), 4)],
                               "k string, s timestamp_ntz, e timestamp_ntz, id int")
    out = {r.id: (r.overlapping_index, r.is_overlapping)
           for r in iv.add_overlapping_identifier(df, "k", "s", "e", order_by=["id"], hot_rows=hot).collect()}
    assert out == {1: (1, True), 2: (1, True), 3: (1, True), 4: (2, False)}


def test_cut_at_boundary(spark):
    df = spark.createDataFrame([("a", d(1), d(9))], "k string, s timestamp_ntz, e timestamp_ntz")
    cuts = [F.lit(d(5)), F.lit(d(9)), F.lit(d(12))]
    out = sorted((r.s.day, r.e.day) for r in iv.cut_at_points(df, "s", "e", cuts).collect())
    assert out == [(1, 5), (5, 9)]


def test_pick_longest_and_unify(spark):
    df = spark.createDataFrame([("a", d(1), d(4), 1, "x"), ("a", d(2), d(9), 2, "y"), ("a", d(20), d(21), 3, "z")],
                               "k string, s timestamp_ntz, e timestamp_ntz, id int, c string")
    flags = {r.id: r.is_longest for r in iv.pick_longest(df, "k", "s", "e", "id").collect()}
    assert flags == {1: False, 2: True, 3: True}
    uni = {r.id: (r.s.day, r.e.day, r.c) for r in iv.unify_overlapping(df, "k", "s", "e", "c", ["id"]).collect()}
    assert uni == {1: (1, 9, "x"), 2: (1, 9, "x"), 3: (20, 21, "z")}


def test_fy_rule_priority_and_edges(spark):
    from effdated.functions.dates import financial_year
    from effdated.operators.reshape import financial_year_rules
    fy = financial_year_rules(spark, 2019, 2021)
    attrs = spark.createDataFrame([
        ("e", "ends-in", dtm.date(2018, 1, 1), dtm.date(2019, 8, 1)),
        ("e", "starts-in", dtm.date(2019, 9, 1), dtm.date(2022, 1, 1)),
        ("e", "spans", dtm.date(2018, 1, 1), dtm.date(2023, 1, 1))],
        "k string, v string, f date, t date")
    res = {r.fy: r.v for r in iv.resolve_by_period(attrs, "k", "f", "t", ["v"], fy).collect()}
    # FY2021: both qualify by rule 3 only; the later effective_from wins
    assert res == {"2020": "ends-in", "2021": "starts-in", "2019": "spans"}
    edge = spark.createDataFrame([(dtm.date(2020, 6, 30),), (dtm.date(2020, 7, 1),)], "x date")
    assert [r.fy for r in edge.select(financial_year("x").alias("fy")).collect()] == [2020, 2021]


def test_hot_split_matches_plain_on_skewed_key(spark):
    """One key with most of the rows: forced split gives the same runs as the plain plan."""
    rows = [("hot", ["x", "y", None][(i // 3) % 3], d(1) + dtm.timedelta(minutes=i), i) for i in range(300)]
    rows += [(f"k{i}", "x", d(1), i) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, v string, t timestamp_ntz, id int")
    plain = iv.flatten_effective_date(df, "k", "v", "t", {"v": "first", "t": "min", "id": "count"}, ["id"])
    split = iv.flatten_effective_date(df, "k", "v", "t", {"v": "first", "t": "min", "id": "count"}, ["id"], hot_rows=7)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(plain.collect(), key=key) == sorted(split.collect(), key=key)
    assert plain.count() > 100


def test_hot_split_without_broadcast(spark, monkeypatch):
    """Past the broadcast bound the carry tables are plain joins; results are unchanged."""
    from effdated.operators import scan
    monkeypatch.setattr(scan, "MAX_BROADCAST_ROWS", 1)
    rows = [("hot", d(1) + dtm.timedelta(hours=i), d(1) + dtm.timedelta(hours=i + (3 if i % 5 else 30)), i)
            for i in range(200)] + [("cold", d(2), d(3), 999)]
    df = spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz, id int")
    plain = iv.add_overlapping_identifier(df, "k", "s", "e", order_by=["id"]).collect()
    split = iv.add_overlapping_identifier(df, "k", "s", "e", order_by=["id"], hot_rows=9).collect()
    key = lambda r: r.id
    assert sorted(plain, key=key) == sorted(split, key=key)


def test_interval_join_over_years_open_periods_and_outliers(spark):
    """Facts over several years, periods short, long and open, and a stray date: brute force."""
    import datetime as dt
    import random

    from effdated.operators.joins import interval_join
    rng = random.Random(8)
    day = lambda n: dt.datetime(2015, 1, 1) + dt.timedelta(days=n)
    facts = [(rng.choice("abc"), i, day(s := rng.randint(0, 3000)), day(s + rng.randint(0, 400))) for i in range(200)]
    facts += [("a", 900, dt.datetime(1900, 1, 1), dt.datetime(1900, 1, 2)), ("a", 901, None, day(10)), (None, 902, day(5), day(9))]
    periods = [(rng.choice("abc"), j, day(s := rng.randint(0, 3000)), day(s + rng.choice([3, 40, 500, 2000]))) for j in range(60)]
    periods += [("a", 70, day(100), dt.datetime(2262, 4, 11)), ("b", 71, dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31)), ("c", 72, day(9), None), ("c", 73, day(9), day(1))]
    f = spark.createDataFrame(facts, "k string, i int, s timestamp_ntz, e timestamp_ntz")
    p = spark.createDataFrame(periods, "k string, j int, ps timestamp_ntz, pe timestamp_ntz")
    ok = lambda *x: all(v is not None for v in x)
    want = {"contained": lambda s, e, a, z: ok(s, e, a, z) and s >= a and e <= z,
            "either_end": lambda s, e, a, z: ok(a, z) and ((s is not None and a <= s <= z) or (e is not None and a <= e <= z))}
    for mode, hit in want.items():
        got = sorted((r.i, r.j) for r in interval_join(f, p, "k", "s", "e", "ps", "pe", mode).collect())
        assert got == sorted((i, j) for k, i, s, e in facts for q, j, a, z in periods if k == q and k is not None and hit(s, e, a, z)), mode


def test_stage_steps_with_two_datasets(spark):
    from effdated.plans import stage
    a = spark.createDataFrame([("x", 1), ("y", None)], "k string, v int")
    m = spark.createDataFrame([("X ", "one")], "k string, name string")
    out = stage.run_stage({"a": a, "m": m}, [
        {"function": "inscope_lookup", "sources": ["a", "m"], "args": {"col": "k", "from_col": "k", "to_col": "name"}, "targets": ["named"]},
        {"function": "union", "sources": ["a", "a"], "targets": ["twice"]},
        {"function": "non_nan", "sources": ["a"], "args": {"cols": ["v"], "keys": ["k"]}, "targets": ["bad"]}])
    assert sorted((r.k, r.name) for r in out["named"].collect()) == [("x", "one"), ("y", None)]
    assert out["twice"].count() == 4 and [r.k for r in out["bad"].collect()] == ["y"]


def test_interval_nodes_make_up_the_period(spark):
    """Every bucket range is covered exactly once, by few nodes."""
    from effdated.operators import joins as jn
    last = jn.FANOUT ** (jn.LEVELS - 1) - 1
    ranges = [(a, b) for a in (0, 1, 7, 8, 9, 63, 64, 500, last) for b in (a, a + 1, a + 6, a + 8, a + 100, last) if a <= b <= last]
    df = spark.createDataFrame(ranges, "a int, b int").select("a", "b", jn.covering_nodes(F.col("a"), F.col("b")).alias("nodes"))
    for r in df.collect():
        got = [m for n in r.nodes for m in range((n // jn.LEVELS) * jn.FANOUT ** (n % jn.LEVELS), (n // jn.LEVELS + 1) * jn.FANOUT ** (n % jn.LEVELS))]
        assert sorted(got) == list(range(r.a, r.b + 1))
        assert len(r.nodes) <= 2 * (jn.FANOUT - 1) * jn.LEVELS


def test_interval_join_many_long_periods_of_one_key(spark):
    """10,000 overlapping long periods of one key: nodes hold little beyond what matches."""
    from effdated.operators import joins as jn
    n = 10_000
    periods = spark.range(n).selectExpr("'k' as k", "id as j", "timestamp_ntz'1990-01-01' + make_dt_interval(cast(id % 3000 as int)) as ps",
                                        "timestamp_ntz'1990-01-01' + make_dt_interval(cast(id % 3000 + 900 + id % 4000 as int)) as pe")
    facts = spark.range(300).selectExpr("'k' as k", "id as i", "timestamp_ntz'1985-01-01' + make_dt_interval(cast(id * 40 as int)) as s",
                                        "timestamp_ntz'1985-01-01' + make_dt_interval(cast(id * 40 + 30 as int)) as e")
    out = jn.interval_join(facts, periods, "k", "s", "e", "ps", "pe", "contained")
    want = {r.i: r.n for r in facts.crossJoin(periods.drop("k")).filter("s >= ps and e <= pe").groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {r.i: r.n for r in out.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()} == want
    # pairs that meet in a node against pairs that match
    p = periods.withColumn("node", F.explode(jn.covering_nodes(jn._bucket(F.col("ps"), 1), jn._bucket(F.col("pe"), 1))))
    f = facts.withColumn("node", F.explode(jn.ancestor_nodes(jn._bucket(F.col("s"), 1), F.lit(31))))
    assert f.join(p, "node").count() < 1.1 * sum(want.values())
