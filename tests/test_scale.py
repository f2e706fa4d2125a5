"""What a step reads, carries and repeats: plans and row counts of the steps that grow with the tables."""

import itertools
from datetime import datetime, timedelta

import pytest

from effdated.operators import filters as fl
from effdated.operators import joins as jn

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _generated_rows(df) -> int:
    """Rows that came out of the plan's explodes when ``df`` was collected."""
    def walk(node):
        here = node.metrics().apply("numOutputRows").value() if node.nodeName() == "Generate" else 0
        children = node.children()
        return here + sum(walk(children.apply(i)) for i in range(children.size()))
    return walk(df._jdf.queryExecution().executedPlan())


@pytest.fixture()
def plain(spark):
    """Plans as they are made: no adaptive ones, no broadcast by size."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def _interval_rows(spark):
    t0 = datetime(2020, 1, 1)
    facts = [(k, i, t0 + timedelta(days=17 * i), t0 + timedelta(days=17 * i + 9)) for k in ("few", "many") for i in range(60)]
    facts += [(None, 99, t0, t0), ("few", 98, None, t0 + timedelta(days=3)), ("many", 97, t0 + timedelta(days=3), None)]
    periods = [("few", 0, t0, datetime(9999, 1, 1)), ("few", 1, t0 + timedelta(days=40), t0 + timedelta(days=400)), (None, 2, t0, datetime(9999, 1, 1))]
    periods += [("many", 10 + i, t0 + timedelta(days=31 * i), t0 + timedelta(days=31 * i + (4000 if i % 9 == 0 else 45))) for i in range(30)]
    periods += [("many", 90, None, t0), ("few", 91, t0 + timedelta(days=9), t0)]
    return (facts, periods, spark.createDataFrame(facts, "k string, f int, s timestamp_ntz, e timestamp_ntz"),
            spark.createDataFrame(periods, "k string, p int, ps timestamp_ntz, pe timestamp_ntz"))


@pytest.mark.parametrize("mode", ["either_end", "contained"])
@pytest.mark.parametrize("direct", [1, 5, 128])
def test_interval_join_direct_and_tree_keys(spark, monkeypatch, mode, direct):
    """Keys on either side of DIRECT_PERIODS give every pair once."""
    monkeypatch.setattr(jn, "DIRECT_PERIODS", direct)
    facts, periods, f, p = _interval_rows(spark)

    def fits(x, y):
        (fk, _, s, e), (pk, _, ps, pe) = x, y
        if fk is None or fk != pk or ps is None or pe is None:
            return False
        if mode == "contained":
            return s is not None and e is not None and ps <= s and e <= pe
        return any(t is not None and ps <= t <= pe for t in (s, e))

    want = sorted((x[1], y[1]) for x, y in itertools.product(facts, periods) if fits(x, y))
    got = jn.interval_join(f, p, "k", "s", "e", "ps", "pe", mode)
    assert got.columns == ["k", "f", "s", "e", "p", "ps", "pe"]
    assert sorted((r["f"], r["p"]) for r in got.collect()) == want


@pytest.mark.parametrize("mode", ["either_end", "contained"])
def test_interval_join_sends_rows_of_ordinary_keys_once(plain, mode):
    """Facts and open periods of a key with few periods are not multiplied by the levels of the tree."""
    facts, periods, f, p = _interval_rows(plain)
    joined = jn.interval_join(f, p, "k", "s", "e", "ps", "pe", mode)
    joined.collect()
    assert _generated_rows(joined) <= len(facts) + len(periods)


def test_staged_payslips_deal_lines_once(plain):
    from effdated.plans.datasets import staged_payslips
    li, o = (plain.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "orders"))
    plan = _plan(staged_payslips(li, o))
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "l_shipdate" not in plan


def test_staged_payslips_number_equal_lines(spark):
    """The ordinal does not depend on columns behind those used; an order that comes twice repeats its lines."""
    from effdated.plans.datasets import staged_payslips
    line = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate string"
    lines = [(1, 7, 1, 2.0, 5.0, "N", "O", "b"), (1, 7, 1, 2.0, 5.0, "N", "O", "a"), (1, 3, 1, 9.0, 5.0, "A", "F", "c"), (1, None, 2, 1.0, 1.0, "R", "F", "d")]
    day = datetime(2020, 1, 1)
    orders = spark.createDataFrame([(1, 4, day), (1, 4, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    got = sorted((r["Source"], r["Hours"]) for r in staged_payslips(spark.createDataFrame(lines, line), orders).collect())
    want = [("payslips:row:11001", "9.0"), ("payslips:row:11002", "2.0"), ("payslips:row:11003", "2.0"), ("payslips:row:12001", "1.0")]
    assert got == sorted(want * 2)


def test_dedupe_digests_come_back_as_they_were(spark):
    """Lower-case hex travels as bytes; other texts, null and the empty text stay apart."""
    keys = ["00ff", "00FF", "0ff", "ff", "", None, "xyz", "ab" * 32, "00 ff", "0x00ff"]
    rows = [(k, n, f"{k}-{n}") for k in keys for n in (3, 1, 2)]
    df = spark.createDataFrame(rows, "code string, n int, text string").repartition(3)
    got = fl.dedupe_keep_first(df, ["code"], ["n"], digests=["code"])
    assert got.columns == df.columns
    assert {tuple(r) for r in got.collect()} == {(k, 1, f"{k}-1") for k in keys} and got.count() == len(keys)


def test_payslip_same_basename_carries_no_paths(plain):
    import __spark_entry__ as E
    plan = E.queries()["payslip_same_basename"](plain, SF)._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(x for x in plan.splitlines() if "Aggregate" in x and "struct(o" in x)
    assert "source_path" not in grouped and "source_file" not in grouped and "l_returnflag" not in grouped


def test_timesheets_compute_their_shifts_once(plain):
    """The six-month share comes from the rows of the result, not from the whole chain run again."""
    import __spark_entry__ as E
    plan = _plan(E.queries()["build_timesheets"](plain, SF))
    assert "_who" not in plan and "_dn" in plan  # no share joined back by employee and day


def test_trailing_share_on_rows_is_that_of_the_days(spark):
    from effdated.operators import shifts as sh
    t0 = datetime(2024, 1, 1, 8)
    rows = [(k, t0 + timedelta(days=d, hours=h)) for k in ("a", "b") for d, h in ((0, 0), (0, 5), (1, 0), (40, 0), (183, 0), (183, 2), (184, 0), (400, 0))]
    rows += [("a", None), ("a", None), (None, t0), (None, t0 + timedelta(days=1))]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz")
    days = {(r["k"], r["day"]): r["s"] for r in sh.trailing_day_share(df, "k", "t", out="s").collect()}
    got = sh.with_trailing_day_share(df, "k", "t", out="s").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["s"] == (days[r["k"], r["t"].date()] if r["k"] and r["t"] else None)


def test_report_explodes_attributes_once(spark):
    import __spark_entry__ as E
    plan = E.queries()["remediation_report"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1


def _dealt_rows(df) -> int:
    """Rows that went through the plan's shuffles when ``df`` was collected."""
    def walk(node):
        here = node.metrics().apply("shuffleRecordsWritten").value() if node.nodeName() == "Exchange" else 0
        children = node.children()
        return here + sum(walk(children.apply(i)) for i in range(children.size()))
    return walk(df._jdf.queryExecution().executedPlan())


def _below_exchanges(node) -> list[str]:
    children = [node.children().apply(i) for i in range(node.children().size())]
    here = [children[0].toString()] if node.nodeName() == "Exchange" else []
    return here + [x for c in children for x in _below_exchanges(c)]


def test_payslips_deal_lines_out_once(plain):
    """Beside the lines' own input, a line's payload is dealt once (to its period) and its label's hash once;
    no shuffle holds a code."""
    import __spark_entry__ as E
    df = E.queries()["build_payslips"](plain, SF)
    n = plain.read.parquet(f"{SF}/lineitem.parquet").count()
    assert len(df.collect()) == n
    assert _dealt_rows(df) <= 8 * n  # 18 before, 6 now
    assert not any("sha2(" in x for x in _below_exchanges(df._jdf.queryExecution().executedPlan()))


@pytest.mark.parametrize("limit", [0, 2, 1_000_000])
def test_mark_repeated(spark, monkeypatch, limit):
    monkeypatch.setattr(fl, "REPEATED_KEYS", limit)
    keys = ["a", "b", "b", "c", None, "", "d", "d", "e", "e", "e", None]
    df = spark.createDataFrame(list(enumerate(keys)), "n int, k string").repartition(4)
    got = fl.mark_repeated(df, df["k"], "again")
    assert got.columns == ["n", "k", "again"]
    want = sorted((i, k is None or limit < 3 or keys.count(k) > 1) for i, k in enumerate(keys))
    assert sorted((r["n"], r["again"]) for r in got.collect()) == want


def _plain_payslips(lines, smn, cycles):
    """The build as its docstring says, line by line: (label, employee, start, end, period of the class, island, many, code's end, cycle)."""
    from functools import cmp_to_key
    day, last = timedelta(days=1), lambda x: (x is None, x or 0)
    met = []
    for emp, s, e0, pay, hours, amount, base, label in lines:
        e = e0 and e0 + day
        base = {"1": "True", "0": "False"}.get(base, base)
        hours = "0" if base == "False" else hours
        met += [(emp, s, e, pay, hours, amount, base, label, x) for x in smn if emp is not None and x[0] == emp and any(t is not None and x[1] <= t <= x[2] for t in (s, e))]
    islands = {}
    for emp in {m[0] for m in met}:
        top, n = None, 0
        for s, e in sorted({m[1:3] for m in met if m[0] == emp}, key=lambda p: (last(p[0]), last(p[1]))):
            n += not (top is not None and s is not None and s < top)
            top = e if top is None else top if e is None else max(top, e)
            islands.setdefault((emp, n), []).append((s, e))
    first_nulls = lambda x: (x is not None, x or 0)
    rows = []
    for emp, s, e, pay, hours, amount, base, label, x in met:
        n, own = next((k[1], v) for k, v in islands.items() if k[0] == emp and (s, e) in v)
        ends = [p[1] for p in own if p[1]]
        end = max(ends) if ends else None
        head = min(own, key=lambda p: (first_nulls(p[0]), first_nulls(p[1])))[1]
        order = (last(x[1]), last(x[3]), last(hours), last(amount), last(pay), emp, n, base, x[2])
        rows.append((order, label, (label, emp, min((p[0] for p in own if p[0]), default=None), end, cycles.get(end), pay, hours, amount, base, x[1], x[2], x[3], n, len(own) > 1, head and head - day)))
    best = {}
    for order, label, row in rows:
        if label not in best or order < best[label][0]:
            best[label] = (order, row)
    return sorted((r for _, r in best.values()), key=str)


@pytest.mark.parametrize("limit", [0, 1_000_000])
@pytest.mark.parametrize("ids", [False, True])
def test_payslips_are_those_of_a_plain_reading(spark, monkeypatch, limit, ids):
    """Repeated, shared and missing labels, periods without an end or a start, islands, employees without a class."""
    import hashlib
    from effdated.plans.datasets import payslips
    monkeypatch.setattr(fl, "REPEATED_KEYS", limit)
    d = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    smn = [("a", d(0), d(30), "x"), ("a", d(30), d(30), "x"), ("a", d(30), d(400), "x"), ("b", d(10), d(90), None), ("b", d(10), d(60), "y"), ("c", d(5), d(6), "z")]
    periods = [("a", d(1), d(14)), ("a", d(10), d(29)), ("a", d(40), None), ("a", None, d(50)), ("a", d(300), d(313)), ("a", d(900), d(913)),
               ("b", d(0), d(13)), ("b", d(14), d(27)), ("b", d(20), d(89)), ("b", d(89), d(102)), ("c", d(0), d(13)), ("c", d(6), d(19)), ("q", d(1), d(14)), (None, d(1), d(14)), ("a", None, None)]
    lines = [(*p, pay, hours, amount, base, f"f:row:{i * 3 + j}") for i, p in enumerate(periods) for j, (pay, hours, amount, base) in enumerate([("N", "8.0", 1.5, "1"), ("O", "2.0", 7.5, "0"), (None, None, None, None)])]
    lines += [(*periods[i], "N", "8.0", 1.5, "1", f"f:row:{n}") for i, n in ((1, 0), (4, 3), (6, 0), (7, 24), (7, 24), (9, 33), (2, 6))]
    lines += [(*periods[i], "N", "8.0", 1.5, "1", None) for i in (8, 1, 0)]
    names = "EmployeeCode string, PeriodStart timestamp_ntz, PeriodEnd timestamp_ntz, PayCode string, Hours string, Amount double, `Is Base Hours?` string, Source string"
    staged = spark.createDataFrame(lines, names).repartition(3)
    code = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if ids:
        from pyspark.sql import functions as F
        staged = staged.withColumn("source_id", F.lit("7f"))
    cycles = {d(30): "2024-01", d(15): "2024-00"}
    out = payslips(staged, spark.createDataFrame(smn, "EmployeeCode string, StartDate timestamp_ntz, EndDate timestamp_ntz, Classification string"),
                   spark.createDataFrame(list(cycles.items()), "run_end timestamp_ntz, cycle string"))
    got = out.collect()
    want = _plain_payslips(lines, smn, cycles)
    shown = sorted(((r["Source"] and r["Source"].replace("{'f:row:': ['", "f:row:").replace("']}", ""), r["EmployeeCode"], r["PeriodStart"], r["PeriodEnd"], r["PayCycle"], r["PayCode"], r["Hours"], r["Amount"],
                     r["Is Base Hours?"], r["StartDate"], r["EndDate"], r["Classification"], r["overlapping_index"], r["is_overlapping"]) for r in got), key=str)
    assert [x[1:] for x in shown if x[0] and "f:row" in x[0]] == [x[1:-1] for x in want if x[0]]
    assert len(got) == len(want)
    ends = {x[0]: (x[1], x[-1]) for x in want}
    for r in got:
        label = r["Source"].split("'")[3] if "f:row" in (r["Source"] or "") else None
        label = label and f"f:row:{label}"
        assert r["PayslipCode"] == code(f"{ends[label][0]}#{ends[label][1] or '∅'}")
        assert r["PayslipLineCode"] == (code(f"7f|{label}" if label else "7f") if ids else label and code(label))


def test_parse_datetime_skips_only_layouts_that_cannot_fit(spark):
    from pyspark.sql import functions as F
    from effdated.functions import dates as dt
    texts = ["05/01/1998", " 5/1/98 ", "5/1/1998 7:08", "5/1/1998 7:08:09", "5-1-1998", "5-1-1998 7:08:09", "5.1.1998", "1998-01-05", "1998-01-05 07:08", "1998-01-05 07:08:09",
             "1998-01-05T07:08:09", "5 Jan 1998", "5-Jan-1998", "5-Jan-98", "Jan 5 1998", "31/12/1998", "12/31/1998", "1998/01/05", "5/1-1998", "05011998", "", " ", ":", "5/1/1998 ", None, "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for dayfirst, patterns in ((True, dt.DAYFIRST_PATTERNS), (False, dt.MONTHFIRST_PATTERNS)):
        every = F.coalesce(*[F.try_to_timestamp(F.trim("t"), F.lit(p)).cast("timestamp_ntz") for p in patterns])
        rows = df.select("t", dt.parse_datetime("t", dayfirst).alias("got"), every.alias("want")).collect()
        assert [r["got"] for r in rows] == [r["want"] for r in rows] and sum(r["got"] is not None for r in rows) > 9
