"""T6 sweep: linear in the records, equal to a plain reading, split or not."""

import random
import time

import pytest
from pyspark.sql import functions as F

from effdated.operators import intervals as iv


def plain(records):
    """Elementary periods with the last record in (start, end, value) order; equal neighbours merged."""
    out = []
    for key in {r[0] for r in records}:
        own = sorted((r for r in records if r[0] == key), key=lambda r: (r[1], r[2], r[3] is None, r[3] or 0))
        points = sorted({p for r in own for p in r[1:3]})
        row = None
        for a, b in zip(points, points[1:]):
            over = [r for r in own if r[1] <= a and r[2] >= b]
            value = over[-1][3] if over else "none"
            if row and row[4] == a and value is not None and value == row[3]:
                row[4] = b
            elif over:
                row = [key, None, a, value, b]
                out.append(row)
            if not over:
                row = None
    return sorted(((r[0] is None, r[0] or ""), r[2], r[4], -1 if r[3] is None else r[3]) for r in out)


def swept(df, hot):
    rows = iv.remove_overlaps_and_flatten(df, "k", "s", "e", ["v"], ["v"], hot_rows=hot).collect()
    epoch = min((r.s for r in rows), default=None)
    return epoch, sorted(((r.k is None, r.k or ""), r.s, r.e, -1 if r.v is None else r.v) for r in rows)


@pytest.mark.parametrize("hot,seed", [(None, 12), (4, 12), (25, 12), (60, 5), (25, 6)])
def test_sweep_random(spark, hot, seed):
    rng = random.Random(seed)
    records = []
    for _ in range(900):
        s = rng.randint(0, 300)
        length = rng.choice([1, 3, 10, 60, 400, 1000 - s])
        records.append((rng.choice(["a", "a", "a", "b", None]), s, s + length, rng.choice([1, 2, 3, None])))
    records += [("nested", i, 500 - i, i % 2) for i in range(100)] + [("same", 7, 7 + i, i) for i in range(1, 60)]
    df = spark.createDataFrame(records, "k string, si int, ei int, v int").select(
        "k", F.expr("date_add(date'2000-01-01', si)").alias("s"), F.expr("date_add(date'2000-01-01', ei)").alias("e"), "v")
    import datetime
    first = datetime.date(2000, 1, 1)
    _, got = swept(df, hot)
    assert [(k, (s - first).days, (e - first).days, v) for k, s, e, v in got] == plain(records)


@pytest.mark.parametrize("hot", [None, 20_000])
def test_one_open_record_stays_linear(spark, hot):
    """An open record makes one island of a key's whole later history."""
    def run(n):
        df = (spark.range(n).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 100).cast("timestamp_ntz").alias("s"),
                                    F.timestamp_seconds(F.col("id") * 100 + 150).cast("timestamp_ntz").alias("e"), (F.col("id") % 7).alias("v"))
              .unionByName(spark.sql("select 'k' k, timestamp_ntz'1970-01-01 00:00:01' s, cast(null as timestamp_ntz) e, 99L v")))
        t = time.time()
        out = iv.remove_overlaps_and_flatten(df, "k", "s", "e", ["v"], ["v"], hot_rows=hot)
        rows, last = out.agg(F.count(F.lit(1)), F.max(F.struct("s", "e", "v"))).first()
        # the open record shows from second 1 to 100 and again after all others
        assert rows == n + 2 and (last["v"], last["e"]) == (99, None)
        return time.time() - t

    run(1000)
    small, large = run(25_000), run(200_000)
    assert large < 3 + 12 * small  # eight times the rows; the join of pieces and records took 64 times as long


def test_statistics_are_taken_once_and_spread_a_hot_key(spark):
    """A key with a third of all rows: its statistics are written once, scans read them, its rows
    are dealt into many sub-buckets, and without a hot key building a scan runs no job."""
    from effdated.operators import scan
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
                                    F.timestamp_seconds(F.col("id") * 7 % 9999).cast("timestamp_ntz").alias("t"), (F.col("id") % 4).alias("v"), "id")
    name = f"statistics test {time.time()}"
    stats = scan.key_statistics(df, ["k"], 1000, name)
    assert [(r["_k0"], r["_n"]) for r in stats.hot.collect()] == [("hot", 10_000)] and stats.n_sub == 10
    again = scan.key_statistics(spark.range(0).selectExpr("'x' as k"), ["k"], 1000, name)
    assert again.n_sub == 10  # read, not counted anew
    lay = scan.layout(df, ["k"], ["t", "id"], stats)
    sizes = {r["_sub"]: r["n"] for r in lay.df.filter("k = 'hot'").groupBy("_sub").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(sizes) >= 8 and max(sizes.values()) < 2500
    settings = {"v": "first", "t": "min", "id": "count"}
    plain = iv.flatten_effective_date(df, "k", "v", "t", settings, ["id"])
    assert iv.flatten_effective_date(df, "k", "v", "t", settings, ["id"], hot_rows=stats).exceptAll(plain).count() == 0
    none = scan.key_statistics(df, ["k"], 1_000_000)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building a scan", "")
    iv.flatten_effective_date(df, "k", "v", "t", settings, ["id"], hot_rows=none)
    jobs = list(tracker.getJobIdsForGroup("building a scan"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert none.n_sub == 0 and jobs == []
