"""Operators 11 to 13 against plain readings of their definitions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from effdated.llm import backoff_lm, registry, whitening, word_runs

SMALL = "/root/testdata/sf0.001"
MIN_LENGTH = 24


# --- whitening -----------------------------------------------------------------------------

def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)) + 100000
    n = len(x)
    y = x - x.sum(0) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    sums = [int(s) for s in x.sum(0)]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return n, deviation, y @ u / np.sqrt(e), e / np.trace(y.T @ y / n)


def check_whitening(rows, vectors, k=8):
    n, deviation, white, explained = plain_whitening(vectors, k)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == n * white.shape[1]
    for j in range(white.shape[1]):
        mine = np.array([got[i, j + 1]["whitened"] for i in range(n)])
        assert np.allclose(mine, white[:, j], atol=1e-7) or np.allclose(mine, -white[:, j], atol=1e-7)
        assert abs(got[0, j + 1]["explained"] / explained[j] - 1) < 1e-9
    assert [int(got[i, 1]["deviation"]) for i in range(n)] == deviation
    assert {r["n"] for r in rows} == {n} and max(r["identity_error"] for r in rows) < 1e-9
    assert all(r["residual"] <= 1e-10 * got[0, 1]["eigenvalue"] for r in rows)


def frame(spark, vectors, ids=None):
    rows = [(i, [None if c is None else float(c) for c in v] if v is not None else None, "x", 1) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string, _id int")


def test_whitening_table(spark):
    rows = registry.op11_whitening(spark, SMALL).collect()
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in table] == list(range(len(table)))
    check_whitening(rows, [r["embedding"] for r in table])


@pytest.mark.parametrize("kind", ["narrow", "hot", "flat", "few"])
def test_whitening_spectra(spark, kind):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((300, 40)) * np.linspace(1, 2, 40)
    if kind == "narrow":
        v = v[:, :5]
    elif kind == "hot":  # a third of all rows is one far vector
        v[:100] = 50.0
    elif kind == "flat":
        v = rng.standard_normal((4000, 30))
    rows = whitening.whiten(frame(spark, v), k=3 if kind == "few" else 8).collect()
    check_whitening(rows, v, 3 if kind == "few" else min(8, v.shape[1]))


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((60, 6)).tolist()
    odd = [None, [], [1.0, None, 1, 1, 1, 1], [float("nan")] * 6, [float("inf")] * 6, [1.0, 2.0]]
    out = whitening.whiten(frame(spark, v + odd, [*range(60), *[100 + i for i in range(len(odd))]])).collect()
    check_whitening(out, v, 6)
    # rank 1, equal vectors, a single one, none
    line = [[float(i), 2.0 * i, 0.0] for i in range(20)]
    assert {r["component"] for r in whitening.whiten(frame(spark, line)).collect()} == {1}
    for vectors in ([[1.0, 2.0]] * 5, [[1.0, 2.0]], [], [None], [[]]):
        assert whitening.whiten(frame(spark, vectors)).collect() == []
    twice = whitening.whiten(frame(spark, v + v, [None] * 60 + [7] * 60)).collect()
    assert len(twice) == 120 * 6 and sum(r["vec_id"] is None for r in twice) == 360


def test_whitening_large_numbers(spark):
    """n x - S leaves 64 bits: deviations stay exact."""
    v = [[2.0**39 + i, float(i % 3)] for i in range(4000)]
    rows = whitening.whiten(frame(spark, v)).filter("vec_id in (0, 3999) and component = 1").collect()
    x = [[math.floor(1024 * c) + 100000 for c in row] for row in v]
    sums = [sum(c) for c in zip(*x)]
    for r in rows:
        assert int(r["deviation"]) == sum((4000 * a - s) ** 2 for a, s in zip(x[r["vec_id"]], sums))
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(spark, [[1e15, 1.0], [1.0, 1.0]])).collect()


def test_filter_damps():
    """The Chebyshev step keeps the top direction and damps all of [low, cut]."""
    e = np.concatenate([[10.0], np.linspace(0.5, 4, 50)])
    q = np.ones((51, 1))
    out = whitening._filter(lambda y: e[:, None] * y, q, 12, 0.5, 4.0, 10.0)[:, 0]
    assert abs(out[0] - 1) < 1e-9 and np.abs(out[1:]).max() < 1e-8


# --- word runs -----------------------------------------------------------------------------

def plain_runs(words, least=MIN_LENGTH):
    best = {}
    for p in range(1, len(words) // 3 + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 3 * p):
                best.setdefault((i, j + p), p)
            i = j
    return sorted((s, e - s, p) for (s, e), p in best.items())


def plain_collapse(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive_words(rng):
    words, letters = [], rng.choice([2, 3, 10, 1000])
    n = rng.choice([0, 10, 60, 200, 700])
    while len(words) < n:
        if rng.random() < 0.4:
            unit = [str(rng.randint(0, letters)) for _ in range(rng.randint(1, max(1, n // 3)))]
            words += [unit[i % len(unit)] for i in range(rng.randint(1, 4 * len(unit) + 5))]
        else:
            words += [str(rng.randint(0, letters)) for _ in range(rng.randint(1, 30))]
    return words


def test_runs_random():
    rng = random.Random(8)
    for _ in range(250):
        lists = [repetitive_words(rng) for _ in range(4)]
        for words, (runs, text, n) in zip(lists, word_runs._scan([" ".join(w).encode() for w in lists], MIN_LENGTH)):
            want = plain_runs(words)
            assert runs == sorted(want, key=lambda r: (r[0], r[2])) and n == len(words)
            assert text.decode() == plain_collapse(words, want)


def test_runs_scales_find_long_periods():
    """Long periods are found through minimizers, and every period belongs to one scale."""
    covered = [p for lo, hi in word_runs.scales(5000) for p in range(lo, hi + 1)]
    assert covered[:2] == [17, 18] and covered == list(range(17, covered[-1] + 1)) and covered[-1] >= 5000
    for p in (17, 25, 26, 333, 1500, 4000):
        unit = [f"u{i * 7919 % 6007}" for i in range(p)]
        words = ["x"] * 5 + [unit[i % p] for i in range(3 * p)] + ["y"]
        runs = word_runs._scan([" ".join(words).encode()], MIN_LENGTH)[0][0]
        assert runs == [(5, 3 * p, p)]
        assert word_runs._scan([" ".join(words[:-2]).encode()], MIN_LENGTH)[0][0] == []


def test_runs_query(spark, documents):
    rows = {r["doc_id"]: r for r in registry.op12_word_runs(spark, SMALL).collect()}
    seen = 0
    for d in documents.collect():
        words = (d["text"] or "").encode().split()
        words = [w.decode() for w in words]
        h = zlib.crc32(str(d["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        r = rows.pop(d["doc_id"])
        best = None
        for s, length, p in runs:
            if best is None or length * best[2] > best[1] * p:
                best = (s, length, p)
        assert (r["n_runs"], r["n_words"]) == (len(runs), n)
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
        seen += bool(runs)
    assert not rows and seen > 5


def test_runs_odd_rows(spark, odd_docs, no_docs):
    rows = word_runs.run_digest(word_runs.find_runs(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["runs_sha256"] == empty and r["n_runs"] == 0 for r in rows)
    assert word_runs.run_digest(word_runs.find_runs(no_docs)).collect() == []
    long = spark.createDataFrame([(1, " ".join(["ab"] * 100_000)), (1, " ".join(["ab"] * 100_000)), (None, "a b " * 12)], "doc_id long, text string")
    got = word_runs.find_runs(long).orderBy(F.desc_nulls_last("doc_id")).collect()
    assert [[tuple(s) for s in r["runs"]] for r in got] == [[(0, 100_000, 1)]] * 2 + [[(0, 24, 2)]]
    assert [r["collapsed"] for r in got] == ["ab", "ab", "a b"]


# --- LM scoring ----------------------------------------------------------------------------

def plain_scores(texts, trained, order=backoff_lm.ORDER, lower=backoff_lm.LOWER):
    """Per text ``n_tokens, n_known, N, base_score, score`` by the recursion of the model."""
    lists = [["<s>"] * (order - 1) + (t or "").encode().lower().split() + ["</s>"] for t in texts]
    counts, context = Counter(), Counter()
    for w, use in zip(lists, trained):
        if use:
            for i in range(order - 1, len(w)):
                for k in range(1, order + 1):
                    counts[tuple(w[i - k + 1:i + 1])] += 1
                    context[tuple(w[i - k + 1:i])] += 1
    n, v = context[()], sum(len(g) == 1 for g in counts)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + backoff_lm.ADD) / (n + backoff_lm.ADD * (v + 1))
        m = lower[len(gram) - 1]
        return (counts[gram] + m * p(gram[1:])) / (context[gram[:-1]] + m)

    out = []
    for w in lists:
        places = range(order - 1, len(w))
        out.append((len(places), sum(counts[w[i],] > 0 for i in places), n, sum(math.log10(p((w[i],))) for i in places),
                    sum(math.log10(p(tuple(w[i - order + 1:i + 1]))) for i in places)))
    return out


def same_scores(rows, texts, trained, **kw):
    want = sorted(plain_scores(texts, trained, **kw))
    got = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9, abs=1e-9)


def test_lm_query(spark, documents):
    docs = documents.collect()
    held = [zlib.crc32(str(d["doc_id"]).encode()) % 10 == 0 for d in docs]
    rows = registry.op13_lm_score(spark, SMALL).collect()
    assert {r["doc_id"]: r["held_out"] for r in rows} == {d["doc_id"]: h for d, h in zip(docs, held)}
    same_scores(rows, [d["text"] for d in docs], [not h for h in held])
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > 0.9 * sum(r["base_score"] for r in out)  # both are negative


@pytest.mark.parametrize("order", [2, 3, 4])
def test_lm_many_blocks_and_parts(spark, documents, order):
    """Blocks of a few texts and parts of a few keys give the counts of one block."""
    few = documents.limit(60).repartition(3)
    lower = {1: 20.0, 2: 5.0, 3: 2.0}
    rows = backoff_lm.score_texts(few, F.col("doc_id") % 3 != 0, order=order, lower=lower, block_tokens=1500, part_keys=4000).collect()
    docs = few.collect()
    same_scores(rows, [d["text"] for d in docs], [d["doc_id"] % 3 != 0 for d in docs], order=order, lower=lower)


def test_lm_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.collect()
    rows = backoff_lm.score_texts(odd_docs, F.col("doc_id") % 2 == 0, block_tokens=40).collect()
    same_scores(rows, [d["text"] for d in docs], [d["doc_id"] is not None and d["doc_id"] % 2 == 0 for d in docs])
    assert sum(r["doc_id"] is None for r in rows) == sum(d["doc_id"] is None for d in docs)
    rows = backoff_lm.score_texts(odd_docs, F.lit(False)).collect()  # nothing to learn from
    same_scores(rows, [d["text"] for d in docs], [False] * len(docs))
    assert backoff_lm.score_texts(no_docs, F.lit(True)).collect() == []
    with pytest.raises(ValueError):
        backoff_lm.score_texts(odd_docs, F.lit(True), order=1)


def test_lm_model_sums_to_one():
    """All words and the unknown one together have probability 1 in every context."""
    texts, n = ["a b a b c", "b a", "c c c"], 0
    rows = plain_scores(texts, [True] * 3)
    assert all(r[4] > r[3] for r in rows)
    words = ["a", "b", "c", None]
    counts, context = Counter(), Counter()
    for t in texts:
        w = ["<s>", *t.split(), "</s>"]
        for i in range(1, len(w)):
            counts[w[i]] += 1
            counts[w[i - 1], w[i]] += 1
            context[w[i - 1]] += 1
            n += 1
    for h in ("a", "zzz", "<s>"):
        total = 0
        for w in [*words, "</s>"]:
            unigram = (counts[w] + 0.1) / (n + 0.1 * (4 + 1))
            total += (counts[h, w] + 20 * unigram) / (context[h] + 20)
        assert total == pytest.approx(1)
