"""Inputs on which an operator once did less than its whole job."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_dedup import brute_components
from effdated.llm import graph, mixing, quality_rules, registry, secret_scan, simhash, url_filter


# mixing in the pipeline


def toxic_corpus(percent, n=1000):
    """``(id, text, domain)``; ``percent`` of the texts are toxic, the others clean."""
    rng, rows = random.Random(percent), []
    for i in range(n):
        d = "toxic" if i * 7 % 100 < percent else "clean"
        own = {"toxic": ["vile", "nasty", "foul"], "clean": ["plain", "kind", "good"]}[d]
        rows.append((i, " ".join(rng.choice(own if rng.random() < 0.4 else ["the", "of", "and", "to"]) for _ in range(rng.randint(10, 60))), d))
    return rows


def tables(spark, sf_dir, rows, labels):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    return spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")


@pytest.mark.parametrize("percent,labelled", [(0, True), (1, True), (10, True), (10, False)])
def test_clean_documents_stay_however_few_are_toxic(spark, tmpdir_path, percent, labelled):
    rows = toxic_corpus(percent)
    labels = [(i, 1, int(d == "toxic")) for i, _, d in rows if i % 2] if labelled else []
    docs = tables(spark, tmpdir_path, rows, labels)
    kept = {r.doc_id for r in corpus_pipeline.mix_domains(spark, docs, tmpdir_path).collect()}
    assert {i for i, _, d in rows if d == "clean"} <= kept
    if not labelled:
        assert len(kept) == len(rows)
    tokens = lambda which: sum(len(t.split()) for i, t, d in rows if i in kept and d in which)
    assert not labelled or tokens(["toxic"]) <= 0.03 * tokens(["clean", "toxic"])  # 2 % before the draw


def test_a_clean_label_counts_more_than_the_model(spark, tmpdir_path):
    rows = toxic_corpus(10)
    odd = {i for i, _, d in rows if d == "toxic" and i % 20 == 1}
    docs = tables(spark, tmpdir_path, rows, [(i, 1, int(d == "toxic" and i not in odd)) for i, _, d in rows if i % 2])
    assert odd and odd <= {r.doc_id for r in corpus_pipeline.mix_domains(spark, docs, tmpdir_path).collect()}


# simhash


@pytest.mark.parametrize("turn", range(6))
def test_the_last_row_of_a_block_pair_is_compared(turn):
    fp = np.array([0, 0xFFFF << 20, 0xFFFF << 30, 0xFFFF << 40, 0xF0F0 << 48, 1], dtype=np.uint64)  # 0 and 1 alone link
    half = np.array([False, False, False, True, True, True])
    order = np.roll(np.arange(6), turn)
    rep = np.arange(6)
    for o in (order, order[::-1]):
        found = simhash._forest((3, False, fp[o], rep[o], half[o]), simhash.MAX_BITS, simhash.SEGMENTS, simhash.PIECES)
        assert found == [(0, 5)]


def test_a_hot_key_loses_no_link_whatever_the_row_order(spark):
    # one hot key (segment 0 and 1 equal), block 4: most rows are far from all others, pairs differ by one bit in segments 1 to 4 each
    rng = random.Random(5)
    fps, bits = [], [simhash._ring(simhash.SEGMENTS)[i][0] for i in range(1, 5)]
    for _ in range(40):
        x = sum(1 << b for b in rng.sample(range(26, 64), 16))
        fps += [x, x ^ sum(1 << b + 2 for b in bits)]
    rng.shuffle(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.links(spark.createDataFrame([(f, f) for f in signed], "_fp long, _rep long"), block=4)
    comp = {r.node: r.component for r in graph.connected_components(got).collect()}
    assert [comp.get(f, f) for f in signed] == brute_components(signed, fps, simhash.MAX_BITS)


# URL filter


def test_rare_runs_count(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    rows = [(i, f"https://{('shop.net', 'site.org', 'else.example')[i % 3]}/{('x', 'fr', 'y')[i % 3]}/{word()}") for i in range(600)]
    rows += [(1000 + i, rows[2][1]) for i in range(50)] + [(2000, None), (None, rows[5][1])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    want = sorted(map(tuple, url_filter.filter_urls(pages, registry.URL_RULES).collect()), key=str)
    monkeypatch.setattr(url_filter, "MAX_RUNS", 30)
    assert sorted(map(tuple, url_filter.filter_urls(pages, registry.URL_RULES).collect()), key=str) == want


# secret scan


@pytest.mark.parametrize("share", [0.02, 0.05, 0.3])
def test_credentials_are_found_whatever_share_of_the_runs_they_are(share):
    rng = random.Random(3)
    of = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz"
    labelled = {"access": ["AKIA" + of(16, upper) for _ in range(200)], "hex": [of(40, "0123456789abcdef") for _ in range(200)]}
    words = [f"{of(rng.randint(7, 12), small)}{rng.choice(['', '-', '/'])}{of(9, small)}" for _ in range(800)]
    foreign = ["ASIA" + of(16, upper) for _ in range(int(800 * share))]
    model = secret_scan.learn_formats(labelled, foreign + words[len(foreign):])
    assert sum(secret_scan.like_kind(v, model) is not None for v in foreign) >= 0.85 * len(foreign)
    assert not [v for v in words if secret_scan.like_kind(v, model)]


def test_short_credentials_and_rests_beside_base_spans_are_scored(spark):
    rng = random.Random(8)
    of = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = [(i, f"password={of(10)} and ordinary sentences follow {rng.choice(['everywhere', 'sometimes', 'generally'])}") for i in range(200)]
    rows += [(1000, f"the pwd is {of(10)} here"), (1001, f"{of(12)}/AKIA{'A1' * 8}"), (1002, f"only {of(7)}")]
    got = {r.doc_id: r.spans for r in secret_scan.span_digest(secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got[1000] == "like_assign:11:21" and got[1002] == "" and all(got[i].startswith("assign") and "like" not in got[i] for i in range(200))
    text = f"{of(12)}/AKIA{'A1' * 8} AKIA{'B2' * 8}+{of(7)} {of(5)} password = {of(10)}"
    assert secret_scan.other_runs(text, secret_scan.base_spans(text)) == [(0, 13), (54, 62)]


def test_near_copies_go_by_row(spark):
    """Repeated ids: of (2, near copy) and (2, a text of its own) only the copy goes; equal rows are one."""
    base = " ".join(f"word{i}" for i in range(300))
    near = base.replace("word7 ", "other7 ")
    own = " ".join(f"own{i}" for i in range(300))
    rows = [(1, base, "a"), (2, near, "b"), (2, own, "c"), (2, own, "c"), (1, base, "a"), (None, base, "d"), (None, None, "e"), (9, "", "f"), (10, None, "g")]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, _key string"), max_bits=8, segments=10)
    got = sorted((r.doc_id or 0, r._key) for r in kept.collect())
    assert got == [(0, "d"), (0, "e"), (1, "a"), (2, "c"), (9, "f")]


def test_conflicting_labels_are_bad_ones(spark):
    """A document labelled clean and toxic is toxic to the classifier and is not kept for its clean label."""
    docs = spark.createDataFrame([(i, f"fine text number {i % 7}" if i % 2 else f"awful words here {i % 7}") for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 1, "clean").otherwise("toxic").alias("domain"))
    both = labels.unionByName(docs.filter("doc_id % 2 = 0").select("doc_id", F.lit("clean").alias("domain")))
    targets = {"clean": 0.98, "toxic": 0.02}
    want, got = (sorted(r.doc_id for r in mixing.take_mixture(docs, x, targets, max_rate=1.0, keep="clean").collect()) for x in (labels, both))
    assert got == want and len(want) < 130


def test_quality_guarantee_holds_for_all_rules_together(spark):
    """Two strata with learnt cutoffs: each rule alone would lose few clean texts, together they may not
    lose more; and the SQL agrees where cutoffs are learnt."""
    import duckdb
    import oracle

    plain = " ".join(f"word{i}" for i in range(60))
    texts = {"ok": plain, "marks": " ".join(f"w*rd{i}***" for i in range(60)), "loud": " ".join(f"WORD{i}" for i in range(60))}

    def docs(losses):
        rows, labels = [], []
        for s, (lang, lost) in enumerate(losses.items()):
            for i in range(4000):
                at = s * 10_000 + i
                kind = "marks" if i % 10 < 2 else "loud" if i % 10 < 4 else "ok"
                clean = int(kind == "ok" or (i % 1000) // 10 < lost * 100)  # some clean texts look bad
                rows.append((at, texts[kind] + f" n{at}", lang))
                labels.append((at, clean, 0))
        return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")

    d, lab = docs({"en": 0.0, None: 0.0, "": 0.01})
    got = quality_rules.quality_rules(d, lab)
    kept = {(r.lang, r.bad): r.kept for r in got.withColumn("bad", F.col("doc_id") % 10 < 4).groupBy("lang", "bad").agg(F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept["en", True] == kept[None, True] == 0 and kept["en", False] == kept[None, False] == kept["", False] == 2400
    assert kept["", True] > 0  # a null stratum and an empty one are two
    con = duckdb.connect()
    con.register("documents", d.toArrow())
    con.register("labels", lab.toArrow())
    ok, why = oracle.compare(got, con, registry.ORACLES["op9_quality_rules"])
    assert ok, why
