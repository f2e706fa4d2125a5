"""Exact, near and line dedup against brute force, and on odd rows."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from effdated.llm import exact_dedup, graph, line_dedup, simhash


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def table(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# exact dedup


def expected_exact(rows):
    groups, seen, out = defaultdict(list), set(), []
    for i, t in rows:
        groups[lower(t)].append(i)
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True):
        ids = [x for x in groups[lower(t)] if x is not None]
        keep = max(ids, default=None)
        first = i == keep and lower(t) not in seen
        seen |= {lower(t)} if first else set()
        out.append((i, keep, len(groups[lower(t)]), first, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("name", ["odd_docs", "documents"])
def test_exact_dedup_matches_brute_force(name, request):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = table(exact_dedup.exact_dedup(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == expected_exact(rows)


def test_exact_dedup_keeps_one_row_of_each_text(odd_docs):
    kept = exact_dedup.drop_exact_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(lower(r.text) for r in rows) == sorted({lower(r.text) for r in odd_docs.collect()})
    assert {r.doc_id for r in rows if r.text and "quick" in r.text.lower() and "\n" not in r.text} == {2}


def test_a_full_filter_only_costs_shuffles(documents, monkeypatch):
    want = table(exact_dedup.exact_dedup(documents), "doc_id", "kept", "group_size")
    monkeypatch.setattr(exact_dedup, "MAX_FILTER_BITS", 64)
    assert table(exact_dedup.exact_dedup(documents), "doc_id", "kept", "group_size") == want


def test_hot_groups_take_the_broadcast_way(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_dedup(docs)
    assert got.filter("kept").count() == 2001
    assert got.filter("group_size = 1000 AND keep_id = 2997").count() == 1000


def test_exact_dedup_of_nothing(no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    assert exact_dedup.drop_exact_copies(no_docs).count() == 0


# near dedup


def brute_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, bits=4):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, x in enumerate(ids):
        members[root(i)].append(x)
    return [min((x for x in members[root(i)] if x is not None), default=None) for i in range(len(ids))]


@pytest.mark.parametrize("name", ["odd_docs", "documents"])
def test_simhash_matches_brute_force(name, request):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, brute_components([i for i, _ in rows], fps))), key=str)
    assert table(simhash.simhash_components(docs), "doc_id", "fingerprint", "component_id") == want


@pytest.mark.parametrize("max_bits,segments,pieces,block", [(4, 5, 3, 1024), (4, 5, 3, 8), (2, 5, 1, 16), (3, 8, 2, 16)])
def test_links_connect_what_all_pairs_connect(spark, max_bits, segments, pieces, block):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {0, (1 << 64) - 1, 1}
    for c in centres:
        for _ in range(40):  # clouds around centres: some linked, some not
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame([(f, f) for f in signed], "_fp long, _rep long")
    links = simhash.links(classes, max_bits, segments, pieces, block)
    comp = {r.node: r.component for r in graph.connected_components(links).collect()}
    want = brute_components(signed, fps, max_bits)
    assert [comp.get(f, f) for f in signed] == want


def test_near_copies_leave_one(odd_docs, documents):
    kept = simhash.drop_near_copies(documents)
    found = simhash.simhash_components(documents)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted({r.component_id for r in found.collect()})
    odd = simhash.drop_near_copies(odd_docs)
    assert odd.columns == odd_docs.columns
    assert {3, 1, 6} <= {r.doc_id for r in odd.collect()} and not {4, 5, 7} & {r.doc_id for r in odd.collect()}


def test_simhash_of_nothing(no_docs):
    assert simhash.simhash_components(no_docs).count() == 0
    assert simhash.drop_near_copies(no_docs).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(path + star, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300))


# line dedup


def brute_lines(rows, min_words=8):
    order = sorted({(i is None, i or 0, t or "") for i, t in rows})
    lines = [(d, k, tuple(w for w in re.split(r"[\x20\x09-\x0D]+", line) if w)) for d, (_, _, t) in enumerate(order) for k, line in enumerate(t.split("\n"))]
    first = {}
    for d, k, w in lines:
        if w:
            first.setdefault(w, (d, k))

    def near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        a, b = sorted((a, b), key=len)
        return any(b[:j] + b[j + 1:] == a for j in range(len(b)))

    long = [w for w in first if len(w) >= min_words]
    late = {b for b in long for a in long if first[a] < first[b] and near(a, b)}
    gone = defaultdict(list)
    for d, k, w in lines:
        if w and (w in late or first[w] != (d, k)):
            gone[order[d]].append(k)
    return gone


def test_line_dedup_matches_brute_force(odd_docs):
    odd_docs = odd_docs.filter("doc_id IS NULL OR doc_id <> 6").withColumn("text", F.when(F.col("doc_id") == 7, "x y").otherwise(F.col("text")))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = line_dedup.line_dedup(odd_docs)
    assert got.columns == [c for c in odd_docs.columns if c != "n_lines"] + ["n_lines", "dropped_lines"]
    # text hashes order rows of one id otherwise than texts; ids differ here or texts are equal
    want = brute_lines(rows)
    for r in got.collect():
        was = [t for i, t in rows if i == r.doc_id]
        if r.doc_id is not None:
            gone = want[(False, r.doc_id, was[0] or "")]
            assert list(r.dropped_lines) == gone
            lines = (was[0] or "").split("\n")
            assert (r.text or "") == "\n".join(x for k, x in enumerate(lines) if k not in gone)
            assert r.n_lines == len(lines)
    assert {11, 12} <= {r.doc_id for r in got.filter("size(dropped_lines) > 0").collect()}


def test_line_dedup_on_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = {k[1]: v for k, v in brute_lines(rows).items()}
    got = {r.doc_id: list(r.dropped_lines) for r in line_dedup.line_dedup(documents).filter("size(dropped_lines) > 0").collect()}
    assert got == want


def test_line_dedup_of_long_lines_and_nothing(spark, no_docs):
    a = " ".join(f"w{i}" for i in range(20_000))
    docs = spark.createDataFrame([(1, a), (2, a.replace("w777 ", "")), (3, a.replace("w778 ", "zzz "))], "doc_id long, text string")
    assert {r.doc_id: r.text == "" for r in line_dedup.line_dedup(docs).collect()} == {1: False, 2: True, 3: True}
    assert line_dedup.line_dedup(no_docs).count() == 0
