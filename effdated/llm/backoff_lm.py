"""LM scoring (operator 13): a weighted backoff automaton over smoothed n-grams.

Model: words and an end token, counts ``c`` of all n-grams up to ``ORDER`` in the training texts (none
left out), start marks as context only, and

    p(w) = (c(w) + ADD) / (N + ADD (V + 1)),   p(w | h) = (c(hw) + M p(w | h')) / (c(h) + M)

with ``h'`` = h without its oldest word and one weight ``M`` per length of h. As an automaton: contexts that
occur are states; a state h has an arc for every w with c(hw) > 0, weight log p(w | h), and a
failure arc to h' with weight log (M / (c(h) + M)); the root also takes unknown words. A
text is read once from left to right: the state is carried, failure arcs are followed until the
word has an arc, and weights add up.

The counts grow with the corpus, so no task holds the whole automaton:

1. Texts are cut into blocks of about ``BLOCK_TOKENS`` tokens, written once as word numbers.
2. Each block names its n-grams, counts those of its training texts, and sends (64-bit key,
   count) of each distinct one to the part of the key. Common n-grams are thus added up before they
   move, and a part gets each key once per block at most.
3. A part adds up and answers every block with what others add to its counts, in the order of
   the keys that it sent (so keys travel once). Parts are as many as keep ``PART_KEYS`` keys in each.
4. Block and answers meet; the block builds that part of the automaton its texts can touch
   and reads all its texts side by side, token by token.

Keys are hashes, as wide as keeps the expected number of clashes among all of them below one
(64 bits at most, and always for single words); n-grams that clash add up. Naming in a block is exact.

Null text counts as empty: one token, the end. Texts with null ids and rows
where ``train`` is null are not learnt from. Very long texts are scored whole; a single text is the
least that a block holds. Repeated rows are counted and returned each. Without training texts N = V = 0.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_table

ORDER, ADD = 3, 0.1
#: Weight M of the lower order, by the number of words in the context.
LOWER = {1: 20.0, 2: 5.0}
BLOCK_TOKENS, PART_KEYS = 1 << 21, 1 << 21
#: Names of the end token and the start mark; no word holds white space.
END, START = b"\n", b" "
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _pack(values: np.ndarray) -> bytes:
    """Integers as compressed bytes, equal places of the numbers side by side."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.decompress(data, n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).reshape(n)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers 0, 1, ... of the distinct values in their order, and of each a place that has it."""
    by = np.argsort(values)
    new = np.empty(len(by), bool)
    new[:1] = True
    np.not_equal(values[by[1:]], values[by[:-1]], out=new[1:])
    number = np.empty(len(by), np.int32)
    number[by] = np.cumsum(new, dtype=np.int32) - 1
    return number, by[new]


class _Block:
    """Texts gathered until they make a block."""

    def __init__(self):
        self.sizes, self.train, self.tokens = [], [], []
        self.number: dict[bytes, int] = defaultdict(count().__next__)
        self.number[END], self.number[START]  # noqa: B018  numbers 0 and 1
        self.n = 0

    def add(self, text: bytes, train: bool) -> None:
        words = text.lower().split()  # bytes: A-Z and ASCII white space only
        words.append(END)
        self.tokens.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        self.sizes.append(len(words))
        self.train.append(train)
        self.n += len(words)

    def row(self) -> dict:
        tokens = np.concatenate(self.tokens)
        # frequent words get small numbers, equally frequent ones in the order of their codes: both pack well
        codes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.number), np.uint64, len(self.number))
        order = np.lexsort((codes, -np.bincount(tokens, minlength=len(self.number))))
        codes, new = codes[order], np.empty_like(order)
        new[order] = np.arange(len(order))
        train = np.array(self.train)
        sizes = np.array(self.sizes, np.int64)
        return {"block": uuid.uuid4().hex, "texts": len(sizes), "n": self.n, "words": len(codes), "learnt": int(sizes[train].sum()), "end": int(new[0]), "start": int(new[1]),
                "tokens": _pack(new[tokens].astype(np.int32)), "codes": _pack(np.diff(codes, prepend=np.uint64(0))), "sizes": _pack(sizes), "train": train.astype(np.uint8).tobytes()}


_FIELDS = [("block", pa.string()), ("texts", pa.int64()), ("n", pa.int64()), ("words", pa.int64()), ("learnt", pa.int64()), ("end", pa.int64()), ("start", pa.int64()),
           ("tokens", pa.binary()), ("codes", pa.binary()), ("sizes", pa.binary()), ("train", pa.binary())]
_FORM = ("block string, texts long, n long, words long, learnt long, end long, start long, "
         "tokens binary, codes binary, sizes binary, train binary")


def token_blocks(rows: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of ``rows(_id, _text, _train)``, written to the shared folder with their ids."""
    kind = rows.schema["_id"].dataType.simpleString()
    fields = [pa.field(n, t) for n, t in _FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids = _Block(), []

        def flush():
            row = block.row()
            own = pa.concat_arrays(ids)
            lists = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            return pa.RecordBatch.from_arrays([*[pa.array([row[f.name]], f.type) for f in fields], lists], names=[*[f.name for f in fields], "ids"])

        for batch in batches:
            first = 0
            train = batch.column(2)
            for i, t in enumerate(batch.column(1)):
                block.add(t.as_py() or b"", train[i].as_py() is True)
                if block.n >= block_tokens:
                    ids.append(batch.column(0).slice(first, i + 1 - first))
                    yield flush()
                    block, ids, first = _Block(), [], i + 1
            if first < batch.num_rows:
                ids.append(batch.column(0).slice(first))
        if block.n:
            yield flush()

    return shared_table(rows.mapInArrow(run, f"{_FORM}, ids array<{kind}>"), "lm-blocks", 500)


class _Grams:
    """The n-grams of a block: ``at[k][i]`` numbers the one of k words that ends at place i.
    Every text is preceded by ``order - 1`` start marks."""

    def __init__(self, row: dict, order: int):
        sizes, n = _unpack(row["sizes"], np.int64, row["texts"]), row["n"]
        pad = max(order - 1, 1)
        self.firsts = np.concatenate([[0], np.cumsum(sizes + pad)[:-1]]) + pad  # places of the texts' first tokens
        self.sizes, self.order, self.end = sizes, order, row["end"]
        self.train = np.frombuffer(row["train"], np.uint8).astype(bool)
        self.places = (np.arange(n) + np.repeat(pad * np.arange(1, len(sizes) + 1), sizes)).astype(np.int32)
        w = np.full(n + pad * len(sizes), row["start"], np.int32)
        w[self.places] = _unpack(row["tokens"], np.int32, n)
        codes = np.cumsum(_unpack(row["codes"], np.uint64, row["words"]))
        token = np.zeros(len(w), bool)
        token[self.places] = True
        offset = np.arange(len(w), dtype=np.int32) - np.repeat((self.firsts - pad).astype(np.int32), sizes + pad)
        # what counts: grams of training texts; those of start marks once a text, as contexts of its first word
        counts = np.repeat(self.train, sizes + pad) & (token | (offset == pad - 1))
        self.w, self.token = w, token
        # per length: numbers by place, and of each number a place where it ends, its key and its count in the block's training texts
        self.at, self.some, self.key, self.own = {}, {}, {}, {}
        for k in range(1, order + 1):
            where = np.flatnonzero(offset >= k - 1).astype(np.int32)
            pair = w[where] if k == 1 else self.at[k - 1][where - 1].astype(np.int64) * (len(codes) + 1) + w[where]
            number, some = _numbered(pair)
            del pair
            some = where[some]
            key = codes[w[some]]
            if k > 1:
                key = self.key[k - 1][self.at[k - 1][some - 1]] * _MIX + key + np.uint64(k)
                key ^= key >> np.uint64(31)
                key *= np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
            self.own[k] = np.bincount(number[counts[where]], minlength=len(some)).astype(np.int32)
            self.at[k] = np.zeros(len(w), np.int32)
            self.at[k][where] = number
            self.some[k], self.key[k] = some, key

    def asked(self, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the n-grams of these lengths, cut to ``bits``, and the order that sorts them."""
        keys = np.concatenate([self.key[k] for k in orders]) >> np.uint64(64 - bits)
        return keys, np.argsort(keys, kind="stable")


def _ask(blocks: DataFrame, orders: tuple[int, ...], bits: int, parts: int) -> DataFrame:
    """``part, block, n, keys, counts``: the sorted keys of a block, by part, with its own counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {f: batch.column(f)[i].as_py() for f, _ in _FIELDS}
                grams = _Grams(row, max(orders))
                key, by = grams.asked(orders, bits)
                key, own = key[by], np.concatenate([grams.own[k] for k in orders])[by]
                del grams, by
                part = ((key >> np.uint64(bits - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
                cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
                for a, b in zip(cuts, [*cuts[1:], len(key)]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(part[a])], pa.int32()), pa.array([row["block"]]), pa.array([b - a], pa.int64()),
                         pa.array([_pack(np.diff(key[a:b], prepend=np.uint64(0)))], pa.binary()), pa.array([_pack(own[a:b])], pa.binary())],
                        names=["part", "block", "n", "keys", "counts"])

    return blocks.select(*[n for n, _ in _FIELDS]).mapInArrow(run, "part int, block string, n long, keys binary, counts binary")


def _answer(asked: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    """``orders, part, block, n, more``: for every row of ``asked`` what other blocks add to its counts,
    in the order of its keys; and once a part (null block) as ``n`` the keys that occur in training."""
    label = max(orders)

    def add_up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.cumsum(_unpack(k, np.uint64, n)) for k, n in zip(rows["keys"], rows["n"])])
        names, number = np.unique(keys, return_inverse=True)
        del keys
        own = np.concatenate([_unpack(c, np.int32, n) for c, n in zip(rows["counts"], rows["n"])])
        total = np.bincount(number, weights=own, minlength=len(names)).astype(np.int64)
        more = total[number] - own
        ends = np.cumsum(rows["n"].to_numpy())
        out = [(label, int(key[0]), b, int(n), _pack(more[e - n:e])) for b, n, e in zip(rows["block"], rows["n"], ends)]
        out.append((label, int(key[0]), None, int((total > 0).sum()), b""))
        return pd.DataFrame(out, columns=["orders", "part", "block", "n", "more"])

    return asked.groupBy("part").applyInPandas(add_up, "orders int, part int, block string, n long, more binary")


class Automaton:
    """The part of the backoff automaton that a block's texts can reach.

    States are the root (0) and the contexts, arcs the n-grams; the arc of a state of length k - 1
    for the word at a place is that of the n-gram of length k that ends there."""

    def __init__(self, grams: _Grams, total: dict[int, np.ndarray], n: int, v: int, lower: dict[int, float]):
        self.grams, order = grams, grams.order
        at, some = grams.at, grams.some
        self.first_state = np.cumsum([1, *[len(some[k]) for k in range(1, order)]]).tolist()  # of the contexts of k words at k - 1
        self.first_arc = np.cumsum([0, *[len(some[k]) for k in range(1, order + 1)]])
        real = {k: (total[k] > 0) & ~(grams.token[some[k]] & (grams.w[some[k]] == grams.end)) for k in range(1, order)}
        lengths, fail, fail_weight, has, weight, goal = [[0]], [[0]], [[0.0]], [], [], []
        p = (total[1] + ADD) / (n + ADD * (v + 1))
        for k in range(1, order + 1):
            end = some[k]
            if k > 1:
                context = total[k - 1][at[k - 1][end - 1]]
                p = (total[k] + lower[k - 1] * p[at[k - 1][end]]) / (context + lower[k - 1])
            has.append(grams.token[end] if k == 1 else total[k] > 0)  # the root takes every word
            weight.append(np.log10(p))
            best = np.zeros(len(end), np.int32)  # the longest context that the word leads to
            for j in range(1, min(k, order - 1) + 1):
                got = at[j][end]
                best = np.where(real[j][got], self.first_state[j - 1] + got, best).astype(np.int32)
            goal.append(best)
            if k < order:
                lengths.append(np.full(len(end), k, np.int8))
                fail.append(self.first_state[k - 2] + at[k - 1][end] if k > 1 else np.zeros(len(end), np.int32))
                fail_weight.append(np.log10(lower[k] / (total[k] + lower[k])))
        self.lengths, self.fail, self.fail_weight = np.concatenate(lengths).astype(np.int8), np.concatenate(fail).astype(np.int32), np.concatenate(fail_weight)
        self.has, self.weight, self.goal = np.concatenate(has), np.concatenate(weight), np.concatenate(goal)
        self.arc = np.stack([at[k] + np.int32(self.first_arc[k - 1]) for k in range(1, order + 1)])  # by length and place
        self.start = 0  # the state after the start marks, of which every text has the same
        for j in range(1, order):
            mark = at[j][grams.firsts[0] - 1] if len(grams.firsts) else 0
            if len(grams.firsts) and real[j][mark]:
                self.start = self.first_state[j - 1] + int(mark)

    def read(self) -> np.ndarray:
        """log10 probability of every text of the block: all texts are read side by side, token by token."""
        sizes = self.grams.sizes
        by = np.argsort(-sizes, kind="stable")
        first, sizes = self.grams.firsts[by], sizes[by]
        state, score = np.full(len(by), self.start, np.int32), np.zeros(len(by))
        alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")  # texts of more than t tokens
        for t, n in enumerate(alive.tolist()):
            place = first[:n] + t
            arc = self.arc[self.lengths[state[:n]], place]
            hit = self.has[arc]
            if not hit.all():  # failure arcs, until the state has one for the word
                off = np.flatnonzero(~hit)
                while off.size:
                    score[off] += self.fail_weight[state[off]]
                    state[off] = self.fail[state[off]]
                    arc[off] = self.arc[self.lengths[state[off]], place[off]]
                    off = off[~self.has[arc[off]]]
            score[:n] += self.weight[arc]
            state[:n] = self.goal[arc]
        out = np.empty(len(by))
        out[by] = score
        return out


def _totals(grams: _Grams, orders: tuple[int, ...], bits: int, answers: list[tuple[int, int, bytes]]) -> dict[int, np.ndarray]:
    """Counts over all blocks of the block's n-grams of these lengths, from ``(part, n, more)``."""
    by = grams.asked(orders, bits)[1]
    total = np.concatenate([grams.own[k] for k in orders]).astype(np.int64)
    total[by] += np.concatenate([_unpack(more, np.int64, n) for _, n, more in sorted(answers)])
    out, at = {}, 0
    for k in orders:
        out[k] = total[at:at + len(grams.own[k])]
        at += len(out[k])
    return out


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                lower: dict[int, float] | None = None, block_tokens: int = BLOCK_TOKENS, part_keys: int = PART_KEYS) -> DataFrame:
    """One row per row of ``docs``: ``id_col, learnt, n_tokens, n_known, train_tokens, train_words, base_score, score``."""
    lower = {**LOWER, **(lower or {})}
    if order < 2 or any(k not in lower for k in range(1, order)):
        raise ValueError("an order of 2 or more, with a weight for every shorter context")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("binary").alias("_text"), train.alias("_train"))
    kind = rows.schema["_id"].dataType.simpleString()
    blocks = token_blocks(rows, block_tokens)
    n, words, tokens = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("learnt", "words", "n")]).first()
    longer = tuple(range(2, order + 1))
    most = max(1, (order - 1) * (tokens + words))  # keys that blocks can ask for
    bits = min(64, max(40, 2 * most.bit_length() - 1))
    single = shared_table(_answer(_ask(blocks, (1,), 64, 1 + words // part_keys), (1,)), "lm-words")
    v = max(0, (single.filter("block is null").agg(F.sum("n")).first()[0] or 0) - 1)  # the start mark is no token
    answers = single.unionByName(_answer(_ask(blocks, longer, bits, 1 + most // part_keys), longer)).filter("block is not null")
    form = f"{id_col} {kind}, learnt boolean, n_tokens long, n_known long, train_tokens long, train_words long, base_score double, score double"

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = _Grams({f: left.column(f)[0].as_py() for f, _ in _FIELDS}, order)
        got = list(zip(right.column("orders").to_pylist(), right.column("part").to_pylist(), right.column("n").to_pylist(), right.column("more").to_pylist()))
        total = _totals(grams, (1,), 64, [a[1:] for a in got if a[0] == 1]) | _totals(grams, longer, bits, [a[1:] for a in got if a[0] > 1])
        grams.key = grams.own = got = None  # large
        m, numbers = len(grams.sizes), grams.at[1][grams.places]
        text = np.repeat(np.arange(m), grams.sizes)
        known = np.bincount(text, weights=(total[1] > 0)[numbers], minlength=m).astype(np.int64)
        base = np.bincount(text, weights=np.log10((total[1] + ADD) / (n + ADD * (v + 1)))[numbers], minlength=m)
        del text, numbers
        score = Automaton(grams, total, n, v, lower).read()
        out = [left.column("ids").combine_chunks().flatten(), pa.array(grams.train), pa.array(grams.sizes), pa.array(known), pa.array(np.full(m, n)),
               pa.array(np.full(m, v)), pa.array(base), pa.array(score)]
        return pa.Table.from_arrays(out, names=[id_col, "learnt", "n_tokens", "n_known", "train_tokens", "train_words", "base_score", "score"])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(read, form)
