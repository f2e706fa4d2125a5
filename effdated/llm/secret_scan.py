"""Secret scans (operator 5): base patterns plus formats inferred as probabilistic automata.

1. One pass over whole texts finds the base spans (see ``PATTERNS``) and every other run of
   ``MIN_CANDIDATE`` or more credential characters, or what base spans leave of it. Only spans and these runs leave the task.
2. Grammar inference: per kind, at most ``MAX_LABELLED`` labelled credentials (the values of
   base spans, those with the least hash) build a prefix tree over their characters, whose
   statistically compatible states are merged, those of one depth only: the automaton stays acyclic, so
   it keeps literal prefixes, positions and lengths. Two states are compatible if the classes of the next
   ``LOOK`` characters and the characters left are distributed alike (Hoeffding bounds); states with
   less than ``MIN_EVIDENCE`` values cannot be told apart: those of one parent are one, then join the nearest. From ``MAX_DEPTH``
   characters on a state loops, so that values of any length are learnt whole.
3. Ordinary text is an automaton of character classes (state: the class before), counted over all runs
   but those that have a format of a single length.
4. Every run is scored by its best format. It becomes a span ``like_<kind>`` if the format gains ``MIN_GAIN``
   over ordinary text in log likelihood, and if its surprise beyond what the states passed lead to
   expect is neither above nor below that of the labelled ones by more than ``SLACK``.

Values that are also base spans of another kind are learnt as that kind only. Base spans are never
dropped. A kind with fewer than ``MIN_LABELLED`` labelled values gets no automaton. Null text counts
as empty and has no spans; very long texts are scanned whole, a run is scored until it cannot
pass. Of kinds that tie the first one counts. Null ids and repeated rows keep their rows; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TEXT_ROWS, shared_table

KINDS = ("assign", "access", "hex")
#: Base patterns with the least length of the value that counts (fixed values).
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
#: Words of which one stands in every assignment; a quick test before the pattern.
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
#: Candidates start at the least length of a labelled value.
MIN_CANDIDATE = MIN_ASSIGN
_RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % MIN_CANDIDATE)
MAX_LABELLED, MIN_LABELLED, MIN_EVIDENCE, MAX_DEPTH, LOOK = 400, 8, 12, 512, 4
MERGE_LEVEL = 0.05
#: Log likelihood that a format must gain over ordinary text, and what one odd character may cost.
MIN_GAIN, SLACK = 8.0, 10.0
#: Weight of an unseen stop in a state.
UNSEEN_STOP = 0.01
_STOP = "$"
#: Characters per class; every other one is a class of its own.
_CLASS_SIZE = {"0": 10, "a": 6, "g": 20, "A": 6, "G": 20}


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """``(start, kind, end, value)`` by start, then kind as in ``KINDS``; code points."""
    found = []
    if text:
        folded = text.lower()
        if any(w in folded for w in _ASSIGN_WORDS):
            found += [(m.start(), "assign", m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
        if "AKIA" in text:
            found += [(m.start(), "access", m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
        found += [(m.start(), "hex", m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def other_runs(text: str, base: list[tuple[int, str, int, str]]) -> list[tuple[int, int]]:
    """Runs of ``MIN_CANDIDATE`` or more credential characters, less what base spans take of them."""
    found, k, taken = [], 0, 0
    for m in _RUN.finditer(text):
        stop = m.end()
        at = max(m.start(), taken)
        while k < len(base) and base[k][0] < stop:  # base is in order of the starts
            if base[k][0] - at >= MIN_CANDIDATE:
                found.append((at, base[k][0]))
            taken, k = max(taken, base[k][2]), k + 1
            at = max(at, taken)
        if stop - at >= MIN_CANDIDATE:
            found.append((at, stop))
    return found


def class_of(c: str) -> str:
    """Digits, a-f, g-z, A-F, G-Z; other characters stand for themselves."""
    return "0" if c.isdigit() else "a" if "a" <= c <= "f" else "g" if "g" <= c <= "z" else "A" if "A" <= c <= "F" else "G" if "G" <= c <= "Z" else c


_CLASS = {chr(i): class_of(chr(i)) for i in range(128)}


class _State:
    """A state: how often each character follows, how often a value ends, and where characters lead."""

    def __init__(self):
        self.chars: dict[str, int] = {}
        self.stops = self.n = 0
        self.fixed = True  # all values passing have the same number of characters left
        self.next: dict[str, int] = {}

    def settle(self) -> None:
        """Costs (negative log probabilities) per character, class and stop, and their expectation. Unseen
        characters weigh as much as there are different ones (at least one), shared out by class."""
        by_class: dict[str, int] = {}
        for c, n in self.chars.items():
            by_class[_CLASS[c]] = by_class.get(_CLASS[c], 0) + n
        self.weight = max(1, len(self.chars))
        self.total, seen = self.n + self.weight + UNSEEN_STOP, sum(self.chars.values())
        spread = 0.2 * (len(_CLASS_SIZE) + 1)
        share = {k: (by_class.get(k, 0) + 0.2) / (seen + spread) / _CLASS_SIZE.get(k, 6) for k in (*_CLASS_SIZE, "")}
        share |= {k: (n + 0.2) / (seen + spread) for k, n in by_class.items() if k not in _CLASS_SIZE}
        self.share = {k: self.weight * v for k, v in share.items()}
        self.unseen = {k: -math.log(v / self.total) for k, v in self.share.items()}
        self.cost = {c: -math.log((n + self.share[_CLASS[c]]) / self.total) for c, n in self.chars.items()}
        # where all labelled values go on for as long, a value that ends does not have the format
        self.stop_cost = math.inf if self.fixed and not self.stops else -math.log((self.stops + UNSEEN_STOP) / self.total)
        kinds: dict[str, int] = {}
        for c in self.chars:
            kinds[_CLASS[c]] = kinds.get(_CLASS[c], 0) + 1
        rest = sum((size - kinds.get(k, 0)) * x * math.exp(-x) for k, size in _CLASS_SIZE.items() for x in (self.unseen[k],))
        stop = self.stop_cost * math.exp(-self.stop_cost) if self.stop_cost < math.inf else 0.0
        self.entropy = rest + stop + sum(x * math.exp(-x) for x in self.cost.values())
        most: dict[str, tuple[int, int]] = {}
        for c, t in self.next.items():
            for k in (_CLASS[c], ""):
                most[k] = max(most.get(k, (0, 0)), (self.chars[c], t))
        self.by_class = {k: t for k, (_, t) in most.items()}  # where an unseen character leads

    def without_one(self, c: str) -> float:
        """Cost of ``c`` had one value less passed here (``_STOP``: of the stop)."""
        n = self.stops + UNSEEN_STOP if c == _STOP else self.chars[c] + self.share[_CLASS[c]]
        return -math.log(max(n - 1, UNSEEN_STOP) / max(self.total - 1, 1))

    def step(self, c: str) -> tuple[float, int]:
        """Cost of ``c`` and the state after it (-1: none)."""
        got = self.cost.get(c)
        if got is not None:
            return got, self.next[c]
        k = _CLASS[c]
        return self.unseen.get(k, self.unseen[""]), self.by_class.get(k, self.by_class.get("", -1))


class Automaton:
    """Acyclic deterministic probabilistic automaton, merged from a prefix tree level by level."""

    def __init__(self, values: list[str], level: float = MERGE_LEVEL):
        self.states: list[_State] = []
        self.bound = math.sqrt(0.5 * math.log(2 / level))
        now, depth = [(self._new(), list(range(len(values))))], 0
        while now:
            groups: list[tuple[int, list[int]]] = []  # state of the next level, values
            for at, own in now:
                state = self.states[at]
                state.fixed = len({len(values[i]) for i in own}) == 1
                follow: dict[str, list[int]] = {}
                for i in own:
                    state.n += 1
                    if len(values[i]) == depth:
                        state.stops += 1
                    else:
                        follow.setdefault(values[i][depth], []).append(i)
                if depth == MAX_DEPTH:
                    self._loop(at, [values[i][depth:] for i in own])
                    continue
                state.chars = {c: len(x) for c, x in follow.items()}
                for symbols, x in self._siblings(follow):
                    near = min(((self._distance(values, depth + 1, x, y), k) for k, (_, y) in enumerate(groups)), default=((2.0, 2.0), -1))
                    if near[1] < 0 or near[0][0] > near[0][1]:
                        groups.append((self._new(), list(x)))
                        near = (near[0], len(groups) - 1)
                    else:
                        groups[near[1]][1].extend(x)
                    for c in symbols:
                        state.next[c] = groups[near[1]][0]
            now, depth = groups, depth + 1
        for state in self.states:
            state.settle()

    def _new(self) -> int:
        self.states.append(_State())
        return len(self.states) - 1

    @staticmethod
    def _siblings(follow: dict[str, list[int]]) -> list[tuple[list[str], list[int]]]:
        """Successors of a state, most values first; those without evidence are one."""
        strong = sorted(((c, x) for c, x in follow.items() if len(x) >= MIN_EVIDENCE), key=lambda f: (-len(f[1]), f[0]))
        weak = sorted((c, x) for c, x in follow.items() if len(x) < MIN_EVIDENCE)
        return [*(([c], x) for c, x in strong), *([([c for c, _ in weak], [i for _, x in weak for i in x])] if weak else [])]

    def _loop(self, at: int, rests: list[str]) -> None:
        state = self.states[at]
        for rest in rests:
            for c in rest:
                state.chars[c] = state.chars.get(c, 0) + 1
                state.next[c] = at
        state.fixed = False
        state.stops, state.n = len(rests), len(rests) + sum(map(len, rests))

    def _distance(self, values: list[str], depth: int, x: list[int], y: list[int]) -> tuple[float, float]:
        """Greatest difference between two groups of values, and up to which they are compatible: of the
        shares of a class at one of the next places (the end is a class), and of the distribution of
        the characters left. Two groups without evidence are never kept apart; one without is
        only if the other has nothing like it."""
        low = (len(x) < MIN_EVIDENCE) + (len(y) < MIN_EVIDENCE)
        limit = (self.bound * (1 / math.sqrt(len(x)) + 1 / math.sqrt(len(y))), 0.99, 2.0)[low]
        worst = 0.0
        for k in range(depth, depth + LOOK):
            p, q = (self._shares([_CLASS[values[i][k]] if k < len(values[i]) else _STOP for i in own]) for own in (x, y))
            worst = max([worst, *(abs(p.get(c, 0) - q.get(c, 0)) for c in p.keys() | q.keys())])
        p, q = (self._shares([len(values[i]) for i in own]) for own in (x, y))
        left = right = 0.0
        for n in sorted(p.keys() | q.keys()):
            left, right = left + p.get(n, 0), right + q.get(n, 0)
            worst = max(worst, abs(left - right))
        return worst, limit

    @staticmethod
    def _shares(items: list) -> dict:
        out: dict = {}
        for x in items:
            out[x] = out.get(x, 0) + 1
        return {k: n / len(items) for k, n in out.items()}

    def cost(self, value: str, most: float = math.inf) -> tuple[float, float]:
        """``(cost, surprise)``: negative log likelihood, the stop included, and how far it is above the
        entropies of the states passed. Given up (infinite) once the surprise is over ``most`` + the
        least that can still come back."""
        at, total, surprise = 0, 0.0, 0.0
        for c in value:
            if at < 0:
                return math.inf, math.inf
            state = self.states[at]
            cost, at = state.step(c)
            total += cost
            surprise += cost - state.entropy
            if surprise > most + 40:
                return math.inf, math.inf
        if at < 0:
            return math.inf, math.inf
        state = self.states[at]
        return total + state.stop_cost, surprise + state.stop_cost - state.entropy

    def own_surprise(self, value: str) -> float:
        """Surprise of a learnt value, each state without it (else learnt values would look too likely)."""
        at, surprise = 0, 0.0
        for c in value:
            state = self.states[at]
            surprise += state.without_one(c) - state.entropy
            at = state.next[c]
        return surprise + self.states[at].without_one(_STOP) - self.states[at].entropy

    def score(self, value: str) -> float:
        """Log likelihood per character, the stop included."""
        return -self.cost(value)[0] / (len(value) + 1)


class Ordinary:
    """Classes of ordinary runs: the state is the class of the character before (``^`` at first)."""

    def __init__(self, pairs: dict[tuple[str, str], int]):
        self.pairs, self.before = pairs, {}
        for (a, _), n in pairs.items():
            self.before[a] = self.before.get(a, 0) + n
        self.kinds = len({b for _, b in pairs} | {*_CLASS_SIZE, _STOP}) + 1
        self.known: dict[tuple[str, str], float] = {}

    def cost(self, value: str) -> float:
        total, a = 0.0, "^"
        for b in [*map(_CLASS.__getitem__, value), _STOP]:
            got = self.known.get((a, b))
            if got is None:
                got = -math.log((self.pairs.get((a, b), 0) + 0.5) / (self.before.get(a, 0) + 0.5 * self.kinds)) + math.log(_CLASS_SIZE.get(b, 1))
                self.known[a, b] = got
            total, a = total + got, b
        return total


def count_pairs(values: list[str]) -> dict[tuple[str, str], int]:
    """Pairs of neighbouring classes in runs, start and stop included."""
    out: dict[tuple[str, str], int] = {}
    for v in values:
        k = ["^", *map(_CLASS.__getitem__, v), _STOP]
        for pair in zip(k, k[1:]):
            out[pair] = out.get(pair, 0) + 1
    return out


def learn_automata(labelled: dict[str, list[str]]) -> dict[str, tuple[Automaton, float, float]]:
    """Automata per kind with the range of the labelled ones' surprise."""
    formats = {}
    for kind, values in labelled.items():
        if len(values) < MIN_LABELLED:
            continue
        automaton = Automaton(values)
        own = [automaton.own_surprise(v) for v in values]
        formats[kind] = (automaton, min(own) - SLACK, max(own) + SLACK)
    return formats


def is_strict(value: str, formats: dict[str, tuple[Automaton, float, float]]) -> bool:
    """Whether the value has a format of one length only: such runs say nothing about ordinary ones."""
    return any(a.states[0].fixed and least <= a.cost(value, most)[1] <= most for a, least, most in formats.values())


def learn_formats(labelled: dict[str, list[str]], runs: list[str]) -> dict:
    """Automata per kind, and the automaton of ordinary runs, from a list of runs."""
    formats = learn_automata(labelled)
    return {"ordinary": Ordinary(count_pairs([v for v in runs if not is_strict(v, formats)])), "formats": formats}


def like_kind(value: str, model: dict) -> str | None:
    """The kind whose format the value has, if any."""
    best, ordinary = None, None
    for kind, (automaton, least, most) in model["formats"].items():
        cost, surprise = automaton.cost(value, most)
        if least <= surprise <= most:
            ordinary = model["ordinary"].cost(value) if ordinary is None else ordinary
            if ordinary - cost > MIN_GAIN and (best is None or cost < best[0]):
                best = (cost, kind)
    return best and best[1]


_SPANS = "array<struct<start:long,kind:string,stop:long,value:string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, base, runs`` per row: base spans and the other long runs."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("stop", pa.int64()), ("value", pa.string())]))

    def one(text: str) -> tuple[list[dict], list[dict]]:
        base = base_spans(text)
        runs = [(i, "run", j, text[i:j]) for i, j in other_runs(text, base)]
        return tuple([dict(zip(("start", "kind", "stop", "value"), s)) for s in spans] for spans in (base, runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [one(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b for b, _ in both], kind), pa.array([r for _, r in both], kind)], names=["_id", "base", "runs"])

    return rows.mapInArrow(run, f"_id long, base {_SPANS}, runs {_SPANS}")


def _labelled(scanned: DataFrame) -> dict[str, list[str]]:
    """Distinct values per kind, at most MAX_LABELLED, those with the least hashes. A value that is a span
    of another pattern too (a hex key that is assigned) is learnt as that."""
    values = scanned.select(F.explode("base").alias("s")).select("s.kind", "s.value")
    own = (F.when(F.col("kind") != "assign", F.lit(False))
           .otherwise(F.col("value").rlike(f"^[0-9a-f]{{32,}}$") | F.col("value").rlike(f"^AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}$")))
    values = values.filter(~own).distinct()
    pick = lambda kind: [r["value"] for r in values.filter(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(MAX_LABELLED).collect()]
    return {k: pick(k) for k in KINDS}


def learn(scanned: DataFrame) -> dict:
    """The model of a scanned table: formats from a bounded sample of labelled values, ordinary runs from
    all of them, counted in tasks so that a few hundred pairs of classes leave each."""
    formats = learn_automata(_labelled(scanned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        pairs_of = lru_cache(100_000)(lambda v: () if is_strict(v, formats) else tuple(count_pairs([v]).items()))  # words come again
        for batch in batches:
            for value, n in Counter(batch.column(0).flatten().field("value").to_pylist()).items():
                for pair, k in pairs_of(value):
                    total[pair] += n * k
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in total], pa.string()), pa.array([b for _, b in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["a", "b", "n"])

    counts = scanned.select("runs").mapInArrow(run, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    pairs = {(r["a"], r["b"]): r["n"] for r in counts.collect()}  # one row per pair of classes
    return {"ordinary": Ordinary(pairs), "formats": formats}


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans`` per row: ``array<struct<start, kind, stop, value>>`` by start and kind."""
    scanned = shared_table(scan(docs, id_col, text_col), "secrets-scanned", TEXT_ROWS)
    model = learn(scanned)
    order = [*KINDS, *(f"like_{k}" for k in KINDS)]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # automata of at most a few thousand strings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_of = lru_cache(100_000)(lambda v: like_kind(v, sent.value))  # words come again
        for batch in batches:
            runs = batch.column(2)
            hits = [(k, kind) for k, v in enumerate(runs.flatten().field("value").to_pylist()) if (kind := kind_of(v))]
            spans = batch.column(1)
            if hits:  # few runs are: only then do lists become Python objects
                out = spans.to_pylist()
                ends = np.cumsum(runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                flat = runs.flatten()
                for k, kind in hits:
                    out[int(np.searchsorted(ends, k, "right"))].append(flat[k].as_py() | {"kind": f"like_{kind}"})
                spans = pa.array([sorted(row, key=lambda s: (s["start"], order.index(s["kind"]))) for row in out], spans.type)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], names=["_id", "spans"])

    # written in small batches: the lists of many rows at once take a Python task's memory
    return shared_table(scanned.mapInArrow(run, f"_id long, spans {_SPANS}"), "secrets-found", TEXT_ROWS).withColumnRenamed("_id", id_col)


def span_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, SHA-256 of the base spans, and all spans as text."""
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return found.select(
        id_col, *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(text(of(KINDS)).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(of(KINDS))).cast("long").alias("n_like"))
