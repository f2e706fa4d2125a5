"""Language ID (operator 4): a byte convolutional network, trained and applied in numpy.

Network: byte embedding, filters of widths 2, 3 and 4, ReLU, max pooling over a window of
``WINDOW`` bytes, softmax. It is trained on the driver on a bounded sample (at most
``MAX_DOCS`` labelled texts, dealt evenly over the languages, one stretch of
``STRETCH`` characters from a hash-chosen place of each). Tasks apply it to *all* windows
of every whole text in fixed-size batches; a text's language has the largest mean
probability over its windows, weighted by the bytes in them, and that mean is the score.

Applied to fixed windows, a filter response is a sum of one table entry per byte pair,
so embedding and filters are folded into lookup tables.

``und`` with score 0 if the text is null or has no letter, or if nothing was learnt. Null
ids and labels are not learnt from. Repeated rows give repeated rows; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS, EMBEDDING = 16, 8
MAX_DOCS, STRETCH = 6000, 512
EPOCHS, BATCH, RATE = 6, 64, 4e-3
UNKNOWN = "und"
#: Windows that a task looks at together.
_BLOCK = 256


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased text's UTF-8 bytes as rows of ``WINDOW`` (zero-padded), and the bytes in each."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(raw)] = raw
    sizes = np.full(n, WINDOW, np.int64)
    sizes[-1] = max(1, len(raw) - (n - 1) * WINDOW)
    return out.reshape(n, WINDOW), sizes


def _shifted(x: np.ndarray, j: int) -> np.ndarray:
    """Bytes j places later in the window, zero beyond its end."""
    if not j:
        return x
    out = np.zeros_like(x)
    out[:, :-j] = x[:, j:]
    return out


def train(x: np.ndarray, y: np.ndarray, n_classes: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on cross-entropy; ``x``: windows, ``y``: class numbers."""
    rng = np.random.default_rng(seed)
    p = {"e": rng.normal(0, 0.5, (256, EMBEDDING))}
    for w in WIDTHS:
        p[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    p["o"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, n_classes))
    p["c"] = np.zeros(n_classes)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v2, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            xb, yb = x[order[at : at + BATCH]], y[order[at : at + BATCH]]
            n, g = len(xb), {}
            p["e"][0] = 0  # padding
            places = np.stack([_shifted(xb, j) for j in range(max(WIDTHS))], axis=2)
            embedded = p["e"][places]  # n, window, 4, embedding
            pooled, best = [], []
            for w in WIDTHS:
                r = embedded[:, :, :w].reshape(n, WINDOW, -1) @ p[f"f{w}"]
                best.append(r.argmax(axis=1))
                pooled.append(np.maximum(r.max(axis=1) + p[f"b{w}"], 0))
            h = np.concatenate(pooled, axis=1)
            z = h @ p["o"] + p["c"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            d = z / z.sum(axis=1, keepdims=True)
            d[np.arange(n), yb] -= 1
            d /= n
            g["o"], g["c"] = h.T @ d, d.sum(axis=0)
            dh = (d @ p["o"].T) * (h > 0)
            de = np.zeros_like(p["e"])
            for k, w in enumerate(WIDTHS):
                dw = dh[:, k * FILTERS : (k + 1) * FILTERS]
                rows = np.arange(n)[:, None]
                seen = embedded[rows, best[k], :w].reshape(n, FILTERS, -1)  # what each filter's maximum saw
                g[f"f{w}"], g[f"b{w}"] = np.einsum("nfk,nf->kf", seen, dw), dw.sum(axis=0)
                back = (dw[:, :, None] * p[f"f{w}"].T[None]).reshape(n, FILTERS, w, EMBEDDING)
                np.add.at(de, places[rows, best[k], :w], back)
            g["e"] = de
            t += 1
            for key, grad in g.items():
                m[key] = 0.9 * m[key] + 0.1 * grad
                v2[key] = 0.999 * v2[key] + 0.001 * grad * grad
                p[key] -= RATE * (m[key] / (1 - 0.9**t)) / (np.sqrt(v2[key] / (1 - 0.999**t)) + 1e-8)
    p["e"][0] = 0
    return p


def _tables(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Responses per byte pair: bytes 0+1 for all filters, byte 2 for width 3, bytes 2+3 for width 4."""
    part = lambda w, j: p["e"] @ p[f"f{w}"][j * EMBEDDING : (j + 1) * EMBEDDING]
    pair = lambda a, b: (a[None, :, :] + b[:, None, :]).reshape(65536, -1)  # index: first + 256 * second
    first = np.concatenate([pair(part(w, 0), part(w, 1)) for w in WIDTHS], axis=1)
    return first.astype(np.float32), part(3, 2).astype(np.float32), pair(part(4, 2), part(4, 3)).astype(np.float32), np.concatenate([p[f"b{w}"] for w in WIDTHS])


def predict(x: np.ndarray, p: dict[str, np.ndarray], tables=None) -> np.ndarray:
    """Class probabilities of windows, ``_BLOCK`` at a time."""
    first, third, last, bias = tables or _tables(p)
    out = []
    for at in range(0, len(x), _BLOCK):
        b = x[at : at + _BLOCK]
        padded = np.zeros((len(b), WINDOW + 3), np.int32)
        padded[:, :WINDOW] = b
        pairs = padded[:, :-1] + 256 * padded[:, 1:]
        r = first.take(pairs[:, :WINDOW], axis=0)
        r[:, :, FILTERS : 2 * FILTERS] += third.take(padded[:, 2 : WINDOW + 2], axis=0)
        r[:, :, 2 * FILTERS :] += last.take(pairs[:, 2 : WINDOW + 2], axis=0)
        h = np.maximum(r.max(axis=1) + bias, 0)
        z = h @ p["o"] + p["c"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        out.append(z / z.sum(axis=1, keepdims=True))
    return np.concatenate(out)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[dict[str, np.ndarray], list[str]] | None:
    """Network and languages learnt from the rows that are not held out; None without any."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.col(f"`{lang_col}`").alias("_lang"))
    rows = rows.filter("_id IS NOT NULL AND _lang IS NOT NULL AND _text <> ''").filter(~held_out(F.col("_id")))
    counts = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}  # a row per language
    if not counts:
        return None
    langs = sorted(counts)
    quota = max(1, MAX_DOCS // len(langs))
    unit = 1 << 20
    share = F.create_map(*[c for k in langs for c in (F.lit(k), F.lit(min(unit, max(1, 2 * quota * unit // counts[k]))))])
    h = F.xxhash64("_id", F.lit("lang"))
    sample = rows.filter(F.pmod(h, F.lit(unit)) < F.element_at(share, F.col("_lang")))
    start = F.pmod(F.shiftright(h, 20), F.greatest(F.length("_text") - STRETCH, F.lit(1))) + 1
    sample = sample.select("_lang", h.alias("_h"), F.substring(F.col("_text"), start.cast("int"), F.lit(STRETCH)).alias("_text"))
    got = sample.orderBy("_h", "_lang").limit(2 * MAX_DOCS).collect()  # at most 2 x MAX_DOCS short texts
    xs, ys, taken = [], [], dict.fromkeys(langs, 0)
    for r in got:
        if taken[r["_lang"]] < quota:
            taken[r["_lang"]] += 1
            x, sizes = windows(r["_text"])
            x = x[sizes >= min(WINDOW // 4, int(sizes.max()))]
            xs.append(x)
            ys.append(np.full(len(x), langs.index(r["_lang"])))
    return train(np.concatenate(xs), np.concatenate(ys), len(langs)), langs


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col, held_out, lang_pred, score`` per row of ``docs``."""
    model = learn(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), held_out(F.col(f"`{id_col}`")).alias("_held"), F.col(f"`{text_col}`").alias("_text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few dozen KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, langs = sent.value or ({}, [])
        tables = _tables(p) if langs else None

        def probabilities(xs: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
            """Mean per text; ``np.add.reduceat`` over the texts' first windows."""
            counts = np.array([len(s) for s in sizes])
            weights = np.concatenate(sizes).astype(np.float64)
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            each = predict(np.concatenate(xs), p, tables) * weights[:, None]
            return np.add.reduceat(each, starts) / np.add.reduceat(weights, starts)[:, None]

        for batch in batches:
            n = batch.num_rows
            names, scores = [UNKNOWN] * n, np.zeros(n)
            held: list[int] = []
            xs: list[np.ndarray] = []
            sizes: list[np.ndarray] = []
            waiting = 0

            def flush():
                if held:
                    means = probabilities(xs, sizes)
                    for i, k, s in zip(held, means.argmax(axis=1).tolist(), means.max(axis=1).tolist()):
                        names[i], scores[i] = langs[k], min(1.0, s)
                    held.clear(), xs.clear(), sizes.clear()

            for i in range(n):
                text = batch.column(2)[i].as_py()
                if langs and text and _has_letter(text):
                    x, s = windows(text)
                    held.append(i), xs.append(x), sizes.append(s)
                    waiting += len(s)
                    if waiting >= 4096:
                        flush()
                        waiting = 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names), pa.array(scores)], names=["_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "_id long, held_out boolean, lang_pred string, score double").withColumnRenamed("_id", id_col)
