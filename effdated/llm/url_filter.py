"""URL filters (operator 7): domain rules, and a character language-model ratio for the rest.

DataFrame functions only. Rules (host suffix and path prefix, the longest wins) decide
what they fit. For all other URLs two smoothed variable-order Markov models, of the URLs
that rules allow and of those they block, are compared: a URL is blocked if its log
likelihood per character under the first less that under the second is below a cutoff.
The cutoff is calibrated on rule-decided URLs kept out of training: of the scores that
block at most ``ACCEPTED_LOSS`` of the allowed ones, the one with the best sum of both rates.

Models: counts of all character runs of length 1 to ``ORDER`` + 1, without a cap. The
probability of a character is interpolated from the empty context up:
p_k = (n(context, c) + SMOOTH * p_(k-1)) / (n(context) + SMOOTH). Its log ratio depends on the window of
the character and the ``ORDER`` before it, and is computed once per distinct window, by joins. The
``MAX_RUNS`` most used windows are one scalar subquery of bounded size, looked up in the row; URLs with other windows join them.

Null URLs and URLs without "://" have empty host and path and fit no rule; null counts as an
empty text for the model. Without URLs of both kinds everything else is allowed.
Repeated rows, null ids and extra columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, hash_get, hash_table, let, shared_table

ORDER = 4
SMOOTH = 2.0
#: Windows that are looked up in the row; all others are joined.
MAX_RUNS = 50_000
BUCKETS = 1 << 15
ALPHABET = 256.0
ACCEPTED_LOSS = 0.05
#: Scores are compared in units of 1/SCALE nat per character.
SCALE = 10_000
#: A window's ratio is summed in units of 1/UNIT nat: sums are exact in any order.
UNIT = 1 << 36
START, STOP = "\x02", "\x03"


def host_and_path(url: Column) -> tuple[Column, Column]:
    known = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    rest = F.substring_index(url, "://", 1)
    rest = F.substring(url, F.length(rest) + 4, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def apply_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` columns. ``rules``: ``("block" | "allow", "host/path")``; of rules of equal
    length the first in the list wins."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        at, slash, prefix = text.partition("/")
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(slash + prefix))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _characters(url: Column) -> Column:
    text = F.translate(F.coalesce(url, F.lit("")), UPPER + START + STOP, LOWER)
    return F.concat(F.array(*[F.lit(START)] * ORDER), F.array_remove(F.split(text, ""), ""), F.array(F.lit(STOP)))


def _run(chars: Column, at: Column, k: int) -> Column:
    """The character at 0-based ``at`` with the ``k`` before it."""
    return F.concat(*[F.get(chars, at - j) for j in range(k, -1, -1)])


def _positions(chars: Column) -> Column:
    return F.sequence(F.lit(ORDER), F.size(chars) - 1)


def count_runs(urls: DataFrame) -> DataFrame:
    """``_chars, _ok`` to ``r, a, b, uses, ma, mb``: all runs with their counts in allowed and blocked URLs,
    their uses in URLs to be scored (``_ok`` is null), and both counts of the context before the last character.

    A context's count is that of the runs which go one character further. Rows that share a
    context differ in one character, so no group is larger than the alphabet.
    """
    each = F.flatten(F.transform(_positions(F.col("_chars")), lambda i: F.array(*[_run(F.col("_chars"), i, k) for k in range(ORDER + 1)])))
    n = lambda c: F.count(F.when(c, 1))
    runs = urls.select("_ok", F.explode(each).alias("r")).groupBy("r").agg(
        n(F.col("_ok")).alias("a"), n(~F.col("_ok")).alias("b"), n(F.col("_ok").isNull()).alias("uses"))
    context = Window.partitionBy(F.expr("substring(r, 1, length(r) - 1)"))
    return shared_table(runs.withColumns({"ma": F.sum("a").over(context), "mb": F.sum("b").over(context)}), "url-runs")


def window_scores(runs: DataFrame) -> DataFrame:
    """``w, uses, v``: per window (a character and the ORDER before it) that is used, its log likelihood ratio in
    1/UNIT. Each order joins the next lower one on all but the first character, so keys have few rows."""
    lower = None
    for k in range(ORDER + 1):
        rows = runs.filter((F.length("r") == k + 1) & (F.col("uses") > 0))
        if lower is None:
            rows = rows.withColumns({"qa": F.lit(1 / ALPHABET), "qb": F.lit(1 / ALPHABET)})
        else:
            rows = rows.withColumn("s", F.expr(f"substring(r, 2, {k})")).join(lower, "s")
        p = lambda x: ((F.col(x) + SMOOTH * F.col(f"q{x}")) / (F.col(f"m{x}") + SMOOTH)).alias(f"q{x}")
        lower = rows.select(F.col("r").alias("s"), "uses", p("a"), p("b"))
        if k < ORDER:
            lower = lower.drop("uses")
    ratio = F.log("qa") - F.log("qb")
    return shared_table(lower.select(F.col("s").alias("w"), "uses", F.round(ratio * UNIT).cast("long").alias("v")), "url-windows")


def _scored(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """``rows`` with ``_score`` instead of ``_chars``: log likelihood ratio per character, rounded to 1/SCALE; positive
    speaks for allowed.

    The ``MAX_RUNS`` most used windows are looked up in the row. A URL with any other window is joined with all
    its others; such a window, and so such a URL, is never hot.
    """
    hot = windows.orderBy(F.desc("uses"), "w").limit(MAX_RUNS)
    model = shared_table(hash_table(hot.select(F.xxhash64("w").alias("t"), F.col("v").alias("w")), BUCKETS), "url-model")
    each = F.transform(_positions(F.col("_chars")), lambda i: let(_run(F.col("_chars"), i, ORDER), lambda w: let(
        F.xxhash64(w), lambda h: let(hash_get(F.col("_table"), h, BUCKETS), lambda v: F.struct(v.alias("v"), F.when(v.isNull(), w).alias("w"))))))
    found = rows.withColumn("_table", model.select("table").scalar()).withColumn("_each", each).drop("_table")
    found = found.select(*[c for c in rows.columns if c != "_chars"], (F.size("_chars") - ORDER).alias("_n"),
                         F.aggregate("_each", F.lit(0).cast("long"), lambda t, x: t + F.coalesce(x["v"], F.lit(0).cast("long"))).alias("_sum"),
                         F.filter(F.transform("_each", lambda x: x["w"]), lambda w: w.isNotNull()).alias("_rare"))
    found = shared_table(found, "url-found")
    is_rare = F.coalesce(F.size("_rare"), F.lit(0)) > 0
    at = found.filter(is_rare).select("_rare").distinct()
    rest = (at.select("_rare", F.explode("_rare").alias("w")).join(windows.select("w", "v"), "w").groupBy("_rare").agg(F.sum("v").alias("_more")))
    full = found.filter(is_rare).join(rest, "_rare").withColumn("_sum", F.col("_sum") + F.col("_more")).drop("_more")
    out = full.select(*found.columns).unionByName(found.filter(~is_rare))
    return out.withColumn("_score", F.round(F.col("_sum") / UNIT / F.col("_n") * SCALE).cast("long")).drop("_sum", "_rare", "_n")


def _cutoff(scored: DataFrame) -> int | None:
    """Calibrate on ``_score, _ok``: counts per score leave the tasks, not rows."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    bins = scored.groupBy("_score").agg(n(F.col("_ok")).alias("a"), n(~F.col("_ok")).alias("b"))
    limits = F.struct(F.sum("a").alias("a"), F.sum("b").alias("b"))
    total = bins.agg(limits.alias("t")).first()["t"]
    if total["a"] is None or not total["a"] or not total["b"]:
        return None
    # scores lie within +- log(ALPHABET / smoothing) nats: a bounded number of bins
    rows = sorted((r["_score"], r["a"], r["b"]) for r in bins.collect())
    best, lost, caught = (0.0, rows[0][0]), 0, 0
    for k, (score, a, b) in enumerate(rows):
        if lost <= ACCEPTED_LOSS * total["a"]:  # block what lies below this score
            best = max(best, (caught / total["b"] - lost / total["a"], score))
        lost, caught = lost + a, caught + b
    return best[1]


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict, score`` per row; score is null where a rule decides."""
    url = F.col(f"`{url_col}`")
    host, path = host_and_path(url)
    named = pages.select(F.col(f"`{id_col}`").alias("_id"), url.alias("_url"), host.alias("_host"), path.alias("_path"))
    rule, verdict = apply_rules(F.col("_host"), F.col("_path"), rules)
    judged = shared_table(named.select("*", rule.alias("_rule"), verdict.alias("_verdict")), "url-judged")
    held = F.col("_rule").isNotNull() & F.coalesce(F.substring(F.md5(F.col("_url").cast("binary")), 1, 1) < "2", F.lit(False))
    judged = judged.withColumn("_held", held)
    ok = F.when(F.col("_rule").isNotNull() & ~F.col("_held"), F.col("_verdict") == "allow")
    runs = count_runs(judged.select(_characters(F.col("_url")).alias("_chars"), ok.alias("_ok")))
    open_rows = judged.withColumn("_chars", F.when(F.col("_rule").isNull() | F.col("_held"), _characters(F.col("_url")))).drop("_url")
    scored = shared_table(_scored(open_rows, window_scores(runs)), "url-scored")
    cutoff = _cutoff(scored.filter("_held").select("_score", (F.col("_verdict") == "allow").alias("_ok")))
    out = scored.withColumn("_score", F.when(F.col("_rule").isNull(), F.col("_score")))
    blocked = F.col("_score") < F.lit(cutoff) if cutoff is not None else F.lit(False)
    return out.select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
                      F.coalesce("_verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"), (F.col("_score") / SCALE).alias("score"))
