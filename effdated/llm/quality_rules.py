"""Quality rules (operator 9): risk-controlled thresholds, DataFrame functions only.

Each rule compares one integer ratio of a text (per mille) with a cutoff. Cutoffs are
learnt per stratum (language) from labelled texts:

1. *Fit half* of the labels: per (stratum, rule) pick from a fixed grid the cutoff with
   the best utility, rejected low-quality texts minus ``CLEAN_COST`` x rejected clean ones. The picks
   of positive utility are put in order, the most useful first.
2. *Holdout half*: for the first, the first two, ... picks of a stratum together, the exact binomial
   test asks whether "more than ``max_false_rejection`` of this stratum's clean texts are rejected by any of
   them" can be ruled out at level ``error / strata``. The longest list that passes with all
   shorter ones is used (fixed-sequence testing within a stratum, Bonferroni over strata).

So with probability 1 - error, the rules in use *together* reject at most ``max_false_rejection``
of the clean texts of every stratum. A stratum with too few labels for the guarantee
gets no cutoff; only the base rule judges it.

Null texts count as empty (no words, base rule fails); a null stratum is a stratum of its
own; conflicting labels of one id count as low quality; null ids and null labels are
not used for learning. Repeated rows give repeated result rows. An empty table or
empty labels give no cutoffs. Equal utilities: the greater cutoff, then the rule's name decides. Very long
texts are measured whole. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, UPPER, let, packed, shared_table, unpacked

#: Symbols counted by the base figures (fixed values).
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CLEAN_COST = 20
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
#: Rule: cutoffs in per mille, tried as "value >= cutoff".
GRID = {
    "symbols": [5, 10, 20, 50, 100, 200, 300],
    "upper": [100, 150, 200, 300, 400, 500, 600],
    "repeats": [100, 150, 200, 250, 300, 350, 400, 450],
    "dup_lines": [100, 200, 300, 400, 500, 600, 700],
    "long_words": [7000, 8000, 9000, 10000, 12000, 15000],
    "short_words": [250, 275, 300, 350, 400, 500],
}
_WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _repeat_words(hashes: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are compared by a 64-bit hash. Sorting (hash, position) puts equal windows
    side by side; each position of a repeated window covers itself and the next two.
    """
    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - 2),
                          lambda i: F.xxhash64(F.element_at(hashes, i), F.element_at(hashes, i + 1), F.element_at(hashes, i + 2)))

    def covered(keys: Column) -> Column:
        pairs = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def count(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["k"] == x["k"], F.lit(False))
            hit = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
            start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
            step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
            return F.aggregate(F.sort_array(F.transform(hit, lambda x: x["i"])), start, step, lambda a: a["n"])

        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(let(pairs, count))

    return F.when(F.size(hashes) < 4, F.lit(0).cast("long")).otherwise(let(windows, covered))


def text_figures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_f``, a struct of the base figures, ``base_failed`` and the rules' ratios."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.withColumn("_t", F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    out = out.withColumn("_w", F.array_remove(F.split("_t", _WORD_BREAK), "")).withColumn(
        "_l", F.filter(F.split("_t", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != ""))
    long = lambda c: c.cast("long")
    out = out.select(
        *own, long(F.size("_w")).alias("_words"), long(_without(F.col("_t"), SPACES)).alias("_chars"),
        long(F.length("_t") - _without(F.col("_t"), SYMBOLS)).alias("_symbols"),
        long(F.size("_l") - F.size(F.array_distinct("_l"))).alias("_dups"),
        let(F.transform("_w", lambda w: F.xxhash64(w)), _repeat_words).alias("_repeats"),
        long(F.length("_t") - _without(F.col("_t"), UPPER)).alias("_upper"), long(F.size("_l")).alias("_lines"))
    per_mille = lambda a, b: F.when(F.col(b) > 0, F.expr(f"(1000 * {a}) div {b}")).otherwise(F.lit(0).cast("long"))
    ratios = F.struct(per_mille("_symbols", "_chars").alias("symbols"), per_mille("_upper", "_chars").alias("upper"),
                      per_mille("_repeats", "_words").alias("repeats"), per_mille("_dups", "_lines").alias("dup_lines"),
                      per_mille("_chars", "_words").alias("long_words"), per_mille("_words", "_chars").alias("short_words"))
    failed = (F.col("_words") < MIN_WORDS) | (100 * F.col("_repeats") > MAX_REPEAT_PERCENT * F.col("_words"))
    return out.select(*own, F.struct(
        F.col("_words").alias("n_words"), F.col("_chars").alias("word_chars"), F.col("_symbols").alias("n_symbols"),
        F.col("_dups").alias("n_dup_lines"), F.col("_repeats").alias("n_repeat_words"), failed.alias("base_failed"),
        ratios.alias("ratios")).alias("_f"))


def _lgamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 8, taken back by the recurrence."""
    z = x + F.lit(8.0)
    back = x
    for i in range(1, 8):
        back = back * (x + F.lit(float(i)))
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - F.log(back)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p) and k <= n p; 1 for larger k.

    Terms fall off below k, so those more than 60 standard deviations below are zero in
    doubles and are not summed: the work per test grows with sqrt(n).
    """
    kd, nd = k.cast("double"), n.cast("double")
    first = F.greatest(F.lit(0), F.floor(kd - 60 * F.sqrt(nd * p * (1 - p)) - 200)).cast("long")
    term = lambda i: F.exp(_lgamma(nd + 1) - _lgamma(i + 1) - _lgamma(nd - i + 1) + i * math.log(p) + (nd - i) * math.log1p(-p))
    total = F.aggregate(F.sequence(first, k), F.lit(0.0), lambda a, i: a + term(i.cast("double")))
    return F.when(kd <= nd * p, total).otherwise(F.lit(1.0))


def _stratum(column: str) -> Column:
    """Strata as text: null is one of its own, apart from an empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`")), F.lit(""))


def _value(ratios: Column, rule: Column) -> Column:
    return F.coalesce(*[F.when(rule == r, ratios[r]) for r in GRID])


def learn_cutoffs(figures: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang",
                  max_false_rejection: float = 0.01, error: float = 0.05) -> DataFrame:
    """``_stratum, rule, cutoff`` of the rules in use.

    ``labels``: ``id_col, quality`` (1 clean, 0 low). Only aggregated counts (strata x
    grid, then strata x rules) leave the aggregations.
    """
    quality = (labels.select(F.col(f"`{id_col}`").alias("_id"), F.col("quality").alias("_q"))
               .filter("_id IS NOT NULL AND _q IS NOT NULL").groupBy("_id").agg(F.min("_q").alias("_q")))
    labelled = (figures.filter("NOT _f.base_failed").select(F.col(f"`{id_col}`").alias("_id"), _stratum(stratum_col).alias("_stratum"), F.col("_f.ratios").alias("_r"))
                .join(quality, "_id")
                .select("_stratum", (F.substring(F.md5(F.col("_id").cast("string").cast("binary")), 1, 1) < "8").alias("_fit"), (F.col("_q") > 0).alias("_clean"), "_r"))
    labelled = shared_table(labelled, "quality-labelled")
    grid = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("cutoff"), (F.col("_r")[rule] >= c).alias("rejected"))
                     for rule, cutoffs in GRID.items() for c in cutoffs])
    tried = labelled.filter("_fit").select("_stratum", "_clean", F.explode(grid).alias("g")).select("_stratum", "_clean", "g.*").filter("rejected")
    utility = F.count_if(~F.col("_clean")) - CLEAN_COST * F.count_if(F.col("_clean"))
    picked = (tried.groupBy("_stratum", "rule", "cutoff").agg(utility.alias("u")).groupBy("_stratum", "rule")
              .agg(F.max(F.struct("u", "cutoff")).alias("b")).select("_stratum", "rule", "b.*").filter("u > 0"))
    first = Window.partitionBy("_stratum").orderBy(F.desc("u"), "rule")  # a handful of rules a stratum
    picked = shared_table(picked.withColumn("place", F.row_number().over(first)), "quality-picked")
    # of every clean holdout text the first pick that rejects it
    table = picked.agg(F.collect_list(F.struct("_stratum", "rule", "cutoff", "place")).alias("_cuts"))
    hits = F.filter("_cuts", lambda c: (c["_stratum"] == F.col("_stratum")) & (_value(F.col("_r"), c["rule"]) >= c["cutoff"]))
    holdout = labelled.filter("NOT _fit AND _clean").withColumn("_cuts", table.scalar())
    lost = holdout.select("_stratum", F.array_min(F.transform(hits, lambda c: c["place"])).alias("at")).groupBy("_stratum", "at").agg(F.count(F.lit(1)).alias("_c"))
    counts = (picked.join(lost, "_stratum", "left").groupBy("_stratum", "rule", "cutoff", "place")
              .agg(F.coalesce(F.sum(F.when(F.col("at") <= F.col("place"), F.col("_c"))), F.lit(0)).alias("_k"), F.coalesce(F.sum("_c"), F.lit(0)).alias("_n")))
    strata = picked.agg(F.count_distinct("_stratum").alias("n")).scalar()
    passes = (F.col("_n") > 0) & (binomial_cdf(F.col("_k"), F.col("_n"), max_false_rejection) * F.col("_strata") <= error)
    so_far = Window.partitionBy("_stratum").orderBy("place")
    return (counts.withColumn("_strata", strata).withColumn("_all", F.min(passes).over(so_far)).filter("_all").select("_stratum", "rule", "cutoff"))


def judge(figures: DataFrame, cutoffs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """Add ``_kept`` to the figures. The cutoffs travel as one array of at most strata x
    rules entries, so that no row is shuffled whatever the share of its stratum."""
    table = cutoffs.agg(F.collect_list(F.struct("_stratum", "rule", "cutoff")).alias("_cuts"))
    stratum = _stratum(stratum_col)
    rejected = F.exists("_cuts", lambda c: (c["_stratum"] == stratum) & (_value(F.col("_f")["ratios"], c["rule"]) >= c["cutoff"]))
    return figures.withColumn("_cuts", table.scalar()).withColumn("_kept", ~F.col("_f")["base_failed"] & ~rejected).drop("_cuts")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                  max_false_rejection: float = 0.01, error: float = 0.05) -> DataFrame:
    """``id_col, stratum_col``, the base figures, ``base_failed`` and ``kept`` per row of ``docs``."""
    named = docs.select(F.col(f"`{id_col}`"), F.col(f"`{stratum_col}`"), F.col(f"`{text_col}`"))
    figures = shared_table(text_figures(named, text_col).drop(text_col), "quality-figures")
    cutoffs = shared_table(learn_cutoffs(figures, labels, id_col, stratum_col, max_false_rejection, error), "quality-cutoffs")
    return judge(figures, cutoffs, stratum_col).select(
        id_col, stratum_col, *[F.col("_f")[c].alias(c) for c in FIGURES], F.col("_kept").alias("kept"))


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                  max_false_rejection: float = 0.01, error: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. The figures are
    written beside the rows, so no text is measured twice and none is shuffled."""
    rows = packed(docs, id=id_col, stratum=stratum_col, text=text_col)
    figures = shared_table(text_figures(rows).drop("text"), "quality-figures")
    named = labels.select(F.col(f"`{id_col}`").alias("id"), "quality")
    cutoffs = shared_table(learn_cutoffs(figures, named, "id", "stratum", max_false_rejection, error), "quality-cutoffs")
    return unpacked(judge(figures, cutoffs, "stratum").filter("_kept"))
