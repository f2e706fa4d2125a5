"""Mixing sources to target weights (operator 10), DataFrame functions only.

1. *Posteriors.* A naive Bayes classifier over words and word endings is counted from at
   most ``MAX_LABELLED`` labelled rows (those with the least hash of their id). The at most
   ``MAX_TERMS`` terms that tell domains apart are kept by their 64-bit hash in a table of
   ``BUCKETS`` short lists, one scalar subquery; every document is scored in its own row,
   without join or shuffle.
2. *Rates.* Nonnegative rates r (how often a document is taken, at most ``max_rate``)
   minimise the sum over domains of (m - target)^2 / share, plus ``RIDGE`` x (r - 1)^2 by
   tokens, where m is a domain's expected share of the token budget. Posteriors are
   rounded to 1/``GRID``, so documents with equal posteriors have equal rates, and one
   small aggregation groups them. Each step of projected gradient descent aggregates the
   groups to one number per domain; only these numbers reach the driver, and the rate of
   a group or document is the replay of the steps so far.
3. *Copies.* floor(rate + u) with u in [0, 1) from a hash of id and text.

Null text counts as empty: no tokens and the prior as posterior. Null ids, repeated
rows and extra columns change nothing (rows are never joined by id, except for the
labels). Without labels the posterior is uniform. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_get, hash_table, let, packed, shared_table, unpacked

BUCKETS = 1 << 12
MAX_TERMS = 4096
MAX_LABELLED = 20_000
#: A term counts when its rows of some domain differ from their expected number by so
#: many standard deviations and the log ratio is at least MIN_WEIGHT (else the lengths of
#: a domain's documents would colour all common words); weights are cut off at MAX_WEIGHT.
MIN_DEVIATIONS, MIN_WEIGHT, MAX_WEIGHT = 5.0, 1.0, 4.0
GRID = 1000
RIDGE = 1e-3
STEPS, TOLERANCE = 60, 1e-4
_WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _WORD_BREAK), "")


def _terms(words: Column) -> Column:
    """Distinct 64-bit hashes of the lower-cased words and of their last two characters."""
    return F.array_distinct(F.concat(F.transform(words, lambda w: F.xxhash64(F.lower(w))),
                                     F.transform(words, lambda w: F.xxhash64(F.right(w, F.lit(2)), F.lit(2)))))


def learn_weights(docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row: ``prior`` (log, per domain, for a text without any of the terms) and ``weights``, an array of ``BUCKETS`` lists of
    ``(t, w)``, a term and its weight per domain; null for no term.

    ``labels``: ``id_col, domain``; of an id with several labels the greatest counts (toxic, low, clean).
    """
    sample = (labels.select(F.col(f"`{id_col}`").alias("_id"), F.col("domain")).filter(F.col("domain").isin(domains) & F.col("_id").isNotNull())
              .groupBy("_id").agg(F.max("domain").alias("domain")).orderBy(F.xxhash64("_id"), "_id").limit(MAX_LABELLED))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(F.broadcast(sample), "_id")
    # null stands for the row itself
    seen = rows.select("domain", F.explode(F.concat(F.array(F.lit(None).cast("long")), _terms(_words(F.col("_text"))))).alias("t"))
    wide = shared_table(seen.groupBy("t").agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"_n{i}") for i, d in enumerate(domains)]), "mixing-counts")
    k = len(domains)
    n = [F.col(f"_n{i}").cast("double") for i in range(k)]
    t = [F.col(f"_t{i}").cast("double") for i in range(k)]
    total = wide.filter("t IS NULL").agg(*[F.coalesce(F.max(f"_n{i}"), F.lit(0)).alias(f"_t{i}") for i in range(k)])
    all_n, all_t = sum(n[1:], n[0]), sum(t[1:], t[0])
    share = [(n[i] + 0.5) / (t[i] + 1.0) for i in range(k)]  # of a domain's documents that have the term
    overall = F.log((all_n + 0.5) / (all_t + 1.0))
    raw = [F.log(x) - overall for x in share]
    logit = [F.log(x / (1.0 - x)) for x in share]
    middle = sum(logit[1:], logit[0]) / float(k)
    odd = [F.abs(n[i] - all_n * t[i] / all_t) / F.sqrt(all_n * t[i] / all_t * (1 - t[i] / all_t) + 1) for i in range(k)]
    strong = F.lit(False)
    for w, deviations in zip(raw, odd):
        strong = strong | F.coalesce((deviations >= MIN_DEVIATIONS) & (F.abs(w) >= MIN_WEIGHT), F.lit(False))
    weight = F.array(*[F.greatest(F.lit(-MAX_WEIGHT), F.least(F.lit(MAX_WEIGHT), x - middle)) for x in logit])
    totals = {f"_t{i}": total.select(f"_t{i}").scalar() for i in range(k)}
    known = (wide.filter("t IS NOT NULL").withColumns(totals)
             .filter(strong).select("t", weight.alias("w"), F.array(*[F.log(1.0 - x) for x in share]).alias("_without"), F.greatest(*odd).alias("_odd"))
             .orderBy(F.desc("_odd"), "t").limit(MAX_TERMS))
    known = shared_table(known, "mixing-terms")
    dense = hash_table(known, BUCKETS).withColumnRenamed("table", "weights")
    absent = known.agg(*[F.coalesce(F.sum(F.get("_without", F.lit(i))), F.lit(0.0)).alias(f"_a{i}") for i in range(k)])
    prior = total.withColumns({f"_a{i}": absent.select(f"_a{i}").scalar() for i in range(k)}).select(
        F.array(*[F.log((x + 1.0) / (all_t + float(k))) + F.col(f"_a{i}") for i, x in enumerate(t)]).alias("prior"))
    return shared_table(dense.withColumn("prior", prior.scalar()), "mixing-model")


def posteriors(docs: DataFrame, model: DataFrame, domains: list[str], text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_tokens`` and ``_p``, the posterior per domain in units of 1/GRID."""
    k = len(domains)
    weights, prior = model.select("weights").scalar(), model.select("prior").scalar()
    zero = F.struct(*[F.lit(0.0).alias(f"s{i}") for i in range(k)])

    def add(a: Column, w: Column) -> Column:
        return F.struct(*[(a[f"s{i}"] + F.get(w, F.lit(i))).alias(f"s{i}") for i in range(k)])

    found = F.filter(F.transform(_terms(F.col("_words")), lambda h: hash_get(F.col("_weights"), h, BUCKETS)), lambda w: w.isNotNull())
    out = docs.withColumn("_words", _words(F.col(f"`{text_col}`"))).withColumn("_weights", weights).withColumn("_prior", prior)
    out = out.withColumn("_s", F.aggregate(found, zero, add))
    score = [F.get(F.col("_prior"), F.lit(i)) + F.col("_s")[f"s{i}"] for i in range(k)]
    top = F.greatest(*score, F.lit(-1e300))
    p = let(F.array(*[F.exp(s - top) for s in score]),
            lambda e: F.transform(e, lambda x: F.round(F.lit(GRID) * x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y)).cast("int")))
    return out.withColumn("_tokens", F.size("_words").cast("long")).withColumn("_p", p).drop("_words", "_weights", "_prior", "_s")


def _least(p: Column, kept: int | None, max_rate: float) -> Column:
    """The least rate: 1 for documents that are no likelier of another domain than of the kept one."""
    return F.when(F.get(p, F.lit(kept)) >= F.array_max(p), F.lit(min(1.0, max_rate))).otherwise(F.lit(0.0)) if kept is not None else F.lit(0.0)


def _replay(p: Column, history: list[list[float]], max_rate: float, kept: int | None = None) -> Column:
    """The rate after the steps in ``history`` (a gradient per domain each), starting from 1."""
    rate = F.lit(min(1.0, max_rate))
    if not history:
        return rate
    steps = F.array(*[F.array(*[F.lit(float(g)) for g in h]) for h in history])
    step = 1.0 / (1.0 + RIDGE)

    def one(r: Column, h: Column) -> Column:
        pull = F.aggregate(F.zip_with(p, h, lambda a, b: a * b / float(GRID)), F.lit(0.0), lambda a, x: a + x)
        return F.greatest(_least(p, kept, max_rate), F.least(F.lit(float(max_rate)), r - step * (pull + RIDGE * (r - 1.0))))

    return F.aggregate(steps, rate, one)


def fit_rates(scored: DataFrame, targets: dict[str, float], max_rate: float, budget: float | None = 1.0, keep: str | None = None) -> list[list[float]]:
    """Steps of projected gradient descent until the domains' shares settle.

    ``budget``: tokens wanted as a multiple of the tokens there are; None: just above the
    most that the scarcest domain allows at ``max_rate``, so its documents are all taken.
    ``keep``: a domain whose documents are all taken at ``max_rate``; it alone sets the
    budget, so the targets of the others are upper bounds.
    """
    kept = None if keep is None else list(targets).index(keep)
    total = float(sum(targets.values()))
    goal = [w / total for w in targets.values()]
    groups = shared_table(scored.groupBy("_p").agg(F.sum("_tokens").alias("_t")), "mixing-groups")
    share = lambda r: [F.sum(F.col("_t") * F.get("_p", F.lit(i)) / float(GRID) * r) for i in range(len(goal))]
    first = groups.agg(F.sum("_t").cast("double"), *share(F.lit(1.0))).first()
    tokens = first[0] or 0.0
    if not tokens:
        return []
    have = [max(x / tokens, 1e-9) for x in first[1:]]
    if kept is not None:
        budget = have[kept] * max_rate / goal[kept]
    elif budget is None:
        budget = 1.02 * min(h * max_rate / g for h, g in zip(have, goal) if g > 0)
    goal = [g * budget for g in goal]
    history: list[list[float]] = []
    now = [h * min(1.0, max_rate) for h in have]
    for _ in range(STEPS):
        history.append([(m - g) / h for m, g, h in zip(now, goal, have)])
        row = groups.agg(*share(_replay(F.col("_p"), history, max_rate, kept))).first()
        after = [x / tokens for x in row]
        if max(abs(a - b) for a, b in zip(after, now)) < TOLERANCE:
            return history
        now = after
    raise RuntimeError(f"the domains' shares did not settle in {STEPS} steps: {after}")


def _flag_labelled(scored: DataFrame, labels: DataFrame, domains: list[str], keep: str, id_col: str) -> DataFrame:
    """``scored`` plus ``_known``: whether the label of a document is ``keep``, where the model says otherwise.

    Only documents that the model gives to other domains are looked up, by id alone; rows shuffle
    only where the ids found are too many to be broadcast.
    """
    at = F.col(f"`{id_col}`")
    other = F.array_max("_p") > F.get("_p", F.lit(domains.index(keep)))
    labelled = (labels.select(F.col(f"`{id_col}`").alias("_at"), F.col("domain")).filter(F.col("domain").isin(domains) & F.col("_at").isNotNull())
                .groupBy("_at").agg(F.max("domain").alias("_domain")).filter(F.col("_domain") == keep).select("_at"))
    found = scored.filter(other & at.isNotNull()).select(at.alias("_at")).distinct().join(labelled, "_at")
    found = shared_table(found, "mixing-labelled")
    known = scored.filter(other & at.isNotNull()).join(found, at == F.col("_at"), "left").withColumn("_known", F.col("_at").isNotNull()).drop("_at")
    return known.unionByName(scored.filter(~other | at.isNull()).withColumn("_known", F.lit(False)))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
        max_rate: float = 4.0, budget: float | None = 1.0, with_text: bool = True, keep: str | None = None) -> DataFrame:
    """``docs`` plus ``_tokens``, ``_p`` (posteriors), ``_rate`` and ``_copies``."""
    domains = list(targets)
    model = learn_weights(docs, labels, domains, id_col, text_col)
    u = F.pmod(F.xxhash64(F.lit(7), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(1 << 32)) / float(1 << 32)
    scored = posteriors(docs, model, domains, text_col).withColumn("_u", u)
    scored = shared_table(scored if with_text else scored.drop(text_col), "mixing-scored")
    if keep is not None:
        scored = _flag_labelled(scored, labels, domains, keep, id_col)
    kept = None if keep is None else domains.index(keep)
    rate = _replay(F.col("_p"), fit_rates(scored, targets, max_rate, budget, keep), max_rate, kept)
    if keep is not None:  # a label counts more than the model
        rate = F.when(F.col("_known"), F.greatest(rate, F.lit(min(1.0, max_rate)))).otherwise(rate)
    return scored.withColumn("_rate", F.round(rate, 6)).withColumn("_copies", F.floor(F.col("_rate") + F.col("_u"))).drop("_u", "_known")


def mixing_report(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
                  max_rate: float = 4.0, budget: float | None = 1.0) -> DataFrame:
    """``id_col, n_tokens``, a posterior per domain, ``rate`` and ``copies`` per row of ``docs``."""
    named = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    out = mix(named, labels, targets, id_col, text_col, max_rate, budget, with_text=False)
    return out.select(id_col, F.col("_tokens").alias("n_tokens"), *[(F.get("_p", F.lit(i)) / GRID).alias(f"p_{d}") for i, d in enumerate(targets)],
                      F.col("_rate").alias("rate"), F.col("_copies").alias("copies"))


def take_mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
                 max_rate: float = 4.0, budget: float | None = 1.0, keep: str | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its number of copies says."""
    named = labels.select(F.col(f"`{id_col}`").alias("id"), "domain")
    out = mix(packed(docs, id=id_col, text=text_col), named, targets, "id", "text", max_rate, budget, with_text=False, keep=keep).filter("_copies > 0")
    if max_rate > 1:
        out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return unpacked(out)


def label_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Domains of a ``quality, toxic`` table: toxic, else low, else clean; other labels none."""
    domain = F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") > 0, "clean")
    return labels.select(F.col(f"`{id_col}`"), domain.alias("domain")).filter("domain IS NOT NULL")
