"""The thin ``opN_<name>`` queries over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (backoff_lm, exact_dedup, html_extract, lang_id, line_dedup, mixing, packing, quality_rules, secret_scan, simhash, url_filter, whitening,
               word_runs)
from .common import let, read

#: Wanted shares of the token budget per domain.
TARGETS = {"clean": 0.9, "low": 0.05, "toxic": 0.05}
#: URL rules: kind, then host suffix and path prefix (fixed values).
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file; it must be the same on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


@query("op2_exact_dedup", """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def _quality_sql() -> str:
    grid = ", ".join(f"('{r}', {c})" for r, cs in quality_rules.GRID.items() for c in cs)
    values = " ".join(f"WHEN '{r}' THEN {r}" for r in quality_rules.GRID)
    cuts = " AND ".join(f"coalesce({r} < min(cutoff) FILTER (rule = '{r}'), true)" for r in quality_rules.GRID)
    return f"""
WITH words AS (
  SELECT doc_id, coalesce('=' || lang, '') AS stratum, lang, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n > 1) GROUP BY doc_id),
figures AS (
  SELECT words.doc_id, stratum, lang, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '{quality_rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper, len(l) AS n_lines
  FROM words LEFT JOIN repeats USING (doc_id)),
ratios AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbols,
         CASE WHEN word_chars > 0 THEN 1000 * n_upper // word_chars ELSE 0 END AS upper,
         CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats,
         CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
         CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END AS long_words,
         CASE WHEN word_chars > 0 THEN 1000 * n_words // word_chars ELSE 0 END AS short_words
  FROM figures),
quality AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
grid(rule, cutoff) AS (VALUES {grid}),
tried AS (
  SELECT stratum, rule, cutoff, substr(md5(doc_id::VARCHAR), 1, 1) < '8' AS fit, q > 0 AS clean,
         (CASE rule {values} END) >= cutoff AS rejected
  FROM ratios JOIN quality USING (doc_id) CROSS JOIN grid WHERE NOT base_failed),
counts AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (NOT clean AND rejected) - {quality_rules.CLEAN_COST} * count(*) FILTER (clean AND rejected) AS u
  FROM tried WHERE fit GROUP BY ALL),
best AS (SELECT * FROM counts WHERE u > 0 QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY u DESC, cutoff DESC) = 1),
picked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY u DESC, rule) AS place FROM best),
clean_texts AS (SELECT ratios.* FROM ratios JOIN quality USING (doc_id) WHERE NOT base_failed AND q > 0 AND substr(md5(doc_id::VARCHAR), 1, 1) >= '8'),
hits AS (SELECT c.doc_id, c.stratum, min(p.place) AS place FROM clean_texts c JOIN picked p ON p.stratum = c.stratum AND (CASE p.rule {values} END) >= p.cutoff GROUP BY ALL),
sizes AS (SELECT stratum, count(*) AS n FROM clean_texts GROUP BY stratum),
tests AS (SELECT p.stratum, p.rule, p.cutoff, p.place, coalesce(s.n, 0) AS n, (SELECT count(*) FROM hits h WHERE h.stratum = p.stratum AND h.place <= p.place) AS k
          FROM picked p LEFT JOIN sizes s USING (stratum)),
tested AS (
  SELECT *, CASE WHEN n = 0 OR k > n * 0.01 THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
           exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln(0.01) + (n - i) * ln(0.99)))) END AS p,
         (SELECT count(DISTINCT stratum) FROM picked) AS strata
  FROM tests),
cutoffs AS (SELECT stratum, rule, cutoff FROM tested QUALIFY bool_and(n > 0 AND p * strata <= 0.05) OVER (PARTITION BY stratum ORDER BY place)),
judged AS (
  SELECT ratios.doc_id, ratios.stratum, {", ".join(f"any_value({r}) AS {r}" for r in quality_rules.GRID)},
         {cuts} AS passes
  FROM ratios LEFT JOIN cutoffs USING (stratum) GROUP BY ratios.doc_id, ratios.stratum, {", ".join(quality_rules.GRID)})
SELECT doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND passes AS kept
FROM ratios JOIN judged USING (doc_id)
"""


@query("op9_quality_rules", _quality_sql())
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = mixing.label_domains(read(spark, sf_dir, "labels"))
    return mixing.mixing_report(read(spark, sf_dir, "documents"), labels, TARGETS)


@query("op4_lang_id")
def op4_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(read(spark, sf_dir, "documents"))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digest(secret_scan.find_secrets(read(spark, sf_dir, "documents")))


def _url_sql() -> str:
    u = url_filter
    kinds = {text: kind for kind, text in URL_RULES}
    cases = []
    for text in sorted(kinds, key=len, reverse=True):
        at, slash, prefix = text.partition("/")
        cases.append(f"WHEN (host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '{slash}{prefix}') THEN '{text}'")
    orders = range(u.ORDER + 1)
    runs = ", ".join(f"array_to_string(c[i - {k}:i], '')" for k in orders)
    counts = ",\n    ".join(f"coalesce(max(n.{x}) FILTER (k = {k}), 0) AS n{k}{x}, coalesce(max(m.{x}) FILTER (k = {k}), 0) AS m{k}{x}" for k in orders for x in "ab")

    def p(x: str) -> str:
        value = f"(1 / {u.ALPHABET}::DOUBLE)"
        for k in orders:
            value = f"((n{k}{x} + {u.SMOOTH}::DOUBLE * {value}) / (m{k}{x} + {u.SMOOTH}::DOUBLE))"
        return value

    return f"""
WITH split AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS (SELECT *, CASE {" ".join(cases)} END AS rule FROM parsed),
judged AS (SELECT *, CASE {" ".join(f"WHEN rule = '{t}' THEN '{k}'" for t, k in kinds.items())} END AS decided FROM ruled),
texts AS (
  SELECT page_id, url, decided, rule IS NOT NULL AND substr(md5(url), 1, 1) < '2' AS held,
         list_concat(list_concat([{", ".join(["chr(2)"] * u.ORDER)}],
           string_split(translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')), [chr(3)]) AS c
  FROM judged),
places AS (SELECT page_id, decided, held, c, unnest(range({u.ORDER + 1}, len(c) + 1)) AS i FROM texts),
spots AS (SELECT page_id, decided, held, i, unnest([{runs}]) AS r, unnest([{", ".join(map(str, orders))}]) AS k FROM places),
runs AS (SELECT r, count(*) FILTER (decided = 'allow') AS a, count(*) FILTER (decided = 'block') AS b
         FROM spots WHERE decided IS NOT NULL AND NOT held GROUP BY r),
contexts AS (SELECT substr(r, 1, length(r) - 1) AS r, sum(a) AS a, sum(b) AS b FROM runs GROUP BY ALL),
seen AS (
  SELECT page_id, any_value(decided) AS decided, any_value(held) AS held, i,
    {counts}
  FROM spots s LEFT JOIN runs n ON n.r = s.r LEFT JOIN contexts m ON m.r = substr(s.r, 1, length(s.r) - 1)
  WHERE held OR decided IS NULL GROUP BY page_id, i),
scored AS (SELECT page_id, any_value(decided) AS decided, any_value(held) AS held, CAST(round(avg(ln({p("a")}) - ln({p("b")})) * {u.SCALE}) AS BIGINT) AS score
           FROM seen GROUP BY page_id),
bins AS (SELECT score, count(*) FILTER (decided = 'allow') AS a, count(*) FILTER (decided = 'block') AS b FROM scored WHERE held GROUP BY score),
sums AS (SELECT score, sum(a) OVER w - a AS lost, sum(b) OVER w - b AS caught, sum(a) OVER () AS all_a, sum(b) OVER () AS all_b
         FROM bins WINDOW w AS (ORDER BY score)),
cutoff AS (SELECT score AS cut FROM sums WHERE all_a > 0 AND all_b > 0 AND lost <= {u.ACCEPTED_LOSS} * all_a
           ORDER BY caught / all_b - lost / all_a DESC, score DESC LIMIT 1)
SELECT page_id, host, path, rule,
       coalesce(j.decided, CASE WHEN s.score < (SELECT cut FROM cutoff) THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN rule IS NULL THEN s.score / {float(u.SCALE)} END AS score
FROM judged j LEFT JOIN scored s USING (page_id)
"""


@query("op7_url_filter", _url_sql())
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), URL_RULES)


@query("op3_html_extract")
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read(spark, sf_dir, "pages"))


@query("op6_line_dedup", f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
places AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM docs),
lines AS (SELECT doc_id, k - 1 AS no, list_filter(string_split_regex(ls[k], '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM places),
firsts AS (SELECT w, min((doc_id, no)) AS f FROM lines WHERE len(w) > 0 GROUP BY w),
long AS (SELECT * FROM firsts WHERE len(w) >= {line_dedup.MIN_WORDS}),
cuts AS (SELECT w, f, unnest(range(1, len(w) + 1)) AS i FROM long),
variants AS (SELECT w, f, i, list_concat(w[:i - 1], w[i + 1:]) AS x FROM cuts),
late AS (
  SELECT w FROM (SELECT w, f, min(f) OVER (PARTITION BY x, i) AS m FROM variants) WHERE m < f
  UNION SELECT v.w FROM variants v JOIN long s ON s.w = v.x WHERE s.f < v.f
  UNION SELECT s.w FROM variants v JOIN long s ON s.w = v.x WHERE v.f < s.f),
gone AS (
  SELECT doc_id, no FROM lines JOIN firsts USING (w)
  WHERE (doc_id, no) <> f OR w IN (SELECT w FROM late)),
lists AS (SELECT doc_id, list(no ORDER BY no) AS g FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, ls, coalesce(g, []) AS g FROM docs LEFT JOIN lists USING (doc_id))
SELECT doc_id, len(ls) AS n_lines, len(g) AS n_dropped, array_to_string(g, ',') AS dropped,
       sha256(coalesce(array_to_string(list_filter(ls, lambda x, i: NOT list_contains(g, i - 1)), chr(10)), '')) AS text_sha256
FROM kept
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.array_join(F.col("dropped_lines").cast("array<string>"), ",")
    return out.select("doc_id", F.col("n_lines").cast("long"), F.size("dropped_lines").cast("long").alias("n_dropped"), gone.alias("dropped"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


def planted_runs(doc_id: Column, text: Column) -> Column:
    """The text in which operator 12 looks for runs: every tenth id (by hash) repeats a part of its words."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        place = F.sequence(F.lit(0), n - 1)
        return F.array_join(F.transform(place, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.rlike(r"[^\x20\x09-\x0D]"), let(words, planted)).otherwise(text)


@query("op12_word_runs")
def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return word_runs.run_digest(word_runs.find_runs(docs, "doc_id", planted_runs(F.col("doc_id"), F.col("text"))))


@query("op13_lm_score")
def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10))
    out = backoff_lm.score_texts(read(spark, sf_dir, "documents"), rest != 0)
    return out.withColumn("held_out", ~F.col("learnt")).drop("learnt")
