"""One query per operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewell.llm import ledger
from sievewell.llm.cross_polytope import near_vectors
from sievewell.llm.factorisation import judge_quality
from sievewell.llm.fill_middle import fill_in_middle, restored
from sievewell.llm.filter_audit import audit_filters
from sievewell.llm.ledger import query, table
from sievewell.llm.licences import KNOWN, built_in, scan_licences, sql_canonical
from sievewell.llm.markov import score_texts
from sievewell.llm.minhash import Likeness, near_duplicates
from sievewell.llm.mixing import mix
from sievewell.llm.pii import report_private
from sievewell.llm.segmentation import predict_languages
from sievewell.llm.toxicity import judge_toxicity
from sievewell.llm.url_cascade import Rule, judge_urls, page_key
from sievewell.llm.wu_manber import find_contamination

# The URL rules to be judged by, and a host to be kept out besides.
URL_RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
BLOCKED_HOSTS = ("spam-farm.example.org",)
# First digit of the MD5 of the pages kept out: the block list is a sixteenth of the corpus, so that filters do let others by.
BLOCKED_DIGIT = "0"

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

URL_SQL = rf"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), {_LOWER}) AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(h, p, v) AS (
  VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)}
), fits AS (
  SELECT page_id, host, path, h, p, v,
         h IS NOT NULL AS fit
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path,
       arg_max(h || p, length(h || p)) AS rule,
       coalesce(arg_max(v, length(h || p)),
                CASE WHEN {" OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in BLOCKED_HOSTS)}
                       OR (host || path <> '' AND md5(host || path)[1] = '{BLOCKED_DIGIT}')
                     THEN 'block' ELSE 'allow' END) AS verdict
FROM fits GROUP BY page_id, host, path
"""

CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT m FROM wins),
dwins AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)
), hits AS (SELECT dwins.doc_id, dwins.m, dwins.i, wins.item_id FROM dwins JOIN wins USING (m, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hits)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN least ON w.doc_id = least.doc_id
"""


LICENCE_SQL = f"""
WITH known(name, text) AS (VALUES {", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in KNOWN)}),
k AS (SELECT sha256(c) AS digest, min(name) AS license FROM (SELECT name, {sql_canonical("text")} AS c FROM known) WHERE c <> '' GROUP BY 1),
whole AS (SELECT doc_id, sha256({sql_canonical("text")}) AS digest FROM documents),
lines AS (SELECT doc_id, sha256({sql_canonical("line")}) AS digest
          FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)),
stated AS (SELECT DISTINCT doc_id, license FROM lines JOIN k USING (digest)),
notices AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices FROM stated GROUP BY doc_id)
SELECT whole.doc_id, whole.digest, k.license, coalesce(notices, '') AS notices
FROM whole LEFT JOIN k ON whole.digest = k.digest LEFT JOIN notices ON whole.doc_id = notices.doc_id
"""


@query("op1_url_filters", URL_SQL)
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    blocked = pages.select(page_key(F.col("url")).alias("key")).where(F.substring(F.md5("key"), 1, 1) == BLOCKED_DIGIT)
    judged = judge_urls(pages, URL_RULES, BLOCKED_HOSTS, blocked_pages=blocked)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_private(table(spark, sf_dir, "documents"))


@query("op3_minhash_near_dedup", NEAR_SQL)
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Likeness(words=3, percent=85))


VECTOR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), least AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT embeddings.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, embeddings.vec_id = component_id AS kept
FROM embeddings JOIN least ON embeddings.vec_id = least.vec_id LEFT JOIN n ON embeddings.vec_id = n.vec_id
"""


@query("op7_embedding_near_dedup", VECTOR_SQL)
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_benchmark_decontamination", CONTAMINATION_SQL)
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain) of the label table."""
    labels = table(spark, sf_dir, "labels")
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


# Shares of all tokens wanted from each domain.
MIX_TARGETS = {"good": 0.9, "poor": 0.07, "toxic": 0.03}


@query("op4_mixing_sources")
def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, classifier = mix(table(spark, sf_dir, "documents"), labelled_domains(spark, sf_dir), MIX_TARGETS)
    shares = [F.get("p", k).alias(f"p_{d}") for k, d in enumerate(classifier.domains)]
    return rated.select("doc_id", "tokens", *shares, "rate", "copies")


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_license_scans", LICENCE_SQL)
def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"), built_in(spark))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_markov_scores")
def op11_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


FILL_SQL = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS d FROM documents),
u AS (SELECT doc_id, t, length(t) AS n, {} FROM h),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), parts AS (
  SELECT *, substring(t, 1, low) AS p, substring(t, low + 1, high - low) AS m, substring(t, high + 1) AS s FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN low::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN (high - low)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""".format(", ".join(f"('0x' || substr(d, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4)))


@query("op12_fill_in_middle", FILL_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_in_middle(table(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return filled.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), b AS (
  SELECT part, (len(w) < 200)::INT AS a, (100 * len(list_distinct(w)) < 50 * len(w))::INT AS b,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT AS c, regexp_matches(t, '[#$%&*|]')::INT AS d,
         coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT AS e,
         coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), f(letter) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT f1.letter || f2.letter || f3.letter || f4.letter || f5.letter AS filter_order
  FROM f f1, f f2, f f3, f f4, f f5
  WHERE len(list_distinct([f1.letter, f2.letter, f3.letter, f4.letter, f5.letter])) = 5
), s AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o),
cells AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM b GROUP BY ALL),
failed AS (
  SELECT *, CASE WHEN a = 1 THEN 'A' ELSE '' END || CASE WHEN b = 1 THEN 'B' ELSE '' END || CASE WHEN c = 1 THEN 'C' ELSE '' END
            || CASE WHEN d = 1 THEN 'D' ELSE '' END || CASE WHEN e = 1 THEN 'E' ELSE '' END AS fails
  FROM cells
), taken AS (
  SELECT part, filter_order, step, n, good, toxic, filter_order[step] AS own,
         contains(fails, filter_order[step]) AS here, fails = filter_order[step] AS alone,
         length(translate(fails, filter_order[1:step - 1], '')) < length(fails) AS before
  FROM failed, s
), steps AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT before AND NOT here), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (NOT before AND here), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (before AND here), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (NOT before AND here), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (NOT before AND here), 0)::BIGINT AS toxic_lost
  FROM taken GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM steps
"""


@query("op13_filter_audit", AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, ledger.Query]:
    return dict(ledger.runs)


def oracle_sql() -> dict[str, str]:
    return dict(ledger.sql)
