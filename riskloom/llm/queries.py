"""The registered queries of the operators, each over its whole table, next to its SQL where SQL can say it."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import Query
from riskloom.llm import attention, bpe, filter_audit, graph_search, language, mixing, passages, quality_rules, reputation, simhash, vector_codes, vector_duplicates, warc
from riskloom.llm.base import remainder, table

#: The vocabulary file of op9; a parameter of the operator, never part of this repository.
VOCABULARY = "byte_bpe_50k.json"


@lru_cache(maxsize=2)
def vocabulary(name: str = VOCABULARY) -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"))


def op2_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    out = quality_rules.judged(table(spark, d, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP2_SQL = r"""
WITH base AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
tri AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) > 2)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM tri) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid),
m AS MATERIALIZED (
  SELECT doc_id, host, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN covered USING (rid)),
f AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS MATERIALIZED (
  SELECT host, count(*)::DOUBLE AS n, count(*) FILTER (base_failed)::DOUBLE AS base,
         count(*) FILTER (n_symbols * 100 > word_chars * 10)::DOUBLE AS symbols
  FROM f GROUP BY host),
r AS (SELECT host, n, 'base' AS rule, base AS bad FROM h UNION ALL SELECT host, n, 'symbols', symbols FROM h),
p AS (SELECT rule, sum(bad) / sum(n) AS mean, sum(n) / count(*) AS per_host FROM r GROUP BY rule),
v AS (SELECT rule, mean, avg((bad / n - mean) ** 2) - mean * (1 - mean) / any_value(per_host) AS beyond
      FROM r JOIN p USING (rule) GROUP BY rule, mean),
k AS (SELECT rule, mean, CASE WHEN beyond > 0 THEN least(1000.0, greatest(1.0, mean * (1 - mean) / beyond - 1)) ELSE 1000.0 END AS k FROM v),
verdict AS (SELECT host, bool_and((bad + mean * k) / (n + k) <= 0.5) AS ok FROM r JOIN k USING (rule) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM f JOIN verdict ON f.host IS NOT DISTINCT FROM verdict.host
"""


def op3_passages(spark: SparkSession, d: str) -> DataFrame:
    return passages.documents_with_repeats(table(spark, d, "documents"))


def op4_language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    models = language.train(language.trained_on(docs))
    return language.identified(docs, models).withColumn("held_out", remainder("doc_id", 3) == 1)


def op5_warc(spark: SparkSession, d: str) -> DataFrame:
    """What the archives say once they are written and read back."""
    back = warc.read(warc.archived(table(spark, d, "pages")), bodies=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, payload_bytes, max(page_id) AS owner FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM p LEFT JOIN o USING (payload_digest, payload_bytes)
"""


def op6_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = attention.train(attention.trained_on(docs), attention.trained_on(table(spark, d, "labels")))
    return attention.scored(docs, model).withColumn("held_out", remainder("doc_id", 4) == 2)


def op8_graph_search(spark: SparkSession, d: str) -> DataFrame:
    return graph_search.neighbours(table(spark, d, "embeddings"))


def op9_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the token ids and of the text that decoding them gives back."""
    tokens = bpe.encoded(table(spark, d, "documents"), vocabulary(), back=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_url_filters(spark: SparkSession, d: str) -> DataFrame:
    return reputation.judged(table(spark, d, "pages"), table(spark, d, "labels"))


OP10_SQL = r"""
WITH read AS MATERIALIZED (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
known AS (
  SELECT doc_id, max((coalesce(quality = 0, false) OR coalesce(toxic = 1, false))::INT) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
seen AS (
  SELECT host, count(*) AS n, sum(bad) AS bad
  FROM (SELECT host, try_cast(regexp_extract(path, '/([0-9]{1,18})(?:\.html|/)?\z', 1) AS BIGINT) AS doc_id FROM read) JOIN known USING (doc_id)
  GROUP BY host),
hosts AS MATERIALIZED (
  SELECT host, coalesce(n, 0)::DOUBLE AS n, coalesce(bad, 0)::DOUBLE AS bad,
         string_split(host, '.')[-1] AS suffix, array_to_string(string_split(host, '.')[-2:], '.') AS domain
  FROM (SELECT DISTINCT host FROM read) LEFT JOIN seen USING (host)),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1.0) / (sum(n) + 2.0) FROM hosts) AS p FROM hosts GROUP BY suffix),
s1 AS (SELECT sum((bad - n * p) ** 2 - n * p * (1 - p)) FILTER (n > 0) AS o, sum(n * (n - 1) * p * (1 - p)) FILTER (n > 0) AS b FROM s0),
s2 AS (SELECT CASE WHEN b > 0 AND o / b > 0 THEN least(200.0, greatest(2.0, b / o - 1)) ELSE 200.0 END AS k FROM s1),
s AS MATERIALIZED (SELECT suffix, (bad + p * k) / (n + k) AS p FROM s0, s2),
d0 AS (SELECT domain, suffix, p, sum(n) AS n, sum(bad) AS bad FROM hosts JOIN s USING (suffix) GROUP BY ALL),
d1 AS (SELECT sum((bad - n * p) ** 2 - n * p * (1 - p)) FILTER (n > 0) AS o, sum(n * (n - 1) * p * (1 - p)) FILTER (n > 0) AS b FROM d0),
d2 AS (SELECT CASE WHEN b > 0 AND o / b > 0 THEN least(200.0, greatest(2.0, b / o - 1)) ELSE 200.0 END AS k FROM d1),
d AS MATERIALIZED (SELECT domain, (bad + p * k) / (n + k) AS p FROM d0, d2),
h0 AS (SELECT host, n, bad, p FROM hosts JOIN d USING (domain)),
h1 AS (SELECT sum((bad - n * p) ** 2 - n * p * (1 - p)) FILTER (n > 0) AS o, sum(n * (n - 1) * p * (1 - p)) FILTER (n > 0) AS b FROM h0),
h2 AS (SELECT CASE WHEN b > 0 AND o / b > 0 THEN least(200.0, greatest(2.0, b / o - 1)) ELSE 200.0 END AS k FROM h1),
h AS (SELECT host, (bad + p * k) / (n + k) AS rate, n + k AS weight FROM h0, h2),
v AS (SELECT host, CASE WHEN host <> '' AND rate - 1.645 * sqrt(rate * (1 - rate) / (weight + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict FROM h),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM read)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NULL THEN v.verdict WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN v USING (host)
"""

def op11_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    return vector_codes.coded(table(spark, d, "embeddings"))


def _op11_sql() -> str:
    """The rounds one after another: every part against every entry, in long form (vector, part, position)."""
    def assigned(book: str, more: str = "") -> str:
        return f"""
  SELECT rid, part, arg_min(entry, far * 1000 + entry) AS entry{more} FROM (
    SELECT rid, part, entry, sum((x.v - b.v) * (x.v - b.v)) AS far FROM x JOIN {book} b USING (part, pos) GROUP BY ALL) GROUP BY ALL"""

    ctes = """
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (
  SELECT rid, (i - 1) // (n // 4) AS part, (i - 1) % (n // 4) AS pos, floor(1024e0 * v)::BIGINT AS v
  FROM (SELECT rid, len(embedding) AS n, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM k)),
b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, pos, v FROM x WHERE rid <= 256)"""
    for i in range(vector_codes.ROUNDS):
        ctes += f""",
a{i} AS MATERIALIZED ({assigned(f"b{i}")}),
m{i} AS (SELECT part, entry, pos, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v FROM x JOIN a{i} USING (rid, part) GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(m{i}.v, b{i}.v) AS v FROM b{i} LEFT JOIN m{i} USING (part, entry, pos))"""
    last = f"b{vector_codes.ROUNDS}"
    return ctes + f""",
final AS MATERIALIZED ({assigned(last, ", min(far) AS far")}),
coded AS (SELECT rid, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM final GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) FROM {last}) AS codebooks_sha256
FROM k JOIN coded USING (rid)
"""


def op12_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return filter_audit.audit(table(spark, d, "documents"), table(spark, d, "labels"))


OP12_SQL = r"""
WITH read AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
first AS (SELECT t, min(doc_id) AS first FROM read GROUP BY t),
known AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
bits AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
         + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(read.doc_id > first, false)::INT AS cell
  FROM read JOIN first USING (t) LEFT JOIN known USING (doc_id)),
cells AS (SELECT part, cell, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM bits GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(name, bit)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS o
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (SELECT filter_order, step, o[step] AS bit, coalesce(list_sum(o[:step - 1]), 0)::INT AS before FROM orders, range(1, 6) r(step)),
counted AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (cell & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (cell & before = 0 AND cell & bit > 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (cell & before > 0 AND cell & bit > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (cell = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (cell & before = 0 AND cell & bit > 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (cell & before = 0 AND cell & bit > 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


def op13_vector_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return vector_duplicates.near_duplicates(table(spark, d, "embeddings"))


OP13_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN links USING (vec_id)
"""

QUERIES: dict[str, Query] = {
    "op1_simhash": Query(op1_simhash),
    "op2_quality_rules": Query(op2_quality_rules, OP2_SQL),
    "op3_passages": Query(op3_passages),
    "op4_language": Query(op4_language),
    "op5_warc": Query(op5_warc, OP5_SQL),
    "op6_mixing": Query(op6_mixing),
    "op7_quality_classifier": Query(op7_quality_classifier),
    "op8_graph_search": Query(op8_graph_search),
    "op9_bpe": Query(op9_bpe),
    "op10_url_filters": Query(op10_url_filters, OP10_SQL),
    "op11_vector_codes": Query(op11_vector_codes, _op11_sql()),
    "op12_filter_audit": Query(op12_filter_audit, OP12_SQL),
    "op13_vector_duplicates": Query(op13_vector_duplicates, OP13_SQL),
}
