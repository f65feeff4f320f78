"""The llm queries: each applies its operator to its whole table and digests the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, jaccard, license_scan, linededup, pieces, suffixarray, suffixtree, topk, toxicity, urlfilter
from tessera.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10))


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixarray.remove(table(spark, sf_dir, "documents"), width=400, keep=False)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(table(spark, sf_dir, "documents"), copies=3, least=20)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a page's outcome is the quality label of the same number
    outcomes = table(spark, sf_dir, "labels").where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.min("quality").cast("long").alias("good"))
    return urlfilter.judge(table(spark, sf_dir, "pages"), outcomes)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out("doc_id")))
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), default_model(), keep_ids=False, keep_text=False)


def op8_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.remove(table(spark, sf_dir, "documents"), width=50, keep=False)


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64.0)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), width=5, num=80, den=100)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_suffix_array": op2_suffix_array,
        "op3_line_dedup": op3_line_dedup,
        "op4_url_filter": op4_url_filter,
        "op5_license_scan": op5_license_scan,
        "op6_toxicity": op6_toxicity,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_suffix_trees": op8_suffix_trees,
        "op9_top_k": op9_top_k,
        "op10_jaccard_join": op10_jaccard_join,
    }


OP4 = r"""WITH p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
two AS (SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS last2, string_split(host, '.')[-1] AS last1 FROM p),
l0 AS (SELECT *, CASE WHEN last2 IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in') THEN last2 ELSE last1 END AS suffix FROM two),
lv AS (SELECT page_id, host, path, suffix, CASE WHEN suffix = last2 THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE last2 END AS domain FROM l0),
o AS (SELECT doc_id AS page_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY 1),
h0 AS (SELECT host, domain, suffix, CAST(sum(good) AS DOUBLE) AS good, CAST(count(*) AS DOUBLE) AS n FROM lv JOIN o USING (page_id) GROUP BY ALL),
d0 AS (SELECT domain, suffix, sum(good) AS good, sum(n) AS n FROM h0 GROUP BY ALL),
s0 AS (SELECT suffix, sum(good) AS good, sum(n) AS n FROM h0 GROUP BY ALL),
mom AS (SELECT level, good, n, k, good / n AS m, (q - n * (good / n) * (good / n)) / n AS spread, (good / n) * (1 - good / n) * k / n AS noise FROM (SELECT 'h' AS level, sum(good) AS good, sum(n) AS n, count(*) AS k, sum(good * good / n) AS q FROM h0 UNION ALL SELECT 'd', sum(good), sum(n), count(*), sum(good * good / n) FROM d0 UNION ALL SELECT 's', sum(good), sum(n), count(*), sum(good * good / n) FROM s0)),
w AS (SELECT level, CASE WHEN n IS NULL OR k < 2 OR NOT (0 < good AND good < n) THEN 10.0 WHEN spread > noise THEN least(1000.0, greatest(1.0, m * (1 - m) / (spread - noise) - 1)) ELSE 1000.0 END AS w FROM mom),
t AS (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS overall FROM h0),
s1 AS (SELECT suffix, good + w * overall AS a, n + w - (good + w * overall) AS b FROM s0, t, w WHERE level = 's'),
d1 AS (SELECT domain, good + w * (s1.a / (s1.a + s1.b)) AS a, n + w - (good + w * (s1.a / (s1.a + s1.b))) AS b FROM d0 JOIN s1 USING (suffix), w WHERE level = 'd'),
h1 AS (SELECT host, good + w * (d1.a / (d1.a + d1.b)) AS a, n + w - (good + w * (d1.a / (d1.a + d1.b))) AS b FROM h0 JOIN d1 USING (domain), w WHERE level = 'h'),
j AS (SELECT page_id, lv.host, path, coalesce(h1.a, d1.a, s1.a, overall * 2) AS a, coalesce(h1.b, d1.b, s1.b, (1 - overall) * 2) AS b FROM lv LEFT JOIN h1 USING (host) LEFT JOIN d1 USING (domain) LEFT JOIN s1 USING (suffix), t),
r AS (SELECT *, a / (a + b) AS rate, a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound,
 CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/' WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/' WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/' WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/' WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM j)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bound < 0.5 THEN 'block' ELSE 'allow' END AS verdict, round(rate, 6) AS rate, round(bound, 6) AS bound FROM r"""

OP3 = r"""WITH l AS (SELECT rn, doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM (SELECT rn, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM (SELECT row_number() OVER () AS rn, * FROM documents))),
k AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT rn, l.doc_id, pos, line, k.key IS NOT NULL AND l.doc_id <> keeper AS dropped FROM l LEFT JOIN k ON l.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256 FROM m GROUP BY rn, doc_id"""

OP9 = r"""WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 20"""

OP8 = r"""WITH w AS (SELECT rn, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM (SELECT row_number() OVER () AS rn, * FROM documents)),
p AS (SELECT rn, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM w, unnest(range(1, greatest(len(w) - 48, 1))) t(i)),
k AS (SELECT h, min(doc_id) AS least FROM p GROUP BY h),
g AS (SELECT DISTINCT rn, i + j AS at FROM p JOIN k USING (h), range(50) r(j) WHERE doc_id > least),
u AS (SELECT rn, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM w),
c AS (SELECT u.rn, count(g.at) AS n_removed, string_agg(word, ' ' ORDER BY u.at) FILTER (g.at IS NULL) AS kept FROM u LEFT JOIN g ON u.rn = g.rn AND u.at = g.at GROUP BY u.rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN c USING (rn)"""

OP1 = r"""WITH d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS h FROM b, unnest(range(1, greatest(len(w) - 8, 2))) t(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM win),
p AS (SELECT rn, i, k, array_to_string(w[i:i + k - 1], ' ') AS h FROM d, ks, unnest(range(1, greatest(len(w) - k + 2, 1))) t(i)),
m AS (SELECT rn, i, k, item_id FROM p JOIN win USING (k, h)),
hits AS (SELECT rn, count(DISTINCT i + j) AS n FROM m, range(10) r(j) WHERE j < k GROUP BY rn),
items AS (SELECT rn, count(item) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rn, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated FROM d LEFT JOIN hits USING (rn) LEFT JOIN items USING (rn)"""


OP2 = r"""WITH d AS (SELECT row_number() OVER () AS rn, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT rn, i, md5(substring(x, 2 * i + 1, 800)) AS h FROM d, unnest(range(0, greatest(CAST(length(x) // 2 AS BIGINT) - 399, 0))) t(i)),
k AS (SELECT h FROM p GROUP BY h HAVING count(*) > 1),
g AS (SELECT rn, i, lag(i) OVER (PARTITION BY rn ORDER BY i) AS before FROM p JOIN k USING (h)),
s AS (SELECT rn, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY rn ORDER BY i) AS span FROM g),
m AS (SELECT rn, span, min(i) AS a, max(i) + 400 AS z FROM s GROUP BY rn, span),
c AS (SELECT rn, span, a, z, lag(z, 1, 0) OVER (PARTITION BY rn ORDER BY a) AS y FROM m),
o AS (SELECT rn, count(*) AS n_spans, sum(z - a) AS n_removed, string_agg(substring(x, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) AS head, max(z) AS tail FROM c JOIN d USING (rn) GROUP BY rn)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE head || substring(x, 2 * tail + 1) END)) AS kept_sha256 FROM d LEFT JOIN o USING (rn)"""

OP10 = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h FROM w, unnest(range(1, greatest(len(w) - 3, 2))) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.b, w.doc_id)) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS b FROM r GROUP BY a) c USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """Encoding and a learnt lexicon have none: their tests hold them against the library and a plain version."""
    return {"op1_decontamination": OP1, "op2_suffix_array": OP2, "op3_line_dedup": OP3, "op4_url_filter": OP4, "op5_license_scan": license_scan.oracle(), "op8_suffix_trees": OP8, "op9_top_k": OP9, "op10_jaccard_join": OP10}
