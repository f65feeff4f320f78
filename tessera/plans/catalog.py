"""The queries of the core library, each beside the SQL that it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import arrays, checks, vision
from tessera.functions import text as T
from tessera.operators import curation, distillation, generation, partition, progress, rollouts, selection, verification
from tessera.plans import fixtures as X
from tessera.session import table
from tessera.sources import config

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _SQL[fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def s6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


#: Fixed values of the record format, in DuckDB's syntax: an answer block, one at the end, and the final sentence at the end.
ANSWER_SQL = r"(?is)<answer>.*?</answer>"
BODY_SQL = r"(?is)<answer>(.*?)</answer>"
ENDED_ANSWER_SQL = r"(?is)<answer>.*?</answer>\.?\s*$"
ENDED_BODY_SQL = r"(?is)<answer>(.*?)</answer>\.?\s*$"
ENDED_SENTENCE_SQL = r"(?is)(?:^|\n)\s*(therefore,\s*the\s*final\s*answer\s*is\s*<answer>.*?</answer>\.?)\s*$"

# Verification ---------------------------------------------------------------------------------------------------

COUNTS = "counts AS (SELECT index, domain, count(*) AS num_rollouts, count(*) FILTER (label = 'A') AS correct_count, count(*) FILTER (label = 'B') AS wrong_count, count(*) FILTER (label = 'C') AS invalid_count, count(*) FILTER (NOT parsed) AS parse_failed_count, count(*) = 4 AND count(*) FILTER (NOT parsed) < 4 AS verify_valid FROM labelled GROUP BY index, domain)"


def counted(spark: SparkSession, d: str) -> DataFrame:
    return verification.counts(verification.judged(X.rollouts(spark, d)), "index", "domain", expected=X.N)


@query(f"WITH {X.JUDGED_SQL}, {COUNTS} SELECT domain, count(*) AS samples, CAST(sum(correct_count) AS BIGINT) AS correct, CAST(sum(wrong_count) AS BIGINT) AS wrong, CAST(sum(parse_failed_count) AS BIGINT) AS parse_failed, count(*) FILTER (verify_valid) AS valid FROM counts GROUP BY ROLLUP (domain)")
def verify_summary(spark, d):
    return counted(spark, d).rollup("domain").agg(F.count("*").alias("samples"), F.sum("correct_count").alias("correct"), F.sum("wrong_count").alias("wrong"), F.sum("parse_failed_count").alias("parse_failed"), F.count_if("verify_valid").alias("valid"))


@query(f"WITH {X.JUDGED_SQL} SELECT index, rollout_id, verdict, reasoning_consistent, reason, parsed, label FROM labelled")
def verdict_parse(spark, d):
    return verification.judged(X.rollouts(spark, d)).select("index", "rollout_id", "verdict", "reasoning_consistent", "reason", "parsed", "label")


@query(f"WITH {X.JUDGED_SQL}, {COUNTS} SELECT * FROM counts")
def verify_counts(spark, d):
    return counted(spark, d)


@query(f"WITH {X.JUDGED_SQL} SELECT index, rollout_id, format_error, format_valid FROM labelled")
def format_check(spark, d):
    return verification.judged(X.rollouts(spark, d)).select("index", "rollout_id", "format_error", "format_valid")


@query(f"WITH {X.JUDGED_SQL}, {COUNTS} SELECT index FROM counts WHERE correct_count = 0")
def difficulty_gate(spark, d):
    return counted(spark, d).where(curation.difficult(F.col("correct_count"))).select("index")


@query(f"WITH {X.JUDGED_SQL} SELECT index, array_to_string(list(rollout_id ORDER BY rollout_id), ',') AS correct_rollout_ids FROM labelled WHERE label = 'A' AND format_valid GROUP BY index")
def accepted_rollouts(spark, d):
    rows = X.rollouts(spark, d)
    good = verification.correct_rollouts(rows, verification.judged(rows), "index")
    return verification.correct_ids(good, "index").select("index", F.array_join(F.col("correct_rollout_ids").cast("array<string>"), ",").alias("correct_rollout_ids"))


# Text -----------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, CASE WHEN length(text) <= 1000 THEN text ELSE substr(text, 1, 1000) || chr(10) || '[TRUNCATED]' END AS text FROM documents")
def truncate_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.truncate(F.col("text"), 1000).alias("text"))


@query(f"WITH {X.rollouts_sql()}, c AS (SELECT *, substr(response, 1, 40) || chr(10) || '[TRUNCATED]' AS cut, regexp_extract_all(response, '{ANSWER_SQL}')[-1] AS last FROM rollouts) SELECT index, rollout_id, CASE WHEN response IS NULL THEN '' WHEN length(response) <= 40 THEN response WHEN last IS NOT NULL AND ends_with(response, last) AND NOT contains(cut, last) THEN cut || chr(10) || last ELSE cut END AS text FROM c")
def truncate_keep_answer(spark, d):
    return X.rollouts(spark, d).select("index", "rollout_id", T.truncate_keeping_answer(F.col("response"), 40).alias("text"))


@query("SELECT doc_id, regexp_replace('Q <' || doc_id || '>: ' || replace(CASE WHEN length(text) <= 20000 THEN text ELSE substr(text, 1, 20000) || chr(10) || '[TRUNCATED]' END, '{answer}', lang) || ' A: ' || lang, '^\\s+|\\s+$', '', 'g') AS prompt FROM documents")
def render_prompt(spark, d):
    return table(spark, d, "documents").select("doc_id", T.render("{image} Q <<<ID>>>: {question} A: <<ANSWER>>", {"question": F.col("text"), "answer": F.col("lang"), "id": F.col("doc_id")}).alias("prompt"))


@query("SELECT doc_id, 'Judge {' || coalesce(text, '') || '} as ' || lang AS prompt FROM documents")
def render_once(spark, d):
    return table(spark, d, "documents").select("doc_id", T.render_once("Judge {{{question}}} as {answer}", {"question": F.col("text"), "answer": F.col("lang")}).alias("prompt"))


@query(f"WITH {X.rollouts_sql()} SELECT index, rollout_id, coalesce(regexp_replace(regexp_extract_all(response, '{BODY_SQL}', 1)[-1], '^\\s+|\\s+$', '', 'g'), '') AS final_answer, coalesce(regexp_matches(response, '{ANSWER_SQL}'), false) AS has_answer_tag, CAST(length(response) AS INTEGER) AS response_chars FROM rollouts")
def extract_answer(spark, d):
    c = F.col("response")
    return X.rollouts(spark, d).select("index", "rollout_id", T.last_answer(c).alias("final_answer"), T.has_answer(c).alias("has_answer_tag"), F.length(c).alias("response_chars"))


@query(f"""WITH {X.rollouts_sql()}, s AS (SELECT index, rollout_id, response, {X.STRIP.format("response")} AS t FROM rollouts),
m AS (SELECT *, regexp_extract(t, '{ENDED_SENTENCE_SQL}') AS sentence, regexp_extract(t, '{ENDED_ANSWER_SQL}') AS tail FROM s)
SELECT index, rollout_id, CASE WHEN response IS NULL OR t = '' OR contains(lower(response), '<think>') THEN response WHEN sentence <> '' THEN '<think>' || chr(10) || {X.STRIP.format("left(t, length(t) - length(sentence))")} || chr(10) || '</think>' || chr(10) || {X.STRIP.format("sentence")} WHEN tail <> '' THEN '<think>' || chr(10) || {X.STRIP.format("left(t, length(t) - length(tail))")} || chr(10) || '</think>' || chr(10) || 'Therefore, the final answer is ' || {X.STRIP.format("tail")} ELSE '<think>' || chr(10) || t || chr(10) || '</think>' END AS response FROM m""")
def normalize_tags(spark, d):
    return X.rollouts(spark, d).select("index", "rollout_id", T.normalize_tags(F.col("response")).alias("response"))


@query(f"""WITH {X.rollouts_sql()}, m AS (SELECT index, rollout_id, response, regexp_extract(response, '{ENDED_BODY_SQL}') AS tail, regexp_extract(response, '{ENDED_BODY_SQL}', 1) AS body FROM rollouts)
SELECT index, rollout_id, CASE WHEN trim(body) <> '' THEN left(response, length(response) - length(tail) + 8 + length(body) - length(ltrim(body))) END AS prefix, CASE WHEN trim(body) <> '' THEN trim(body) END AS target FROM m""")
def split_for_score(spark, d):
    return X.rollouts(spark, d).select("index", "rollout_id", T.score_target(F.col("response")).alias("s")).select("index", "rollout_id", "s.prefix", "s.target")


@query("SELECT doc_id, coalesce(lower(trim(v)) IN ('1', 'true', 'yes', 'y', 'on'), false) AS flag FROM (SELECT doc_id, [' Yes', 'no', '1', 'TRUE', 'off', NULL, 'on '][doc_id % 7 + 1] AS v FROM documents)")
def as_bool(spark, d):
    v = F.element_at(F.array(*[F.lit(x) for x in (" Yes", "no", "1", "TRUE", "off", None, "on ")]), (F.col("doc_id") % 7 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", T.as_bool(v).alias("flag"))


QUESTION = "'Q ' || (doc_id % 9) || '. ' || lang || ' see https://a.example.org/x?y=1 now (2 points). Just give the answer.' || chr(10) || 'A. en' || chr(10) || 'B) de' || chr(10) || '(C) fr' || chr(10) || 'D. es'"


def questions(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang", F.concat(F.lit("Q "), (F.col("doc_id") % 9).cast("string"), F.lit(". "), "lang", F.lit(" see https://a.example.org/x?y=1 now (2 points). Just give the answer.\nA. en\nB) de\n(C) fr\nD. es")).alias("question"))


@query(f"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(question, 'https?://\\S+|www\\.\\S+', ' ', 'gi'), '[\\[(]\\s*\\d+\\s*(?:points?|marks?|pts?)\\s*[\\])]', ' ', 'gi'), '^\\s*(?:[Qq](?:uestion)?\\s*)?\\d+\\s*[.):]\\s+', ''), '[ \\t]+', ' ', 'g')) AS question FROM (SELECT doc_id, {QUESTION} AS question FROM documents)")
def strip_links(spark, d):
    return questions(spark, d).select("doc_id", T.strip_links(F.col("question")).alias("question"))


@query(f"SELECT doc_id, replace(question, 'Just give the answer.', 'Reason step by step, then give the final answer.') AS refined_question, contains(question, 'Just give') AS has_low_quality_instruction FROM (SELECT doc_id, {QUESTION} AS question FROM documents)")
def refine_instruction(spark, d):
    return questions(spark, d).select("doc_id", T.refine_instruction(F.col("question")).alias("x")).select("doc_id", F.col("x.refined").alias("refined_question"), F.col("x.low_quality").alias("has_low_quality_instruction"))


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'A. ' WHEN 'de' THEN 'B. ' WHEN 'fr' THEN 'C. ' WHEN 'es' THEN 'D. ' ELSE '' END || lang AS answer FROM documents")
def option_label(spark, d):
    return questions(spark, d).select("doc_id", T.option_label(F.col("question"), F.col("lang")).alias("answer"))


@query("SELECT doc_id, lower(regexp_replace(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g'), '[\\s.,;:!]+$', '')) AS canonical FROM documents")
def canonical_answer(spark, d):
    return table(spark, d, "documents").select("doc_id", T.canonical_answer(F.col("text")).alias("canonical"))


CONTRACT = ['{"answerable": true, "reason": "r"}', 'thinking\n{"reason": "r", "answerable": false}', '{"answerable": true}', '{"answerable": true, "reason": "r", "more": 1}', '```json\n{"answerable": true, "reason": "r"}\n```', '{"answerable": true, "reason": "r"} end']


def contract_rows(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.element_at(F.array(*[F.lit(x) for x in CONTRACT]), (F.col("doc_id") % 6 + 1).cast("int")).alias("output"))


CONTRACT_SQL = f"o AS (SELECT doc_id, [{', '.join(X.q(x) for x in CONTRACT)}][doc_id % 6 + 1] AS output FROM documents), l AS (SELECT doc_id, string_split(output, chr(10))[-1] AS line FROM o), c AS (SELECT doc_id, CASE WHEN json_valid(line) AND list_sort(json_keys(line)) = ['answerable', 'reason'] THEN line END AS line FROM l)"


@query(f"WITH {CONTRACT_SQL} SELECT doc_id, line FROM c")
def clean_contract(spark, d):
    return contract_rows(spark, d).select("doc_id", checks.stage_output(F.col("output"), checks.STAGE_KEYS["answerability"]).alias("line"))


@query(f"WITH {CONTRACT_SQL} SELECT doc_id FROM c WHERE json_extract_string(line, '$.answerable') = 'true'")
def answerability_filter(spark, d):
    v = checks.single_object(checks.stage_output(F.col("output"), checks.STAGE_KEYS["answerability"]))
    return contract_rows(spark, d).where(checks.field(v, "answerable", "BOOLEAN")).select("doc_id")


# Images ---------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, w, h, round(s, 6) AS scale, greatest(1, CAST(ceil(w * s) AS BIGINT)) AS new_w, greatest(1, CAST(ceil(h * s) AS BIGINT)) AS new_h, CASE WHEN least(w, h) >= 32 AND greatest(w, h) <= least(w, h) * 8.0 THEN true ELSE false END AS usable FROM (SELECT *, CASE WHEN greatest(w, h) > 2048 THEN 2048.0::DOUBLE / greatest(w, h) WHEN least(w, h) < 32 THEN 32.0::DOUBLE / least(w, h) ELSE 1.0::DOUBLE END AS s FROM (SELECT doc_id, doc_id * 37 % 5000 + 1 AS w, doc_id * 91 % 3000 + 1 AS h FROM documents))")
def image_scale(spark, d):
    rows = table(spark, d, "documents").select("doc_id", (F.col("doc_id") * 37 % 5000 + 1).alias("w"), (F.col("doc_id") * 91 % 3000 + 1).alias("h"))
    s = vision.scale(F.col("w"), F.col("h"))
    return rows.select("doc_id", "w", "h", F.round(s, 6).alias("scale"), vision.scaled(F.col("w"), s).alias("new_w"), vision.scaled(F.col("h"), s).alias("new_h"), vision.usable(F.col("w"), F.col("h")).alias("usable"))


@query("SELECT doc_id, 'data:image/jpeg;base64,' || base64(encode(text)) AS url FROM documents")
def data_url(spark, d):
    return table(spark, d, "documents").select("doc_id", vision.data_url(F.encode("text", "UTF-8")).alias("url"))


# Splits ---------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS index FROM orders")
def global_index(spark, d):
    return partition.global_index(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey")


@query("WITH s AS (SELECT ntile(7) OVER (ORDER BY doc_id) - 1 AS split FROM documents), n AS (SELECT count(*) AS n FROM documents) SELECT CAST(i AS INTEGER) AS split, count(s.split) AS rows, any_value(n.n) // 7 + CASE WHEN i < any_value(n.n) % 7 THEN 1 ELSE 0 END AS expected, true AS valid FROM range(7) t(i) CROSS JOIN n LEFT JOIN s ON s.split = i GROUP BY i")
def split_counts(spark, d):
    return partition.split_summary(partition.with_splits(table(spark, d, "documents").select("doc_id"), 7, "doc_id"), 7)


@query("SELECT CAST(split % 3 AS INTEGER) AS shard, count(*) AS expected FROM (SELECT ntile(10) OVER (ORDER BY doc_id) - 1 AS split FROM documents) GROUP BY 1")
def shard_expected(spark, d):
    rows = partition.with_splits(table(spark, d, "documents").select("doc_id"), 10, "doc_id")
    return rows.groupBy(partition.shard_of(F.col("split"), 3).alias("shard")).agg(F.count("*").alias("expected"))


@query("SELECT doc_id, TRY_CAST(nullif(regexp_extract(path, '(?:^|/)(\\d+)\\.[A-Za-z]+$', 1), '') AS INTEGER) AS split FROM (SELECT doc_id, '/data/' || source || '/' || CASE WHEN doc_id % 3 = 0 THEN 'part' ELSE '' END || doc_id || '.parquet' AS path FROM documents)")
def file_split(spark, d):
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), F.when(F.col("doc_id") % 3 == 0, "part").otherwise(""), F.col("doc_id").cast("string"), F.lit(".parquet"))
    return table(spark, d, "documents").select("doc_id", partition.file_split(path).alias("split"))


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM documents")
def id_projection(spark, d):
    return table(spark, d, "documents").select("doc_id")


# Rollout records ------------------------------------------------------------------------------------------------

GROUPED = f"g AS (SELECT index, count(*) AS n, count(error) AS failed, array_to_string(list(rollout_id ORDER BY rollout_id) FILTER (error IS NOT NULL), ',') AS failed_ids, min(rollout_id) FILTER (error IS NOT NULL) AS first_failed, bool_and(error IS NULL AND regexp_matches(response, '{ANSWER_SQL}')) AS complete FROM rollouts GROUP BY index)"


@query(f"WITH {X.rollouts_sql()}, {GROUPED} SELECT index, CAST(n AS INTEGER) AS num_rollouts, CAST(failed AS INTEGER) AS num_failed_rollouts, coalesce(failed_ids, '') AS failed_rollout_ids, failed < n AS rollout_valid FROM g")
def rollout_valid_any(spark, d):
    out = rollouts.validity_unless_all_failed(X.rollout_records(spark, d))
    return out.select("index", "num_rollouts", "num_failed_rollouts", F.array_join(F.col("failed_rollout_ids").cast("array<string>"), ",").alias("failed_rollout_ids"), "rollout_valid")


@query(f"WITH {X.rollouts_sql()}, {GROUPED} SELECT index, CAST(n - failed AS INTEGER) AS num_rollouts, CASE WHEN failed > 0 THEN 'timeout' END AS error, first_failed AS failed_rollout_id, failed = 0 AS rollout_valid FROM g")
def rollout_valid_all(spark, d):
    out = rollouts.validity_if_none_failed(X.rollout_records(spark, d))
    return out.select("index", F.size("rollouts").alias("num_rollouts"), "error", "failed_rollout_id", "rollout_valid")


@query(f"WITH {X.rollouts_sql()}, {GROUPED} SELECT index, failed < n AS done, coalesce(complete, false) AS tag_complete FROM g")
def tag_complete(spark, d):
    out = rollouts.validity_unless_all_failed(X.rollout_records(spark, d))
    return out.select("index", rollouts.done("rollout_valid", 4).alias("done"), rollouts.tag_complete().alias("tag_complete"))


@query("SELECT doc_id, CAST(r AS INTEGER) AS rollout_id, CAST(length(text) % 7 AS VARCHAR) AS final_answer, true AS has_answer_tag FROM documents, range(2) t(r)")
def generate_rollouts(spark, d):
    prompts = table(spark, d, "documents").select("doc_id", F.col("text").alias("prompt"))
    rows = generation.generate(prompts, generation.EchoClient(), 2, keys=("doc_id",))
    return generation.gathered(rows, ("doc_id",)).select("doc_id", F.explode("rollouts").alias("r")).select("doc_id", "r.rollout_id", "r.final_answer", "r.has_answer_tag")


SCORED = f"WITH {X.rollouts_sql()}, m AS (SELECT index, rollout_id, trim(regexp_extract(response, '{ENDED_BODY_SQL}', 1)) AS target FROM rollouts WHERE response IS NOT NULL), s AS (SELECT *, list_transform(string_split(target, ''), lambda c: -(ord(c) % 7) / 10.0::DOUBLE) AS lp FROM m)"


@query(f"{SCORED} SELECT index, rollout_id, CASE WHEN target = '' THEN 'no answer at the end' END AS score_error, CASE WHEN target <> '' THEN round(list_sum(lp) / len(lp), 6) END AS mean, CASE WHEN target <> '' THEN round(list_sum(lp), 6) END AS sum, CASE WHEN target <> '' THEN CAST(len(lp) AS BIGINT) ELSE 0 END AS count FROM s")
def score_candidates(spark, d):
    rows = X.rollouts(spark, d).where("response is not null").withColumn("prompt", F.lit("Q: "))
    return generation.score_candidates(rows, generation.EchoClient(), keys=("index", "rollout_id")).select("index", "rollout_id", "score_error", *r6("mean", "sum"), "count")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_anti(spark, d):
    return rollouts.not_done(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels").where("quality = 1"), "doc_id")


@query("SELECT doc_id, len(string_split(text, ' ')) <= 400 AS kept, CAST(least(len(string_split(text, ' ')), 5) AS INTEGER) AS tokens, array_to_string(string_split(text, ' ')[-5:], ' ') AS tail FROM documents")
def overlong_prompts(spark, d):
    tokens = F.split("text", " ")
    last = arrays.keep_last(tokens, 5)
    return table(spark, d, "documents").select("doc_id", (F.size(tokens) <= 400).alias("kept"), F.size(last).alias("tokens"), F.array_join(last, " ").alias("tail"))


# Selection ------------------------------------------------------------------------------------------------------


@query("SELECT vec_id // 4 AS id, CAST(vec_id % 4 AS INTEGER) AS rollout_id, vec_id % 20 + 1 AS prefix_length FROM embeddings")
def common_prefix(spark, d):
    return X.logprobs(spark, d).select("id", "rollout_id", arrays.common_prefix(F.col("prefix_ids"), F.col("full_ids")).alias("prefix_length"))


def scored(spark, d) -> DataFrame:
    return X.logprobs(spark, d).select("id", "rollout_id", arrays.target_score(F.col("prefix_ids"), F.col("full_ids"), F.col("logprobs")).alias("s")).select("id", "rollout_id", "s.*")


@query(f"WITH {X.SCORES_SQL} SELECT id, rollout_id, start, count, {s6('sum', 'mean')} FROM scores")
def answer_logprob(spark, d):
    return scored(spark, d).select("id", "rollout_id", "start", "count", *r6("sum", "mean"))


CANDIDATES = f"{X.SCORES_SQL}, cand AS (SELECT * FROM scores WHERE id % 5 <> 0 OR rollout_id = 1), best AS (SELECT id, count(*) AS n, first(rollout_id ORDER BY mean DESC, rollout_id) AS rid, first(mean ORDER BY mean DESC, rollout_id) AS mean, first(sum ORDER BY mean DESC, rollout_id) AS sum, first(count ORDER BY mean DESC, rollout_id) AS cnt FROM cand GROUP BY id)"


def candidates(spark, d) -> DataFrame:
    return scored(spark, d).where("id % 5 <> 0 or rollout_id = 1")


@query(f"WITH {CANDIDATES} SELECT id, n AS num_correct_rollouts, rid AS selected_rollout_id, CASE WHEN n > 1 THEN round(mean, 6) END AS answer_logprob_mean, CASE WHEN n > 1 THEN round(sum, 6) END AS answer_logprob_sum, CASE WHEN n > 1 THEN cnt ELSE 0 END AS answer_token_count, CASE WHEN n > 1 THEN 'max_normalized_answer_likelihood' ELSE 'single_correct_rollout' END AS selection_reason FROM best")
def best_of_n(spark, d):
    return selection.best_of_n(candidates(spark, d), "id").select("id", "num_correct_rollouts", "selected_rollout_id", *r6("answer_logprob_mean", "answer_logprob_sum"), "answer_token_count", "selection_reason")


@query(f"WITH {CANDIDATES}, l AS (SELECT id, array_to_string(list(rollout_id || ':' || CAST(count AS VARCHAR) ORDER BY rollout_id), ',') AS candidates FROM cand GROUP BY id) SELECT best.id, 'normalized_answer_likelihood' AS selection_method, n AS num_correct_rollouts, rid AS selected_rollout_id, 'r' || rid AS response, candidates FROM best JOIN l USING (id) JOIN documents d ON d.doc_id = best.id")
def best_records(spark, d):
    rows = candidates(spark, d)
    texts = rows.select("id", "rollout_id", F.concat(F.lit("r"), F.col("rollout_id").cast("string")).alias("response"), F.lit("").alias("final_answer"), F.lit(True).alias("has_answer_tag"), F.lit("stop").alias("finish_reason"), F.lit(2).alias("response_chars"))
    out = selection.best_records(table(spark, d, "documents").select(F.col("doc_id").alias("id")), texts, rows)
    listed = F.array_join(F.transform("candidate_scores", lambda x: F.concat_ws(":", x["rollout_id"].cast("string"), x["answer_token_count"].cast("string"))), ",")
    return out.select("id", "selection_method", "num_correct_rollouts", "selected_rollout_id", "best_rollout.response", listed.alias("candidates"))


@query(f"WITH {CANDIDATES} SELECT d.doc_id AS index, CAST(d.doc_id AS VARCHAR) AS id, d.lang AS domain, rid AS rollout_id, 'r' || rid AS response, n AS num_correct_rollouts, CASE WHEN n > 1 THEN round(mean, 6) END AS answer_logprob_mean, CAST(NULL AS VARCHAR) AS subtype FROM best JOIN documents d ON d.doc_id = best.id")
def final_rows(spark, d):
    best = selection.best_of_n(candidates(spark, d), "id").withColumnRenamed("id", "index")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("index"), F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("domain"))
    nested = docs.join(best, "index").withColumn("best_rollout", F.struct(F.col("selected_rollout_id").alias("rollout_id"), F.concat(F.lit("r"), F.col("selected_rollout_id").cast("string")).alias("response"), F.lit("").alias("final_answer"), F.lit(True).alias("has_answer_tag"), F.lit("stop").alias("finish_reason"), F.lit(2).alias("response_chars"), "selection_reason", "answer_logprob_mean", "answer_logprob_sum", "answer_token_count"))
    flat = selection.final_rows(nested.drop("selection_reason", "answer_logprob_mean", "answer_logprob_sum", "answer_token_count"))
    return flat.select("index", "id", "domain", "rollout_id", "response", "num_correct_rollouts", *r6("answer_logprob_mean"), "subtype")


@query("SELECT ntile(5) OVER (ORDER BY doc_id) - 1 AS split, row_number() OVER (ORDER BY doc_id) - 1 AS index, doc_id, quality FROM documents JOIN labels USING (doc_id) QUALIFY true")
def realign_splits(spark, d):
    rows = partition.with_splits(table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi"), 5, "doc_id")
    return selection.realigned(rows, table(spark, d, "labels").select("doc_id", "quality"), "doc_id").select(F.col("split").cast("long").alias("split"), "index", "doc_id", "quality")


@query("WITH e AS (SELECT doc_id AS id, count(*) AS e FROM documents WHERE doc_id % 10 <> 3 GROUP BY 1), g AS (SELECT doc_id AS id, count(*) AS g FROM (SELECT doc_id FROM documents WHERE doc_id % 10 <> 5 UNION ALL SELECT doc_id FROM documents WHERE doc_id % 10 = 7) GROUP BY 1), b AS (SELECT id, coalesce(e, 0) AS e, coalesce(g, 0) AS g FROM e FULL JOIN g USING (id)) SELECT id, 'missing' AS problem FROM b WHERE g = 0 UNION ALL SELECT id, 'extra' FROM b WHERE e = 0 UNION ALL SELECT id, 'duplicate_result' FROM b WHERE g > 1")
def completeness(spark, d):
    ids = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    got = ids.where("id % 10 <> 5").unionByName(ids.where("id % 10 = 7"))
    return selection.completeness(ids.where("id % 10 <> 3"), got)


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return selection.duplicate_keys(table(spark, d, "events"), "user_id", "event_type")


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def last_write_wins(spark, d):
    return selection.last_write(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("SELECT doc_id, lang FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, lang FROM documents WHERE lang <> 'en'")
def shard_union(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return docs.where("lang = 'en'").unionByName(docs.where("lang <> 'en'"))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def unseen_ids(spark, d):
    return table(spark, d, "documents").select("doc_id").subtract(table(spark, d, "labels").select("doc_id"))


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 0 INTERSECT SELECT doc_id FROM documents WHERE doc_id % 3 = 0")
def disjoint_check(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return docs.where("doc_id % 2 = 0").intersect(docs.where("doc_id % 3 = 0"))


@query("SELECT doc_id, source FROM documents ORDER BY source DESC, doc_id LIMIT 10")
def sorted_preview(spark, d):
    return table(spark, d, "documents").select("doc_id", "source").orderBy(F.desc("source"), "doc_id").limit(10)


# Progress -------------------------------------------------------------------------------------------------------


@query(f"WITH {X.rollouts_sql()}, {GROUPED}, l AS (SELECT CAST(index % 6 AS INTEGER) AS split, failed < n AS ok, failed < n AND coalesce(complete, false) AS done, failed > 0 AS bad FROM g WHERE index % 11 <> 0), t AS (SELECT i AS split, (SELECT count(*) FROM documents WHERE doc_id % 6 = i) AS rows, (SELECT count(*) FROM l WHERE split = i AND ok) AS valid, (SELECT count(*) FROM l WHERE split = i AND done) AS tag_complete, (SELECT count(*) FROM l WHERE split = i) AS lines, (SELECT count(*) FROM l WHERE split = i AND bad) AS failed_lines FROM (SELECT CAST(i AS INTEGER) AS i FROM range(6) r(i))) SELECT split, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(valid) AS BIGINT) AS valid, CAST(sum(tag_complete) AS BIGINT) AS tag_complete, CAST(sum(lines) AS BIGINT) AS lines, CAST(sum(failed_lines) AS BIGINT) AS failed_lines, round(100.0::DOUBLE * sum(valid) / sum(rows), 6) AS pct FROM t GROUP BY ROLLUP (split)")
def split_progress(spark, d):
    log = rollouts.validity_unless_all_failed(X.rollout_records(spark, d)).where("index % 11 <> 0").withColumn("split", (F.col("index") % 6).cast("int"))
    inputs = table(spark, d, "documents").groupBy((F.col("doc_id") % 6).cast("int").alias("split")).agg(F.count("*").alias("rows"))
    out = progress.rollout_progress(log, log.where("num_failed_rollouts > 0"), inputs, "rollout_valid", 4)
    return out.withColumn("pct", F.round("pct", 6))


@query(f"WITH {X.JUDGED_SQL}, {COUNTS}, c AS (SELECT *, CAST(index % 6 AS INTEGER) AS split FROM counts), t AS (SELECT split, count(*) AS rows, count(*) FILTER (verify_valid) AS done, sum(correct_count) FILTER (verify_valid) AS correct, sum(wrong_count) FILTER (verify_valid) AS wrong, sum(invalid_count) FILTER (verify_valid) AS invalid, sum(parse_failed_count) AS parse_failed FROM c GROUP BY split) SELECT split, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(done) AS BIGINT) AS done, CAST(sum(correct) AS BIGINT) AS correct, CAST(sum(wrong) AS BIGINT) AS wrong, CAST(sum(invalid) AS BIGINT) AS invalid, CAST(sum(parse_failed) AS BIGINT) AS parse_failed, round(100.0::DOUBLE * sum(done) / sum(rows), 6) AS pct, round(100.0::DOUBLE * sum(correct) / (sum(rows) * 4), 6) AS accuracy FROM t GROUP BY ROLLUP (split)")
def verify_progress(spark, d):
    log = counted(spark, d).select((F.col("index") % 6).cast("int").alias("split"), F.col("index").alias("id"), F.lit(2).alias("line"), "verify_valid", "correct_count", "wrong_count", "invalid_count", "parse_failed_count")
    stale = log.withColumns({"line": F.lit(1), "verify_valid": F.lit(True), "correct_count": F.lit(9).cast("long")})
    inputs = log.groupBy("split").agg(F.count("*").alias("rows"))
    out = progress.verify_progress(log.unionByName(stale), inputs, 4, ["line"])
    return out.withColumns({"pct": F.round("pct", 6), "accuracy": F.round("accuracy", 6)})


@query(f"WITH {CANDIDATES}, t AS (SELECT CAST(id % 3 AS INTEGER) AS shard, count(*) + 2 AS expected, count(*) AS done, count(*) FILTER (n = 1) AS single FROM best GROUP BY 1) SELECT shard, CAST(sum(expected) AS BIGINT) AS expected, CAST(sum(done) AS BIGINT) AS done, CAST(sum(single) AS BIGINT) AS single, CAST(sum(done) - sum(single) AS BIGINT) AS scored, round(100.0::DOUBLE * sum(done) / sum(expected), 6) AS pct FROM t GROUP BY ROLLUP (shard)")
def bestofn_progress(spark, d):
    rows = selection.best_of_n(candidates(spark, d), "id").withColumn("shard", (F.col("id") % 3).cast("int"))
    expected = rows.groupBy("shard").agg((F.count("*") + 2).alias("expected"))
    return selection.progress(rows, expected).withColumn("pct", F.round("pct", 6))


# Curation -------------------------------------------------------------------------------------------------------


@query("SELECT distill_model, count(*) AS n FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '9B' WHEN (doc_id + 3) % 5 = 0 THEN '27B' WHEN (doc_id + 6) % 5 = 0 THEN '122B' END AS distill_model FROM documents) WHERE distill_model IS NOT NULL GROUP BY 1")
def cascade_assign(spark, d):
    wide = table(spark, d, "documents").select("doc_id", F.posexplode(F.array(*[F.lit(t) for t in curation.TEACHERS])).alias("k", "teacher"))
    solved = wide.select("doc_id", "teacher", ((F.col("doc_id") + 3 * F.col("k")) % 5 == 0).alias("solved"))
    return curation.cascade(solved, "doc_id").groupBy("distill_model").agg(F.count("*").alias("n"))


DOMAINS = ["science", "mathematics", "spatial", "counting", "other"]
OUTCOMES = "o AS (SELECT doc_id, ['science', 'mathematics', 'spatial', 'counting', 'other'][doc_id % 5 + 1] AS domain, (doc_id * 3 + r * r) % 10 < doc_id % 12 AS correct FROM documents, range(8) t(r)), p AS (SELECT doc_id, domain, count(*) AS rollouts, count(*) FILTER (correct) AS passes, avg(CAST(correct AS INTEGER)) AS pass_rate FROM o GROUP BY ALL)"


def rates(spark, d) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.element_at(F.array(*[F.lit(x) for x in DOMAINS]), (F.col("doc_id") % 5 + 1).cast("int")).alias("domain"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("r"))
    return curation.pass_rates(rows.withColumn("correct", (F.col("doc_id") * 3 + F.col("r") * F.col("r")) % 10 < F.col("doc_id") % 12), "doc_id", "domain")


@query(f"WITH {OUTCOMES} SELECT doc_id, domain, rollouts, passes, pass_rate FROM p")
def pass_rates(spark, d):
    return rates(spark, d)


@query(f"WITH {OUTCOMES}, f AS (SELECT *, CASE WHEN domain IN ('science', 'mathematics') THEN 'analytical' WHEN domain IN ('spatial', 'counting') THEN 'real_world' END AS grp FROM p WHERE passes BETWEEN 1 AND 7) SELECT doc_id, domain, passes, grp FROM f WHERE grp IS NOT NULL QUALIFY row_number() OVER (PARTITION BY grp ORDER BY doc_id) <= 100")
def frontier_select(spark, d):
    rows = curation.frontier(rates(spark, d)).withColumn("grp", curation.group_of(F.col("domain"))).where("grp is not null")
    return curation.balanced(rows, "grp", 100, "doc_id").select("doc_id", "domain", "passes", "grp")


@query(f"WITH {X.JUDGED_SQL} SELECT index, rollout_id, 0.9::DOUBLE * CAST(label = 'A' AS INTEGER) + 0.1::DOUBLE * CAST(format_valid AS INTEGER) AS reward FROM labelled")
def reward_weighted(spark, d):
    return verification.judged(X.rollouts(spark, d)).select("index", "rollout_id", curation.reward(F.col("label") == "A", F.col("format_valid"), (0.9, 0.1)).alias("reward"))


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keeper FROM documents")
def exact_dedup(spark, d):
    return curation.exact_duplicates(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id", "keeper")


HASHES = "h AS (SELECT min(v) AS id, x FROM (SELECT vec_id AS v, (vec_id // 3) * 2654435761 % 1000003 * 4097 + vec_id % 3 * 5 AS x FROM embeddings) GROUP BY x)"


@query(f"WITH {HASHES} SELECT a.id AS a, b.id AS b, CAST(bit_count(xor(a.x, b.x)) AS INTEGER) AS distance FROM h a JOIN h b ON a.id < b.id AND bit_count(xor(a.x, b.x)) <= 3")
def perceptual_dedup(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", (F.floor(F.col("vec_id") / 3) * 2654435761 % 1000003 * 4097 + F.col("vec_id") % 3 * 5).cast("long").alias("hash"))
    return curation.hamming_pairs(rows, "vec_id", "hash", 3)


@query("WITH u AS (SELECT vec_id, label, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS n FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / (a.n * b.n) AS cosine FROM u a JOIN u b ON a.label = b.label AND a.vec_id < b.vec_id) SELECT a, b, round(cosine, 6) AS cosine FROM p WHERE cosine >= 0.35")
def semantic_dedup(spark, d):
    rows = table(spark, d, "embeddings").withColumnRenamed("label", "block")
    return curation.cosine_pairs(rows, "vec_id", "embedding", 0.35).withColumn("cosine", F.round("cosine", 6))


@query("SELECT CAST(ntile(7) OVER (ORDER BY doc_id) - 1 AS INTEGER) AS split, doc_id, lang, CASE lang WHEN 'de' THEN 'm-de' WHEN 'fr' THEN 'm-fr' ELSE 'm' END AS model, 'true' AS thinking FROM documents")
def config_splits(spark, d):
    """Documents split and routed as a nested configuration says, by its flat names."""
    flat = config.flatten({"num_splits": 7, "model": {"name": "m", "thinking": True, "by_lang": {"de": "m-de", "fr": "m-fr"}, "gpus": [1, 2]}})
    rows = partition.with_splits(table(spark, d, "documents").select("doc_id", "lang"), int(flat["NUM_SPLITS"]), "doc_id")
    own = F.try_element_at(F.create_map(*[F.lit(x) for k, v in flat.items() for x in (k, v)]), F.concat(F.lit("MODEL_BY_LANG_"), F.upper("lang")))
    return rows.select("split", "doc_id", "lang", F.coalesce(own, F.lit(flat["MODEL_NAME"])).alias("model"), F.lit(flat["MODEL_THINKING"]).alias("thinking"))


# Distillation ---------------------------------------------------------------------------------------------------


@query("SELECT user_id, event_type, CASE WHEN event_type < 'm' THEN 'expert-a' ELSE 'expert-r' END AS teacher FROM events")
def route_teacher(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", F.when(F.col("event_type") < "m", "analytical").otherwise("real_world").alias("key"))
    return distillation.routed(rows, {"analytical": "expert-a", "real_world": "expert-r"}, "key").select("user_id", "event_type", "teacher")


@query(f"WITH {X.LOGITS_SQL} SELECT seq_id, pos, token_id, CAST(rank AS INTEGER) AS rank FROM stop")
def topk_tokens(spark, d):
    return selection.top_tokens(X.logits(spark, d), ["seq_id", "pos"], 8).select("seq_id", "pos", "token_id", "rank")


@query(f"WITH {X.LOGITS_SQL} SELECT seq_id, pos, token_id, round(logprob, 6) AS logprob FROM student")
def log_softmax(spark, d):
    return distillation.log_softmax(X.logits(spark, d), ["seq_id", "pos"]).select("seq_id", "pos", "token_id", *r6("logprob"))


@query(f"WITH {X.LOGITS_SQL}, {X.losses_sql(True)} SELECT seq_id, pos, round(loss, 6) AS loss FROM losses")
def forward_kl_topk(spark, d):
    return X.positions(spark, d, "forward_kl_topk").select("seq_id", "pos", *r6("loss"))


@query(f"WITH {X.LOGITS_SQL}, {X.losses_sql(False)} SELECT seq_id, pos, round(loss, 6) AS loss FROM losses")
def reverse_kl_corrected(spark, d):
    return X.positions(spark, d, "reverse_kl_topk_corrected").select("seq_id", "pos", *r6("loss"))


@query(f"WITH {X.LOGITS_SQL}, {X.losses_sql(True)} SELECT seq_id, pos, {s6('student_mass', 'teacher_mass')} FROM losses")
def topk_mass(spark, d):
    return X.positions(spark, d, "forward_kl_topk").select("seq_id", "pos", *r6("student_mass", "teacher_mass"))


@query(f"WITH {X.LOGITS_SQL}, {X.losses_sql(False)} SELECT seq_id, pos, overlap_count, round(overlap_advantage, 6) AS overlap_advantage FROM losses")
def overlap_advantage(spark, d):
    return X.positions(spark, d, "reverse_kl_topk_corrected").select("seq_id", "pos", "overlap_count", *r6("overlap_advantage"))


METRICS = ["student_mass", "student_mass_min", "student_mass_max", "teacher_mass", "teacher_mass_min", "teacher_mass_max", "overlap_ratio", "overlap_advantage", "loss_min", "loss_max"]


@query(f"WITH {X.LOGITS_SQL}, {X.losses_sql(True)}, m AS (SELECT avg(student_mass) AS student_mass, min(student_mass) AS student_mass_min, max(student_mass) AS student_mass_max, avg(teacher_mass) AS teacher_mass, min(teacher_mass) AS teacher_mass_min, max(teacher_mass) AS teacher_mass_max, avg(overlap_count) / 8 AS overlap_ratio, coalesce(avg(overlap_advantage) FILTER (overlap_count > 0), 0.0) AS overlap_advantage, min(greatest(loss, 0.0)) AS loss_min, max(greatest(loss, 0.0)) AS loss_max FROM losses WHERE pos <> 0) SELECT {s6(*METRICS)} FROM m")
def distill_metrics(spark, d):
    return distillation.metrics(X.positions(spark, d, "forward_kl_topk"), 8).select(*r6(*METRICS))


@query(f"WITH {X.LOGITS_SQL}, {X.losses_sql(True)} SELECT round(avg(least(greatest(loss, 0.0), 10.0)), 6) AS loss FROM losses WHERE pos <> 0")
def loss_token_mean(spark, d):
    rows = X.positions(spark, d, "forward_kl_topk").withColumn("loss", distillation.clamped(distillation.floored(F.col("loss"))))
    return distillation.token_mean(rows).select(*r6("loss"))


@query(f"WITH {X.LOGITS_SQL}, {X.losses_sql(True)} SELECT round(avg(m), 6) AS loss FROM (SELECT avg(loss) AS m FROM losses WHERE pos <> 0 GROUP BY seq_id)")
def loss_seq_mean(spark, d):
    return distillation.sequence_mean(X.positions(spark, d, "forward_kl_topk")).select(*r6("loss"))


PAIRED = "e AS (SELECT vec_id, -abs(CAST(embedding[1] AS DOUBLE)) AS s, -abs(CAST(embedding[2] AS DOUBLE)) AS t FROM embeddings)"


def paired(spark, d) -> DataFrame:
    lp = lambda i: -F.abs(F.col("embedding")[i].cast("double"))
    return table(spark, d, "embeddings").select("vec_id", lp(0).alias("s"), lp(1).alias("t"))


@query(f"WITH {PAIRED} SELECT vec_id, round(s - t, 6) AS k1, round(abs(s - t), 6) AS abs, round(0.5 * (s - t) * (s - t), 6) AS k2, round(exp(t - s) - (t - s) - 1, 6) AS k3 FROM e")
def kl_estimators(spark, d):
    return paired(spark, d).select("vec_id", *[F.round(distillation.loss_of(n)(F.col("s"), F.col("t")), 6).alias(n) for n in ("k1", "abs", "k2", "k3")])


@query(f"WITH {PAIRED} SELECT vec_id, round((s - t) * 0.5 + s, 6) AS with_policy, round((s - t) * 0.5, 6) AS alone FROM e")
def combined_loss(spark, d):
    l = distillation.loss_of("k1")(F.col("s"), F.col("t"))  # noqa: E741
    return paired(spark, d).select("vec_id", F.round(distillation.combined(l, F.col("s"), 0.5, True), 6).alias("with_policy"), F.round(distillation.combined(l, F.col("s"), 0.5, False), 6).alias("alone"))


@query("SELECT vec_id, array_to_string(list_concat([0, 0], list_transform(embedding[1:3], lambda x: CAST(floor(x * 8) AS BIGINT)), [0]), ',') AS padded FROM embeddings")
def pad_teacher(spark, d):
    short = F.transform(F.slice("embedding", 1, 3), lambda x: F.floor(x * 8))
    return table(spark, d, "embeddings").select("vec_id", F.array_join(arrays.pad(short, 2, 1, 0).cast("array<string>"), ",").alias("padded"))


@query("SELECT vec_id, [CAST(i AS INTEGER) FOR i IN range(3)][vec_id % 3 + 1] AS token, round(-abs(CAST(embedding[vec_id % 3 + 1] AS DOUBLE)), 6) AS logprob FROM embeddings")
def zip_logprobs(spark, d):
    entry = F.create_map(*[x for i in range(3) for x in (F.lit(str(i)), -F.abs(F.col("embedding")[i].cast("double")))])
    ids = F.array((F.col("vec_id") % 3).cast("int"))
    return table(spark, d, "embeddings").select("vec_id", ids[0].alias("token"), F.round(arrays.actual_logprobs(ids, F.array(entry))[0], 6).alias("logprob"))


# Streaming and sources ------------------------------------------------------------------------------------------


@query("SELECT CAST(doc_id AS VARCHAR) AS id, true AS valid FROM documents WHERE length(text) > 0")
def stream_resume(spark, d):
    """Documents processed in two runs over a folder; the second run offers some again. Rows: id, valid."""
    from tessera.streaming import resume

    base = X.folder(spark, "stream")
    work = lambda b: b.select("id", (F.length("text") > 0).alias("valid"))
    for part in ("doc_id % 2 = 0", "doc_id % 2 = 1 or doc_id % 10 = 0"):
        table(spark, d, "documents").where(part).select(F.col("doc_id").cast("string").alias("id"), "text").write.mode("append").parquet(f"{base}/in")
        resume.run(spark, f"{base}/in", "id string, text string", f"{base}/out", f"{base}/failed", f"{base}/checkpoint", work)
    return resume.stored(spark, f"{base}/out").select("id", "valid")


@query("SELECT count(DISTINCT doc_id) AS done, count(DISTINCT doc_id) >= 10 AS enough, false AS all_done FROM labels WHERE quality = 1")
def distinct_done(spark, d):
    """Distinct valid keys of a log with repeated lines, and whether they are as many as expected."""
    from tessera.streaming import resume

    log = table(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("id"))
    log = log.unionByName(log)
    n = log.distinct().count()
    return log.agg(F.count_distinct("id").alias("done")).select("done", F.lit(resume.finished(log, 10)).alias("enough"), F.lit(resume.finished(log, n + 1) or resume.finished(log, n, failures=1)).alias("all_done"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, n_chars AS n FROM documents")
def jsonl_strict(spark, d):
    """A log that is written as JSON lines and read strictly."""
    from tessera.sources import records

    path = X.folder(spark, "log")
    records.append_jsonl(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("n_chars").alias("n")), path)
    return records.jsonl(spark, path, "id string, n long", strict=True)[0]


@query("SELECT doc_id AS id, lang, 2 AS n FROM documents")
def append_log(spark, d):
    """Appending twice leaves each line twice."""
    from tessera.sources import records

    path = X.folder(spark, "log")
    for _ in range(2):
        records.append_jsonl(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "text"), path)
    return records.jsonl(spark, path, "id long, lang string, text string")[0].groupBy("id", "lang").agg(F.count("*").alias("n"))


@query("SELECT doc_id, lang, CASE WHEN lang = 'de' THEN -n_chars ELSE n_chars END AS n_chars, true AS zstd FROM documents")
def atomic_parquet(spark, d):
    """A table of zstd files by language, of which one partition is replaced."""
    from tessera.sources import records

    path = X.folder(spark, "table")
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    records.write_parquet(docs, path, "lang")
    records.write_parquet(docs.where("lang = 'de'").withColumn("n_chars", -F.col("n_chars")), path, "lang")
    return records.parquet(spark, path).select("doc_id", "lang", "n_chars", F.col("_metadata.file_name").contains(".zstd.").alias("zstd"))


@query("SELECT doc_id AS id, doc_id % 3 <> 0 AS ok, CASE WHEN doc_id % 3 <> 0 THEN 'good' ELSE 'bad' END AS log FROM documents UNION ALL SELECT doc_id, false, 'both' FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, true, 'both' FROM documents WHERE doc_id % 3 <> 0")
def dual_sink(spark, d):
    """Valid rows to one log, others to another; and the same with all rows in the first."""
    from tessera.sources import records

    path, out = X.folder(spark, "logs"), None
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), (F.col("doc_id") % 3 != 0).alias("ok"))
    records.write_both(rows, "ok", f"{path}/good", f"{path}/bad")
    records.write_both(rows, "ok", f"{path}/both", f"{path}/rest", both=True)
    for log in ("good", "bad", "both"):
        one = records.jsonl(spark, f"{path}/{log}", "id long, ok boolean", strict=True)[0].withColumn("log", F.lit(log))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT CAST(ntile(7) OVER (ORDER BY doc_id) - 1 AS INTEGER) AS split, row_number() OVER (ORDER BY doc_id) - 1 AS index, doc_id FROM documents")
def adopted_splits(spark, d):
    """Split files written one by one and adopted again by their names."""
    from tessera.sources import records

    path = X.folder(spark, "splits")
    records.write_splits(partition.with_splits(table(spark, d, "documents").select("doc_id"), 7, "doc_id"), path)
    return records.adopted_splits(spark, path, 7).select("split", "index", "doc_id")


@query("SELECT doc_id, lang, l.quality FROM documents JOIN (SELECT doc_id, quality FROM labels) l USING (doc_id)")
def strict_join(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    rows = table(spark, d, "documents").select("doc_id", "lang").join(labels.select("doc_id"), "doc_id", "left_semi")
    return selection.joined_strictly(rows, labels, ["doc_id"])


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN ' <think>' || text WHEN text IS NULL THEN NULL ELSE '<think>' || text END AS response, text AS plain FROM documents")
def think_start(spark, d):
    c = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" <think>"), "text")).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", T.with_think_start(c).alias("response"), T.with_think_start(F.col("text"), thinking=False).alias("plain"))


@query("SELECT doc_id AS index, CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id AS VARCHAR) ELSE 's' || doc_id END AS id, text AS question, source, lang AS domain, CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id AS VARCHAR) ELSE 's' || doc_id END AS key FROM documents")
def sample_metadata(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("index"), F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("s"), F.col("doc_id").cast("string"))).alias("id"), F.col("text").alias("question"), "source", F.col("lang").alias("domain"), "n_chars")
    return rows.select(*rollouts.metadata(rows), rollouts.key(rows).alias("key"))


@query("SELECT doc_id, [0.0, 16256.25, 33.25, NULL][doc_id % 4 + 1] AS spread, [0.0, 260100.0, 0.0, NULL][doc_id % 4 + 1] AS edges, [0, 0, -1, NULL][doc_id % 4 + 1] AS dhash FROM documents")
def image_quality(spark, d):
    """Blankness, blur and difference hash of made images, of which a quarter can't be read."""
    rows = vision.difference_hash(vision.sharpness(X.images(spark, d)))
    return rows.select("doc_id", "spread", "edges", "dhash")


@query("SELECT doc_id, CAST(r AS INTEGER) AS rollout_id, CAST(length(text) % 7 AS VARCHAR) AS final_answer, 'stop' AS finish_reason, CAST(NULL AS VARCHAR) AS error FROM documents, range(2) t(r)")
def generate_retry(spark, d):
    """Calls of which a third fail at first: each is tried again by itself, eight at a time in a task."""
    prompts = table(spark, d, "documents").select("doc_id", F.col("text").alias("prompt"))
    rows = generation.generate(prompts, X.flaky_client(), 2, retries=3, wait=0, in_flight=8, keys=("doc_id",))
    return generation.gathered(rows, ("doc_id",)).select("doc_id", F.explode("rollouts").alias("r")).select("doc_id", "r.rollout_id", "r.final_answer", "r.finish_reason", "r.error")


@query("SELECT n AS name, vec_id, round(CASE n WHEN 'abs' THEN abs(s - t) WHEN 'kl' THEN s - t WHEN 'k1' THEN s - t WHEN 'mse' THEN 0.5 * (s - t) * (s - t) WHEN 'k2' THEN 0.5 * (s - t) * (s - t) WHEN 'low_var_kl' THEN exp(t - s) - (t - s) - 1 ELSE exp(t - s) - (t - s) - 1 END, 6) AS loss FROM (SELECT vec_id, -abs(CAST(embedding[1] AS DOUBLE)) AS s, -abs(CAST(embedding[2] AS DOUBLE)) AS t FROM embeddings), (VALUES ('abs'), ('kl'), ('k1'), ('mse'), ('k2'), ('low_var_kl'), ('k3')) v(n)")
def loss_registry(spark, d):
    """Every registered loss of one token, by its name."""
    names = [n for n in distillation.LOSSES if "topk" not in n]
    one = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.round(distillation.loss_of(n)(F.col("s"), F.col("t")), 6).alias("loss")) for n in names]))
    return paired(spark, d).select("vec_id", one.alias("x")).select("x.name", "vec_id", "x.loss")


@query("SELECT CAST(doc_id AS VARCHAR) AS id, n_chars AS n, CAST(NULL AS VARCHAR) AS line FROM documents WHERE doc_id % 4 <> 1 UNION ALL SELECT NULL, NULL, '{\"id\": ' FROM documents WHERE doc_id % 4 = 1")
def jsonl_tolerant(spark, d):
    """A log with unreadable and blank lines, written and read again."""
    from tessera.sources import records

    docs = table(spark, d, "documents")
    path = X.folder(spark, "log")
    good = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("n_chars").alias("n")))
    docs.select(F.when(F.col("doc_id") % 4 == 1, '{"id": ').when(F.col("doc_id") % 4 == 2, F.concat(good, F.lit("\n"))).otherwise(good).alias("value")).write.text(path)
    rows, bad = records.jsonl(spark, path, "id string, n long")
    return rows.withColumn("line", F.lit(None).cast("string")).unionByName(bad.select(F.lit(None).cast("string").alias("id"), F.lit(None).cast("long").alias("n"), "line"))
