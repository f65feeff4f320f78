"""Rollouts, verdicts, log-probs and logits derived from the driver's tables by portable arithmetic, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table

N = 4
TEMPLATES = [
    "<think>step {id}</think>\nTherefore, the final answer is <answer>{a}</answer>",
    "so <answer> {a} </answer>",
    "<think>x</think> no tag",
    "<think>a</think><answer>{a}</answer>.",
    "<think>a</think><answer>1</answer> m <answer>{a}</answer>",
]
VERDICTS = [
    '{"verdict": "correct", "reasoning_consistent": true, "reason": "ok"}',
    '{"verdict": "correct", "reasoning_consistent": true, "reason": "ok", "extra": 1}',
    '{"verdict": "correct", "reasoning_consistent": true, "reason": "fine"}',
    '{"verdict": "incorrect", "reasoning_consistent": true, "reason": " bad "}',
    '{"verdict": "correct", "reasoning_consistent": false, "reason": "gap"}',
    '{"verdict": "correct", "reasoning_consistent": "true", "reason": "x"}',
    '{"verdict": "correct", "reasoning_consistent": true, "reason": "x"} tail',
    "not json",
    '{"verdict": "maybe", "reasoning_consistent": true, "reason": "x"}',
]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("index"), F.col("doc_id").cast("string").alias("id"), F.col("text").alias("question"), F.pmod("n_chars", F.lit(7)).cast("string").alias("answer"), F.col("lang").alias("domain"), "source")


def rollouts(spark: SparkSession, sf_dir: str, n: int = N) -> DataFrame:
    """index, rollout_id, domain, response, error, verifier_response."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("index"), F.col("lang").alias("domain"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("rollout_id"))
    kind = (F.col("index") * 7 + F.col("rollout_id")) % 6
    a = ((F.col("index") + F.col("rollout_id")) % 5).cast("string")
    response = F.lit(None).cast("string")
    for i, t in enumerate(TEMPLATES):
        response = F.when(kind == i, F.replace(F.replace(F.lit(t), F.lit("{id}"), F.col("index").cast("string")), F.lit("{a}"), a)).otherwise(response)
    v = F.element_at(F.array(*[F.lit(x) for x in VERDICTS]), ((F.col("index") * 5 + F.col("rollout_id")) % 9 + 1).cast("int"))
    return rows.select("index", "rollout_id", "domain", response.alias("response"), F.when(kind == 5, "timeout").alias("error"), v.alias("verifier_response"))


def q(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def rollouts_sql(n: int = N) -> str:
    cases = " ".join(f"WHEN {i} THEN replace(replace({q(t)}, '{{id}}', CAST(doc_id AS VARCHAR)), '{{a}}', CAST((doc_id + r) % 5 AS VARCHAR))" for i, t in enumerate(TEMPLATES))
    verdicts = ", ".join(q(v) for v in VERDICTS)
    return f"rollouts AS (SELECT doc_id AS index, CAST(r AS INTEGER) AS rollout_id, lang AS domain, CASE (doc_id * 7 + r) % 6 {cases} END AS response, CASE WHEN (doc_id * 7 + r) % 6 = 5 THEN 'timeout' END AS error, [{verdicts}][(doc_id * 5 + r) % 9 + 1] AS verifier_response FROM documents, range({n}) t(r))"


STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
JUDGED_SQL = (
    rollouts_sql()
    + """, judged AS (SELECT *, CASE WHEN NOT regexp_matches(s, '(?is)<think>.*?</think>') THEN 'missing_think_tag' WHEN NOT regexp_matches(s, '(?is)<answer>.*?</answer>') THEN 'missing_answer_tag' WHEN NOT regexp_matches(s, '(?is)<answer>.*?</answer>\\s*$') THEN 'bad_final_line' ELSE '' END AS format_error,
 ok AS parsed, CASE WHEN ok THEN json_extract_string(j, '$.verdict') ELSE 'incorrect' END AS verdict, CASE WHEN ok THEN CAST(json_extract(j, '$.reasoning_consistent') AS BOOLEAN) ELSE false END AS reasoning_consistent, CASE WHEN ok THEN trim(json_extract_string(j, '$.reason')) ELSE 'Verifier output did not match the required JSON schema.' END AS reason
 FROM (SELECT *, coalesce(regexp_replace(response, '^\\s+|\\s+$', '', 'g'), '') AS s, j IS NOT NULL AND coalesce(json_extract_string(j, '$.verdict') IN ('correct', 'incorrect') AND json_type(j, '$.reasoning_consistent') = 'BOOLEAN' AND json_type(j, '$.reason') = 'VARCHAR', false) AS ok
  FROM (SELECT *, CASE WHEN json_valid(verifier_response) THEN verifier_response END AS j FROM rollouts))),
labelled AS (SELECT *, format_error = '' AS format_valid, CASE WHEN verdict = 'correct' AND reasoning_consistent THEN 'A' ELSE 'B' END AS label FROM judged)"""
)


def flaky_client():
    """Fails the first time that it is asked for a prompt whose length is a multiple of 3."""
    from tessera.operators.generation import EchoClient

    class Flaky(EchoClient):
        def open(self):
            self.asked = set()
            return self

        def complete(self, prompt, image=None, sampling=None):
            if len(prompt) % 3 == 0 and prompt not in self.asked:
                self.asked.add(prompt)
                raise RuntimeError("not yet")
            return super().complete(prompt, image, sampling)

    return Flaky()


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and an image of 20 x 20 grey pixels: even, stripes, a falling ramp, or unreadable."""
    kinds = [(20, "5A" * 400), (20, "00FF" * 200), (20, "".join(f"{255 - i:02X}" for i in range(20)) * 20), (-1, "")]
    image = F.array(*[F.struct(F.lit("x").alias("origin"), F.lit(n).alias("height"), F.lit(n).alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"), F.unhex(F.lit(x)).alias("data")) for n, x in kinds])
    return table(spark, sf_dir, "documents").select("doc_id", F.element_at(image, (F.col("doc_id") % 4 + 1).cast("int")).alias("image"))


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared one."""
    import uuid

    from tessera.session import shared_dir

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def rollout_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators.generation import gathered

    return gathered(rollouts(spark, sf_dir), ("index", "domain"))


def logprobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, rollout_id, prefix_ids, full_ids, logprobs: four candidates a sample; the prefix parts from the full text at a place of its own."""
    e = table(spark, sf_dir, "embeddings")
    start = F.pmod("vec_id", F.lit(20)) + 1
    ids = F.transform("embedding", lambda x, i: i + 1)
    return e.select(
        F.floor(F.col("vec_id") / 4).alias("id"), F.pmod("vec_id", F.lit(4)).cast("int").alias("rollout_id"), F.concat(F.slice(ids, F.lit(1), start.cast("int")), F.array(F.lit(999))).alias("prefix_ids"),
        ids.alias("full_ids"), F.transform("embedding", lambda x, i: F.when(i % 13 != 0, -F.abs(x.cast("double")))).alias("logprobs"),
    )


SCORES_SQL = """scores AS (SELECT vec_id // 4 AS id, CAST(vec_id % 4 AS INTEGER) AS rollout_id, vec_id % 20 + 1 AS start, sum(lp) AS sum, count(lp) AS count, sum(lp) / count(lp) AS mean FROM (SELECT vec_id, i, CASE WHEN i % 13 <> 0 THEN -abs(CAST(embedding[i + 1] AS DOUBLE)) END AS lp FROM embeddings, range(64) t(i)) WHERE i >= vec_id % 20 + 1 GROUP BY vec_id)"""


def logits(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """seq_id, pos, token_id, logit: four positions a sequence; shift takes the logits of a later vector."""
    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") - shift).alias("v"), "embedding").where("v >= 0")
    return e.select(F.floor(F.col("v") / 4).alias("seq_id"), F.pmod("v", F.lit(4)).alias("pos"), F.posexplode("embedding").alias("token_id", "logit")).withColumn("logit", F.col("logit").cast("double"))


LOGITS_SQL = """student0 AS (SELECT vec_id // 4 AS seq_id, vec_id % 4 AS pos, CAST(i AS INTEGER) AS token_id, CAST(embedding[i + 1] AS DOUBLE) AS logit FROM embeddings, range(64) t(i)),
teacher0 AS (SELECT (vec_id - 1) // 4 AS seq_id, (vec_id - 1) % 4 AS pos, CAST(i AS INTEGER) AS token_id, CAST(embedding[i + 1] AS DOUBLE) AS logit FROM embeddings, range(64) t(i) WHERE vec_id >= 1),
sn AS (SELECT seq_id, pos, max(logit) AS m FROM student0 GROUP BY ALL), sz AS (SELECT seq_id, pos, any_value(m) + ln(sum(exp(logit - m))) AS z FROM student0 JOIN sn USING (seq_id, pos) GROUP BY ALL),
student AS (SELECT seq_id, pos, token_id, logit, logit - z AS logprob FROM student0 JOIN sz USING (seq_id, pos)),
tn AS (SELECT seq_id, pos, max(logit) AS m FROM teacher0 GROUP BY ALL), tz AS (SELECT seq_id, pos, any_value(m) + ln(sum(exp(logit - m))) AS z FROM teacher0 JOIN tn USING (seq_id, pos) GROUP BY ALL),
teacher AS (SELECT seq_id, pos, token_id, logit - z AS logprob, row_number() OVER (PARTITION BY seq_id, pos ORDER BY logit DESC, token_id) AS rank FROM teacher0 JOIN tz USING (seq_id, pos)),
stop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq_id, pos ORDER BY logit DESC, token_id) AS rank FROM student) WHERE rank <= 8),
ttop AS (SELECT * FROM teacher WHERE rank <= 8)"""


def losses_sql(forward: bool) -> str:
    floor = "greatest({}, -10.0)"
    s, t = floor.format("s.logprob"), floor.format("coalesce(t.logprob, -10.0)")
    base = "ttop t JOIN student s USING (seq_id, pos, token_id) LEFT JOIN stop o USING (seq_id, pos, token_id)" if forward else "stop s LEFT JOIN ttop t USING (seq_id, pos, token_id)"
    both = "o.token_id IS NOT NULL" if forward else "t.logprob IS NOT NULL"
    l = f"exp({t}) * ({t} - {s})" if forward else f"exp({s}) * ({s} - {t}) - exp({s}) + exp({t})"  # noqa: E741
    return f"losses AS (SELECT seq_id, pos, sum(l) AS loss, sum(exp(sl)) AS student_mass, coalesce(sum(exp(tl)), 0.0) AS teacher_mass, count(*) FILTER (b) AS overlap_count, coalesce(sum(-l) FILTER (b) / nullif(count(*) FILTER (b), 0), 0.0) AS overlap_advantage FROM (SELECT seq_id, pos, {l} AS l, s.logprob AS sl, t.logprob AS tl, {both} AS b FROM {base}) GROUP BY seq_id, pos)"


def positions(spark: SparkSession, sf_dir: str, loss: str, k: int = 8) -> DataFrame:
    from tessera.operators import distillation as D
    from tessera.operators.selection import top_tokens

    keys = ["seq_id", "pos"]
    student = D.log_softmax(logits(spark, sf_dir), keys)
    teacher = top_tokens(D.log_softmax(logits(spark, sf_dir, 1), keys), keys, k)
    return D.topk_losses(student, teacher, top_tokens(student, keys, k), keys, loss).withColumn("is_response", F.col("pos") != 0)
