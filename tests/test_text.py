"""Golden values of the text and JSON contracts."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays, checks, vision
from tessera.functions import text as T

T7 = "Therefore, the final answer is <answer>7</answer>"


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(("response", "answer", "found", "target", "error"), [
    ("<think>a</think><answer> 7 </answer>", "7", True, "7", ""),
    ("<think>a</think><answer>7</answer>.", "7", True, "7", "bad_final_line"),
    ("<think>a</think><answer>1</answer> m <answer>2</answer>", "2", True, "1</answer> m <answer>2", ""),
    ("<think>a</think><answer></answer>", "", True, None, ""),
    ("<think>a</think> no tag", "", False, None, "missing_answer_tag"),
    ("<answer>7</answer>", "7", True, "7", "missing_think_tag"),
    ("<think>a</think><answer>7</answer> tail", "7", True, None, "bad_final_line"),
    ("", "", False, None, "missing_think_tag"),
    (None, "", False, None, "missing_think_tag"),
])
def test_answers(spark, response, answer, found, target, error):
    c = F.col("r")
    r = spark.createDataFrame([(response,)], "r string").select(T.last_answer(c).alias("a"), T.has_answer(c).alias("f"), T.score_target(c)["target"].alias("t"), T.format_error(c).alias("e")).first()
    assert tuple(r) == (answer, found, target, error)


@pytest.mark.parametrize(("given", "want"), [
    ("x <THINK> y", "x <THINK> y"),
    (f"r\n{T7}.", f"<think>\nr\n</think>\n{T7}."),
    ("r <answer>7</answer>", f"<think>\nr\n</think>\n{T7}"),
    ("<answer>7</answer>", f"<think>\n\n</think>\n{T7}"),
    (f"r {T7}", f"<think>\nr Therefore, the final answer is\n</think>\n{T7}"),
    ("just text", "<think>\njust text\n</think>"),
    ("  \n", "  \n"),
    ("", ""),
    (None, None),
])
def test_normalize_tags(spark, given, want):
    assert one(spark, T.normalize_tags(F.col("r")), r=given) == want


def test_prefix_and_unclosed_tag(spark):
    assert one(spark, T.score_target(F.col("r"))["prefix"], r="p <answer>  7 </answer>.\n") == "p <answer>  "
    assert one(spark, T.has_answer(F.col("r")), r="<answer>" + " " * 50_000) is False


def test_render_order(spark):
    assert one(spark, T.render("{question}|{answer}", {"question": F.col("q"), "answer": F.col("a")}), q="see {answer}", a="7") == "see 7|7"
    assert one(spark, T.render_once("{question}|{answer}", {"question": F.col("q"), "answer": F.col("a")}), q="see {answer}", a="7") == "see {answer}|7"


def test_strip_and_truncate(spark):
    assert one(spark, T.strip(F.col("r")), r=" \x1c a b \x1f\n") == "a b"
    assert one(spark, T.truncate(F.col("r"), 2), r="héllo") == "hé\n[TRUNCATED]"
    assert one(spark, T.truncate_keeping_answer(F.col("r"), 5), r="12345678<answer>9</answer>\n") == "12345\n[TRUNCATED]\n<answer>9</answer>"


OK = '{"verdict": "correct", "reasoning_consistent": true, "reason": "r"}'


@pytest.mark.parametrize(("text", "parsed"), [
    (OK, True),
    ('{"verdict": "correct", "reasoning_consistent": true, "reason": "r", "more": [1]}', True),
    (f" {OK}\n", True),
    ('{"verdict": "correct", "reasoning_consistent": "true", "reason": "r"}', False),
    ('{"verdict": "correct", "reasoning_consistent": 1, "reason": "r"}', False),
    ('{"verdict": "correct", "reasoning_consistent": true, "reason": 5}', False),
    ("{'verdict': 'correct', 'reasoning_consistent': true, 'reason': 'r'}", False),
    (f"{OK} tail", False),
    (f"{OK}, {OK}", False),
    (f"```json\n{OK}\n```", False),
    (f"[{OK}]", False),
    ('"correct"', False),
    ("", False),
    (None, False),
    ('{"verdict": "correct", "reasoning_consistent": true, "reason": "a\nb"}', False),
    ('{"verdict": "correct", "reasoning_consistent": true, "reason": NaN}', False),
    ('{"verdict": "unsure", "reasoning_consistent": true, "reason": "r"}', False),
])
def test_verdict(spark, text, parsed):
    v = spark.createDataFrame([(text,)], "r string").select(checks.verdict(F.col("r")).alias("v")).first().v
    assert v.parsed is parsed
    assert (v.verdict, v.reasoning_consistent) == (("correct", True) if parsed else ("incorrect", False))


@pytest.mark.parametrize(("size", "want"), [((100, 100), 1.0), ((16, 100), 2.0), ((4096, 1000), 0.5), ((16, 4096), 0.5), ((32, 2048), 1.0)])
def test_scale(spark, size, want):
    assert spark.createDataFrame([size], "w int, h int").select(vision.scale(F.col("w"), F.col("h")).alias("s")).first().s == want


@pytest.mark.parametrize(("prefix", "full", "lp", "want"), [
    ([1, 2, 3], [1, 2, 3, 4, 5], [None, -1.0, -2.0, -0.5, -0.25], (3, -0.75, 2, -0.375)),
    ([1, 2, 9], [1, 2, 3, 4], [None, -1.0, -0.4, None], (2, -0.4, 1, -0.4)),
    ([1], [1, 2], [None, None], (1, None, 0, None)),
    ([], [], [], (0, None, 0, None)),
])
def test_target_score(spark, prefix, full, lp, want):
    df = spark.createDataFrame([(prefix, full, lp)], "p array<int>, f array<int>, l array<double>")
    assert tuple(df.select(arrays.target_score(F.col("p"), F.col("f"), F.col("l")).alias("s")).first().s) == want


def test_lengths_must_match(spark):
    df = spark.createDataFrame([([1, 2], [{"1": -1.0}])], "i array<int>, e array<map<string,double>>")
    with pytest.raises(Exception, match="differ in length"):
        df.select(arrays.actual_logprobs(F.col("i"), F.col("e"))).collect()
