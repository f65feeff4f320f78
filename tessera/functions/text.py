"""Text functions as Column builders; no Python runs on executors.

Blanks at the ends are those of Unicode and \\x1c-\\x1f; tags are matched in any
case and across lines. Patterns avoid a blank run next to a lazy group, which
would backtrack cubically on an unclosed tag.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Limits and markers of the record formats.
PROMPT_CHARS, VERIFIER_CHARS, CUT_MARK = 20_000, 50_000, "\n[TRUNCATED]"
SENTENCE = "Therefore, the final answer is "
ANSWER = r"(?is)<answer>(.*?)</answer>"
ENDED_ANSWER = r"(?isU)<answer>(.*?)</answer>\.?\s*\z"
ENDED_SENTENCE = r"(?isU)(?:\A|\n)\s*(therefore,\s*the\s*final\s*answer\s*is\s*<answer>.*?</answer>\.?)\s*\z"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", F.lit(""))


def truncate(c: Column, chars: int = PROMPT_CHARS) -> Column:
    """Null becomes empty; longer texts keep their first characters and a mark."""
    return F.when(c.isNull(), "").when(F.length(c) <= chars, c).otherwise(F.concat(F.substring(c, 1, chars), F.lit(CUT_MARK)))


def truncate_keeping_answer(c: Column, chars: int = VERIFIER_CHARS) -> Column:
    """truncate(), and the last answer block once more if it ends the text and was cut off."""
    cut = truncate(c, chars)
    last = F.try_element_at(F.regexp_extract_all(c, F.lit(r"(?is)<answer>.*?</answer>"), F.lit(0)), F.lit(-1))
    lost = last.isNotNull() & strip(c).endswith(strip(last)) & ~F.contains(cut, last)
    return F.when((F.length(c) > chars) & lost, F.concat(cut, F.lit("\n"), last)).otherwise(cut)


def render(template: str, fields: Mapping[str, Column]) -> Column:
    """The template with {name} and <<NAME>> replaced one after another, so that a mark inside an earlier value is replaced too; then stripped. Images are left out."""
    out = F.lit(template)
    for name, value in {"image": F.lit(""), **fields}.items():
        value = truncate(value.cast("string"))
        for mark in (f"{{{name}}}", f"<<{name.upper()}>>"):
            out = F.replace(out, F.lit(mark), value)
    return strip(out)


def render_once(template: str, fields: Mapping[str, Column]) -> Column:
    """The template's {name} marks replaced in one pass: inserted values are not searched again. {{ and }} stand for braces."""
    from string import Formatter

    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(F.coalesce(fields[name].cast("string"), F.lit("")))
    return F.concat(*pieces) if pieces else F.lit("")


def last_answer(c: Column) -> Column:
    """The body of the last answer block, stripped; empty if there is none."""
    return F.coalesce(strip(F.try_element_at(F.regexp_extract_all(c, F.lit(ANSWER), F.lit(1)), F.lit(-1))), F.lit(""))


def has_answer(c: Column) -> Column:
    """Whether there is an answer block; an empty one counts."""
    return F.coalesce(c.rlike(ANSWER), F.lit(False))


def with_think_start(c: Column, thinking: bool = True) -> Column:
    """A response to a thinking prompt begins inside the think block: its opening tag is put back."""
    return F.when(~F.regexp_replace(c, r"(?U)\A[\s\x1c-\x1f]+", F.lit("")).startswith("<think>"), F.concat(F.lit("<think>"), c)).otherwise(c) if thinking else c


def normalize_tags(c: Column) -> Column:
    """Responses without think tags get them: around what stands before the final sentence or the final answer block, else around all."""
    text = strip(c)

    def wrap(reasoning: Column, ending: Column) -> Column:
        return F.concat(F.lit("<think>\n"), strip(reasoning), F.lit("\n</think>\n"), ending)

    sentence = strip(F.regexp_extract(text, ENDED_SENTENCE, 1))
    whole_sentence = F.regexp_substr(text, F.lit(ENDED_SENTENCE))
    tail = F.regexp_substr(text, F.lit(ENDED_ANSWER))
    before = lambda found: F.substring(text, F.lit(1), F.length(text) - F.length(found))
    done = F.when(whole_sentence.isNotNull(), wrap(before(whole_sentence), sentence)).when(tail.isNotNull(), wrap(before(tail), F.concat(F.lit(SENTENCE), strip(tail)))).otherwise(F.concat(F.lit("<think>\n"), text, F.lit("\n</think>")))
    return F.when(c.isNull() | (text == "") | F.contains(F.lower(c), F.lit("<think>")), c).otherwise(done)


def format_error(c: Column) -> Column:
    """Empty if the response has a think block, an answer block, and ends with the latter; else the first thing missing."""
    text = F.coalesce(strip(c), F.lit(""))
    return F.when(~text.rlike(r"(?is)<think>.*?</think>"), "missing_think_tag").when(~text.rlike(ANSWER), "missing_answer_tag").when(~text.rlike(r"(?isU)<answer>.*?</answer>\s*\z"), "bad_final_line").otherwise("")


def score_target(c: Column) -> Column:
    """Struct of prefix (the text up to the answer's body) and target (the body) of a response that ends with its answer; null if it doesn't, or the body is empty.

    The block reaches from the first opening tag from which the text's end can be reached.
    """
    found = F.regexp_substr(c, F.lit(ENDED_ANSWER))
    body = F.regexp_extract(c, ENDED_ANSWER, 1)
    lead = F.length(F.regexp_extract(body, r"(?U)\A[\s\x1c-\x1f]*", 0))
    prefix = F.substring(c, F.lit(1), F.length(c) - F.length(found) + F.lit(len("<answer>")) + lead)
    target = strip(body)
    return F.when(found.isNotNull() & (target != ""), F.struct(prefix.alias("prefix"), target.alias("target")))


def as_bool(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c.cast("string"))).isin("1", "true", "yes", "y", "on"), F.lit(False))


def strip_links(c: Column) -> Column:
    """Without web links, score notes and leading question numbers; blanks run together."""
    out = F.regexp_replace(c, r"(?i)https?://\S+|www\.\S+", F.lit(" "))
    out = F.regexp_replace(out, r"(?i)[\[(]\s*\d+\s*(?:points?|marks?|pts?)\s*[\])]", F.lit(" "))
    out = F.regexp_replace(out, r"\A\s*(?:[Qq](?:uestion)?\s*)?\d+\s*[.):]\s+", F.lit(""))
    return F.trim(F.regexp_replace(out, r"[ \t]+", F.lit(" ")))


#: Instructions that ask for a bare answer, and what they become.
BARE_INSTRUCTIONS = r"(?i)(?:please\s+)?(?:just|only|directly)\s+(?:give|provide|output|answer\s+with)\s+(?:me\s+)?(?:the\s+)?(?:final\s+)?(?:answer|option(?:\s+letter)?)[^.!?\n]*[.!?]?"
FULL_INSTRUCTION = "Reason step by step, then give the final answer."


def refine_instruction(c: Column) -> Column:
    """Struct of refined (the question with a bare-answer instruction rewritten) and low_quality (whether there was one)."""
    return F.struct(F.regexp_replace(c, BARE_INSTRUCTIONS, F.lit(FULL_INSTRUCTION)).alias("refined"), F.coalesce(c.rlike(BARE_INSTRUCTIONS), F.lit(False)).alias("low_quality"))


def option_label(question: Column, answer: Column) -> Column:
    """The answer with the letter of the option that it names ("D. photosynthesis"), if exactly the text of one is given; else the answer."""
    letters = F.regexp_extract_all(question, F.lit(r"(?m)^\s*\(?([A-H])[.):]\s*(.+?)\s*$"), F.lit(1))
    bodies = F.regexp_extract_all(question, F.lit(r"(?m)^\s*\(?([A-H])[.):]\s*(.+?)\s*$"), F.lit(2))
    at = F.array_position(F.transform(bodies, lambda x: F.lower(F.rtrim(x))), F.lower(strip(answer)))
    return F.when(at > 0, F.concat(F.try_element_at(letters, at.cast("int")), F.lit(". "), strip(answer))).otherwise(strip(answer))


def canonical_answer(c: Column) -> Column:
    """Blanks run together, ending punctuation off, case folded."""
    return F.lower(F.regexp_replace(F.regexp_replace(strip(c), r"\s+", F.lit(" ")), r"[\s.,;:!]+\z", F.lit("")))
