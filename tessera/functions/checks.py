"""Strict JSON contracts of model outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import strip

PARSE_FAILED = "Verifier output did not match the required JSON schema."
#: The keys that each cleaning stage's last line must have, no more and no fewer.
STAGE_KEYS = {
    "language": ["standardized_question", "is_translated", "reason"],
    "irrelevant_content": ["error type", "corrected text", "reason"],
    "answerability": ["answerable", "reason"],
    "instruction": ["refined_question", "has_low_quality_instruction", "rewritten_instruction", "reason"],
    "extraction": ["extracted_answer", "has_reasoning_or_noise", "reason"],
    "canonicalization": ["canonical_answer", "answer_type", "recovered_option_label", "reason"],
}


def single_object(text: Column) -> Column:
    """The text as a variant if it is one JSON object and nothing else; else null. An array around it shows what follows the object."""
    v = F.try_parse_json(F.concat(F.lit("["), strip(text), F.lit("]")))
    first = F.try_variant_get(v, "$[0]", "variant")
    return F.when(F.schema_of_variant(first).startswith("OBJECT") & F.try_variant_get(v, "$[1]", "variant").isNull(), first)


def field(v: Column, name: str, kind: str) -> Column:
    """A field of exactly this type (STRING or BOOLEAN), else null: nothing is converted."""
    path = f"$['{name}']"
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == kind, F.try_variant_get(v, path, kind.lower()))


def verdict(text: Column) -> Column:
    """Struct of verdict, reasoning_consistent, reason, parsed of a verifier's output. What doesn't parse is incorrect and inconsistent."""
    v = single_object(text)
    word, consistent, reason = field(v, "verdict", "STRING"), field(v, "reasoning_consistent", "BOOLEAN"), field(v, "reason", "STRING")
    ok = F.coalesce(word.isin("correct", "incorrect"), F.lit(False)) & consistent.isNotNull() & reason.isNotNull()
    return F.struct(F.when(ok, word).otherwise("incorrect").alias("verdict"), F.when(ok, consistent).otherwise(False).alias("reasoning_consistent"), F.when(ok, strip(reason)).otherwise(PARSE_FAILED).alias("reason"), ok.alias("parsed"))


def label(v: Column) -> Column:
    """A for a correct verdict with consistent reasoning, else B."""
    return F.when((v["verdict"] == "correct") & v["reasoning_consistent"], "A").otherwise("B")


def stage_output(text: Column, keys: Sequence[str]) -> Column:
    """The last line as a JSON object string if it is one with exactly these keys, else null."""
    line = F.try_element_at(F.split(F.regexp_replace(text, r"\s+\z", F.lit("")), "\n"), F.lit(-1))
    v = single_object(line)
    return F.when(v.isNotNull() & (F.array_sort(F.json_object_keys(line)) == F.array(*[F.lit(k) for k in sorted(keys)])), strip(line))
