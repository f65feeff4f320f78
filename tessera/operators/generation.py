"""Model calls behind a client: each task keeps a bounded number of calls in flight, each call is retried by itself, failures become rows.

A client is a picklable object whose open(), called once a task, gives a
session that may be used by several threads: complete(prompt, image, sampling)
gives a text and its finish reason, logprobs(prompt, image, response) the
tokens of the whole and their log-probs. Both may raise. Already answered rows
must be taken out before: filters are not pushed through a Python stage.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import target_score
from tessera.functions.text import score_target
from tessera.operators.rollouts import ROLLOUT, failed
from tessera.session import find_package

#: Rows of results that a task hands on at once.
_ROWS = 256


class EchoClient:
    """A deterministic offline client: the answer is made from the prompt's length."""

    def open(self):
        return self

    def complete(self, prompt: str, image: str | None = None, sampling: Mapping | None = None) -> tuple[str, str]:
        return f"<think>\n{len(prompt)}\n</think>\nTherefore, the final answer is <answer>{len(prompt) % 7}</answer>", "stop"

    def logprobs(self, prompt: str, image: str | None, response: str) -> tuple[list[int], list[float | None]]:
        """Tokens are code points; the first has no log-prob, as in a prompt's."""
        text = prompt + response
        return [ord(c) for c in text], [None if i == 0 else -(ord(c) % 7) / 10 for i, c in enumerate(text)]


@dataclass(frozen=True)
class ChatClient:
    """A server with the common chat-completions interface. Sampling parameters are sent as given; an image, a data URL, is a part of the message."""

    url: str
    model: str
    timeout: float = 600.0

    def open(self):
        return self

    def _post(self, body: dict) -> dict:
        request = urllib.request.Request(f"{self.url}/chat/completions", json.dumps({"model": self.model, **body}).encode(), {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                return json.loads(reply.read())
        except urllib.error.HTTPError as e:
            raise RuntimeError(f"HTTP {e.code}: {e.read()[:1000].decode(errors='replace')}") from e

    @staticmethod
    def _user(prompt: str, image: str | None) -> dict:
        return {"role": "user", "content": [{"type": "text", "text": prompt}] + ([{"type": "image_url", "image_url": {"url": image}}] if image else [])}

    def complete(self, prompt: str, image: str | None = None, sampling: Mapping | None = None) -> tuple[str, str]:
        choice = self._post({**(sampling or {}), "messages": [self._user(prompt, image)]})["choices"][0]
        return choice["message"]["content"], choice.get("finish_reason") or ""

    def logprobs(self, prompt: str, image: str | None, response: str) -> tuple[list[int], list[float | None]]:
        """The prompt's own tokens: each entry maps tokens to log-probs, of which the token's own is taken."""
        got = self._post({"messages": [self._user(prompt, image), {"role": "assistant", "content": response}], "temperature": 0.0, "max_tokens": 1, "prompt_logprobs": 1, "return_token_ids": True})
        ids, entries = got["prompt_token_ids"], got["prompt_logprobs"]
        own = [e.get(str(i)) if e else None for i, e in zip(ids, entries, strict=True)]
        return ids, [x["logprob"] if isinstance(x, dict) else x for x in own]


def in_order(rows: Iterator, call: Callable, in_flight: int) -> Iterator[tuple]:
    """(row, call(row)) in the order of rows, on so many threads. Rows are drawn as results leave: no more than twice as many are held."""
    with ThreadPoolExecutor(in_flight) as pool:
        active: deque = deque()
        for row in rows:
            active.append((row, pool.submit(call, row)))
            if len(active) >= 2 * in_flight:
                own, done = active.popleft()
                yield own, done.result()
        while active:
            own, done = active.popleft()
            yield own, done.result()


def attempted(call: Callable[[], tuple], retries: int, wait: float) -> tuple[tuple | None, str | None]:
    """(the call's result, None), or (None, the last error) after so many attempts; wait * attempt seconds lie between."""
    error = None
    for attempt in range(retries):
        try:
            return call(), None
        except Exception as e:  # noqa: BLE001  whatever a client raises becomes the row's error
            error = f"{type(e).__name__}: {e}"
            if attempt + 1 < retries:
                time.sleep(wait * (attempt + 1))
    return None, error


def _mapped(df: DataFrame, keys: tuple[str, ...], client, call: Callable, columns: list[str], types: str, in_flight: int) -> DataFrame:
    """keys of each row and the columns that call(session, row) gives."""
    find_package(df.sparkSession)
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), types])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        session = client.open()
        out: list[tuple] = []
        rows = (row for b in batches for row in b.astype(object).where(b.notna(), None).to_dict("records"))
        for row, got in in_order(rows, lambda row: call(session, row), in_flight):
            out.append((*(row[k] for k in keys), *got))
            if len(out) >= _ROWS:
                yield pd.DataFrame(out, columns=[*keys, *columns])
                out = []
        if out:
            yield pd.DataFrame(out, columns=[*keys, *columns])

    return df.mapInPandas(run, schema)


def generate(prompts: DataFrame, client, n: int, retries: int = 3, wait: float = 2.0, in_flight: int = 16, keys: tuple[str, ...] = ("id",), sampling: Mapping | None = None, thinking: bool = False) -> DataFrame:
    """keys, rollout_id, response, finish_reason, error: n rollouts of each prompt (columns: keys, prompt and, if there, image).

    Each call is tried again by itself, after wait * attempt seconds; a call
    that keeps failing gives a row with its last error. A task has at most
    in_flight calls under way. With thinking, a response that doesn't begin with its tag gets it.
    """
    image = [F.col("image")] if "image" in prompts.columns else [F.lit(None).cast("string").alias("image")]
    wide = prompts.select(*keys, "prompt", *image, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("rollout_id"))

    def call(session, row):
        got, error = attempted(lambda: session.complete(row["prompt"], row["image"], sampling), retries, wait)
        if error:
            return None, None, error
        text, reason = got
        return "<think>" + text if thinking and text and not text.lstrip().startswith("<think>") else text, reason, None

    return _mapped(wide, (*keys, "rollout_id"), client, call, ["response", "finish_reason", "error"], "response string, finish_reason string, error string", in_flight)


def score_candidates(candidates: DataFrame, client, retries: int = 3, wait: float = 2.0, in_flight: int = 8, keys: tuple[str, ...] = ("id", "rollout_id")) -> DataFrame:
    """keys, score_error, mean, sum, count, start: the log-probs of each response's answer.

    candidates: keys, prompt, response and, if there, image. Two scorings a
    response, of the text up to the answer's body and of the text with it; what
    they share is left out. Both are tried again together when one fails. A
    response that doesn't end with its answer, and a scoring that keeps failing, carry an error.
    """
    image = F.col("image") if "image" in candidates.columns else F.lit(None).cast("string")
    parted = candidates.withColumn("__t", score_target(F.col("response"))).select(*keys, F.col("prompt"), image.alias("image"), F.col("__t.prefix").alias("prefix"), F.concat("__t.prefix", "__t.target").alias("full"))

    def call(session, row):
        if row["full"] is None:
            return None, None, None, "no answer at the end"
        both = lambda: (session.logprobs(row["prompt"], row["image"], row["prefix"]), session.logprobs(row["prompt"], row["image"], row["full"]))
        got, error = attempted(both, retries, wait)
        return (None, None, None, error) if error else (got[0][0], got[1][0], got[1][1], None)

    names = ["prefix_ids", "full_ids", "logprobs", "score_error"]
    scored = _mapped(parted, keys, client, call, names, "prefix_ids array<int>, full_ids array<int>, logprobs array<double>, score_error string", in_flight)
    scored = scored.withColumn("s", target_score(F.col("prefix_ids"), F.col("full_ids"), F.col("logprobs")))
    error = F.coalesce("score_error", F.when(F.col("s.count") == 0, "no scored token"))
    return scored.select(*keys, error.alias("score_error"), "s.mean", "s.sum", F.coalesce("s.count", F.lit(0).cast("long")).alias("count"), "s.start")


def gathered(rollouts: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """keys and rollouts in the order of their numbers: a sample's own n rollouts meet, so groups are bounded."""
    from tessera.operators.rollouts import parsed

    p = parsed(F.col("response"))
    bad = failed(F.struct("error"))
    reason = F.when(~F.coalesce(bad, F.lit(False)), F.coalesce("finish_reason", F.lit("stop")) if "finish_reason" in rollouts.columns else F.lit("stop"))
    one = F.struct("rollout_id", p["response"].alias("response"), p["final_answer"].alias("final_answer"), p["has_answer_tag"].alias("has_answer_tag"), reason.alias("finish_reason"), p["response_chars"].alias("response_chars"), "error").cast(ROLLOUT)
    return rollouts.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("rollouts"))
