"""Model calls as an opaque row function behind an interface; no network code is here."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor
from concurrent.futures import wait as wait_all

import pandas as pd
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import answers
from ..functions.text import FAILED_CALL
from . import records as exchange

#: A provider answers a batch of prompts with (text, prompt tokens, completion tokens) each; a failure is an exception.
Provider = Callable[[list[str]], list[tuple[str, int, int]]]
TRY_AGAIN = ("429", "503", "timed out", "rate limit")
#: Which settings hold a provider's key, by a mark in the address or the model's name; the first that is set serves.
KEY_NAMES = (("openrouter", True, ("OPENROUTER_API_KEY", "OPENROUTER_KEY")), ("anthropic", False, ("ANTHROPIC_API_KEY",)), ("groq", False, ("GROQ_API_KEY",)), ("together", False, ("TOGETHER_API_KEY",)))
ANY_KEY = ("OPENAI_API_KEY",)


def echo(prompts: list[str]) -> list[tuple[str, int, int]]:
    """A mock: the last line of each prompt."""
    return [(p.strip().rsplit("\n", 1)[-1], len(p) // 4, 1) for p in prompts]


def ask(rows: DataFrame, prompt_col: str, provider: Provider, batch: int = 32, attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """Adds the response and its telemetry. A batch that fails is tried again if that may help; its rows then say what went wrong."""
    schema = rows.schema.simpleString()[len("struct<") : -1]

    def call(prompts: list[str]) -> list[tuple[str, int, int]]:
        for k in range(attempts):
            try:
                return provider(prompts)
            except Exception as e:  # noqa: BLE001  a provider may raise anything; the row carries it
                if k + 1 == attempts or not any(t in str(e).lower() for t in TRY_AGAIN):
                    return [(f"{FAILED_CALL} {e}", 0, 0)] * len(prompts)
                time.sleep(wait * 2**k)
        return []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = []
            for at in range(0, len(frame), batch):
                prompts = frame[prompt_col].iloc[at : at + batch].fillna("").tolist()
                began = time.perf_counter()
                said = call(prompts)
                each = (time.perf_counter() - began) / max(1, len(prompts))
                parts += [(t, each, p, c) for t, p, c in said]
            yield frame.assign(**{n: [x[i] for x in parts] for i, n in enumerate(("response", "latency", "prompt_tokens", "completion_tokens"))})

    return rows.mapInPandas(run, schema + ", response:string, latency:double, prompt_tokens:bigint, completion_tokens:bigint")


#: A client by its name: it answers one prompt with (text, prompt tokens, completion tokens); a failure is an exception.
Client = tuple[str, Callable[[str], tuple[str, int, int]]]


def ask_each(rows: DataFrame, prompt_col: str, clients: Sequence[Client], window: int = 16, attempts: int = 3, wait: float = 1.0, progress: Accumulator | None = None) -> DataFrame:
    """Adds response, latency, tokens, ``client`` and ``attempts``; at most ``window`` calls of a task are under way at once.

    A call that fails for a while is tried again, then (or if it fails for good) the next client is asked; if all fail, the row carries the last failure and no client.
    Rows leave in the order of completion, so a slow call holds up none but its own. ``progress`` counts finished rows, those of tasks that ran again once more.
    """
    schema = rows.schema.simpleString()[len("struct<") : -1]
    at = rows.columns.index(prompt_col)

    def call(prompt: str) -> tuple:
        began, tries, said = time.perf_counter(), 0, ""
        for name, client in clients:
            for k in range(attempts):
                tries += 1
                try:
                    text, asked, told = client(prompt)
                    return text, time.perf_counter() - began, asked, told, name, tries
                except Exception as e:  # noqa: BLE001  a client may raise anything; the row carries it
                    said = f"{FAILED_CALL} {e}"
                    if k + 1 == attempts or not any(t in str(e).lower() for t in TRY_AGAIN):
                        break
                    time.sleep(wait * 2**k)
        return said, time.perf_counter() - began, 0, 0, None, tries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = [("response", pa.string()), ("latency", pa.float64()), ("prompt_tokens", pa.int64()), ("completion_tokens", pa.int64()), ("client", pa.string()), ("attempts", pa.int32())]
        flying: dict[Future, pa.RecordBatch] = {}

        def landed(wait_for: str) -> Iterator[pa.RecordBatch]:
            for f in wait_all(flying, return_when=wait_for).done:
                row = flying.pop(f)
                if progress is not None:
                    progress.add(1)
                yield pa.RecordBatch.from_arrays([*row.columns, *[pa.array([x], kind) for x, (_, kind) in zip(f.result(), added, strict=True)]], names=[*row.schema.names, *[n for n, _ in added]])

        with ThreadPoolExecutor(window) as pool:
            for batch in batches:
                for k in range(batch.num_rows):
                    if len(flying) >= window:
                        yield from landed(FIRST_COMPLETED)
                    flying[pool.submit(call, batch.column(at)[k].as_py() or "")] = batch.slice(k, 1)
            while flying:
                yield from landed(FIRST_COMPLETED)

    return rows.mapInArrow(run, schema + ", response string, latency double, prompt_tokens long, completion_tokens long, client string, attempts int")


def paraphrased(records: DataFrame, provider: Provider) -> DataFrame:
    """Rows (scaffold_id, persona, title, canonical_query, prompt) with ``user_query`` from a provider: the first clean paraphrase, else the query behind the persona's title."""
    said = ask(records, "prompt", provider)
    plain = F.when(F.col("persona") == "general_user", F.col("canonical_query")).otherwise(F.concat(F.lit("["), "title", F.lit("] "), "canonical_query"))
    clean = F.get(answers.paraphrases(F.col("response")), F.lit(0))
    failed = F.col("response").startswith(FAILED_CALL)
    return said.withColumn("user_query", F.when(failed, plain).otherwise(F.coalesce(clean, plain))).withColumn("llm_generator", F.when(failed | clean.isNull(), "fallback").otherwise("live"))


def run_statistics(records: DataFrame) -> DataFrame:
    """How records came about: cache, live or fallback, and their tokens, by persona and in all."""
    return records.groupingSets([["persona", "llm_generator"], ["llm_generator"], []], "persona", "llm_generator").agg(F.count(F.lit(1)).alias("records"), F.sum("completion_tokens").alias("tokens"))


def key_names(endpoint: Column, model: Column) -> Column:
    """Array of the settings that may hold the key for an address and a model, in order. The third member of a mark says whether a model's name may bear it, too."""
    out = F.array(*map(F.lit, ANY_KEY))
    has = lambda c, mark: F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(mark))
    for mark, in_model, names in reversed(KEY_NAMES):
        here = has(endpoint, mark) | has(model, mark) if in_model else has(endpoint, mark)
        out = F.when(here, F.array(*map(F.lit, (*names, *ANY_KEY)))).otherwise(out)
    return out


def batched(scaffolds: DataFrame, personas: list[str], provider: Provider) -> DataFrame:
    """One call per scaffold (id, canonical_query) for all personas: a row per scaffold and persona with ``user_query``.

    The response maps personas to questions; a persona that it lacks or answers badly gets the canonical query behind its title.
    """
    asked = F.concat(F.lit("Rephrase this question once for each persona. Answer with a JSON object from persona to question.\nPersonas: "), F.lit(", ".join(personas)), F.lit("\nQuestion: "), F.col("canonical_query"))
    said = ask(scaffolds.withColumn("prompt", asked), "prompt", provider).withColumn("said", answers.mapping(F.col("response")))
    rows = said.withColumn("persona", F.explode(F.array(*map(F.lit, personas))))
    found = exchange.question_for(F.coalesce("said", F.create_map().cast("map<string,string>")), F.col("persona"), F.col("canonical_query"))
    return rows.withColumn("user_query", found).drop("prompt", "said")
