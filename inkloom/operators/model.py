"""Sections through an external language model, and what surrounds the call."""

import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.speech import verbalize_urls
from inkloom.functions.text import strip
from inkloom.operators.sections import MAX_SECTION_CHARS, Split, explode_chunks

# The model, its limits, and the mark of a section that could not be cleaned.
MODEL = "qwen3.5:9b"
NUM_CTX, TEMPERATURE = 8192, 0.2
RETRIES, TIMEOUT_S = 2, 600
FAILED = "[CLEANUP FAILED]\n\n"

Client = Callable[[dict[str, Any]], dict[str, Any]]
RESPONSE = "response string, done_reason string, prompt_eval_count bigint, prompt_eval_duration bigint, eval_count bigint, eval_duration bigint"


def http_client(url: str, timeout: int = TIMEOUT_S) -> Client:
    """A client for a model server; the standard library only. Not tested here: there is no server."""
    import json
    import urllib.request

    def call(request: dict[str, Any]) -> dict[str, Any]:
        message = urllib.request.Request(url, json.dumps(request).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(message, timeout=timeout) as answer:
            return json.load(answer)

    return call


def prompt(base: Column, extension: Column) -> Column:
    """Base prompt and, where there is one, its extension, an empty line between."""
    return F.concat_ws("\n\n", strip(base), strip(extension))


def request_of(text: str, system: str | None = None, model: str = MODEL, temperature: float = TEMPERATURE, num_ctx: int = NUM_CTX) -> dict[str, Any]:
    """A request as a client takes it; think stands beside stream, not among the options."""
    head = {"model": model} | ({} if system is None else {"system": system})
    return head | {"prompt": text, "stream": False, "think": False, "options": {"temperature": temperature, "num_ctx": num_ctx}}


def request_json(system: Column, text: Column, model: str = MODEL, num_ctx: int = NUM_CTX, temperature: float = TEMPERATURE) -> Column:
    options = F.struct(F.lit(temperature).alias("temperature"), F.lit(num_ctx).alias("num_ctx"))
    return F.to_json(F.struct(F.lit(model).alias("model"), system.alias("system"), text.alias("prompt"), F.lit(False).alias("stream"), F.lit(False).alias("think"), options.alias("options")))


def response_timings(response: Column) -> Column:
    """Seconds and tokens a second of both phases; missing figures count as 0."""
    r = F.from_json(response, RESPONSE)
    n = lambda c: F.coalesce(r[c], F.lit(0).cast("long"))
    rate = lambda count, ns: F.when(n(ns) == 0, F.lit(0.0)).otherwise(n(count) / (n(ns) / 1e9))
    return F.struct(
        (n("prompt_eval_duration") / 1e9).alias("prefill_s"),
        (n("eval_duration") / 1e9).alias("decode_s"),
        n("prompt_eval_count").alias("prefill_tokens"),
        n("eval_count").alias("decode_tokens"),
        rate("prompt_eval_count", "prompt_eval_duration").alias("prefill_rate"),
        rate("eval_count", "eval_duration").alias("decode_rate"),
        (r["done_reason"] == "length").alias("truncated"),
    )


def code_block(text: Column) -> Column:
    """The first fenced Python block; null where there is none or it is empty."""
    return F.nullif(F.regexp_extract(text, r"(?s)```python\s*\n(.*?)```", 1), F.lit(""))


def attempt(client: Client, request: dict[str, Any], retries: int, sleep: Callable[[float], None]) -> tuple[str | None, str | None, int]:
    """(response, error, attempts). A cut-off response is an error; waits grow by two seconds, with none after the last try."""
    error = None
    for n in range(1, retries + 2):
        try:
            data = client(request)
            if data.get("done_reason") == "length":
                raise RuntimeError("cut off: the answer reached the model's context limit")
            return data["response"], None, n
        except Exception as e:  # every failure of a section is a value, not a failed task
            error = str(e)
            if n <= retries:
                sleep(2 * n)
    return None, error, retries + 1


def settings(system: str | None, model: str = MODEL, temperature: float = TEMPERATURE, num_ctx: int = NUM_CTX) -> Column:
    """What a request is made of, apart from the section."""
    return F.struct(F.lit(system).cast("string").alias("system"), F.lit(model).alias("model"), F.lit(float(temperature)).alias("temperature"), F.lit(num_ctx).alias("num_ctx"))


def clean_sections(parts: DataFrame, system: str | Column, client: Client | dict[str, Client], retries: int | dict[str, int] = RETRIES, sleep: Callable[[float], None] = time.sleep, model: str = MODEL, temperature: float = TEMPERATURE, num_ctx: int = NUM_CTX) -> DataFrame:
    """parts with cleaned, ok, error, attempts. A failed section keeps its raw text behind a mark; one without text is not sent.

    system is a prompt for all sections, or a column of settings() of each. With a client, or a number of retries, by name, parts must have
    a column corpus that names them."""
    asked = system if isinstance(system, Column) else settings(system, model, temperature, num_ctx)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = lambda x, corpus: x[corpus] if isinstance(x, dict) else x
        for batch in batches:
            done = [
                (None, None, 0) if t is None else attempt(own(client, corpus), request_of(t, a["system"], a["model"], a["temperature"], a["num_ctx"]), own(retries, corpus), sleep)
                for t, a, corpus in zip(batch["text"], batch["asked"], batch["named"], strict=True)
            ]
            made = pd.DataFrame(done, columns=["response", "error", "attempts"], index=batch.index)
            yield pd.concat([batch[["text"]], batch[["carried"]], made], axis=1)

    # What is only carried goes as one JSON value: pandas would make floats of whole numbers with nulls.
    kept = [c for c in parts.columns if c not in ("text", "asked")]
    shape = parts.select(*kept).schema.simpleString()
    by_name = isinstance(client, dict) or isinstance(retries, dict)
    sent = parts.select("text", F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("carried"), asked.alias("asked"), (F.col("corpus") if by_name else F.lit(None).cast("string")).alias("named"))
    out = sent.mapInPandas(run, "text string, carried string, response string, error string, attempts int")
    out = out.withColumn("carried", F.from_json("carried", shape)).select(*[F.col("carried")[c].alias(c) if c != "text" else "text" for c in parts.columns if c != "asked"], "response", "error", "attempts")
    ok = F.col("error").isNull()
    cleaned = F.when(ok, verbalize_urls(strip(F.col("response")))).otherwise(F.concat(F.lit(FAILED), "text"))
    return out.select(*[c for c in parts.columns if c != "asked"], cleaned.alias("cleaned"), ok.alias("ok"), "error", "attempts")


def clean_documents(docs: DataFrame, keys: list[str], kind: Split | None, system: str | DataFrame, client: Client | dict[str, Client], max_chars: int = MAX_SECTION_CHARS, **options) -> DataFrame:
    """Split, chunk, clean and put together again: keys, text, n_sections, n_failed; a document without sections has the empty text.

    system is a prompt, or a table (corpus, asked) of the settings() of each corpus, a row a corpus, which keys must name; documents of others are an error."""
    parts = explode_chunks(docs.select(*keys, "text"), kind, max_chars)
    if isinstance(system, DataFrame):
        named = parts.join(F.broadcast(system.select("corpus", "asked")), "corpus", "left")
        unknown = F.raise_error(F.concat(F.lit("there is no recipe for corpus "), "corpus"))
        parts = named.select(*parts.columns, F.when(F.col("asked").isNull(), unknown).otherwise(F.col("asked")).alias("asked"))
        system = F.col("asked")
    parts = clean_sections(parts, system, client, **options)
    ordered = F.array_sort(F.collect_list(F.struct("sec_idx", "chunk_idx", "cleaned")))
    text = F.array_join(F.transform(ordered, lambda x: x["cleaned"]), "\n\n")
    return parts.groupBy(*keys).agg(text.alias("text"), F.count("text").alias("n_sections"), F.sum((~F.col("ok")).cast("long")).alias("n_failed"))


def pending(inputs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs without a result yet. Where results say ok, a failed one is tried again."""
    done = done.filter("ok") if "ok" in done.columns else done
    return inputs.join(done.select(*keys).distinct(), keys, "left_anti")
