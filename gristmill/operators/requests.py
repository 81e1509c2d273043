"""Requests to providers with chunking, retries and fallback; the providers are plain callables.

``Provider.ask(system, payload)`` returns a JSON text or raises one of the errors below. A provider
that is rate-limited or not reached is asked again and then passed over; refused credentials end
the request, as the next provider would hide them. All attempts become rows, so that what was
tried can be counted afterwards.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.chunks import chunk_text


class RequestError(Exception):
    retryable = False


class RateLimited(RequestError):
    retryable = True


class NetworkFailed(RequestError):
    retryable = True


class NotAuthenticated(RequestError):
    pass


class PayloadTooLarge(RequestError):
    pass


class AllProvidersFailed(RequestError):
    pass


@dataclass
class Provider:
    name: str
    model: str
    ask: Callable[[str, str], str]


@dataclass
class Attempt:
    provider: str
    model: str
    input_size_chars: int
    estimated_tokens: int
    output_size_chars: int | None
    latency_ms: int
    status: str
    retry_count: int
    fallback_used: bool
    error_type: str | None


OnRetry = Callable[[int, RequestError], None]


def backoff(base_s: float = 1.0, most_s: float = 60.0) -> OnRetry:
    """Waits before a retry: twice as long each time, up to a bound."""
    return lambda retry, _: time.sleep(min(most_s, base_s * 2 ** (retry - 1)))


def ask_in_turn(providers: list[Provider | None], system: str, payload: str, max_retries: int, log: list[Attempt], on_retry: OnRetry | None = None) -> str:
    """The first provider that answers; missing ones are skipped, but count for whether a fallback was used.

    on_retry: called before each retry with its number and the error; ``backoff()`` waits there.
    """
    for index, provider in enumerate(providers):
        if provider is None:
            continue
        for retry in range(max_retries + 1):
            began, tokens = time.perf_counter(), math.ceil(len(payload) / 4)

            def attempt(status: str, answer: str | None = None, error: RequestError | None = None, p=provider, r=retry, i=index, t=began, n=tokens) -> Attempt:
                took = int(1000 * (time.perf_counter() - t))
                return Attempt(p.name, p.model, len(payload), n, None if answer is None else len(answer), took, status, r, i > 0, type(error).__name__ if error else None)

            try:
                answer = provider.ask(system, payload)
                log.append(attempt("success", answer))
                return answer
            except RequestError as error:
                log.append(attempt("error", error=error))
                if isinstance(error, (PayloadTooLarge, NotAuthenticated)):
                    raise
                if not error.retryable:
                    break
                if on_retry and retry < max_retries:
                    on_retry(retry + 1, error)
    raise AllProvidersFailed


def generate(providers: list[Provider | None], system: str, payload: str, token_budget: int, max_retries: int, log: list[Attempt], on_retry: OnRetry | None = None) -> list[str]:
    """Answers for the chunks of a payload; a chunk that is too large for a provider is halved."""

    def one(chunk: str) -> list[str]:
        try:
            return [ask_in_turn(providers, system, chunk, max_retries, log, on_retry)]
        except PayloadTooLarge:
            if len(chunk) <= 1:
                raise
            return [a for part in chunk_text(chunk, len(chunk) // 2) for a in one(part)]

    return [a for chunk in chunk_text(payload, token_budget * 4) for a in one(chunk)]


def run_requests(df: DataFrame, row_id: str, payload: str, make_providers: Callable[[], list[Provider | None]], system: str = "", token_budget: int = 1000, max_retries: int = 2, on_retry: OnRetry | None = None) -> DataFrame:
    """(row_id, answers, failed, attempts) for every payload; providers are made once per task."""
    attempt = "array<struct<provider string, model string, input_size_chars int, estimated_tokens int, output_size_chars int, latency_ms int, status string, retry_count int, fallback_used boolean, error_type string>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        providers = make_providers()
        for batch in batches:
            out = []
            for key, text in zip(batch["row_id"], batch["payload"], strict=True):
                log: list[Attempt] = []
                try:
                    answers, failed = generate(providers, system, text or "", token_budget, max_retries, log, on_retry), None
                except RequestError as error:
                    answers, failed = [], type(error).__name__
                out.append((key, answers, failed, [vars(a) for a in log]))
            yield pd.DataFrame(out, columns=["row_id", "answers", "failed", "attempts"])

    rows = df.select(F.col(row_id).cast("string").alias("row_id"), F.col(payload).alias("payload"))
    return rows.mapInPandas(run, f"row_id string, answers array<string>, failed string, attempts {attempt}")


def attempt_rows(ran: DataFrame) -> DataFrame:
    """One row per attempt, in order: rows of the request table, the payload's identifier being the request's."""
    return ran.select("row_id", F.posexplode("attempts").alias("attempt_no", "a")).select(F.col("row_id").alias("request_id"), "attempt_no", "a.*")


def unwrap_answer(body: Column, style: str, schema: str) -> Column:
    """struct(value, error) of a provider's response: its text is read as JSON into ``schema``."""
    path = "$.candidates[0].content.parts[0].text" if style == "candidates" else "$.choices[0].message.content"
    text = F.get_json_object(body, path)
    value = F.from_json(text, schema)
    error = F.when(text.isNull() | F.try_parse_json(text).isNull(), "ParsingError").when(value.isNull(), "ValidationError")
    return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))


def echo_provider(name: str, fails: Callable[[str], RequestError | None]) -> Provider:
    """A provider for tests and simulations: fails as told, else answers with the payload's length."""

    def ask(system: str, payload: str) -> str:
        if error := fails(payload):
            raise error
        return json.dumps({"chars": len(payload)})

    return Provider(name, f"{name}-model", ask)
