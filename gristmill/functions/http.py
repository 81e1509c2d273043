"""Outcome of a fetch from its status and headers, and waiting times, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def header(headers: Column, name: str) -> Column:
    return F.get(F.map_values(F.map_filter(headers, lambda k, _: F.lower(k) == name.lower())), F.lit(0))


def classify_response(status: Column, headers: Column, method: str = "GET") -> Column:
    """'ok' or the error class of a response; 404 and other 4xx are ordinary results, null means no answer came."""
    exhausted = F.coalesce(header(headers, "X-RateLimit-Remaining") == "0", F.lit(False))
    refused = "AuthenticationError" if method == "POST" else "BlockedSourceError"
    return (
        F.when(status.isNull(), "NetworkError")
        .when(status == 429, "RateLimitError")
        .when(status == 413, "PayloadTooLargeError")
        .when((status == 403) & exhausted & F.lit(method == "GET"), "RateLimitError")
        .when(status.isin(401, 403), refused)
        .when(status >= 500, "NetworkError")
        .otherwise("ok")
    )


def retry_after_seconds(headers: Column) -> Column:
    """Seconds of a Retry-After header; a date there gives null, no error."""
    return F.trim(header(headers, "Retry-After")).try_cast("double")


def is_retryable(outcome: Column) -> Column:
    return outcome.isin("RateLimitError", "NetworkError", "TimeoutError")


def backoff_ceiling(attempt: Column, base: float = 1.0, cap: float = 60.0) -> Column:
    """The longest wait before a retry: base doubled per attempt, up to cap."""
    return F.least(F.lit(float(cap)), F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1))


def wait_before_retry(attempt: Column, retry_after: Column, jitter: Column, base: float = 1.0, cap: float = 60.0) -> Column:
    """A server's own wait wins, even above the cap; else ``jitter`` in [0, 1] of the ceiling."""
    return F.coalesce(retry_after, jitter * backoff_ceiling(attempt, base, cap))
