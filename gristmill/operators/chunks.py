"""Lossless chunks of a text within a character budget, cut at line ends where possible."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunk_text(text: str | None, budget: int) -> list[str]:
    """Chunks of at most ``budget`` characters (at least 1) whose concatenation is the text; none for an empty text."""
    if not text:
        return []
    budget = max(1, budget)
    if len(text) <= budget:
        return [text]
    chunks, start = [], 0
    end_of_lines = [i + 1 for i, c in enumerate(text) if c == "\n"]
    ends = [*end_of_lines, len(text)] if not end_of_lines or end_of_lines[-1] < len(text) else end_of_lines
    line_start = 0
    for end in ends:
        if end - line_start > budget:  # a line of its own pieces
            if line_start > start:
                chunks.append(text[start:line_start])
            chunks += [text[i : min(i + budget, end)] for i in range(line_start, end, budget)]
            start = end
        elif end - start > budget:
            chunks.append(text[start:line_start])
            start = line_start
        line_start = end
    if start < len(text):
        chunks.append(text[start:])
    return chunks


def chunks_of(text: Column, budget: int) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([chunk_text(t, budget) for t in batch], dtype=object)

    return F.pandas_udf(run, "array<string>")(text)


def chunk_rows(df: DataFrame, text: str, budget: int, *keep: str) -> DataFrame:
    """(kept columns, chunk_no, chunk): one row per chunk."""
    return df.select(*keep, F.posexplode(chunks_of(F.col(text), budget)).alias("chunk_no", "chunk"))
