"""Token counts of texts by a public tokenizer; the vocabulary file's path is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("GRISTMILL_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: how the vocabulary's own tokenizer splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The byte-level BPE tokenizer of a vocabulary file, once per worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of each text; 0 for null and empty texts."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = tokenizer(path).encode_ordinary
        for batch in batches:
            yield batch.map(lambda t: len(encode(t)) if t else 0).astype("int32")

    return F.pandas_udf(count, "int")(text)
