"""Blocks of more lines than a suffix keeps."""

import random
from collections import defaultdict

from gristmill.llm import lines


def test_blocks_longer_than_a_suffix(spark):
    legal = [f"legal {chr(97 + k)}" for k in range(11)]
    texts = {f"u{i}": [f"own {chr(97 + i)}", *(legal if i < 6 else legal[2:8]), f"end {chr(97 + i)}", *legal[:5]] for i in range(12)}
    rows = [(u, "s", u, "\n".join(t)) for u, t in texts.items()] + [("again", "s", "u0", "\n".join(texts["u0"])), ("none", "s", None, "\n".join(legal))]
    docs = spark.createDataFrame(rows, "row_id string, source string, url string, text string")
    seen = defaultdict(set)
    for u, t in texts.items():
        for i in range(len(t)):
            for end in range(i + 1, len(t) + 1):
                seen[tuple(t[i:end])].add(u)
    want = defaultdict(list)
    for block, urls in seen.items():
        if len(urls) >= 4:
            want[len(block)].append(len(urls))
    got = {r.len: (r.n_blocks, r.max_urls) for r in lines.block_report(docs).collect()}
    assert max(got) == 11 and got == {n: (len(c), max(c)) for n, c in want.items()}


def test_blocks_of_all_lengths_equal_brute_force(spark):
    rng = random.Random(8)
    footer = [f"foot {chr(97 + k)}" for k in range(13)]
    texts = {f"u{i}": [f"own {chr(97 + i)}", *footer[: rng.randint(1, 13)], "-", *footer[rng.randint(0, 5) : rng.randint(6, 13)]] for i in range(24)}
    docs = spark.createDataFrame([(u, "s", u, "\n".join(t)) for u, t in texts.items()], "row_id string, source string, url string, text string")
    seen = defaultdict(set)
    for u, t in texts.items():
        t = [x for x in t if x != "-"]
        for i in range(len(t)):
            for end in range(i + 1, len(t) + 1):
                seen[tuple(t[i:end])].add(u)
    want = defaultdict(list)
    for block, urls in seen.items():
        if len(urls) >= 4:
            want[len(block)].append(len(urls))
    got = {r.len: (r.n_blocks, r.max_urls) for r in lines.block_report(docs).collect()}
    assert got == {n: (len(c), max(c)) for n, c in want.items()} and max(got) > 8
