"""Candidates of problem 2 lose no pair that the verifier accepts."""

import random

from gristmill.llm import names


def test_candidates_lose_no_accepted_pair(spark):
    rng = random.Random(5)
    base = {"".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(rng.choice([4, 5, 6, 7, 8, 24]))) for _ in range(150)}
    cores = set(base)
    for core in sorted(base):
        for _ in range(4):
            t = core
            for _ in range(names.allowed(core, core)):
                at = rng.randrange(len(t) - 1)
                t = rng.choice([t[:at] + t[at + 1 :], t[:at] + rng.choice("xyq") + t[at:], t[:at] + rng.choice("xyq") + t[at + 1 :], t[:at] + t[at + 1] + t[at] + t[at + 2 :]])
            cores.add(t)
    cores = sorted(cores)
    want = {(a, b) for a in cores for b in cores if a < b and names.distance(a, b) <= names.allowed(a, b)}
    got = {(r.core_a, r.core_b) for r in names.candidate_cores(spark.createDataFrame([("company", c) for c in cores], "kind string, core string")).collect()}
    assert len(want) > 400 and not want - got
