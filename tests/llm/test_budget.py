"""Problems 7 and 8."""

from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gristmill.llm import mixing, packing
from gristmill.llm.tokens import VOCABULARY, tokenizer

DOCS = "doc_id bigint, source string, text string, tokens int, deme int"


def test_tokens(spark):
    encode = tokenizer(VOCABULARY).encode_ordinary
    assert len(encode("<|endoftext|> hello")) > 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=80), st.integers(0, 3))
def test_evolved_packings_are_valid(sizes, seed):
    sizes = sorted(sizes, reverse=True)
    found = packing.evolve(sizes, 50, [], seed)
    assert sorted(i for b in found.bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) == f <= 50 for b, f in zip(found.bins, found.fills, strict=True))
    bins, fills = [], []
    packing.best_fit(list(range(len(sizes))), sizes, 50, bins, fills)
    assert -(-sum(sizes) // 50) <= len(found.bins) <= len(bins)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=60))
def test_exact_fits_are_valid(sizes):
    sizes = sorted(sizes, reverse=True)
    bins = packing.exact_fit(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 50 for b in bins)
    assert packing.least_bins(sizes, 50) <= len(bins)


def fewest(sizes, capacity):
    """Bins of an optimal packing, by trying everything."""
    best = [len(sizes)]

    def place(i, fills):
        if len(fills) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(fills)
            return
        for b in range(len(fills)):
            if fills[b] + sizes[i] <= capacity:
                place(i + 1, [*fills[:b], fills[b] + sizes[i], *fills[b + 1 :]])
        place(i + 1, [*fills, sizes[i]])

    place(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_lower_bound_and_optimum(sizes):
    sizes = sorted(sizes, reverse=True)
    optimum = fewest(sizes, 20)
    assert packing.least_bins(sizes, 20) <= optimum <= len(packing.evolve(sizes, 20, [], 1).bins)


def test_evolution_beats_best_fit():
    import numpy as np

    sizes = sorted((int(x) for x in np.random.default_rng(5).integers(40, 180, 1500)), reverse=True)
    bins, fills = [], []
    packing.best_fit(list(range(len(sizes))), sizes, 256, bins, fills)
    found = packing.evolve(sizes, 256, [], 1)
    assert packing.least_bins(sizes, 256) <= len(found.bins) < len(bins)


def test_packing_does_not_depend_on_partitions(spark):
    rows = [(i % 700, "s", "word " * (7 * i % 90), 0, 0) for i in range(800)]
    docs = spark.createDataFrame(rows, DOCS)
    capacities = spark.createDataFrame([(1, "a", 64), (2, "b", 300)], "capacity_id int, label string, capacity_tokens int")
    one, other = (sorted(tuple(r) for r in packing.pack(docs.repartition(n), capacities).collect()) for n in (2, 8))
    assert one == other and len(one) >= 1600


def test_crossover_keeps_every_item():
    import numpy as np

    sizes = sorted([int(x) for x in np.random.default_rng(1).integers(1, 60, 200)], reverse=True)
    a, b = packing.evolve(sizes, 100, [], 1), packing.evolve(sizes, 100, [], 2)
    child = packing.crossover(a, b, sizes, 100, np.random.default_rng(3))
    assert sorted(i for bin_ in child.bins for i in bin_) == list(range(200)) and max(child.fills) <= 100


def test_pack(spark):
    rows = [(i, "s", "word " * (i % 40), 0, 0) for i in range(120)] + [(200, "s", None, 0, 0), (201, "s", "", 0, 0), (202, "s", "word " * 5000, 0, 0), (5, "s", "word " * 5, 0, 0), (None, "s", "a b", 0, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    capacities = spark.createDataFrame([(1, "a", 64), (2, "b", 512), (2, "b", 512), (3, "zero", 0)], "capacity_id int, label string, capacity_tokens int")
    size = lambda t: len(tokenizer(VOCABULARY).encode_ordinary(t)) if t else 0
    got = packing.pack(docs, capacities).collect()
    for capacity_id, capacity in ((1, 64), (2, 512)):
        mine = [r for r in got if r.capacity_id == capacity_id]
        fill, parts = defaultdict(int), defaultdict(list)
        for r in mine:
            fill[r.container_id] += r.tokens
            parts[r.doc_id].append(r)
        assert max(fill.values()) <= capacity
        assert set(parts) == {r[0] for r in rows}
        want = defaultdict(int)
        for r in rows:
            want[r[0]] += size(r[2])
        assert {d: sum(p.tokens for p in ps) for d, ps in parts.items()} == dict(want)
        assert all(len(ps) == 1 for d, ps in parts.items() if d is not None and d != 5 and want[d] <= capacity)
        assert len(fill) <= -(-sum(fill.values()) // capacity) * 1.1 + 1
    assert {r.capacity_id for r in got} == {1, 2}
    report = packing.packing_report(packing.pack(docs, capacities), capacities).collect()
    assert all(r.n_containers >= r.least for r in report)
    assert packing.pack(docs.limit(0), capacities).count() == 0 and packing.pack(docs, capacities.limit(0)).count() == 0


@pytest.mark.parametrize("shares", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.1526, "b": 0.1415, "c": 0.1305, "d": 0.4072, "e": 0.1682}, {"x": 1.0}, {f"s{i}": 1 / 7 for i in range(7)}])
def test_pfair_lag_is_less_than_a_block(shares):
    blocks = mixing.frame_blocks(shares, 1000)
    assert sum(blocks.values()) == 1000
    slots = mixing.pfair_frame(blocks)
    got = dict.fromkeys(blocks, 0)
    for t, (name, j) in enumerate(slots, 1):
        assert j == got[name]
        got[name] += 1
        assert all(abs(got[n] - blocks[n] * t / 1000) < 1 for n in blocks)


def test_mix(spark):
    rows = [(i, "big", f"text number {i} " * 10, 0, 0) for i in range(300)] + [(1000 + i, "small", f"other number {i} " * 10, 0, 0) for i in range(20)] + [(5000, "big", None, 0, 0), (5001, "small", "", 0, 0), (5002, None, "x", 0, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([(1, "big", 0.5, 2), (1, "small", 0.5, 3), (1, "none", 0.2, 1), (2, "none", 1.0, 4), (3, "small", None, 1), (3, "big", 0.4, 1), (3, "big", 0.4, 1)], "mix_id int, source string, target_share double, max_repeats int")
    scarce = 2 * 3 * sum(len(tokenizer(VOCABULARY).encode_ordinary(r[2])) for r in rows if r[1] == "small" and r[2])  # what three uses of the small source allow
    drawn, report = mixing.mix(docs, targets.withColumn("target_share", F.when((F.col("mix_id") == 1) & (F.col("source") == "none"), 0.0).otherwise(F.col("target_share"))), block=64, frame=100, size=scarce)
    uses = defaultdict(int)
    for r in drawn.filter("mix_id = 1").collect():
        uses[r.source, r.doc_id] += 1
        assert r.use_no <= 3
    assert max(uses.values()) == 3 and max(n for (s, _), n in uses.items() if s == "big") <= 2
    shares = {(r.mix_id, r.source): r for r in report.collect()}
    assert abs(shares[1, "big"].actual_share - 0.5) < 0.03 and abs(shares[1, "small"].actual_share - 0.5) < 0.03
    assert shares[1, "none"].tokens == 0 and not shares[1, "none"].met and shares[2, "none"].actual_share == 0.0
    assert shares[3, "big"].actual_share == 1.0
    done = defaultdict(int)
    for r in drawn.filter("mix_id = 1").orderBy("slot").collect():
        done[r.source] += r.tokens
        assert abs(done["big"] - done["small"]) <= 4 * 64
    assert mixing.mix(docs.limit(0), targets)[0].count() == 0 and mixing.mix(docs, targets.limit(0))[1].count() == 0


def test_offsets_are_running_sums(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_DOCS", 10)
    sized = spark.createDataFrame([("s", i, i % 7, i) for i in range(200)] + [("t", 5, 3, 900), ("t", 5, 3, 901)], "source string, doc_id bigint, n bigint, row bigint")
    rows = mixing.offsets(sized).collect()
    for source in "st":
        at = 0
        for r in sorted((r for r in rows if r.source == source), key=lambda r: (r.before, -r.n if r.n == 0 else r.n)):
            assert r.before <= at
            at = max(at, r.before + r.n)
        assert at == sum(r.n for r in rows if r.source == source)


def test_a_mix_keeps_the_corpus_and_explains_what_is_short(spark):
    rows = [(i, "big", f"text number {i} " * 10, 0, 0) for i in range(600)] + [(10_000 + i, "other", f"some text {i} " * 12, 0, 0) for i in range(500)] + [(20_000 + i, "tiny", f"rare text {i} " * 9, 0, 0) for i in range(6)] + [(30_000, "speck", "one", 0, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([(1, "big", 0.45, 2), (1, "other", 0.34997, 2), (1, "tiny", 0.1, 4), (1, "gone", 0.1, 9), (1, "speck", 0.00003, 5)], "mix_id int, source string, target_share double, max_repeats int")
    drawn, report = mixing.mix(docs, targets, block=64)
    found = {r.source: r for r in report.collect()}
    sizes = {s: sum(len(tokenizer(VOCABULARY).encode_ordinary(r[2])) for r in rows if r[1] == s) for s in ("big", "other", "tiny", "speck")}
    whole = sum(sizes.values())
    assert abs(found["big"].tokens - 0.45 * whole) < 200 and abs(found["other"].tokens - 0.34997 * whole) < 200
    assert found["tiny"].tokens == 4 * sizes["tiny"] and found["tiny"].max_uses == 4 and found["gone"].tokens == 0
    assert all(r.met or r.capped for r in found.values()) and found["tiny"].capped and found["gone"].capped and not found["big"].capped
    assert all(found[s].n_draws > 0 for s in sizes)
    done, slots = defaultdict(int), [r for r in drawn.orderBy("slot").collect()]
    for r in slots:
        if r.source == "speck":  # its only block may wait for 1 / 0.00003 slots, when the others are done
            continue
        done[r.source] += r.tokens
        parts = {"big": 0.45, "other": 0.34997}
        for s, share in parts.items():
            assert abs(done[s] - (r.slot + 1) * 64 * share / 0.9) < 64 + 64 + 80  # a block, the slot's own, a document
    again = mixing.mix(docs.repartition(7), targets, block=64)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, slots))


def test_small_shares_are_exact():
    small = {"a": 0.99997, "b": 0.00003}
    assert mixing.frame_blocks(small, mixing.frame_slots(small)) == {"a": 99_997, "b": 3}
    assert mixing.frame_slots({"a": 1.0, "b": 1e-9}) == mixing.FRAME and mixing.frame_slots({"a": 0.5, "b": 0.25, "c": 0.25}) == 4
    blocks = mixing.frame_blocks({"a": 1.0, "b": 1e-9, "c": 1e-9}, 1000)
    assert blocks == {"a": 998, "b": 1, "c": 1}
