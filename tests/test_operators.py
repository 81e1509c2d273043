import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gristmill.operators import allocate, chunks, dedup, enrich, metrics, provenance, requests, resolve, validate
from gristmill.settings import Settings
from gristmill.sources import payloads


def test_first_wins_and_flags(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, 4, "w"), ("b", 5, "v")], "k string, o int, v string")
    assert sorted(r.v for r in dedup.first_wins(df, ["k"], ["o"]).collect()) == ["v", "y", "z"]
    assert {r.v for r in dedup.mark_first(df, ["k"], ["o"]).collect() if r.is_first} == {"v", "y", "z"}
    assert dedup.first_wins(df.limit(0), ["k"], ["o"]).count() == 0


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "k string, o int")
    old = spark.createDataFrame([("a", 9)], "k string, o int")
    assert [tuple(r) for r in dedup.insert_if_absent(new, old, ["k"], ["o"]).collect()] == [("b", 1)]


def test_two_key_dedup_equals_greedy_scan(spark):
    rng = random.Random(5)
    keys = {u: rng.choice([None, "k1", "k2", "k3", "k4"]) for u in "abcdefghij"}
    rows = [(i, u, keys[u]) for i, u in enumerate(rng.choices("abcdefghij", k=60))]
    urls, seen, want = set(), set(), {}
    for i, u, k in rows:
        if u in urls:
            want[i] = "duplicate_url"
            continue
        if k is not None and k in seen:
            want[i] = "duplicate_key"  # and claims no address
            continue
        urls.add(u)
        seen.add(k)
        want[i] = "kept"
    got = dedup.two_key_dedup(spark.createDataFrame(rows, "i int, u string, k string"), "u", "k", ["i"])
    assert {r.i: r.outcome for r in got.collect()} == want


def test_provenance(spark):
    df = spark.createDataFrame([(3, "t"), (1, "t"), (2, None), (4, "u")], "i int, t string")
    stored = spark.createDataFrame([(99, provenance_hash("u"))], "id int, content_hash string")
    got = {r.i: (r.winner_id, r.created) for r in provenance.get_or_create(df, "t", "i", stored).collect()}
    assert got == {3: (1, False), 1: (1, True), 2: (None, False), 4: (99, False)}


def provenance_hash(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def test_allocation():
    assert allocate.fill_forward([("a", 2), ("b", 10), ("c", 10)], 12) == {"a": 2, "b": 5, "c": 5}
    assert allocate.fill_forward([("a", 10), ("b", 1)], 8) == {"a": 4, "b": 1}
    assert allocate.fill_in_passes([("a", 10), ("b", 1)], 8, 2) == {"a": 7, "b": 1}
    assert allocate.fill_in_passes([("a", 1)], 8, 4) == {"a": 1} and allocate.fill_forward([], 5) == {}
    assert allocate.even_split(10, 3) == 3 and allocate.even_split(1, 5) == 1


def test_facets(spark):
    facets = spark.createDataFrame([("x", 5), ("b", 7), ("a", 7), ("z", 2000)], "f string, n bigint")
    taken = {r.f: r.taken for r in allocate.facet_take(facets, "f", 1010, 1000).collect()}
    assert taken == {"z": 1000, "a": 7, "b": 3, "x": 0}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab\n", max_size=60), st.integers(-1, 12))
def test_chunks_are_lossless(text, budget):
    found = chunks.chunk_text(text, budget)
    assert "".join(found) == text
    assert all(0 < len(c) <= max(1, budget) for c in found)


def test_chunks_fill_lines():
    assert chunks.chunk_text("aa\nbb\ncccccccc\nd", 6) == ["aa\nbb\n", "cccccc", "cc\n", "d"]
    assert chunks.chunk_text(None, 5) == []


def test_validation_and_routing(spark):
    rows = [
        (1, "T", "Acme", "s", "https://e.com/1", datetime(2026, 1, 1)), (2, "T", "Acme", "s", "https://e.com/1", datetime(2026, 1, 1)), (3, "T", " ", "s", "https://e.com/2", datetime(2026, 1, 1)),
        (4, "T", "A", "s", "ftp://e.com/3", datetime(2026, 1, 1)), (5, "T", "A", "s", "https://e.com/4", datetime(2025, 1, 1)), (6, "T", "A", "s", "https://e.com/5", datetime(2027, 1, 1)), (7, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "i int, title string, company string, source_name string, url string, posted_ts timestamp")
    flagged = dedup.mark_first(df, ["source_name", "url"], ["i"])
    routed = validate.route(flagged, validate.job_rules(), F.col("posted_ts"), datetime(2026, 1, 1, 6), 24, 60)
    assert {r.i: r.status for r in routed.collect()} == {1: "inserted", 2: "duplicate", 3: "invalid", 4: "invalid", 5: "stale", 6: "future_dated", 7: "invalid"}
    m = metrics.run_metrics(routed).first()
    assert (m.discovered, m.inserted, m.duplicate, m.invalid, m.stale, m.future_dated, m.rejected) == (7, 1, 1, 3, 1, 1, 5)
    ok, bad = validate.split_valid(df, validate.job_rules())
    assert ok.count() == 4 and bad.count() == 3
    assert "company: must not be blank" in [r.message for r in validate.processing_errors(bad, "validation_error").collect()]
    assert metrics.rejection_reasons(routed).count() == 5


def test_enrich(spark):
    papers = spark.createDataFrame([(1, "https://github.com/A/B", 0), (2, "https://github.com/c/d", 0), (3, None, 0), (4, "https://github.com/e/f", 0)], "i int, github_url string, github_stars int")
    repos = spark.createDataFrame([("a/b", True, 7), ("c/d", False, None)], "repo string, found boolean, stars int")
    got = {r.i: (r.github_url, r.github_stars) for r in enrich.with_repo_metadata(papers, repos).collect()}
    assert got == {1: ("https://github.com/A/B", 7), 2: (None, None), 3: (None, None), 4: ("https://github.com/e/f", None)}
    maps = spark.createDataFrame([({"a": "1", "b": "1"}, {"b": "2"}, None)], "x map<string,string>, y map<string,string>, z map<string,string>")
    assert maps.select(enrich.merged_metadata("x", "y", "z").alias("m")).first().m == {"a": "1", "b": "2"}


def sequential(names, link):
    """The ladder one name at a time, against everything seen before."""
    order, canon, log = [], {}, []
    for raw in names:
        key = raw
        if len(key) < 2:
            log.append(("unresolved", None))
        elif key in canon:
            log.append(("normalized_exact" if canon[key] == key else "alias", canon[key]))
        else:
            scored = [(resolve.token_sort_ratio(key, k), k) for k in order]
            best = max(scored, key=lambda s: s[0], default=(0, None))
            canon[key] = canon[best[1]] if best[0] >= link else key
            log.append(("fuzzy" if best[0] >= link else "created", canon[key]))
            order.append(key)
    return log


def test_resolution_equals_the_sequential_ladder(spark):
    rng = random.Random(3)
    base = ["meridian analytics lab", "borealis data works", "quantum harbour research", "lumen robotics", "a"]
    names = []
    for _ in range(120):
        word = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            if len(word) > 2:
                word[rng.randrange(1, len(word))] = rng.choice("abcdefgh")
        names.append("".join(word))
    want = sequential(names, resolve.LINK)
    got = resolve.resolve(spark.createDataFrame(list(enumerate(names)), "ord bigint, raw_name string")).orderBy("ord").collect()
    assert [r.method for r in got] == [m for m, _ in want]
    ids = {}
    for r, (_, root) in zip(got, want, strict=True):
        assert (r.canonical_id is None) == (root is None)
        if root:
            assert ids.setdefault(root, r.canonical_id) == r.canonical_id
    assert len(set(ids.values())) == len(ids)


def test_similar_keys_lose_none(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(3, 14))) for _ in range(120)]
    words += [w[: len(w) // 2] + w[len(w) // 2 + 1 :] for w in words[:40] if len(w) > 4]
    words = sorted(set(words))
    want = {(a, b) for a in words for b in words if a < b and resolve.token_sort_ratio(a, b) >= resolve.REVIEW}
    got = resolve.similar_keys(spark.createDataFrame([(w,) for w in words], "key string")).filter("key < other").collect()
    assert {(r.key, r.other) for r in got} == want and len(want) > 10


def test_resolution_with_an_index(spark):
    names = spark.createDataFrame([(1, "Acme, Inc."), (2, "ACME Labs"), (3, ""), (4, None), (5, "Zeta"), (6, "Acmee")], "ord bigint, raw_name string")
    entities = spark.createDataFrame([("e1", "acme")], "id string, normalized_name string")
    aliases = spark.createDataFrame([("e1", "acme labs"), ("e9", "acme")], "canonical_entity_id string, normalized_alias string")
    got = {r.ord: (r.method, r.canonical_id, r.confidence) for r in resolve.resolve(names, entities, aliases, create_if_missing=False).collect()}
    assert got[1] == ("normalized_exact", "e1", 1.0) and got[2] == ("alias", "e1", 0.99)
    assert got[3] == got[4] == ("unresolved", None, 0.0) and got[5][0] == "unresolved"
    assert resolve.resolve(names.limit(0)).count() == 0
    assert {r.raw_name for r in resolve.resolve(names).collect() if r.ord in (3, 4)} == {"(empty)"}


def test_requests():
    log = []
    too_large = requests.echo_provider("p", lambda t: requests.PayloadTooLarge() if len(t) > 2 else None)
    assert len(requests.generate([too_large], "", "abcd", 100, 0, log)) == 2
    assert [(a.input_size_chars, a.estimated_tokens) for a in log] == [(4, 1), (2, 1), (2, 1)]
    log = []
    flaky = requests.echo_provider("a", lambda t: requests.RateLimited())
    locked = requests.echo_provider("b", lambda t: requests.NotAuthenticated())
    good = requests.echo_provider("c", lambda t: None)
    waits = []
    assert requests.generate([flaky, None, good], "", "x", 10, 1, log, lambda retry, error: waits.append((retry, type(error).__name__))) == ['{"chars": 1}']
    assert [(a.provider, a.status, a.retry_count, a.fallback_used, a.output_size_chars) for a in log] == [("a", "error", 0, False, None), ("a", "error", 1, False, None), ("c", "success", 0, True, 12)]
    assert waits == [(1, "RateLimited")] and all(a.latency_ms >= 0 for a in log)
    with pytest.raises(requests.NotAuthenticated):  # refused credentials end the request
        requests.generate([flaky, locked, good], "", "x", 10, 0, [])
    with pytest.raises(requests.AllProvidersFailed):
        requests.generate([flaky], "", "x", 10, 0, [])
    assert requests.generate([good], "", "", 10, 0, []) == []


def test_answers(spark):
    bodies = [('{"choices":[{"message":{"content":"{\\"a\\": 1}"}}]}',), ('{"choices":[]}',), ('{"choices":[{"message":{"content":"nope"}}]}',)]
    got = spark.createDataFrame(bodies, "b string").select(requests.unwrap_answer(F.col("b"), "choices", "a int").alias("r")).collect()
    assert [(r.r.value and r.r.value.a, r.r.error) for r in got] == [(1, None), (None, "ParsingError"), (None, "ParsingError")]


def test_discovered_units(spark):
    rows = [("s", u, i) for i, u in enumerate("aabacbbdde")] + [("t", "x", 1), (None, "y", 1), (None, "y", 2)]
    got = dedup.discovered(spark.createDataFrame(rows, "source string, unit string, i int"), "source", "unit", ["i"], 4).collect()
    assert sorted(r.i for r in got if r.source == "s") == [0, 1, 2, 3, 4]  # four units with repeats, then on to the next new one
    assert sum(r.first for r in got if r.source == "s") == 3 and [(r.i, r.first) for r in got if r.source == "t"] == [(1, True)]
    assert sorted((r.i, r.first) for r in got if r.source is None) == [(1, True), (2, False)]
    assert dedup.discovered(spark.createDataFrame([], "source string, unit string, i int"), "source", "unit", ["i"], 4).count() == 0


def test_settings(monkeypatch):
    assert Settings.from_env({}).clock_skew_seconds == 60
    got = Settings.from_env({"GRISTMILL_CLOCK_SKEW_SECONDS": "300", "GRISTMILL_PROVIDER_ORDER": " a, ,b "})
    assert got.clock_skew_seconds == 300 and got.provider_order == ("a", "b")
    for bad in ("-1", "301", "x"):
        with pytest.raises(ValueError):
            Settings.from_env({"GRISTMILL_CLOCK_SKEW_SECONDS": bad})


def test_statuses(spark):
    rows = spark.createDataFrame([("s", "u", 200), ("s", "v", 404), ("s", "w", None)], "source_name string, url string, status_code int")
    assert sorted(r.message for r in payloads.status_errors(rows).collect()) == ["HTTP 404 from v", "HTTP none from w"]


def test_two_keys_where_an_address_has_several_keys(spark):
    rng = random.Random(11)
    for n in (1, 40, 200):
        rows = [(i, rng.choice([None, *"abcdefgh"]) and f"u{rng.randrange(n)}", rng.choice([None, f"k{rng.randrange(n)}", f"k{rng.randrange(n)}"])) for i in range(2 * n)]
        seen_u, seen_k, want = set(), set(), {}
        for i, u, k in rows:
            want[i] = "duplicate_url" if u is not None and u in seen_u else "duplicate_key" if k is not None and k in seen_k else "kept"
            if want[i] == "kept":
                seen_u.add(u)
                seen_k.add(k)
        got = dedup.two_key_dedup(spark.createDataFrame(rows, "i int, u string, k string"), "u", "k", ["i"])
        assert {r.i: r.outcome for r in got.collect()} == want
    same = spark.createDataFrame([("u", "k")] * 3, "u string, k string")
    assert sorted(r.outcome for r in dedup.two_key_dedup(same, "u", "k", ["u"]).collect()) == ["duplicate_url", "duplicate_url", "kept"]
