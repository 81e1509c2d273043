import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gristmill.operators import shapes, timestamps

PAGES = "page_id bigint, source_name string, retrieved_at timestamp, body string, state string, pos1 int"
WORKS = "id string, authorships array<struct<author struct<id string, display_name string, orcid string>, institutions array<struct<id string, display_name string, ror string, country_code string, type string>>>>, child string, retrieved_at timestamp, publication_date string"
AT = datetime(2026, 1, 1)


def pages(spark, *bodies):
    return spark.createDataFrame([(i, "yc_directory", AT, b, "clash", 7) for i, b in enumerate(bodies)], PAGES)


def test_read_shape_and_states():
    tree = shapes.read_shape("OBJECT<a: ARRAY<OBJECT<x: BIGINT>>, `b: c,<>`: STRING, n: DECIMAL(23,0)>")
    assert tree == ("OBJECT", {"a": ("ARRAY", ("OBJECT", {"x": ("BIGINT",)})), "b: c,<>": ("STRING",), "n": ("DECIMAL(23,0)",)})
    automaton = shapes.TreeAutomaton(shapes.INDUSTRY_RULES)
    assert [automaton.classify(s) for s in (None, "STRING", "VOID", "OBJECT<id: BIGINT, name: STRING>", "OBJECT<name: STRING>", "OBJECT<id: BIGINT>", "ARRAY<STRING>", "OBJECT<")] == [
        "void", "text", "void", "identified", "labelled", "unnamed", "list", "other",
    ]


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ({"hits": [{"industries": ["A", None, " ", {"name": "B", "id": 1}]}, None, {"industries": "C"}]}, [(0, 0), (0, 3), (2, 0)]),
        ({"hits": {"industries": {"name": "A"}}}, [(0, 0)]),
        ({"results": [{"hits": []}, {"hits": [{"industries": ["A"]}]}, {"hits": [{"industries": ["B"]}, {"industries": ["C", "C"]}]}]}, [(0, 0), (1, 0), (2, 0), (2, 1)]),
        ({"results": {"hits": [{"industries": ["A"]}]}}, [(0, 0)]),
        ({"message": "no"}, []),
        ({"hits": [{"industries": [{"name": None}, 5, ["A"]]}]}, []),
    ],
)
def test_industries(spark, body, want):
    found = shapes.industry_tables(pages(spark, json.dumps(body))).super.filter(shapes.non_blank("name"))
    assert sorted((r.pos1, r.pos2) for r in found.collect()) == want


def test_bodies_that_are_not_json(spark):
    good = json.dumps({"hits": [{"industries": ["A"]}]})
    found = shapes.industry_tables(pages(spark, None, "", "nope", good[:-3], good + " x", good + good, good, " " + good + "\n")).super.collect()
    assert sorted(r.parent_id for r in found) == ["6", "7"]


def test_author_and_institution_tables(spark):
    rows = [
        ("w1", [(("a1", "Ann", "o1"), [("i1", "Inst", "r1", "DE", "x"), None, (None, " ", None, None, None)]), (None, None), None, ((None, " ", None), []), (("a2", "Bob", None), None)], "clash", AT, None),
        ("w2", None, None, AT, None),
        ("w3", [], None, AT, None),
    ]
    works = spark.createDataFrame(rows, WORKS)
    found = shapes.named_children(works, pages(spark, None)).collect()
    assert sorted(map(tuple, found)) == [("author", "w1", 0, -1), ("author", "w1", 4, -1), ("institution", "w1", 0, 0)]
    states = {(r.pos1): r.state for r in shapes.author_tables(works).super.collect()}
    assert states[0] == "registered" and states[4] == "identified" and states[1] == "void" and states[2] == "void"
    registered = shapes.author_tables(works).subtype("registered").collect()
    assert [(r.parent_id, r.child_id, r.child_orcid) for r in registered] == [("w1", "a1", "o1")]
    empty = works.limit(0)
    assert shapes.named_children(empty, pages(spark, None).limit(0)).count() == 0


def test_timestamp_dictionary_is_incremental(spark, tmp_path):
    rows = spark.createDataFrame(
        [("t", "1", "2026-01-01", None, None, 0), ("t", "2", "2026-01-01", None, None, 0), ("t", "3", "2 hours ago", None, None, 7_200_000_000), ("t", "4", None, None, None, 0), ("t", "5", "junk", "X/Y", "dmy", 0)],
        "tbl string, row_id string, raw string, zone string, date_order string, collected_us bigint",
    )
    book = timestamps.InstantDictionary(spark, str(tmp_path / "book"))
    assert book.read().count() == 0
    found = {r.row_id: r.utc_us for r in timestamps.found_instants(rows, book).collect()}
    assert found == {"1": 1_767_225_600_000_000, "2": 1_767_225_600_000_000, "3": 0}
    assert book.read().count() == 3
    book.update(rows.unionByName(rows.withColumn("raw", F.lit("2026-01-02"))))
    assert book.read().count() == 3 + 2  # with and without a zone
    assert book.normalise(rows).count() == 5
    book.update(rows.limit(0))
    assert book.read().count() == 5


def test_timestamp_tables_empty_and_clashing(spark):
    news = spark.createDataFrame([("n1", "s", "2026-03-08 02:30:00", AT, 1, "z"), ("n2", "s", "2026-03-08 03:30:00", AT, 1, "z"), ("n3", None, "2026-03-08 03:30:00", AT, 1, "z")], "id string, source_name string, published_at string, collected_at timestamp, utc_us int, zone string")
    jobs = news.select("id", "source_name", F.col("published_at").alias("posted_at"), "collected_at").limit(0)
    works = spark.createDataFrame([], WORKS)
    listing = json.dumps({"hits": [{"objectID": "9", "created_at": 1_700_000_000}, {"objectID": None, "created_at": "2026-01-01"}]})
    sources = spark.createDataFrame([("s", "America/New_York", "mdy"), ("s", "America/New_York", "mdy")], "name string, time_zone string, date_order string")
    rows = timestamps.timestamp_rows(news, jobs, works, pages(spark, listing), sources)
    found = sorted((r.tbl, r.row_id, r.utc_us) for r in timestamps.found_instants(rows, timestamps.InstantDictionary(spark)).collect())
    assert found == [("api_pages", "9", 1_700_000_000_000_000), ("news", "n2", 1_772_955_000_000_000), ("news", "n3", 1_772_940_600_000_000)]


def test_every_state_has_a_subtype_table(spark):
    body = json.dumps({"hits": [{"industries": ["A", None, 5, True, ["x"], {"name": "B", "id": 1}, {"name": "C"}, {"id": 2}]}]})
    tables = shapes.industry_tables(pages(spark, body))
    rows = {state: [r.asDict() for r in tables.subtype(state).collect()] for state in tables.states("industry")}
    assert {state: [r["pos2"] for r in found] for state, found in rows.items() if found} == {"text": [0], "void": [1], "number": [2], "flag": [3], "list": [4], "identified": [5], "labelled": [6], "unnamed": [7]}
    assert rows["number"][0]["child_value"] == 5.0 and rows["flag"][0]["child_value"] is True and rows["list"][0]["child_json"] == '["x"]'
    assert tables.all_subtypes("pos2").count() == tables.super.count() == 8


def test_rows_of_named_children_come_through_the_automaton(spark, monkeypatch):
    works = spark.createDataFrame([("w", [(("a", "Ann", None), None)], "", AT, None)], WORKS)
    monkeypatch.setattr(shapes, "AUTHOR_RULES", [shapes.Rule("named", {"display_name": "number"})])
    tables = shapes.record_tables(works, pages(spark, None))
    assert tables.subtype("other", "author").count() == 1 and tables.subtype("identified", "author").count() == 0
    assert [tuple(r) for r in tables.all_subtypes("parent_id").collect()] == [("author", "w")]


def test_a_second_run_parses_nothing(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("t", str(i), f"2026-01-{1 + i % 20:02d}", None, None, 0) for i in range(60)], "tbl string, row_id string, raw string, zone string, date_order string, collected_us bigint")
    path = str(tmp_path / "book")
    first = {tuple(r) for r in timestamps.found_instants(rows, timestamps.InstantDictionary(spark, path)).collect()}
    parsed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            parsed.add(len(batch))
            yield from timestamps_parse(iter([batch]))

    timestamps_parse = timestamps._parse_batches
    monkeypatch.setattr(timestamps, "_parse_batches", counting)
    assert {tuple(r) for r in timestamps.found_instants(rows, timestamps.InstantDictionary(spark, path)).collect()} == first
    assert parsed.value == 0
    more = rows.withColumn("raw", F.concat("raw", F.lit("T01:00Z")))
    assert timestamps.found_instants(more, timestamps.InstantDictionary(spark, path)).count() == 60 and parsed.value == 20
    assert timestamps.dictionary_path(spark, "a") != timestamps.dictionary_path(spark, "b")
