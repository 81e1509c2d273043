"""Problems 1, 6 and 9."""

import random
from collections import defaultdict

import numpy as np
import pytest

from gristmill.llm import boilerplate as bp
from gristmill.llm import lines, reading

NEWS = "id string, source_name string, url string, title string, full_text_location string, votes string, path string, ids int"
RAW = "id string, source_url string, source_name string, raw_content_location string, votes string"
STORY = ["The committee agreed on a new plan for the harbour on Monday, after months of talks.", "Residents said they would watch the work closely, because earlier plans had failed.", "The cost of the project is still open, and nobody wants to name a sum."]


def html_page(title, body, related):
    parts = ["<html><head>", f"<title>{title}</title>", "<script>var a = '<p>no</p>';</script>", "</head>", "<body>", '<div class="m1-a">', '<a href="/1">Home | News | Sport</a>', "</div>", '<div class="m1-k">', f"<h1>{title}</h1>"]
    parts += [f"<p>{p}</p>" for p in body] + ["</div>", '<div class="m1-z">', "<li><a>Most read</a></li>", *[f"<li><a>{r}</a></li>" for r in related], "</div>", "<!-- note", "still -->", "</body></html>"]
    return "\n".join(parts)


def site(n, seed=1):
    rng = random.Random(seed)
    words = ["harbour", "council", "bridge", "school", "market", "garden", "station", "library"]
    pages = []
    for i in range(n):
        title = f"Why the {rng.choice(words)} {i} needs a {rng.choice(words)}"
        pages.append((title, rng.sample(STORY, 3) + [f"About {i} people came, the {rng.choice(words)} said, and most of them stayed."], [f"Inside the {rng.choice(words)} push" for _ in range(3)]))
    return pages


def test_page_lines():
    found, title = bp.page_lines('<!DOCTYPE html>\n<title>A &amp; B</title>\n<body><div class="x9">\n<p>Hi <a href="#">there</a></p>\n<p>&nbsp;</p>\n<script>\nx\n</script>\n<!-- a\nb -->\n<li><a>All</a></li>\nplain</div>')
    assert title == "A & B"
    assert [(line.no, line.path, line.text, line.linked) for line in found] == [(3, "body/div.x0", "Hi there", False), (10, "body/div.x0", "All", True), (11, "body/div.x0", "plain", False)]
    assert bp.page_lines("")[0] == [] and bp.page_lines("<p>" * 3000 + "x")[0][0].text == "x"


def test_end_tags_that_are_left_out():
    page = "<html><head><title>T</title>\n<body>\n<ul>\n<li>a\n<li>b\n</ul>\n<p>x\n<p>y\n<div>z</div>\n</body> tail"
    assert [(line.path, line.text) for line in bp.page_lines(page)[0]] == [("html/body/ul", "a"), ("html/body/ul", "b"), ("html/body", "x"), ("html/body", "y"), ("html/body", "z"), ("html", "tail")]
    deep = bp.page_lines("<div>\nx\n" * 5000)[0]
    assert len(deep) == 5000 and len(deep[-1].path) < 200


def test_furniture_of_pages_and_texts(spark):
    pages = site(40)
    raw = spark.createDataFrame([(f"r{i}", f"https://h.example/{i}", "s", html_page(*p), "clash") for i, p in enumerate(pages)] + [("null", None, None, None, None), ("blank", "https://h.example/b", "s", " \n ", None)], RAW)
    text = "\n".join(["Home | News | Sport", pages[0][0], *pages[0][1], "", "Most read", *pages[0][2]])
    news = spark.createDataFrame([("n0", "s", "https://h.example/0", pages[0][0], text, "", "", 1), ("n1", "s", None, None, None, "", "", 1), ("n2", None, None, None, "", "", "", 1)], NEWS)
    got = defaultdict(set)
    for r in bp.furniture_lines(news, raw).collect():
        got[r.row_id].add(r.line_no)
    assert got["n0"] == {0, 7, 8, 9, 10}
    for i in range(40):
        assert got[f"r{i}"] == {6, 15 + 1, 17, 18, 19}, i
    shares = {r.path: r.share for r in bp.host_paths(raw).collect()}
    assert shares["html/body/div.m0-k"] == 1.0 and shares["html/body/div.m0-z"] == 0.0


def test_paths_of_deep_elements_differ():
    same = "<div>" * 60 + "\n<i class=a>\nx\n</i>\n<i class=b>\ny\n</i>"
    found = bp.page_lines(same)[0]
    assert [line.text for line in found] == ["x", "y"] and found[0].path != found[1].path and max(len(line.path) for line in found) < 300


def test_lines_of_a_text_are_judged_as_in_their_page(spark):
    raw = [(f"r{i}", f"https://h.example/{i}", "s", html_page(*p), "") for i, p in enumerate(site(40))]
    odd = "Entirely unusual words with nothing in common, said nobody to no one at all on any day of that week."
    page = html_page("A title", [*STORY, odd], ["x"])
    raw.append(("r40", "https://h.example/40", "s", page.replace("</body>", f"<div class='m1-z'>\n<p>{odd[::-1]}</p>\n</div>\n</body>"), ""))
    news = spark.createDataFrame([("n0", "A title", "\n".join([*STORY, odd, odd[::-1]]), "r40"), ("n1", "A title", "\n".join(STORY), "gone"), ("n2", None, None, None)], "id string, title string, full_text_location string, raw_document_id string")
    docs = spark.createDataFrame(raw + raw[:1], RAW)
    got = {(r.row_id, r.line_no) for r in bp.furniture_lines(news, docs).filter("tbl = 'news'").collect()}
    assert got == {("n0", 4)}


def test_votes_of_few_pages_decide_nothing(spark):
    votes = spark.createDataFrame([("h", "a", 1, 1), ("h", "b", 2, 2), ("h", "c", 0, 7), ("h", "d", 0, 8), ("h", "e", 60, 100)], "host string, path string, won int, seen int")
    parsed = spark.createDataFrame([("h", ["a", "b", "c", "d", "e", "new"], 0), ("other", ["a"], 0), ("h", [], 0)], "host string, paths array<string>, best int")
    assert sorted(r.prior for r in bp.with_priors(parsed, votes).collect()) == [[], [0], [0, 1, 0, -1, 0, 0]]


def test_boilerplate_of_empty_tables(spark):
    assert bp.furniture_lines(spark.createDataFrame([], NEWS), spark.createDataFrame([], RAW)).count() == 0
    only = spark.createDataFrame([("n0", "s", "u", "T", "T\n" + "word " * 50_000, "", "", 1)], NEWS)
    assert bp.furniture_lines(only, spark.createDataFrame([], RAW)).count() == 0


def brute_lines(rows):
    by_source = defaultdict(set)
    seen = defaultdict(set)
    for _, source, url, text in rows:
        if source is None:
            continue
        if url is not None:
            by_source[source].add(url)
            for line in (text or "").split("\n"):
                if lines.line_key(line):
                    seen[source, lines.line_key(line)].add(url)
    out = set()
    for row_id, source, _, text in rows:
        for no, line in enumerate(text.split("\n") if text is not None and source is not None else []):
            n = len(seen[source, lines.line_key(line)]) if lines.line_key(line) else 0
            if n >= 4 and n * 20 >= len(by_source[source]):
                out.add((row_id, no))
    return out


def test_line_keys():
    assert lines.line_key(" » Accept  ALL 12 cookies! ") == lines.line_key("accept all 7 cookies")
    assert lines.line_key("...") == "" and lines.line_key("") == "" and lines.line_key("C++") == "c"


def test_repeated_lines_equal_brute_force(spark):
    rng = random.Random(4)
    pool = [f"Share this story {c}" for c in "abcdefgh"] + ["Privacy", "Terms of use 5", "---", ""]
    rows = []
    for i in range(160):
        source = rng.choices(["hot", "b", "c", None], [6, 2, 1, 1])[0]
        body = [rng.choice(pool) if rng.random() < 0.6 else f"unique line number {chr(97 + i % 26)}{rng.random()}".replace("0.", "x") + "abcdefghij"[rng.randrange(10)] * i for _ in range(rng.randint(0, 12))]
        text = None if rng.random() < 0.05 else "\n".join(body)
        rows.append((f"n{i}", source, None if rng.random() < 0.05 else f"u{rng.randrange(140)}", text))
    rows.append(("long", "hot", "u1", "Privacy\n" + "x y " * 30_000))
    docs = spark.createDataFrame(rows, "row_id string, source string, url string, text string")
    want = brute_lines(rows)
    assert {(r.row_id, r.line_no) for r in lines.repeated_lines(docs).collect()} == want and len(want) > 100
    texts = {r.row_id: (r.text, r.n_removed) for r in lines.without_repeated_lines(docs).collect()}
    for row_id, _, _, text in rows:
        kept = None if text is None else "\n".join(x for no, x in enumerate(text.split("\n")) if (row_id, no) not in want)
        assert texts[row_id][0] == kept
    assert lines.repeated_lines(docs.limit(0)).count() == 0 and lines.without_repeated_lines(docs.limit(0)).count() == 0


def test_blocks_of_several_lines(spark):
    rows = [(f"n{i}", "s", f"u{i}", f"own {chr(97 + i)}\nAbout us\nTerms\nContact\nown too {chr(97 + i)}") for i in range(8)]
    docs = spark.createDataFrame(rows, "row_id string, source string, url string, text string")
    got = {r.len: (r.n_blocks, r.max_urls) for r in lines.block_report(docs).collect()}
    assert got == {1: (3, 8), 2: (2, 8), 3: (1, 8)}


@pytest.mark.parametrize(("word", "n"), [("cat", 1), ("make", 1), ("table", 2), ("reading", 2), ("jumped", 1), ("wanted", 2), ("nation", 2), ("science", 2), ("hierarchical", 5), ("interoperability", 7), ("well-being", 3), ("x", 1)])
def test_syllables(word, n):
    assert abs(reading.syllables(word) - n) <= (1 if n > 4 else 0)


EASY = "The cat is on the mat. We see a red bus. Sam has a big dog and it can run fast. "
HARD = "Notwithstanding the methodological heterogeneity of the underlying corpora, variational generalisation necessitates comprehensive parameterisation. "


def test_levels(spark):
    docs = [(1, EASY * 4, "en"), (2, HARD * 4, "en"), (3, None, "en"), (4, "", "en"), (5, "12 34 " * 30, "en"), (6, EASY * 4, "de"), (7, EASY.replace(".", "") * 8, "en"), (None, HARD * 4, "en"), (9, EASY * 6000, "en"), (1, EASY * 4, "en")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, lang string, doc_kind string, level int")
    labels = spark.createDataFrame([], "doc_id bigint, rater_id int, grade int")
    got = [tuple(r) for r in reading.found_levels(df, labels).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (2, 4), (7, 1), (None, 4), (9, 1)], key=str)
    rows = {r.doc_id: r for r in reading.reading_levels(df).collect()}
    assert rows[3].level is None and rows[3].grade is None and rows[4].n_words == 0 and rows[5].level is None
    assert reading.found_levels(df.limit(0), labels).count() == 0


def test_levels_agree_with_raters_held_out(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/reading_labels.parquet")
    rows = reading.labelled_histograms(docs, labels, 600)
    cuts = reading.fit_cuts(rows[::2])
    right = 0
    for words, grade in rows[1::2]:
        right += reading.levels_of(words[None, :], cuts)[0] == int(np.searchsorted((5.5, 10.5, 15.5), grade, side="right")) + 1
    assert right / len(rows[1::2]) > 0.95 and len(rows) > 300


def test_few_labels_count_and_none_leave_the_defaults():
    assert reading.fit_cuts([]) == reading.DEFAULT_CUTS
    hard = np.array(reading.pieces(HARD * 3))
    one = [(reading.histogram(hard), 3.0)] * 8
    assert reading.levels_of(one[0][0][None, :], reading.DEFAULT_CUTS)[0] == 4
    assert reading.levels_of(one[0][0][None, :], reading.fit_cuts(one))[0] == 1


@pytest.mark.parametrize("cuts", [reading.DEFAULT_CUTS, (3.0, 4.25, 30.0)])
def test_histograms_give_the_levels_of_the_pieces(cuts):
    rng = random.Random(3)
    for _ in range(200):
        text = " ".join(rng.choice([EASY, HARD, "The council will consider the proposal for a new library next week. "]) for _ in range(rng.randint(1, 6)))
        counts = np.array(reading.pieces(text))
        assert reading.levels_of(reading.histogram(counts)[None, :], cuts)[0] == reading.level_of(reading.grades(counts), counts[:, 0], cuts)


def test_grades_are_on_the_raters_scale():
    cuts = reading.DEFAULT_CUTS
    assert list(reading.rater_scale(np.array([-50.0, *cuts, 90.0]), cuts)) == [1.0, 5.5, 10.5, 15.5, 20.0]
