from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gristmill.functions import dates, html, http, text, urls


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if not isinstance(v, (int, float)) else 'int'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("HTTPS://Example.COM/Path/?utm_source=x&b=2&a=1#frag", "https://example.com/Path?a=1&b=2"),
        ("http://e.com/", "http://e.com/"),
        ("http://e.com///", "http://e.com"),
        ("http://e.com/a?ref=1&refresh=2&GCLID=3", "http://e.com/a"),
        ("http://e.com/a?q=a+b&e=&t=%7Ex*", "http://e.com/a?e=&q=a+b&t=~x%2A"),
        (" http://U:P@e.com:80/a ", "http://u:p@e.com:80/a"),
        (None, None),
    ],
)
def test_normalize_url(spark, raw, want):
    assert one(spark, urls.normalize_url(F.col("u")), u=raw) == want


def test_repositories(spark):
    assert one(spark, urls.github_url_in(F.col("t")), t="see (https://github.com/a/b.c), then https://github.com/x/y.") == "https://github.com/a/b.c"
    assert one(spark, urls.github_url_in(F.col("t")), t="https://github.com/only") is None
    assert tuple(one(spark, urls.github_repo(F.col("t")), t="https://github.com/a/b.git/")) == ("a", "b")
    assert one(spark, urls.github_repo(F.col("t")), t="https://www.github.com/a/b") is None


def test_small_url_functions(spark):
    assert one(spark, urls.template_url("p/", F.col("s")), s=" /a-b/ ") == "p/a-b"
    assert one(spark, urls.template_url("p/", F.col("s")), s="a/b") is None
    assert one(spark, urls.template_url("p/", F.col("s")), s=" / ") is None
    assert one(spark, urls.work_id(F.col("s")), s="https://o.example/W12 ") == "W12"
    assert one(spark, urls.arxiv_id(F.col("s")), s="http://arxiv.example/abs/2601.1v2") == "2601.1v2"
    assert one(spark, urls.query_string({"q": F.col("s"), "n": F.lit(None), "p": F.lit(1)}), s="a b") == "q=a+b&p=1"
    assert one(spark, urls.is_http_url(F.col("s")), s="javascript:x") is False
    assert one(spark, urls.host_of(F.col("s")), s="http://A.b/c") == "a.b"


@pytest.mark.parametrize(
    ("raw", "key"),
    [
        ("Zebrofin", "zebrofin"), ("\t Zebrofin\n", "zebrofin"), ("Zebrofin Corporation", "zebrofin"), ("Muvela, Ltd.", "muvela"), ("Ro-Kato_Pel", "ro kato pel"), ("Muvela Ltd Inc", "muvela"),
        ("The Quorvane Mill", "quorvane mill"), ("Salt & Pine", "salt and pine"), ("B.V. Kolto", "b v kolto"), ("Çağla Ömür", "cagla omur"), ("Groß-Umstadt", "gross umstadt"), ("京都", ""), ("Ltd", "ltd"), (None, None),
    ],
)
def test_entity_keys(spark, raw, key):
    assert one(spark, text.normalize_entity_name(F.col("n")), n=raw) == key


def test_strings(spark):
    assert one(spark, text.squash_spaces(F.col("s")), s=" a  b\n c ") == "a b c"
    assert one(spark, text.vendor_of(F.col("n"), F.col("i")), n="Acme: Model", i="x/y") == "Acme"
    assert one(spark, text.vendor_of(F.col("n"), F.col("i")), n=": Model", i="x/y") == "x"
    assert one(spark, text.vendor_of(F.col("n"), F.col("i")), n="Model", i="y") is None
    assert [one(spark, text.digits_to_int(F.col("s")), s=s) for s in ("12", "-1", "1.5", "true", "99999999999", "")] == [12, None, None, None, None, None]
    assert one(spark, text.ai_title(F.col("s")), s="An LLM test") is True and one(spark, text.ai_title(F.col("s")), s="Maine") is False
    assert one(spark, text.estimate_tokens(F.col("s")), s="abcde") == 2
    assert one(spark, text.first_href(F.col("s")), s='<p><a class="x" href="https:&#x2F;&#x2F;a">') == "https://a"
    assert one(spark, text.pipe_fields(text.first_paragraph(F.col("s"))), s="A &amp; B | <b>T</b> | x<p>more | y") == ["A & B", "T", "x"]
    red = one(spark, text.redact(F.create_map(F.lit("Token"), F.col("s"), F.lit("prompt"), F.repeat(F.col("s"), 300), F.lit("k"), F.col("s"))), s="z")
    assert red["Token"] == "***redacted***" and red["prompt"] == "z" * 200 + "...(truncated)" and red["k"] == "z"


REF = datetime(2026, 9, 10, 12)


@pytest.mark.parametrize("raw", ["2026-04-31T01:02:03Z", "10 Sep", "2026-W37-4T12:00Z", "noon", None, "2026-09-10T12Z", " ", "2026-09-10 12:00", "0", "10.09.2026 12:00 +02:00", "2026-09-10T25:00:00Z", "2026-13-01T12:00:00Z"])
def test_strict_rejects(spark, raw):
    assert one(spark, dates.strict_timestamp(F.col("s")), s=raw) is None


@pytest.mark.parametrize("raw", ["2026-09-10T12:00:00Z", "2026-09-10T08:00:00-04:00", "2026-09-10 12:00Z", "Thu, 10 Sep 2026 12:00:00 +0000", "Thu, 10 Sep 2026 12:00 GMT", " 10 sep 2026 13:00:00 +0100 "])
def test_strict_accepts(spark, raw):
    assert one(spark, dates.strict_timestamp(F.col("s")), s=raw) == REF


def test_lenient_and_relative(spark):
    assert one(spark, dates.absolute_date(F.col("s")), s="Sep 9, 2026") == datetime(2026, 9, 9)
    assert one(spark, dates.absolute_date(F.col("s")), s="Sep 9") is None
    got = [one(spark, dates.relative_date(F.col("s"), F.lit(REF)), s=s) for s in ("3 hours ago", "1 month ago", "2 Years ago", "Yesterday", "today", "in 3 days")]
    assert got == [REF - timedelta(hours=3), REF - timedelta(days=30), REF - timedelta(days=730), REF - timedelta(days=1), REF, None]
    order = dates.publication_date(F.col("a"), F.col("b"), F.lit(None), F.lit(None), F.lit("1 day ago"), F.lit(REF))
    assert one(spark, order, a="junk", b="2026-09-01") == datetime(2026, 9, 1)


@pytest.mark.parametrize(
    ("micros", "state"),
    [(0, "fresh"), (-86_400_000_000, "fresh"), (-86_400_000_001, "stale"), (60_000_000, "fresh"), (60_000_001, "future")],
)
def test_freshness_bounds(spark, micros, state):
    assert one(spark, dates.freshness(F.lit(REF + timedelta(microseconds=micros)), REF)) == state
    assert one(spark, dates.freshness(F.lit(None).cast("timestamp"), REF)) is None


def test_reasons(spark):
    assert one(spark, dates.freshness_reason(F.lit(REF - timedelta(hours=30, minutes=15)), REF)) == "stale_record: published 30.2h before reference_time"
    assert one(spark, dates.freshness_reason(F.lit(REF + timedelta(seconds=120)), REF)) == "future_dated: published 120s ahead of reference_time (exceeds 60s tolerance)"


def test_http(spark):
    headers = F.create_map(F.lit("x-ratelimit-remaining"), F.lit("0"), F.lit("retry-after"), F.lit("Wed, 21 Oct"))
    plain = F.create_map(F.lit("a"), F.lit("b"))
    got = {s: one(spark, http.classify_response(F.lit(s), plain)) for s in (200, 404, 401, 403, 413, 429, 500)}
    assert got == {200: "ok", 404: "ok", 401: "BlockedSourceError", 403: "BlockedSourceError", 413: "PayloadTooLargeError", 429: "RateLimitError", 500: "NetworkError"}
    assert one(spark, http.classify_response(F.lit(403), headers)) == "RateLimitError"
    assert one(spark, http.classify_response(F.lit(403), headers, "POST")) == "AuthenticationError"
    assert one(spark, http.retry_after_seconds(headers)) is None
    assert one(spark, http.wait_before_retry(F.lit(9), F.lit(500.0), F.lit(1.0))) == 500.0
    assert one(spark, http.wait_before_retry(F.lit(9), F.lit(None).cast("double"), F.lit(0.5))) == 30.0


PAGE = """<html><head><title>T</title><meta property="og:updated_time" content="2026-01-05"><meta name="date" content="2026-01-04">
<script type="application/ld+json">{bad</script><script type="application/ld+json">[{"@type":"Thing"},{"@graph":[{"@type":["NewsArticle"],"datePublished":"2026-01-03T00:00:00Z"},
{"@type":"JobPosting","title":"Dev","datePosted":"2026-01-02","hiringOrganization":{"name":"Acme"}}]}]</script></head>
<body><nav>Menu</nav><time datetime="2026-01-06">Jan</time><article><p>""" + "Body text. " * 20 + "</p></article><footer>Foot</footer></body></html>"


def test_html(spark):
    assert html.job_posting(PAGE) == {"title": "Dev", "company": "Acme", "posted_at": "2026-01-02", "url": None}
    assert html.page_dates(PAGE) == {"json_ld": None, "meta": "2026-01-05", "time_tag": "2026-01-06"}
    assert html.publication_candidates(PAGE) == [{"field": "json_ld.datePublished", "value": "2026-01-03T00:00:00Z"}]
    main = html.main_text(PAGE)
    assert main["text"].count("Body text.") == 20 and "Menu" not in main["text"] and not main["truncated"]
    assert html.main_text("<p>short</p>") is None and html.main_text(None) is None and html.main_text("") is None
    long = html.main_text("<p>" + "x" * 300_001)
    assert len(long["text"]) == 300_001 and not long["truncated"] and html.main_text("<p>" + "x" * 300, 200) == {"text": "x" * 200, "truncated": True}
    assert html.job_posting(None) is None and html.job_posting("<script type='application/ld+json'>") is None
    assert one(spark, html.main_text_of(F.col("p"))["truncated"], p=PAGE) is False


def test_aware_references_are_converted(spark):
    east = datetime(2026, 9, 10, 14, tzinfo=timezone(timedelta(hours=2)))
    moment = F.lit(REF + timedelta(seconds=61))
    assert one(spark, dates.freshness(moment, east)) == one(spark, dates.freshness(moment, REF)) == "future"
    assert one(spark, dates.freshness(F.lit(REF), east, 0, 0)) == "fresh" and dates.epoch_window(east) == dates.epoch_window(REF)
    assert one(spark, dates.age_hours(F.lit(REF), east)) == 0.0
