"""Problems 2 and 5."""

import random

import pytest

from gristmill.llm import matching, names

#: What a large table teaches about the words below.
WORDS = names.Vocabulary(
    {"networks": 175, "design": 168, "research": 164, "systems": 160, "health": 145, "biosciences": 143, "manufacturing": 137, "laboratories": 127, "staffing": 120, "partners": 110, "intelligence": 132, "international": 159},
    {"rd": ("research", "design")},
    frozenset({"meridale"}),
)


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("Bredihewa Manufacturing", "Bredihewa Msnuafcturing"), ("Bredihewa Manufacturing", "MANUFACTURING, BREDIHEWA"), ("Cisugabri Research & Design", "Cisugabri R&D GmbH"), ("Cisugabri Laboratories", "The Cisugabri Labs, Inc."),
        ("Cisugabri Networks", "Cisu Gabri Netw."), ("Cisugabri Networks", "CisugabriNetworks"), ("Cisugabri Networks", "Cisugabri.ai"), ("Cisugabri Health", "Císugabri Healthcare (YC)"), ("Meridale Staffing Partners", "MERIDALE STAFFING PRTNRS"),
    ],
)
def test_same_firms(a, b):
    assert names.form_similarity("company", names.company_form(a, WORDS), names.company_form(b, WORDS)) >= names.MIN_SIMILARITY


@pytest.mark.parametrize(("a", "b"), [("Vicodife Health", "Vicodife Biosciences"), ("Vicodife Health", "Trobaneku Health"), ("Acme Systems", "Zeta Systems")])
def test_other_firms(a, b):
    assert names.form_similarity("company", names.company_form(a, WORDS), names.company_form(b, WORDS)) < names.MIN_SIMILARITY


@pytest.mark.parametrize("b", ["Cotevumo, Christopher", "COTEVUMO, C.", "C. K. Cotevumo", "CK Cotevumo", "Cotevumo Christopher", "Dr. Chris Cotevumo", "Chridtopher Cotevumo", "Kit Cotevmuo", "christopher cotevumo", "Christopher K. Cotevumo"])
def test_same_person(b):
    assert names.form_similarity("author", names.person_form("Christopher Cotevumo"), names.person_form(b)) >= names.MIN_SIMILARITY


@pytest.mark.parametrize("b", ["Robert Cotevumo", "R. Cotevumo", "Christopher Danalida"])
def test_other_person(b):
    assert names.form_similarity("author", names.person_form("Christopher Cotevumo"), names.person_form(b)) < names.MIN_SIMILARITY


@pytest.mark.parametrize("name", ["N/A", "Confidential Client", "Stealth", " ", "--", "x"])
def test_nobody(name):
    assert names.company_form(name) is None


def test_collision_curve():
    bands = names.bands_for(0.35, 0.9, 3)
    assert 1 - (1 - 0.35**3) ** bands >= 0.9 > 1 - (1 - 0.35**3) ** (bands - 1)


def test_distance():
    assert [names.distance(*p) for p in (("abc", "acb"), ("abc", "abcd"), ("abc", "xbz"), ("", "abc"), ("aaaa", "bbbb"))] == [1, 1, 2, 3, 4]
    assert names.distance("a" * 50_000, "a" * 49_999 + "b") == 1


def test_bands_find_what_brute_force_finds(spark):
    rng = random.Random(2)
    cores = {"".join(rng.choice("bdfgklmnprstv") + rng.choice("aeiou") for _ in range(4)) for _ in range(150)}
    for core in list(cores)[:100]:
        at = rng.randrange(1, 7)
        cores.add(core[:at] + rng.choice("abcdefgh") + core[at + 1 :])
    cores = sorted(cores)
    want = {(a, b) for a in cores for b in cores if a < b and names.distance(a, b) <= 1}
    got = names.candidate_cores(spark.createDataFrame([("company", c) for c in cores], "kind string, core string")).collect()
    found = {(r.core_a, r.core_b) for r in got}
    assert len(want & found) / len(want) >= 0.95 and len(want) > 60


def test_star_clusters(spark):
    forms = spark.createDataFrame([(i, float(r)) for i, r in [(1, -9), (2, -5), (3, -1), (4, -8), (5, -1), (6, 0)]], "form bigint, rank double")
    edges = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.9), (3, 4, 0.95), (4, 5, 0.9)], "a bigint, b bigint, similarity double")
    got = {r.form: r.centre for r in names.star_clusters(forms, edges).collect()}
    assert got == {1: 1, 2: 1, 3: 4, 4: 4, 5: 4, 6: 6}
    assert names.star_clusters(forms, edges.limit(0)).count() == 6


def test_star_clusters_with_equal_ranks(spark):
    forms = spark.createDataFrame([(i, 0.0) for i in range(30)], "form bigint, rank double")
    edges = spark.createDataFrame([(i, i + 1, 0.9) for i in range(29)], "a bigint, b bigint, similarity double")
    got = {r.form: r.centre for r in names.star_clusters(forms, edges).collect()}
    assert len(got) == 30 and all(abs(f - c) <= 1 for f, c in got.items()) and got[0] == got[1] == 0


JOBS = "id string, company string, metadata_json map<string,string>, form string, entity string"
STARTUPS = "id string, entity_name string, website string, location string, profile string"
PARSED = "id string, record_type string, data string, site string"
WORKS = "authorships array<struct<author struct<display_name string>>>"


#: Other firms, from whose names the operator learns which words are common.
OTHERS = [f"{core} {word}" for core, word in zip("Bredihewa Trobaneku Wacamica Gozagijo Hebruvasta Kijoduji Nenebala Plufewimo Zatepori Fuzepuhu Gehulezu Filipliwo".split(), "Networks Health Biosciences Systems".split() * 3, strict=True)]


def test_linked_names(spark):
    jobs = spark.createDataFrame([(str(i), c, None, "f", "e") for i, c in enumerate([*OTHERS] + ["Cisugabri Networks"] * 5 + ["cisugabri netw.", "Cisugabri Systems", None, "", "N/A", "N/A ", " Cisugabri Networks"])], JOBS)
    startups = spark.createDataFrame([("s", "Císugabri Networks, Inc.", None, None, "")], STARTUPS)
    works = spark.createDataFrame([([(("Ann Xobelu",),), (("Ana Xobelu",),), None, (None,), ((" ",),)],), (None,)], WORKS)
    got = {(r.kind, r.name_a, r.name_b) for r in names.linked_names(jobs, startups, works).collect()}
    spellings = sorted(["Cisugabri Networks", "cisugabri netw.", "Císugabri Networks, Inc.", " Cisugabri Networks"], key=str.encode)
    assert {g for g in got if g[0] == "company"} == {("company", a, b) for i, a in enumerate(spellings) for b in spellings[i + 1 :]}
    assert names.linked_names(jobs.limit(0), startups.limit(0), works.limit(0)).count() == 0


def test_matching(spark):
    startups = spark.createDataFrame([("s1", "Cisugabri Networks", "https://www.cisugabri.example/", "Nordvik", ""), ("s2", "Cisugabri Networks", None, None, ""), ("s3", "Vicodife Health", "getvicodife.example", None, ""), ("s4", None, None, None, "")], STARTUPS)
    parsed = spark.createDataFrame(
        [
            ("p1", "startup", '{"org": "Networks, Cisugabri", "site": null}', ""), ("p2", "startup", '{"company_name": "Zzz", "url": "http://getvicodife.example"}', ""), ("p3", "product", '{"org": "Cisugabri Networks"}', ""),
            ("p4", "startup", "broken", ""), ("p5", "startup", None, ""), ("p6", "startup", '{"profile": {"title": "Vicodife Biosciences"}}', ""),
        ],
        PARSED,
    )
    jobs = spark.createDataFrame([("j1", "CISUGABRI NETW.", {"apply_url": "https://careers.cisugabri.example/apply"}, "", ""), ("j2", "Confidential", None, "", ""), ("j3", "Vicodife Heatlh", {}, "", ""), ("j4", None, None, "", ""), ("j5", "Vicodife Heatlh", {}, "", "")] + [(f"o{i}", name, None, "", "") for i, name in enumerate(OTHERS)], JOBS)
    rows = matching.matched_records(startups, parsed, jobs).collect()
    assert {(r.startup_id, r.other_tbl, r.other_id) for r in rows} == {
        ("s1", "parsed_records", "p1"), ("s2", "parsed_records", "p1"), ("s3", "parsed_records", "p2"), ("s1", "jobs", "j1"), ("s2", "jobs", "j1"), ("s3", "jobs", "j3"), ("s3", "jobs", "j5"),
    }
    assert len(rows) == 7 and all(0 < r.confidence < 1 for r in rows)
    assert matching.matched_records(startups.limit(0), parsed.limit(0), jobs.limit(0)).count() == 0


def test_places():
    assert matching.place_key("Kestrel Falls (Washland)") == matching.place_key("Washland - KESTREL FALLS / Remote") == "falls kestrel washland"
    assert matching.place_key("Multiple locations (remote ok)") == "" and matching.place_key(None) == ""


@pytest.mark.parametrize(
    ("token", "word"),
    [
        ("netw", "networks"), ("network", "networks"), ("labs", "laboratories"), ("laborattory", "laboratories"), ("mfg", "manufacturing"), ("bio", "biosciences"), ("healthcare", "health"), ("healhtcare", "health"), ("intel", "intelligence"),
        ("intl", "intl"), ("int", "int"), ("cisugabri", None), ("zoo", None),
    ],
)
def test_what_tokens_stand_for(token, word):
    assert WORDS.read(token) == word and names.NO_WORDS.read(token) is None


def test_common_words_are_learned(spark):
    rng = random.Random(3)
    trades = ["Forge", "Bakery", "Shipping", "Textiles"]
    cores = ["".join(rng.choice("bdfgklmnprstv") + rng.choice("aeiou") for _ in range(4)) for _ in range(120)]
    rows = [("company", f"{c.title()} {rng.choice(trades)}", 1) for c in cores] + [("company", f"Oak {'abcdefghij'[i % 10] * 2}{i} Shipping Textiles", 60) for i in range(20)] + [("author", "Ann Xo", 1)]
    found = names.common_words(spark.createDataFrame(rows, "kind string, name string, n bigint"))
    assert set(found["company"].words) == {"forge", "bakery", "shipping", "textiles"} and found["company"].heads == {"oak"}
    assert found["company"].pairs == {"st": ("shipping", "textiles")}
    assert names.common_words(spark.createDataFrame(rows, "kind string, name string, n bigint").limit(0))["company"].words == {}


def test_given_names_with_an_error_in_the_first_letters_meet(spark):
    names_ = ["Christopher Xobelu", "Shristopher Xobelu", "Hcristopher Xobelu", "Cchristopher Xobelu", "Robert Xobelu"]
    works = spark.createDataFrame([([((n,),) for n in [*names_, *names_[:1] * 3]],)], WORKS)
    got = {(r.name_a, r.name_b) for r in names.linked_names(spark.createDataFrame([], JOBS), spark.createDataFrame([], STARTUPS), works).collect()}
    assert got == {(a, b) for a in names_[:4] for b in names_[:4] if a < b}


def test_confidence_is_the_precision_of_what_a_rule_decides(spark):
    columns = "profile bigint, tbl string, form bigint, entity bigint, site string, place_key string, firm bigint, n bigint"
    known = [(1, "startups", 11, 101, "a.example", "ulm", 101, 1), (2, "startups", 12, 102, "b.example", "", 102, 1)]
    others = [
        (10, "jobs", 11, 101, "a.example", "ulm", 101, 7),  # site and name
        (11, "jobs", 99, 999, "a.example", "", 101, 2),  # site, another name
        (12, "jobs", 98, 101, "a.example", "", 101, 5),  # site, the same spellings
        (13, "jobs", 11, 101, "z.example", "ulm", 101, 3),  # name and place, another site
        (14, "jobs", 12, 102, None, "", 102, 4),  # name, no site
        (15, "jobs", 12, 102, "q.example", "", 102, 1),  # name, another site
        (16, "jobs", 77, 102, "r.example", "", 102, 6),  # spelling, another site
        (17, "jobs", 55, 555, "s.example", "", 555, 9),  # nobody
    ]
    links, rules = matching.resolve_profiles(spark.createDataFrame(known + others, columns))
    assert {r.profile: (r.firm, r.rule) for r in links.collect()} == {
        10: (101, "site and name"), 11: (101, "site"), 12: (101, "site"), 13: (101, "name and place"), 14: (102, "name"), 15: (102, "name"), 16: (102, "spelling"),
    }
    got = {r.rule: (r.right, r.wrong, round(r.confidence, 4)) for r in rules.collect()}
    assert got == {"site and name": (7, 0, 0.8889), "site": (5, 2, 0.6667), "name and place": (0, 3, 0.2), "name": (0, 1, 0.3333), "spelling and place": (0, 0, 0.5), "spelling": (0, 6, 0.125)}
