"""The two operators in DataFrame functions: URL filter and licence scan."""

import re

import pytest

from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, frame
from txrisk.llm import licences, url_filter
from txrisk.llm.common import table


@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.train(url_filter.labelled_urls(spark))


@pytest.fixture(scope="module")
def licence_model(spark):
    return licences.train(table(spark, SF_SMALL, "documents"))


def brute_url(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    best = None
    for rule in url_filter.RULES:
        own, rest = rule.text.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return host, path, best


URLS = ["https://a.ORG/x", "http://example.org/es/1", "http://x.example.org/en/17?q", "http://example.org/en/2", "http://notexample.org",
        "http://org/", "http://a.com/fr/#x", "a.com/de/1", "x://y.com/de/?a", None, "", "://", "http://É.com/FR/", "http://a?b/c", "h://a#://b/",
        "http://free-casino.example.net/en/1", "http://research.example.net/en/1", "s://" + "long.host." * 3000 + "com/fr/" + "p" * 50_000, "two\nlines://a.com/fr/"]


def test_hosts_paths_and_rules_equal_brute_force(spark, url_model):
    pages = spark.createDataFrame([(i, u, "x", 1.0) for i, u in enumerate(URLS)] + [(0, URLS[0], "x", 1.0)],
                                  "page_id long, url string, host string, score double")
    got = sorted(url_filter.judge(pages, url_filter.RULES, url_model).collect())
    assert len(got) == len(URLS) + 1 and got[0] == got[1]
    for r in got[1:]:
        host, path, rule = brute_url(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
        assert r.verdict == (rule.verdict if rule else "block" if r.score >= 0.5 else "allow")
    by = {URLS[r.page_id]: r.verdict for r in got}
    assert by["http://free-casino.example.net/en/1"] == "block" and by["http://research.example.net/en/1"] == "allow"


def test_held_out_hosts(spark, url_model):
    held = [("https://casino-online.example.com/en/5", "block"), ("https://cheap-casino.example.net/fr/9", "block"),
            ("https://poker-bonus.example.com/es/1", "block"), ("https://physics-journal.example.com/en/5", "allow"),
            ("https://library.example.net/de/2", "allow"), ("https://news-archive.example.net/en/8", "allow")]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(held)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, [], url_model).collect()}
    assert sum(got[i] == v for i, (_, v) in enumerate(held)) >= 5


def test_url_filter_without_labels_or_pages(spark, url_model):
    one = spark.createDataFrame([("http://a/", "allow"), (None, "allow"), ("http://b/", None)], "url string, verdict string")
    assert url_filter.train(one) is None
    pages = spark.createDataFrame([(1, "http://c/")], "page_id long, url string")
    assert url_filter.judge(pages, [], None).first().verdict == "allow"
    assert url_filter.judge(pages.limit(0), url_filter.RULES, url_model).count() == 0


def test_main_paths_run_no_python(spark, url_model, licence_model):
    plans = [url_filter.judge(table(spark, SF_SMALL, "pages"), url_filter.RULES, url_model),
             licences.scan(table(spark, SF_SMALL, "documents"), licence_model)]
    for plan in plans:
        text = plan._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|Exchange", text)


def test_licences_are_named_and_prose_is_not(spark, licence_model):
    lines = {"Apache": "Licensed under the Apache License, Version 2.0.", "CC": "Licensed under CC BY-NC 4.0.", "MIT": "Released under the MIT License.",
             "GPL": "this work is licensed under the gnu general public license, version 3"}
    rows = documents() + [(900 + k, f"Some prose of mine here.\n\n  \n{t}\nMore prose.", "en") for k, t in enumerate(lines.values())]
    rows += [(950, "The public may license a general version of the work.", "en"), (951, "mit licence apache gnu", "en"),
             (952, "x " * 5000 + lines["MIT"], "en")]
    docs = frame(spark, rows)
    found = licences.scan(docs, licence_model).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    for k, name in enumerate(lines):
        assert [(x.paragraph, x.family) for x in by[900 + k].licences] == [(1, name)] and by[900 + k].n_paragraphs == 3
    assert all(not r.licences for i, r in by.items() if not 900 <= i < 910 and i != 952)
    assert [x.family for x in by[952].licences] == ["MIT"]  # the notice behind a very long line
    empty = [i for i, t, _ in rows if i is not None and not (t or "").strip()]
    assert empty and all(by[i].n_paragraphs == 0 for i in empty)
    assert licences.scan(frame(spark, []), licence_model).count() == 0


def test_templates_themselves_are_recognised(spark, licence_model):
    rows = [(i, t, "en") for i, t in enumerate(t for f in licences.FAMILIES for t in licences.TEMPLATES[f])]
    names = [f for f in licences.FAMILIES for _ in licences.TEMPLATES[f]]
    got = {r.doc_id: [x.family for x in r.licences] for r in licences.scan(frame(spark, rows), licence_model).collect()}
    assert sum(got[i] == [names[i]] for i in got) >= 0.9 * len(names)


def test_training_on_an_empty_table(spark):
    weights, intercepts, threshold = licences.train(frame(spark, []))
    assert len(weights) == len(licences.FAMILIES) + 1 and threshold >= 0.5


def test_short_notices_inside_prose_are_named(spark, licence_model):
    lines = {"MIT": "This project is released under the MIT License, see the LICENSE file in the root folder for details.",
             "BSD": "All code here was written at home and is released under the BSD 3-Clause License as stated in the file beside it.",
             "": "The work was released under the old law and the public may read the general terms in the file beside it."}
    docs = frame(spark, [(i, t, "en") for i, t in enumerate(lines.values())])
    got = {r.doc_id: [x.family for x in r.licences] for r in licences.scan(docs, licence_model).collect()}
    assert got == {i: [f] if f else [] for i, f in enumerate(lines)}


def test_every_ordinary_paragraph_counts(spark):
    common, rare = "the public may work under these terms", "free software in general"
    rows = [(k, "\n".join([f"{common} {k}", "plain words only", f"{rare} {k}", "a licence line"]), "en") for k in range(300)]
    rows += [(400, None, "en"), (401, " \n ", "en")]
    got = {tuple(r.at): 0 for r in licences.counted(frame(spark, rows)).collect()}
    for r in licences.counted(frame(spark, rows)).collect():
        got[tuple(r.at)] += r.n
    assert sum(got.values()) == 900 and got[()] == 300 and sorted(got.values()) == [300, 300, 300]
    names = {frozenset(licences.VOCABULARY[i] for i in at) for at in got}
    assert any({"public", "terms"} <= x for x in names) and any("software" in x for x in names)
