"""Quality rules, PII, decontamination, URL filter and HTML extraction against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import decontaminate, html_text, pii, quality_rules, url_filter

from .edge import CLASHING, EDGE, edge_docs, empty_docs


# -- quality rules ----------------------------------------------------------------
def rule_figures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", t)
    n = len(w)

    def covered(k):
        seen = Counter(tuple(w[i:i + k]) for i in range(n - k + 1))
        hit = set()
        for i in range(n - k + 1):
            if seen[tuple(w[i:i + k])] > 1:
                hit.update(range(i, i + k))
        return len(hit)

    lines, dup = set(), 0
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", x):
            dup += x in lines
            lines.add(x)
    longest = 0
    while longest < n and max(Counter(tuple(w[i:i + longest + 1]) for i in range(n - longest)).values(), default=0) > 1:
        longest += 1
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, covered(3), covered(quality_rules.MIN_REPEAT), longest


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def test_rules_equal_plain_counts():
    r = random.Random(1)
    for _ in range(60):
        texts = ["".join(r.choice(["a", "b", "a b a", "\n", " ", "é|", " a b c d e f ", "\t", "x x x", None or " q"]) for _ in range(r.randint(0, 40)))
                 for _ in range(12)] + [None, ""]
        m = quality_rules.measure(texts)
        for i, t in enumerate(texts):
            assert tuple(int(m[c][i]) for c in NAMES) == rule_figures(t), t


def test_rules_edge_rows(spark):
    got = quality_rules.judge(edge_docs(spark)).collect()
    assert len(got) == len(EDGE)
    for r in got:
        if r["doc_id"] in (8, 9):
            assert r["n_words"] == 20_000
            continue
        assert tuple(r[c] for c in NAMES) == rule_figures(dict(EDGE)[r["doc_id"]])
        assert r["base_failed"] and not r["kept"] and r["pii_spans"] == "own pii_spans"
    assert quality_rules.judge(empty_docs(spark)).count() == 0


def test_long_repeat_is_rejected_and_clean_text_kept(spark):
    fresh = [f"t{i}" for i in range(300)]
    docs = spark.createDataFrame([(1, " ".join(fresh)), (2, " ".join(fresh[:60] + fresh[:60] + fresh[60:80])), (3, "a b c " * 200)],
                                 "doc_id long, text string")
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.judge(docs).collect()}
    assert kept[1] == (False, True) and kept[2][1] is False and kept[3] == (True, False)


# -- PII --------------------------------------------------------------------------
def plain_spans(t):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m.group())
        if 12 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.BASE_KINDS.index(s[2])))


def test_base_spans_equal_the_patterns():
    r, f = random.Random(2), pii.Finder()
    parts = ["1", "2", "45", ".", "-", " ", "+", "@", "a", "b.c", "(", ")", "é", "4111111111111111", "0", "token = ", "255", "iban ", "_", "%"]
    for _ in range(8000):
        t = "".join(r.choice(parts) for _ in range(r.randint(1, 40)))
        assert [s for s in f.spans(t) if s[2] in pii.BASE_KINDS] == plain_spans(t), t


def test_method_spans():
    f = pii.Finder()
    find = lambda t: [(t[a:b], k) for a, b, k in f.spans(t)]
    assert find('token = "04dbebab91ab8568"') == [("04dbebab91ab8568", "account")]
    assert find("My IBAN: DE89 3704 0044 0532 0130 00.")[0] == ("DE89 3704 0044 0532 0130 00", "account")
    assert find("ftp://me:pw1@files.example.org/x") == [("me:pw1@files.example.org", "login")] or \
        ("pw1@files.example.org", "email") in find("ftp://me:pw1@files.example.org/x")
    assert find("an accountant counted 12345678 beans") == []
    assert find("1" * 5000) == [] and find("." * 1000 + "@" * 1000) == []


def test_pii_edge_rows_and_masking(spark):
    docs = edge_docs(spark, [*EDGE, (20, "mail a.b@c.de or +1 (017) 555-7713 now"), (21, "🙂 1.2.3.4")])
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["pii_spans"]] for r in pii.find_pii(docs).collect()}
    assert spans[20] == [("email", 5, 13), ("phone", 17, 34)] and spans[21] == [("ip", 2, 9)] and spans[1] == [] and spans[8] == []
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert text[20] == "mail [EMAIL] or [PHONE] now" and text[21] == "🙂 [IP]" and text[1] is None
    assert pii.digest(empty_docs(spark)).count() == 0


# -- decontamination ----------------------------------------------------------------
def bench_words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(text, items, window):
    w, hit, found = bench_words(text), set(), set()
    for item, t in items:
        v = bench_words(t)
        if not v:
            continue
        for i in range(max(1, len(v) - window + 1)):
            p = v[i:i + window]
            for s in range(len(w) - len(p) + 1):
                if w[s:s + len(p)] == p:
                    hit.update(range(s, s + len(p)))
                    found.add(item)
    return len(w), len(hit), sorted(found - {None})


@pytest.mark.parametrize("block_bytes", [10**9, 200])
def test_contamination_equals_plain_search(spark, block_bytes):
    r = random.Random(4)
    word = lambda: r.choice("ab cd ef gh é1 x".split())
    items = [("i1", " ".join(word() for _ in range(7))), ("i2", "AB, cd."), ("i3", None), ("i4", ""), ("i5", "x"), (None, "ab"),
             ("i6", " ".join(word() for _ in range(3))), ("i1", "gh gh gh gh gh")]
    docs = [(i, "-".join(word() for _ in range(r.randint(0, 40)))) for i in range(60)] + EDGE + [(99, " ".join(x[1] or "" for x in items))]
    found = decontaminate.find_contamination(edge_docs(spark, docs), spark.createDataFrame(items, "item_id string, text string"),
                                             window=4, block_bytes=block_bytes)
    for row in found.select("doc_id", "text", "n_words", "hit_spans", "hit_items", "kept").collect():
        spans = [(s["start"], s["end"]) for s in row["hit_spans"]]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        assert (row["n_words"], sum(b - a for a, b in spans), row["hit_items"]) == plain_hits(row["text"], items, 4)
        assert row["kept"] == "own kept"


def test_no_benchmark_or_no_documents(spark):
    bench = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.digest(decontaminate.find_contamination(edge_docs(spark), bench)).filter("contaminated").count() == 0
    assert decontaminate.find_contamination(empty_docs(spark), bench).count() == 0


# -- URL filter -----------------------------------------------------------------------
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("shop.net", "", "block"), ("a.b", "/x", "allow")]


def judged(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return host, path, best[3] if best else None, best[2] if best else "allow"


URLS = ["http://WWW.Example.com/en/1", "https://example.com/en/2?x", "http://x.example.com/en", "http://notexample.com/en/1", None, "", "no address",
        "http://net/es/", "http://a.net/es/9#q", "ftp://shop.net?x", "http://a.shop.net", "http://x.a.b/xyz", "://a.b/x", "http://", "http://com?/",
        "http://com/a://b.net/es/", "http://com/" + "p/" * 3000, "http://" + "s." * 300 + "com/z", "http://Ä.com/", "http://example.com:80/en/"]


@pytest.mark.parametrize("max_bytes", [10**6, 0])
def test_url_verdicts(spark, max_bytes):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string").withColumns(
        {c: F.lit("own") for c in CLASHING if c not in ("host", "verdict")}).withColumn("host", F.lit("own"))
    rules = spark.createDataFrame([*RULES, (None, "/", "block")], "rule_host string, rule_path string, rule_verdict string")
    got = url_filter.judge_urls(pages, rules, max_filter_bytes=max_bytes).collect()
    assert len(got) == len(URLS) + 3
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(r["url"]), r["url"]
        assert r["kept"] == "own"


def test_empty_url_tables(spark):
    none = spark.createDataFrame([], "rule_host string, rule_path string, rule_verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge_urls(pages, none).select("rule", "verdict").collect()] == [(None, "allow")]
    assert url_filter.judge_urls(pages.filter("false"), none).count() == 0


def test_bloom_filter_has_no_false_negatives(spark):
    rules = spark.range(2000).select(F.concat(F.lit("h"), F.col("id"), F.lit(".org")).alias("rule_host"), F.lit("/").alias("rule_path"),
                                     F.lit("block").alias("rule_verdict"))
    pages = spark.range(4000).select("id", F.concat(F.lit("http://www.h"), F.col("id"), F.lit(".org/p")).alias("url"))
    assert url_filter.judge_urls(pages, rules).filter("verdict = 'block'").count() == 2000


# -- HTML ---------------------------------------------------------------------------------
PAGES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p></p>", ""),
    ("<html><head><title>t</title><body><main><p>one<p>two</main>", "one two"),
    ("<article><h1>T</h1><p>Body &eacute;\n  <b>bo</b>ld<br>x</p><aside>no</aside><form>f</form><p>Hi.</p></article><footer>c</footer>",
     "T Body é bold x Hi."),
    ("<nav><a href=x>M</a></nav><div id=content><h2>Title</h2><p>Long text here that is content, yes.</p><p>Hi.</p>"
     "<div class='comments'><p>A reader says a long thing here too.</p></div></div><div id=footer>f</div>",
     "Title Long text here that is content, yes. Hi."),
    ("<article><p>Cut off <b>here", "Cut off here"),
    ("<script>var t='</p>';</script><article><p>x</p><ul><li>a<li>b</ul><div class=ad>buy</div></article>", "x a b"),
    ("<article>" + "<p>word</p>" * 3000 + "</article>", " ".join(["word"] * 3000)),
]


def test_main_text(spark):
    pages = spark.createDataFrame([(i, "http://x", h) for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string")
    pages = pages.withColumn("text", F.lit("own")).withColumn("n_chars", F.lit("own"))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in enumerate(PAGES)}
    assert html_text.extract(pages.filter("false")).count() == 0


LONG = "A long text that is the article of this page, yes."


@pytest.mark.parametrize("page", [
    *(f"<nav><a href=x>M</a></nav><div class='{c}'><article><p>{LONG}</p></article></div><footer>c</footer>"
      for c in ("content-sidebar-wrap", "with-sidebar", "has-navbar", "no-comments", "widget", "x sidebar")),
    f"<article class='post no-comments'><p>{LONG}</p></article>",
    f"<div class=widget><p>{LONG}</p></div><div class=sidebar><p>short</p></div>",
    f"<form action=x><div><p>{LONG}</p></div></form>", f"<form><main><p>{LONG}</p></main></form>",
    f"<article><p>{LONG}</p><div class=comments><article><p>A reader.</p></article></div></article>",
    f"<article><p>{LONG}</p></article><div class=comments><p>{'A reader says more. ' * 9}</p></div>",
    f"<nav><a href=x>M<a name=top></nav><div><p>{LONG}</p></div>", f"<nav><ul><li><a href=x>M</ul></nav><div><p>{LONG}</p></div>",
    f"<a name=top><article><p>{LONG}</p></article>", f"<div><a href=x></div><article><p>{LONG}</p></article>",
])
def test_wrappers_and_open_links_keep_the_article(page):
    assert html_text.main_text(page) == LONG


@pytest.mark.parametrize("page", [
    *(f"<div class=post><p>{LONG}</p></div><div class='{c}'><p>Some words that are no article at all.</p></div>"
      for c in ("site-footer", "sidebar-right", "comments-area", "left_sidebar", "cookie-bar", "main-nav")),
    f"<table><tr><td><article><p>{LONG}</p></article><td><p>Buy this fine thing now.</p></table>",
    f"<main><p>{LONG}</p></main><div><p>All rights are with us, always.</p></div>",
    f"<![foo[bar]]><p>{LONG}</p>", f"<p>{LONG}</p><![CDATA[x]]>", f"<p>{LONG}<!-- a", f"<p>{LONG}<a href='", f"<p>{LONG}</p", f"<p>{LONG}<!x",
])
def test_parts_adverts_and_cut_off_markup_are_no_text(page):
    assert html_text.main_text(page) == LONG


def test_the_ratios_decide_where_no_element_does(monkeypatch):
    """Without article elements and cues, lines of many tags and few characters are left to the ratio step."""
    tiny = "<div>" + "".join(f"<b><i><u>{w}</u></i></b> " for w in "tag cloud of some words".split()) + "</div>"
    page = "<div><p>" + "</p><p>".join([LONG] * 4) + "</p></div>" + "<hr>" * 9 + tiny * 5
    assert html_text.main_text(page) == " ".join([LONG] * 4)
    monkeypatch.setattr(html_text, "_smoothed", lambda ratios: np.ones(len(ratios)))
    assert html_text.main_text(page) != " ".join([LONG] * 4)


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "</span>" * 20_000, "<!--" * 40_000, "<article>" + "<div>" * 16_000 + "x" + "</div>" * 16_000,
                                  "<nav>x" * 10_000, "<div>" * 9000 + "<body>" * 9000, "<![a[" * 20_000, "<p title='" * 9000])
def test_hard_pages_take_linear_time(page):
    import time
    start = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - start < 2


def test_given_pages_keep_their_article():
    import html as h

    import duckdb
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (page,) in rows:
        m = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
        body = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br|li|ul)>", " ", m.group(1))) if m else ""
        assert html_text.main_text(page) == " ".join(h.unescape(body).split())
