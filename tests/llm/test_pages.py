"""Page and url operators against brute force."""

from __future__ import annotations

import html as references
import re
import time

import pytest
from conftest import SF

from orcaspark.llm import html, registry, urlrules

PAGES = "page_id bigint, url string, html string"


# -- main text -----------------------------------------------------------------------------


def article(page: str) -> str:
    """Text of the marked article, for pages whose article holds headings and paragraphs only."""
    inner = re.search(r"(?s)<article>(.*?)(?:</article>|\Z)", page)[1]
    blocks = [re.sub(r"</?\w+[^>]*>", "", b) for b in re.split(r"</?(?:p|h1)>", inner)]
    blocks = [" ".join(references.unescape(b).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_articles_of_whole_table(session):
    rows = session.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in registry.queries()["op5_html"](session, SF).collect()}
    assert len(got) == len(rows)
    for row in rows:
        text = got[row["page_id"]]["text"]
        assert text == article(row["html"]) and got[row["page_id"]]["n_chars"] == len(text)


WEIGHTS = html.Weights(
    {"p": 1.0, "article": 1.0, "h1": 0.99, "nav": 0.0, "a": 0.01, "li": 0.05, "footer": 0.0, "div.ad": 0.0},
    {"p": 0.98, "b": 0.95, "h1": 0.95, "a": 0.02, "li": 0.02, "ul": 0.02, "nav": 0.0, "footer": 0.0, "div": 0.3},
)


def test_boilerplate_within_and_around_the_article():
    page = """<html><head><title>T</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies to improve this site, accept them all now please.</p></div>
    <article><header><p>Site header text</p></header><h1>Big &amp; bold</h1>
    <p>First   <b>para</b>graph&nbsp;here<br>goes on.</p><aside><p>Related stories here</p></aside>
    <form><p>Sign up</p></form><script>var p = "</p>";</script><!-- a comment --><p>Second &lt;one&gt;.</p>
    <div id="comments"><p>I disagree with this.</p></div></article>
    <footer><p>&copy; all of us</p></footer></body></html>"""
    assert html.main_text(page, WEIGHTS) == "Big & bold\n\nFirst paragraph here goes on.\n\nSecond <one>."


@pytest.mark.parametrize(
    "inner, text",
    [
        ('<p><a class="social">X</a> the rest of it</p>', "the rest of it"),
        ('<p>One <a class="social">X</a> two</p>', "One two"),
        ('<h2 id="related-work">Related work here</h2>', "Related work here"),
        ('<section id="social-policy"><p>Text of it</p></section>', "Text of it"),
        ('<p class="notice">Mind the gap</p>', "Mind the gap"),
        ('<div class="article-header"><p>Text of it</p></div>', "Text of it"),
        ('<p data-id="social">Text of it</p>', "Text of it"),
        ("<p>One <svg viewBox='0'/>two</p><p>three</p>", "One two\n\nthree"),
        ("<p>One <button>two</p><p>three</p>", "One two\n\nthree"),
        ("<p>One <select><option>two</select>three</p>", "One three"),
    ],
)
def test_article_text_with_names_of_boilerplate(inner, text):
    page = f"<article><p>First words of the long article.</p>{inner}<p>Last words of the long article.</p></article>"
    weights = html.Weights({"p": 1.0, "article": 1.0}, dict.fromkeys("p article div section h2 a".split(), 1.0))
    want = f"First words of the long article.\n\n{text}\n\nLast words of the long article."
    assert html.main_text(page, weights) == want


def test_scan_finds_the_best_stretch():
    import itertools
    import random

    rng = random.Random(2)
    for _ in range(300):
        scores = [(rng.choice([0, 0.5, 1, 3]), rng.choice([0, 0.2, 1, 4])) for _ in range(rng.randint(0, 9))]
        start, stop = html.best_stretch(scores)

        def total(a, b, scores=scores):
            return sum(w for _, w in scores[a:b]) - sum(c for c, _ in scores[a + 1 : b])

        best = max((total(a, b) for a, b in itertools.combinations(range(len(scores) + 1), 2)), default=0)
        assert total(start, stop) == pytest.approx(max(best, 0))


def test_page_edges(session):
    long_page = "<article>" + "<p>word &amp; word</p>" * 30_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain words"), (3, "u", "<p"), (4, "u", long_page), (4, "u", long_page)]
    pages = session.createDataFrame([(*r, "x") for r in rows], PAGES + ", text string")
    got = {r["page_id"]: r for r in html.extract(pages).collect()}
    assert got[1]["text"] == got[2]["text"] == "" and got[None]["text"] == "plain words"
    assert got[4]["n_chars"] == 30_000 * 13 - 2 + 0 * len(got)
    assert html.extract(pages).count() == len(rows)
    assert html.extract(pages.limit(0)).count() == 0


# -- urls ----------------------------------------------------------------------------------


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return host.translate(str.maketrans(urlrules.UPPER, urlrules.LOWER)), path


def fixed(host, path):
    fitting = [
        r for r in urlrules.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fitting, key=lambda r: len(r.name), default=None)


def test_urls_of_whole_table(session):
    urls = dict(session.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect())
    got = registry.queries()["op8_urls"](session, SF).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = parsed(urls[r["page_id"]])
        rule = fixed(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")


def test_url_edges(session):
    urls = [None, "", "nothing", "http://", "HTTP://A.NET", "x://a.net/", "s://b://c.net/", "http://net/x", "http://xnet/x"]
    urls += ["http://example.net/en/", "http://example.net/en", "http://A.Example.COM/de/1?x=y#z", "http://é.org/fr/\nq", "http://É.org/fr/"]
    pages = session.createDataFrame([(i, u, "", "x") for i, u in enumerate(urls)] * 2, PAGES + ", tokens string")
    got = urlrules.judge(pages).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        host, path = parsed(urls[r["page_id"]])
        rule = fixed(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name), urls[r["page_id"]]
    assert urlrules.judge(pages.limit(0)).count() == 0


def brute_rules(rows, support, confidence):
    """Itemsets by enumeration, then pruned by shorter rules."""
    from itertools import combinations

    tokens = sorted({t for items, _ in rows for t in items})
    least = max(support, urlrules.LEAST / len(rows)) * len(rows)
    found = {}
    for size in range(1, 4):
        for items in combinations(tokens, size):
            having = [v for own, v in rows if set(items) <= set(own)]
            for verdict in set(having):
                n = having.count(verdict)
                if n >= least - 1e-9 and n / len(having) >= confidence:
                    found[items, verdict] = n / len(having)
    return {
        (items, v)
        for (items, v), c in found.items()
        if not any(set(o) < set(items) and w == v and d >= c for (o, w), d in found.items())
    }


def test_mined_rules_and_matching(session):
    import random

    rng = random.Random(3)
    rows = []
    for _ in range(200):
        items = [t for t in "abc" if rng.random() < 0.6] + ["z"]
        rows.append((items, "block" if ("a" in items and "b" in items) or rng.random() < 0.1 else "allow"))
    labelled = session.createDataFrame(rows, "tokens array<string>, verdict string")
    rules = urlrules.mine(labelled, 0.05, 0.8)
    mined = {(tuple(r["items"]), r["verdict"]): (r["confidence"], r["support"]) for r in rules.collect()}
    assert set(mined) == brute_rules(rows, 0.05, 0.8) and mined
    sets = session.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "key bigint, tokens array<string>")
    got = {r["key"]: r["verdict"] for r in urlrules.matched(sets, rules).collect()}
    for i, (items, _) in enumerate(rows):
        fitting = [(c, s, v) for (needed, v), (c, s) in mined.items() if set(needed) <= set(items)]
        assert got.get(i) == (max(fitting)[2] if fitting else None)


def test_quotes_count_only_as_values():
    """Apostrophes and quotes in texts and odd attributes swallow no paragraph."""
    pages = {
        "<article><p title=it's>Hello don't go away now</p><p>Second paragraph here</p></article>": [
            "Hello don't go away now", "Second paragraph here",
        ],
        '<article><p>if x<y then "stop</p><p>Second para isn\'t lost > here</p></article>': [
            'if x<y then "stop', "Second para isn't lost > here",
        ],
        """<p title = "a > b" class='c > d' e=f>one</p><p data-x="never closed>two</p><P>three</P>""": ["one", "two", "three"],
    }
    for page, want in pages.items():
        assert [b.text() for b in html.blocks(page)] == want


@pytest.mark.parametrize("piece", ['<p title="x ', "<p a='", "<a ", "<!", '<a b="" ', "<p a='\"", "<svg>", "<script a=\""])
def test_hostile_pages_take_linear_time(piece):
    times = []
    for count in (20_000, 200_000):
        begin = time.perf_counter()
        html.blocks(piece * count)
        times.append(time.perf_counter() - begin)
    assert times[1] < 40 * times[0] + 1


def test_articles_in_any_case_are_labels(session):
    rows = [(i, "u", f"<html><body><Article class=x><p>words of the text {i}</p></Article><p>rest</p></body></html>") for i in range(4)]
    weights = html.learn(session.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert weights.words["article"] > 0.9
