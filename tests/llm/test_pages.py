"""HTML extraction and the host filter."""

from __future__ import annotations

import time

import duckdb
import pytest

from fleetlake.llm import hosts, html_text
from tests.conftest import rows_of

ARTICLE = "<h1>A title here</h1><p>First <b>bold</b> part&nbsp;of   text.<br>Next line.<p>Second &amp; last."
WANTED = "A title here First bold part of text. Next line. Second & last."
PAGE = "page_id long, url string, html string"


@pytest.mark.parametrize(
    "html",
    [
        f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href=1>x</a></nav><article>{ARTICLE}</article><footer>f</footer></body></html>",
        f"<body><div class='site-header'>h</div><div id=content><main>{ARTICLE}</main></div><aside>side words</aside><script>if(1<2)x='</p>'</script>",
        f"<body><div><ul class=menu><li><a href=1>one</a><li><a href=2>two</a></ul><div>{ARTICLE}</div><div class='comments'><p>Reader says a lot of words here.</div></div>",
        f"<article>{ARTICLE}<form><input value=v><button>Send</button></form><!-- note --></article><div class='cookie-notice'>We use cookies</div>",
        f"<body><div class=AdBox>Buy now</div><article>{ARTICLE}</article><div id='related_posts'><a href=1>More words</a></div><",
        f"<body><article>{ARTICLE}</article><foo",
    ],
)
def test_main_text(html):
    assert html_text.main_text(html) == WANTED


def test_density_finds_an_unmarked_article():
    prose = "".join(f"<p>{'Some sentence of the story goes on here. ' * 6}</p>" for _ in range(4))
    links = "".join(f"<li><a href={k}>Link number {k}</a></li>" for k in range(12))
    page = f"<body><div><ul>{links}</ul></div><div><div>{prose}</div></div></body>"
    assert html_text.main_text(page) == " ".join(["Some sentence of the story goes on here."] * 24)


@pytest.mark.parametrize(
    "page",
    [
        "<body><div>The Daily Site</div><div>3 May</div><div><h1>Title</h1>{a}{b}</div><div>(c) 2024 The Daily Site</div></body>",
        "<body><div><div>The Daily Site</div><div><h1>Title</h1><div>{a}</div><div>{b}</div></div></div><div>(c) 2024</div></body>",
        "<body><div>The Daily Site</div><h1>Title</h1>{a}{b}<div>(c) 2024 The Daily Site</div></body>",
        "<div>The Daily Site</div><div><h1>Title</h1>{a}<p>Short.</p>{b}</div><div>All rights are with us.</div>",
    ],
)
def test_unmarked_boilerplate_without_links(page):
    first = "".join(f"<p>{'Some sentence of the story goes on here. ' * 6}</p>" for _ in range(3))
    second = "".join(f"<p>{'The story has another side to it as well. ' * 5}</p>" for _ in range(3))
    wanted = ["Title", *["Some sentence of the story goes on here."] * 18]
    wanted += [*(["Short."] if "Short" in page else []), *["The story has another side to it as well."] * 15]
    assert html_text.main_text(page.format(a=first, b=second)) == " ".join(wanted)


@pytest.mark.parametrize(
    "name",
    ["content overflow-hidden", "has-sidebar", "layout no-sidebar", "post comments-open", "social-science", "ad-free", "page-share", "hidden"],
)
def test_wrappers_are_no_boilerplate(name):
    for wrapped in (f"<article>{ARTICLE}</article>", f"<div>{ARTICLE}</div>"):
        page = f"<body><div class='{name}'>{wrapped}<div class='sidebar-left'>Side.</div></div><div class='comments'>{'Reader words. ' * 50}</div>"
        assert html_text.main_text(page) == WANTED


@pytest.mark.parametrize("html", [None, "", "   ", "<html></html>", "<p", "<!--", "<body><script>x</script>", "&#0;&#xD800;"])
def test_pages_without_text(html):
    assert html_text.main_text(html).strip("�") == ""


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        ("<body><header>Site<h2>Daily</h2></header><article><header><h1>Head</h1><nav>x</nav></header>{p}</article>", "Head {p}"),
        ("<body><article>{p}<ul><li><a href=1>One</a><li><a href=2>Two</a></ul></article>", "{p} One Two"),
        ("<body><article><p class='notice-period'>Three months.</p>{p}<p class='advert'>Buy.</p></article>", "Three months. {p}"),
        ("<body><article>{p}<math><mi>x</mi><mo>=</mo><mn>2</mn></math></article>", "{p} x=2"),
        ("<body><main><div>3 May</div><div><h1>Head</h1>{p}</div><div>Buy now.</div></main>", "Head {p}"),
    ],
)
def test_what_belongs_to_the_article(page, wanted):
    said = "Some sentence of the story goes on here."
    prose = "".join(f"<p>{' '.join([said] * 6)}</p>" for _ in range(4))
    assert html_text.main_text(page.format(p=prose)) == wanted.format(p=" ".join([said] * 24))


@pytest.mark.parametrize("tags", ["<div>", "<p><button><div>", "<b><div></i>", "<li><div></p>", "<h1><span>", "<main><header>"])
def test_time_follows_length_however_deep(tags):
    begun = time.process_time()
    html_text.main_text(tags * 40_000 + "deep")
    assert time.process_time() - begun < 15


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 5000 + "deep") == "deep"
    assert len(html_text.main_text("<p>" + "word " * 300_000)) == 300_000 * 5 - 1


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", f"<article>{ARTICLE}"), (1, "u", f"<article>{ARTICLE}"), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], f"{PAGE}, text string")
    found = html_text.extract(pages)
    assert rows_of(found) == sorted([(1, "u", WANTED, len(WANTED))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0


def link(host):
    return f"<a href='https://{host}/x'>y</a>"


def host_pages(spark):
    rows = [
        (1, "https://Good.Example.COM/en/1?q=://x", link("helper.org") + link("HELPER.org") + link("liked.org")),
        (2, "http://helper.org/a#b", link("liked.org")),
        (3, "http://liked.org", ""),
        (4, "http://spam-farm.org/fr/1", link("liked.org")),
        (5, "http://friend.org/x", link("spam-farm.org") + link("farmer.org")),
        (6, "http://farmer.org/x", "<img src=//adult-x.net/p.png>" + link("friend.org")),
        (7, "http://a.b.net/es/9", None),
        (8, "http://b.net/it/9", ""),
        (9, "http://www.example.com/en/1", ""),
        (10, "http://sub.www.example.com/en/1", ""),
        (11, "http://example.com/en", ""),
        (12, None, link("liked.org")),
        (13, "no address", ""),
        (14, "http://", ""),
        (14, "http://", ""),
        (None, "://h.net/fr/", ""),
        (15, "http://xcom/", ""),
    ]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], f"{PAGE}, host string, verdict string")


def test_hosts_equal_sql(spark):
    pages = host_pages(spark)
    found = rows_of(hosts.judged(pages), "page_id", "host", "path", "rule", "verdict")
    sql = duckdb.connect()
    sql.register("pages", pages.select("page_id", "url", "html").toArrow())
    expected = sql.execute(hosts.oracle_sql()).fetchall()
    names = [c[0] for c in sql.description]
    order = [names.index(c) for c in ("page_id", "host", "path", "rule", "verdict")]
    assert found == sorted((tuple(r[k] for k in order) for r in expected), key=repr)


def test_verdicts(spark):
    found = {r.page_id: r for r in hosts.judged(host_pages(spark)).collect()}
    assert (found[1].host, found[1].path, found[1].rule, found[1].verdict) == ("good.example.com", "/en/1", "example.com/en/", "block")
    assert (found[9].rule, found[10].rule, found[11].rule) == ("www.example.com/en/",) * 2 + ("com/",)
    assert (found[7].rule, found[8].rule, found[8].verdict) == ("net/es/", None, "allow")
    # Distrust walks back to who links to a bad host, and to who links there.
    assert [found[k].verdict for k in (2, 3, 4, 5, 6)] == ["allow", "allow", "block", "block", "block"]
    assert [(found[k].host, found[k].path, found[k].verdict) for k in (12, 13, 14)] == [("", "", "allow")] * 3
    assert hosts.judged(host_pages(spark).limit(0)).count() == 0


def test_scores_of_a_kind_add_up_to_one(spark):
    sums = hosts.propagated(host_pages(spark)).groupBy().sum("trust", "distrust").first()
    assert list(sums) == pytest.approx([1.0, 1.0])


def test_far_hosts_are_reached(spark):
    # Host k links to host k + 1; the last links to a bad one. Nobody links to or from the lone one.
    names = [f"h{k}.org" for k in range(14)] + ["spam-farm.org"]
    rows = [(k, f"http://{names[k]}/", link(names[k + 1]), "x", "y") for k in range(14)]
    pages = spark.createDataFrame([*rows, (99, "http://lone.org/", "", "x", "y")], f"{PAGE}, host string, verdict string")
    scores = {r.host: r.distrust for r in hosts.propagated(pages).collect()}
    whole = sum(0.85**k for k in range(15))
    for k, name in enumerate(reversed(names)):
        assert scores[name] == pytest.approx(0.85**k / whole)
    found = {r.page_id: r.verdict for r in hosts.judged(pages).collect()}
    assert found == {**dict.fromkeys(range(14), "block"), 99: "allow"}


def test_no_python_in_the_plan(spark):
    plan = hosts.judged(host_pages(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
