"""Minimum-cut extraction: cuts against enumeration, page fixtures, odd inputs."""

import itertools
import random

import pytest

from vigilo.llm import html_mincut as M


@pytest.mark.parametrize("seed", range(40))
def test_cut_value_is_minimal(seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 9)
    unary = [rnd.choice([-3, -1, -.5, 0, .5, 1, 2, 4]) for _ in range(n)]
    edges = [(a, b, rnd.choice([.2, .6, 1.2])) for a, b in itertools.combinations(range(n), 2) if rnd.random() < .5]

    def cost(labels):
        return (sum(max(u, 0) if not x else max(-u, 0) for u, x in zip(unary, labels))
                + sum(w for a, b, w in edges if labels[a] != labels[b]))

    best = min(cost(x) for x in itertools.product([False, True], repeat=n))
    assert abs(cost(M.min_cut(unary, edges)) - best) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p>";x(1<2)</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><!-- ad 3 -->
<div class="cookie-notice">We use cookies. Accept them all to go on reading this page, please.</div>
<div class="ad">Buy this thing now, it is very cheap.</div>
<article><header><h1>Head &amp; line</h1></header><p><b>First   paragraph of&nbsp;the story</b><br>goes on here, with some more words.<p>Second &lt;one&gt;
is <a href="x">linked</a> too.</p><div class="comments"><p>I liked this article very much, thank you for writing it all down.</p></div></article>
<aside>Related things to read in the sidebar today.</aside><form><label>Name</label><input></form>
<footer>&copy; 2020 example.com &middot; All rights reserved.</footer></body></html>"""


def test_article_without_its_surroundings():
    assert M.main_text(PAGE) == ("Head & line\nFirst paragraph of the story goes on here, with some more words.\n"
                                 "Second <one> is linked too.")


def test_page_without_landmarks():
    words = "word " * 25
    html = f"<div><div class=menu><a href=1>A</a> <a href=2>B</a></div><p>{words}end.</p><p>{words}fin.</p><div>Share</div></div>"
    assert M.main_text(html) == f"{words}end.\n{words}fin."


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<", "" if M.main_text("<") == "" else M.main_text("<")), ("<article><p>Cut off here &am", "Cut off here &am"),
    ("<article><p>Cut tag <arti", "Cut tag"), ("<article><p>A &amp b &quo", "A & b &quo"), ("<script>only()</script>", ""),
    ("<article>" + "<div>" * 3000 + "deep text here.", "deep text here."),
])
def test_odd_pages(html, text):
    assert M.main_text(html) == text


def test_long_page_keeps_everything():
    body = "".join(f"<p>Paragraph {i} has some words in it.</p>" for i in range(20_000))
    text = M.main_text(f"<article>{body}</article>")
    assert text.count("\n") == 19_999


PROSE = "This paragraph tells a part of the story in plain words, and it goes on for a while before it comes to its end here."


@pytest.mark.parametrize("name", ["sidebar-content", "cookie-text", "main-menu", "comment-body", "footer-content", "newsletter-body",
                                  "related-story", "ad-content"])
def test_a_boilerplate_word_wins(name):
    html = f"<div class=post><p>{PROSE}</p></div><div class={name}><p>{PROSE} Not this one.</p><p>{PROSE} Nor this.</p></div>"
    assert M.main_text(html) == PROSE
    assert M.main_text(f"<article><p>{PROSE}</p><div class={name}>{PROSE} No.</div><p>{PROSE}</p></article>") == f"{PROSE}\n{PROSE}"


def test_articles_whose_names_hold_other_words():
    for tag in ("article class='post has-sidebar related'", "main class=sidebar", "div class='post-header'", "div class='content with-sidebar'"):
        assert M.main_text(f"<{tag}><p>{PROSE}</p>") == PROSE
    assert M.main_text(f"<article><p>{PROSE}</p></article><article class=comment><p>{PROSE}</p></article>") == PROSE


def test_the_cut_decides_against_the_classifier():
    short = f"<div><p>{PROSE}</p><p>He left</p><p>{PROSE}</p></div>"
    assert M.main_text(short) == f"{PROSE}\nHe left\n{PROSE}"
    advert = "Our shop has many fine things at the very best prices, come in today and see them all for yourself."
    links = "<div><a href=1>Home</a></div>"
    among = f"<div>{links}<div>{advert}</div>{links}</div><div class=text><p>{PROSE}</p></div>"
    assert M.main_text(among) == PROSE
    moved = [(t, x) for h in (short, among) for t, s, x in M.labelled(h) if (s > 0) != x]
    assert moved == [("He left", True), (advert, False)]


def test_hostile_pages_take_linear_time():
    import time
    n = 100_000
    for html in ("<div>" * n + "</ul>" * n + "text", "<li><ul>" + "<div>" * n + "<li>x</li>" * n, "<div>" * n + "<td>" * n,
                 "".join("<div>Some words in this line.</div><div><a>x</a></div>" for _ in range(n // 4))):
        start = time.time()
        M.main_text(html)
        assert time.time() - start < 20


def test_query_on_pages(spark):
    import re
    from html import unescape
    d = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    for r in M.op9_minimum_cut_extraction(spark, d).collect():
        inner = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<article><p>Some text.</p></article>", "y"), (1, None, None, "x")],
                               "page_id long, url string, html string, text string")
    out = sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in M.extract_main_text(df).collect())
    assert out == [("1", "None", "", 0), ("1", "None", "", 0), ("None", "u", "Some text.", 10)]
    assert M.extract_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("raw", [
    "<script>for(i=0;i<n;i++){f(i)}</script>", "<SCRIPT type='x'>a<b&&c</Script >", "<script>if(a<b)s='<p>no text</p>'</script>",
    "<script>s='<!--'</script>", "<script><!--> s</script>", "<script><!-- w('<script>x<y</script>'); --></script>", "<script>s='</scripts>'</script>",
    "<style>a<b{}</style>", "<title>a <b c</title>", "<textarea>x <y </textarea>", "<noscript><img src=x </noscript>", "<iframe>a<b</iframe>",
    "<template><script>i<n</script><p>none</p></template>", "<object><style>a<b{}</style></object>", "<svg><title>x</svg>",
    "<svg><!-- </svg> --><text>no</text></svg>", "<template><p title='</template>'>no</p></template>", "<script src=x></script>",
])
def test_raw_elements_end_at_their_own_end_tag(raw):
    assert M.main_text(f"{raw}<article><p>First of two.</p>{raw}<p>Second of two.</p></article>") == "First of two.\nSecond of two."
