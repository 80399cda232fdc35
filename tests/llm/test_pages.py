from dealscope.llm import pages
from dealscope.llm.queries import op9_html_extraction

from .helpers import SF, plain, table

ARTICLE = "<p>First, with a comma and <a href='/x'>a link</a>.<p>Second &amp; last<br>line.<ul><li>a<li>b</ul>"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


def text(source):
    return pages.Page(source).text(None)


def test_blocks_and_furniture():
    source = page(f"""<header><a href=/>Site</a></header><nav><ul><li>Home</ul></nav><div class="cookie-notice">We use cookies, sorry</div>
      <script>if (a < b) document.write("<p>no</p>")</script><style>p{{}}</style><!-- <p>no</p> -->
      <article class="post x-12"><h1>Title</h1>{ARTICLE}<div class="shareButtons">share me</div></article>
      <aside>related</aside><section id=comments><p>long, long, long comment, really, it is long, is it not</section>
      <form>name <input></form><footer>&copy; us</footer>""")
    assert text(source) == "Title\nFirst, with a comma and a link.\nSecond & last line.\na\nb"


def test_plain_containers():
    assert text(page(f'<div class="has-sidebar"><div id="main"><h1>T</h1><div class="c">{ARTICLE}</div></div></div>')).startswith("First, with")
    assert text("just text &lt;b&gt;") == "just text <b>"
    assert text("") == "" and text("<p></p>") == "" and text("<nav>only</nav>") == "" and text("<p>a < b</p><") == "a < b\n<"


def test_generalised_path():
    p = pages.Page(page('<div class="b2 a10"><p>x</div>'))
    assert p.named(p.best()[0]) == "html>body>div.a#.b#"


def test_consensus_overrules_one_page(spark):
    def with_teaser(n):
        return page(f'<div class="content"><p>Body {n}, of, the, page.</div><div class="teaser"><p>t{n}</div>')

    odd = page('<div class="content"><p>Short.</div><div class="teaser"><p>A long, long, teaser, with, many, commas, here.</div>')
    rows = [(n, f"https://h.example/{n}", with_teaser(n)) for n in range(5)] + [(9, "HTTP://user@H.example:80/9?q", odd), (10, "https://other.example/", odd)]
    got = dict(plain(pages.extract(spark.createDataFrame(rows, "page_id int, url string, html string")), "page_id", "text"))
    assert got[9] == "Short." and got[10].startswith("A long")
    assert got[1] == "Body 1, of, the, page."


def test_query(spark):
    import html
    import re

    want = {}
    for i, source in plain(table(spark, SF, "pages"), "page_id", "html"):
        inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if False else "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want[i] = "\n".join(b for b in blocks if b)
    rows = op9_html_extraction(spark, SF).collect()
    assert {r.page_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)


def test_edges(spark):
    schema = "page_id int, url string, html string, host int, text string, path int"
    rows = [(1, None, None, 1, "", 2), (2, "nonsense", "", None, None, None), (None, "https://a.b/", "<p>x, y", 1, "", 2), (3, "https://a.b/", "<p>x, y", 1, "", 2),
            (3, "https://a.b/", "<p>x, y", 1, "", 2), (4, "https://a.b/", "<div>" * 3000 + "deep" + "</i></b>", 1, "", 2),
            (5, "https://a.b/", "<p>" + "word " * 50000, 1, "", 2)]
    found = pages.extract(spark.createDataFrame(rows, schema))
    got = sorted(plain(found, "page_id", "n_chars"), key=repr)
    assert got == sorted([(1, 0), (2, 0), (None, 4), (3, 4), (3, 4), (4, 4), (5, 249999)], key=repr)
    assert pages.extract(spark.createDataFrame([], schema)).collect() == []


def test_open_head():
    article = "<article><h1>T</h1><p>One, two.</article>"
    assert text(f"<html><head><meta charset=utf-8><title>t</title><style>p{{}}</style>\n<body>{article}</body></html>") == "T\nOne, two."
    assert text(f"<html><head><title>t</title><script>x</script>{article}") == "T\nOne, two."
    assert text("<head><title>t</title>\nBare text.") == "Bare text."
    assert text(f"<head><link rel=x>\n<noscript><p>no</noscript></head><body>{article}") == "T\nOne, two."


def test_self_closed_svg():
    assert text("<body><p>One <svg viewBox='0 0 1 1'/>two<p>three <svg><text>no</text></svg>four<math/> five") == "One two\nthree four five"
    assert text("<body><p>One<svg class=a>no</svg> two<svg width=5/>no</svg> three") == "One two three"
    assert text("<body><p>One<svg />, two") == "One, two"


STORY = "<h1>T</h1><p>One, two.<p>Three."
COMMENTS = "<div class=comments><h1>Comments</h1><article class=comment><p>no, no, no, no, no, no</article></div><div class=ad>Buy</div>"


def test_cut_names_on_the_article():
    for body in (f'<article class="post comments-open">{STORY}{COMMENTS}</article>',
                 f'<div id="content" class="has-comments">{STORY}{COMMENTS}</div>',
                 f'<article class="post category-promotion">{STORY}</article>{COMMENTS}',
                 f'<main><div class="has-comments">{STORY}{COMMENTS}</div></main>',
                 f'<div id=logo><h1>Site</h1></div><div class="has-comments"><article class=a>{STORY}{COMMENTS}</article></div>',
                 f'<article class="post sponsored">{STORY}</article>{COMMENTS}',
                 f'<article class="comments-open"><p>T<p>One, two.<p>Three.{COMMENTS}</article>'):
        assert text(page(body)) == "T\nOne, two.\nThree."


def test_comments_and_adverts_stay_cut():
    for body in (f"<article>{STORY}</article>{COMMENTS}", f"<div>{STORY}</div>{COMMENTS}",
                 f"<article>{STORY}</article><section id=comments><article><p>no, no, no</article></section>",
                 f"<main>{STORY}<article class=comment><p>no, no</article></main>",
                 f"<div>{STORY}</div><form class=comment-form><p>no, no</form><form><p>no, no</form>"):
        assert text(page(body)) == "T\nOne, two.\nThree."


def test_list_of_posts():
    posts = "".join(f'<article class="post {c}"><h2>P{c}</h2><p>x, y</article>' for c in ("comments-open", "tag-ad", "z"))
    kept = pages.Page(page(f"<div class=list>{posts}</div>"))
    assert [b for n, b, _ in kept.blocks if kept._kept()[n]] == ["Pcomments-open", "x, y", "Ptag-ad", "x, y", "Pz", "x, y"]


def test_form_around_the_page():
    assert text(page(f"<form id=aspnetForm><nav>n</nav><article>{STORY}</article><div class=comments>no</div></form>")) == "T\nOne, two.\nThree."
    assert text(page("<form id=aspnetForm><div class=c><p>One, two.<p>Three.</div><footer>f</footer></form>")) == "One, two.\nThree."
    assert text(page("<form>Name <input></form>")) == ""
