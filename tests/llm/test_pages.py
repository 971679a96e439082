import html as html_lib
import random
import re

import pytest

from cohortml.llm.html_tree import Page
from cohortml.llm.template import extract_main_text, main_text

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def paragraphs(rng):
    return [sentence(rng, rng.randrange(15, 60)) for _ in range(rng.randrange(2, 7))]


def with_article(rng, title, body):
    ps = "".join(f"<p>{p}" + ("</p>" if rng.random() < 0.7 else "") for p in body)
    return (f"<!DOCTYPE html><html><head><title>{title} | Site</title><script>if (a < b) document.write('<p>no</p>')</script></head><body>"
            f"<header><h1>Site</h1></header><nav><a href=/>{sentence(rng, 2)}</a></nav><main><article><h1>{title}</h1>{ps}"
            f"<div class='share-buttons'>Share this</div></article>"
            f"<section id=comments><article class=comment><p>{sentence(rng, 30)}</p></article></section></main>"
            f"<aside>{sentence(rng, 12)}</aside><form><label>Mail</label><input></form><footer>&copy; {sentence(rng, 3)}</footer></body></html>")


def with_classes(rng, title, body):
    ps = "".join(f"<p>{p}</p>" for p in body[:1]) + f"<div class='ad-slot'>{sentence(rng, 9)}</div>" + "".join(f"<p>{p}</p>" for p in body[1:])
    return (f"<html><body class='no-sidebar'><div id='page-{rng.randrange(99)}'><div class='siteHeader'><a href='/'>Home</a></div>"
            f"<div class=cookie-notice>We use cookies {sentence(rng, 4)}</div><ul class=menu><li><a href=x>{sentence(rng, 2)}</a></li></ul>"
            f"<div class='post-body'><h1>{title}</h1>{ps}</div><div class='sidebar'><p>{sentence(rng, 40)}</p></div>"
            f"<div class='comments-list'><p>{sentence(rng, 80)}</p></div><div class='footer'>{sentence(rng, 5)}</div></div></body></html>")


def without_marks(rng, title, body):
    """Nothing but the repetition over pages, and the mass of text, tells boilerplate here."""
    ps = "".join(f"<p>{p}</p>" for p in body)
    return ("<html><body><div class=a1><div>The Daily Planet</div><div>All the news since nineteen hundred and two</div></div>"
            "<div class=b7><p>This web site keeps small files on your computer so that it works. By reading on you accept that, "
            "and everything that is written on the page about it.</p></div>"
            f"<div class=c3><h1>{title}</h1>{ps}<p>Write to the editors if you found a mistake in what you have read here.</p></div>"
            f"<div class=d9><p>{sentence(rng, 8)}</p></div><div class=e2>Printed nowhere. Some rights kept.</div></body></html>")


MAKERS = [with_article, with_classes, without_marks]


def site(host, maker, n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        title, body = sentence(rng, 6), paragraphs(rng)
        out.append((f"https://{host}/{i}", maker(rng, title, body), "\n".join([title, *body])))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h, *_) in enumerate(rows)],
                                 "page_id long, url string, html string, host string, tokens string").repartition(3)


def test_sites_with_and_without_marks(spark):
    rows = [r for i, m in enumerate(MAKERS) for r in site(f"h{i}.example.org", m, 25, i)]
    rows += site("big.example.org", without_marks, 60, 9)  # a host with nearly half of all pages
    got = {r["page_id"]: r for r in extract_main_text(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, (url, _, want) in enumerate(rows):
        assert got[i]["text"] == want, url
        assert got[i]["n_chars"] == len(want) and got[i]["url"] == url


def test_hosts_of_one_and_two_pages(spark):
    rows = site("one.example", with_article, 1, 1) + site("two.example", with_classes, 2, 2)
    got = {r["page_id"]: r["text"] for r in extract_main_text(frame(spark, rows)).collect()}
    assert [got[i] for i in range(3)] == [w for _, _, w in rows]


def test_copies_do_not_make_their_text_a_template(spark):
    rows = site("h.example", with_article, 12, 3)
    rows += [rows[0]] * 80
    got = {r["page_id"]: r["text"] for r in extract_main_text(frame(spark, rows)).collect()}
    assert [got[i] for i in range(len(rows))] == [w for _, _, w in rows]


def test_odd_rows(spark):
    rows = [(None, None, "a"), (7, None, "b"), (7, "not a url", "<p>x &amp; y<p>z"), (7, "not a url", "<p>x &amp; y<p>z"),
            (None, "http://h.example/", ""), (8, "http://h.example/", "plain &#8364; text without marks"),
            (9, "HTTP://U@H.Example:80/q", "<div>" * 3000 + "deep" + "</div>" * 10), (10, "http://h.example/2", "<p " + "a=" * 20000)]
    schema = "page_id long, url string, html string"
    got = extract_main_text(spark.createDataFrame(rows, schema))
    assert sorted((str(r["page_id"]), str(r["url"]), r["text"], r["n_chars"]) for r in got.collect()) == sorted([
        ("None", "None", "a", 1), ("7", "None", "b", 1), ("7", "not a url", "x & y\nz", 7), ("7", "not a url", "x & y\nz", 7),
        ("None", "http://h.example/", "", 0), ("8", "http://h.example/", "plain € text without marks", 26),
        ("9", "HTTP://U@H.Example:80/q", "deep", 4), ("10", "http://h.example/2", "<p " + "a=" * 20000, 40003)])
    assert extract_main_text(spark.createDataFrame([], schema)).count() == 0
    assert extract_main_text(spark.createDataFrame([(1, "http://x.y/", None)], schema)).first()["text"] == ""


@pytest.mark.parametrize("source", ["<a title='5>", "<p>" * 200_000, "<b <c " * 100_000, "<" * 300_000, "<li>x" * 100_000,
                                    "<script>" + "x" * 300_000, "<!--" * 100_000, '<a b="' * 100_000 + ">", "<b>x</i>" * 100_000,
                                    "<div>" * 50_000 + "</li>" * 50_000, "<ul>" + "<div><li>x" * 20_000])
def test_reading_is_linear(source):
    import time
    begin = time.time()
    main_text(source, frozenset(), None)
    assert time.time() - begin < 20


def test_blocks_and_references():
    page = Page("<body><p>a <b>b</b>c&nbsp;&lt;p&gt;<br>d<table><tr><td>1<td>2</table>e<script>f</script>g</p></body>")
    assert [b[0] for b in page.blocks] == ["a bc <p> d", "1", "2", "eg"]


def test_registered_query(spark):
    """The given pages hold one ``article`` each: its headline and paragraphs, read by plain patterns."""
    from tests.conftest import SF_SMALL
    from cohortml.llm.queries import QUERIES
    query = next(f for name, f in QUERIES.items() if name.startswith("op11_"))
    got = {r["page_id"]: r["text"] for r in query(spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1).replace("<br>", " ")
        blocks = [" ".join(html_lib.unescape(re.sub("</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)
