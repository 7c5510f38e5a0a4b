"""Extraction on made pages whose articles are known, and on the test pages."""

import html as entities
import random
import re

from pyspark.sql import functions as F

from tradeloom.llm.queries import QUERIES
from tradeloom.llm.site_templates import (
    ONE_PLACE,
    extract,
    main_text,
    parse,
    read_page,
    read_pages,
    site_templates,
    templates_of,
)

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"


def prose(i, k):
    return f"Sentence {i} of part {k} says something about number {i * 31 + k}."


def plain_site(i, title=None):
    """A page without article element: only recurrence tells its template."""
    return (
        f"<html><head><title>{title or f'Story {i}'}</title></head><body><div><span>Our site</span> since 1999</div>"
        f"<div><p>We use small files to remember you.</p><p>Accept all</p></div>"
        f"<div><h1>Story {i}</h1><p>{prose(i, 1)}</p><p>{prose(i, 2)} &amp; more&nbsp;text</p></div>"
        f"<div>All rights kept &copy; the site</div></body></html>"
    )


def plain_text(i):
    return f"Story {i}\n\n{prose(i, 1)}\n\n{prose(i, 2)} & more text"


def test_templates_are_found_per_host(spark):
    rows = [(i, f"https://www.Site.org/{i}", plain_site(i)) for i in range(30)]
    rows += [(100 + i, f"https://other.org/{i}", plain_site(900 + i)) for i in range(3)]
    got = {r.id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == plain_text(i) for i in range(30))
    # three pages are not enough to know a template
    assert got[100].startswith("Our site since 1999\n\nWe use small files")
    hosts = {r.host for r in site_templates(spark.createDataFrame(rows, PAGES)).collect()}
    assert hosts == {"www.site.org"}


def test_copies_of_an_article_are_no_template(spark):
    rows = [(i, f"https://a.org/{i}", plain_site(i)) for i in range(10)]
    rows += [(50 + i, f"https://a.org/c{i}", plain_site(7).replace("since 1999", f"since {i}")) for i in range(40)]
    got = {r.id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[50 + i].endswith(plain_text(7)) for i in range(40))
    assert got[3] == plain_text(3)


PAGE = """<!DOCTYPE html><html lang=en><head><title>A &lt;title&gt;</title><style>p{}</style></head>
<body class="no-sidebar header-on"><a class="skip-link" href="#x">Skip</a>
<header><h1>Site</h1><nav><ul><li><a href=/a>A<li><a href=/b>B</ul></nav></header>
<div class="cookieNotice">We use cookies</div><!-- a <p>comment</p> -->
<main id=content><article class="post has-comments"><header class="entry-header"><h1>Head &eacute; &#8212; line</h1><p>by someone</p></header>
<p>First <b>bold</b> <i>text</i>
  goes on<br>here.<p>Second &amp;amp; <a href="https://x.org/?a=1&b=2">link</a>.</p>
<script>document.write("<p>no</p>")</script><noscript>no</noscript>
<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>
<div class="ad-slot"><p>Buy</p></div><aside><p>See also</p></aside>
<form action=x><label>Mail</label><input name=q><button>Go</button></form>
<blockquote>Quoted</blockquote><pre>  code   here </pre><p style="display:none">hidden</p><p aria-hidden="true">h</p>
<div class="share"><a>Tweet</a></div></article>
<section id="comments"><article class="comment"><p>Nice!</p></article></section></main>
<div role="complementary">side</div><footer>&copy; x</footer></body></html>"""


def test_elements_that_are_no_article():
    want = [
        "Head é — line", "First bold text goes on here.", "Second &amp; link.", "one", "two", "c1", "c2", "Quoted",
        "code here",
    ]
    assert main_text(PAGE).split("\n\n") == want


def test_broken_markup():
    assert main_text("") == "" and main_text("just text") == "just text"
    assert main_text("<p>a<p>b</div></p></p>c<") == "a\n\nb\n\nc<"
    assert main_text("<p>a < b and c > d</p><p title='x>y'>e") == "a < b and c > d\n\ne"
    assert main_text("<p>open <!-- never closed <p>x") == "open"
    assert main_text("<script>if (a</b) </script ><p>x</p><style>p") == "x"
    assert main_text("<P>Upper</P><DIV CLASS=Menu>m</DIV>") == "Upper"
    deep = "<div>" * 5000 + "<p>low</p>" + "</div>" * 5000
    assert main_text(deep) == "low"
    assert main_text("<a href='" * 20_000) == ""
    assert parse("<title>One</title><title>Two</title>")[1] == "One"


def test_hashes_ignore_attributes_but_not_words():
    same, as_well, other = (
        [p.whole for p in read_page(page).parts]
        for page in (
            "<div class=x><p>same words</p></div>", "<div  id='7'><p>same\n words</p></div>", "<div><p>other words</p></div>",
        )
    )
    assert same == as_well and not set(same) & set(other)


def test_articles_within_other_elements_are_not_the_text():
    body = "<article><p>The text.</p></article>"
    for other in (
        "<aside><article><p>Seen elsewhere</p></article></aside>",
        "<section id=comments><article class=comment-body><p>Nice</p></article></section>",
        "<article class='comment-body'><p>Nice</p></article>",
        "<nav><main><p>Menu</p></main></nav>",
    ):
        assert main_text(body + other) == main_text(other + body) == "The text."
        assert main_text("<div><p>Plain text.</p></div>" + other) == "Plain text."
    assert main_text(f"<form action=x>{body}</form>") == "The text."


def main_site(i, title="The Site", before="", after=""):
    """A page in main, with boxes that no tag or class gives away, under a title that all pages share."""
    body = "".join(f"<p>{prose(i, k)} {'and more of it ' * 4}</p>" for k in range(2 + i % 3))
    return (
        f"<title>{title}</title><main><div class=c1><p>Join our letter, it comes every week.</p></div>{before}{body}{after}"
        "<div class=c2><p>We write about things.</p><p>Call us any time.</p></div></main>"
    )


def main_site_text(i, before=""):
    return "\n\n".join([before] * bool(before) + [f"{prose(i, k)} {'and more of it ' * 4}".strip() for k in range(2 + i % 3)])


def test_templates_inside_main_under_one_title(spark):
    rows = [(i, f"https://a.org/{i}", main_site(i)) for i in range(60)]
    got = {r.id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: main_site_text(i) for i in range(60)}


def test_prose_that_pages_quote_stays(spark):
    quote = "<p>A quoted sentence that many pages have.</p>"
    pages = [main_site(i, f"T {i}", before=quote) if i % 2 else main_site(i, f"T {i}", after=quote + "<p>End</p>" * (i % 4)) for i in range(80)]
    rows = [(i, f"https://a.org/{i}", p) for i, p in enumerate(pages)]
    for r in extract(spark.createDataFrame(rows, PAGES)).collect():
        assert "A quoted sentence that many pages have." in r.text and "Join our letter" not in r.text


def test_a_section_of_a_large_host_has_a_template(spark):
    box = "<div><p>Only here: the section's own words.</p></div>"
    rows = [(i, f"https://a.org/{i}", plain_site(i)) for i in range(300)]
    rows += [(1000 + i, f"https://a.org/s/{i}", plain_site(1000 + i).replace("<body>", "<body>" + box)) for i in range(12)]
    got = {r.id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == plain_text(i) for i in got)


def test_counting_beside_brute_force(spark):
    rng = random.Random(8)
    boxes = [f"<div><p>Box {k} says so.</p></div>" for k in range(4)] + ["<ul><li><a href=x>One</a><li><a>Two</a></ul>"]
    rows = []
    for i in range(160):
        content = [f"<p>{rng.choice('abcdef')} {rng.randrange(40)} {'long ' * rng.randrange(9)}</p>" for _ in range(rng.randrange(1, 4))]
        for box in boxes:
            if rng.random() < 0.5:
                content.insert(rng.choice([0, 0, 0, len(content)]), box)
        inner = "".join(content)
        title = rng.choice(["", "<title>Site</title>", f"<title>{rng.randrange(30)}</title>"])
        page = title + (f"<main>{inner}</main>" if rng.random() < 0.5 else f"<div>{inner}</div>")
        rows.append((i, f"https://h{rng.randrange(3)}.org/{i}", page))
    read = read_pages(spark.createDataFrame(rows, PAGES), "page_id", "url", "html")
    got = {tuple(r) for r in templates_of(read, 5, 12).collect()}
    want = set()
    for host in ("h0.org", "h1.org", "h2.org"):
        pages = [read_page(p) for _, url, p in rows if host in url]
        leads = {}
        for p in pages:
            if p.title:
                leads.setdefault(p.title, set()).add(p.lead)
        sizes = [len(x) for x in leads.values()]
        wide = max(sizes) >= 5 and max(sizes) >= 0.2 * sum(sizes)

        def count(found):
            titles, texts = {p.title or x.context for p, x in found}, {x.context for _, x in found}
            return max(len(titles), len(texts)) if wide else len(titles)

        every = {}
        for p in pages:
            for x in p.parts:
                every.setdefault(x.whole, []).append((p, x))
        for whole, found in every.items():
            n = count(found)
            if n < (12 if found[0][1].inside else 5):
                continue
            if found[0][1].free:
                want.add((host, whole, None))
                continue
            for place in {v for _, x in found for v in (x.start, x.end)}:
                if count([(p, x) for p, x in found if place in (x.start, x.end)]) >= ONE_PLACE * n:
                    want.add((host, whole, place))
    assert got == want and any(p is None for _, _, p in got) and any(p is not None for _, _, p in got)


def test_query(spark):
    """The test pages are simple enough for a second, quite different way."""
    got = {r.page_id: r for r in QUERIES["op1_site_templates"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [entities.unescape(re.sub(r"</?b>", "", x)).split() for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n\n".join(" ".join(b) for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "", ""), (1, "", ""), (2, "https://a.org", "<p>é " + "x " * 200_000 + "</p>"), (3, "u", "<p>t</p>")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"host": F.lit("h"), "page": F.lit(1), "text": F.lit("t")})
    got = sorted((str(r.id), str(r.url), r.text[:3], len(r.text)) for r in extract(pages).collect())
    assert got == [("1", "", "", 0), ("1", "", "", 0), ("2", "https://a.org", "é x", 400_001), ("3", "u", "t", 1), ("None", "None", "", 0)]
    assert extract(pages.where("false")).count() == 0
