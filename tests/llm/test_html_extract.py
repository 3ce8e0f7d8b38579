"""HTML extraction: markup rules on fixed pages, template counts against a plain count."""

import html
import re
import time

import pytest

from tallyframe.llm import html_extract as H


def text(source):
    return H.Page(source).text(set())


@pytest.mark.parametrize("source,want", [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>a < b &lt; c &am", "a < b < c &am"),
    ("<article><h1>T</h1><p><b>x y<br><p>z</article>", "T\n\nx y\n\nz"),
    ("<article><p>a&nbsp;&#8364;\n\t b &notanentity; &copy", "a € b ¬anentity; ©"),
    ("<body><p>no<article><p>yes</article><p>no", "yes"),
    ("<main><p>yes</p></main><p>no", "yes"),
    ("<p>one<div>two<p>three</div>four", "one\n\ntwo\n\nthree\n\nfour"),
    ("<article>a<script>var t='</p><b>';</script>b<style>p{}</style><!-- c --><!-- open", "a b"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>no</footer></article>", "T\n\nx"),
    ("<header><h1>no</h1></header><p>x</p><nav>no</nav><aside>no</aside><form>no</form><footer>no</footer>", "x"),
    ("<article><div class='share-box'>no</div><p>x<span class=ad>no</span>y</p><div id=comments><p>no</div></article>", "x y"),
    ("<article><p>x</p><section class=comments><article class=comment><p>no</p></article></section></article>", "x"),
    ("<article class='post has-sidebar'><p>x</p></article><article class=comment>no</article>", "x"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "1\n\n2\n\na b\n\nc"),
    ("<div role=dialog>no</div><div hidden>no</div><div style='display: none'>no</div><p title='a>b'>x", "x"),
    ("</p></div>a</article><p>b</b></i>c", "a\n\nbc"),
    ("<P>A<P>B<SCRIPT>x</SCRIPT >C", "A\n\nB C"),
    ("<article><p>x</p></article><article><p>y</p></article>", "x\n\ny"),
])
def test_blocks(source, want):
    assert text(source) == want


def test_deep_and_long_pages():
    assert text("<div>" * 3000 + "x" + "</div>" * 3000) == "x"
    assert text("<p>" + "word " * 200_000) == ("word " * 200_000).strip()
    assert text("<a '" * 2000 + "<p>x") .endswith("x")


@pytest.mark.parametrize("part", ["<a ", "<a", "</a ", "<p a=\"", "<p a=\"'", "<div></b></p>", "<main>x", "<ul><dd></dd>", "<aside><article>x", "<!--", "<script>", "<div>x"])
def test_damaged_pages_take_time_in_proportion(part):
    def taken(n):
        start = time.process_time()
        page = H.Page(part * (n // len(part)))
        page.text({1}, {2})
        return time.process_time() - start

    assert taken(800_000) < 16 * max(min(taken(100_000), taken(100_000)), 0.1)


@pytest.mark.parametrize("source,want", [
    ("<p>a <b <i>c", "a c"),  # <b goes on to the next >
    ("<p>a <b <p>c</p> <d <e", "a c <d <e"),
    ("<p>x <a t=\"y <p>z</p>", "x <a t=\"y z"),
    ("<p>x <a t=\"<p>y</p>\" <p>z</p>", "x z"),
    ("<p>x <a t=\"'<p>y</p>' <p>z</p><!-- no -->", "x <a t=\"' y ' z"),
])
def test_tags_that_never_end_are_text(source, want):
    assert " ".join(text(source).split()) == want


def page(body):
    return f"<html><body>{body}</body></html>"


def test_templates_of_a_host_go_and_article_paragraphs_stay(spark):
    rows = []
    for i in range(40):
        rows.append((i, f"http://a.net/{i}", page(f"<div>Our shop<p>Call us</p></div><p>Own text {i}</p><p>Call us</p>")))
        rows.append((100 + i, f"http://b.net/{i}", page(f"<article><p>Own {i}</p><p>Same in all</p><div><p>Box in all</p></div></article>")))
        rows.append((200 + i, f"http://c{i}.net/", page(f"<div>Our shop<p>Call us</p></div><p>Own text {i}</p>")))
        rows.append((300 + i, "http://copies.net/", page("<p>The same page again</p>")))
    rows += [(900, None, None), (901, "no url", ""), (902, None, "<p>x</p>"), (None, "http://a.net/q", page("<div>Our shop<p>Call us</p></div><p>Q"))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, page string, templates string").repartition(4)
    got = {r.page_id: (r.url, r.text) for r in H.extract_text(df).collect()}
    assert len(got) == len(rows)
    for i in range(40):
        assert got[i][1] == f"Own text {i}"
        assert got[100 + i][1] == f"Own {i}\n\nSame in all"
        assert got[200 + i][1] == f"Our shop\n\nCall us\n\nOwn text {i}"
        assert got[300 + i][1] == "The same page again"
    assert (got[900], got[901], got[902], got[None][1]) == ((None, ""), ("no url", ""), (None, "x"), "Q")


def test_templates_are_those_that_a_plain_count_finds(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.net/{i}", page("".join(f"<div>box {k}</div>" for k in range(6) if (i * 7 + k) % (k + 1) == 0) + f"<p>{i}")) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: set(r.templates) for r in H.site_templates(df).collect()}
    for host in {"h0.net", "h1.net", "h2.net"}:
        own = [H.Page(h).candidates() for _, u, h in rows if host in u]
        want = {k for k in set().union(*own) if sum(k in o for o in own) >= max(H.LEAST_PAGES, H.LEAST_SHARE * len(own))}
        assert got.get(host, set()) == want
    before = sorted(map(tuple, H.extract_text(df).collect()))
    plain = sorted(map(tuple, H.extract_text(df).collect()))
    monkeypatch.setattr(H, "MOST_BROADCAST_HASHES", 0)  # the shuffled way
    assert sorted(map(tuple, H.extract_text(df).collect())) == plain
    assert sorted(map(tuple, H.extract_text(df).collect())) == before


def test_empty_table(spark):
    assert H.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_given_pages_equal_a_reading_of_their_fixed_layout(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in H.extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split(r"</?p>|</?h1>", article)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_variants_of_a_large_host_go_by_their_count(spark, monkeypatch):
    rows = [(i, f"http://hot.net/{i}", page(f"<div>Menu of variant {i % 60}<p>Call us</p></div><p>Own text {i}</p><p>Said before</p>")) for i in range(320)]
    rows += [(1000 + i, f"http://hot.net/copy{i}", page(f"<div><p>{'Told at many addresses. ' * 20}</p></div><div>Advert {i}</div>")) for i in range(8)]
    rows += [(2000 + i, f"http://hot.net/list{i}", page(f"<article><h1>Dish {i}</h1><ul><li>salt<li>rice {i}</ul><div>Follow us</div></article>")) for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in H.extract_text(df).collect()}
    for i in range(320):
        assert got[i] == f"Own text {i}"
    for i in range(8):
        assert got[1000 + i] == ("Told at many addresses. " * 20).strip() + f"\n\nAdvert {i}"
        assert got[2000 + i] == f"Dish {i}\n\nsalt\n\nrice {i}"
    monkeypatch.setattr(H, "MOST_OF_HOST", 0)  # each page with its own
    assert {r.page_id: r.text for r in H.extract_text(df).collect()} == got


@pytest.mark.parametrize("source,want", [
    ("<div class='layout has-sidebar'><article><p>x</p></article></div>", "x"),
    ("<div id='page' class='header-fixed'><p>x</p></div>", "x"),
    ("<form><nav>no</nav><article><p>x</p></article></form>", "x"),
    ("<form><div class='sidebar'><main><p>x</p></main><p>no</p></div></form>", "x"),
    ("<div hidden><div class=widget><article>x<div class=ad>no</div></article></div></div>", "x"),
    ("<head><title>no</title><body><article>x</article>", "x"),
    ("<article><header class='entry-header'><h1>T</h1></header><p>x</p></article>", "T\n\nx"),
    ("<article><header class='header'><h1 class=header>T</h1></header><p>x</p></article>", "T\n\nx"),
    ("<aside><article>x</article></aside>", "x"),
    ("<article>x</article><aside><article>no</article></aside><nav class=menu>no</nav>", "x"),
    ("<article><p>x</p><div class=comments><article>no</article></div></article>", "x"),
    ("<div class='share-buttons'>no</div><div class='not-shared widget'>no</div><p>x</p>", "x"),
])
def test_nothing_that_holds_the_article_goes(source, want):
    assert text(source) == want


STORY, CARD = "A long story is told here. " * 5, "Read this too"


@pytest.mark.parametrize("source,want", [
    (f"<main><h1>T</h1><p>{STORY}</p><article>{CARD}</article><article>{CARD}</article></main><p>no", f"T\n\n{STORY.strip()}\n\n{CARD}\n\n{CARD}"),
    (f"<main><h1>T</h1><p>{STORY}</p>{f'<article>{CARD}</article>' * 30}</main>", "\n\n".join(["T", STORY.strip(), *[CARD] * 30])),
    (f"<main><p>no</p><article><h1>T</h1><p>{STORY}</p></article></main>", f"T\n\n{STORY.strip()}"),
    (f"<main><p>{STORY}</p></main><article>{CARD}</article>", f"{STORY.strip()}\n\n{CARD}"),
    (f"<body><h1>T</h1><p>{STORY}</p><article>{CARD}</article>", f"T\n\n{STORY.strip()}\n\n{CARD}"),
    (f"<body><div>{STORY}</div><article>{CARD}</article>", CARD),
])
def test_story_of_main_stays_beside_teaser_articles(source, want):
    assert text(source) == want


def test_counts_take_teasers_and_leave_repeated_articles(spark):
    def cards(v):
        return "".join(f"<article>{CARD} {v} {k}</article>" for k in range(20))

    rows = [(i, f"http://a.net/{i}", page(f"<main><h1>T {i}</h1><p>{STORY} {i}</p>{cards(i % 20)}</main>")) for i in range(120)]
    rows += [(1000 + i, f"http://a.net/copy{i}", page(f"<main><p>Line {i}</p><article><p>{STORY}</p></article></main>")) for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in H.extract_text(df).collect()}
    for i in range(120):
        assert got[i] == f"T {i}\n\n{STORY.strip()} {i}"
    for i in range(8):
        assert got[1000 + i] == STORY.strip()
