import html as entities
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.html_wrappers import Wrapper, align, extract, extract_pages, fold, stream
from tallyframe.llm.queries import op4_html_wrappers

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li>News</li></ul></nav><!-- <p>gone</p> --><div class="ad">Buy now</div>
<article><h1>Title &lt;1&gt;</h1>{body}<form><input>Mail</form><div class="share">Share</div></article>
<section class="comments"><article class="comment"><p>First!</p></article></section><aside>Side</aside><footer>&copy; us</footer></body></html>"""


def test_furniture_is_left_out():
    text, _ = extract(PAGE.format(body="<p>One <b>two</b>three<br>four\n  five&nbsp;six<p>seven</p><div>eight</div>nine"), None)
    assert text == "Title <1> One twothree four five six seven eight nine"
    assert extract("<p>no article <i>here</i></p><div role='navigation'>x</div>", None)[0] == "no article here"
    assert extract(None, None)[0] == extract("", None)[0] == ""
    assert extract("a < b <p>cut &am", None)[0] == "a < b cut &am"
    assert extract("<article>kept <p", None)[0] == "kept"


def test_folding_and_alignment():
    a = fold(["<ul", "li", "#t", "li", "#t", "li", "#t", ">ul", "p", "#t"])
    assert a == ["<ul", ["+", ["li", "#t"]], ">ul", "p", "#t"]
    b = fold(["<ul", "li", "#t", ">ul", "<div.ad", "#f", ">div", "p", "#t", "p", "#t"])
    both = align(a, b)
    wrapper = Wrapper(both)
    for tokens in (["<ul", "li", "#t", "li", "#t", ">ul", "p", "#t"], ["<ul", "li", "#t", ">ul", "<div.ad", "#f", ">div", "p", "#t", "p", "#t"]):
        assert wrapper.slots(tokens) == [k for k, t in enumerate(tokens) if t == "#t"]
    assert wrapper.slots(["<ol", "#t"]) is None
    assert align(both, a) == both and align(both, b) == both


def test_wrappers_parse_their_pages(spark):
    bodies = ["<p>a</p>" * n + ("<h2>b</h2><p>c</p>" if n % 2 else "") for n in range(1, 9)]
    rows = [(k, f"http://h{k % 2}.org/{k}", PAGE.format(body=b), "x") for k, b in enumerate(bodies)]
    rows += [(None, None, "<p>x</p>", "x"), (99, "not a url", None, "x"), (99, "http://h0.org/", "", "x"), (100, "http://h0.org/", PAGE.format(body="<p>" + "long " * 20_000), "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = extract_pages(pages).collect()
    want = sorted(((p, u, extract(h, None)[0]) for p, u, h, _ in rows), key=str)
    assert sorted(((r.page_id, r.url, r.text) for r in got), key=str) == want
    assert sum(r.parsed for r in got) >= len(rows) - 1
    assert extract_pages(pages.limit(0)).count() == 0


def test_query_on_pages(spark):
    sf = "/root/testdata/sf0.01"
    source = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op4_html_wrappers(spark, sf).collect()
    assert len(rows) == len(source)
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", source[r.page_id].html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inner)
        plain = [" ".join(entities.unescape(re.sub(r"</?\w+[^>]*>", lambda m: " " if m[0].startswith("<br") else "", p)).split()) for p in parts]
        assert r.text == " ".join(p for p in plain if p) and r.n_chars == len(r.text)


def test_most_pages_are_parsed_by_their_wrapper(spark):
    got = extract_pages(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    assert got.where("parsed").count() >= 0.95 * got.count()


def test_state_classes_do_not_hide_the_article():
    pages = [
        "<body class='has-sidebar'>{}</body>",
        "<body class='search header'>{}</body>",
        "<div class='layout no-sidebar'>{}</div>",
        "<article class='post comments-open'><p>kept</p></article>",
        "<main id='search-results'>{}</main>",
        "<div class='hidden-xs content'>{}</div>",
        "<form id='aspnetForm'><div class='widget'><article>{}</article></div></form>",
    ]
    for page in pages:
        assert extract(page.format("<p>kept</p>"), None)[0] == "kept", page


def test_articles_in_comments_and_asides_stay_out():
    for wrapper in ("<ol class='comment-list'>{}</ol>", "<aside>{}</aside>", "<div class='related'>{}</div>", "<article class='comment'>{}</article>", "<div class='site-header'>{}</div>"):
        inner = "gone" if "header" in wrapper else "<article>gone</article>"
        assert extract(f"<main><p>kept</p>{wrapper.format(inner)}</main>", None)[0] == "kept", wrapper


def test_constant_slots_are_template_on_pages_without_an_article(spark):
    rows = [(k, f"http://a.org/{k}", f"<div class='top'>Home of news</div><div id='b2'><p>Our offer</p></div><div class='x'><p>story {k}</p><p>more {k}</p></div>") for k in range(6)]
    rows += [(10 + k, f"http://copies.org/{k}", "<div>same page</div>") for k in range(5)]
    rows += [(20 + k, f"http://flagged.org/{k}", f"<div>Top</div><div class='widget'><p>text {k}</p></div>") for k in range(4)]
    rows += [(30 + k, f"http://few.org/{k}", f"<div>Top</div><p>text {k}</p>") for k in range(2)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"story {k} more {k}" for k in range(6))
    assert all(got[10 + k] == "same page" for k in range(5))
    assert all(got[20 + k] == f"text {k}" for k in range(4))
    assert all(got[30 + k] == f"Top text {k}" for k in range(2))


def test_article_headers_and_marked_paragraphs():
    pages = {
        "<body class='single-post has-sidebar'><article><p>Hello world</p></article></body>": "Hello world",
        "<main class='with-sidebar'><p>Hello</p></main>": "Hello",
        "<article><div class='article-header'><h1>Title</h1></div><p>Body</p></article>": "Title Body",
        "<article><header><h1>Title</h1></header><p>Body</p><p class='advert'>Buy now</p><ul><li class='share'>Tweet<li>One</ul><footer>tags</footer></article>": "Title Body One",
        "<header><h1>Site</h1></header><article><h1 class='header'>Title</h1><p>Body</article>": "Title Body",
    }
    for page, text in pages.items():
        assert extract(page, None)[0] == text, page


def test_the_wrapper_decides_on_hosts_without_semantic_tags(spark):
    """Menus, a slogan and a note in neutral elements: the learned wrapper leaves out what the region alone can't tell."""
    page = "<div class='b1'><ul><li>Home<li>News<li>Shop</ul></div><div class='b2'><h2>{title}</h2><p>{one}</p>{more}</div><div class='b3'><p>Written by our staff</p></div>"
    rows, want = [], {}
    for k in range(12):
        more = "".join(f"<p>part {j} of story {k}</p>" for j in range(k % 4))
        rows.append((k, f"https://plain.org/{k}", page.format(title=f"Title {k}", one=f"Once {k}", more=more)))
        want[k] = " ".join([f"Title {k}", f"Once {k}", *(f"part {j} of story {k}" for j in range(k % 4))])
    got = {r.page_id: r for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(r.parsed for r in got.values())
    assert {k: r.text for k, r in got.items()} == want
    assert all(extract(html, None)[0] != want[k] for k, _, html in rows)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<ul", ">ul", "li", "p", "#t", "#a"]), max_size=9), min_size=1, max_size=4))
def test_a_wrapper_parses_every_stream_it_was_learned_from(streams):
    """Optional parts side by side, repeats inside optional parts: each text token gets one slot of its kind."""
    whole = None
    for s in sorted(map(fold, streams), key=lambda e: (len(str(e)), str(e))):
        whole = s if whole is None else align(whole, s)
    wrapper = Wrapper(whole)
    for tokens in streams:
        for places in (wrapper.places(tokens), wrapper._aligned(tokens)):
            assert places is not None, (whole, tokens)
            assert sorted(at for _, at in places) == [k for k, t in enumerate(tokens) if t[0] == "#"]
            assert all(wrapper.kinds[slot] == tokens[at] for slot, at in places)


def test_unknown_tokens_are_not_parsed():
    wrapper = Wrapper(fold(stream("<div><p>A</p></div>")[0]))
    html = "<div><h1></h1><p>A</p></div>"
    assert wrapper.places(stream(html)[0]) is None or "h1" in str(wrapper.expression)
    assert extract(html, wrapper) == ("A", False)
    assert wrapper._aligned(["<nothing", "#t"]) is None


def test_comments_adverts_and_consent_mark_by_any_piece():
    for mark in ("post-comments", "commentlist", "user-comment-box", "ad-slot", "cookie-notice-bar", "comments"):
        assert extract(f"<article><p>kept</p><div class='{mark}'><p>gone</p></div></article>", None)[0] == "kept", mark
    for mark in ("comments-open", "no-ads", "commentary", "has-comments", "adaptive", "promotion-theory"):
        assert extract(f"<article><div class='{mark}'><p>kept</p></div></article>", None)[0] == "kept", mark
    assert extract("<article class='ad-free comments-open'><p>kept</p></article>", None)[0] == "kept"


def test_what_a_marked_region_holds_counts_inside_an_article():
    pages = {
        "<article><p>Body</p><p class='comment'>a remark of the author</p></article>": "Body a remark of the author",
        "<article><p>Body</p><ol class='commentlist'><li class='comment'>First!</ol></article>": "Body",
        "<article><div class='banner'><h1>Title</h1></div><p>Body</p></article>": "Title Body",
        "<article><h1>Title</h1><div class='banner'><h1>Buy</h1></div><p>Body</p></article>": "Title Body",
        "<article><p>Body</p><section class='related'><h2>Related work</h2><p>Others <a href='x'>tried</a> before us.</p></section></article>": "Body Related work Others tried before us.",
        "<article><p>Body</p><section class='related'><p><a href='x'>Another post</a></p><p><a href='y'>One more</a></p></section></article>": "Body",
        "<article><p>Body</p><div class='related'><article><p>Teaser</p></article></div></article>": "Body",
        "<article><p>Body</p><section class='comments'><h1>Comments</h1><p>First!</p></section></article>": "Body",
        "<article><p>Body</p><aside class='related'><p>gone</p></aside></article>": "Body",
    }
    for page, text in pages.items():
        assert extract(page, None)[0] == text, page


def test_the_wrapper_decides_on_regions_marked_in_part_inside_articles(spark):
    """A box whose class holds a furniture word goes where its text is the host's, and stays where it is the page's; a fixed line that nothing marks stays."""
    page = "<article><h1>T {k}</h1><p>Story {k}</p><div class='{mark}-large-x1'><p>{text}</p></div><p>The end</p></article>"
    rows = [(k, f"http://fixed.org/{k}", page.format(k=k, mark="notice", text="Read our terms")) for k in range(6)]
    rows += [(10 + k, f"http://own.org/{k}", page.format(k=k, mark="notice", text=f"Note {k} of the author")) for k in range(6)]
    rows += [(20 + k, f"http://unmarked.org/{k}", page.format(k=k, mark="figure", text="Read our terms")) for k in range(6)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(6):
        assert got[k] == f"T {k} Story {k} The end"
        assert got[10 + k] == f"T {k} Story {k} Note {k} of the author The end"
        assert got[20 + k] == f"T {k} Story {k} Read our terms The end"
    assert all(extract(html, None)[0] != got[k] for k, _, html in rows[:6])
