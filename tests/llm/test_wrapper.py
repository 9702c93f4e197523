import pytest

from tidemill.llm import wrapper


def text(page):
    return " ".join(t for _, _, t in wrapper.blocks(page, None))


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a<br>b  \n c</p>", "a b c"),
    ("<article><h1>T</h1><p>one<b>two</b><br><p>three &amp; &eacute;&#233; &am</article><footer>f</footer>", "T onetwo three & éé &am"),
    ("<nav><a href='/'>x</a></nav><article><p>a</p><div class='comments'><p>c</p></div><aside>s</aside></article>", "a"),
    ("<body class='menu-left'><div id=content><p>long enough text of the article</p></div><div class='ad'>b</div></body>",
     "long enough text of the article"),
    ("<main><form><p>f</p></form><ul><li>one<li>two</ul><script>var t='</p>';</script><style>p{}</style>end</main>", "one two end"),
    ("<article><p>cut off <b>in a ta</b><a hre", "cut off in a ta"), ("<article><p>x<!-- open <p>y", "x"),
    ("<header>site</header><article><header><h1>T</h1></header>a < b</article>", "T a < b"),
    ("<div class='cookie-notice'>c</div><article class='post'>a</article><article class='teaser'>b</article>", "a"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c")])
def test_article_text(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page,want", [
    ("<p>a<svg-icon></svg-icon> b</p><p>c</p>", "a b c"), ("<title-bar>a</title-bar><p>b</p>", "a b"),
    ("<select-box>a</select-box><p>b</p>", "a b"), ("<p>a <svg/>b</p><p>c</p>", "a b c"), ("<p>a <SVG width=1 />b</p>", "a b"),
    ("<p>a <svg width=1><path d=''/>x</svg>b</p>", "a b"), ("<p>a<script\n>x</script> b</p>", "a b"),
    ("<p>for <math><mi>x</mi><mo>=</mo><mn>2</mn></math> it holds</p>", "for x=2 it holds")])
def test_only_raw_elements_are_skipped(page, want):
    assert text(f"<main>{page}</main>") == want


@pytest.mark.parametrize("page,want", [
    ("<article><p>first half</p></article><article><p>second half of it</p></article>", "first half second half of it"),
    ("<main><p>lead</p><article><p>body</p></article></main>", "lead body"),
    ("<div><p>lead</p></div><div><p>a body that is far longer than its lead</p></div>", "lead a body that is far longer than its lead")])
def test_content_outside_one_element_stays(page, want):
    assert text(page) == want


def test_matching_keeps_order_and_prefers_equal_texts():
    page = wrapper.parse("<div><p>x</p><p>same</p><p>y</p><ul><li>1</ul></div>")
    reference = wrapper._number(wrapper.parse("<div><p>same</p><p>z</p><ul><li>2</ul></div>"))
    pairs = wrapper.align(page, reference)
    runs = {r.text: pairs.get(id(r)) for r in wrapper._runs(page)}
    assert runs["same"].text == "same" and runs["y"].text == "z" and runs["1"].text == "2" and runs["x"] is None


@pytest.mark.parametrize("tag", ["div", "blockquote", "main"])
def test_deep_pages(tag):
    page = f"<{tag}>" * 5000 + "x"
    reference = wrapper._number(wrapper.parse(page))
    assert [(n >= 0, same, t) for n, same, t in wrapper.blocks(page, reference)] == [(True, True, "x")]


def site(n, extra=""):
    return [(i, f"https://h.example.com/{i}", f"<html><body><div class='x'><p>Story {i} tells of {i * 7} things at length.</p>"
             f"<p>Subscribe to our letters today!</p><p>More about {i * 3}.</p></div>{extra}</body></html>") for i in range(n)]


def extracted(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in wrapper.main_texts(df).collect()}


def test_constant_nodes_are_template(spark):
    got = extracted(spark, site(12))
    assert got == {i: f"Story {i} tells of {i * 7} things at length. More about {i * 3}." for i in range(12)}


def test_text_shared_by_few_articles_stays(spark):
    tail = "".join(f"<p>Tail {k}.</p>" for k in range(8)) + "<p>A sentence that six of thirty articles share.</p>"
    rows = [(i, f"https://h.example.com/{i}", f"<html><body><article><p>Story {i} tells of {i * 7} things at length, and more.</p>"
             f"{tail + '</article></body></html>' if i < 6 else '</article>'}") for i in range(30)]      # the reference is complete
    got = extracted(spark, rows)
    assert all(got[i].endswith("A sentence that six of thirty articles share.") and "Tail 7." in got[i] for i in range(6))


def test_all_runs_are_judged(spark):
    rows = [(i, f"https://h.example.com/{i}", f"<html><body><div><p>{'A long notice on every page. ' * 9}</p><p>Lead {i}.</p></div>"
             f"<article><p>Story {i} tells of {i * 7} things.</p></article><article><p>Part two of {i}.</p></article></body></html>")
            for i in range(12)]
    assert extracted(spark, rows) == {i: f"Lead {i}. Story {i} tells of {i * 7} things. Part two of {i}." for i in range(12)}


def paged(i, layout, filler=""):
    return (i, f"https://h.example.com/{i}", f"<html><body><div class='{layout}'><p>Story {i} tells of {i * 7} things at length.</p>"
            f"<p>Layout {layout} sends letters to all!</p><p>More about {i * 3}.{filler}</p></div></body></html>")


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_long_pages_and_further_layouts(spark, monkeypatch, limit):
    monkeypatch.setattr(wrapper, "BROADCAST_BYTES", limit, raising=False)
    filler = " word" * 14_000
    rows = [paged(i, "abc"[i % 3], filler) for i in range(30)] + [paged(30, "d")] * 9
    got = extracted(spark, rows)
    assert got == {i: f"Story {i} tells of {i * 7} things at length. More about {i * 3}.{filler}" for i in range(30)} | {
        30: "Story 30 tells of 210 things at length. Layout d sends letters to all! More about 90."}


def test_copies_of_one_article_are_no_template(spark):
    rows = [(i, "https://h.example.com/a", site(1)[0][2]) for i in range(40)]
    assert set(extracted(spark, rows).values()) == {"Story 0 tells of 0 things at length. Subscribe to our letters today! More about 0."}


def test_odd_pages(spark):
    rows = [(1, None, "<p>no url</p>"), (2, "not a url", None), (None, "https://a.b/", "<p>x</p>"), (3, "https://a.b/", ""),
            (3, "https://a.b/", "<p>" + "word " * 40_000 + "</p>"), (3, "https://a.b/", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as blocks", "3 as text")
    got = wrapper.main_texts(df).collect()
    assert sorted((str(r.page_id), r.text[:6]) for r in got) == [("1", "no url"), ("2", ""), ("3", ""), ("3", "word w"), ("3", "x"), ("None", "x")]
    assert wrapper.main_texts(df.filter("false")).collect() == []
