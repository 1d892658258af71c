"""Main text of pages: rules, templates counted per host, odd markup."""

import re
import time

import pytest

from tidemark.llm.page_text import Page, page_text
from tidemark.llm.text_queries import op5_page_text


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b<br>c <b>d</p> e", "a\nb c d\ne"),
    ("<body><nav><ul><li>x</ul></nav><article><header><h1>T</h1></header><p>one\n two&nbsp;3</p></article><footer>f", "T\none two 3"),
    ('<script>var t="</p>";</script><style>p{}</style><p>x &lt;b&gt; y</p><!-- <p>z</p> -->', "x <b> y"),
    ('<div class="ad-box">buy</div><main><p>m</p><div id="comments"><p>c</p></div></main><p>out</p>', "m"),
    ('<article><p>a</p><aside>s</aside><div role="navigation">n</div><form>f</form><p>b</article>', "a\nb"),
    ('<p title="a > b">q</p><p>1 < 2 &am', "q\n1 < 2 &am"),
    ('<div hidden>h</div><span class="advert">s</span><p>t <i>u</i>', "t u"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b</table></article>", "1\n2\na\nb"),
    ("<article><p>cut off in the mid", "cut off in the mid"),
])
def test_rules(source, text):
    assert Page(source).main_text() == text


def test_templates_are_counted_per_host(spark):
    rows = []
    for i in range(40):
        shared = f"<div>About this site <p>all rights</p></div><div><p>Share it</p></div>"
        rows.append((i, f"https://One.example/{i}", f"<body>{shared}<div><p>story {i}</p><p>same line</p></div>"))
        rows.append((100 + i, f"https://two.example/{i}", f"<body><div>only here {i}</div><article><p>copied story</p></article>"))
    rows += [(900, None, rows[0][2]), (901, "::not a url::", rows[0][2]), (902, "https://one.example/x", None), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = [(r["page_id"], r["text"]) for r in page_text(pages).collect()]
    want = [(i, f"story {i}") if i < 100 else (i, "copied story") for i, _, _ in rows[:80]]
    want += [(i, "About this site\nall rights\nShare it\nstory 0\nsame line") for i in (900, 901)]
    want += [(902, ""), (0, "story 0")]
    assert sorted(got) == sorted(want)
    assert page_text(pages.limit(0)).count() == 0


def test_every_article_of_the_table(spark):
    import html
    sf = "/root/testdata/sf0.01"
    got = {r["page_id"]: r for r in op5_page_text(spark, sf).collect()}
    for page in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inside = re.split(r"</article>|<footer>", page["html"].split("<article>")[1])[0]
        blocks = [" ".join(html.unescape(re.sub(r"<b>|</b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        text = "\n".join(x for x in blocks if x)
        assert got[page["page_id"]]["text"] == text
        assert got[page["page_id"]]["n_chars"] == len(text)


@pytest.mark.parametrize("story", ["<article><div class=body><p>copied</p><p>story</p></div></article>",
                                   "<main><div><p>copied</p><p>story</p></div></main>",
                                   "<div><section><p>copied</p><p>story</p></section></div>"])
def test_copies_of_a_story_are_no_template(spark, story):
    rows = [(i, "https://a.example/x", f"<nav>n {i}</nav>{story}") for i in range(30)]
    rows += [(100 + i, "https://a.example/y", f"<div>imprint</div><div><p>other {i}</p></div>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in page_text(pages).collect()}
    assert got == {i: "copied\nstory" if i < 100 else f"other {i - 100}" for i, _, _ in rows}


@pytest.mark.parametrize("source, text", [
    ("<div class='content-sidebar-wrap'><article><p>the story</p></article><div class=sidebar><p>s</p></div></div>", "the story"),
    ("<div class='with-sidebar'><p>the story</p><p>goes on</p></div><p>end</p>", "the story\ngoes on\nend"),
    ("<div id='page-header-content'><main><p>the story</p></main></div>", "the story"),
    ("<article class='post social'><p>the <b>whole</b> story</p><div class=share>s</div></article>", "the whole story"),
    ("<article><p>story</p></article><div id=comments><article><p>a much longer comment</p></article></div>", "story"),
    ("<article><div class='widget-area article-widget'><p>the story</p></div><p>end</p></article>", "the story\nend"),
])
def test_named_noise_never_takes_the_article(source, text):
    assert Page(source).main_text() == text


@pytest.mark.parametrize("source, text", [
    ('<article><div style="overflow:hidden"><p>story</p></div></article>', "story"),
    ('<p><a href="/hidden-gems">the hidden gems</a> of <span data-src="a.hidden.b">town</span></p>', "the hidden gems of town"),
    ('<p title="the hidden cost">cost</p><p data-id="social-1">one</p><a href="/x?id=social">two</a>', "cost\none\ntwo"),
    ("<p title='class=\"ad\"'>kept</p><p data-role=navigation>too</p><p aria-hidden=false>three</p>", "kept\ntoo\nthree"),
    ('<p>a</p><svg class="i"/><p>b</p><svg><text>x</text></svg><p>c</p>', "a\nb\nc"),
    ("<p>a</p><svg><p>never closed</p>", "a\nnever closed"),
    ("<p>a</p><template-x>b</template-x><svg-icon>c</svg-icon><p>d</p><template>e</template>", "a\nbc\nd"),
    ("<p>a</p><template-x><p>b</p></template-x>", "a\nb"),
    ("<main><p>a long story about many things</p><article><p>teaser</p></article><p>and its end</p></main>",
     "a long story about many things\nteaser\nand its end"),
    ("<body><p>a long story about many things without main</p><article><p>teaser</p></article>",
     "a long story about many things without main\nteaser"),
    ("<article><p>one</p><p class='share-price'>price 5</p><div class='social-history'>past</div><div class='share-buttons'>s</div></article>",
     "one\nprice 5\npast"),
    ("<article><p>story told</p><section class='comments-area'><p>first!</p></section><div id=ad-slot-3>buy</div></article>", "story told"),
    ("<div hidden=''>h</div><div HIDDEN>i</div><div Class=ADVERT>j</div><p>k</p>", "k"),
    ("<blockquote><p>a<blockquote><p>b</blockquote>c</blockquote>d", "a\nb\nc\nd"),
    ("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "a\nb\nc\nd"),
])
def test_nothing_of_the_text_is_lost(source, text):
    assert Page(source).main_text() == text


@pytest.mark.parametrize("source", [
    "<div>" * 100_000 + "<p>deep</p>", "<div><p>" * 50_000 + "deep", "<blockquote>" * 100_000 + "deep", "<span class=ad>" * 50_000 + "x</i>" * 50_000,
    "<div class=ad>" * 50_000 + "deep", "<li>" * 100_000 + "deep", "</b>" * 100_000 + "deep", "<article>" * 50_000 + "deep", "<p " * 100_000 + "deep",
    "<b>" * 100_000 + "<p>deep" * 1000, "<p>" + "word " * 500_000, "<main>" * 30_000 + "<i hidden>" * 30_000])
def test_deep_and_long_pages_take_linear_time(source):
    begun = time.process_time()
    page = Page(source)
    page.rests()
    assert "deep" not in source or "deep" in page.main_text() or "<p " in source or "class=ad" in source
    assert time.process_time() - begun < 3


def test_template_of_a_small_host_and_of_a_small_share(spark):
    story = lambda k: f"<div><p>story number {k}</p><p>told {k} times</p></div>"
    rows = [(k, "https://small.example/", f"<div>our notice</div>{story(k)}") for k in range(3)]
    rows += [(10 + k, "https://two.example/", f"<div>our notice</div>{story(k)}") for k in range(2)]
    rows += [(1000 + k, "https://large.example/", (f"<div>sale today</div>" if k % 100 == 0 else "") + story(k)) for k in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in page_text(pages).collect()}
    number = {i: i % 1000 % 10 if i < 1000 else i - 1000 for i, _, _ in rows}
    want = {i: f"story number {k}\ntold {k} times" for i, k in number.items()}
    for i in (10, 11):  # two pages are no evidence
        want[i] = "our notice\n" + want[i]
    assert got == want
    asked = {r["page_id"]: r["text"] for r in page_text(pages, min_share=0.3).collect()}
    assert asked[1000].startswith("sale today") and asked[0] == want[0]
