import time
import tracemalloc

import pytest

from wavelake.llm import html_extract as h

SCHEMA = "page_id bigint, url string, html string, path string, salt int, host string, n_chars string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)


def blog(title, paras, tail=""):
    return (f"<html><head><title>no</title><style>p{{}}</style></head><body><header class='site'><h1>Site</h1></header>"
            f"<nav><ul><li><a href=/>menu</a></ul></nav><div id=wrap><div class='post-{len(paras)} entry'><header><h1>"
            f"{title}</h1><span>by me</span></header>" + "".join(f"<p>{p}" for p in paras)
            + "<div class='share'>share</div><aside>side</aside><form><p>form</p></form><div id=comments><p>"
            + "reader comment " * 60 + "</p></div></div><div class=sidebar><p>" + "links " * 90 + "</p></div></div>"
            f"<div class='cookie-notice'>cookies</div><footer><p>foot</footer><script>var a='<p>x</p>';</script>{tail}")


def test_main_text_without_what_surrounds_it(spark):
    html = blog("A &amp; B", ["One <b>two</b>\n  three&nbsp;four", "Five <a href=x>six</a>", "Sev&eacute;n<br>eight"])
    (row,) = h.extract_pages(pages(spark, [(1, "http://x.example/1", html)])).collect()
    assert row.text == "A & B\n\nOne two three four\n\nFive six\n\nSevén eight" and row.n_chars == len(row.text)


def test_the_host_outvotes_a_page_of_its_own(spark):
    same = [(i, f"https://m.example:80/{i}", blog("T", ["word " * 60, "more " * 50])) for i in range(4)]
    # here another container is longer, but the host's pages agree on the post
    odd = "<body><div class=extra><p>" + "teaser " * 300 + "</div><div id=wrap><div class='post-9 entry'><p>short</div></div>"
    rows = [*same, (9, "http://M.example/9", odd), (10, "http://alone.example/", odd)]
    got = {r.page_id: r.text for r in h.extract_pages(pages(spark, rows)).collect()}
    assert got[9] == "short" and got[10].startswith("teaser")
    (best,) = h.host_paths(pages(spark, same)).collect()
    assert best.path == "body>div>div.entry.post-0" and best.votes == 4_000_000


def test_article_with_broken_markup():
    html = ("<body><nav>menu</nav><!-- <p>ad</p> --><div class='ad'>ad</div><article><h1>Head</h1><p><b>Bold<br><p>Text"
            "<ul><li>one<li>two</ul></p><table><tr><td>x<td>y</table><p>1 < 2 &copy;</article><footer>f")
    page = h.parse(html)
    assert h.extract(page, "body>article") == ["Head", "Bold", "Text", "one", "two", "x", "y", "1 < 2 ©"]


def test_what_stands_beside_does_not_name_the_element():
    page = h.parse("<div class='layout-sidebar has-comments'><div class=text><p>main</div><div class='sidebar x'><p>no")
    assert h.extract(page, "body>div.has-comments.layout-sidebar>div.text") == ["main"]
    assert h.extract(page, None) == ["main"]


def test_plain_and_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no url", "just text"), (4, "http://e.example/", "<p>" + "long " * 50_000),
            (None, "http://e.example/", "<p>one"), (5, "http://e.example/", "<p>same"), (5, "http://e.example/", "<p>same"),
            (6, "http://n.example/", "<nav>only menu</nav>"), (7, "x", "<"), (8, "x", "<a href='unclosed"),
            (9, "x", "<script>never ends <p>x"), (10, "x", "<p>a</p" + "<div>" * 3000)]
    got = h.extract_pages(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert text[1] == text[2] == text[6] == text[9] == "" and text[5] == "same" and text[None] == "one"
    assert text[3] == "just text" and len(text[4]) == 5 * 50_000 - 1
    assert h.extract_pages(pages(spark, [])).collect() == []


LONG = "<h1>Head</h1><p>" + "word " * 60 + "</p><p>end"
WANT = ["Head", ("word " * 60).strip(), "end"]


def test_a_wrapper_is_not_skipped_for_a_word_or_form():
    beside = "<nav>menu</nav><div class=sidebar><p>side text</div><div id=comments><p>" + "reader " * 30 + "</div>"
    for wrapper in ("form id=aspnetForm", "div class='widget Blog'", "div class=two-col-sidebar",
                    "div class='elementor-widget elementor-widget-theme-post-content'", "div id=search-results-page",
                    "div class=post-discussion"):
        for inner in ("div class=text", "article", "main"):
            tags = wrapper.split()[0], inner.split()[0]
            page = h.parse(f"<{wrapper}><{inner}>{LONG}</{tags[1]}></{tags[0]}>{beside}")
            assert h.extract(page, None) == WANT, (wrapper, inner)
            if wrapper.startswith("form"):  # what surrounds the text may be inside as well
                assert h.extract(h.parse(f"<{wrapper}>{beside}<{inner}>{LONG}</{tags[1]}></form>"), None) == WANT
    # a theme that calls each part so
    parts = "".join(f"<div class=elementor-widget><p>{'part ' * 20}{i}</div>" for i in range(5))
    assert len(h.extract(h.parse(f"<div class=page>{parts}</div>"), None)) == 5
    # an article in a skipped element with less text than the rest of the page
    short = "<div class=widget><article><p>" + "own " * 20 + "</article></div><div id=comments>" + "reader " * 90 + "</div>"
    assert h.extract(h.parse(short), None) == [("own " * 20).strip()]


def test_what_is_skipped_stays_out_beside_an_article():
    for beside in ("<div class=sidebar>", "<div class='cookie-consent'>", "<form>", "<div id=comments>", "<aside>",
                   "<ol class=commentlist><li class=comment><article class=comment-body>"):
        for inner in ("div class=post", "article"):
            page = h.parse(f"{beside}<p>{'other ' * 200}</p></article></div></form></ol></aside><{inner}><h1>T</h1><p>x y</p>")
            assert h.extract(page, None) == ["T", "x y"], (beside, inner)


def test_the_winning_path_resets_what_stands_above(spark):
    html = "<div class=two-col-sidebar><div class=entry>{}</div></div><div class=extra><p>{}</div>"
    rows = [(i, "http://w.example/", html.format(f"<p>{'long ' * 80}", "few")) for i in range(3)]
    rows.append((9, "http://w.example/", html.format("<p>short text", "other " * 50)))
    got = {r.page_id: r.text for r in h.extract_pages(pages(spark, rows)).collect()}
    assert got[9] == "short text" and got[0] == ("long " * 80).strip()


POST = ("<nav>menu</nav><div id=page><div class=post><h1><a href=/>Title {0}</a></h1><div class=entry><p>{1}</p><p>{1}"
        "</div>{2}<div class=tags><a href=/a>one tag</a> <a href=/b>other tag</a></div><div class=share>share</div></div>"
        "<div class=sidebar><p>side</div></div><div class=extra><p>other text</div>")


def test_heading_and_text_beside_the_longest_part(spark):
    body, more = ("long " * 40).strip(), "<div class=more><p>short end</div>"
    want = [body, body]
    page = h.parse(POST.format(1, body, more))
    assert h.extract(page, None) == ["Title 1", *want, "short end"]
    # by the host's vote, also on pages without the last part or with a longer one
    ends = {1: more, 2: more, 3: "", 4: "<div class=more><p>" + "much " * 200 + "</div>"}
    rows = [(i, "http://p.example/", POST.format(i, body, e)) for i, e in ends.items()]
    got = {r.page_id: r.text.split("\n\n") for r in h.extract_pages(pages(spark, rows)).collect()}
    assert got[1] == ["Title 1", *want, "short end"] and got[3] == ["Title 3", *want]
    assert got[4] == ["Title 4", *want, ("much " * 200).strip()]
    (best,) = h.host_paths(pages(spark, rows[:3])).collect()
    assert best.path == "body>div>div.post>div.entry" and best.wide == "body>div>div.post"
    # the heading inside, beside, in a header, further out
    for html in ("<div class=post><div class=entry><h1>T</h1><p>{0}</div>{1}</div>",
                 "<h1>T</h1><div class=entry><p>{0}</div>{1}",
                 "<div class=post><header><h1>T</h1><p>by me</header><div class=entry><p>{0}</div>{1}</div>",
                 "<div class=post><h2>T</h2><div><div class=entry><p>{0}</div></div>{1}</div>",
                 "<div class=post><div><h1>T</h1><div class=entry><p>{0}</div></div>{1}</div>"):
        page = h.parse("<header><h1>Site</h1></header>" + html.format(body, more) + "<footer>foot</footer>")
        assert h.extract(page, None) == ["T", body, "short end"], html
    # nothing is added from the frame of the page
    frame = h.parse(f"<div id=page><h1 class=banner>Site</h1><nav>m</nav><div class=post><h2>T</h2><p>{body}</div>{more}</div>")
    assert h.extract(frame, None) == ["T", body]


@pytest.mark.parametrize(("html", "want"), [
    ("<p>Hello <script>var a='<p>';</script>world", ["Hello world"]),
    ("<p>one <button>press <b>me</b></button>two <svg><path d=x /><text>pic</text></svg>three <input name=x>four",
     ["one two three four"]),
    ("<p>a <label>Name</label>b <video><p>no video</video>c", ["a b c"]),
    ("<p>x <span class='advert'>buy <span>now</span> it</span> y", ["x y"]),
    ("<p>x <span class='no-ads lead'>kept</span> y", ["x kept y"]),
    ("<p>a <span class=ad>ad<p>b", ["a", "b"]),  # never closed
    ("<p>cut <button>open</p><p>next", ["cut", "next"]),
    ("<div><p>cut <svg><text>open</div><p>next", ["cut", "next"]),
])
def test_what_stands_in_a_line_does_not_end_the_block(html, want):
    assert h.extract(h.parse(f"<article>{html}</article>"), None) == want


def test_a_title_before_the_article_is_kept():
    body = ("long " * 40).strip()
    page = h.parse(f"<nav>m</nav><div><h1>Title</h1><p class=lede>Lede</p><article><p>{body}</article></div><footer>f")
    assert h.extract(page, None) == ["Title", "Lede", body]
    for html in (f"<div><nav>m</nav><h1>Site</h1><article><p>{body}</article></div>",  # a frame of the page
                 f"<div><h1>News</h1><article><p>{body}</article><article><p>x</article></div>",
                 f"<div><h1>Site</h1><article><h2>Title</h2><p>{body}</article></div>"):
        assert "Site" not in h.extract(h.parse(html), None) and "News" not in h.extract(h.parse(html), None)


def test_long_paths_are_named_by_digests(spark):
    page = h.parse("<div class=a>" * 300 + "<p>deep text</div><p>beside")
    assert max(len(n.path) for n in page.nodes) <= h.LONG_PATH
    assert len({n.path for n in page.nodes if n.tag == "div"}) == 300
    # a host's vote reaches the pages through such a path
    deep = "<div class=a>" * 300
    rows = [(i, "http://d.example/", f"{deep}<p>{'long ' * 50}{'</div>' * 300}<div class=b><p>few") for i in range(3)]
    rows.append((9, "http://d.example/", f"{deep}<p>short{'</div>' * 300}<div class=b><p>{'other ' * 50}"))
    got = {r.page_id: r.text for r in h.extract_pages(pages(spark, rows)).collect()}
    assert got[9] == "short" and got[0] == ("long " * 50).strip()


@pytest.mark.parametrize("html", ["<div>" * 200_000 + "text", "<div>x " * 50_000, "<div><h2>t</h2><p>x</div>" * 20_000,
                                  "<ul>" + "<div>" * 30_000 + "<li>x" * 10_000, "<div>" * 30_000 + "</p>" * 60_000,
                                  "<div class='widget a'>x " * 20_000, "<div class=widget>" * 9000 + "<article>x</article>" * 9000])
def test_time_and_memory_grow_with_the_page(html):
    began = time.monotonic()
    page = h.parse(html)
    votes = h.wide_votes(page)
    blocks = h.extract(page, *max(votes, key=votes.get, default=(None, None)))
    assert time.monotonic() - began < 20 and len(blocks) <= len(page.blocks)  # a quadratic step takes minutes


def test_memory_of_a_megabyte_of_nested_elements():
    tracemalloc.start()
    h.parse("<div>" * 200_000 + "text")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
