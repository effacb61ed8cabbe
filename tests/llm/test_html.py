"""Main text of pages."""

import html
import math
import random

import pytest
from prepkit.llm import html_text

HEAD = '<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>'
NAV = '<nav><ul><li><a href="/a?b=1&c=\'>x">Home</a><li><a href=/b>More</a></ul></nav>'
FOOT = "<footer>&copy; somebody <a href=x>terms</a></footer>"


def page(body, before=NAV, after=FOOT):
    return f"{HEAD}{before}{body}{after}</body></html>"


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<article><h1>One</h1><p>Two <b>three</b>\n four</p></article>", "One\nTwo three four"),
        ("<article><p><b>Open<br>line<p>Next &lt;p&gt; &#x41;&eacute;&amp&am</article>", "Open line\nNext <p> Aé&&am"),
        ("<article><h1>A</h1><p>B.</p><div class='ad'>buy</div><p>C</p><form><input>mail</form></article>", "A\nB.\nC"),
        ("<main><p>One text of some length here.</p><section id=comments><p>me too</p></section></main>",
         "One text of some length here."),
        ("<div class=content><p>One two three four.</p><p>Five six seven eight.</p></div><div class='cookie-notice'>We use"
         " cookies, many of them, and long sentences about them.</div>", "One two three four.\nFive six seven eight."),
        ("<article><ul><li>a<li>b <a href=z>link</a></ul><table><tr><td>1<td>2<tr><td>3</table></article>",
         "a\nb link\n1\n2\n3"),
        ("<article><p>3 < 4 and <unknown>5</unknown> > 2</p></article>", "3 < 4 and 5 > 2"),
        ("<article><pre>a\n  b</pre><!-- <p>no</p> --><p>c</p></article>", "a b\nc"),
        ("", ""),
        ("<article></article>", ""),
    ],
)
def test_article(body, want):
    assert html_text.main_text(page(body)) == want


LONG = "plain words of text " * 8
PARTS = "".join(f"<p>{LONG}{k}.</p>" for k in range(3))
WANT = "\n".join(f"{LONG}{k}." for k in range(3))


@pytest.mark.parametrize(
    "name", ["layout has-sidebar", "no-sidebar", "content with-comments", "page-with-ads", "modal-open", "sidebar", "widget-area"]
)
def test_names_of_wrappers_do_not_cut_the_text(name):
    assert html_text.main_text(page(f"<div class='{name}'><article>{PARTS}</article></div>")) == WANT
    assert html_text.main_text(page(f"<div id='{name}'><div>{PARTS}</div></div>")) == WANT


def test_forms_around_the_text_stay():
    assert html_text.main_text(page(f"<form id=aspnet><input type=hidden><div>{PARTS}</div></form>")) == WANT
    assert html_text.main_text(page(f"<form><main>{PARTS}</main><input></form>")) == WANT
    assert html_text.main_text(page(f"<main>{PARTS}<form><input>mail</form></main>")) == WANT
    assert html_text.main_text(page(f"<main><form><p>One.</p></form>{PARTS}</main>")) == "One.\n" + WANT


def test_titles_of_articles_stay():
    for head in ("<header><h1>T</h1></header>", "<div class=entry-header><h2>T</h2></div>", "<header class=header><p>T</p></header>"):
        assert html_text.main_text(page(f"<article>{head}{PARTS}</article>")) == "T\n" + WANT


@pytest.mark.parametrize("name", ["ad", "related-posts", "side-bar", "cookie_banner", "nav__links", "site-header", "widget-12"])
def test_named_parts_go(name):
    more = f"<div class='x {name}'>Some more text here</div>"
    assert html_text.main_text(page(f"{more}<div>{PARTS}</div>{more}")) == WANT
    assert html_text.main_text(page(f"{more}<article><p>One.</p></article>{more}")) == "One."


def test_text_spread_over_siblings_is_whole():
    a, b = (("".join(f"<p>{c * 100}</p>" for _ in range(n)), "\n".join([c * 100] * n)) for c, n in (("a", 5), ("b", 3)))
    (a, x), (b, y) = a, b
    whole = f"{x}\n{y}"
    links = "<ul>" + "".join(f"<li><a href=/{k}>Link {k}</a></li>" for k in range(9)) + "</ul>"
    for one, two in (("section", "section"), ("div", "div"), ("article", "article"), ("article", "section")):
        parts = f"<{one}>{a}</{one}><{two}>{b}</{two}>"
        for body in (parts, f"<div id=content>{parts}</div>", f"{links}<div id=content>{parts}</div>{links}", f"<main>{parts}</main>"):
            assert html_text.main_text(page(body)) == whole, body
    assert html_text.main_text(page(f"<div>{links}<div>{a}</div></div><h2>B</h2><div><div>{b}</div></div>")) == f"{x}\nB\n{y}"
    assert html_text.main_text(page(f"<main><article>{a}</article><article><p>short</p></article></main>")) == f"{x}\nshort"
    assert html_text.main_text(page(f"<main>{a}</main><main>{b}</main>")) == whole


def test_unmarked_link_lists_lose_to_text():
    links = "<div>" + "".join(f"<a href=/{k}>Some link text {k}</a> " for k in range(30)) + "</div>"
    text = "<div><div>" + "".join(f"<p>{'plain words of text ' * 8}{k}.</p>" for k in range(5)) + "</div></div>"
    found = html_text.main_text(page(links + text + links, "", ""))
    assert found.split("\n") == [f"{'plain words of text ' * 8}{k}." for k in range(5)]


@pytest.mark.parametrize("cut", range(0, 700, 7))
def test_cut_pages_do_not_fail(cut):
    whole = page("<article><h1>One &amp; two</h1><p class='x y' data-a=\"b>c\">Three</p><!-- x --><p>Four</article>")
    assert isinstance(html_text.main_text(whole[:cut]), str)


def test_deep_and_long_pages():
    deep = "<div>" * 20000 + "<p>down here</p>"
    assert html_text.main_text(HEAD + deep) == "down here"
    rng = random.Random(1)
    blocks = [" ".join(f"w{rng.randrange(999)}" for _ in range(rng.randint(1, 60))) + " <&>" for _ in range(2000)]
    body = "<article>" + "".join(f"<p>{html.escape(b)}</p>" for b in blocks) + "</article>"
    assert html_text.main_text(page(body)) == "\n".join(blocks)


def test_densities_follow_links():
    root, nodes = html_text.parse("<body><p>aaaa bbbb cccc</p><p><a>aaaa</a><a>bbbb</a>cccc</p></body>")
    html_text.measure(root, nodes)
    plain, linked = (n for n in nodes if n.tag == "p")
    assert plain.chars == linked.chars == 12 and linked.linked == 8 and linked.links == 2
    assert plain.density > linked.density


def test_whole_table(spark):
    rows = [(1, "u", page("<article><p>a</p></article>"), "x"), (1, None, None, "x"), (None, "v", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_text.extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", "a"), (1, None, ""), (None, "v", "")], key=repr)
    assert html_text.extract(df.where("false")).count() == 0


LONG = " ".join(f"word{k}" for k in range(60))


def framed(body):
    return f"<html><body><div><h1>Title</h1><p>{LONG} one.</p>{body}<p>{LONG} three.</p></div></body></html>"


def test_a_quote_in_an_unquoted_value_is_a_part_of_it():
    got = html_text.main_text(framed("<p>See <a href=/it's>this link</a> and go on.</p><p>It's the next one.</p>"))
    assert "this link and go on." in got and "It's the next one." in got and "three." in got


@pytest.mark.parametrize("comment", ["<!-->", "<!--->", "<!-- a --!>", "<!-- a -- b -->", "<!---->"])
def test_comments_end_as_in_browsers(comment):
    got = html_text.main_text(framed(f"{comment}<p>Two is here.</p><!-- end --><p>Two and a half.</p>"))
    assert got == html_text.main_text(framed("<p>Two is here.</p><p>Two and a half.</p>"))


def test_a_slash_does_not_close_a_script():
    got = html_text.main_text(framed("<script src=a.js/>var hidden = 1;</script><style/>p{}</style><p>Two.</p>"))
    assert got == html_text.main_text(framed("<p>Two.</p>")) and "hidden" not in got


def test_unquoted_values_attributes_and_cut_off_tags():
    assert html_text.main_text("<p class=a>b>c</p>") == "b>c"
    assert html_text.main_text("<p title='a>b' data-x = \"c>d\" =e>f</p>") == "f"
    assert html_text.main_text(framed("") + "<p class=\"never closed") == html_text.main_text(framed(""))


COMMENTS = [
    f'<div class="post-comments"><p>{LONG} first reader. {LONG}</p><p>{LONG} {LONG} second reader.</p></div>',
    f'<div id="disqus_thread"><div class="c"><p>{LONG} first reader.</p></div></div>',
    f'<div><div class="user-comment"><p>{LONG} first reader.</p></div><div class="user-comment"><p>{LONG} reader.</p></div></div>',
    f'<article class="comment"><p>{LONG} first reader.</p></article><article class="comment"><p>{LONG} reader.</p></article>',
    f'<section class="comments comment-list"><article class="comment"><h4>Ann</h4><p>{LONG} reader.</p></article></section>',
]


@pytest.mark.parametrize("comments", COMMENTS)
@pytest.mark.parametrize("frame", ["div", "article", "main"])
def test_comments_go_and_the_article_stays(comments, frame):
    got = html_text.main_text(f"<body><{frame}><h1>Title</h1><p>{LONG} one.</p><p>{LONG} two.</p></{frame}>{comments}</body>")
    assert "one." in got and "two." in got and "reader" not in got


@pytest.mark.parametrize("name", ["content with-comments", "comments-open", "no-comments", "has-comments post"])
def test_wrappers_that_merely_mention_comments_stay(name):
    got = html_text.main_text(f'<body><div class="{name}"><p>{LONG} one.</p><p>{LONG} two.</p></div></body>')
    assert "one." in got and "two." in got


def test_a_page_of_comments_only_keeps_them():
    assert "reader" in html_text.main_text(f'<body><div class="comments"><p>{LONG} reader.</p><p>{LONG} more.</p></div></body>')


def random_tree(rng, depth=0):
    """Markup of random nested elements with texts and links, and many equal parts."""
    tag = rng.choice(("div", "section", "span", "p" if depth else "div"))
    inner = []
    for _ in range(rng.randrange(1, 5)):
        kind = rng.random()
        if kind < 0.35 and depth < 5:
            inner.append(random_tree(rng, depth + 1))
        elif kind < 0.5:
            inner.append(f"<a href=x>{'l' * rng.choice((3, 10))}</a>")
        else:
            inner.append(rng.choice(("t" * 20, "t" * 20, "u" * rng.randrange(1, 90))))
    return f"<{tag}>{''.join(inner)}</{tag}>"


def test_densities_and_the_largest_sum_beside_a_plain_computation():
    """Every node's density from its own subtree, sums of children, and the argmax with its ties."""
    rng = random.Random(12)
    for _ in range(150):
        root, nodes = html_text.parse(f"<body>{random_tree(rng)}{random_tree(rng)}</body>")

        def below(node):
            """All elements under a node, and all characters without blanks, in links and in all."""
            tags = links = chars = linked = 0
            for x in node.parts:
                if isinstance(x, str):
                    chars += len("".join(x.split()))
                else:
                    t, k, c, w = below(x)
                    tags, links, chars, linked = tags + t + 1, links + k, chars + c, linked + w
            return (tags, links + 1, chars, chars) if node.tag == "a" else (tags, links, chars, linked)

        body = next(n for n in nodes if n.tag == "body")
        share = below(body)[3] / max(below(body)[2], 1)

        def density(node):
            tags, links, chars, linked = below(node)
            if not chars:
                return 0.0
            plain, t = max(chars - linked, 1), max(tags, 1)
            if not linked:
                return chars / t
            base = math.log(max(math.log(chars / plain * linked + share * chars + math.e), math.e))
            return max(chars / t * math.log(max(chars / linked * t / max(links, 1), 1.0)) / base, 0.0)

        want = {n: density(n) for n in nodes}
        sums = {n: sum(want[x] for x in n.parts if not isinstance(x, str)) for n in nodes}
        html_text.measure(root, nodes)
        for n in nodes:
            assert math.isclose(n.density, want[n], abs_tol=1e-9) and math.isclose(n.sum, sums[n], abs_tol=1e-9)
        inside = [n for n in nodes if n.order >= body.order and below(n)[2]]
        if inside:
            depth = {n: 0 for n in nodes}
            for n in nodes[1:]:
                depth[n] = depth[n.parent] + 1
            top = max(inside, key=lambda n: (n.sum, depth[n], -n.order))
            assert html_text.best_node(inside) is top
