import random

import pytest
from llm_cases import clashing, frame

from stallwise.llm.html_text import text_of, visible_text

CASES = {
    "": "",
    "plain  text\n here": "plain text here",
    "a < b &amp; c &lt;i&gt;": "a < b & c <i>",
    "<p>one<p>two <b>bold</b>\n more": "one\n\ntwo bold more",
    "<div>a</div><div>b</div>c": "a\nb\nc",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<h1>T</h1>text": "T\n\ntext",
    "<ul><li>x<li>y<ol start=3><li>q<li value=9>r</ol><li>z</ul>tail": "- x\n- y\n  3. q\n  9. r\n- z\n\ntail",
    "<dl><dt>term<dd>meaning<dt>other<dd>too</dl>": "term\n  meaning\nother\n  too",
    "<table><tr><th>Name<th>Qty<tr><td>apples &amp; pears<td>3</table>after": "Name            Qty\napples & pears  3\n\nafter",
    "<table><tr><td colspan=2>wide heading<tr><td>a<td>b<tr><td>cc<td>d</table>": "wide heading\na   b\ncc  d",
    "<table><caption>C</caption><thead><tr><th>h</thead><tbody><tr><td><table><tr><td>in<td>ner</table></table>": "C\nh\nin ner",
    "<pre>a\n  b   c</pre>": "a\n  b   c",
    "<head><title>t</title><style>.x{color:red}</style></head><body>seen": "seen",
    "<title>t</title><p>seen": "seen",
    "<script>var t='</p>';</script>a<!-- no -->b<template>c</template><noscript>d</noscript>": "ab",
    "<div hidden>no</div><p style='display: none'>no</p><span style=visibility:hidden>no</span>yes": "yes",
    "<style>.ad, #top {display:none} p.q{visibility:hidden}</style><div class='big ad'>no</div><p id=top>no<p class=q>no<p>yes": "yes",
    "<select><option>1<option selected>2</select>": "2",
    "<input type=hidden value=no><input value=yes><textarea>a &amp; b</textarea>": "yesa & b",
    "<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>": "S\nT\nyes",
    "<b>never closed <i>both": "never closed both",
    "</div>stray</p>": "stray",
    "x<!-- runs to the end": "x",
    "<blockquote>q</blockquote>e": "  q\n\ne",
    "a&nbsp;b&#x41;&notin;": "a bA∉",
}


@pytest.mark.parametrize("page", list(CASES))
def test_layout(page):
    assert text_of(page) == CASES[page]


SCREEN = {
    "<style>@media print {.nav, p {display:none}}</style><p>yes": "yes",
    "<style>@media (max-width:600px) {.side {display:none}} .ad{display:none}</style><p class=side>yes<p class=ad>no": "yes",
    "<style>@media screen and (min-width: 60em) {.a{display:none}} @media (width <= 700px), print {.b{display:none}}</style><p class=a>no<p class=b>yes": "yes",
    "<style>@media not print {@media (400px <= width <= 9000px) {.a{display:none}}} @media not screen{.b{display:none}}</style><p class=a>no<p class=b>yes": "yes",
    "<style>@supports (display:grid){.a{display:none}} @keyframes p{p{visibility:hidden}}</style><p class=a>no<p>yes": "yes",
    "<style>.a{display:none} @media (min-width:800px){.a{display:block}}</style><p class=a>yes": "yes",
    "<style>.a{color:red; @media print{display:none}} .b{content:'}'; display:none} .c{.d{display:none}</style><p class=a>yes<p class=b>no<p class=d>yes": "yes\n\nyes",
    "<style media=print>p{display:none}</style><p>yes": "yes",
    "<style>@media (some-day: 1) {p{display:none}}</style><p>yes": "yes",
    "<p>a <svg><title/><desc>no</desc><defs><text>no</text></defs><path d='M 0'/><text x=1>b</text><text>c</text></svg> d": "a\nb\nc\nd",
    "x <math><semantics><mrow><mi>y</mi><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation></semantics></math> z": "x y=2 z",
    "<desc>yes</desc>": "yes",
}


@pytest.mark.parametrize("page", list(SCREEN))
def test_what_a_wide_screen_shows(page):
    assert text_of(page) == SCREEN[page]


QUOTES = {
    "<p>a</p><a title=don't>first</a> rest of page <p>end</p>": "a\n\nfirst rest of page\n\nend",
    "<a href=\"x\"\">one</a> two <b class='y''>three</b> \"four\"": "one two three \"four\"",
    "<p \"hidden\">yes</p \"><p title = 'a>b' hidden>no</p><p title=>yes</p>": "yes\n\nyes",
    "<p a'b=1 it's>yes<img alt=5\"><i style=\"display:none\">no</i> too": "yes too",
    "a<br/>b<p class=x/y/>c<p =x hidden>no": "a\nb\n\nc",
    "a<i title=\"runs to the end>": "a",
}


@pytest.mark.parametrize("page", list(QUOTES))
def test_quotes_open_only_values(page):
    assert text_of(page) == QUOTES[page]


def test_deep_and_long_pages():
    assert text_of("<div>" * 20_000 + "deep") == "deep"
    assert text_of("<table><tr><td>" * 60 + "x") == "x"
    assert text_of("<p>" + "word " * 100_000).count("word") == 100_000
    assert text_of("<ul><li>" * 300 + "x").strip("- \n") == "x"


def test_rows(spark):
    pages = frame(spark, [(1, "<p>a"), (1, "<p>a"), (2, None), (3, ""), (None, "<b>x")], "page_id long, html string")
    got = sorted(((r["page_id"], r["text"]) for r in visible_text(clashing(pages)).collect()), key=repr)
    assert got == sorted([(1, "a"), (1, "a"), (2, ""), (3, ""), (None, "x")], key=repr)
    assert visible_text(frame(spark, [], "page_id long, html string")).collect() == []


@pytest.mark.parametrize(
    "page, text",
    [
        ("<map><p>visible</p></map>", "visible"),
        ("<style>.ad{display:none}</style><p class=ad style=\"display:block\">a", "a"),
        ("<style>p{display:none} .show{display:block}</style><p class=show>a<p>b", "a"),
        ("<style>.show{display:block} p{display:none}</style><p class=show>a<p>b", "a"),
        ("<style>.a{display:block} .b{display:none}</style><p class='a b'>h<p class=a>a", "a"),
        ("<p style=\"display:none;display:block\">a", "a"),
        ("<div style=\"visibility:hidden\">x<span style=\"visibility:visible\">a</span>y</div>", "a"),
        ("<div hidden style=\"display:block\">a</div><p hidden>b", "a"),
        ("<style>div .x{display:none}</style><div><b><i class=x>h</i></b>a</div><i class=x>b</i>", "a\nb"),
        ("<style>div b .x{display:none}</style><div><u><i class=x>a</i></u><b><b><i class=x>h</i></b></b></div>", "a"),
        ("<style>div > b .x{display:none}</style><div><u><b><i class=x>a</i></b></u><b><u><i class=x>h</i></u></b></div>", "a"),
        ("<style>ul > li{display:none}</style><ul><li>h</ul><ol><li>a</ol>", "1. a"),
        ("<style>#a{display:none!important}</style><p id=a style=\"display:block\">h<p>b", "b"),
        ("<style>p:hover, p[x], p ~ p {display:none}</style><p>a<p x>b", "a\n\nb"),
        ("<style>* {visibility:hidden} b {visibility:visible}</style><p>h<b>a</b>", "a"),
        ("<table><tr><td>one<br>two<td>three<tr><td>4<td>5</table>", "one  three\ntwo\n4    5"),
        ("<table><tr><td rowspan=2>tall<td>a<tr><td>b<tr><td>c<td>d</table>", "tall  a\n      b\nc     d"),
        ("<table><tr><td>x<td rowspan=0>all<td>y<tr><td>z<td>w</table>", "x  all  y\nz       w"),
        ("<table><tr><td><ul><li>a<li>b</ul><td>c</table>", "- a  c\n- b"),
        ("<table><tr><td><p>first</p><p>second</p></table>", "first\n\nsecond"),
        ("<table><tr><td><pre>a  b\n c</pre><td>d</table>", "a  b  d\n c"),
    ],
)
def test_styles_and_cells(page, text):
    assert text_of(page) == text


def test_visible_words_against_a_plain_implementation():
    """Random trees: which words are shown, by recursion over display and visibility."""
    pick = random.Random(8)
    styles = "<style>.n{display:none} .b{display:block} .h{visibility:hidden} .v{visibility:visible} i.n{display:inline} div div .k{display:none}</style>"
    count = 0

    def make(depth, shown, sees, above):
        nonlocal count
        out, words = [], []
        for _ in range(pick.randrange(4)):
            if depth == 0 or pick.random() < 0.4:
                count += 1
                out.append(f" w{count} ")
                words += [f"w{count}"] if shown and sees else []
                continue
            tag, kinds = pick.choice(["div", "i", "section", "ul"]), pick.sample("nbhvk", pick.randrange(3))
            inline, display, visibility = "", None, None
            for kind, value in (("n", "none"), ("b", "block")):
                display = value if kind in kinds else display
            display = "inline" if tag == "i" and "n" in kinds else display
            for kind, value in (("h", "hidden"), ("v", "visible")):
                visibility = value if kind in kinds else visibility
            if "k" in kinds and above.count("div") >= 2:
                display = "none"
            if pick.random() < 0.3:
                name, value = pick.choice([("display", "none"), ("display", "block"), ("visibility", "hidden"), ("visibility", "visible"), ("visibility", "inherit")])
                inline = f' style="color:red; {name}: {value}"'
                display, visibility = (value, visibility) if name == "display" else (display, None if value == "inherit" else value)
            now = sees if visibility is None else visibility == "visible"
            inner, found = make(depth - 1, shown and display != "none", now, [*above, tag])
            out.append(f'<{tag} class="{" ".join(kinds)}"{inline}>{inner}</{tag}>')
            words += found
        return "".join(out), words

    for _ in range(300):
        page, words = make(5, True, True, [])
        assert text_of(styles + page).replace("- ", " ").split() == words, page
