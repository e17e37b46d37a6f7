import random
import time

import pytest

from tillmark.llm import html_text
from tillmark.llm.html_text import main_text

SCHEMA = "page_id long, url string, html string, text string, n_chars string, row int"

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script>
</head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav><!-- note --><div class="ad">Buy, buy,
buy.</div><article><h1>Title &amp; more</h1><p><b>First, of all.<br><p>Second
  para&nbsp;graph.</p></article><footer>&copy; 2020</footer>"""

SOUP = """<div id="topNav"><a href=x>Home</a> <a>About</a></div>
<div class="cookie-banner">We use cookies, accept them, please, now.</div>
<div class="wrap"><div class="post-body"><h2>The title</h2>
<p>One, two, three and more text that is long enough to look like prose.
<p>Another <a href=z>link</a>ed text, with things<br>and a break.
<div class="ad-slot">Cheap, good, now!</div><ul><li>item one<li>item two</ul>
<table><tr><td>cell<td>cell two</table><blockquote>A quote</blockquote>
in <span class="share">Share this</span> the middle</div>
<div class="sidebar"><p>Other, pages, a, b, c, d, e, f, g, h, i, j, k, l, m</p></div>
<div id="comments"><p>I, too, think, so, and, so, on, and, on, really, yes, I, do</p></div>
<form><p>Name, address, telephone</p><input name=q></form></div><div role=contentinfo>(c)</div>"""


def test_article():
    assert main_text(ARTICLE) == "Title & more First, of all. Second para graph."


def test_containers_without_semantic_tags():
    assert main_text(SOUP) == (
        "The title One, two, three and more text that is long enough to look like prose. Another"
        " linked text, with things and a break. item one item two cell cell two A quote in"
        " the middle"
    )


def test_sections_of_main():
    page = ("<main><section><p>One, two.</p></section><section><p>Three, four, five.</p></section>"
            "<aside>no</aside></main><div>also, not, this, one</div>")
    assert main_text(page) == "One, two. Three, four, five."


def test_a_lone_article_or_main_beside_the_text_loses():
    body = "<p>Text, that, goes, on, for, a, while, indeed.</p>" * 5
    for tag in ("article", "main"):
        page = f"<body><{tag}><p>A teaser, for more.</p></{tag}><div id=post>{body}</div></body>"
        assert main_text(page) == " ".join(["Text, that, goes, on, for, a, while, indeed."] * 5)


def test_article_wins_over_a_little_more_text_beside_it():
    page = "<div><article><p>One, two, three.</p></article><div><p>A, b, c, d.</p></div></div>"
    assert main_text(page) == "One, two, three."


PROSE = "A sentence, with a comma or two, that goes on for quite a while before it ends. " * 11
AROUND = {
    "sidebar": "<div class=sidebar><p>Other, pages, of, this, site</p></div>",
    "menu": "<div id=mainMenu><p>Home, about, news</p></div>",
    "comments": "<div class='comment-list'><p>Yes, indeed, so, it, is</p></div>",
    "search": "<form action=/s><p>Search, all, of, it</p><input name=q><button>Go</button></form>",
}


@pytest.mark.parametrize("wrapper", [
    "<div class='layout has-sidebar'>{}</div>", "<div id=page class='site header-fixed'>{}</div>",
    "<div class='social-science'>{}</div>", "<div class='no-comments'>{}</div>",
    "<form id=aspnetForm><input type=hidden name=a><input type=hidden name=b>{}</form>",
    "<div class=header>{}</div>", "<div id=comments-open><section class=menu>{}</section></div>",
    "<body class='with-sidebar'><form class=search><input name=q>{}</form>",
])
@pytest.mark.parametrize("body", [
    "<article><h1>Title</h1><p>{}</p></article>", "<h1>Title</h1><p>{}</p>",
    "<div class=post><h1>Title</h1><div><p>{}</p></div></div>",
])
def test_no_page_is_lost_by_a_name(wrapper, body):
    text = f"Title {PROSE.strip()}"
    inner = body.format(PROSE)
    assert main_text(wrapper.format(inner)) == text
    for part in AROUND.values():
        if "<article>" not in body and "<div class=post>" not in body:
            continue  # without a container of its own there is nothing to tell them apart by
        assert main_text(wrapper.format(part + inner)) == text
        assert main_text(wrapper.format(inner + part)) == text


def test_long_comments_do_not_beat_a_short_article():
    comments = "<p>I, too, think, so, and, so, on, and, on, really, yes, I, do</p>" * 5
    page = f"<div class=post><p>{PROSE[:160]}</p></div><div id=comments>{comments}</div>"
    assert main_text(page) == PROSE[:160].strip()


@pytest.mark.parametrize("name,part", [
    ("sidebar", True), ("sidebar-left", True), ("siteNav", True), ("ad-slot", True), ("ad-300x250", True),
    ("cookie-banner", True), ("post-comments", True), ("comment-list", True), ("share_buttons", True),
    ("has-sidebar", False), ("no-comments", False), ("header-fixed", False), ("social-science", False),
    ("comments-open", False), ("badge", False), ("", False), ("related-work", False),
])
def test_names_of_parts(name, part):
    assert html_text._part(html_text._words(name)) is part


def test_forms_count_by_their_fields():
    form = "<form><p>Name, address, telephone</p>{}</form>"
    beside = f"<div><p>{PROSE}</p></div>"
    assert "Name" not in main_text(form.format("<input name=q>") + beside)
    assert main_text(form.format("<input name=q>")) == ""
    assert main_text(form.format("<input type='hidden'>")) == "Name, address, telephone"
    long = f"<form><p>{PROSE}</p><input name=q></form>"
    assert main_text(long) == PROSE.strip()
    assert main_text(long.replace("<input name=q>", "<input name=q>" * 20)) == ""


def page_of(draw, depth=0):
    """A random page of wanted and unwanted parts."""
    tags = ["div", "div", "section", "p", "span", "a", "ul", "article", "main", "nav", "form"]
    names = ["", "", "", " class=menu", " class='post has-menu'", " id=comments", " class=box"]
    parts = []
    for _ in range(draw.randint(1, 4)):
        if depth > 5 or draw.random() < 0.4:
            parts.append(" ".join(draw.choice(["word", "longer words", "a, b", "x"]) for _ in range(draw.randint(1, 30))))
        else:
            tag = draw.choice(tags)
            field = "<input name=q>" if draw.random() < 0.1 else ""
            parts.append(f"<{tag}{draw.choice(names)}>{field}{page_of(draw, depth + 1)}</{tag}>")
    return "".join(parts)


@pytest.mark.parametrize("seed", range(60))
def test_scores_equal_plain_recursion(seed):
    """Names, points, links and sums of every element by their definitions, one element at a time."""
    draw = random.Random(seed)
    page = page_of(draw)
    if seed % 2:
        page = page.replace("article", "div").replace("main", "div")
    root = html_text.parse(page)
    hard = {id(e) for e in every(root) if e.unwanted}

    def text(e):
        """Characters outside of links."""
        linked = any(a.tag == "a" for a in up(e, None))
        return sum(
            (0 if linked else len(c.strip())) if isinstance(c, str)
            else 0 if id(c) in hard else text(c) for c in e.children
        )

    def inside(e):
        return [c for c in every(e) if c is not e and not any(id(a) in hard for a in up(c, e))]

    page_text, gone, weight = text(root), set(hard), {}
    for e in every(root):
        semantic = any(c.tag in ("article", "main") and not c.named for c in inside(e))
        if id(e) in hard or any(id(a) in hard for a in up(e, None)) or semantic:
            continue
        fields = sum(c.field for c in every(e) if c is not e and not any(
            id(a) in hard for a in up(c.parent, e)))
        if e.named:
            if text(e) > page_text * (0.95 if e.named > 0.9 else 0.5):
                weight[id(e)] = 0.1
            else:
                gone.add(id(e))
        elif e.tag == "form" and fields and text(e) < fields * (200 if 2 * text(e) > page_text else 1000):
            gone.add(id(e))
    html_text.judge(root)
    assert {id(e) for e in every(root) if e.unwanted} == gone

    found = html_text.blocks(root)
    html_text.score(found)
    for e in every(root):
        score = whole = chars = linked = 0
        for b in found:
            near = b.holder.parent or b.holder if b.holder.tag in html_text.PARAGRAPHS else b.holder
            above = [near, *up(near, None)[1:]]
            if b.dropped or e not in above:
                continue
            points = 1 + b.text.count(",") + min(len(b.text) / 100, 3)
            for a in above:
                points *= weight.get(id(a), 1)
            articles = [a for a in above if a.tag == "article"] or [a for a in above if a.tag == "main"]
            level = above.index(e)
            less = 1 if level == 0 or articles and articles[-1] is e else 2 if level == 1 else 3 * level
            score += points / less
            whole += points * (1 - b.linked / len(b.text))
            chars += len(b.text)
            linked += b.linked
        assert (e.chars, e.linked) == (chars, linked)
        assert e.score == pytest.approx(score) and e.whole == pytest.approx(whole)


def every(element):
    return [element] + [x for c in element.children if not isinstance(c, str) for x in every(c)]


def up(element, top):
    """The element and its ancestors below `top`."""
    found = []
    while element is not None and element is not top:
        found.append(element)
        element = element.parent
    return found


PARTS = ["Text, that, goes, on.", "More.", "A, b, c, d, e, f, g, h, i, j, k, l, m, n, o.",
         "Words without any comma that go on for a while, or two.", "The end, of, it."]


def wrapped(parts, depth):
    return "".join("<div>" * depth + f"<p>{p}</p>" + "</div>" * depth for p in parts)


@pytest.mark.parametrize("depth", range(9))
@pytest.mark.parametrize("n", [2, 3, 5, 40])
@pytest.mark.parametrize("frame", [
    "{}", "<body>{}</body>", "<div id=content>{}</div>",
    "<body><div>Tag line</div><div><a href=x>Home</a></div><div><div>{}</div></div>"
    "<div>Made by hand</div></body>",
    "<article><p>A teaser.</p></article><div><section>{}</section></div>",
])
def test_wrapped_paragraphs_stay(depth, n, frame):
    parts = [f"{PARTS[i % len(PARTS)]} {i}" for i in range(n)]
    assert main_text(frame.format(wrapped(parts, depth))) == " ".join(parts)


def test_sections_of_unequal_weight_stay():
    heavy, light = PARTS[2], PARTS[0]
    sections = [[heavy, light, light], [light, light], [light, light, light]]
    page = "".join(f"<div><div>{wrapped(s, 2)}</div></div>" for s in sections)
    expected = " ".join(p for s in sections for p in s)
    assert main_text(f"<div><div>{page}</div></div><div>Made by hand</div>") == expected


def test_comments_as_articles_go():
    page = ("<article><p>Text, of the page.</p><article class=comment><p>Yes, yes, yes, yes</p>"
            "</article></article>")
    assert main_text(page) == "Text, of the page."


def test_link_lists_lose():
    links = "".join(f"<li><a href={i}>A link, with, many, commas {i}</a></li>" for i in range(30))
    page = f"<div><ul>{links}</ul></div><div><p>Prose, of some length, in a paragraph.</p></div>"
    assert main_text(page) == "Prose, of some length, in a paragraph."


def test_siblings_that_score_well_stay():
    part = "<div class=part><p>Text, that, goes, on, for, a, while, indeed.</p></div>"
    page = f"<body><div>{part * 2}<div><a href=x>only a link</a></div></div></body>"
    assert main_text(page) == " ".join(["Text, that, goes, on, for, a, while, indeed."] * 2)


@pytest.mark.parametrize("page,text", [
    ("", ""), ("   ", ""), ("just text", "just text"), ("<p>a < b &lt;x&gt; &am &amp</p>",
     "a < b <x> &am &"), ("<a b='", ""), ("<script>x</script>", ""), ("<p>one<p>two", "one two"),
    ("<article><p>ends in the mid", "ends in the mid"), ("</div></p>x", "x"),
    ("<p>x<![CDATA[y]]>z</p>", "xz"), ("<P CLASS='Ad'>no</P><P>yes</P>", "yes"),
    ("<p>in<b>li</b>ne</p>", "inline"), ("<p hidden>no</p><p>yes</p>", "yes"),
    ("<p style='display: none'>no</p><p>yes</p>", "yes"), ("<nav>only a menu</nav>", ""),
    ("<p>a\t\n b c</p>", "a b c"), ("<p>&#72;&#x69;&eacute;</p>", "Hié"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", [
    "<div>" * 50000 + "deep, text" + "</div>" * 50000, "<" * 300000, "<a " + "x='" * 100000,
    "<b>" * 100000 + "x" + "</i>" * 100000, "<b>" * 20000 + "x" + "</p><p>" * 20000,
    "<script>" * 100000, "<!--" * 100000, "<li>" * 50000, "word, " * 200000, "&" * 300000,
    "<span>" * 500 + "<p>x</p>" * 20000,
])
def test_time_is_linear(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 5


def test_long_text_is_whole():
    words = " ".join(f"w{i}," for i in range(100000))
    assert main_text(f"<article><p>{words}</p></article>") == words


def run(spark, rows):
    df = spark.createDataFrame([(i, u, h, "clash", "c", 1) for i, u, h in rows], SCHEMA)
    return html_text.report(df.repartition(2))


def test_report(spark):
    rows = [(1, "u", ARTICLE), (2, None, None), (None, "v", ""), (3, "w", SOUP), (3, "w", SOUP)]
    found = run(spark, rows)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(map(tuple, found.collect()), key=repr)
    expected = [(i, u, t := main_text(h or ""), len(t)) for i, u, h in rows]
    assert got == sorted(expected, key=repr)


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "u", "<p>x, y</p>", "clash", "c", 1)], SCHEMA)
    found = html_text.extract(df)
    assert sorted(found.columns) == ["n_chars", "page_id", "row", "text", "url"]
    assert found.first().text == "x, y"


def test_empty_table(spark):
    assert run(spark, []).collect() == []
