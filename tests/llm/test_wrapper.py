from __future__ import annotations

import random
import re
from html import unescape

from freshet.llm import wrapper
from freshet.llm.queries import op6_html_extraction
from tests.llm.conftest import DATA

PAGES = "page_id long, url string, html string, host string, texts string, slots int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "old", "old", 1) for r in rows], PAGES)


def text_of(html):
    root = wrapper.parse(html)
    return "\n".join(t for t, _ in wrapper.blocks(root, {}))


def test_query_against_the_marked_articles(spark):
    rows = {r["page_id"]: r for r in op6_html_extraction(spark, DATA).collect()}
    for p in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", p["html"], re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(x for x in parts if x)
        assert rows[p["page_id"]]["text"] == want and rows[p["page_id"]]["n_chars"] == len(want)
        assert rows[p["page_id"]]["url"] == p["url"]


def test_regions_that_are_no_article():
    html = """<html><head><title>T</title></head><body><header>Site</header><nav><a>Home</a></nav>
    <div class="cookie-notice">We use cookies</div><main><article><h1>A &amp; B</h1><p>One<br>two <i>three</i>.
    <p>Four&nbsp;&lt;5&gt;<ul><li>x<li>y</ul><form>mail <input></form><script>var p = "<p>no</p>";</script><aside>See also</aside>
    </article><section id="comments"><p>Nice!</p></section></main><div class=sidebar>s</div><footer>F</footer>"""
    assert text_of(html) == "A & B\nOne two three.\nFour <5>\nx\ny"
    assert text_of("<div hidden>a</div><p style='display: none'>b</p>c <b>d<p>e") == "c d\ne"
    assert text_of("plain &eacute; <3 text") == "plain é <3 text"
    assert text_of("<p>cut <a href='x") == "cut"


def test_a_template_is_found_without_marks(spark):
    def page(k):
        items = "".join(f"<p>Words {k} {j}</p>" for j in range(k % 3 + 1))
        return f"<body><div class=top>Welcome to our site</div><div class=text><h2>Title {k}</h2>{items}</div><div class=end>All rights reserved</div></body>"

    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(8)]
    rows += [(100, "http://few.example/1", page(1)), (101, "http://few.example/2", page(2))]
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(pages(spark, rows)).collect()}
    for k in range(8):
        assert got[k] == "\n".join([f"Title {k}", *(f"Words {k} {j}" for j in range(k % 3 + 1))])
    assert got[100].startswith("Welcome")  # two pages show no template


def test_copies_do_not_make_an_article_constant(spark):
    html = "<article><h1>Same</h1><p>Everywhere the same words</p></article>"
    rows = [(k, "http://h.example/x", html) for k in range(30)]
    assert {r["text"] for r in wrapper.main_text(pages(spark, rows)).collect()} == {"Same\nEverywhere the same words"}


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [
        (1, None, None), (2, "not a url", ""), (3, "http://a.example/", "<p>x"), (3, "http://a.example/", "<p>x"), (None, "http://A.example", "<p>y</p>"),
        (4, "http://b.example", deep), (5, "http://c.example", "<p>" + "long " * 50000 + "</p>" * 3), (6, "http://b.example", "<"),
        (7, "http://d.example", "".join(f"<h2>t{i}</h2><p>{i}</p>" for i in range(600))),
        (8, "http://d.example", "".join(f"<h2>u{i}</h2><p>{i}</p>" for i in range(600))),
    ]
    out = wrapper.main_text(pages(spark, rows)).collect()
    got = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    assert got[1] == got[2] == "" and got[3] == "x" and got[None] == "y" and got[4] == "deep" and got[6] == "<"
    assert got[5] == ("long " * 50000).strip() and got[8].count("\n") == 1199
    assert wrapper.main_text(pages(spark, [])).count() == 0


def test_many_hosts_join_instead_of_broadcast(spark, monkeypatch):
    rows = [(k, f"http://h{k % 3}.example/", f"<article><p>a {k}</p></article>") for k in range(30)]
    want = sorted(map(tuple, wrapper.main_text(pages(spark, rows)).collect()))
    monkeypatch.setattr(wrapper, "BROADCAST_CHARS", -1)
    assert sorted(map(tuple, wrapper.main_text(pages(spark, rows)).collect())) == want


def brute_match(a, b):
    """Simple tree matching on the lists of children, without runs."""
    if a.symbol != b.symbol:
        return 0
    x, y = ([c for c in n.items if isinstance(c, wrapper.Node)] for n in (a, b))
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + brute_match(x[i], y[j]))
    return m[-1][-1] + 1


def test_matching_of_trees_without_repeated_neighbours():
    one = wrapper.parse("<div><h1>a</h1><p>b</p><ul><li>c</li></ul><p>d</p></div>")
    two = wrapper.parse("<div><p>b</p><section>n</section><ul><li>x</li></ul><h1>a</h1></div>")
    assert wrapper.match(one, two)[0] == brute_match(one, two) == 5
    assert len(wrapper.match(one, one)[1]) == brute_match(one, one) == 7


def test_other_words_at_a_constant_node_stay(spark):
    def page(k, by):
        return f"<body><p>{by}</p><h2>Title {k}</h2><p>Words {k}</p></body>"

    rows = [(k, f"http://h.example/{k}", page(k, "By our staff" if k < 17 else f"First words of {k}")) for k in range(20)]
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(pages(spark, rows)).collect()}
    for k in range(20):
        assert got[k] == (f"Title {k}\nWords {k}" if k < 17 else f"First words of {k}\nTitle {k}\nWords {k}")


def test_near_copies_have_one_vote(spark):
    def page(k, body):
        return f"<body><nav>menu {k}</nav><div class=ad>advert {k}</div><h1>{body}</h1><p>Text of {body}</p></body>"

    one = [(k, f"http://h.example/{k}", page(k, "one")) for k in range(8)]
    two = [(k, f"http://h.example/{k}", page(k, "two")) for k in range(8, 16)]
    for rows in (one[:5] + two[:1], one + two):
        got = {r["page_id"]: r["text"] for r in wrapper.main_text(pages(spark, rows)).collect()}
        assert got == {k: "one\nText of one" if k < 8 else "two\nText of two" for k, _, _ in rows}


def test_words_of_layouts_are_no_marks():
    for html in (
        "<html class='has-overlay'><body class='right-sidebar comment-open'><p>x</p></body></html>",
        "<html class=overlay><body class='search hidden'><p>x</p></body></html>",
        "<body><div id=page class='no-sidebar'><p>x</p></div><div class='sidebar'>s</div><div id='cookie-notice'>c</div></body>",
        "<body><main class=notice role=search><article class='post share-enabled share'><p>x</p></article></main></body>",
        "<body><div class='side search'><div class=hidden><article><p>x</p></article></div><div class=related><article>t</article></div></div></body>",
    ):
        assert text_of(html) == "x"


def test_text_outside_of_articles_is_content(spark):
    card = "<article class='card'><p>Teaser</p></article>"

    def page(k):
        return f"<body><div class=top>Welcome</div><main><h1>T {k}</h1><p>The text {k}</p>{card}</main><div class=end><p>More {k}</p></div></body>"

    assert text_of("<body><h1>T</h1><p>The text</p>" + card + "</body>") == "T\nThe text\nTeaser"
    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(8)]
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(pages(spark, rows)).collect()}
    assert got == {k: f"T {k}\nThe text {k}\nTeaser\nMore {k}" for k in range(8)}


def stripped(html):
    """Without class names and with plain blocks for what HTML marks as a region."""
    html = re.sub(r" (?:class|id|role)=\"[^\"]*\"", "", html)
    return re.sub(r"<(/?)(?:nav|footer|aside|article|main|header|section)\b", r"<\1div", html)


def test_the_induced_template_finds_articles_without_marks(spark):
    given = sorted((r["page_id"], r["html"]) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect())
    rows = [(k, f"http://h{k % 2}.example/{k}", stripped(html)) for k, html in given]
    want = {k: text_of(html) for k, html in given}

    def near(percent, votes):
        got = {r["page_id"]: r["text"] for r in wrapper.main_text(pages(spark, rows), votes, percent).collect()}
        return sum(got[k] == text for k, text in want.items()) / len(want)

    assert near(wrapper.CONSTANT_PERCENT, wrapper.MIN_PAGES) > 0.9
    assert near(wrapper.CONSTANT_PERCENT, 10**9) < 0.1  # without votes menus, adverts and footers stay


def test_the_vote_decides_on_marked_pages(spark):
    def page(k):
        return f"<body><article><h1>Title {k}</h1><p>Sign in to read on</p><p>Words {k}</p></article></body>"

    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(8)]
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(pages(spark, rows)).collect()}
    assert got == {k: f"Title {k}\nWords {k}" for k in range(8)}
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(pages(spark, rows), percent=101).collect()}
    assert got == {k: f"Title {k}\nSign in to read on\nWords {k}" for k in range(8)}


def test_matching_of_any_trees():
    rng = random.Random(5)

    def tree(depth):
        kids = "".join(tree(depth - 1) for _ in range(rng.randrange(5))) if depth else ""
        tag = rng.choice(["div", "section", "ul"])
        return f"<{tag}>{kids}</{tag}>"

    for _ in range(150):
        a, b = (wrapper.parse(f"<main>{tree(3)}{tree(2)}</main>") for _ in range(2))
        count, pairs = wrapper.match(a, b)
        assert count == len(pairs) == brute_match(a, b)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == count
        assert all(x.symbol == y.symbol for x, y in pairs)


def test_long_lists_are_matched_whole(monkeypatch):
    for n in (180, 300, 3000):
        runs = "<p></p><div></div>" * n
        a, b = wrapper.parse(f"<main>{runs}<span></span></main>"), wrapper.parse(f"<main><span></span>{runs}</main>")
        assert wrapper.match(a, b)[0] == 2 * n + 2
    rng = random.Random(6)
    a, b = (wrapper.parse("".join(rng.choice(["<p><i></i></p>", "<div></div>", "<ul><li></li><li></li></ul>"]) for _ in range(60))) for _ in range(2))
    want = brute_match(a, b)
    monkeypatch.setattr(wrapper, "CELLS", 10)
    assert wrapper.match(a, b)[0] == want


def test_one_inserted_item_shifts_no_other():
    a = wrapper.parse("<ul><li><b>x</b></li><li><i>y</i></li><li><u>z</u></li></ul>")
    b = wrapper.parse("<ul><li><em>new</em></li><li><b>x</b></li><li><i>y</i></li><li><u>z</u></li></ul>")
    assert wrapper.match(a, b)[0] == 8


def test_regions_at_any_depth():
    deep = "<div>" * 3000 + "<p>text</p><aside>also</aside><nav><a>menu</a></nav>" + "</div>" * 3000 + "<p>end</p>"
    root = wrapper.parse(deep)
    assert text_of(deep) == "text\nend"
    assert wrapper.match(root, wrapper.parse("<div>" + deep + "</div>"))[0] >= 3000


def test_forms():
    article = "<article><h1>A</h1><p>The words of it</p></article>"
    assert text_of(f"<body><form action=x>{article}<input value=v><button>Go</button></form></body>") == "A\nThe words of it"
    assert text_of("<body><form><h1>A</h1><p>All of the text is in a form</p><select><option>o</select></form></body>") == "A\nAll of the text is in a form"
    assert text_of(f"<body>{article}<form>Your mail <input></form></body>") == "A\nThe words of it"


def test_named_parts_of_an_article():
    inner = "<p class=notice>Mind this</p><section id=related><p>Earlier work was of another kind</p></section><div class=side>By the side</div>"
    assert text_of(f"<article><p>Text</p>{inner}</article>") == "Text\nMind this\nEarlier work was of another kind\nBy the side"
    links = "<section id=related><a href=x>One page</a> <a href=y>Another page</a></section>"
    comments = "".join(f"<div class='{c}'><p>Nice!</p></div>" for c in ("user-comments", "comment-list", "comments-area", "replies"))
    assert text_of(f"<article><p>Text</p>{links}{comments}</article>") == "Text"
