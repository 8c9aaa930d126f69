"""Main text of web pages by wrapper induction.

The pages of a host share a template. A reference page stands for each host (its
page of the smallest id with any markup); the DOM tree of every page is aligned
with it by simple tree matching: two nodes match if their tags and classes are
equal, and their children are matched in order for the largest number of matched
nodes. Children of equal shape at both ends of two lists are paired at once, which
loses no match; what is left between them is matched by dynamic programming over
rows, in memory linear in the lists, at every size and depth.

The blocks that the pages of a host show at a reference node decide about it. A
node is constant if nearly all pages that have it hold the same words there: these
words are template wherever they stand, in articles too if those vary. Varying nodes are content,
but for those outside of the host's content, the smallest part of the reference with
CONTENT_SHARE percent of its varying text beside links, whose words are mostly links,
or which nearly all pages have with fewer words than the content's blocks have on average. Pages of the same blocks have one vote
together, those of the reference's blocks none, and only MIN_PAGES votes decide.

Marks decide where the votes do not: regions that are not the article by their tag,
role or class are left out, and article, main part and headings protect varying text.
Inside of an article the vaguer names count only for regions of links. A form goes
with its words unless it holds the page's article or most of its text; controls go.

Null or empty html gives an empty text; a null or strange url puts a page with
the pages of the empty host. Unclosed and cut markup is closed as browsers do.
Very long pages are read whole. Repeated rows give equal rows. Other columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.shared import chunks, written

MIN_PAGES = 5
CONSTANT_PERCENT = 80
#: A host's content is the smallest part of the template with this share of the varying text.
CONTENT_SHARE = 90
#: Cells of two child lists whose whole table is held; longer lists are halved until theirs fit.
CELLS = 1 << 20
#: References together up to so many characters are broadcast.
BROADCAST_CHARS = 16 << 20
#: Judged nodes of all hosts together up to this number are broadcast.
BROADCAST_SLOTS = 500_000
SALTS = 16

# Fixed values of HTML: elements without an end, raw text, blocks, implied ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul caption legend".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("html body div ul ol dl table article section main aside nav footer header form blockquote td th".split())

# What is never an article, by tag, and by class, id or role if these words make up a whole class or name. The words
# do not count for the tags that hold content, nor around the page's largest article or main part.
OUT_TAGS = frozenset(
    "head nav footer aside script style noscript template iframe button select textarea svg object menu dialog "
    "input label canvas audio video map title".split()
)
OUT_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar side aside ad ads advert adverts advertisement "
    "advertising adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments "
    "disqus reply replies respond related recommended widget pagination pager toolbar search masthead topbar skip "
    "complementary contentinfo hidden".split()
)

# Out words that articles use for parts of their own as well.
VAGUE_WORDS = frozenset("side aside related recommended notice notices notification alert search widget toolbar menu".split())
# Words that go with out words in a name, as in comment-list, and mean nothing alone.
WITH_WORDS = frozenset("area block box container form inner item items list page post reader section site thread user wrap wrapper".split())

CONTENT_TAGS = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "symbol", "out", "said", "items", "place", "chars", "links", "kids", "shape")

    def __init__(self, tag: str, symbol: str, out: bool, said: int):
        # out: no article by its tag or as it is not shown; said: by a name, 1 a vague one, 2 a plain one.
        self.tag, self.symbol, self.out, self.said = tag, symbol, out, said
        self.items: list[Node | str] = []
        self.place = self.shape = -1
        # Characters in regions that are not out, and those in links.
        self.chars = self.links = 0


def _said(token: str) -> int:
    """2 if the words of a token are out words: comment-list, but not no-sidebar; 1 if only vague ones."""
    found = _WORD.findall(token)
    outs = OUT_WORDS.intersection(found)
    if not outs or not (OUT_WORDS | WITH_WORDS).issuperset(found):
        return 0
    return 1 if outs <= VAGUE_WORDS else 2


def _node(tag: str, attributes: str) -> Node:
    symbol, out, said = tag, tag in OUT_TAGS, 2 * (tag == "form")
    if attributes.strip(" /\n\t"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), next((v for v in values if v), "").lower()
            if name in ("class", "id", "role"):
                if tag not in CONTENT_TAGS:
                    said = max([said, *(_said(token) for token in value.split())])
                if name == "class":
                    symbol += "." + ".".join(sorted(value.split()))
            elif name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "")):
                out = True
            elif name == "aria-hidden" and value == "true":
                out = True
    return Node(tag, symbol, out, 0 if out else said)


def parse(html: str) -> Node:
    """The tree of a page: elements, and text with character references decoded."""
    root = Node("", "", False, 0)
    stack, at = [root], 0
    opened: dict[str, int] = {}  # open elements by tag: an end or a start that closes nothing looks for nothing

    def close(k: int):
        for node in stack[k:]:
            opened[node.tag] -= 1
        del stack[k:]

    while at < len(html):
        m = _TOKEN.search(html, at)
        if m is None:
            stack[-1].items.append(unescape(html[at:]))
            break
        if m.start() > at:
            stack[-1].items.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1) if opened.get(tag) else ():
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break  # an inline end tag does not close a block
            continue
        if tag in BLOCKS:
            # A block ends an open paragraph.
            for k in range(len(stack) - 1, 0, -1) if opened.get("p") else ():
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in SCOPES:
                    break
        if closed := CLOSED_BY.get(tag):
            for k in range(len(stack) - 1, 0, -1) if any(opened.get(t) for t in closed) else ():
                if stack[k].tag in closed:
                    close(k)
                    if tag != "tr":
                        break
                elif stack[k].tag in ("ul", "ol", "dl", "table", "select", "tbody", "thead", "tfoot", "tr", "menu"):
                    break
        if tag == "tr" and stack[-1].tag == "tr":
            close(len(stack) - 1)
        node = _node(tag, m[3])
        stack[-1].items.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(html, at)
            node.items.append(html[at : end.start() if end else len(html)])
            at = html.find(">", end.end()) + 1 if end else len(html)
            at = at or len(html)
            continue
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
    _spare(root)
    return root


def _nodes(root: Node) -> list[Node]:
    """All nodes in document order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.items) if isinstance(c, Node)]
    return out


def _spare(root: Node) -> None:
    """Counts characters, and takes the name marks from the nodes around the largest
    article or main part and from a form with most of the page's text."""
    order, parent = _nodes(root), {}
    for node in reversed(order):
        for c in node.items:
            if isinstance(c, str):
                node.chars += len(c) - c.count(" ")
            else:
                parent[id(c)] = node
                if not c.out:
                    node.chars += c.chars
                    node.links += c.links
        if node.tag == "a":
            node.links = node.chars
    for node in order:
        if node.tag == "form" and 2 * node.chars > root.chars:
            node.said = 0
    marked = [node for node in order if node.tag in ("article", "main") and node.chars]
    largest = max(marked, key=lambda node: node.chars, default=None)
    # Marks inside of main part do not count around an article that is all of it.
    while inner := [c for c in largest.items if isinstance(c, Node) and c.chars == largest.chars] if largest else []:
        largest = inner[0]
    while largest is not None:
        largest.said = 0
        largest = parent.get(id(largest))


def numbered(root: Node) -> Node:
    """Places of the nodes in document order."""
    for k, node in enumerate(_nodes(root)):
        node.place = k
    return root


class _Shapes:
    """The different trees among the nodes of two pages, and the matches of pairs of them."""

    def __init__(self, *roots: Node):
        self.symbol: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.known: dict[tuple[int, int], int] = {}
        ids: dict[tuple, int] = {}
        for root in roots:
            for node in reversed(_nodes(root)):
                node.kids = [c for c in node.items if isinstance(c, Node)]
                kids = tuple(c.shape for c in node.kids)
                node.shape = ids.setdefault((node.symbol, kids), len(ids))
                if node.shape == len(self.kids):
                    self.symbol.append(node.symbol)
                    self.kids.append(kids)
                    self.size.append(1 + sum(self.size[k] for k in kids))

    def of(self, x: int, y: int) -> int | None:
        """Matched nodes of two trees, None if not yet counted."""
        if x == y:
            return self.size[x]
        return self.known.get((x, y)) if self.symbol[x] == self.symbol[y] else 0

    def count(self, x: int, y: int) -> int:
        """Matched nodes of two trees, from the lower trees up."""
        todo = [(x, y)]
        while todo:
            x, y = todo[-1]
            if self.of(x, y) is not None:
                todo.pop()
                continue
            xs, ys = self.kids[x], self.kids[y]
            lead, tail = _ends(xs, ys)
            left, right = xs[lead : len(xs) - tail], ys[lead : len(ys) - tail]
            lacking = [(p, q) for p in set(left) for q in set(right) if self.of(p, q) is None]
            if lacking:
                todo += lacking
                continue
            equal = sum(self.size[k] for k in xs[:lead]) + sum(self.size[k] for k in xs[len(xs) - tail :])
            between = int(_row(*self.table(left, right))[-1]) if left and right else 0
            self.known[x, y] = 1 + equal + between
            todo.pop()
        return self.of(x, y)

    def table(self, left, right):
        """Matched nodes of the different trees of two lists, and the lists as places in it."""
        rows, columns = {x: i for i, x in enumerate(dict.fromkeys(left))}, {y: j for j, y in enumerate(dict.fromkeys(right))}
        table = np.array([[self.count(x, y) for y in columns] for x in rows], np.int64)
        return table, np.array([rows[x] for x in left]), np.array([columns[y] for y in right])


def _ends(xs, ys) -> tuple[int, int]:
    """Lengths of the equal beginnings, and of the equal ends of the rest."""
    shorter, lead, tail = min(len(xs), len(ys)), 0, 0
    while lead < shorter and xs[lead] == ys[lead]:
        lead += 1
    while tail < shorter - lead and xs[-1 - tail] == ys[-1 - tail]:
        tail += 1
    return lead, tail


def _rows(table, xs, ys):
    """Row by row, the most nodes matched by the first members of xs and of ys."""
    row = np.zeros(len(ys) + 1, np.int64)
    yield row
    for x in xs:
        following = row.copy()
        np.maximum(row[1:], row[:-1] + table[x][ys], out=following[1:])
        row = np.maximum.accumulate(following)
        yield row


def _row(table, xs, ys):
    for row in _rows(table, xs, ys):  # noqa: B007
        pass
    return row


def _aligned(table, xs, ys) -> list[tuple[int, int]]:
    """Places of the members that an alignment of the most matched nodes pairs."""
    out, todo = [], [(0, len(xs), 0, len(ys))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a > 1 and (b - a) * (d - c) > CELLS:
            middle = (a + b) // 2
            before = _row(table, xs[a:middle], ys[c:d])
            after = _row(table, xs[a:b][: middle - a - 1 : -1], ys[c:d][::-1])[::-1]
            cut = c + int(np.argmax(before + after))
            todo += [(a, middle, c, cut), (middle, b, cut, d)]
            continue
        best = list(_rows(table, xs[a:b], ys[c:d]))
        i, j = b - a, d - c
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((a + i, c + j))
    return out


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the number of matched nodes, and the matched pairs."""
    if a.symbol != b.symbol:
        return 0, []
    shapes = _Shapes(a, b)
    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        xs, ys = [c.shape for c in x.kids], [c.shape for c in y.kids]
        lead, tail = _ends(xs, ys)
        todo += zip(x.kids[:lead], y.kids[:lead], strict=True)
        todo += zip(x.kids[len(xs) - tail :], y.kids[len(ys) - tail :], strict=True)
        left, right = xs[lead : len(xs) - tail], ys[lead : len(ys) - tail]
        if left and right:
            todo += [(x.kids[lead + i], y.kids[lead + j]) for i, j in _aligned(*shapes.table(left, right))]
    return len(pairs), pairs


# What is known of a block without its host's votes.
SAME, OWN, OUT, MARKED, HEADING, LINKED = 1, 2, 4, 8, 16, 32


def regions(root: Node, places: dict[int, int]) -> list[tuple[str, int, int]]:
    """(text, reference node, flags) of all blocks with words, in page order.

    places: of matched nodes, by id, the reference's places. A block whose element is
    not matched (OWN is not set) has the node of the nearest matched one around it.
    """
    out: list[tuple[str, int, int]] = []
    held: list[str] = []
    linked = 0

    def close(slot: int, flags: int):
        nonlocal linked
        words = " ".join("".join(held).split())
        if words:
            out.append((words, slot, flags | (LINKED if 2 * linked >= len(words) - words.count(" ") else 0)))
        held.clear()
        linked = 0

    # (node, block's node and flags, in a link, its next item) of the open elements
    stack = [(root, places.get(id(root), -1), OWN if id(root) in places else 0, False, iter(root.items))]
    while stack:
        node, slot, flags, link, items = stack[-1]
        c = next(items, None)
        if c is None:
            stack.pop()
            if node.tag in BLOCKS or not node.tag:
                close(slot, flags)
        elif isinstance(c, str):
            held.append(c)
            linked += (len("".join(c.split()))) if link else 0
        elif c.tag == "br":
            held.append(" ")
        else:
            inside = flags | MARKED if c.tag in ("article", "main") else flags
            vague = c.said == 1 and inside & MARKED and 2 * c.links < c.chars
            gone = c.out or (c.said and not vague) or (c.tag == "header" and not inside & MARKED)
            if c.tag in BLOCKS:
                close(slot, flags)
                own = id(c) in places
                inside = (inside & ~OWN) | (OWN if own else 0) | (OUT if gone else 0) | (HEADING if c.tag in HEADINGS else 0)
                stack.append((c, places[id(c)] if own else slot, inside, link, iter(c.items)))
            elif not gone:
                stack.append((c, slot, inside, link or c.tag == "a", iter(c.items)))
    return out


def blocks(root: Node, places: dict[int, int]) -> list[tuple[str, int]]:
    """(text, reference node) of the blocks that no mark leaves out."""
    return [(text, slot) for text, slot, flags in regions(root, places) if not flags & OUT]


@lru_cache(maxsize=64)
def _reference(html: str) -> tuple[Node, dict[int, set[str]], frozenset[str]]:
    """A reference page's tree, the words of its nodes by place, and all that no mark leaves out."""
    root = numbered(parse(html))
    found = regions(root, {id(node): node.place for node in _nodes(root)})
    words: dict[int, set[str]] = {}
    for text, slot, _ in found:
        words.setdefault(slot, set()).add(text)
    return root, words, frozenset(text for text, _, flags in found if not flags & OUT)


PARTS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("differs", T.BooleanType()),
        T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("slots", T.ArrayType(T.IntegerType())),
        T.StructField("flags", T.ArrayType(T.IntegerType())),
    ]
)

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1))
    return pages.select("page_id", "url", "html", host.alias("host"))


def references_of(rows: DataFrame) -> DataFrame:
    """host, reference: the page that stands for each host, written."""
    return written(
        rows.filter(F.length("html") > 0)
        .groupBy("host")
        .agg(F.min_by("html", F.struct("page_id", F.xxhash64("html"))).alias("reference"))
    )


def aligned(rows: DataFrame, references: DataFrame) -> DataFrame:
    """Blocks of every page with the reference nodes that they match, and what is
    known of them. Blocks that a mark leaves out have their length and no text."""
    chars = references.agg(F.sum(F.length("reference"))).first()[0] or 0
    if chars <= BROADCAST_CHARS:
        both = rows.join(F.broadcast(references), "host", "left")
    else:
        # A host's pages are spread over SALTS tasks at least.
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)))
        copies = references.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        both = salted.join(copies, ["host", "_salt"], "left")

    def run(batches):
        for batch in chunks(batches, 1 << 20):
            out = []
            for page_id, url, where, html, reference in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                texts, sizes, slots, marks, differs = [], [], [], [], False
                if html:
                    root = parse(html)
                    base, words, every = _reference(reference)
                    pairs = match(root, base)[1]
                    for text, slot, flags in regions(root, {id(a): b.place for a, b in pairs}):
                        texts.append("" if flags & OUT else text)
                        sizes.append(len(text))
                        slots.append(slot)
                        marks.append(flags | SAME if flags & OWN and text in words.get(slot, ()) else flags)
                    differs = every != {text for text in texts if text}
                out.append((page_id, url, where, differs, texts, sizes, slots, marks))
            columns = [pa.array(c, f) for c, f in zip(zip(*out, strict=True), _ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, PARTS.names)

    return both.select(F.col("page_id").cast("long"), "url", "host", "html", "reference").mapInArrow(run, PARTS)


_ARROW = [
    pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()),
]


def votes(parts: DataFrame) -> DataFrame:
    """What the pages of a host show at a reference node: n pages that have it, k with the reference's words; chars and
    blocks in it or nearest to it, and the chars of those that are mostly links."""

    def has(flag: int):
        return F.col("b.flags").bitwiseAND(F.lit(flag)) != 0

    # Pages of the same blocks, in any order, are copies and one vote; the sums are combined before the shuffle.
    content = F.xxhash64(F.array_sort(F.array_distinct("texts")))
    return (
        parts.filter("differs")
        .select("host", content.alias("content"), F.explode(F.arrays_zip("sizes", "slots", "flags")).alias("b"))
        .groupBy("host", "content", F.col("b.slots").alias("slot"))
        .agg(
            F.max(has(OWN).cast("long")).alias("own"),
            F.min(F.when(has(OWN), has(SAME).cast("long"))).alias("same"),
            F.avg("b.sizes").alias("size"),
            F.avg(has(LINKED).cast("long")).alias("linked"),
        )
        .groupBy("host", "slot")
        .agg(
            F.count("*").alias("blocks"),
            F.sum("own").alias("n"),
            F.sum(F.coalesce("same", F.lit(0))).alias("k"),
            F.sum("size").alias("chars"),
            F.sum(F.col("size") * F.col("linked")).alias("links"),
        )
    )


def judged(html: str, shown: list[dict], min_pages: int, percent: int) -> tuple[list[int], list[int]]:
    """A host's constant nodes, and the varying ones that are no content."""
    nodes = _nodes(numbered(parse(html)))
    parent = {c.place: node.place for node in nodes for c in node.items if isinstance(c, Node)}
    same = {s["slot"] for s in shown if s["slot"] >= 0 and s["n"] >= min_pages and 100 * s["k"] >= percent * s["n"]}
    varying = {s["slot"]: s for s in shown if s["slot"] >= 0 and s["slot"] not in same}
    # The vote takes blocks from an article, never a whole one.
    article: dict[int, int] = {}
    for node in nodes:
        above = article.get(parent.get(node.place, -1), -1)
        article[node.place] = node.place if node.tag in ("article", "main") else above
    partly = {article[slot] for slot in varying}
    constant = [slot for slot in same if article[slot] < 0 or article[slot] in partly]
    # Text beside links below every node, and the smallest node of blocks with nearly all of it.
    below = [0.0] * len(nodes)
    for slot, s in varying.items():
        below[slot] = max(s["chars"] - s["links"], 0.0)
    for place in range(len(nodes) - 1, 0, -1):
        below[parent[place]] += below[place]
    content = nodes[0]
    while below[0]:
        inner = [c for c in content.items if isinstance(c, Node) and 100 * below[c.place] >= CONTENT_SHARE * below[0]]
        if not inner or not any(isinstance(c, Node) and c.tag in BLOCKS for c in inner[0].items):
            break
        content = inner[0]
    within, around = {node.place for node in _nodes(content)}, set()
    place = content.place
    while place in parent:
        place = parent[place]
        around.add(place)
    texts = [s for slot, s in varying.items() if slot in within and 2 * s["links"] < s["chars"]]
    mean = sum(s["chars"] for s in texts) / max(sum(s["blocks"] for s in texts), 1)
    pages = max((s["n"] for s in shown), default=0)
    outside = [
        slot
        for slot, s in varying.items()
        if slot not in within
        and slot not in around
        and s["n"] >= min_pages
        and (2 * s["links"] >= s["chars"] or (100 * s["n"] >= percent * pages and s["chars"] < mean * s["blocks"]))
    ]
    return sorted(constant), sorted(outside)


TEMPLATE = "host string, constant array<int>, outside array<int>"


def induced(parts: DataFrame, references: DataFrame, min_pages: int, percent: int) -> DataFrame:
    """host, constant, outside of the hosts with nodes that are no content; they are nodes of one page a host."""
    shown = votes(parts).groupBy("host").agg(F.collect_list(F.struct("slot", "n", "k", "chars", "links", "blocks")).alias("shown"))

    def run(batches):
        for batch in chunks(batches, 1 << 20):
            out = [
                (host, *judged(html, shown, min_pages, percent))
                for host, html, shown in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ]
            columns = [pa.array(c, f) for c, f in zip(zip(*out, strict=True), [pa.string(), *[pa.list_(pa.int32())] * 2], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["host", "constant", "outside"])

    both = references.join(shown, "host").select("host", "reference", "shown")
    return both.mapInArrow(run, TEMPLATE).filter((F.size("constant") > 0) | (F.size("outside") > 0))


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, percent: int = CONSTANT_PERCENT) -> DataFrame:
    """page_id, url, text, n_chars of every page (page_id, url, html)."""
    rows = with_host(pages)
    references = references_of(rows)
    parts = written(aligned(rows, references))
    template = written(induced(parts, references, min_pages, percent))
    if (template.agg(F.sum(F.size("constant") + F.size("outside"))).first()[0] or 0) <= BROADCAST_SLOTS:
        template = F.broadcast(template)
    constant, outside = (F.coalesce(c, F.array().cast("array<int>")) for c in ("constant", "outside"))

    def has(block, flag: int):
        return block["flags"].bitwiseAND(F.lit(flag)) != 0

    def stays(b):
        spared = has(b, MARKED) | (has(b, HEADING) & ~has(b, LINKED))
        return ~(
            has(b, OUT)
            | (has(b, SAME) & F.array_contains(constant, b["slots"]))
            | (~spared & F.array_contains(outside, b["slots"]))
        )

    kept = F.filter(F.arrays_zip("texts", "slots", "flags"), stays)
    text = F.array_join(F.transform(kept, lambda b: b["texts"]), "\n")
    return parts.join(template, "host", "left").select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
