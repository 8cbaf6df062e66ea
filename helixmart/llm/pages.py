"""Main text of web pages: boosted trees over DOM-node features, decoded so that ancestors and descendants agree."""

from __future__ import annotations

import functools
import html
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmart.llm.boost import BoostedTrees
from helixmart.llm.common import ship

# Elements by the part they play in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript head title svg iframe select option datalist textarea annotation annotation-xml".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd semantics annotation annotation-xml".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}

# Features: tags told apart, and what tokens of class, id and role speak of.
TAGS = "p h1 h2 h3 h4 li ul ol div section article main nav header footer aside form table td blockquote pre figure figcaption dl body".split()
TOKENS = {
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs topbar tabs pager pagination toc skip",
    "head": "header masthead banner top logo branding hero",
    "foot": "footer bottom copyright colophon legal imprint foot",
    "side": "sidebar aside side rail widget widgets complementary secondary",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsense dfp",
    "notice": "cookie cookies consent notice alert banner popup modal overlay gdpr newsletter subscribe subscription paywall",
    "social": "share sharing social related recommended recommendations trending popular more tags meta byline author",
    "comment": "comment comments commentlist reply replies discussion disqus respond reviews reader",
    "form": "form search login signup register input contact",
    "main": "article content main post entry story body text page maincontent articlebody prose",
}
GROUP = {t: i for i, (_, words) in enumerate(TOKENS.items()) for t in words.split()}
SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^=>]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+)?)*+)>|<[!?/][^>]*(?:>|\Z)", re.S)
# One attribute after the other: quotes speak only after an equals sign, and what a value holds is no name.
ATTRIBUTE = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+))?")
# HTML's white space and the blanks that references can write.
SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "items", "groups", "depth", "hidden", "links", "own", "label", "open")

    def __init__(self, tag: str, parent: Node | None, groups: tuple[int, ...] = (), hidden: bool = False):
        self.tag, self.parent, self.groups, self.hidden = tag, parent, groups, hidden
        self.children: list[Node] = []
        self.items: list[str | Node] = []  # texts and block children, in page order
        self.depth = parent.depth + 1 if parent else 0
        self.links = 0  # characters of its own text that are links
        self.own = 0
        self.label = None


def parse(page: str) -> Node:
    """Tree of the block elements; inline elements only leave their text, and how much of it is linked."""
    root = Node("body", None)
    stack: list[tuple[str, Node | None]] = []  # open elements; None for inline and transparent ones
    here, linked, at, end = root, 0, 0, len(page)

    def text(raw: str) -> None:
        if raw:
            found = html.unescape(raw) if "&" in raw else raw
            here.items.append(found)
            n = len(found)
            here.own += n
            if linked:
                here.links += n

    def close(upto: int) -> None:
        nonlocal here, linked
        while len(stack) > upto:
            tag, node = stack.pop()
            if node is not None:
                here = node.parent
            elif tag == "a":
                linked -= 1

    while at < end:
        m = TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            else:
                if tag == "br":
                    here.items.append(" ")
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][1] is not None:
                    break
        if tag in SIBLINGS:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in STOPS[tag]:
                    break
                if stack[i][0] in SIBLINGS[tag]:
                    close(i)
                    if tag not in ("tr", "tbody", "tfoot", "thead"):
                        break
        if tag in VOID:
            if tag in ("br", "hr", "img", "input"):
                here.items.append(" ")
            if tag == "hr":
                here.items.append(Node("hr", here))
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?|\Z", re.I).search(page, at)
            at = stop.end()
            continue
        groups, hidden = (), tag in UNSEEN
        if m[3]:
            found = set()
            for name, value in ATTRIBUTE.findall(m[3]):
                name, value = name.lower(), value[1:-1] if value[:1] in ("'", '"') else value
                if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                    hidden = True
                elif name in ("class", "id", "role"):
                    found.update(GROUP[t] for t in (w.lower() for w in SPLIT.split(value)) if t in GROUP)
            groups = tuple(found)
        if tag in INLINE and not hidden and not groups:
            stack.append((tag, None))
            linked += tag == "a"
        else:
            node = Node(tag, here, groups, hidden)
            here.items.append(node)
            here.children.append(node)
            here = node
            stack.append((tag, node))
    return root


def features(root: Node) -> tuple[list[Node], np.ndarray]:
    """All block nodes, parents first, and a row of features for each."""
    order: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(reversed(node.children))
    place = {id(n): i for i, n in enumerate(order)}
    size, links, blocks, paragraphs, stops, lists = ([0] * len(order) for _ in range(6))
    for i in range(len(order) - 1, -1, -1):
        n = order[i]
        size[i] += n.own
        links[i] += n.links
        blocks[i] += 1
        stops[i] += sum(t.count(". ") + t.count(".\n") + t.endswith(".") for t in n.items if isinstance(t, str))
        if n.parent is not None:
            p = place[id(n.parent)]
            for values in (size, links, blocks, stops):
                values[p] += values[i]
            paragraphs[p] += n.tag == "p"
            lists[p] += n.tag == "li"
    total, tag_at = max(1, size[0]), {t: i for i, t in enumerate(TAGS)}
    width = 16 + len(TAGS) + 2 * len(TOKENS) + len(TAGS)
    x = np.zeros((len(order), width), dtype=np.float32)
    above: list[set[int]] = []
    above_tags: list[set[int]] = []
    for i, n in enumerate(order):
        p = place[id(n.parent)] if n.parent is not None else 0
        siblings = n.parent.children if n.parent is not None else [n]
        row = x[i]
        row[0], row[1], row[2] = n.depth, math.log1p(size[i]), links[i] / max(1, size[i])
        row[3], row[4], row[5] = size[i] / blocks[i], stops[i] / (1 + size[i] / 100), size[i] / total
        row[6], row[7] = math.log1p(n.own), paragraphs[i]
        row[8], row[9] = len(siblings), lists[i]
        row[10], row[11] = size[p] / blocks[p], links[p] / max(1, size[p])
        row[12], row[13] = paragraphs[p], math.log1p(size[p])
        row[14], row[15] = size[i] / max(1, size[p]), i / len(order)
        base = 16
        t = tag_at.get(n.tag)
        if t is not None:
            row[base + t] = 1
        base += len(TAGS)
        own = set(n.groups)
        for g in own:
            row[base + g] = 1
        base += len(TOKENS)
        up = above[p] | set(n.parent.groups) if n.parent is not None else set()
        up_tags = above_tags[p] | ({tag_at[n.parent.tag]} if n.parent.tag in tag_at else set()) if n.parent is not None else set()
        above.append(up)
        above_tags.append(up_tags)
        for g in up:
            row[base + g] = 1
        base += len(TOKENS)
        for g in up_tags:
            row[base + g] = 1
    return order, x


def decode(order: list[Node], margins: np.ndarray) -> set[int]:
    """Nodes to keep (by place): the best sum of margins in which nothing below a dropped node is kept.

    A node's margin counts by how much text it has of its own; an empty node goes with its descendants.
    """
    place = {id(n): i for i, n in enumerate(order)}
    weights = [math.log1p(n.own) for n in order]
    keep, drop = [0.0] * len(order), [0.0] * len(order)
    for i in range(len(order) - 1, -1, -1):
        n = order[i]
        keep[i] += float(margins[i]) * weights[i] if not n.hidden else -1e9
        drop[i] -= float(margins[i]) * weights[i] if not n.hidden else 0.0
        if n.parent is not None:
            p = place[id(n.parent)]
            keep[p] += max(keep[i], drop[i])
            drop[p] += drop[i]
    kept: set[int] = set()
    for i, n in enumerate(order):
        if (n.parent is None or place[id(n.parent)] in kept) and (n.parent is None or keep[i] > drop[i]):
            kept.add(i)
    return kept


def render(order: list[Node], kept: set[int]) -> str:
    """Kept blocks in page order, one on a line."""
    place = {id(n): i for i, n in enumerate(order)}
    blocks: list[str] = []

    todo: list[tuple[Node, int]] = [(order[0], 0)]
    parts: list[str] = []

    def flush() -> None:
        if parts:
            block = SPACES.sub(" ", "".join(parts)).strip()
            parts.clear()
            if block:
                blocks.append(block)

    while todo:
        node, at = todo.pop()
        while at < len(node.items):
            item = node.items[at]
            at += 1
            if isinstance(item, str):
                parts.append(item)
                continue
            inline = item.tag in INLINE
            if not inline:
                flush()
            if place.get(id(item)) in kept:
                todo += [(node, at), (item, 0)]
                break
        else:
            if node.tag not in INLINE:
                flush()
    return "\n".join(blocks)


# ---- training pages: a generator that knows which blocks are the article -------------------------------------------


def _sentence(rng: random.Random, least: int, most: int) -> str:
    return " ".join("x" * rng.randint(2, 9) for _ in range(rng.randint(least, most))).capitalize() + "."


def _paragraph(rng: random.Random) -> str:
    return " ".join(_sentence(rng, 3, 14) for _ in range(rng.choice([1, 1, 2, 3, 5, 9])))


def _attr(rng: random.Random, words: list[str], none: float = 0.2) -> str:
    if rng.random() < none:
        return ""
    word = rng.choice(words)
    return rng.choice([f' class="{word}"', f' id="{word}"', f' class="box {word}"', f' class="{word}-{rng.choice(["wrap", "x", "inner", "area"])}"', f" class={word}"])


def training_page(rng: random.Random) -> str:
    """A page whose dropped parts carry the attribute ``data-drop``: menus, headers, footers, asides, notices,
    adverts, forms and reader comments around and inside an article of varied make."""
    p, links = lambda: f"<p>{_paragraph(rng)}</p>", lambda n: "".join(f'<li><a href="/x">{_sentence(rng, 1, 4)}</a></li>' for _ in range(n))

    def drop(tag: str, inner: str, words: list[str], none: float = 0.1) -> str:
        return f"<{tag}{_attr(rng, words, none)} data-drop>{inner}</{tag}>"

    def menu() -> str:
        return drop(rng.choice(["nav", "nav", "div", "ul"]), f"<ul>{links(rng.randint(2, 9))}</ul>", ["nav", "menu", "navbar", "main-menu", "breadcrumbs"])

    def advert() -> str:
        return drop(rng.choice(["div", "div", "aside", "section", "p"]), rng.choice([_sentence(rng, 3, 20), _paragraph(rng)]), ["ad", "ads", "advert", "sponsored", "promo", "ad-slot"], 0)

    def notice() -> str:
        return drop(rng.choice(["div", "section", "p"]), rng.choice([_sentence(rng, 5, 20), p()]) + rng.choice(["", "<button>Ok</button>"]), ["cookie-notice", "consent", "notice", "alert", "newsletter", "popup"], 0)

    def side() -> str:
        return drop(rng.choice(["aside", "aside", "div"]), f"<h3>{_sentence(rng, 1, 3)}</h3>" + rng.choice([f"<ul>{links(5)}</ul>", p(), p() + p()]), ["sidebar", "widget", "side", "related"], 0.05)

    def form() -> str:
        return drop("form", f"<label>{_sentence(rng, 1, 3)}</label><input><p>{_sentence(rng, 2, 9)}</p><button>Go</button>", ["search", "login", "signup"], 0.5)

    def comments() -> str:
        one = lambda: f'<{rng.choice(["li", "div"])}>{rng.choice(["", "<b>x</b>"])}{p()}'
        return drop(rng.choice(["section", "div", "ol"]), f"<h3>{_sentence(rng, 1, 3)}</h3>" + "".join(one() for _ in range(rng.randint(1, 6))), ["comments", "commentlist", "discussion", "replies", "user-comments"], 0)

    def head() -> str:
        return drop(rng.choice(["header", "header", "div"]), rng.choice([f"<h1>{_sentence(rng, 1, 4)}</h1>", f"<p>{_sentence(rng, 2, 6)}</p>", menu()]), ["header", "masthead", "banner", "top"], 0.05)

    def foot() -> str:
        return drop(rng.choice(["footer", "footer", "div"]), rng.choice([f"&copy; {_sentence(rng, 3, 20)}", f"<p>{_paragraph(rng)}</p>", f"<ul>{links(4)}</ul>"]), ["footer", "site-footer", "copyright", "legal"], 0.05)

    parts = [f"<h1>{_sentence(rng, 1, 12)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.choice([0, 1, 2, 4, 8, 12])):
        parts.append(p())
        if rng.random() < 0.2:
            parts.append(
                rng.choice([f"<h2>{_sentence(rng, 1, 6)}</h2>", f"<blockquote>{p()}</blockquote>", "<ul>" + "".join(f"<li>{_sentence(rng, 2, 15)}</li>" for _ in range(4)) + "</ul>", f"<pre>{_sentence(rng, 3, 9)}</pre>",
                            f"<figure><figcaption>{_sentence(rng, 3, 9)}</figcaption></figure>", f"<table><tr><td>{_sentence(rng, 1, 4)}<td>{_sentence(rng, 1, 4)}</table>", f"<p>{_sentence(rng, 2, 9)} <a href=x>{_sentence(rng, 1, 4)}</a> {_sentence(rng, 2, 9)}</p>"])
            )
        if rng.random() < 0.08:
            parts.append(rng.choice([advert, notice, side, form, lambda: drop("ul", links(4), ["share", "related", "tags", "social"], 0)])())
    if rng.random() < 0.3:
        parts.append("<p><b>" + _sentence(rng, 3, 12) + "<br>")
    tag = rng.choice(["article", "article", "main", "div", "section"])
    known = ["article", "content", "post", "entry-content", "story", "main", "article-body"]
    body = f"<{tag}{_attr(rng, known, 0.8 if tag in ('article', 'main') else 0.1)}>{''.join(parts)}</{tag}>"
    if rng.random() < 0.3:
        body = f"<{rng.choice(['div', 'main'])}{_attr(rng, ['page', 'wrap', 'container', 'main'])}>{body}{rng.choice(['', comments(), side()])}</div>"
    before = [f() for f in (menu, head, notice, advert, form) if rng.random() < 0.5]
    after = [f() for f in (side, comments, advert, notice, form) if rng.random() < 0.35] + [foot() for _ in range(rng.random() < 0.85)]
    rng.shuffle(before)
    return "<html><body>" + "".join(before) + body + "".join(after)


@functools.lru_cache(maxsize=1)
def model(pages: int = 600, seed: int = 11) -> BoostedTrees:
    """Trained on generated pages only; the same at every size of input."""
    rng = random.Random(seed)
    xs, ys = [], []
    for _ in range(pages):
        # The mark becomes an element of its own, which parse() keeps and features() does not know.
        source = training_page(rng)
        marked = re.sub(r"<(\w+)([^<>]*) data-drop>", r'<\1\2 style="--drop">', source)
        order, x = features(_marked(marked))
        xs.append(x)
        ys.append(np.array([0.0 if n.label else 1.0 for n in order]))
    return BoostedTrees().fit(np.concatenate(xs), np.concatenate(ys))


def _marked(page: str) -> Node:
    """The tree of a generated page, with ``label`` set on nodes in dropped parts."""
    root = parse(page)
    flags = iter(re.findall(r'<(?!/)(\w+)([^<>]*)>', page))
    # Blocks come in page order in both.
    blocks = [attrs for tag, attrs in flags if not (tag in INLINE and not _speaks(attrs)) and tag not in VOID and tag not in ("html", "body")]
    order: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(reversed(node.children))
    for node, attrs in zip(order[1:], blocks, strict=True):
        node.label = "--drop" in attrs or bool(node.parent.label)
    return root


def _speaks(attrs: str) -> bool:
    return any(t.lower() in GROUP for name, value in ATTRIBUTE.findall(attrs) if name in ("class", "id", "role") for t in SPLIT.split(value))


def main_text(pages: list[str | None], trees: BoostedTrees) -> list[str]:
    parsed = [features(parse(p or "")) for p in pages]
    if not parsed:
        return []
    margins = trees.margin(np.concatenate([x for _, x in parsed]))
    out, at = [], 0
    for order, x in parsed:
        out.append(render(order, decode(order, margins[at : at + len(x)])))
        at += len(x)
    return out


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the column ``out``: the main text of the whole html, its blocks joined by line ends.

    Edge cases: NULL and empty html, and pages without an article, give the empty text; unclosed and stray tags
    are mended as browsers do; references are decoded once; an unclosed comment or script runs to the page's
    end; repeated rows are answered each; a column named ``out`` is replaced.
    """
    ship(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(model())
    source = pages.drop(out) if out != html_col else pages
    place = source.columns.index(html_col)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = main_text(part.column(place).to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "_main_text"])

    done = source.mapInArrow(run, ", ".join([*fields, "_main_text string"]))
    return done.withColumn(out, F.coalesce("_main_text", F.lit(""))).drop("_main_text")
