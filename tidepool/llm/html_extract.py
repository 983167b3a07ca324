"""HTML extraction by wrapper induction.

Pages are read into DOM trees. Each host has a reference page (the smallest
page_id); every page's skeleton (its elements, runs of equal siblings folded
into one) is aligned with the reference's by simple tree matching, which names
each of its nodes after the node of the reference that it matches. Over all
pages of the host, the named nodes are counted: a node whose text is the same
on nearly every page is template, one whose text varies is a slot. A page's
main text is its slots in page order: those in its semantic region (article,
main) where it has one, else all of them, without menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments. A
form, a dialog, a hidden element or a word of class or id makes an element
boilerplate only if it holds neither an article or main nor most of the page's
varying text (a form around the whole page loses its controls and labels); an
aside only if it holds no article or main and there is other text. The
template nodes stay where they are half of the text or more (pages that copy
each other).

Statistics cover all pages; they are pre-aggregated per (host, node, text), so
a host with a third of all pages is counted in parts, and pages meet their
host's wrapper in a join that Spark broadcasts or splits by size.

Edge cases: a null or empty html has an empty text; malformed markup (missing
end tags, "<" in text, truncated tags) is read as browsers do, roughly; a
null or odd url belongs to the host ''; rows that share a page_id are pages
of their own; text outside every block is a block; an empty table gives an
empty one; other columns are never read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import stage
from tidepool.session import ship_package

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math select option datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr img".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
                   "p pre section table ul".split())
SAME_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "p": {"body"}}
BOILERPLATE_TAGS = frozenset("nav footer button menu head".split())
CONTROL_TAGS = frozenset("label legend output progress meter".split())  # in a form, besides those in RAW
WRAPPING_TAGS = frozenset("form dialog".split())
WRAPPING_ROLES = frozenset("search form dialog alert".split())
LANDMARK_ROLES = frozenset("navigation banner contentinfo complementary menu menubar".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies consent disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "paywall popup promo promoted recommended related replies reply respond share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
CONTENT_ROLES = frozenset(["main", "article"])

TAG_NAME = re.compile(r"(/?)([A-Za-z][A-Za-z0-9:-]*)")
TAG_SIGN = re.compile(r"[>\"']")
ATTRS = re.compile(r"([A-Za-z_:][-A-Za-z0-9_:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    tag: str
    label: str
    junk: bool
    region: bool
    mark: Mark | None = None  # of the element's own class or id
    story: bool = False  # an article, or in one
    children: list[Node] = field(default_factory=list)
    name: str = ""
    block: Node | None = None  # the nearest element that is not inline, itself included


@dataclass(slots=True)
class Mark:
    """An element of a kind, or with a word of class or id, that is mostly boilerplate: the blocks [first, last) are in it."""

    first: int
    comments: bool  # readers' comments or what stands beside the text: goes wherever there is other text
    story: bool
    last: int = 0
    void: bool = False


@dataclass(slots=True)
class Block:
    node: Node
    text: str
    glued: bool  # no space between this block and the one before


class Tags:
    """The tags of a page in order, each found by one pass over it, however odd the page."""

    def __init__(self, text: str):
        self.text = text
        self.last = text.rfind(">")
        self.closed = {'"': True, "'": True}  # whether there may be more of these quotes
        self.quoted = True

    def next(self, at: int) -> tuple[int, int, re.Match | None, str] | None:
        """(start, end, name, attributes) of the first tag from ``at``; the name of a comment or declaration is None."""
        text = self.text
        while (start := text.find("<", at)) >= 0:
            if text.startswith("<!--", start):
                end = text.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(text), None, ""
            if start > self.last:
                return None
            if text.startswith(("!", "?"), start + 1):
                return start, text.index(">", start) + 1, None, ""
            name = TAG_NAME.match(text, start + 1)
            if name:
                end = self.end(name.end())
                return start, end + 1, name, text[name.end():end]
            at = start + 1
        return None

    def end(self, at: int) -> int:
        """The ">" that ends a tag: the first that is in no attribute's quotes."""
        text, begin, first = self.text, at, at
        while self.quoted and (sign := TAG_SIGN.search(text, at)):
            here = sign.start()
            if sign[0] == ">":
                return here
            at = here + 1
            if self.closed[sign[0]] and text[begin:here].rstrip()[-1:] == "=":
                close = text.find(sign[0], at)
                if close < 0:
                    self.closed[sign[0]] = False  # an open quote is read as any character
                else:
                    at = close + 1
            begin = at
        self.quoted = False  # quotes that swallow all the rest are none
        return text.find(">", first)


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in ATTRS.findall(raw)} if raw.strip(" /") else {}


def is_junk(tag: str, attrs: dict[str, str], in_region: bool) -> bool:
    """Boilerplate by kind of element: what it says is never read."""
    return tag in BOILERPLATE_TAGS or tag == "header" and not in_region


def wraps(tag: str, attrs: dict[str, str]) -> str:
    """What an element is that is boilerplate by kind, unless it holds the page's text: 'whole' (a form around the
    page, an element that a script shows), 'aside' (beside other text) or ''."""
    role = attrs.get("role", "").lower()
    if tag == "aside" or role in LANDMARK_ROLES:
        return "aside"
    if tag in WRAPPING_TAGS or role in WRAPPING_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return "whole"
    return ""


def is_marked(tag: str, attrs: dict[str, str], in_region: bool) -> bool:
    """Boilerplate by a word of class or id, which can be wrong (has-sidebar): it is read, and ``picked`` decides."""
    if not attrs or tag in ("html", "body", "article", "main") or tag == "header" and in_region:
        return False
    words = WORD.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower())
    return any(w in BOILERPLATE_WORDS and not (in_region and w in ("header", "masthead")) for w in words)


def names(attrs: dict[str, str]) -> list[str]:
    return f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()


def parse(text: str) -> tuple[Node, list[Block], list[Mark]]:
    """The element tree, the text blocks in page order, and the marks that hold blocks and no article or main."""
    root = Node("#", "#", False, False)
    root.block = root
    blocks: list[Block] = []
    stack, pieces, at = [root], [], 0
    marks: list[Mark] = []
    inside: list[Mark] = []  # marks of elements on the stack
    glue = False
    opened = Counter()  # tags on the stack: what is not there is not searched for, so any depth is read in linear time

    def close_block(within: bool = False) -> None:
        """``within``: a marked inline element starts or ends here, which is no gap in the text."""
        nonlocal glue
        raw = "".join(pieces)
        said = " ".join(raw.split()) if raw else ""
        if said:
            blocks.append(Block(stack[-1].block, said, glue and not raw[0].isspace()))
            glue = within and not raw[-1].isspace()
        else:
            glue = glue and within and not raw
        pieces.clear()

    def say(raw: str) -> None:
        if raw and not stack[-1].junk:  # what boilerplate says is never read
            pieces.append(entities.unescape(raw) if "&" in raw else raw)

    def pop_to(depth: int) -> None:
        if any(n.tag not in INLINE for n in stack[depth:]):
            close_block()
        elif any(n.mark for n in stack[depth:]):
            close_block(within=True)
        for n in reversed(stack[depth:]):
            if n.mark:
                n.mark.last = len(blocks)
                inside.pop()
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    def find(tag: str) -> int:
        return next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag) if opened[tag] else 0

    tags = Tags(text)
    while found := tags.next(at):
        start, end, m, inner = found
        say(text[at:start])
        at = end
        if m is None:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = find(tag)
            if depth:
                pop_to(depth)
            elif tag not in INLINE:
                close_block()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(text, at)
            at = end.end() if end else len(text)
            if tag not in INLINE:
                close_block()
            continue
        if tag in ENDS_P:
            depth = find("p")
            if depth:
                pop_to(depth)
        if tag in SAME_END and any(opened[t] for t in SAME_END[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SCOPE[tag]:
                    break
                if stack[i].tag in SAME_END[tag]:
                    pop_to(i)
                    break
        if tag in ("br", "hr"):
            pieces.append(" ")
        if tag not in INLINE and tag not in ("br",):
            close_block()
        if tag in VOID or inner.endswith("/") and tag not in ENDS_P:
            continue
        attrs, up = attributes(inner), stack[-1]
        role = attrs.get("role", "").lower()
        # A reader's comment may be an article too; its own class says so.
        region = (tag in ("article", "main") or role in CONTENT_ROLES or attrs.get("itemprop") == "articleBody") and (
            not any(w in ("comment", "reply") for w in WORD.findall(" ".join(names(attrs)))))
        label = tag if not attrs else ".".join(
            [tag, *sorted(WORD.findall(attrs.get("class", "").lower())), *WORD.findall(attrs.get("id", "").lower())])
        control = tag in CONTROL_TAGS and opened["form"] > 0
        node = Node(tag, label, up.junk or control or is_junk(tag, attrs, up.region), up.region or region)
        node.story = up.story or region and (tag == "article" or role == "article")
        if region and not node.junk:
            for mark in reversed(inside):  # outside of a void mark there are only void ones, or a story is around them
                if mark.void or mark.story:
                    break
                mark.void = True
        kind = wraps(tag, attrs)
        if not node.junk and not region and (kind or is_marked(tag, attrs, up.region)):
            if tag in INLINE:
                close_block(within=True)
            node.mark = Mark(len(blocks), kind == "aside" or any(w in COMMENT_WORDS for w in names(attrs)), up.story)
            marks.append(node.mark)
            inside.append(node.mark)
        node.block = up.block if tag in INLINE else node
        if node.block is node:
            up.block.children.append(node)
        stack.append(node)
        opened[tag] += 1
    rest = text[at:]
    cut = re.search(r"<[A-Za-z/!?][^<]*$", rest)  # a tag that the end of the page cuts off
    say(rest[:cut.start()] if cut else rest)
    pop_to(1)
    close_block()
    return root, blocks, [m for m in marks if m.first < m.last and not m.void]


@dataclass(slots=True)
class Shape:
    """A skeleton node: an element, or a run of siblings that look alike."""

    label: str
    nodes: list[Node]
    children: list[Shape] = field(default_factory=list)
    name: str = ""
    size: int = 1
    form: bytes = b""  # digest of the whole subtree's labels


def skeleton(nodes: list[Node]) -> Shape:
    made = [Shape(nodes[0].label, nodes)]
    for shape in made:  # grows by the children; pages nest as deep as they like, so nothing here recurses
        run: list[Node] = []
        kids: list[list[Node]] = []
        seen: dict[str, list[Node]] = {}
        for child in (c for n in shape.nodes for c in n.children):
            if run and run[-1].label == child.label:
                run.append(child)
            elif len(shape.nodes) > 1 and child.label in seen:  # a pattern that alternates (h2 p h2 p) is one node per label too
                run = seen[child.label]
                run.append(child)
            else:
                run = [child]
                kids.append(run)
                seen.setdefault(child.label, run)
        shape.children = [Shape(group[0].label, group) for group in kids]
        made += shape.children
    for shape in reversed(made):
        shape.size = 1 + sum(c.size for c in shape.children)
        shape.form = hashlib.blake2b(b"".join([shape.label.encode("utf-8", "replace"), b"\0", *(c.form for c in shape.children)]),
                                     digest_size=16).digest()
    return made[0]


def ends(a: list[Shape], b: list[Shape]) -> tuple[int, int]:
    """How many first and last siblings are alike: these belong together in a largest common subtree."""
    least, head, tail = min(len(a), len(b)), 0, 0
    while head < least and a[head].form == b[head].form:
        head += 1
    while tail < least - head and a[-1 - tail].form == b[-1 - tail].form:
        tail += 1
    return head, tail


def match(a: Shape, b: Shape, memo: dict) -> int:
    """Simple tree matching: the size of the largest common top-down ordered subtree."""
    todo = [(a, b, False)]
    while todo:
        x, y, ready = todo.pop()
        key = (x.form, y.form)
        if key in memo:
            continue
        if x.label != y.label or x.form == y.form:
            memo[key] = x.size if x.form == y.form else 0
            continue
        head, tail = ends(x.children, y.children)
        left, right = x.children[head:len(x.children) - tail], y.children[head:len(y.children) - tail]
        if ready:
            alike = sum(c.size for c in x.children[:head]) + sum(c.size for c in x.children[len(x.children) - tail:])
            memo[key] = 1 + alike + (Grid(left, right, memo).best() if left and right else 0)
            continue
        todo.append((x, y, True))
        by_label: dict[str, dict[bytes, Shape]] = {}
        for c in right:
            by_label.setdefault(c.label, {})[c.form] = c
        for c in {c.form: c for c in left}.values():
            todo += [(c, d, False) for d in by_label.get(c.label, {}).values() if (c.form, d.form) not in memo]
    return memo[a.form, b.form]


class Grid:
    """The alignment of two sibling lists, whose pairs' matches are in ``memo``, row by row: cell j of row i is
    the most that the first i of ``left`` and the first j of ``right`` have in common."""

    def __init__(self, left: list[Shape], right: list[Shape], memo: dict):
        self.left, self.right, self.memo = left, right, memo
        kinds = {y.form: y for y in right}
        self.by_label: dict[str, list[tuple[int, bytes]]] = {}
        for k, y in enumerate(kinds.values()):
            self.by_label.setdefault(y.label, []).append((k, y.form))
        number = {form: k for k, form in enumerate(kinds)}
        self.kind = np.array([number[y.form] for y in right], int)
        self.start = np.zeros(len(right) + 1, int)

    def after(self, row: np.ndarray, x: Shape) -> np.ndarray:
        got = np.zeros(len(self.kind), int)
        for k, form in self.by_label.get(x.label, ()):
            got[k] = self.memo[x.form, form]
        out = np.zeros_like(row)
        np.maximum.accumulate(np.maximum(row[1:], row[:-1] + got[self.kind]), out=out[1:])
        return out

    def best(self) -> int:
        row = self.start
        for x in self.left:
            row = self.after(row, x)
        return int(row[-1])

    def pairs(self) -> list[tuple[Shape, Shape]]:
        """Every ``span``th row is kept and those between are made again, so long lists need little memory."""
        span = isqrt(len(self.left)) + 1
        kept, row = [], self.start
        for i, x in enumerate(self.left):
            if i % span == 0:
                kept.append(row)
            row = self.after(row, x)
        out, base, rows = [], len(self.left) + 1, []
        i, j = len(self.left), len(self.right)
        while i and j:
            if i <= base:
                base = (i - 1) // span * span
                rows = [kept[base // span]]
                for x in self.left[base:i]:
                    rows.append(self.after(rows[-1], x))
            x, y = self.left[i - 1], self.right[j - 1]
            here, above = rows[i - base], rows[i - 1 - base]
            got = self.memo[x.form, y.form] if x.label == y.label else 0
            if got and here[j] == above[j - 1] + got:
                out.append((x, y))
                i, j = i - 1, j - 1
            elif here[j] == above[j]:
                i -= 1
            else:
                j -= 1
        return out


def align(ref: Shape, page: Shape, memo: dict) -> None:
    """Name the page's nodes after the nodes of the reference they match."""
    match(ref, page, memo)
    page.name = ref.name
    todo = [(ref, page)]
    while todo:
        ref, page = todo.pop()
        pairs = pairs_of(ref.children, page.children, memo)
        for r, p in pairs:
            p.name = r.name
        todo += pairs
        met = {id(p) for _, p in pairs}
        for p in page.children:
            if id(p) not in met:
                name_new(p, step(page.name, f"+{p.label}"))


def pairs_of(ref: list[Shape], page: list[Shape], memo: dict) -> list[tuple[Shape, Shape]]:
    head, tail = ends(ref, page)
    alike = [*zip(ref[:head], page[:head]), *zip(ref[len(ref) - tail:], page[len(page) - tail:])]
    left, right = ref[head:len(ref) - tail], page[head:len(page) - tail]
    return alike + Grid(left, right, memo).pairs() if left and right else alike


def step(name: str, below: str) -> str:
    """A name of fixed length for the path to a node, however deep."""
    return hashlib.blake2b(f"{name}/{below}".encode("utf-8", "replace"), digest_size=9).hexdigest()


def name_new(shape: Shape, name: str) -> None:
    shape.name = name
    todo = [shape]
    while todo:
        above = todo.pop()
        for i, c in enumerate(above.children):
            c.name = step(above.name, f"{i}{c.label}")
        todo += above.children


def hand_down(shape: Shape) -> None:
    todo = [shape]
    while todo:
        above = todo.pop()
        for n in above.nodes:
            n.name = above.name
        todo += above.children


def reference(text: str) -> Shape:
    root, _, _ = parse(text)
    shape = skeleton([root])
    name_new(shape, "#")
    return shape


def page_of(text: str | None, ref: Shape) -> tuple[list[tuple[str, str, str, int, str, bool]], list[tuple[int, int, bool]]]:
    """(region, node, text's hash, characters, text, glued) of each block, and (first, last, comments) of each mark.

    The region is 'content' in article or main, else 'rest', with 'marked ' before it in a mark.
    """
    root, blocks, marks = parse(text or "")
    shape = skeleton([root])
    align(ref, shape, {})
    hand_down(shape)
    marked = covered(len(blocks), [(m.first, m.last) for m in marks])
    out = []
    for b, under in zip(blocks, marked):
        digest = hashlib.blake2b(b.text.encode("utf-8", "replace"), digest_size=12).hexdigest()
        region = ("marked " if under else "") + ("content" if b.node.region else "rest")
        out.append((region, b.node.name, digest, len(b.text), b.text, b.glued))
    return out, [(m.first, m.last, m.comments) for m in marks]


def blocks_of(text: str | None, ref: Shape) -> list[tuple[str, str, str, int, str, bool]]:
    return page_of(text, ref)[0]


def covered(n: int, spans: list[tuple[int, int]]) -> list[bool]:
    """For each of ``n`` positions whether a span has it."""
    change = [0] * (n + 1)
    for first, last in spans:
        change[first] += 1
        change[last] -= 1
    return [depth > 0 for depth in accumulate(change)][:n]


BLOCKS = ("page_id long, url string, host string, blocks array<struct<region:string,node:string,digest:string,chars:int,text:string,"
          "glued:boolean>>, marks array<struct<first:int,last:int,comments:boolean>>")


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))


def aligned_blocks(pages: DataFrame, max_broadcast_bytes: int = 32 << 20) -> DataFrame:
    """The columns of BLOCKS, one row per page, nodes named by the host's reference page.

    The names of the references, and then their pages, are broadcast if they
    have ``max_broadcast_bytes`` in all at most; else pages and references meet
    in a shuffled join.
    """
    ship_package(pages.sparkSession)
    hosted = with_host(pages)
    # Which page is a host's reference is known before any html moves; then only references do.
    first = stage(hosted.groupBy(F.col("host").alias("ref_host")).agg(F.min("page_id").alias("ref_page")), "hosts")
    size = first.agg(F.sum(F.octet_length("ref_host") + 16)).first()[0] or 0
    named = F.broadcast(first) if size <= max_broadcast_bytes else first
    refs = stage(hosted.join(named, (F.col("host") == F.col("ref_host")) & F.col("page_id").eqNullSafe(F.col("ref_page")))
                 .groupBy("host").agg(F.min("html").alias("ref_html")), "references")
    size = refs.agg(F.sum(F.octet_length("ref_html") + F.octet_length("host"))).first()[0] or 0
    side = F.broadcast(refs) if size <= max_broadcast_bytes else refs

    def run(batches):
        known: dict[str, Shape] = {}
        for batch in batches:
            rows = []
            for page, url, html, host, ref in batch.itertuples(index=False, name=None):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = reference(ref or "")
                rows.append((page, url, host, *page_of(html, known[host])))
                if len(rows) == 500:
                    yield out(rows)
                    rows = []
            if rows:
                yield out(rows)

    def out(rows):
        made = pd.DataFrame(rows, columns=["page_id", "url", "host", "blocks", "marks"])
        made["page_id"] = made["page_id"].astype("Int64")
        made["blocks"] = [[dict(zip(("region", "node", "digest", "chars", "text", "glued"), b)) for b in bs] for bs in made["blocks"]]
        made["marks"] = [[dict(zip(("first", "last", "comments"), m)) for m in ms] for ms in made["marks"]]
        return made

    return hosted.join(side, "host").select("page_id", "url", "html", "host", "ref_html").mapInPandas(run, BLOCKS)


def wrappers(blocks: DataFrame, same: float = 0.9, min_pages: int = 2) -> DataFrame:
    """(host, template): the (node, digest) pairs of the host's template nodes.

    A node is template if one text of it is on at least ``same`` of the host's
    pages, of which there are at least ``min_pages``.
    """
    # A text counts once per page.
    each = blocks.select("host", F.explode(F.expr(
        "array_distinct(transform(blocks, b -> struct(b.node as node, b.digest as digest)))")).alias("b")).select("host", "b.*")
    texts = each.groupBy("host", "node", "digest").agg(F.count("*").alias("pages"))
    pages = blocks.groupBy("host").agg(F.count("*").alias("all")).where(F.col("all") >= min_pages)
    fixed = texts.where(F.col("pages") >= same * min_pages).join(pages, "host").where(F.col("pages") >= same * F.col("all"))
    return fixed.groupBy("host").agg(
        F.collect_set(F.concat_ws(" ", "node", "digest")).alias("template"))  # at most 1 / same per node of a page


def picked(semantic: list[bool], chars: list[int], fixed: list[bool], marks: list[tuple[int, int, bool]]) -> list[int]:
    """The positions of the blocks that are a page's main text, in page order.

    A mark that holds most of the varying text is none, unless it is readers'
    comments or an aside and there is other varying text.
    """
    if marks:
        sums = [0, *accumulate(0 if same else n for n, same in zip(chars, fixed))]
        if not sums[-1]:
            sums = [0, *accumulate(chars)]
        held = [(first, last, sums[last] - sums[first], comments) for first, last, comments in marks]
        marked = covered(len(chars), [(first, last) for first, last, n, comments in held
                                      if 2 * n <= sums[-1] or comments and n < sums[-1]])
    else:
        marked = [False] * len(chars)
    live = [i for i, under in enumerate(marked) if not under]
    mine = [i for i in live if semantic[i]] or live
    fresh = [i for i in mine if not fixed[i]]
    return fresh if 2 * sum(chars[i] for i in fresh) > sum(chars[i] for i in mine) else mine


def extract(pages: DataFrame, **params) -> DataFrame:
    """page_id, url, text of every page."""
    blocks = stage(aligned_blocks(pages), "blocks")
    wrapper = stage(wrappers(blocks, **params), "wrappers")

    @F.pandas_udf("array<int>")
    def picked_of(semantic: pd.Series, chars: pd.Series, fixed: pd.Series, first: pd.Series, last: pd.Series, comments: pd.Series) -> pd.Series:
        return pd.Series([picked(a, b, c, list(zip(*marks))) for a, b, c, *marks in zip(semantic, chars, fixed, first, last, comments)],
                         dtype=object)

    template = F.coalesce("template", F.array().cast("array<string>"))
    mine = picked_of(F.transform("blocks", lambda b: b["region"].endswith("content")), F.col("blocks.chars"),
                     F.transform("blocks", lambda b: F.array_contains(template, F.concat_ws(" ", b["node"], b["digest"]))),
                     F.col("marks.first"), F.col("marks.last"), F.col("marks.comments"))
    said = blocks.join(wrapper, "host", "left").withColumn("mine", mine)
    kept = F.transform("mine", lambda i: F.get("blocks", i))
    parts = F.transform(kept, lambda b: F.concat(F.when(b["glued"], "").otherwise(" "), b["text"]))
    return said.select("page_id", "url", F.ltrim(F.array_join(parts, "")).alias("text"))


def report(pages: DataFrame, **params) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return extract(pages, **params).withColumn("n_chars", F.length("text").cast("long"))
