"""Main text of web pages by wrapper induction.

Pages of one host and layout (the path of the article or main element) come
out of one template. Each page's DOM is reduced to its blocks (inline markup is
part of a block's text) and aligned with its layout's reference page by simple
tree matching: the largest order-preserving matching of equal labels, level by
level. A reference node whose text is the same in most of the pages that align
with it is constant and becomes template; so does a block that the reference
lacks and that stands at the same path with the same text in as many pages. Nodes whose text varies are slots and become content. Exact copies of a
page vote once.

Elements and class names that say what they are bound the induction on both
sides: navigation, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments never are content, and where a page has an
``article`` or ``main`` element the possible slots are the blocks inside it.
(There only whole class names and roles count, no parts of them and no ids; and
reader comments go by their container: an element whose id or class says
comments and nothing else, if it is a list by name or if a name or date stands
in it. Headings are anchors and no containers.)
Inside such an element a block is template only if it is the same in nine of
ten of the different pages (three at least, so in all of up to nine). Pages of near-equal content have
one vote together: those whose own blocks (not the same as the reference's)
repeat half of their words (pairs of words from eight words on) from the
reference vote with it, the others by the smallest hash of these. What copies
of an article share is thus no template, however long or short articles are.

The reference of a layout is a page at the lower quartile of its pages' lengths
(ties: the smallest id): long enough to hold the template, short enough to
align fast. Every page is aligned with one page, so a host with a third of all
pages is spread over all tasks; votes are summed before they are shuffled.

Defined results: null or empty html gives an empty text; a null url is a host
of its own. Broken markup is read as far as it goes: an unclosed tag at the
end is dropped, an unclosed element ends with its parent. A page that holds
nothing but its layout's template has an empty text. Repeated rows each give
their row. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import bounded_batches, materialize

FEW_WORDS = 8  # texts under so many words are compared by words, others by pairs of words
CONSTANT_SHARE = 0.5  # of a host's different pages in which a template node has one text
CONSTANT_PAGES = 3  # and at least in so many
INSIDE_SHARE, INSIDE_PAGES = 0.9, 3  # the same inside an article or main element (so all of up to nine)

_RAW = "script|style|title|textarea|iframe|noframes|noembed|xmp"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_UNENDED = re.compile(r"<[a-zA-Z/!?]")
_LOOSE = re.compile(r"<[a-zA-Z/!?][^>]*>")  # a tag with an open quote, as far as its first >
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_CLASS = re.compile(r"(?<![\w-])(class)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_NUMBER = re.compile(r"[0-9]+")
_PART = re.compile(r"[a-z0-9]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output picture "
    "progress q rb rp rt rtc ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "nav header footer aside form script style noscript template iframe object embed svg canvas audio video button "
    "select textarea input dialog menu head title fieldset".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Parts of a class, id or role that say the element is no content. Inside an
# article or main element only whole classes and roles do, the votes decide on
# the rest; the id of a heading is its anchor.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer contentinfo complementary cookie cookies consent notice popup modal newsletter "
    "subscribe share sharing social related comment comments reply replies disqus widget toolbar pagination pager "
    "login signup search".split()
)
# Inside an article these name sections of its own as often; the votes decide.
INSIDE = BOILERPLATE - frozenset("search related share sharing social".split())
ROLES = INSIDE | frozenset(("search",))  # a role says what its element is
HEADERS = frozenset("header masthead topbar".split())  # outside an article
# Inside an article an id or class of these parts alone names reader comments:
# by itself if it says that it is a list of them, else if somebody's name or a
# date stands in it.
COMMENTS = frozenset("comment comments reply replies response responses disqus".split())
COMMENT_LISTS = frozenset("list section area thread wrap wrapper container box form count commentlist commentarea".split())
SIGNED = frozenset("author avatar byline commenter date datetime posted time timestamp user username vcard".split())
MAIN = frozenset(("article", "main"))
NOT_MAIN = frozenset("comment comments reply replies ad ads advert sponsored promo related".split())
# Elements that an opening tag of the same group ends.
_ENDS: dict[str, frozenset[str]] = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
_WALLS = frozenset("ul ol dl table div section article main body html form nav header footer aside".split())


class Node:
    """A block element or a run of text in one. A leaf has a text, others have children."""

    __slots__ = ("tag", "label", "children", "text", "number", "content", "inside", "path", "signed")

    def __init__(self, tag: str, label: str, content: bool, inside: bool, path: int = 0):
        self.tag, self.label = tag, label
        self.children: list[Node] = []
        self.text: str | None = None
        self.number = -1
        self.content = content  # nothing around it says that it is no content
        self.inside = inside  # within an article or main element
        self.path = path  # hash of the steps from the root
        self.signed: bool | None = None  # of what may be reader comments: whether a name or date stands in it


def _value(match: re.Match) -> str:
    return match[2] or match[3] or match[4] or ""


def _is_boilerplate(tag: str, attributes: str, inside: bool) -> bool:
    if tag in NEVER:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    parts: set[str] = set()
    for m in _NAMED.finditer(attributes):
        if m[1].lower() == "id" and (inside or tag in HEADINGS):
            continue
        value = _value(m).lower()
        if inside and m[1].lower() == "role" and not ROLES.isdisjoint(value.split()):
            return True
        parts.update(value.split() if inside else _PART.findall(value))
    if tag in MAIN:
        return not parts.isdisjoint(NOT_MAIN)
    return not parts.isdisjoint(INSIDE if inside else BOILERPLATE) or (not inside and not parts.isdisjoint(HEADERS))


def _comments(tag: str, attributes: str) -> bool | None:
    """Whether an element of an article is named as reader comments: ``True`` by its name alone,
    ``False`` if what stands in it decides, ``None`` if not."""
    if not attributes or tag in HEADINGS or tag in MAIN:
        return None
    named = None
    for m in _NAMED.finditer(attributes):
        for token in _value(m).lower().split():
            parts = set(_PART.findall(token))
            if parts & {"commentlist", "commentarea"} or (parts & COMMENTS and parts & COMMENT_LISTS and parts <= COMMENTS | COMMENT_LISTS):
                return True
            if parts and parts <= COMMENTS:
                named = False
    return named


def _signed(tag: str, attributes: str) -> bool:
    """Whether a tag marks somebody's name or a date."""
    if tag == "time":
        return True
    parts = {p for m in _CLASS.finditer(attributes or "") for p in _PART.findall(_value(m).lower())}
    return not parts.isdisjoint(SIGNED)


def _step(tag: str, names: str) -> bytes:
    """An element on a path: its tag and first class, numbers in it left out."""
    first = names.split(None, 1)[:1]
    return (f"/{tag}.{_NUMBER.sub('#', first[0])}" if first and tag not in ("html", "body") else f"/{tag}").encode(
        "utf-8", "surrogatepass"
    )


def _plain(piece: str) -> str:
    """Text between two tags: what is left of broken ones dropped, references decoded."""
    if "<" in piece:
        piece = _LOOSE.sub("", piece)
    return unescape(piece) if "&" in piece else piece


def layout_of(page: str | None) -> int:
    """Hash of the path to the article or main element of a page's first content there (none: 0)."""
    return parse(page, True)[2]


def parse(page: str | None, layout_only: bool = False) -> tuple[Node, list[Node], int]:
    """The tree of a page's blocks, its leaves in order, and its depth (or, read no further than needed, its layout)."""
    root = Node("#root", "#root", True, False)
    stack, buffer = [root], []
    hidden = 0  # depth of inline elements that are no content
    open_hidden: list[str] = []
    deepest = 1
    layout = 0
    doubtful: list[Node] = []  # open elements that may be reader comments
    page = page or ""

    def flush() -> None:
        nonlocal layout
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                top = stack[-1]
                leaf = Node("#text", "#text", top.content, top.inside, top.path)
                if not layout and top.inside and top.content:
                    layout = next(x.path for x in reversed(stack) if x.tag in MAIN)
                leaf.text = text
                top.children.append(leaf)

    def close(depth: int) -> None:
        """End open elements until ``depth`` are left."""
        flush()
        while len(stack) > depth:
            done = stack.pop()
            if doubtful and doubtful[-1] is done:
                doubtful.pop()
            if len(done.children) == 1 and done.children[0].tag == "#text":
                done.text = done.children[0].text
                done.children = []

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at and not hidden:
            buffer.append(_plain(page[at : token.start()]))
        at = token.end()
        if layout_only and layout:
            return root, [], layout
        if not token[3]:
            continue  # a comment, a declaration or an element of raw text
        tag = token[3].lower()
        if not token[2]:
            if doubtful and _signed(tag, token[4]):
                for node in doubtful:
                    node.signed = True
            if tag in INLINE:
                if tag == "br":
                    if not hidden:
                        buffer.append(" ")
                elif hidden or (token[4] and _is_boilerplate(tag, token[4], stack[-1].inside)):
                    if tag not in VOID and not token[4].endswith("/"):
                        hidden += 1
                        open_hidden.append(tag)
                continue
            hidden = 0
            open_hidden.clear()
            ends = _ENDS.get(tag)
            flush()
            for depth in range(len(stack) - 1, 0, -1):
                inner = stack[depth].tag
                if inner == "p" or (ends and inner in ends):
                    close(depth)
                    if inner != "p" or not ends:
                        break
                elif inner in _WALLS:
                    break
            parent = stack[-1]
            named = _CLASS.search(token[4]) if token[4] else None
            inside = parent.inside or tag in MAIN
            names = _value(named).lower() if named else ""
            node = Node(
                tag,
                f"{tag}.{names}" if named else tag,
                parent.content and not _is_boilerplate(tag, token[4], parent.inside),
                inside,
                zlib.crc32(_step(tag, names), parent.path),
            )
            if tag in MAIN and not node.content:
                node.inside = parent.inside
            if node.content and parent.inside:
                node.signed = _comments(tag, token[4])
            if tag not in VOID:
                if node.signed is False:
                    doubtful.append(node)
                parent.children.append(node)
                stack.append(node)
                deepest = max(deepest, len(stack))
        elif tag in INLINE:
            if open_hidden and tag in open_hidden:
                while open_hidden.pop() != tag:
                    pass
                hidden = len(open_hidden)
        else:
            flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    hidden = 0
                    open_hidden.clear()
                    break
    if not hidden:
        rest = _LOOSE.sub("", page[at:])
        unended = _UNENDED.search(rest)
        buffer.append(_plain(rest[: unended.start()] if unended else rest))
    close(1)
    flush()
    if layout_only:
        return root, [], layout
    leaves: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node.signed:
            node.content = False
        if not node.content:
            for child in node.children:
                child.content = False
        if node.text is not None:
            node.number = len(leaves)
            leaves.append(node)
        todo.extend(reversed(node.children))
    return root, leaves, deepest


def _match_children(a: Node, b: Node, memo: dict) -> int:
    """Weight of the best matching below two nodes of one label; the matched pairs go to ``memo``."""
    key = (id(a), id(b))
    if key in memo:
        return memo[key][0]
    left, right = a.children, b.children
    pairs: list[tuple[Node, Node]] = []
    low, high = 0, 0
    most = min(len(left), len(right))
    same = lambda x, y: x.text is not None and x.text == y.text and x.label == y.label
    while low < most and same(left[low], right[low]):
        low += 1
    while high < most - low and same(left[-1 - high], right[-1 - high]):
        high += 1
    pairs += zip(left[:low], right[:low])
    if high:
        pairs += zip(left[-high:], right[-high:])
    weight = 2 * (low + high)
    xs, ys = left[low : len(left) - high], right[low : len(right) - high]
    if xs and ys:
        codes: dict[str, int] = {}
        code = lambda v: codes.setdefault(v, len(codes))
        y_label = np.array([code(y.label) for y in ys])
        y_text = np.array([code("=" + y.text) if y.text is not None else -1 for y in ys])
        y_inner = [j for j, y in enumerate(ys) if y.text is None]

        def rows(first: int, last: int, best: np.ndarray, keep: bool):
            """Best weights behind ``xs[first:last]``, and for each cell whether it was taken or skipped."""
            taken = np.zeros((last - first, len(ys)) if keep else (0, 0), dtype=bool)
            skipped = np.zeros_like(taken)
            for i in range(first, last):
                x = xs[i]
                gain = (y_label == codes.get(x.label, -2)).astype(np.int64)
                if x.text is not None:
                    gain += gain * (y_text == codes.get("=" + x.text, -2))
                else:
                    for j in y_inner:
                        if gain[j]:
                            gain[j] += _match_children(x, ys[j], memo)
                through = np.where(gain > 0, best[:-1] + gain, -1)
                row = np.maximum.accumulate(np.maximum(through, best[1:]))
                if keep:
                    taken[i - first] = (through == row) & (through > 0)
                    skipped[i - first] = best[1:] == row  # leaving x out is as good
                best = np.concatenate(([0], row))
            return best, taken, skipped

        # The choices of all cells are too many for long lists: the weights before every
        # ``step`` rows are kept, and the choices made again, step by step from the end.
        step = len(xs) if len(xs) * len(ys) <= _CELLS else max(1, math.isqrt(len(xs)))
        edges = list(range(0, len(xs), step))
        starts, best = [], np.zeros(len(ys) + 1, dtype=np.int64)
        for first in edges:
            starts.append(best)
            if len(edges) > 1:
                best = rows(first, min(first + step, len(xs)), best, False)[0]
        j, final = len(ys) - 1, None
        for first, start in zip(reversed(edges), reversed(starts)):
            end, taken, skipped = rows(first, min(first + step, len(xs)), start, True)
            final = int(end[-1]) if final is None else final
            i = len(taken) - 1
            while i >= 0 and j >= 0:
                if skipped[i, j]:
                    i -= 1
                elif taken[i, j]:
                    pairs.append((xs[first + i], ys[j]))
                    i, j = i - 1, j - 1
                else:
                    j -= 1
        weight += final
    memo[key] = (weight, pairs)
    return weight


def align(reference: Node, page: Node, depth: int) -> dict[int, tuple[int, bool]]:
    """Leaf of ``page`` -> (leaf of ``reference``, whether the text is the same)."""
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(max(limit, 4 * depth + 1000))  # plain frames, on the heap
    try:
        memo: dict = {}
        _match_children(page, reference, memo)
    finally:
        sys.setrecursionlimit(limit)
    found, todo = {}, [(page, reference)]
    while todo:
        x, y = todo.pop()
        if x.text is not None and y.text is not None:
            found[x.number] = (y.number, x.text == y.text)
        elif x.text is None and y.text is None:
            todo.extend(memo.get((id(x), id(y)), (0, ()))[1])
    return found


_CELLS = 4_000_000  # of an alignment whose choices are all kept
_REFERENCES: OrderedDict[str, tuple[Node, int, np.ndarray, np.ndarray]] = OrderedDict()  # parsed, of this worker process
_KEPT = 200


def _possible(leaves: list[Node]) -> tuple[bool, list[Node]]:
    """Whether a page marks its main part, and its possible blocks."""
    marked = any(x.content and x.inside for x in leaves)
    return marked, [x for x in leaves if x.content and (x.inside or not marked)]


def _grams(texts: list[str], size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words of the texts, one after the other."""
    words = " ".join(texts).encode("utf-8", "surrogatepass").split(b" ")
    runs = words if size == 1 else map(b" ".join, zip(words, words[1:]))
    return np.fromiter(map(zlib.crc32, runs), dtype=np.uint32)


def _reference(html: str) -> tuple[Node, int, np.ndarray, np.ndarray]:
    """Tree and depth of a reference, and the different words and pairs of words of its blocks."""
    if html in _REFERENCES:
        _REFERENCES.move_to_end(html)
        return _REFERENCES[html]
    root, leaves, depth = parse(html)
    texts = [x.text for x in _possible(leaves)[1]]
    _REFERENCES[html] = made = (root, depth, np.unique(_grams(texts, 1)), np.unique(_grams(texts, 2)))
    if len(_REFERENCES) > _KEPT:
        _REFERENCES.popitem(last=False)
    return made


def cluster_of(own: list[str], n_blocks: int, words: np.ndarray, pairs: np.ndarray) -> int:
    """Pages of one number vote together: -1 with the reference, whose words these are."""
    if not own:
        return -1
    few = sum(t.count(" ") + 1 for t in own) < FEW_WORDS
    grams = _grams(own, 1 if few else 2)
    known = 2 * int(np.isin(grams, words if few else pairs).sum())
    if known > len(grams) or (known == len(grams) and 2 * len(own) < n_blocks):
        return -1
    return int((_grams(own, 2) if few and len(grams) > 1 else grams).min())


def blocks_of(html: str | None, reference: str | None) -> tuple[bool, list[tuple[str, int]], int]:
    """Whether the page marks its main part, its possible blocks ``(text, key)``, and its cluster.

    The key is a hash of path and text, and 0 for a block that repeats one
    which the alignment matches: that one is the template's.
    """
    root, leaves, depth = parse(html)
    marked, possible = _possible(leaves)
    aligned: dict[int, tuple[int, bool]] = {}
    if reference is not None:
        base, base_depth, words, pairs = _reference(reference)
        aligned = align(base, root, max(depth, base_depth))
    same = {x.number for x in possible if aligned.get(x.number, (-1, False))[1]}
    keys = {
        x.number: int.from_bytes(
            hashlib.blake2b(x.text.encode("utf-8", "surrogatepass"), digest_size=8, salt=x.path.to_bytes(4)).digest()
        ) >> 1 | 1
        for x in possible
    }
    matched = {keys[n] for n in same}
    blocks = [(x.text, 0 if x.number not in same and keys[x.number] in matched else keys[x.number]) for x in possible]
    own = [x.text for x in possible if x.number not in same]
    if marked and reference is not None:
        return marked, blocks, cluster_of(own, len(blocks), words, pairs)
    digest = hashlib.blake2b("\n".join(b[0] for b in blocks).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return marked, blocks, int.from_bytes(digest, signed=True)


ALIGNED = "page_id long, url string, site long, marked boolean, cluster long, blocks array<struct<text:string,key:long>>"


def _align_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for page_id, url, site, html, reference in zip(*(batch[c] for c in ("page_id", "url", "site", "html", "reference"))):
            marked, blocks, cluster = blocks_of(html, reference)
            rows.append((page_id, url, site, marked, cluster, [{"text": t, "key": key} for t, key in blocks]))
        frame = pd.DataFrame(rows, columns=["page_id", "url", "site", "marked", "cluster", "blocks"])
        yield frame.astype({"page_id": "Int64"})


def references(pages: DataFrame) -> DataFrame:
    """``site, reference``: a page at the lower quartile of each site's page lengths."""
    lengths = materialize(
        pages.filter("html <> ''").select("site", "page_id", F.length("html").alias("length")), "lengths"
    )
    middle = lengths.groupBy("site").agg(F.percentile_approx("length", 0.25, 10_000).alias("length"))
    chosen = materialize(lengths.join(middle, ["site", "length"]).groupBy("site", "length").agg(
        F.min("page_id").alias("chosen")
    ), "chosen")
    fetched = pages.join(chosen, "site").filter(
        (F.length("html") == F.col("length")) & F.col("page_id").eqNullSafe(F.col("chosen"))
    )
    return materialize(fetched.groupBy("site").agg(F.min("html").alias("reference")), "references")


def extract(pages: DataFrame, share: float = CONSTANT_SHARE, least: int = CONSTANT_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``."""
    bounded_batches(pages.sparkSession)

    @F.pandas_udf("long")
    def layouts(htmls: pd.Series) -> pd.Series:
        return pd.Series([layout_of(h) for h in htmls], dtype="int64")

    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.xxhash64(host, layouts("html")).alias("site")
    )
    aligned = materialize(
        own.join(references(own), "site", "left")
        .select("page_id", "url", "site", "html", "reference")
        .mapInPandas(_align_all, ALIGNED),
        "aligned",
    )
    different = (
        aligned.select("site", "marked", "cluster").distinct().groupBy("site", "marked").agg(F.count("*").alias("pages"))
    )
    votes = (
        aligned.select("site", "marked", "cluster", F.explode("blocks.key").alias("key"))
        .filter("key <> 0")
        .distinct()
        .groupBy("site", "marked", "key")
        .agg(F.count("*").alias("equal"))
    )
    enough = F.when(F.col("marked"), INSIDE_PAGES).otherwise(least)
    often = F.when(F.col("marked"), INSIDE_SHARE).otherwise(share) * F.col("pages")
    template = materialize(
        votes.filter(F.col("equal") >= enough)
        .join(different, ["site", "marked"])
        .filter(F.col("equal") >= often)
        .groupBy("site", "marked")
        .agg(F.collect_set("key").alias("template")),
        "template",
    )
    texts = lambda blocks: F.array_join(F.transform(blocks, lambda b: b["text"]), "\n")
    varying = F.filter("blocks", lambda b: ~F.array_contains("template", b["key"]))
    text = F.when(F.col("template").isNull(), texts(F.col("blocks"))).otherwise(texts(varying))
    return aligned.join(template, ["site", "marked"], "left").select(
        "page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars")
    )
