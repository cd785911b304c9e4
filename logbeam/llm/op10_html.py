"""Operator 10: HTML extraction by wrapper induction.

Each page becomes a tree; its *shape* is the tree of block elements with
repeated siblings merged, its text leaves are slots (``dom.py``).  Of each
host the commonest shape is the wrapper, and every other shape of the host is
aligned with it by simple tree matching, so each slot of a page is a slot of
the wrapper or one of its own.  A block of text that stands in its slot on
every page of the host that has the slot is template, everything else content.

Mark-up says first what is not the article (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments), by tag, role, and
class words or id, and where the page marks its article or main part only that
counts.  A class word must be a whole class, with at most a word of place in
front and of kind behind it (``site-header``, ``cookie-notice``, ``ad-slot``),
so ``social-science`` or ``share-price`` mean nothing.  But for
comments, it says nothing of an outermost article or main part, nor of an element
outside them that holds such a part or more than half of the page's text.  What is left
is the page's content, and template blocks are taken out of it, inside the
article as elsewhere; headings of an article are its own and stay.

Pages of one host may be copies of each other, which does not make their text
a template.  So pages with the same content count once, and blocks are template
if all the different pages that have the slot, two or more, have them, and if
such blocks are less than half of the host's text (``MAX_SHARE``): a template
is what frames the texts.  This errs where two or more pages of a host share a
smaller part word for word in the same slot and no other page has that slot.

Pages never meet in one task: shapes and blocks are reduced to counts by
partial aggregation, the matching runs once per distinct (host, shape), and
its verdict goes back to the pages by id.

Edge cases: null or empty html gives an empty text; very long pages and deep
trees are read whole; of shapes with as many pages the greater text is the wrapper;
an empty table gives no rows; a url that is null or has
no host belongs to the host ``""``; repeated rows are repeated in the result; a
null page_id is kept; malformed mark-up is read as far as it goes; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dom
from .common import arrow_map, join_null_safe, saved, small

#: Text that all pages share is template if it is a smaller share of the host's text.
MAX_SHARE = 0.5

# What mark-up declares not to be the article.
NOT_ARTICLE = frozenset(
    "head nav header footer aside form script style noscript template iframe object svg math canvas audio video button "
    "select textarea input dialog menu title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tooltip".split())
FRAME = "site|page|main|top|bottom|left|right|global|primary|secondary|sub|cookie|privacy|user|reader|article|post|blog|google|sticky|mobile|desktop"
KIND = (
    "box|bar|area|wrap(?:per)?|container|list|section|links?|buttons?|icons?|banner|notice|block|widget|menu|form|slot|unit|popup|overlay|consent|"
    "inner|outer|content|\\d+")


def _word(words: str) -> re.Pattern:
    return re.compile(rf"(?:(?:{FRAME})[-_])?(?:{words})(?:[-_](?:{KIND}))*", re.I)


COMMENTS = _word("comments?|replies|respond|disqus")
NAMES = _word(
    "ads?|advert(?:s|isement|ising)?|sponsor(?:ed|s)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|notification|alert|popup|modal|"
    "overlay|newsletter|subscribe|signup|share|sharing|social|related|recommended|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|header|"
    "masthead|footer|login|search|pagination|pager|skip-?link|widget")
ARTICLE_NAMES = re.compile(r"(?:^|\s)(?:article(?:-body)?|post-content|entry-content|main-content|content|story-body)(?:$|\s)", re.I)


@lru_cache(4096)
def _declared(tag: str, attrs: str) -> tuple[str, str]:
    """What tag and attributes say: "out", "comments", "words" or ""; and of
    which part the element is: "article", "main", "named" or ""."""
    if tag in NOT_ARTICLE:
        return "out", ""
    a = dom.attributes(attrs) if attrs else {}
    names = f"{a.get('class', '')} {a.get('id', '')}".split()
    if a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden") == "true":
        return "out", ""
    if re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return "out", ""
    part = ""
    if tag == "article" or a.get("itemprop") == "articleBody":
        part = "article"
    elif tag == "main" or a.get("role", "").lower() == "main":
        part = "main"
    if tag in ("html", "body"):
        return "", part
    said = "comments" if any(map(COMMENTS.fullmatch, names)) else "words" if any(map(NAMES.fullmatch, names)) else ""
    if not part and any(map(ARTICLE_NAMES.fullmatch, names)):
        part = "named"
    return said, part


def _weights(root: dom.Node) -> dict[int, tuple[int, bool]]:
    """Of every element: the characters of text below it, without what is
    certainly out, and whether an article or main part is in it."""
    found: dict[int, tuple[int, bool]] = {}
    todo: list[tuple[dom.Node, bool]] = [(root, False)]
    while todo:
        node, done = todo.pop()
        if done:
            size, part = 0, False
            for k in node.kids:
                if isinstance(k, dom.Text):
                    size += len(k.text.strip())
                else:
                    inner, has = found[id(k)]
                    size, part = size + inner, part or has or _declared(k.tag, k.attrs)[1] in ("article", "main")
            found[id(node)] = size, part
        elif _declared(node.tag, node.attrs)[0] == "out":
            found[id(node)] = 0, False
        else:
            todo.append((node, True))
            todo += [(k, False) for k in node.kids if isinstance(k, dom.Node)]
    return found


def _judged(root: dom.Node) -> tuple[set[int], list[dom.Node]]:
    """The elements that are out, and the parts that hold the article: the
    outermost article elements, else main, else elements named as content (all
    outermost ones of the kind); none: the whole page."""
    weights = _weights(root)
    half = weights[id(root)][0] / 2
    out: set[int] = set()
    found: dict[str, list[dom.Node]] = {"article": [], "main": [], "named": []}
    todo: list[tuple[dom.Node, frozenset[str]]] = [(root, frozenset())]
    while todo:
        node, inside = todo.pop()
        said, kind = _declared(node.tag, node.attrs)
        within = "article" in inside or "main" in inside
        size, holds = weights[id(node)]
        spared = said == "words" and not within and (kind in ("article", "main") or holds or size > half)
        if said == "out" or said and not spared:
            out.add(id(node))
            continue
        if kind and kind not in inside:
            found[kind].append(node)
            inside |= {kind}
        todo += [(k, inside) for k in reversed(node.kids) if isinstance(k, dom.Node)]
    return out, found["article"] or found["main"] or found["named"]


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _blocks(part: dom.Node, out: set[int]) -> list[tuple[int, str, bool]]:
    """The part's blocks in page order: slot, text, and whether it is a heading."""
    blocks: list[tuple[list[dom.Text], bool]] = [([], False)]
    todo: list = [part]
    while todo:
        x = todo.pop()
        if isinstance(x, bool):
            blocks.append(([], x))
        elif isinstance(x, dom.Text):
            blocks[-1][0].append(x)
        elif id(x) not in out:
            if x.tag in dom.INLINE:
                todo += reversed(x.kids)
            else:  # a block of its own, line breaks included
                todo += [False, *reversed(x.kids), x.tag in HEADINGS]
    texts = [(b, " ".join("".join(t.text for t in b).split()), heading) for b, heading in blocks]
    return [(next(t.slot for t in b if t.text.strip()), text, heading) for b, text, heading in texts if text]


def _units(root: dom.Node) -> list[tuple[int, str, bool]]:
    """What the page's mark-up leaves: the blocks of the article's parts, and
    which of them stay whatever the template is."""
    out, parts = _judged(root)
    return [(slot, text, heading and bool(parts)) for p in parts or [root] for slot, text, heading in _blocks(p, out)]


def extract(page: str, template: frozenset[tuple[int, int]] = frozenset()) -> str:
    """Main text of one page; ``template`` are its template blocks as slot and
    hash of the text."""
    root = dom.parse(page)
    if not template:
        return " ".join(text for _, text, _ in _units(root))
    dom.shape(root)
    return " ".join(text for slot, text, stays in _units(root) if stays or (slot, _hash(text)) not in template)


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html key, host, html) to the page's shape, the hash of
    the content its mark-up leaves, its length, and its different blocks that
    may be template."""
    block = pa.struct([("slot", pa.int32()), ("hash", pa.int64()), ("size", pa.int64())])
    for batch in batches:
        shapes, contents, chars, blocks = [], [], [], []
        for page in batch.column(4).to_pylist():
            root = dom.parse(page or "")
            shapes.append(dom.shape(root)[0])
            units = _units(root)
            contents.append(_hash("\n".join(text for _, text, _ in units)))
            chars.append(sum(len(text) for _, text, _ in units))
            sizes: dict[tuple[int, int], int] = {}
            for n, text, stays in units:
                if not stays:
                    sizes[n, _hash(text)] = sizes.get((n, _hash(text)), 0) + len(text)
            blocks.append([{"slot": n, "hash": h, "size": size} for (n, h), size in sorted(sizes.items())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array(shapes, pa.string()), pa.array(contents, pa.int64()),
             pa.array(chars, pa.int64()), pa.array(blocks, pa.list_(block))],
            names=["page_id", "key", "host", "shape", "content", "chars", "blocks"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, shape id, pages, shape, wrapper) to the wrapper's slot of each
    slot of the shape, -1 without one."""
    read = lru_cache(64)(dom.read_shape)
    for batch in batches:
        slots = []
        for own, wrapper in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            places = [-1] * own.replace("(", ",").replace(")", ",").split(",").count("#")
            for a, b in dom.match(read(own), read(wrapper))[1]:
                places[a] = b
            slots.append(places)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(slots, pa.list_(pa.int32()))], names=["host", "shape_id", "pages", "slots"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        template = batch.column(3).to_pylist()
        texts = [extract(p or "", frozenset((b["slot"], b["hash"]) for b in t or ()))
                 for p, t in zip(batch.column(2).to_pylist(), template, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def wrappers(shaped: DataFrame, max_share: float = MAX_SHARE) -> DataFrame:
    """(shape_id, template): the template blocks of every shape that has some.
    ``shaped`` (host, shape_id, shape, content, chars, blocks) has a row per page."""
    # copies count once
    once = shaped.groupBy("host", "content").agg(F.min(F.struct("shape_id", "chars", "blocks")).alias("p")).select("host", "p.*")
    pages = once.groupBy("shape_id").agg(F.count(F.lit(1)).alias("pages"))
    shapes = shaped.groupBy("host", "shape_id").agg(F.min("shape").alias("shape")).join(pages, "shape_id", "left").fillna(0, ["pages"])
    wrapper = shapes.groupBy("host").agg(F.max_by("shape", F.struct("pages", "shape")).alias("wrapper"))
    pairs = shapes.join(wrapper, "host").select("host", "shape_id", "pages", "shape", "wrapper")
    aligned = saved(arrow_map(pairs, _align, "host string, shape_id long, pages long, slots array<int>"))
    # a slot without a place in the wrapper is a place of its shape alone
    own = -1 - F.shiftrightunsigned(F.xxhash64("shape_id", "slot"), 1)
    placed = aligned.select("host", "shape_id", "pages", F.posexplode("slots").alias("slot", "at")).select(
        "host", "shape_id", "pages", "slot", F.when(F.col("at") >= 0, F.col("at").cast("long")).otherwise(own).alias("place"))
    of_place = placed.groupBy("host", "place").agg(F.sum("pages").alias("pages"))
    # a block on every page of a place is on every page of each of its shapes
    blocks = once.select("shape_id", F.inline("blocks")).groupBy("shape_id", "slot", "hash").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    blocks = blocks.join(small(aligned.select("shape_id", "pages")), "shape_id").where("n = pages").drop("pages")
    blocks = blocks.join(placed.drop("pages"), ["shape_id", "slot"])
    blocks = blocks.groupBy("host", "place", "hash").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).where("n > 1")
    constant = blocks.join(of_place, ["host", "place"]).where("n = pages").select("host", "place", "hash", "size")
    shared = constant.groupBy("host").agg(F.sum("size").alias("size"))
    framed = shared.join(once.groupBy("host").agg(F.sum("chars").alias("chars")), "host").where(F.col("size") < F.col("chars") * max_share)
    constant = saved(constant.join(framed.select("host"), "host").select("host", "place", "hash"))
    template = placed.join(small(constant), ["host", "place"])
    return template.groupBy("shape_id").agg(F.collect_list(F.struct("slot", "hash")).alias("template"))


def main_text(pages: DataFrame, max_share: float = MAX_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url,
    html)."""
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
    pages = pages.select("page_id", "url", "html")
    key = F.xxhash64("url", "html")
    shaped = saved(arrow_map(
        pages.select("page_id", "url", key.alias("key"), host.alias("host"), "html"), _shapes,
        "page_id long, key long, host string, shape string, content long, chars long, blocks array<struct<slot:int,hash:long,size:long>>"
    ).withColumn("shape_id", F.xxhash64("host", "shape")))
    verdicts = shaped.select("page_id", "key", "shape_id").join(small(saved(wrappers(shaped, max_share))), "shape_id")
    of_page = saved(verdicts.select("page_id", "key", "template").dropDuplicates(["page_id", "key"]))
    judged = join_null_safe(pages.withColumn("key", key), small(of_page), ["page_id", "key"], "left")
    return arrow_map(
        judged.select("page_id", "url", "html", "template"), _extracted, "page_id long, url string, text string, n_chars long")
