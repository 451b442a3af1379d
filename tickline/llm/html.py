"""Main text of web pages: site templates are found by counting element subtrees per host.

Pass 1 parses each page, hashes every element's subtree (tags, classes and text), inside <article> and
<main> too, and counts on how many pages of the host it stands, each time in a different parent: what stands
always in the same parent goes with that one or stays with it, and what one page repeats counts once. A
subtree is template if it is so often there as `SHARE` of the host's different pages, and on `LEAST_PAGES` of
them (on small hosts half of the pages, `SMALL_LEAST` at least). Inside <article> and <main> chance and custom
repeat headings and sentences, so there it takes half of the host's pages.
Pass 2 parses the page again, drops what HTML itself declares to be no content (menus, headers, footers, asides,
forms, scripts, notices, adverts, comments: by tag, role or class word), and keeps the text that is left, in
the page's <article> and <main> where they have any, with the hashes of the elements around it. These blocks,
not the html, meet the host's templates in a join; the text is read from them without the template subtrees.
An article that several pages carry is still those pages' article: an element with half of the text in
<article> and <main> is never template, and if the template subtrees in there hold half of that text
together, they stay.

A page's template subtrees come from a join of its own subtrees with the host's by (host, hash), so a page
carries a list no longer than itself, however many templates the host has.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import stored

SHARE = 0.001
LEAST_PAGES = 10
#: On hosts of few pages half of them is enough, but no fewer than this.
SMALL_LEAST = 4
SALTS = 16
#: On a page without <article> and <main>, an element with this share of the text is no template.
NEARLY = 0.9

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)[^>]*(?:>|$)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)")
_SPACE = re.compile(r"\s+")

# Fixed values of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_BLOCK = frozenset(
    """address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section
    select summary table tbody td tfoot th thead title tr ul""".split()
)
#: An opening tag ends an open element of these kinds (the standard's omitted end tags).
_ENDS = {
    **{t: ("p",) for t in "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()},
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tbody": ("tr", "td", "th", "thead", "tbody", "p"), "tfoot": ("tr", "td", "th", "tbody", "p"), "body": ("head",),
}
#: Elements that such an ending does not reach beyond.
_WALLS = frozenset("table td th ul ol dl article section div main aside body html button select".split())

_NO_CONTENT = frozenset("nav footer aside menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alertdialog alert menu menubar toolbar".split())
#: Class and id words of what is no content, whatever its size.
_SURE = frozenset("breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr menu nav navbar navigation replies respond".split())
_NAMES = _SURE | frozenset(
    """ad ads advert adverts advertisement advertising adsense banner header login masthead modal newsletter notice
    notices popup promo promoted recommended related reply share sharing sidebar signup social sponsor
    sponsored subscribe toolbar widget""".split()
)
#: Words that may stand beside one of those in a class or id, as in "main-nav" or "ad-slot-300x250".
_BESIDE = frozenset(
    """area bar block bottom box button buttons center column container desktop fixed form global group horizontal icons
    inline inner item items js left link links list main mobile outer page panel popup posts primary right row secondary
    site slot small sticky top unit vertical wrap wrapper x""".split()
)
_OWN = frozenset(("article", "main"))
#: Their text is never the page's.
_NEVER = _RAW | frozenset("template head object embed svg canvas button input select menu audio video map".split())
#: Parts of a table, which say nothing alone.
_PARTS = frozenset("caption colgroup tbody td tfoot th thead tr".split())


class _Node:
    __slots__ = ("tag", "names", "role", "hidden", "kids", "size", "own", "inside", "holds", "most", "_hash")

    def __init__(self, tag: str, names: str = "", role: str = "", hidden: bool = False):
        self.tag, self.names, self.role, self.hidden, self.kids = tag, names, role, hidden, []


def _attributes(text: str) -> tuple[str, str, bool]:
    """Class and id words, role, and whether the element is hidden."""
    names, role, hidden = [], "", False
    for m in _ATTR.finditer(text):
        key = (m[1] or m[5]).lower()
        value = unescape(m[2] or m[3] or m[4] or "")
        if key in ("class", "id"):
            names.append(value.lower())
        elif key == "role":
            role = value.strip().lower()
        elif key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)) or (key == "aria-hidden" and value.strip().lower() == "true"):
            hidden = True
    return " ".join(names), role, hidden


def parse(page: str) -> _Node:
    """The page's element tree; text kids are strings with character references decoded. Never raises."""
    root = _Node("")
    open_ = [root]
    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            open_[-1].kids.append(unescape(page[at:]))
            break
        if m.start() > at:
            open_[-1].kids.append(unescape(page[at : m.start()]))
        at = max(m.end(), m.start() + 1)
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
            continue
        if ends := _ENDS.get(tag):
            k = len(open_) - 1
            while k > 0 and open_[k].tag not in _WALLS and open_[k].tag not in ends:
                k -= 1
            # an omitted end may also close the same kind just below, as in <li><p>..<li>
            while k > 0 and open_[k].tag in ends:
                del open_[k:]
                k -= 1
                while k > 0 and open_[k].tag not in _WALLS and open_[k].tag not in ends:
                    k -= 1
        node = _Node(tag, *_attributes(m[3])) if m[3] and not m[3].isspace() else _Node(tag)
        open_[-1].kids.append(node)
        if tag in _VOID or m[3].endswith("/") and tag not in _RAW and tag not in _BLOCK:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            node.kids.append(page[at : end.start()] if end else page[at:])
            at = end.end() if end else size
            continue
        open_.append(node)
    return root


def _walk(root: _Node) -> list[_Node]:
    """All elements, parents before children; no recursion, pages may nest deeply."""
    out, wait = [], [root]
    while wait:
        node = wait.pop()
        out.append(node)
        wait.extend(k for k in reversed(node.kids) if not isinstance(k, str))
    return out


def measure(root: _Node) -> None:
    """Give every element the size of its text, that of its text in <article> and <main>, and whether it lies in
    one, whether it lies around half of the text in them, and whether it has most of the page's text."""
    wait: list = [(root, False)]
    elements = []
    while wait:
        node, inside = wait.pop()
        node.inside = inside or node.tag in _OWN
        elements.append(node)
        wait.extend((k, node.inside) for k in node.kids if not isinstance(k, str))
    for node in reversed(elements):
        node.size = node.own = 0
        if node.tag in _NEVER:
            continue
        for k in node.kids:
            if isinstance(k, str):
                node.size += sum(map(len, k.split()))
            else:
                node.size += k.size
                node.own += k.own
        if node.inside:
            node.own = node.size
    for node in elements:
        base = root.own or root.size
        node.holds = not node.inside and root.own > 0 and 2 * node.own >= base
        node.most = node.holds or 2 * (node.own if root.own else node.size) > base


def hash_subtrees(root: _Node) -> None:
    """Give every element the hash of its subtree; 0 where it has no text."""
    measure(root)
    for node in reversed(_walk(root)):
        node._hash = 0
        if not node.size:
            continue
        parts = [node.tag, node.names, node.role]
        for k in node.kids:
            if isinstance(k, str):
                if words := k.split():
                    parts.append("t" + " ".join(words))
            else:
                parts.append(f"{k.tag} {k._hash}")
        node._hash = int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) or 1


def _counted(node: _Node, parent: _Node, root: _Node) -> bool:
    """Whether an element can be template: not the page itself, not most of its text, not a piece of a sentence or table."""
    if not node._hash or node.tag in ("html", "body") or node.tag in _PARTS:
        return False
    if 2 * node.own >= root.own if root.own else node.size >= NEARLY * root.size:
        return False
    return node.tag in _BLOCK or not any(isinstance(k, str) and not k.isspace() for k in parent.kids)


def subtrees(page: str) -> tuple[int, set[tuple[int, int]]]:
    """The page's hash, and (hash, hash of the parent) of the elements that can be template: each hash once, with
    the least of its parents."""
    root = parse(page)
    hash_subtrees(root)
    found: dict[int, int] = {}
    for node in _walk(root):
        for k in node.kids:
            if not isinstance(k, str) and _counted(k, node, root):
                found[k._hash] = min(node._hash, found.get(k._hash, node._hash))
    return root._hash, set(found.items())


def subtree_hashes(page: str) -> set[int]:
    """Hashes of the elements that can be template."""
    return {h for h, _ in subtrees(page)[1]}


def _named(names: str, words: frozenset[str]) -> bool:
    """Whether a class or id is one of the words, alone or beside others of its kind: "has-sidebar" is none."""
    for name in names.split():
        parts = [p for p in re.split(r"[^a-z]+", name) if p]
        if not words.isdisjoint(parts) and all(p in _NAMES or p in _BESIDE for p in parts):
            return True
    return False


def _no_content(node: _Node) -> bool:
    """Declared to be no content. What lies around the page's articles is content; so is a form, header, hidden
    part or one with a name of less certain meaning, if it has most of the text."""
    if node.tag in _OWN or node.tag in ("html", "body"):
        return False
    if node.tag in _NEVER:
        return True
    if node.holds:
        return False
    if node.tag in _NO_CONTENT or node.role in _ROLES or _named(node.names, _SURE):
        return True
    unsure = node.tag in ("form", "header", "dialog") or node.hidden or node.role in ("form", "dialog") or _named(node.names, _NAMES)
    return unsure and not node.most


def blocks(page: str) -> str:
    """What is left of a page without what is no content, as JSON: the size of the text in <article> and <main>,
    then text pieces, elements that can be template (hash, size of their text in there, whether they lie in there)
    and 0 for their ends."""
    root = parse(page)
    hash_subtrees(root)
    tops = (_outermost(root) if root.own else []) or [root]
    out: list = [root.own]
    wait: list = [(t, None, False) for t in reversed(tops)]
    while wait:
        item, parent, hidden = wait.pop()
        if item == 0 or isinstance(item, str):
            if item == 0 or not hidden:
                out.append(item)
            continue
        if counted := parent is not None and _counted(item, parent, root):
            out.append([item._hash, item.own, int(item.inside)])
        gone = hidden or _no_content(item)
        if gone or item.tag in _BLOCK:
            out.append(" ")
        if counted:
            wait.append((0, None, False))
        if not gone and item.tag in _BLOCK:
            wait.append((" ", None, False))
        wait.extend((k, item, gone) for k in reversed(item.kids))
    return json.dumps(out, ensure_ascii=False, separators=(",", ":"))


def text_of(held: str, template: frozenset[int] = frozenset(), strong: frozenset[int] = frozenset()) -> str:
    """The text of a page's :func:`blocks` without the outermost template elements (inside <article> and <main>
    those of `strong`). Where they hold most of the text of <article> and <main> together, the article itself is
    on several pages, with small changes: then none of it goes."""
    own, *items = json.loads(held)

    def read(delete: bool) -> tuple[list[str], int]:
        parts, deep, size = [], 0, 0  # deep: open elements of one that goes, itself included
        for item in items:
            if isinstance(item, str):
                if not deep:
                    parts.append(item)
            elif item == 0:
                deep -= deep > 0
            elif deep:
                deep += 1
            elif delete and item[0] in (strong if item[2] else template):
                deep, size = 1, size + item[1]
                parts.append(" ")
        return parts, size

    parts, size = read(True)
    if own and 2 * size >= own:
        parts, _ = read(False)
    return _SPACE.sub(" ", "".join(parts)).strip()


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """The text of a page without its template subtrees and those that are no content."""
    return text_of(blocks(page), template, template)


def _outermost(root: _Node) -> list[_Node]:
    """Each <article> and <main> that lies in no other and in nothing that is no content."""
    out, wait = [], [root]
    while wait:
        node = wait.pop()
        if node.tag in _OWN:
            out.append(node)
        elif not _no_content(node):
            wait.extend(k for k in reversed(node.kids) if not isinstance(k, str))
    return out


def host_of(url):
    """Lower-case host of a URL, empty for none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _least(pages, share: float, least_pages: int):
    """How many different parents make a subtree template, by the number of the host's pages."""
    return F.greatest(F.least(F.lit(least_pages), F.greatest(F.lit(SMALL_LEAST), F.ceil(pages / 2))), pages * share)


def _places(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(__host, __page, __hash, __parent): the subtrees of each page that has a host; hash 0 stands for the page."""
    named = pages.select(host_of(F.col(f"`{url}`")).alias("__host"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("__html")).where(F.col("__host") != "")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, out, around = [], [], []
            for k, page in enumerate(batch.column(2)):
                whole, found = subtrees(page.as_py())
                found = [(0, whole), *found]
                owner += [k] * len(found)
                out += [h for h, _ in found]
                around += [p for _, p in found]
            at = pa.array(owner, pa.int64())
            yield pa.record_batch({"__host": batch.column(0).take(at), "__page": batch.column(1).take(at), "__hash": pa.array(out, pa.int64()), "__parent": pa.array(around, pa.int64())})

    return named.select("__host", F.xxhash64("__html").alias("__page"), "__html").mapInArrow(hashes, "__host string, __page long, __hash long, __parent long")


def _often(places: DataFrame, share: float, least_pages: int) -> DataFrame:
    """(__host, __hash, __strong): each host's template subtrees, and whether they are so inside <article> and <main>."""
    counts = places.select("__host", "__hash", "__parent").distinct().groupBy("__host", "__hash").agg(F.count("*").alias("__n")).where(F.col("__n") >= min(SMALL_LEAST, least_pages))
    counts = stored(counts, "subtree-counts")
    size = counts.where(F.col("__hash") == 0).select("__host", F.col("__n").alias("__pages"))
    told = counts.where(F.col("__hash") != 0).join(size, "__host").where(F.col("__n") >= _least(F.col("__pages"), share, least_pages))
    return told.select("__host", "__hash", (F.col("__n") >= F.greatest(F.lit(SMALL_LEAST), F.ceil(F.col("__pages") / 2))).alias("__strong"))


def templates(pages: DataFrame, url: str = "url", html: str = "html", share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(__host, __page, __template, __inside): the template subtrees of each page that has some, by hash, and those of
    them that are so inside <article> and <main>. `__page` is the hash of its html. Pages without a host have no template."""
    places = stored(_places(pages, url, html), "subtrees")
    own = places.where(F.col("__hash") != 0).select("__host", "__page", "__hash").withColumn("__salt", F.pmod("__page", F.lit(SALTS)).cast("int"))
    salted = _often(places, share, least_pages).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # a menu of a hot host goes to SALTS tasks
    return own.join(salted, ["__host", "__hash", "__salt"]).groupBy("__host", "__page").agg(F.collect_set("__hash").alias("__template"), F.collect_set(F.when(F.col("__strong"), F.col("__hash"))).alias("__inside"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", share: float = SHARE, least_pages: int = LEAST_PAGES, out: str = "text") -> DataFrame:
    """All rows and columns of `pages` and `out`, the main text (empty if there is none).

    Blocks are joined in page order by one space, white space is turned into one space. Null or empty
    html gives empty text; a null or odd URL only goes without template removal. Equal pages of a host
    count once. A column named like `out` is replaced. An empty table stays empty.
    """
    by_page = stored(templates(pages, url, html, share, least_pages), "templates")
    # copies of one page would be dealt to one task: the salt comes from the URL
    salted = by_page.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = [c for c in pages.columns if c != out]

    @F.pandas_udf("string")
    def blocks_of(htmls):
        import pandas as pd

        return pd.Series([blocks(page) for page in htmls], dtype=object)

    @F.pandas_udf("string")
    def joined_text(helds, lists, insides):
        import pandas as pd

        sets = lambda x: frozenset(() if x is None else x.tolist())
        return pd.Series([text_of(held, sets(a), sets(b)) for held, a, b in zip(helds, lists, insides, strict=True)], dtype=object)

    # the salt hangs on the row, so a task that runs again places it alike
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    named = pages.withColumns({"__host": host_of(F.col(f"`{url}`")), "__page": F.xxhash64(body), "__salt": F.pmod(F.xxhash64(F.col(f"`{url}`")), F.lit(SALTS)).cast("int"), "__blocks": blocks_of(body)})
    # both sides are dealt, however small the lists are: one plan for every size
    joined = named.join(salted.hint("shuffle_merge"), ["__host", "__page", "__salt"], "left")
    return joined.withColumn("__out", joined_text("__blocks", "__template", "__inside")).select(*[f"`{c}`" for c in own], F.col("__out").alias(out))
