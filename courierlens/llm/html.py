"""Main text of web pages by removing the templates of their sites.

A page's elements are hashed as subtrees, markup and text. Spark counts per
host on how many different pages each subtree occurs; a subtree that recurs on
many of them is the site's template and is deleted. What no count can show, as
it differs from page to page, is told by the markup: navigation, page headers
and footers, asides, forms, scripts, styles, and elements whose class, id or
role names a menu, an advert, a notice, or comments. Inside articles a name
drops boxes only, and if it may name a part of the text, only those without prose.

Articles themselves are never template, however often they are copied, and
neither is prose inside an article: only boxes in it can be. Copies of a whole
page count once, as a subtree must occur below different parents. A box that is
most of the text of the pages it is on stays as well: copies of a story need no
article element to be kept.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import written


@dataclass(frozen=True)
class TemplateParams:
    """A subtree is template below at least ``least_parents`` different parents and on a share of its host's pages.

    Boxes outside articles need ``box_share`` of the pages, prose and what
    stands inside articles ``text_share``: passages are quoted, boxes are not.
    A box that is most of the text on ``own_share`` of its pages is what these
    pages are about, not template.
    """

    least_parents: int = 5
    box_share: float = 0.01
    text_share: float = 0.3
    own_share: float = 0.5


#: Elements without an end tag, elements whose text is no text, elements that begin a block (fixed names of HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul caption".split()
)
#: Elements that never belong to the main text.
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video map nav aside footer form "
    "button select textarea input dialog menu search noembed noframes title xmp datalist".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li td dd dt figcaption".split())
#: Start tags that end an open p, and items that end the item before them.
ENDS_P = BLOCKS - frozenset("body html li dd dt td th tr tbody thead tfoot option optgroup legend caption summary".split())
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Words of class, id and role that name what is not main text.
NAMED = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidenav aside masthead topbar toolbar footer "
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login search form comment comments disqus respond replies reply discussion related recommended share sharing "
    "social pagination pager widget complementary contentinfo copyright legal disclaimer skip hidden dialog alertdialog".split()
)
#: Words of NAMED that also name a part of what a text is about.
CONTENT_WORDS = frozenset(
    "menu promotion notice notices alert subscription search form discussion related share sharing social legal "
    "disclaimer copyright login reply banner hidden skip overlay sponsor promoted".split()
)
#: Words that say nothing on their own, beside a word of NAMED.
FURNITURE = frozenset(
    "area bar block box btn button buttons container content group icons inner item items left right top bottom link links "
    "list main outer panel section site toggle unit wrap wrapper post posts entry article articles page user users reader "
    "readers visitor visitors thread threads slot slots zone holder placement count counts stream feed body header".split()
)
#: Words for what goes whatever element it is and whatever it holds: what readers say, what is paid for, what stands beside.
COMMENTS = frozenset("comment comments disqus replies respond".split())
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsored".split())
BESIDE = frozenset("sidebar sidebars sidenav".split())
ALWAYS = COMMENTS | ADVERTS | BESIDE
#: Long enough to be told within a word written together, as in commentlist.
JOINED = sorted((w for w in ALWAYS if len(w) > 5), key=len, reverse=True)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements a text is made of; outside articles, too, only a class that says nothing else drops them.
TEXTUAL = HEADINGS | frozenset("p blockquote pre section table caption thead tbody tfoot tr th td li dd dt figure figcaption".split())
CONTAINERS = frozenset("div section aside ul ol dl table header footer nav form span figure details center blockquote".split())
TABLE_PARTS = frozenset("caption tbody td tfoot th thead tr".split())
#: Elements within a line of text, and elements that hold lines.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math q rp rt ruby s samp small strike "
    "strong sub sup time tt u var option optgroup summary legend".split()
)
LINES = INLINE | HEADINGS | frozenset("p pre span dt figcaption".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Characters outside links from which a box is prose.
MUCH = 100
NAME_PARTS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Element:
    tag: str
    parent: Element | None
    dropped: bool = False
    main: bool = False
    within: bool = False
    lost: bool = False
    parts: list = field(default_factory=list)
    key: int = 0


def _words(token: str) -> set[str]:
    """Words of a name; one written together of a word of ALWAYS and furniture counts as both."""
    words: set[str] = set()
    for word in filter(None, NAME_PARTS.split(token)):
        word = word.lower()
        if word not in NAMED:
            for part in JOINED:
                rest = word.removeprefix(part) if word.startswith(part) else word.removesuffix(part)
                if rest != word and rest in FURNITURE:
                    words.add(part)
                    word = rest
                    break
        words.add(word)
    return words


def _names(tag: str, within: bool, name: str, value: str) -> tuple[bool, bool]:
    """Whether a class, id or role drops an element, and whether it does so unless the element holds prose.

    Comments, adverts and sidebars go by a name that consists of such words,
    whatever the element; only headings stay, and an id of a paragraph or a
    part of a table is an anchor. Else any word of NAMED drops a box outside
    articles. Inside them and for textual elements, a name must consist of such
    words, ids are anchors unless they call a section a box, and headings and
    paragraphs stay.
    """
    away = doubtful = False
    for token in value.split() if tag not in ("body", "html", "main") else ():
        words = _words(token)
        if not words & NAMED and not words & ALWAYS:
            continue
        anchor = name == "id" and tag in TEXTUAL
        fixed = tag in HEADINGS or (anchor and tag not in ("section", "table"))
        if words & ALWAYS and words <= ALWAYS | NAMED | FURNITURE and not fixed:
            return True, False
        if tag == "section" and words & FURNITURE:
            anchor = False  # related-posts is a box, discussion a part of the text
        if tag == "article" or not words & NAMED:
            continue
        if not within and tag not in TEXTUAL:
            return True, False
        if tag in HEADINGS or (within and tag in ("p", "blockquote", "pre")) or anchor:
            continue
        if words <= NAMED | FURNITURE:
            # the id of a section names what it is about as often as what it is for
            sure = name == "role" or (name != "id" and bool(words & NAMED - CONTENT_WORDS))
            away, doubtful = away or sure, doubtful or not sure
    return away, doubtful


def _named_away(tag: str, within: bool, attributes: str) -> tuple[bool, bool, bool]:
    """Whether the attributes tell that the element is no main text, that it is none unless it holds prose, that it is."""
    away = doubtful = main = False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            if name == "role" and value == "main":
                main = True
            sure, unless = _names(tag, within, name, value)
            away, doubtful = away or sure, doubtful or unless
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            away = True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            away = True
        elif name == "itemprop" and value == "articleBody":
            main = True
    return away, doubtful, main


def _text_sizes(node: Element) -> tuple[int, int, bool]:
    """Characters outside and inside links below an element, and whether a heading or paragraph is among them."""
    outside = inside = 0
    prose = False
    stack = [(node, node.tag == "a")]
    while stack:
        at, linked = stack.pop()
        for part in at.parts:
            if isinstance(part, Element):
                if not part.dropped:
                    prose = prose or part.tag == "p" or part.tag in HEADINGS
                    stack.append((part, linked or part.tag == "a"))
            elif linked:
                inside += len(part.strip())
            else:
                outside += len(part.strip())
    return outside, inside, prose


def _holds_prose(node: Element) -> bool:
    """Whether most of the text is no link, and there is a paragraph, a heading or much of it."""
    outside, inside, prose = _text_sizes(node)
    return outside > inside and (prose or outside >= MUCH)


def parse(source: str) -> Element:
    """Element tree of a page, forgiving as browsers are; only what the extraction needs."""
    root = Element("html", None)
    at, end, place = root, len(source), 0
    lower, in_doubt = None, []
    while place < end:
        token = TOKEN.search(source, place)
        if token is None:
            at.parts.append(source[place:])
            break
        if token.start() > place:
            at.parts.append(source[place : token.start()])
        place = max(token.end(), token.start() + 1)
        closing, opening = token.group(1), token.group(2)
        if closing:
            at = _close(at, closing.lower())
        elif opening:
            tag, attributes = opening.lower(), token.group(3) or ""
            at = _make_room(at, tag)
            child = Element(tag, at)
            away = doubtful = main = False
            if "=" in attributes or "hidden" in attributes:
                away, doubtful, main = _named_away(tag, at.within, attributes)
            child.lost = away or at.lost
            child.main = (main or tag in ("article", "main")) and not child.lost
            child.within = child.main or at.within
            child.dropped = away or tag in DROPPED or (tag == "header" and not at.within)
            at.parts.append(child)
            if doubtful and not child.dropped:
                in_doubt.append(child)
            if tag in RAW:
                lower = source.lower() if lower is None else lower
                stop = lower.find(f"</{tag}", place)
                # lower() may change the length of a text, so its places count only if it did not
                if stop < 0 or len(lower) != end:
                    found = re.compile(f"</{tag}", re.I).search(source, place)
                    stop = found.start() if found else end
                place = stop
                past = source.find(">", place)
                place = end if past < 0 else past + 1
            elif tag not in VOID and not attributes.rstrip().endswith("/"):
                at = child
            elif tag not in VOID and tag in BLOCKS | {"b", "i", "em", "strong", "span", "a"}:
                at = child  # a slash does not close such an element
    for child in reversed(in_doubt):
        child.dropped = not _holds_prose(child)
    return root


def _make_room(at: Element, tag: str) -> Element:
    """End what a start tag ends without saying so."""
    if tag in SIBLINGS:
        ended, bound = SIBLINGS[tag]
        node = at
        while node.parent is not None and node.tag not in bound:
            if node.tag in ended:
                return node.parent
            node = node.parent
    elif tag in ENDS_P:
        node = at
        while node.parent is not None and (node.tag == "p" or node.tag not in BLOCKS):
            if node.tag == "p":
                return node.parent
            node = node.parent
    return at


def _close(at: Element, tag: str) -> Element:
    """The parent of the innermost open element of this name; a stray end tag changes nothing."""
    node = at
    while node.parent is not None:
        if node.tag == tag:
            return node.parent
        if tag not in BLOCKS and node.tag in BLOCKS:
            return at  # an inline end tag does not reach out of its block
        node = node.parent
    return at


def hash_tree(root: Element) -> list[Element]:
    """Give every element the hash of its subtree; returns them, children before parents."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in node.parts if isinstance(p, Element))
    order.reverse()
    for node in order:
        digest = xxhash.xxh64(node.tag.encode())
        for part in node.parts:
            if isinstance(part, Element):
                digest.update(b"<%d>" % part.key)
            elif not part.isspace():
                digest.update(" ".join(part.split()).encode("utf-8", "surrogatepass"))
        node.key = digest.intdigest() - 2**63
    return order


def candidates(root: Element) -> set[tuple[int, int, bool, bool]]:
    """(subtree, parent, is text, is most of the page's text) of what may be template.

    That are boxes anywhere, prose outside articles, and any other element that
    is no part of a line, so the highest recurring subtree is found whatever
    its tag. Long prose in a box counts as text.
    """
    order = hash_tree(root)
    sizes: dict[int, tuple[int, int]] = {}
    for node in order:  # characters outside and inside links, without what is dropped
        outside = inside = 0
        for part in node.parts:
            if not isinstance(part, Element):
                outside += len(part.strip())
            elif not part.dropped:
                below = sizes[id(part)]
                outside, inside = outside + below[0], inside + below[1]
        sizes[id(node)] = (0, outside + inside) if node.tag == "a" else (outside, inside)
    whole = sizes[id(root)][0]
    found = set()
    for node in order:
        if node.parent is None or node.dropped or node.main or node.tag in ("body", "html"):
            continue
        if node.tag in CONTAINERS:
            text = node.within
        elif node.tag in PROSE or node.tag in TABLE_PARTS:
            if node.within:
                continue
            text = True
        elif node.tag in INLINE or node.tag in VOID or node.parent.tag in LINES:
            continue
        else:
            text = True
        if not _holds_main(node):
            outside, inside = sizes[id(node)]
            much = outside >= MUCH and outside > inside
            found.add((node.key, node.parent.key, text or much, much and 2 * outside > whole))
    return found


def _holds_main(node: Element) -> bool:
    stack = [node]
    while stack:
        at = stack.pop()
        if at.main:
            return True
        stack.extend(p for p in at.parts if isinstance(p, Element))
    return False


def text_blocks(root: Element, template: frozenset[int]) -> list[tuple[bool, str]]:
    """(within an article, text) of each block that is left, in page order."""
    blocks: list[tuple[bool, str]] = []
    words: list[str] = []

    def flush(within: bool) -> None:
        text = " ".join(references.unescape("".join(words)).split())
        words.clear()
        if text:
            blocks.append((within, text))

    stack: list[tuple[Element, int]] = [(root, 0)]
    while stack:
        node, place = stack.pop()
        while place < len(node.parts):
            part = node.parts[place]
            place += 1
            if not isinstance(part, Element):
                words.append(part)
            elif part.tag == "br":
                words.append(" ")
            elif not part.dropped and part.tag not in VOID and (part.key not in template or part.main or _holds_main(part)):
                stack.append((node, place))
                if part.tag in BLOCKS:
                    flush(node.within)
                node, place = part, 0
            elif part.tag in BLOCKS or part.tag in VOID and part.tag == "hr":
                flush(node.within)
        if node.tag in BLOCKS:
            flush(node.within)
    flush(False)
    return blocks


def main_text(source: str | None, template: frozenset[int] = frozenset()) -> str:
    """Text of the page's articles, or of all that is left where a page has none."""
    if not source:
        return ""
    root = parse(source)
    if template:
        hash_tree(root)
    blocks = text_blocks(root, template)
    inside = [text for within, text in blocks if within]
    return " ".join(inside or [text for _, text in blocks])


def host_of(url: Column) -> Column:
    """Host of a url in lower case, without user and port; empty if there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return host


def _candidates_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        found = [
            (host, key, parent, text, own)
            for host, source in zip(rows["host"], rows["html"], strict=True)
            if source
            for key, parent, text, own in candidates(parse(source))
        ]
        yield pd.DataFrame(found, columns=["host", "subtree", "parent", "text", "own"])


def _page_candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        found = [
            (page, host, key)
            for page, host, source in zip(rows["page_id"], rows["host"], rows["html"], strict=True)
            if source
            for key in {k for k, *_ in candidates(parse(source))}
        ]
        yield pd.DataFrame(found, columns=["page_id", "host", "subtree"])


def host_templates(pages: DataFrame, params: TemplateParams = TemplateParams()) -> DataFrame:
    """(host, subtree) of every template, counted over all pages with a host."""
    hosted = pages.select(host_of(F.col("url")).alias("host"), "html").filter("host <> '' and html <> ''")
    found = hosted.mapInPandas(_candidates_of, "host string, subtree bigint, parent bigint, text boolean, own boolean")
    # one row per subtree, parent and task leaves the map side; the pages of a host are counted as they come
    pairs = found.groupBy("host", "subtree", "parent").agg(
        F.count(F.lit(1)).alias("pages"), F.max("text").alias("text"), F.count_if("own").alias("own")
    )
    counts = pairs.groupBy("host", "subtree").agg(
        F.count(F.lit(1)).alias("parents"), F.sum("pages").alias("pages"), F.max("text").alias("text"), F.sum("own").alias("own")
    )
    sizes = hosted.groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    share = F.when(F.col("text"), params.text_share).otherwise(params.box_share)
    several = counts.filter((F.col("parents") >= params.least_parents) & (F.col("own") < params.own_share * F.col("pages")))
    return several.join(sizes, "host").filter(F.col("pages") >= share * F.col("of")).select("host", "subtree")


def extract(pages: DataFrame, params: TemplateParams = TemplateParams()) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null and empty html give an empty text. A page whose url has no host is
    cleaned by markup alone, as is a page without id. Rows that repeat an id
    share what is deleted. Other columns are ignored; no pages give no rows.
    Only pages on which some template occurs carry a list of what to delete.
    """
    templates = written(host_templates(pages, params), "templates")
    own = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    deleted = None
    if templates.limit(1).count():
        hosted = own.select("page_id", host_of(F.col("url")).alias("host"), "html").filter("host <> '' and page_id is not null")
        # pages of hosts without any template need no second look
        hosted = hosted.join(templates.select("host").distinct(), "host", "left_semi")
        here = hosted.mapInPandas(_page_candidates, "page_id bigint, host string, subtree bigint")
        deleted = here.join(templates, ["host", "subtree"]).groupBy("page_id").agg(F.collect_set("subtree").alias("deleted"))

    @F.pandas_udf("string")
    def text_of(source: pd.Series, deleted: pd.Series) -> pd.Series:
        return pd.Series(
            [main_text(s, frozenset(d.tolist()) if d is not None else frozenset()) for s, d in zip(source, deleted, strict=True)],
            dtype=object,
        )

    joined = own.join(deleted, "page_id", "left") if deleted is not None else own.withColumn("deleted", F.lit(None).cast("array<bigint>"))
    return joined.select("page_id", "url", text_of("html", "deleted").alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("bigint")
    )
