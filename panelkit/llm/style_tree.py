"""Main text of web pages by a site style tree: the pages of a host merged by the structure of their elements.

Every page becomes a small tree of container elements. Elements of one host with the same path (tags with their
classes and ids, from the body down) are one node of the host's style tree, which counts, over the host's distinct pages,
- the styles of the node, each a sequence of child tags: presentation importance is their entropy, on base of the
  number of pages (1 if there is one page),
- the texts below the node: content importance is 1 less the mean entropy of a text over the pages that hold it, so text of
  one page counts 1 and text on all pages 0,
- the share of text in links.
The importance of a node is the mean of the two, times the share of text outside links. Branches of importance under ``LEAST`` are
removed from every page of the host. Fewer than ``MIN_PAGES`` pages tell less: what an importance lacks of 1 counts by log(pages) / log(``MIN_PAGES``).

The blocks of a node are branches of their own: a text (of ``MIN_WORDS`` words, as shorter ones repeat by chance) has the content importance
1 - log(n) / log(m), if n of the m articles with that node hold it (of the pages, outside articles; articles of the same text
are one, as they are copies, not templates). If more than half of a page's text would go in this way, the page is a near copy and keeps it.

What tags and roles declare comes before what is counted: menus, headers, footers, asides, forms, scripts, styles and comments have
importance 0; an article (or main part) has importance 1 with all that has no class or id, as equal articles on a host are copies,
not templates. If a page has an article, only that is its main text.

Words of classes and ids (sidebar, advert) lower what is counted. A name is an aside name if its head is such a word (cookie-banner, adslot, but not
has-sidebar or menu-open); it lowers to ``NAMED``, a name with such a word elsewhere to ``HINTED``. On hosts with fewer pages an aside name also removes,
unless its element holds an article or most of the page's text. Names say nothing of an article, of headings, and of headers in an article; there, a
section goes by its class only, and lists and paragraphs need the tree's word.

Reader comments differ from page to page, so no tree finds them: an element goes if its name or item type says so, unless it holds all articles of
the page, and so do articles in an article that has a text of its own. What is hidden, by attribute or own style, goes too.

Blocks are what lies between the begins and ends of block elements; their white space becomes one space, and they are
joined by line ends. A line break element is white space.

Defined cases: null and empty html, and pages without text, give an empty text; broken markup is read as far as it goes (unclosed elements
end with what holds them, an unclosed tag or comment at the end is dropped); a null or strange address belongs to the
host ""; repeated pages count once in the tree and are extracted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import added, written

PART, WHOLE, COMMENTS, INNER = 1, 2, 3, 4  # hints: an aside word in a name, an aside name, one of reader comments, an article in an article
LEAST = 0.3
MIN_PAGES = 5
MIN_WORDS = 4
NAMED, HINTED = 0.5, 0.75
BROADCAST_BYTES = 16 * 1024**2  # of hosts and paths to be removed
SALTS = 64
LONGEST = 240  # characters of a path; a longer one is told by its hash, and goes on from there, at any depth
_MODULUS, _BASE = (1 << 61) - 1, 0x1F3D5B79A3C5E7F1 % ((1 << 61) - 1)

# fixed values: elements of the markup language by how they are read
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article aside body center dialog div dl footer form header main menu nav ol section table ul".split())
RAW = frozenset("script style textarea title iframe xmp".split())  # their content is no markup
UNSEEN = frozenset("head noscript template svg annotation annotation-xml object canvas select button option audio video map datalist".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD_PARTS = frozenset("base link meta noscript script style template title".split())
ENDS = {  # an open element of the first kind ends where one of the second kind begins, unless the third lies between
    "p": (BLOCKS, frozenset("td th caption button object".split())),
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th", "tr", "tbody", "tfoot"]), frozenset(["table"])),
    "th": (frozenset(["td", "th", "tr", "tbody", "tfoot"]), frozenset(["table"])),
    "tr": (frozenset(["tr", "tbody", "tfoot"]), frozenset(["table"])),
}
ASIDE_TAGS = frozenset("nav footer aside form dialog menu".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share "
    "sharing social related recommended comment comments reply replies disqus pagination pager toolbar copyright disclaimer".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies disqus".split())
HOLDER_WORDS = frozenset(  # what a name says of the box and not of its content
    "list area box slot wrap wrapper container section block unit thread widget panel inner outer region zone module group row col column "
    "item items posts articles stories links buttons icons body content".split()
)
QUALIFIERS = frozenset("has no not with without is hide show toggle".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|itemtype|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+|\d+")
_HIDDEN = re.compile(r"(?:^|[\s\"'])hidden(?=[\s=/]|$)", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)


@dataclass
class Node:
    path: str
    parent: int
    aside: bool
    article: bool
    declared: bool  # its tags decide, not what is counted
    hint: int = 0  # what its names say, see the constants
    holds: int = 0  # how many articles or main parts begin here or below
    within: bool = False  # an article
    first: int = 0  # its blocks, and those of all below it: from the first to before the last
    last: int = 0
    children: list[str] = field(default_factory=list)


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=lambda: [Node("", -1, False, False, True)])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


def _signs(attributes: str) -> tuple[str, str, list[str], str, bool, bool]:
    """What tells elements of one tag apart, the role, the classes and the id; whether it is a comment by type, and whether it is not shown."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
    unseen = bool(_NOT_SHOWN.search(found.get("style", ""))) or ("hidden" in attributes.lower() and bool(_HIDDEN.search(_QUOTED.sub("''", attributes))))
    if not found:
        return "", "", [], "", False, unseen
    sign = "".join(f"{mark}{found[name]}" for name, mark in (("class", "."), ("id", "#")) if name in found)
    comment = found.get("itemtype", "").lower().rstrip("/").endswith(("/comment", "/usercomments")) or found.get("itemprop", "").lower() == "comment"
    return re.sub(r"\d+", "0", sign), found.get("role", "").lower(), found.get("class", "").lower().split(), found.get("id", "").lower(), comment, unseen


def _head(name: str) -> str:
    """The word of a class or id that says what lies there: the last but for words of boxes, which may be written together with it.

    A name that says what its element has, or how it is, has none.
    """
    words = [w for w in _WORD.findall(name) if not w.isdigit()]
    if not words or words[0] in QUALIFIERS:
        return ""
    while len(words) > 1 and words[-1] in HOLDER_WORDS:
        words.pop()
    last = words[-1]
    if last not in ASIDE_WORDS:
        return next((last[: -len(h)] for h in HOLDER_WORDS if last.endswith(h) and last[: -len(h)] in ASIDE_WORDS), last)
    return last


def _hint(tag: str, classes: list[str], name: str, in_article: bool) -> int:
    """What the words of classes and id say."""
    if tag in HEADINGS or in_article and tag == "header":
        return 0
    heads = [_head(x) for x in (*classes, name)]
    if any(h in COMMENT_WORDS for h in heads):
        return COMMENTS
    section = in_article and (tag == "section" or "section" in classes)
    names = classes if section else [*classes, name]
    if any(x in ASIDE_WORDS for x in names) or any(h in ASIDE_WORDS for h in heads[: len(names)]):
        # in an article, only boxes go by their names alone
        return PART if in_article and tag not in ("div", "section") else WHOLE
    return int(not section and any(w in ASIDE_WORDS for x in names for w in _WORD.findall(x)))


def read_page(text: str) -> Page:
    """The containers and blocks of a page."""
    page = Page()
    stack: list[tuple[str, int, bool]] = [("", 0, True)]  # open elements, each with the container that it is (true) or lies in
    opened: dict[str, int] = defaultdict(int)  # how many of a tag are open
    pieces: list[str] = []
    in_link, link_chars, hidden, at = False, 0, 0, 0

    def flush() -> None:
        nonlocal link_chars
        if pieces:
            block = " ".join("".join(pieces).split())
            if block:
                page.blocks.append((stack[-1][1], block, min(link_chars, len(block))))
            pieces.clear()
        link_chars = 0

    def close(depth: int) -> None:
        nonlocal hidden
        while len(stack) > depth:
            tag, node, own = stack.pop()
            opened[tag] -= 1
            hidden -= tag in UNSEEN
            if own:
                page.nodes[node].last = len(page.blocks)

    def begin(tag: str, node: int) -> None:
        own = node != stack[-1][1]
        if own:
            page.nodes[node].first = len(page.blocks)
        stack.append((tag, node, own))
        opened[tag] += 1

    def say(raw: str) -> None:
        nonlocal link_chars
        if raw and not hidden:
            raw = html.unescape(raw) if "&" in raw else raw
            pieces.append(raw)
            if in_link:
                link_chars += len(raw)

    while True:
        m = _TAG.search(text, at)
        say(text[at : m.start()] if m else text[at:])
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end
            if tag == "a":
                in_link = False
            elif opened[tag]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        flush()
                        close(depth)
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            at = end.end() if end else len(text)
            continue
        if stack[-1][0] == "head" and tag not in HEAD_PARTS:
            close(len(stack) - 1)
        if tag == "br":
            say(" ")
        elif tag == "a":
            in_link = True
        elif tag in BLOCKS:
            flush()
            for kind, (begun, between) in ENDS.items():
                if tag in begun and opened[kind]:
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] == kind:
                            close(depth)
                            break
                        if stack[depth][0] in between:
                            break
            if tag not in VOID:
                begin(tag, _open(page, stack[-1][1], tag, m[3] or m[6] or ""))
        elif tag in UNSEEN:
            hidden += 1
            begin(tag, stack[-1][1])
    flush()
    close(0)
    return page


def _step(path: str, tag: str, sign: str) -> str:
    path = f"{path}>{tag}{sign}"
    return path if len(path) <= LONGEST else "#" + xxhash.xxh3_128_hexdigest(path)


def _open(page: Page, parent: int, tag: str, attributes: str) -> int:
    """The container that an element is, or the one it lies in."""
    page.nodes[parent].children.append(tag)
    if tag in ("html", "body"):
        return parent
    sign, role, classes, name, comment, unseen = _signs(attributes)
    above = page.nodes[parent]
    article = tag == "article" or role == "article"
    begins = article or tag == "main" or role == "main"
    aside = unseen or tag in ASIDE_TAGS or role in ASIDE_ROLES or (tag == "header" and not above.article)
    hint = COMMENTS if comment else 0 if aside else _hint(tag, classes, name, above.article)
    if begins and hint != COMMENTS:
        hint = INNER if article and above.within else 0
    if tag not in CONTAINERS and not aside and not hint:
        return parent
    if begins and not hint:
        at = parent
        while at >= 0:
            page.nodes[at].holds += 1
            at = page.nodes[at].parent
    begins = begins and not hint
    declared = above.aside or aside or begins or (above.article and not sign)
    within = above.within or article
    page.nodes.append(Node(_step(above.path, tag, sign), parent, above.aside or aside, above.article or begins, declared, hint, int(begins), within))
    return len(page.nodes) - 1


PARSED = (
    "host string, path string, page long, style long, text long, chars long, links long, declared boolean, hint int, at long, unit long, key long"
)


def _key(path: str, block: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{block}") >> 1


def _node_rows(page: Page, whole: int) -> Iterator[tuple]:
    """For each path of a page: style, text (as hashes), characters, those in links, and whether its tags decide."""
    # sums over the blocks so far, so that what lies below an element is a difference, however deep it is
    sums, powers, chars_to, links_to = [0], [1], [0], [0]
    for _, block, linked in page.blocks:
        sums.append((sums[-1] * _BASE + xxhash.xxh64_intdigest(block)) % _MODULUS)
        powers.append(powers[-1] * _BASE % _MODULUS)
        chars_to.append(chars_to[-1] + len(block))
        links_to.append(links_to[-1] + linked)
    texts: dict[str, int] = defaultdict(int)
    chars: dict[str, int] = defaultdict(int)
    links: dict[str, int] = defaultdict(int)
    for node in page.nodes[1:]:
        first, last, path = node.first, node.last, node.path
        if last > first:
            texts[path] = (texts[path] * powers[last - first] + sums[last] - sums[first] * powers[last - first]) % _MODULUS
            chars[path] += chars_to[last] - chars_to[first]
            links[path] += links_to[last] - links_to[first]
    seen = set()
    for node in page.nodes[1:]:
        if node.path in texts and node.path not in seen:
            seen.add(node.path)
            style = xxhash.xxh64_intdigest(" ".join(t for i, t in enumerate(node.children) if not i or node.children[i - 1] != t)) >> 1
            yield node.path, whole, style, texts[node.path], chars[node.path], links[node.path], node.declared, node.hint, None, None, None


def _text_rows(page: Page, whole: int) -> Iterator[tuple]:
    """For each block that may be main text: where it lies, itself, and the article or page that holds it (as hashes)."""
    units = [whole]
    for node in page.nodes[1:]:
        begins = node.article and not page.nodes[node.parent].article
        units.append(_blocks_hash(page, node.first, node.last) if begins else units[node.parent])
    for at, block, _ in page.blocks:
        node = page.nodes[at]
        if not node.aside and (node.article or not page.nodes[0].holds):
            key = _key(node.path, block) if len(block.split(None, MIN_WORDS - 1)) == MIN_WORDS else None
            yield *[None] * 8, xxhash.xxh64_intdigest(node.path) >> 1, units[at], key


def _blocks_hash(page: Page, first: int, last: int) -> int:
    return xxhash.xxh64_intdigest("\n".join(b for _, b, _ in page.blocks[first:last])) >> 1


def _parsed(pages: DataFrame) -> DataFrame:
    """What the tree needs of ``pages`` (url, html), from one reading of each: a row per page and path, and one per place, unit and text of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), ("path", pa.string()), *[(c, pa.int64()) for c in ("page", "style", "text", "chars", "links")]])
        schema = schema.append(pa.field("declared", pa.bool_())).append(pa.field("hint", pa.int32()))
        for c in ("at", "unit", "key"):
            schema = schema.append(pa.field(c, pa.int64()))
        for batch in batches:
            rows: dict[tuple, None] = {}
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = read_page(source or "")
                whole = _blocks_hash(page, 0, len(page.blocks))
                for found in (_node_rows(page, whole), _text_rows(page, whole)):
                    rows.update(((host, *row), None) for row in found)
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return written(pages.select(_host("url").alias("host"), "html").mapInArrow(run, PARSED), "page-parts")


def _weighed(importance, pages):
    """An importance as far as so many pages tell it."""
    return 1 - F.least(F.lit(1.0), F.log(pages) / F.log(F.lit(MIN_PAGES))) * (1 - importance)


def _repeated(parsed: DataFrame) -> DataFrame:
    """The blocks of each host whose importance is under ``LEAST``: host and key."""
    rows = parsed.where("at is not null").select("host", "at", "unit", "key").distinct()
    units = rows.select("host", "at", "unit").distinct().groupBy("host", "at").agg(F.count("*").alias("m"))
    texts = rows.where("key is not null").groupBy("host", "at", "key").agg(F.count("*").alias("n")).where("n > 1")
    both = texts.join(units, ["host", "at"])
    return both.where(_weighed(1 - F.log("n") / F.log("m"), F.col("m")) < LEAST).select("host", "key")


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)), F.lit(""))


def importance(pages: DataFrame) -> DataFrame:
    """The style tree of each host of ``pages`` (url, html): host, path, pages, presentation, content, importance, declared, hint."""
    return _tree(_parsed(pages))


def _tree(parsed: DataFrame) -> DataFrame:
    once = parsed.where("path is not null").groupBy("host", "path", "page").agg(*[F.min(c).alias(c) for c in ("style", "text", "chars", "links", "declared", "hint")])
    # one row per style and one per text of a node, summed in one pass: an entropy needs only the counts
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("style", "text")]))
    counts = once.select("host", "path", "chars", "links", "declared", "hint", kinds.alias("of")).groupBy("host", "path", "of.kind", "of.value").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("chars", "links")], *[F.max(c).alias(c) for c in ("declared", "hint")]
    )
    style, n = F.col("kind") == "style", F.col("n")
    nodes = counts.groupBy("host", "path").agg(
        F.sum(F.when(style, n)).alias("pages"),
        F.sum(F.when(style, n * F.log(n))).alias("styles"),
        F.avg(F.when(~style, F.log(n))).alias("texts"),
        (F.sum("links") / F.greatest(F.sum("chars"), F.lit(1))).alias("linked"),
        F.max("declared").alias("declared"),
        F.max("hint").alias("hint"),
    )
    m = F.col("pages")
    several = m > 1
    nodes = nodes.withColumn("presentation", F.when(several, (F.log(m) - F.col("styles") / m) / F.log(m)).otherwise(1.0))
    nodes = nodes.withColumn("content", F.when(several, 1 - F.col("texts") / F.log(m)).otherwise(1.0))
    return nodes.withColumn("importance", (F.col("presentation") + F.col("content")) / 2 * (1 - F.col("linked"))).drop("styles", "texts")


def _main_text(source: str | None, removed: frozenset[str]) -> str:
    page = read_page(source or "")
    to = [0]
    for _, block, _ in page.blocks:
        to.append(to[-1] + len(block))
    inner = [n for n in page.nodes if n.hint == INNER and page.nodes[n.parent].hint != INNER]
    inside = sum(to[n.last] - to[n.first] for n in inner)
    # articles in an article are comments on it if it has a text of its own
    outer = sum(to[n.last] - to[n.first] for n in page.nodes if n.article and not page.nodes[n.parent].article) - inside
    drop = [False]
    for node in page.nodes[1:]:
        own = to[node.last] - to[node.first]
        low = node.path in removed and not node.holds
        if node.hint == WHOLE:
            low |= f"+{node.path}" not in removed and not node.holds and 2 * own <= to[-1]
        elif node.hint == COMMENTS:
            low |= not node.holds or node.holds < page.nodes[0].holds
        elif node.hint == INNER:
            low |= 10 * outer > inside
        drop.append(drop[node.parent] or node.aside or low)
    kept = [(node, block) for node, block, _ in page.blocks if not drop[node]]
    if any(node.article and not gone for node, gone in zip(page.nodes, drop, strict=True)):
        kept = [(node, block) for node, block in kept if page.nodes[node].article]
    own = [(node, block) for node, block in kept if f"={_key(page.nodes[node].path, block)}" not in removed] if removed else kept
    if 2 * sum(len(block) for _, block in own) >= sum(len(block) for _, block in kept):
        kept = own
    return "\n".join(block for _, block in kept)


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row of ``pages`` (url, html) and its ``main_text``."""
    parsed = _parsed(pages)
    tree = _tree(parsed).where(~F.col("declared") & (F.col("pages") > 1))
    named = F.when(F.col("hint").isin(WHOLE, COMMENTS), NAMED).when(F.col("hint") == PART, HINTED).otherwise(1.0)
    lowered = _weighed(F.col("importance"), F.col("pages")) * named
    # beside the branches to be removed, with a sign before them, those named like asides that the tree keeps
    low = tree.where((lowered < LEAST) | ((F.col("hint") == WHOLE) & (F.col("pages") >= MIN_PAGES))).withColumn("path", F.when(lowered < LEAST, F.col("path")).otherwise(F.concat(F.lit("+"), "path")))
    low = low.select("host", "path").union(_repeated(parsed).select("host", F.concat(F.lit("="), F.col("key").cast("string"))))
    low = written(low.groupBy("host").agg(F.collect_list("path").alias("__removed")).withColumnRenamed("host", "__host"), "low-branches")
    rows = pages.select(*keep, F.col("html").alias("__html"), _host("url").alias("__of"))
    size = low.agg(F.sum(F.length("__host") + F.length(F.concat_ws("", "__removed")) + 16 * F.size("__removed"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(low), F.col("__of") == F.col("__host"), "left")
    else:  # a host may have most pages, so each is dealt over SALTS places
        rows = rows.withColumn("__salt", F.pmod(F.xxhash64("__html"), F.lit(SALTS)))
        low = low.withColumn("__place", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.join(low, (F.col("__of") == F.col("__host")) & (F.col("__salt") == F.col("__place")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed: dict[str, frozenset[str]] = {}
            out = []
            columns = (batch.column(c) for c in ("__html", "__of", "__removed"))
            for source, host, paths in zip(*columns, strict=True):
                host = host.as_py()
                if host not in removed:
                    removed[host] = frozenset(paths.as_py() or ())
                out.append(_main_text(source.as_py(), removed[host]))
            yield pa.RecordBatch.from_pydict({name: batch.column(name) for name in keep} | {"main_text": pa.array(out, pa.string())})

    return rows.select(*keep, "__html", "__of", "__removed").mapInArrow(run, added(pages, keep, "main_text string"))
