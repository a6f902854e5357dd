"""Main text of web pages by deducing each host's template from its pages.

Every page is cut into tokens: structural elements, known by their path, and
blocks of text, known by path and words. A token's occurrence vector says how
often it stands in each page of the host; tokens with equal vectors form an
equivalence class. Classes of at least two elements or words in at least half
of a host's pages are looked at in every page: a token is ordered if it follows
its class's order, and nested if all it has in the page lies in one gap between
tokens of the host's root class, the same gap from page to page. Tokens that
are so in enough pages form the template, if their class still has its size.
Text of the template is constant.

What lies between is slots: the elements that hold blocks, lists and tables
counted to the element around them. A slot all of whose blocks are constant is
template; every other slot varies, and a page gives the blocks of all of those
in page order, without the parts that are marked as navigation, notices,
adverts, forms, comments and the like. That a slot lies in an article or main
element is one of its features: where a page has such slots, only they are
looked at.

A page is parsed once. Its tokens and blocks are written, and vectors, nesting
and text are read from there.

Vectors are never gathered: each is kept as its number of pages and two
commutative hashes, combined before the shuffle, so a host with a third of all
pages is a few rows per task. Classes in half of the pages bound a template by
the size of two pages. Hosts with one page have no template, so all their slots
count as varying, and a page without any slot that varies (a copy of most
others) gives all its blocks. Null and empty pages have an empty text. Repeated
rows are pages of their own. Pages of any length are read whole, one row a page.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import arrow_bounded, ddl, renamed, slices
from .url_templates import host_and_path

# HTML's element names by their part in a page.
RAW = "script|style|noscript|template|textarea|svg|math|iframe|select|object|canvas|audio|video|title|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav header footer aside form menu dialog button label fieldset head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: Words of class, id and role values that mark a part as not the article.
NOT_MAIN = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu menubar sidebar aside footer masthead cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments reply replies respond discussion disqus related recommended "
    "breadcrumb breadcrumbs pagination pager widget widgets search toolbar toc skip complementary contentinfo".split()
)
SITE_HEADER = frozenset("header topbar site-header page-header".split())
MAIN_ROLES = frozenset(["main", "article"])

_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\b[^>]*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)>|<[!?/][^>]*>|[^<]+|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    aside: bool
    at: int  # elements that begin before it


@dataclass
class Page:
    """The blocks of a page and the path and place of each of its structural elements."""

    blocks: list[Block] = field(default_factory=list)
    nodes: list[tuple[tuple[str, ...], bool]] = field(default_factory=list)


def parse(source: str) -> Page:
    """A tolerant reading: unknown end tags are skipped, missing ones implied, everything open closes at the end."""
    page = Page()
    stack: list[tuple[str, str, bool, int]] = []  # tag, step of the path, aside, node
    text: list[str] = []

    def flush():
        words = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if words:
            inner = [s for s in stack if s[3] >= 0]
            page.blocks.append(Block(tuple(s[1] for s in inner), words, any(s[2] for s in stack), len(page.nodes)))

    def close(tag):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                flush()
                del stack[i:]
                return True
        return False

    for m in _TOKEN.finditer(source):
        tag = m[3]
        if tag is None:
            piece = m[0]
            if m[1] is None and (piece[0] != "<" or piece == "<"):
                text.append(piece)
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            elif m[2]:
                if any(s[0] == tag and s[2] for s in stack):
                    close(tag)
            elif m[4].strip() and not m[4].rstrip().endswith("/") and tag not in VOID and _marked(tag, m[4], stack)[1]:
                flush()
                stack.append((tag, tag, True, -1))
            continue
        if m[2]:
            if tag == "p" and not any(s[0] == "p" for s in stack):
                flush()
            else:
                close(tag)
            continue
        flush()
        if tag in CLOSES_P and any(s[0] == "p" for s in stack):
            close("p")
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in (tag, *(("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else ())):
                    del stack[i:]
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table", "select", "tr" if tag != "tr" else "table"):
                    break
        if tag in VOID or m[4].rstrip().endswith("/") and tag in ("path", "br", "hr"):
            continue
        name, aside = _marked(tag, m[4], stack)
        node = -1
        if tag not in ("p", "li", "td", "th", "tr", "tbody", "thead", "dt", "dd", "pre", "blockquote", "figure", "figcaption") and tag not in HEADINGS:
            node = len(page.nodes)
            page.nodes.append(((*(s[1] for s in stack if s[3] >= 0), name), aside or any(s[2] for s in stack)))
        stack.append((tag, name, aside, node))
    flush()
    return page


def _marked(tag: str, attributes: str, stack) -> tuple[str, bool]:
    """(step of the path, whether the element is no part of an article)."""
    aside = tag in ASIDE
    name = tag
    inside = any(s[1].split(".")[0] in ("article", "main") for s in stack)
    if aside and tag == "header" and inside:
        aside = False  # an article's own heading
    for key, a, b, c in _ATTRIBUTE.findall(attributes) if "=" in attributes or "hidden" in attributes else ():
        key, value = key.lower(), (a or b or c).lower()
        if key in ("class", "id", "role", "itemprop"):
            words = value.split()
            parts = {p for w in words for p in _NAME.findall(w)}
            if parts & NOT_MAIN or (not inside and tag not in HEADINGS and SITE_HEADER & set(words)):
                aside = aside or tag not in ("html", "body", "main", "article")
            if key == "role" and value in MAIN_ROLES or key == "itemprop" and "articlebody" in value:
                name = "main"
            elif key in ("class", "id"):
                name += "." + ".".join(_NAME.findall(value))
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            aside = aside or tag not in ("html", "body")
    return name, aside


def _is_main(step: str) -> bool:
    return step.split(".")[0] in ("article", "main")


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts).encode()) - (1 << 63)


#: Elements that shape text inside a slot.
LISTS = frozenset("ul ol dl table".split())


def _text_token(block: Block) -> int:
    return _hash("text", "/".join(block.path), block.text)


def _slot(path: tuple[str, ...]) -> tuple[str, ...]:
    """The element that a block's path counts to."""
    while path and path[-1].split(".")[0] in LISTS:
        path = path[:-1]
    return path


def main_text(texts: list[str], tokens: list[int], slots: list[int], marked: list[bool], constant: frozenset[int]) -> str:
    """Blocks of the slots that vary, of those in article and main elements where the page has any, joined by an empty line."""
    pool = [i for i, m in enumerate(marked) if m] or range(len(texts))
    varying = {slots[i] for i in pool if tokens[i] not in constant}
    return "\n\n".join(texts[i] for i in [i for i in pool if slots[i] in varying] or pool)


def sequence(page: Page) -> list[tuple[int, int]]:
    """(token, number of words) of a page in its order; elements have no words."""
    out, blocks = [], iter(page.blocks)
    block = next(blocks, None)
    for i in range(len(page.nodes) + 1):
        while block is not None and block.at <= i:
            if not block.aside:
                out.append((_text_token(block), block.text.count(" ") + 1))
            block = next(blocks, None)
        if i < len(page.nodes):
            out.append((_hash("node", "/".join(page.nodes[i][0])), 0))
    return out


#: What is kept of a page: its tokens with their numbers of words, and its blocks with their tokens, slots and whether they are in an article.
PARSED = "_tokens array<bigint>, _words array<int>, _texts array<string>, _blocks array<bigint>, _slots array<bigint>, _marked array<boolean>"
PARSED_TYPES = [pa.list_(kind) for kind in (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_())]
PARSED_NAMES = [part.split()[0] for part in PARSED.split(", ")]


def parsed(source: str | None) -> tuple[list, ...]:
    """The values of ``PARSED`` for a page."""
    page = parse(source or "")
    tokens = sequence(page)
    here = [b for b in page.blocks if not b.aside]
    return (
        [t for t, _ in tokens],
        [w for _, w in tokens],
        [b.text for b in here],
        [_text_token(b) for b in here],
        [_hash("slot", "/".join(_slot(b.path))) for b in here],
        [any(map(_is_main, b.path)) for b in here],
    )


def parse_pages(pages: DataFrame, source: str, keep: list[str]) -> DataFrame:
    """The written table of what is kept of every page, with the columns ``keep``."""
    schema = ", ".join([ddl(pages.select(*[F.col(f"`{c}`") for c in keep])), PARSED])

    def run(batches):
        for batch in batches:
            for part in slices(batch, source):
                columns = zip(*(parsed(t) for t in part.column(source).to_pylist()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(list(c), k) for c, k in zip(columns, PARSED_TYPES))], [*keep, *PARSED_NAMES])

    return stored(pages.mapInArrow(run, schema), "pages-parsed")


TOKEN_SCHEMA = "host string, token bigint, size bigint, text boolean, times bigint, place double, one bigint, two bigint"
NESTED_SCHEMA = "host string, token bigint, gap bigint, pages bigint"


def _record_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def page_tokens(pages: DataFrame) -> DataFrame:
    """Tokens of every parsed page of (_host, _uid); one and two are hashes of the page and of how often the token stands in it."""

    def run(batches):
        for batch in batches:
            rows = []
            for host, uid, tokens, words in zip(*(batch.column(c).to_pylist() for c in ("_host", "_uid", "_tokens", "_words"))):
                counts: dict[int, list] = {}
                for place, (token, n) in enumerate(zip(tokens, words)):
                    counts.setdefault(token, [0, place, max(n, 1), n > 0])[0] += 1
                for token, (n, place, size, text) in counts.items():
                    mixed = xxhash.xxh3_64_intdigest(f"{uid}:{n}")
                    rows.append((host, token, size, text, n, float(place), mixed >> 33, mixed & 0x7FFFFFFF))
            yield _record_batch(rows, TOKEN_SCHEMA)

    return pages.select("_host", "_uid", "_tokens", "_words").mapInArrow(run, TOKEN_SCHEMA)


def _rising(values: list[int]) -> set[int]:
    """Places of a longest rising subsequence."""
    ends: list[int] = []
    tails: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        at = bisect.bisect_left(tails, v)
        before[i] = ends[at - 1] if at else -1
        tails[at : at + 1], ends[at : at + 1] = [v], [i]
    i, out = ends[-1] if ends else -1, set()
    while i >= 0:
        out.add(i)
        i = before[i]
    return out


def gaps(tokens: list[int], classes: dict[int, tuple[int, int]]) -> dict[int, int]:
    """The gap of the root class that each token of a page lies in, -1 for tokens out of their class's order or in several gaps.

    ``classes`` has each token's class, 0 for the root, and its rank there.
    """
    times: Counter[int] = Counter()
    by_class: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for at, token in enumerate(tokens):
        if token in classes:
            c, rank = classes[token]
            # The n-th of each token of a class belong to its n-th occurrence.
            by_class[c].append(((times[token] << 32) + rank, at, token))
            times[token] += 1
    out: dict[int, int] = {}
    root: list[int] = []
    for c in sorted(by_class, key=lambda c: c != 0):
        found = by_class[c]
        ordered = _rising([f[0] for f in found])
        if c == 0:
            root = [found[i][1] for i in sorted(ordered)]
            ranks = [found[i][0] + 1 for i in sorted(ordered)]
        for i, (_, at, token) in enumerate(found):
            before = bisect.bisect_left(root, at)
            gap = -1 if i not in ordered else 0 if c == 0 or not before else ranks[before - 1]
            out[token] = gap if out.get(token, gap) == gap else -1
    return out


def nested(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """In how many parsed pages a token is in order and in a gap; ``classes`` is (host, token, class, rank)."""
    each = stored(classes.groupBy("host").agg(F.collect_list(F.struct("token", "class", "rank")).alias("classes")), "page-classes")
    joined = pages.select(F.col("_host").alias("host"), F.col("_tokens").alias("tokens")).join(_few(each, "classes"), "host")

    def run(batches):
        for batch in batches:
            found: Counter[tuple] = Counter()
            for host, tokens, known in zip(*(batch.column(c).to_pylist() for c in ("host", "tokens", "classes"))):
                for token, gap in gaps(tokens, {k["token"]: (k["class"], k["rank"]) for k in known}).items():
                    if gap >= 0:
                        found[host, token, gap] += 1
            yield _record_batch([(*k, n) for k, n in found.items()], NESTED_SCHEMA)

    counts = joined.select("host", "tokens", "classes").mapInArrow(run, NESTED_SCHEMA).groupBy("host", "token", "gap").agg(F.sum("pages").alias("held"))
    return counts.groupBy("host", "token").agg(F.max("held").alias("held"))


def deduce(pages: DataFrame, share: float = 0.5, text_share: float = 0.8, size: int = 2) -> DataFrame:
    """(host, constant): the tokens of the text blocks of each host's template, from parsed pages.

    ``share`` of a host's pages must hold a class's tokens, in order and nested,
    and ``text_share`` of them a text block; a class has ``size`` elements or words.
    """
    tokens = page_tokens(pages).groupBy("host", "token").agg(
        F.count("*").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two"), F.max("size").alias("size"), F.max("text").alias("text"), F.max("times").alias("times"), F.avg("place").alias("place")
    )
    number = pages.groupBy(F.col("_host").alias("host")).agg(F.count("*").alias("pages"))
    often = stored(tokens.where("n > 1").join(number, "host").where(F.col("n") >= share * F.col("pages")), "page-tokens")
    vector = Window.partitionBy("host", "n", "one", "two")
    large = often.withColumn("members", F.sum("size").over(vector)).where(F.col("members") >= size)
    # Bounded: every row stands in at least `share` of the host's pages. The root class stands once in each of the most pages.
    by_class = Window.partitionBy("host").orderBy((F.col("times") > 1).cast("int"), F.desc("n"), F.desc("members"), "one", "two")
    ranked = large.withColumn("class", F.dense_rank().over(by_class) - 1).withColumn("rank", F.row_number().over(Window.partitionBy("host", "class").orderBy("place", "token")))
    ranked = stored(ranked.select("host", "token", F.col("class").cast("bigint"), F.col("rank").cast("bigint"), "size", "text", "pages"), "page-ranks")
    held = ranked.join(nested(pages, ranked), ["host", "token"]).where(F.col("held") >= share * F.col("pages"))
    valid = held.withColumn("members", F.sum("size").over(Window.partitionBy("host", "class"))).where(F.col("members") >= size)
    return valid.where(F.col("text") & (F.col("held") >= text_share * F.col("pages"))).groupBy("host").agg(F.collect_list("token").alias("constant"))


#: Tokens of templates that may be sent to every task; beyond, pages are joined to them by host.
TEMPLATE_TOKENS = 1_000_000


def _few(templates: DataFrame, tokens: str) -> DataFrame:
    total = templates.agg(F.coalesce(F.sum(F.size(tokens) + 8), F.lit(0))).first()[0]
    return F.broadcast(templates) if total <= TEMPLATE_TOKENS else templates


def extract(df: DataFrame, id_col: str = "page_id", url: str = "url", source: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add ``text`` to every row; columns of that name, or of those used on the way (``_host``, ``_tokens`` and so on), are replaced. ``keep`` are the columns to return beside it, all by default."""
    arrow_bounded(df.sparkSession)
    host, _ = host_and_path(F.col(f"`{url}`"))
    uid = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{url}`"), F.col(f"`{source}`"))
    own = ["text", "_html", "_host", "_uid", "_constant", *PARSED_NAMES]
    rows = renamed(df, own)
    kept = [c for c in rows.columns if keep is None or c in keep]
    plain = {"_html": F.col(f"`{source}`"), "_host": host, "_uid": uid}
    before = df.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(n) for n, c in plain.items()])
    pages = parse_pages(before, "_html", [*kept, "_host", "_uid"])
    templates = stored(deduce(pages), "page-templates")
    side = templates.select(F.col("host").alias("_host"), F.col("constant").alias("_constant"))
    joined = pages.join(_few(side, "_constant"), "_host", "left").select(*[F.col(f"`{c}`") for c in kept], *PARSED_NAMES[2:], "_constant")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in before.schema.fields[: len(kept)]] + ["text string"])

    def run(batches):
        for batch in batches:
            known = [frozenset(c or ()) for c in batch.column("_constant").to_pylist()]
            texts = [main_text(*page) for page in zip(*(batch.column(n).to_pylist() for n in PARSED_NAMES[2:]), known)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, "text"])

    return joined.mapInArrow(run, schema)
