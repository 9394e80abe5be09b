"""Main text of web pages by equivalence-class template deduction.

Pages of one host share a template. A page is read into tokens: one for each element
(its path of tags, classes and ids) and one for each text block (its path and text).
Per host, a token has an occurrence vector, how often each page holds it; tokens with
equal vectors form an equivalence class. A class is valid if at least ``MIN_PAGES`` pages
and half of the host's hold it and an element is among it; a text of it nests where its
own path is in the template too. Texts of valid classes are the template's, what fills
the places between is a slot. Of a marked article (a main element if it holds none) no text
is taken for the template's: what its pages share there is content. Slots inside elements that name their role (menu, header,
footer, sidebar, notice, advert, form, comments) go; of the others the text is the main
one if the page marks an article, else the one of the host's richest slot.

Tags name a role for sure. A word of a class or id and a ``form`` may also sit on a wrapper,
so their elements stay if they hold an article or the host's richest slot, counted before
they go. A word that heads its class (``comments``, ``top-menu``) counts for a role, one in
passing (``has-sidebar``, ``elementor-widget-text``) doesn't: an element of the first kind is
a host's richest slot, and those of comments, related pages or adverts hold it, only if the
host has no other slot; their articles count only on pages without others, never those of
comments, related pages or adverts. Where all of a page's text is in such elements, it stays.

A vector is kept as its number of pages, its total and a sum of hashes over (page, count),
so tokens are pre-aggregated in every task and no host is ever gathered. A template holds
tokens of at least half the host's pages, hence at most twice a page's tokens. Pages meet
their host's template in a join whose small side is a stored table of known size; a hot
host is split as a skewed key. Pages themselves are not aggregated.

Defined results: a null or empty page has an empty text; a null or unreadable URL is the
host ``""``; repeated rows are pages of their own; unclosed and misnested tags close with
what encloses them, a page that breaks off ends there; where dropping the template's
texts would leave nothing, they stay; other columns are not read.
"""

from __future__ import annotations

import html as html_codec
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import python_tasks, stored, table

#: Pages that must share a class.
MIN_PAGES = 5

_MARKUP = re.compile(r"""<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z))""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "select"}
_DROP = _RAW | {"head", "nav", "footer", "aside", "button", "menu", "dialog", "label", "fieldset", "audio", "video", "canvas"}
_BLOCK = {"html", "body", "p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd",
          "table", "thead", "tbody", "tfoot", "tr", "blockquote", "pre", "figure", "figcaption", "address", "form", "fieldset", "hr", "details", "summary", "center", "menu", "dialog", "title", "head"}
_CELL = {"td", "th", "br"}
#: An opening tag ends these open elements, up to the named enclosing ones.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
         "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_SCOPES = {"article", "main", "section", "div", "td", "th", "li", "blockquote", "body", "html", "header", "footer", "nav", "aside", "form", "table", "figure", "details"}
#: Words in a class or id that name a role beside the article.
_ROLES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "sidebar", "side", "menu", "nav", "navbar", "navigation", "breadcrumb",
          "breadcrumbs", "footer", "masthead", "topbar", "notice", "notices", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search",
          "share", "sharing", "social", "related", "recommended", "comment", "comments", "disqus", "reply", "replies", "respond", "pagination", "pager", "toolbar", "widget", "widgets", "alert", "copyright", "skip"}
_DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}
#: Of these, words whose elements hold articles beside the page's own.
_BESIDE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "related", "recommended", "comment", "comments", "disqus", "reply", "replies", "respond"}
#: Words of builders and page types, which name a role only as the last of a class; words before a role that is elsewhere or missing.
_LOOSE, _NOT_HERE = {"widget", "widgets", "search", "side"}, {"has", "no", "with", "without"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


@dataclass(slots=True, eq=False)
class Role:
    """An element that a word or a form drops, if nothing speaks for it: ``sure`` if it or one around it is headed by the word."""
    path: int
    above: Role | None
    sure: bool
    beside: bool
    holds: bool = False  # an article, or on pages whose articles all are in sure roles, one of those
    holds_in_role: bool = False

    def around(self) -> Iterator[Role]:
        """This one and those it is in."""
        role = self
        while role:
            yield role
            role = role.above


@dataclass(slots=True)
class Element:
    tag: str
    path: int
    dropped: bool
    role: Role | None
    main: bool
    article: bool
    heading: bool


@dataclass(slots=True)
class Block:
    path: int
    slot: int
    text: str
    main: bool
    body: bool
    token: int
    linked: int
    role: Role | None


def _hash(*parts) -> int:
    h = xxhash.xxh64_intdigest("\x00".join(map(str, parts)))
    return h - (1 << 64) if h >> 63 else h


def _heads(name: str, roles: set[str]) -> bool:
    """Whether a role word heads a class or id, as its last or first word."""
    words = [w.lower() for w in _NAME.findall(name)]
    return bool(words) and (words[-1] in roles and not _NOT_HERE & set(words[-2:-1]) or words[0] in roles - _LOOSE)


def _open(above: Element, tag: str, attributes: str) -> Element:
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
    label = f"{found.get('class', '')} {found.get('id', '')}"
    words = {w.lower() for w in _NAME.findall(label)}
    name = found.get("role", "").lower()
    inner = tag == "article" or name == "article"
    article = inner or tag == "main" or name == "main"
    header = tag == "header" and not above.main
    dropped = above.dropped or tag in _DROP or header or name in _DROP_ROLES - {"form"}
    path, role = _hash(above.path, tag, label.strip()), above.role
    roles = _ROLES if above.main or tag in _HEADINGS else _ROLES | {"header"}
    named = bool(words & roles)
    if not dropped and (tag == "form" or name == "form" or named and tag not in ("html", "body")):
        around = (role.sure, role.beside) if role else (False, False)
        role = Role(path, role, around[0] or named and any(_heads(x, roles) for x in label.split()), around[1] or bool(words & _BESIDE))
    if article and not dropped and role and not role.beside:
        for r in role.around():
            r.holds, r.holds_in_role = r.holds or not role.sure, True
    # inside an article, its header keeps the headings only
    own_header = tag == "header" and above.main
    return Element(tag, path, dropped, role, (above.main or article) and not dropped, (above.article or inner) and not dropped, above.heading if not own_header else True)


def read_page(html: str) -> tuple[list[Block], Counter, Counter]:
    """Text blocks outside elements whose tags drop them, in page order; counts of all text tokens; counts of all element tokens."""
    stack = [Element("", 0, False, None, False, False, False)]
    blocks: list[Block] = []
    texts: Counter = Counter()
    elements: Counter = Counter()
    pieces: list[str] = []
    roles: list[Role] = []
    clean = False
    linked, at, end = 0, 0, len(html)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        pieces.clear()
        top = stack[-1]
        if text:
            frame = next((e for e in reversed(stack) if e.tag in _BLOCK), top)
            token = _hash("text", frame.path, text)
            texts[token] += 1
            if not top.dropped and (not top.heading or any(e.tag in _HEADINGS for e in stack)):
                slot = next((stack[i] for i in range(len(stack) - 1, 0, -1) if stack[i].tag in _SCOPES or stack[i].role is not stack[i - 1].role), stack[0])
                blocks.append(Block(frame.path, slot.path, text, top.main, top.article, token, linked, top.role))
        linked = 0

    def close(k: int) -> None:
        """Closes the elements from index ``k`` on."""
        if any(e.tag in _BLOCK or (e.dropped, e.role) != (stack[k - 1].dropped, stack[k - 1].role) for e in stack[k:]):
            flush()
        del stack[k:]

    while at < end:
        mark = _MARKUP.search(html, at)
        text = html[at:mark.start() if mark else end]
        if text:
            text = html_codec.unescape(text) if "&" in text else text
            pieces.append(text)
            if any(e.tag == "a" for e in stack):
                linked += len(text.strip())
        if not mark:
            break
        at = mark.end()
        if not mark[2]:
            continue
        tag = mark[2].lower()
        if mark[1]:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if k:
                close(k)
            continue
        if tag in _CELL:
            pieces.append(" ")
        if tag in _BLOCK:
            if any(e.tag == "p" for e in stack):  # a block ends an open paragraph, unless a scope opened inside it
                k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p" or stack[i].tag in _SCOPES), 0)
                if k and stack[k].tag == "p":
                    close(k)
            flush()
        if tag in _ENDS:
            ended, scope = _ENDS[tag]
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in ended or stack[i].tag in scope), 0)
            if k and stack[k].tag in ended:
                close(k)
        if tag in _VOID:
            continue
        element = _open(stack[-1], tag, mark[3])
        elements[_hash("element", element.path)] += 1
        if tag in _RAW:
            found = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = found.end() if found else end
            continue
        clean = clean or element.main and not (element.role and (element.role.sure or element.role.beside))
        if element.role is not stack[-1].role:
            roles.append(element.role)
        if element.dropped and not stack[-1].dropped or element.role is not stack[-1].role:
            flush()
        if not mark[3].rstrip().endswith("/") or tag in _BLOCK:
            stack.append(element)
    flush()
    for r in roles:
        r.holds = r.holds or r.holds_in_role and not clean
    if not any(b.body for b in blocks):  # a main element without an article is the article
        for b in blocks:
            b.body = b.main
    return blocks, texts, elements


def main_text(html: str | None, template: set[int] = frozenset(), slot: int | None = None, holders: set[int] = frozenset()) -> str:
    """The main text of one page, given its host's template tokens, richest slot and role elements that hold the richest slots."""
    if not html:
        return ""
    blocks, _, _ = read_page(html)
    blocks = [b for b in blocks if not b.role or all(r.holds or r.path in holders for r in b.role.around())] or blocks
    chosen = [b for b in blocks if b.main]
    if not chosen:
        chosen = [b for b in blocks if 2 * b.linked <= len(b.text)]
        rich = [b for b in chosen if b.slot == slot]
        if rich:
            first, last = chosen.index(rich[0]), len(chosen) - 1 - chosen[::-1].index(rich[-1])
            chosen = chosen[first:last + 1]
    own = [b for b in chosen if b.body or b.token not in template or _hash("element", b.path) not in template]
    return "\n".join(b.text for b in own or chosen)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, token, kind, page, n, holders): kind 0 for texts, 1 for elements; 2 for slots, whose n is their characters and
    whose holders are the role elements around, 3 for those in articles, 4 for those that are sure roles themselves or beside the article."""
    for batch in batches:
        rows: list[tuple[int, int, int, int, list[int] | None]] = []
        for i, html in enumerate(batch.column("html").to_pylist()):
            if not html:
                continue
            blocks, texts, elements = read_page(html)
            slots: Counter = Counter()
            holders: dict[int, list[int]] = {}
            for b in blocks:
                sure = b.role is not None and b.role.sure
                if not (b.main and sure) and 2 * b.linked <= len(b.text):
                    slots[b.slot, 3 if b.main else 4 if sure and (b.role.beside or b.role.path == b.slot) else 2] += len(b.text)
                    if b.role:
                        holders[b.slot] = [r.path for r in b.role.around()]
            rows += [(i, t, kind, n, None) for kind, tokens in enumerate((texts, elements)) for t, n in tokens.items()]
            rows += [(i, s, kind, n, holders.get(s)) for (s, kind), n in slots.items()]
        at, token, kind, n = (pa.array([r[k] for r in rows], pa.int64()) for k in range(4))
        yield pa.RecordBatch.from_arrays([batch.column("host").take(at), token, kind, batch.column("page").take(at), n, pa.array([r[4] for r in rows], pa.list_(pa.int64()))],
                                         names=["host", "token", "kind", "page", "n", "holders"])


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, template, slot, holders): the tokens of a host's valid classes, its richest slot outside articles, and the
    role elements around that and around the richest slot in articles. ``pages``: host, page (a hash), html."""
    python_tasks(pages.sparkSession)
    rows = pages.select("host", "page", "html").mapInArrow(_tokens, "host string, token bigint, kind bigint, page bigint, n bigint, holders array<bigint>")
    vectors = stored(rows.groupBy("host", "token", "kind").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("total"), F.sum(F.xxhash64("page", "n").cast("decimal(20,0)")).alias("vector"), F.max("holders").alias("holders"))
                     .filter((F.col("pages") >= min_pages) | (F.col("kind") >= 2)))
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    classes = (vectors.filter("kind < 2").join(sizes, "host").filter(2 * F.col("pages") >= F.col("of"))
               .groupBy("host", "pages", "total", "vector").agg(F.collect_set("token").alias("tokens"), F.max("kind").alias("structured")).filter("structured = 1"))
    tokens = classes.select("host", F.explode("tokens").alias("token")).groupBy("host").agg(F.sort_array(F.collect_set("token")).alias("template"))
    best = lambda kind: F.max_by(F.struct("token", "holders"), F.when(F.col("kind") == kind, F.struct("total", "token"))).alias(f"k{kind}")
    none = F.array().cast("array<bigint>")
    slots = (vectors.filter("kind >= 2").groupBy("host").agg(best(2), best(3), best(4))
             .withColumn("k2", F.when(F.col("k2").isNull() & F.col("k3").isNull(), F.col("k4")).otherwise(F.col("k2")))
             .select("host", F.col("k2.token").alias("slot"), F.array_union(F.coalesce("k2.holders", none), F.coalesce("k3.holders", none)).alias("holders")))
    return tokens.join(slots, "host", "full").select("host", "template", "slot", "holders")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets: dict[str, tuple[set[int], set[int]]] = {}
    for batch in batches:
        out = []
        for html, host, template, slot, holders in zip(*(batch.column(c).to_pylist() for c in ("html", "host", "template", "slot", "holders"))):
            if host not in sets:
                if len(sets) > 1000:
                    sets.clear()
                sets[host] = set(template or ()), set(holders or ())
            out.append(main_text(html, sets[host][0], slot, sets[host][1]))
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.string())], names=["_row", "_main"])


def extract(pages: DataFrame, html: str = "html", url: str = "url", columns: list[str] | None = None, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: its columns in struct ``_row`` and the main text ``_main``."""
    python_tasks(pages.sparkSession)
    columns = pages.columns if columns is None else columns
    rows = pages.select(F.struct(*columns).alias("_row"), host_of(url).alias("host"), F.xxhash64(F.col(url), F.md5(F.col(html).cast("binary"))).alias("page"), F.col(html).alias("html"))
    known = stored(templates(rows, min_pages))
    row = pages.select(*columns).schema.simpleString()[len("struct<"):-1]
    return rows.drop("page").join(known, "host", "left").select("_row", "html", "host", "template", "slot", "holders").mapInArrow(_extract, f"_row struct<{row}>, _main string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), columns=["page_id", "url"])
    return found.select(F.col("_row.page_id").alias("page_id"), F.col("_row.url").alias("url"), F.col("_main").alias("text"), F.length("_main").cast("bigint").alias("n_chars"))
