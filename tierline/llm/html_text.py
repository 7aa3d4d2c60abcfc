"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from one template. The template's tokens are told from content by how they occur:
over the pages of a host, tokens of one template part have the same vector of occurrences. A token is an
element by its path from the root (names, classes and ids), or a whole text at its path. Occurrence vectors
are not built: a sum of hashes of (page, count) over the pages is equal for equal vectors and is an ordinary
aggregate. Tokens with equal sums form a class; classes that occur in enough pages are valid, and those
whose tokens lie below tokens of valid classes nest into the template, a tree. Content fills its slots.

A slot belongs to the article if the template says so: below an article or main element if it has one, else
below the element with most text outside links. Slots of menus, notices, forms and the like are left out by the
names of their elements, but for wrappers that hold most of the article. A text that the template repeats inside a
slot is left out where it can be no part of the article: at the slot's beginning or end, and in a class with elements
around the slots. Repeated headings and sentences between a page's own texts stay, and so does what near-copies
share. Copies of one page count as one page of the host, so that a text does not become template by being copied.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Columns, map_columns, small_batches, staged, table

# A class is valid if it occurs in this share of the host's pages, and in this number of pages.
SUPPORT = 0.5
LEAST_PAGES = 3
# Longer paths are hashed.
LONGEST_PATH = 200

# Elements and words of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
LEAVES = frozenset("p li h1 h2 h3 h4 h5 h6 td th tr dd dt blockquote pre figcaption".split())
AUTO_CLOSE = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = frozenset("html body div td th li section article main aside nav header footer form table ul ol dl".split())
BOILERPLATE_TAGS = frozenset(
    "nav footer aside form script style noscript iframe svg math button select input textarea dialog template"
    " menu head object embed canvas".split()
)
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar note".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation"
    " menu breadcrumb breadcrumbs header masthead footer sidebar aside widget notice notices cookie cookies consent"
    " gdpr newsletter subscribe subscription signup popup modal overlay alert comment comments disqus reply replies"
    " respond related recommended recommendations share sharing social toolbar pagination pager login search"
    " copyright disclaimer".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies ad ads advert advertisement sponsored promo".split())
DISCUSSION_WORDS = frozenset("comment comments disqus reply replies respond".split())
MAIN_TAGS = frozenset(("article", "main"))
# Names that headings, and parts of an article, may have and still be text of the article.
HEADING_WORDS = frozenset(("header", "masthead", "banner"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+", re.IGNORECASE)


@dataclass(frozen=True)
class Element:
    """An element with its path; ``main``, ``boilerplate`` and ``hard`` also hold for what lies inside.

    ``hard`` is boilerplate by a tag, a role or by being hidden. ``named`` is what marks the element itself
    by its names: a part of a name, a whole name, or a name of discussions.
    """

    name: str
    path: str
    main: bool
    boilerplate: bool
    hard: bool = False
    named: str = ""
    starts_main: bool = False
    parent: Element | None = field(default=None, repr=False, compare=False)

    @property
    def leaf(self) -> bool:
        return self.name in LEAVES


@dataclass
class Block:
    """A text between block boundaries with the element that holds it; ``links``: characters inside links."""

    element: Element
    text: str
    links: int


ROOT = Element("", "", False, False)


def _inside(element: Element | None, name: str) -> bool:
    while element is not None and element.name != name:
        element = element.parent
    return element is not None


def _element(parent: Element, name: str, attributes: str, wrappers: set[str] | frozenset[str] = frozenset()) -> Element:
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    label = name + "".join(
        f"{sign}{' '.join(sorted(found[k].split()))}" for k, sign in (("class", "."), ("id", "#")) if found.get(k)
    )
    path = f"{parent.path}/{label}"
    if len(path) > LONGEST_PATH:
        path = f"~{xxhash.xxh64_hexdigest(path.encode('utf-8', 'surrogatepass'))}"
    role = found.get("role", "").lower()
    names = {w.lower() for k in ("class", "id") for w in _WORD.findall(found.get(k, ""))}
    if parent.main or name in HEADINGS:
        names -= HEADING_WORDS
    is_main = name in MAIN_TAGS or role == "main" or found.get("itemprop", "").lower() == "articlebody"
    hit: set[str] = set()
    barred = False
    if name == "article":
        # A whole class name on the article of a page, any part of one on an article inside it.
        own = names if _inside(parent, "article") else set(found.get("class", "").lower().split())
        hit = own & COMMENT_WORDS
    elif name not in ("html", "body", "main"):
        barred = name in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES or (name == "header" and not parent.main)
        hit = names & BOILERPLATE_WORDS
    hidden = name not in ("html", "body") and bool(attributes) and bool(_HIDDEN.search(attributes))
    named = ""
    if hit and path not in wrappers:
        whole = {w for k in ("class", "id") for w in found.get(k, "").lower().split()}
        named = "discussion" if hit & DISCUSSION_WORDS or name == "article" else "whole" if hit & whole else "part"
    hard = parent.hard or hidden or barred
    boilerplate = parent.boilerplate or hard or bool(named)
    return Element(name, path, parent.main or is_main, boilerplate, hard, named, is_main, parent)


class Parser:
    """Elements and blocks of a page, in page order; broken markup is read as far as it goes.

    Names do not mark wrappers (see ``_wrappers``), so a page with any is read again.
    """

    def __init__(self, page: str):
        self.wrappers: frozenset[str] = frozenset()
        self._start(page)
        self.wrappers = self._wrappers()
        if self.wrappers:
            self._start(page)

    def _start(self, page: str) -> None:
        self.stack = [ROOT]
        self.blocks: list[Block] = []
        self.opened: list[Element] = []
        self._known: dict[tuple, Element] = {}
        self._parts: list[str] = []
        self._holder = ROOT
        self._links = 0
        self._read(page)

    def _read(self, page: str) -> None:
        at = 0
        while m := _TAG.search(page, at):
            self._text(page[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._close(name)
                continue
            self._open(name, m[3] or m[6] or "")
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                at = end.start() if end else len(page)
        self._text(page[at:])
        self._end_block()

    def _wrappers(self) -> frozenset[str]:
        """Elements that names mark although they hold more than half of the article's text, outside links.

        Parts of names (has-sidebar, ad-free) mark no such element, and whole names none that has the article or
        main element inside; names of discussions always mark. The article's text is that in article and
        main elements, or all text if there is none.
        """
        seen = [b for b in self.blocks if not b.element.hard]
        if not any(b.element.boilerplate for b in seen):
            return frozenset()
        main = any(b.element.main for b in seen)
        total, held = 0, defaultdict(int)
        for b in seen:
            size, around, inner, up = max(0, len(b.text) - b.links), set(), False, b.element
            while up is not None and up.named != "discussion":
                if up.named == "part" or (up.named == "whole" and inner):
                    around.add(up.path)
                inner = inner or (up.starts_main and not up.named)
                up = up.parent
            if up is None and b.element.main == main:
                total += size
                for path in around:
                    held[path] += size
        return frozenset(path for path, size in held.items() if 2 * size > total)

    def _text(self, text: str) -> None:
        if not text:
            return
        if not self._parts:
            self._holder = self._block_element()
        self._parts.append(text)
        if any(e.name == "a" for e in self.stack[-3:]):
            self._links += len(text)

    def _block_element(self) -> Element:
        return next(e for e in reversed(self.stack) if e.name not in INLINE)

    def _end_block(self) -> None:
        if self._parts:
            text = " ".join(html.unescape("".join(self._parts)).split())
            if text:
                self.blocks.append(Block(self._holder, text, self._links))
        self._parts, self._links = [], 0

    def _pop_to(self, names: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name in names:
                del self.stack[i:]
                return
            if self.stack[i].name in scope:
                return

    def _open(self, name: str, attributes: str) -> None:
        if name in INLINE:
            if name == "br":
                self._text(" ")
        else:
            self._end_block()
            self._pop_to({"p"}, P_SCOPE)
        if name in AUTO_CLOSE:
            self._pop_to(*AUTO_CLOSE[name])
        key = (self.stack[-1].path, self.stack[-1].boilerplate, self.stack[-1].main, name, attributes)
        element = self._known.get(key)
        if element is None:
            element = self._known[key] = _element(self.stack[-1], name, attributes, self.wrappers)
        if name in INLINE and element.boilerplate and not self.stack[-1].boilerplate:
            self._end_block()
        if name not in INLINE or name == "a":
            self.opened.append(element)
        if name not in VOID and not attributes.rstrip().endswith("/"):
            self.stack.append(element)
            if name in INLINE and element.boilerplate:
                # The block's holder is not inline; a hidden inline part gets a block of its own.
                self._holder = element

    def _close(self, name: str) -> None:
        if name not in INLINE:
            self._end_block()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name == name:
                if name in INLINE and self.stack[i].boilerplate and not self.stack[i - 1].boilerplate:
                    if self._parts:
                        self._holder = self.stack[i]
                    self._end_block()
                del self.stack[i:]
                return
            if name in INLINE and self.stack[i].name not in INLINE:
                return


def _text_token(block: Block) -> str:
    return f"{block.element.path}={xxhash.xxh64_hexdigest(block.text.encode('utf-8', 'surrogatepass'))}"


def host_of(url):
    """Host of a URL in lower case without its port; the empty host for anything else."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def page_tokens(pages: DataFrame) -> DataFrame:
    """One row per page and token: how often the token occurs, what it is, and the text in it.

    ``pages``: host, tag (of the page), html. ``parent`` is the element that holds the token (null for a page,
    whose token is empty); ``is_text`` tells whole texts from elements.
    """

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out = {c: [] for c in ("host", "tag", *TOKEN)}
            for host, tag, page in zip(batch["host"], batch["tag"], batch["html"], strict=True):
                rows = {"": ["", None, False, False, False, False, 1, 0, 0]}
                parsed = Parser(page or "")
                for e in [ROOT, *parsed.opened]:
                    if e.path:
                        new = [e.path, e.parent.path, False, e.main, e.boilerplate, e.leaf, 0, 0, 0]
                        rows.setdefault(e.path, new)[6] += 1
                for b in parsed.blocks:
                    e = b.element
                    if e.path in rows:
                        rows[e.path][7] += len(b.text)
                        rows[e.path][8] += min(b.links, len(b.text))
                    token = _text_token(b)
                    rows.setdefault(token, [token, e.path, True, e.main, e.boilerplate, True, 0, 0, 0])[6] += 1
                for row in rows.values():
                    for c, v in zip(out, (host, tag, *row), strict=True):
                        out[c].append(v)
            yield out

    schema = (
        "host string, tag bigint, token string, parent string, is_text boolean, main boolean,"
        " boilerplate boolean, leaf boolean, n bigint, chars bigint, links bigint"
    )
    return map_columns(pages.select("host", "tag", "html"), run, schema)


TOKEN = ("token", "parent", "is_text", "main", "boilerplate", "leaf", "n", "chars", "links")


def host_templates(tokens: DataFrame) -> DataFrame:
    """host, pages, tokens: per host the tokens that occur in enough pages, each with its class.

    Tokens are counted with an ordinary aggregate, so pages of one host are spread over all tasks. The
    two hash sums have 32 bits a page, so they cannot overflow; both and the count agree by chance only.
    """
    print_ = F.xxhash64("tag", "n")
    low = F.sum(print_.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low")
    high = F.sum(F.shiftrightunsigned(print_, 32)).alias("high")
    # What a token is follows from its name, but for elements that some pages hide, or where they are no wrappers;
    # such pages leave them out by themselves.
    facts = [F.max(c).alias(c) for c in ("parent", "is_text", "main", "leaf")] + [F.min("boilerplate").alias("boilerplate")]
    text = [F.sum(c).alias(c) for c in ("chars", "links")]
    counted = tokens.groupBy("host", "token").agg(F.count("*").alias("seen"), low, high, *facts, *text)
    sums = staged(counted.where(F.expr("token = ''") | (F.col("seen") >= LEAST_PAGES)), "tokens")
    pages = sums.where("token = ''").select("host", F.col("seen").alias("pages"))
    enough = (F.col("seen") >= LEAST_PAGES) & (F.col("seen") >= SUPPORT * F.col("pages"))
    # At most 1 / SUPPORT times the tokens of a mean page pass.
    group = F.xxhash64("low", "high", "seen").alias("group")
    columns = ["token", "parent", "is_text", "main", "boilerplate", "leaf", "seen", group, "chars", "links"]
    return (
        sums.join(pages, "host")
        .where(enough & (F.col("token") != ""))
        .groupBy("host")
        .agg(F.max("pages").alias("pages"), F.array_sort(F.collect_list(F.struct(*columns))).alias("tokens"))
    )


@dataclass
class Template:
    """A host's template: its elements (nodes), those whose slots hold the article, and its repeated texts.

    ``texts`` are those whose class reaches beyond the slots; a class of texts alone, as copies share, is no template.
    """

    nodes: set[str] = field(default_factory=set)
    content: set[str] = field(default_factory=set)
    texts: set[str] = field(default_factory=set)
    has_main: bool = False

    @classmethod
    def of(cls, pages: int, tokens: list[dict]) -> Template:
        size: dict[int, int] = defaultdict(int)
        for t in tokens:
            size[t["group"]] += 1
        # A class of one token says little, unless the token is in all pages.
        valid = {t["token"]: t for t in tokens if size[t["group"]] > 1 or t["seen"] == pages}
        made = cls()
        # Classes nest: a token belongs to the template if all elements around it do.
        for token in valid:
            around, path = [], token
            while path and path in valid and path not in made.nodes:
                around.append(path)
                path = valid[path]["parent"]
            if not path or path in made.nodes:
                made.nodes.update(p for p in around if not valid[p]["is_text"])
                made.texts.update(p for p in around if valid[p]["is_text"])
        made._choose({p: valid[p] for p in made.nodes})
        around = {valid[p]["group"] for p in made.nodes if valid[p]["parent"] not in made.content}
        made.texts = {p for p in made.texts if valid[p]["group"] in around}
        return made

    def _choose(self, nodes: dict[str, dict]) -> None:
        """The slots of the article: below its element, or below the element with most text outside links."""
        plain = {p: t for p, t in nodes.items() if not t["boilerplate"]}
        self.content = {p for p, t in plain.items() if t["main"]}
        self.has_main = bool(self.content)
        if self.has_main or not plain:
            return
        best = max(sorted(plain), key=lambda p: plain[p]["chars"] - 2 * plain[p]["links"])
        if plain[best]["leaf"] and plain[best]["parent"] in plain:
            best = plain[best]["parent"]
        for path in plain:
            up = path
            while up and up != best:
                up = nodes[up]["parent"]
            if up == best:
                self.content.add(path)

    def slot(self, element: Element) -> str | None:
        """The innermost element of the template around a text."""
        up: Element | None = element
        while up is not None and up.path not in self.nodes:
            up = up.parent
        return up.path if up is not None else None

    def fill(self, blocks: list[Block]) -> list[Block]:
        """What a page adds to the slots: its blocks without the template's texts before the first and after the last own one.

        Where such texts are most of what is in the slots, in number and in characters outside links, the host's pages
        are versions of one article, and all blocks stay.
        """
        own = [i for i, b in enumerate(blocks) if _text_token(b) not in self.texts]
        if not own:
            return blocks
        kept = blocks[own[0] : own[-1] + 1]
        size, left = (sum(max(0, len(b.text) - b.links) for b in part) for part in (blocks, kept))
        return blocks if 2 * len(kept) < len(blocks) and 2 * left < size else kept


def main_text(page: str | None, template: Template | None) -> str:
    """The article's blocks of a page, joined by line breaks.

    They are what fills the template's content slots, but for elements of the page's own that are no part
    of an article (a form, say). Pages without a template, or with an article or main element that their
    template has not, or with empty slots, are read by their own elements. If only names mark a page's whole
    article as no part of it, the names do not count.
    """
    blocks = Parser(page or "").blocks
    plain = [b for b in blocks if not b.element.boilerplate]
    own = [b for b in plain if b.element.main]
    chosen: list[Block] = []
    if template and (template.has_main or not own):
        chosen = template.fill([b for b in plain if template.slot(b.element) in template.content])
    return "\n".join(b.text for b in chosen or own or plain or [b for b in blocks if b.element.main and not b.element.hard])


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).

    Null and empty pages have an empty text; hosts are those of the URLs, pages without one share a host.
    Pages of hosts with fewer than three pages, and pages that do not follow their host's template, are
    read by their own elements. Equal rows are each returned. Pages are read twice: templates are counted over
    the distinct pages of a host, and then, some kilobytes per host, joined to all pages.
    """
    small_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    distinct = rows.select("host", "html", F.xxhash64("html").alias("tag"), digest.alias("digest")).dropDuplicates(["host", "digest"])
    templates = staged(host_templates(page_tokens(distinct)), "templates")

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        known: dict[str, Template] = {}
        for batch in batches:
            texts = []
            for host, n, tokens, page in zip(batch["host"], batch["pages"], batch["tokens"], batch["html"], strict=True):
                if tokens is not None and host not in known:
                    if len(known) >= 1000:
                        known.clear()
                    known[host] = Template.of(n, tokens)
                texts.append(main_text(page, known.get(host)))
            yield {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    kind = pages.schema["page_id"].dataType.simpleString()
    joined = rows.join(templates, "host", "left").select("page_id", "url", "html", "host", "pages", "tokens")
    return map_columns(joined, run, f"page_id {kind}, url string, text string, n_chars bigint")


def op1_main_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))
