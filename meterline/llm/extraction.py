"""Main text of web pages, with the site's template removed.

Every element's subtree gets a hash. In Spark the pages of a host that hold a subtree are counted;
subtrees that recur on most of a host's pages are its template and are deleted, as are elements
that by their name, role or class are not the article. What is left is read block by block.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import settle
from meterline.plans.sizing import broadcast_when_small

# Fixed values of the HTML standard: elements without content, with raw text, and that end a
# paragraph or an earlier element of their own kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe plaintext".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - set("body caption html tbody td tfoot th thead tr legend".split())
SIBLINGS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
# An element of a kind above is looked for only up to these.
SCOPE = set("table ul ol dl td th body html article section div select".split())

DROPPED = set(
    "head nav footer aside form script style noscript template iframe object embed svg math "
    "canvas audio video button input select textarea dialog menu title noembed noframes "
    "datalist map".split()
)
ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
    "toolbar form advertisement doc-footnote".split()
)
_NOISE = (
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo "
    "promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription signup paywall share sharing social related recommended "
    "recommendations sidebar breadcrumb breadcrumbs menu nav navbar navigation topbar masthead "
    "header footer comment comments disqus respond reply replies discussion widget pagination "
    "pager tags toolbar login search skip"
)
NOISE = set(_NOISE.split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only after "=".
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
_BLANK = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    tag: str
    attributes: str = ""
    children: list = field(default_factory=list)
    hash: int = 0


def parse(page: str | None) -> Node:
    """A tree of a page; open elements are closed the way browsers do, at least at the end."""
    page = page or ""
    root = Node("")
    stack = [root]
    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        if not token:
            stack[-1].children.append(page[at:])
            break
        if token.start() > at:
            stack[-1].children.append(page[at : token.start()])
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            if not _close(stack, tag) and tag == "p":
                stack[-1].children.append(Node("p"))
            continue
        if tag in CLOSES_P:
            _close_within(stack, {"p"}, {"button", "table", "td", "th", "caption"})
        if tag in SIBLINGS:
            _close_within(stack, SIBLINGS[tag], SCOPE - SIBLINGS[tag])
        node = Node(tag, token[3] or "")
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            node.children.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif tag not in VOID and not node.attributes.rstrip().endswith("/"):
            stack.append(node)
        elif tag not in VOID and tag in BLOCK:
            # A slash does not close an element in HTML.
            stack.append(node)
    return root


def _close(stack: list[Node], tag: str) -> bool:
    """End tag: close up to the element it names, not beyond a table cell; whether it names one."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return True
        if stack[i].tag in ("td", "th") and tag not in ("tr", "tbody", "thead", "tfoot", "table"):
            return False
    return False


def _close_within(stack: list[Node], tags: set[str], stops: set[str]) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in stops:
            return


def attributes(node: Node) -> dict[str, str]:
    return {
        m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "")
        for m in _ATTRIBUTE.finditer(node.attributes)
    }


def walk(root: Node) -> Iterator[Node]:
    """All elements, a parent before its children, without recursion."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        waiting += [c for c in reversed(node.children) if isinstance(c, Node)]


def hash_subtrees(root: Node) -> None:
    """Set every element's ``hash`` from its name, attributes and content below it."""
    import xxhash

    for node in reversed(list(walk(root))):
        digest = xxhash.xxh64(f"{node.tag} {_BLANK.sub(' ', node.attributes).strip()}\x00")
        for child in node.children:
            if isinstance(child, Node):
                digest.update(b"\x01" + child.hash.to_bytes(8, "little"))
            else:
                digest.update(b"\x02" + _BLANK.sub(" ", child).strip().encode("utf-8", "replace"))
        node.hash = digest.intdigest()


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def is_noise(node: Node, inside: bool) -> bool:
    """Whether an element by its name, role, class or id is not part of an article.

    ``inside``: it stands in an article, whose own header belongs to it.
    """
    if node.tag in DROPPED or (node.tag == "header" and not inside):
        return True
    if not node.attributes:
        return False
    found = attributes(node)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    if node.tag in ("html", "body", "main"):
        return False
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        # "site-header", "cookieNotice" and "ad_box" name their parts.
        parts = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name).lower()
        parts = re.split(r"[^a-z]+", parts)
        if parts[0] in ("has", "with", "no", "without", "is"):
            continue
        if inside and node.tag == "header":
            parts = [x for x in parts if x != "header"]
        if NOISE.intersection(parts):
            return True
    return False


def is_template(node: Node, template: set[int], inside: bool) -> bool:
    """Whether an element is the site's; never one that holds an article or is an article's text.

    ``inside``: it stands in an article or main, where only what has no text outside links can go.
    """
    if node.hash not in template:
        return False
    waiting: list = [node]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            if inside and item.strip():
                return False
        elif item.tag in ("article", "main"):
            return False
        elif item.tag != "a":
            waiting += item.children
    return True


def article_text(root: Node, template: set[int]) -> str:
    """The article's blocks outside the template, white space collapsed, a blank line between."""
    kept: set[int] = set()
    tops: dict[str, list[Node]] = {"article": [], "main": []}
    waiting = [(root, False, False)]
    while waiting:
        node, in_main, in_article = waiting.pop()
        inside = in_main or in_article
        if is_template(node, template, inside) or is_noise(node, inside):
            continue
        kept.add(id(node))
        if node.tag == "article" and not in_article:
            tops["article"].append(node)
        if node.tag == "main" and not in_main:
            tops["main"].append(node)
        below = (in_main or node.tag == "main", in_article or node.tag == "article")
        waiting += [(c, *below) for c in reversed(node.children) if isinstance(c, Node)]
    blocks: list[str] = []
    for top in tops["article"] or tops["main"] or [root]:
        blocks += _blocks(top, kept)
    return "\n\n".join(blocks)


def _blocks(top: Node, kept: set[int]) -> list[str]:
    blocks: list[str] = []
    words: list[str] = []

    def end() -> None:
        text = _BLANK.sub(" ", entities.unescape("".join(words))).strip()
        words.clear()
        if text:
            blocks.append(text)

    waiting: list = [top]
    while waiting:
        item = waiting.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            words.append(item)
        elif id(item) not in kept:
            words.append(" ")
        elif item.tag == "br":
            words.append(" ")
        else:
            if item.tag in BLOCK:
                end()
                waiting.append(None)
            waiting += reversed(item.children)
    end()
    return blocks


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; "" for a null URL or one without a host."""
    found = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def template_subtrees(pages: DataFrame, *, least_pages: int, share: float) -> DataFrame:
    """(host, templates): hashes of the subtrees on at least ``share`` of a host's pages.

    Pages of a host with equal text but for noise count as one, so that an article under several
    menus is no template; a host needs ``least_pages`` different texts. An average page has room
    for few subtrees that most pages hold, which bounds a host's list.
    """
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, contents, hashes = [], [], []
            for i, page in enumerate(batch.column("html")):
                root = parse(page.as_py())
                hash_subtrees(root)
                found = {signed(n.hash) for n in walk(root) if n.tag not in ("", "html", "body")}
                text = article_text(root, set()).encode("utf-8", "surrogatepass")
                # Without a subtree, the row counts the page itself.
                at += [i] * (len(found) + 1)
                contents += [signed(xxhash.xxh64_intdigest(text))] * (len(found) + 1)
                hashes += [*found, None]
            rows = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host").take(rows),
                    pa.array(contents, pa.int64()),
                    pa.array(hashes, pa.int64()),
                ],
                names=["host", "page", "subtree"],
            )

    keyed = pages.where("html IS NOT NULL").select(host_of(F.col("url")).alias("host"), "html")
    found = keyed.mapInArrow(run, "host string, page long, subtree long")
    counts = found.groupBy("host", "subtree").agg(F.countDistinct("page").alias("n"))
    counts = settle(counts.where(F.col("n") >= least_pages * share))
    sizes = counts.where("subtree IS NULL").select("host", F.col("n").alias("pages"))
    return (
        counts.where("subtree IS NOT NULL")
        .join(sizes.where(F.col("pages") >= least_pages), "host")
        .where(F.col("n") >= F.col("pages") * share)
        .groupBy("host")
        .agg(F.collect_list("subtree").alias("templates"))
    )


def extract(pages: DataFrame, *, least_pages: int = 8, share: float = 0.6) -> DataFrame:
    """Add ``text`` (the main text) and ``n_chars`` (its code points) to pages.

    Input: ``page_id``, ``url``, ``html`` and any other columns; columns of the added names are
    replaced, ``html`` goes. The article is the ``article`` elements, else ``main``, else the
    page, without elements that are noise by name, role or class and without the host's template.

    A null or empty ``html`` gives an empty text. A null ``url``, or one without a host, counts
    as the host "". Repeated pages and ids are rows of their own. An empty table gives an empty
    one. Texts of any length are read whole.
    """
    rest = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    templates = settle(template_subtrees(pages, least_pages=least_pages, share=share))
    joined = pages.withColumn("__host", host_of(F.col("url"))).join(
        broadcast_when_small(
            templates.select(F.col("host").alias("__host"), F.col("templates").alias("__known"))
        ),
        "__host",
        "left",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, known in zip(batch.column("html"), batch.column("__known").to_pylist()):
                root = parse(page.as_py())
                template: set[int] = set()
                if known:
                    template = {x % (1 << 64) for x in known}
                    hash_subtrees(root)
                texts.append(article_text(root, template))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in rest),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                names=[*rest, "text", "n_chars"],
            )

    schema = pages.select(*rest).schema.add("text", "string").add("n_chars", "long")
    return joined.select(*rest, "html", "__known").mapInArrow(run, schema)
