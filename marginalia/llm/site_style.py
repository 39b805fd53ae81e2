"""Main text of web pages by site style trees: same-host pages merged, importance by entropy, noisy branches removed.

The pages of a host are merged into one tree of styled elements. A branch's content importance is the part of its words that is news from page
to page: one minus the entropy of its texts over pages. Its presentation importance is the entropy of its children's styles. Strips
whose presentation never varies (menus, adverts, footers) may hold new words on each page, but few: such a branch is weighed by
the information that it holds, next to what its richest sibling holds.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm import common

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*(?:>|\Z)|[^<]+|<", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.S)
WORDS = re.compile(r"[a-z]+")
MARKS = re.compile(r"[a-z]+(?:\d(?!\d))?")
# Fixed values of HTML: elements without content, with raw text, that start a block, and that an opening tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCK - {"html", "body", "caption", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend"}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th")}
LIMITS = frozenset("ul ol dl table body html article section div main td th button object".split())
# Fixed values of HTML: elements that hold no text of the page.
NO_TEXT = frozenset("head script style noscript template button select input textarea iframe object svg canvas audio video title".split())
# Presentation that is not article text where the tree can't tell: elements, the words of a class, id or role that say so, and words that may stand beside them.
NOISE_TAGS = frozenset("nav header footer aside form menu dialog search".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments contentinfo cookie cookies consent disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination pager paywall popup promo promoted related replies respond search share sharing sidebar sidenav skip social sponsor sponsored subscribe toolbar widget".split()
)
LAYOUT_WORDS = frozenset("area bar block bottom box button buttons col column container content form global group icons inner item items left link links list main outer panel primary right row secondary section signup site slot sticky top unit wrap wrapper zone".split())
INNER_HEADER = frozenset("article main section".split())
STAY = frozenset(("", "html", "body", "article", "main"))
#: Elements that part a page; only these are weighed against their siblings, and none inside article and main.
PARTS = frozenset("aside div footer form header nav ol section table ul".split())
DEEP = 200  # below, a path names its parent's by a digest, so that paths stay short at any depth
MIN_PAGES = 4
THRESHOLD = 0.3
SHARE = 0.3


def names_noise(named: str, but: frozenset[str] = frozenset()) -> bool:
    """True if one of the names (class, id, role) says that the element is no article text: whole names, of noise words and words of layout only."""
    for name in named.split():
        words = WORDS.findall(name)
        if any(w in NOISE_WORDS and w not in but for w in words) and all(w in NOISE_WORDS or w in LAYOUT_WORDS for w in words):
            return True
    return False


@dataclass
class Node:
    tag: str
    style: str  # the element as the style tree sees it: tag, class, id and role without numbers
    empty: bool  # holds no text of the page, or is hidden
    noise: bool  # says itself that it is no article text
    path: str
    depth: int = 0
    inner: bool = False  # it or an element around it is one of INNER_HEADER
    main: bool = False  # it or an element around it is article or main
    items: list = field(default_factory=list)  # nodes and texts in order


def _node(tag: str, source: str, parent: Node | None) -> Node:
    marks = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)} if "=" in source else {}
    named = " ".join(marks.get(a, "") for a in ("class", "id", "role")).lower()
    style = tag + ("." + "-".join(MARKS.findall(named)) if named.strip() else "")
    noise = tag in NOISE_TAGS or tag not in STAY and names_noise(named)
    if tag == "header" and parent and parent.inner:
        noise = names_noise(named, frozenset(("header",)))
    hidden = re.search(r"display\s*:\s*none", marks.get("style", "")) or marks.get("aria-hidden") == "true" or re.search(r"\shidden(?=[\s/>=])", source)
    depth = parent.depth + 1 if parent else 1
    above = parent.path if parent else ""
    if depth > DEEP:
        above = hashlib.sha1(above.encode("utf-8", "surrogatepass")).hexdigest()
    main = bool(parent and parent.main) or tag in ("article", "main")
    return Node(tag, style, tag in NO_TEXT or bool(hidden), noise, f"{above}/{style}", depth, bool(parent and parent.inner) or tag in INNER_HEADER, main)


def parse(source: str) -> Node:
    """A tree of the page. Unclosed elements end where HTML lets them end; stray closing tags are left out."""
    root = Node("", "", False, False, "")
    stack = [root]
    at = 0
    while m := TOKEN.match(source, at):
        at = m.end()
        token = m[0]
        if token[0] != "<" or len(token) == 1:
            stack[-1].items.append(token)
            continue
        if token[1] in "!?":
            continue
        name = NAME.match(token)[1].lower()
        if token[1] == "/":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    del stack[k:]
                    break
                if stack[k].tag in ("td", "th", "table", "body") and name not in BLOCK | {"td", "th"}:
                    break
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in LIMITS:
                    break
        if name in SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SIBLINGS[name]:
                    del stack[k:]
                    if name in ("li", "dt", "dd", "option"):
                        break
                elif stack[k].tag in ("ul", "ol", "dl", "table", "select", "body"):
                    break
        node = _node(name, token, stack[-1])
        stack[-1].items.append(node)
        if name in VOID or token.endswith("/>") and name not in RAW | BLOCK:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            if name in ("textarea", "title"):
                node.items.append(source[at : end.start() if end else len(source)])
            at = end.start() if end else len(source)
            close = source.find(">", at)
            at = len(source) if close < 0 else close + 1
            continue
        stack.append(node)
    return root


def blocks(root: Node, removed: frozenset[str] | set[str], names: bool = True) -> list[str]:
    """Texts of the blocks in page order, without the removed paths and, with `names`, without what names itself noise."""
    out: list[list[str]] = [[]]
    work: list = [iter(root.items)]
    closing: list[bool] = [False]
    while work:
        item = next(work[-1], None)
        if item is None:
            work.pop()
            if closing.pop():
                out.append([])
        elif isinstance(item, str):
            out[-1].append(item)
        elif item.tag in ("br", "wbr", "img"):
            out[-1].append(" " if item.tag != "wbr" else "")
        elif not (item.empty or names and item.noise or item.tag not in STAY and item.path in removed):
            block = item.tag in BLOCK
            if block:
                out.append([])
            elif item.tag in ("td", "th"):
                out[-1].append(" ")
            work.append(iter(item.items))
            closing.append(block)
    texts = (" ".join(html.unescape("".join(t)).split()) for t in out)
    return [t for t in texts if t]


def features(root: Node) -> Iterator[tuple[Node, str, str, str]]:
    """(element, parent's path, kind, feature): kind `s` is the sequence of children's styles of an element, kind `c` a text in it."""
    work = [(root, "")]
    while work:
        node, parent = work.pop()
        if node.empty:
            continue
        inner = [x for x in node.items if isinstance(x, Node)]
        yield node, parent, "s", ">".join(dict.fromkeys(x.style for x in inner))
        for x in node.items:
            if isinstance(x, str) and x.strip():
                yield node, parent, "c", " ".join(x.split())
        work += [(x, node.path) for x in inner]


def host(url: Column) -> Column:
    """A url's host in lower case; empty if it has none."""
    return F.lower(F.coalesce(F.try_parse_url(url.cast("string"), F.lit("HOST")), F.lit("")))


def style_tree(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, path, top, importance) of every element of each host's style tree that is found on MIN_PAGES distinct pages.

    Pages with the same content count once. For each element of the merged tree: pages m, the entropy (base m) of its styles, and its
    texts in words, each text with its entropy over pages. Sums are combined in each batch and again by the shuffle, so a
    hot host sends one row a path and feature. The tree of a host has as many rows as the site has paths, however many pages. `top`
    tells that no element around it has an importance below THRESHOLD.
    """

    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            seen: dict[tuple, int] = {}
            for h, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own: dict[tuple, int] = {}
                for node, parent, kind, feature in features(parse(source)):
                    key = (h, node.path, parent, node.depth, node.main, kind, feature)
                    own[key] = own.get(key, 0) + 1
                for key, n in own.items():
                    for counted in ((*key, n), (*key[:5], "m", "", 1) if key[5] == "s" else None):
                        if counted:
                            seen[counted] = seen.get(counted, 0) + 1
            if seen:
                h, path, parent, depth, main, kind, feature, n = zip(*seen)
                words = [0 if k != "c" else f.count(" ") + 1 for k, f in zip(kind, feature)]
                made = pd.util.hash_array(np.array(feature, dtype=object)).view(np.int64)
                yield pa.record_batch(
                    [pa.array(h), pa.array(path), pa.array(parent), pa.array(depth, pa.int32()), pa.array(main), pa.array(kind), pa.array(made), pa.array(words, pa.int64()), pa.array(n, pa.int64()), pa.array(list(seen.values()), pa.int64())],
                    names=["host", "path", "parent", "depth", "main", "kind", "feature", "words", "n", "pages"],
                )

    source = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).where("html is not null")
    source = source.groupBy("host", F.md5("html").alias("h")).agg(F.first("html").alias("html")).select("host", "html")
    flat = source.mapInArrow(emit, "host string, path string, parent string, depth int, main boolean, kind string, feature long, words long, n long, pages long")
    # kind s: one style a page, so k = pages with the style; a path that is repeated within a page has one row a style
    place = ["host", "path", "parent", "depth", "main"]
    each = flat.groupBy(*place, "kind", "feature", "words").agg(F.sum("pages").alias("k"), F.sum(F.col("n") * F.col("pages")).alias("t"), F.sum(F.col("n") * F.col("pages") * F.log("n")).alias("nlogn"))
    style, text = F.col("kind") == "s", F.col("kind") == "c"
    paths = each.groupBy(*place).agg(
        F.max(F.when(F.col("kind") == "m", F.col("k"))).alias("m"),
        F.coalesce(F.sum(F.when(style, F.col("k"))), F.lit(0)).alias("styles"),
        F.coalesce(F.sum(F.when(style, F.col("k") * F.log("k"))), F.lit(0.0)).alias("style_log"),
        F.coalesce(F.sum(F.when(text, F.col("words") * F.col("t"))), F.lit(0)).alias("words"),
        F.coalesce(F.sum(F.when(text, F.col("words") * F.col("t") * (F.log("t") - F.col("nlogn") / F.col("t")))), F.lit(0.0)).alias("spread"),
    )
    return paths.where(F.col("m") >= MIN_PAGES).groupBy("host").applyInPandas(_importance, "host string, path string, top boolean, importance double")


def _importance(tree: pd.DataFrame) -> pd.DataFrame:
    """Importance of the elements of one host: sums go from the leaves upwards, a level at a time.

    content: one minus the entropy of the texts over pages, by words. information: the words that are news. A part of the page whose
    presentation never varies counts by its information next to its richest sibling's: as far as that is less than SHARE.
    """
    m, styles = tree["m"].to_numpy(float), np.maximum(tree["styles"].to_numpy(float), 1)
    varies = np.clip((np.log(styles) - tree["style_log"].to_numpy(float) / styles) / np.log(m), 0, 1)
    mass, noise = tree["words"].to_numpy(float).copy(), tree["spread"].to_numpy(float) / np.log(m)
    number = {p: k for k, p in enumerate(tree["path"])}
    parent = np.array([number.get(p, -1) if q else -1 for p, q in zip(tree["parent"], tree["path"])], np.int64)
    depth = tree["depth"].to_numpy()
    levels = [np.flatnonzero((depth == d) & (parent >= 0)) for d in np.unique(depth)[::-1]]
    for at in levels:
        np.add.at(mass, parent[at], mass[at])
        np.add.at(noise, parent[at], noise[at])
    news = np.maximum(mass - noise, 0)
    content = np.where(mass > 0, np.clip(news / np.maximum(mass, 1e-9), 0, 1), 0.0)
    richest = np.zeros(len(tree))
    has = np.flatnonzero(parent >= 0)
    np.maximum.at(richest, parent[has], news[has])
    share = np.ones(len(tree))
    share[has] = np.minimum(1, news[has] / np.maximum(richest[parent[has]], 1e-9) / SHARE)
    tags = [p.rpartition("/")[2].split(".")[0] for p in tree["path"]]
    part = np.array([t in PARTS for t in tags]) & ~tree["main"].to_numpy(bool)
    importance = content * np.where(part, 1 - (1 - share) * (1 - varies), 1.0)
    low = (importance < THRESHOLD) & np.array([t not in STAY for t in tags])
    under = np.zeros(len(tree), bool)
    for at in levels[::-1]:
        under[at] = under[parent[at]] | low[parent[at]]
    return pd.DataFrame({"host": tree["host"], "path": tree["path"], "top": ~under, "importance": np.clip(importance, 0, 1)})


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", names: bool = True) -> DataFrame:
    """Adds text and n_chars (code points) to pages.

    An element goes with all it holds if its place in the host's style tree has an importance below THRESHOLD. With `names` it also goes if
    its own presentation says that it isn't article text (navigation, forms, adverts, comments), for hosts with fewer than MIN_PAGES
    distinct pages, which have no tree, and for what entropy can't tell, as reader comments. Scripts, styles, controls and hidden
    elements always go; body, article and main stay. Character references are decoded, white space inside a block becomes one
    space, blocks are joined by two line feeds. Null and empty pages give the empty text; null urls count as one host; pages of any length
    and depth are read whole; rows that repeat an id are rows of their own. Columns of pages named text or n_chars are replaced.

    A page gets the list of its host's removed branches, the outermost ones only.
    """
    with common.scope():
        tree = style_tree(pages, url_col, html_col).where("top").where(F.col("importance") < THRESHOLD)
        low = common.staged(tree.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("low")), "style-tree", outside=True)
    rest = [c for c in pages.columns if c not in ("text", "n_chars")]
    keyed = pages.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(html_col).cast("string").alias("html"), host(F.col(url_col)).alias("host"))
    joined = keyed.join(low, "host", "left").select("rest", "html", "low")

    def extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[list | None, frozenset] = (None, frozenset())
        for batch in rows:
            out = []
            for source, low in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if low != known[0]:
                    known = (low, frozenset(low or ()))
                out.append("\n\n".join(blocks(parse(source), known[1], names)) if source else "")
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["rest", "text", "n_chars"])

    made = joined.mapInArrow(extract, f"rest {joined.schema['rest'].dataType.simpleString()}, text string, n_chars long")
    return made.select(*[F.col(f"rest.`{c}`") for c in rest], "text", "n_chars")
