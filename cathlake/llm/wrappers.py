"""Main text of web pages by wrappers inferred per host.

A page is read as a stream of tags and text. Its structure is a tree of
block-level elements; pages of one host are aligned one after another into a
wrapper, a union-free expression over that tree: equal neighbours and equal
groups of neighbours fold into ``(...)+``, elements that one side lacks become
``(...)?``, and text that differs becomes a slot. The wrapper gathers how many
words, linked words and pages each place has; from that the place of the main
text is chosen per host, and places that hold the same text on every page are
taken as template. Alignment is a merge of two wrappers, so each task first
merges its own pages; a host's partial wrappers meet in two rounds of groups,
and a host with a third of all pages is never gathered.

Elements that are not article text by their meaning (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments) are left
out whatever the wrapper says.

Defined results: null html is the empty page; a page without text gives the
empty text; a page whose url has no host forms a host of its own name "";
a page that lacks its host's main place falls back to a wrapper of its own.
Repeated rows repeat; an empty table gives an empty table.
"""

from __future__ import annotations

import html as htmllib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, schema_plus, ship, whole_text

SALTS = 64           # first-round groups per host
HOSTS_IN_TASK = 2000  # wrappers that a task keeps before it passes them on
MAX_DEPTH = 60       # deeper elements count as part of their ancestor; their text stays
MIN_PAGES = 3        # pages before equal text counts as template
MAIN_SHARE = 0.6     # share of a host's text that its main place must hold

# Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rp rt s samp small span "
             "strike strong sub sup time tt u var wbr".split())
LEFT_OUT = set("nav footer aside form button select option textarea fieldset dialog menu iframe object svg canvas video audio "
               "noscript template head".split())
MAIN = ("article", "main")
LAYOUT, CLOSED = 1, 2  # left out unless the page's only article is inside; left out with all it holds
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
               "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
               "th": ("tr", "table"), "option": ("select",)}
HINT = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|aside|ad|ads|advert|advertisement|adbox|sponsor|"
    r"sponsored|promo|promotion|banner|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|comment|comments|"
    r"discussion|disqus|respond|replies|reply|share|sharing|social|related|recommended|breadcrumb|breadcrumbs|pagination|pager|"
    r"newsletter|subscribe|subscription|signup|login|search|toolbar|widget|skip|copyright)s?(?:$|[\s_\d-])", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar",
         "form", "note"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|noscript|xmp)\b(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
    r"|<[!?][^>]*+>", re.S | re.I)
# A whole attribute: its name, then its value; text inside a value is never taken for a name.
ATTR = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
FIRM = re.compile(r"comment|discussion|disqus|respond|repl(?:y|ies)|related|recommended", re.I)
ARTICLE = re.compile(r"<(article|main)\b", re.I)


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if raw.strip(" /"):
        for k, v in ATTR.findall(raw):
            out.setdefault(k.lower(), v[1:-1] if v[:1] in "\"'" else v)
    return out


class Node:
    """A place in a wrapper. ``same`` stands for its own text (its start and a
    checksum) while all pages agree, else it is None."""

    __slots__ = ("label", "children", "words", "linked", "same", "pages", "optional", "repeated")

    def __init__(self, label, children=None, words=0, linked=0, same=None, pages=1, optional=False, repeated=False):
        self.label, self.children, self.words, self.linked = label, children if children is not None else [], words, linked
        self.same, self.pages, self.optional, self.repeated = same, pages, optional, repeated

    def dump(self):
        return [self.label, self.words, self.linked, self.same, self.pages, int(self.optional), int(self.repeated),
                [c.dump() for c in self.children]]

    @staticmethod
    def load(x):
        return Node(x[0], [Node.load(c) for c in x[7]], x[1], x[2], x[3], x[4], bool(x[5]), bool(x[6]))

    def pattern(self) -> str:
        """The wrapper as a union-free expression; ``#`` is a slot, quotes hold template text."""
        own = "" if not self.words else "#" if self.same is None else f'"{self.same}"'
        s = (self.label if self.label != "()" else "") + "(" + " ".join([own] * bool(own) + [c.pattern() for c in self.children]) + ")"
        return s + ("*" if self.optional and self.repeated else "?" if self.optional else "+" if self.repeated else "")


def read(page: str) -> tuple[Node, list[tuple[str, str]]]:
    """The page's own wrapper, and its blocks as (place, text) in page order.

    Left-out elements are in the wrapper by name but carry no text.
    """
    root = Node("")
    # open elements: (tag, node or None, place, left out)
    stack: list[tuple] = [("", root, "", 0)]
    blocks: list[tuple[str, str]] = []
    run: list[str] = []
    linked = 0
    in_link = 0
    named = [x.lower() for x in ARTICLE.findall(page)]
    # The page's only main, or its only article where there is no main, is kept inside a form or a hinted layout element.
    only = "main" if named.count("main") == 1 else "article" if named == ["article"] else None

    def flush():
        nonlocal linked
        if run:
            text = " ".join(htmllib.unescape("".join(run)).split())
            run.clear()
            if text:
                _, node, place, out = stack[-1]
                if not out:
                    blocks.append((place, text))
                    n = text.count(" ") + 1
                    node.same = f"{text[:40]}|{zlib.crc32(text.encode()):08x}" if not node.words else None
                    node.words += n
                    node.linked += min(linked, n)
        linked = 0

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            s = page[at:m.start()]
            run.append(s)
            if in_link:
                linked += len(s.split())
        at = m.end()
        name = m.group(3)
        if not name:
            continue
        tag, closing = name.lower(), m.group(2)
        if tag == "br" or tag == "hr":
            flush()
            continue
        if tag in VOID:
            continue
        if closing:
            if tag == "a":
                in_link = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    flush()
                    del stack[k:]
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag == "a":
            in_link = 1
        at_ = attributes(m.group(4))
        named_so = tag not in ("html", "body") and any(HINT.search(at_[k]) for k in ("class", "id") if at_.get(k))
        unseen = tag not in ("html", "body") and bool(at_) and (
            "hidden" in at_ or at_.get("aria-hidden") == "true" or "display:none" in at_.get("style", "").replace(" ", "")
            or at_.get("role", "").lower() in ROLES)
        hint = named_so or unseen
        if tag in INLINE and not hint:
            continue
        if tag in ("td", "th"):
            run.append(" ")
            continue
        flush()
        if tag in CLOSES_P and stack[-1][0] == "p":
            stack.pop()
        if tag in SAME_CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in SAME_CLOSES[tag]:
                    break
        _, parent, place, out = stack[-1]
        inside = any(p in MAIN for p in re.split(r"[>.]", place))
        is_main = tag in MAIN or at_.get("role") == "main" or at_.get("itemprop") == "articleBody"
        if out == LAYOUT and tag == only and not unseen:
            out = 0
            for _, above, _, _ in stack:
                above.label = above.label.removeprefix("-")  # the way to it is part of the wrapper
        if out != CLOSED:
            firm = named_so and any(FIRM.search(at_.get(k, "")) for k in ("class", "id"))
            if (tag in LEFT_OUT and tag != "form") or (tag == "header" and not inside) or (not is_main and (unseen or firm)):
                out = CLOSED
            elif tag == "form" or (named_so and not is_main):
                out = LAYOUT
        label = tag + ("." + re.sub(r"[\d>.()\s]+", "-", (at_.get("class") or at_.get("id") or ""))[:40]
                       if tag in ("div", "section", "span", "td") and (at_.get("class") or at_.get("id")) else "")
        if is_main and tag not in MAIN:
            label = "main." + label
        if len(stack) > MAX_DEPTH:
            node, here = parent, place
        else:
            node, here = Node(("-" if out else "") + label), f"{place}>{label}"
            parent.children.append(node)
        stack.append((tag, node, here, out))
    if at < len(page):
        run.append(page[at:])
    flush()
    fold(root)
    return root, blocks


def absorb(a: Node, b: Node, pages: bool) -> None:
    """Merge ``b`` into ``a``; ``pages``: they come from different pages."""
    if b.words:
        a.same = (b.same if not a.words else a.same if a.same == b.same else None)
    a.words += b.words
    a.linked += b.linked
    a.pages = a.pages + b.pages if pages else max(a.pages, b.pages)
    a.optional |= b.optional
    a.repeated |= b.repeated
    a.children = align(a.children, b.children, pages) if pages else squeeze(a.children + b.children)


def align(x: list[Node], y: list[Node], pages: bool) -> list[Node]:
    """One list for two lists of siblings: a longest common subsequence of
    labels is merged, the rest becomes optional."""
    if [n.label for n in x] == [n.label for n in y]:
        for a, b in zip(x, y, strict=True):
            absorb(a, b, pages)
        return x
    n, m = len(x), len(y)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i].label == y[j].label else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and x[i].label == y[j].label:
            absorb(x[i], y[j], pages)
            out.append(x[i])
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            x[i].optional = True
            out.append(x[i])
            i += 1
        else:
            y[j].optional = True
            out.append(y[j])
            j += 1
    return squeeze(out)


def squeeze(x: list[Node]) -> list[Node]:
    """Fold equal neighbours, then equal neighbouring groups, into repeated places."""
    out: list[Node] = []
    for c in x:
        if out and out[-1].label == c.label and c.label != "()":
            absorb(out[-1], c, False)
            out[-1].repeated = True
        else:
            out.append(c)
    for width in (2, 3, 4):
        i = 0
        while i + 2 * width <= len(out):
            a, b = out[i:i + width], out[i + width:i + 2 * width]
            if [n.label for n in a] == [n.label for n in b] and "()" not in [n.label for n in a]:
                for p, q in zip(a, b, strict=True):
                    absorb(p, q, False)
                    p.repeated = True
                del out[i + width:i + 2 * width]
            else:
                i += 1
    return out


def fold(node: Node) -> None:
    todo, order = [node], []
    while todo:
        n = todo.pop()
        order.append(n)
        todo += n.children
    for n in reversed(order):
        n.children = squeeze(n.children)


def places(node: Node, place: str = "") -> Iterator[tuple[str, Node, int, int]]:
    """(place, node, words in it, linked words in it), children first."""
    words, linked = node.words, node.linked
    found = []
    for c in node.children:
        if not c.label.startswith("-"):
            sub = list(places(c, f"{place}>{c.label}"))
            words += sub[-1][2]
            linked += sub[-1][3]
            found += sub
    yield from found
    yield place, node, words, linked


def rule_of(root: Node) -> dict:
    """{"main": place of the main text, "template": places of text that every page repeats}."""
    every = list(places(root))
    total = max(every[-1][2], 1)
    named = [p for p in every if p[0].rpartition(">")[2].partition(".")[0] in MAIN]
    if named and max(p[2] for p in named) > 0:
        main = max(named, key=lambda p: (p[2], -len(p[0])))
    else:
        plain = [p for p in every if p[2] - p[3] >= MAIN_SHARE * total and p[0].count(">") >= 1]
        # The innermost place that still holds most of the text, but not a single paragraph kind.
        wide = [p for p in plain if p[1].children] or plain
        main = max(wide, key=lambda p: p[0].count(">")) if wide else every[-1]
    inner = [p for p in every if p[0] == main[0] or p[0].startswith(main[0] + ">")]
    fixed = [p for p in inner if p[1].words and p[1].same is not None and not p[1].repeated and p[1].pages >= MIN_PAGES
             and p[1].pages == root.pages and not p[1].children and p[0].rpartition(">")[2].partition(".")[0] not in HEADINGS]
    if sum(p[1].words for p in fixed) > 0.2 * main[2]:
        fixed = []  # the pages are copies of each other, not a template around different texts
    return {"main": main[0], "template": sorted(p[0] for p in fixed)}


def extract(page: str, rule: dict | None) -> str:
    """Main text of a page by its host's rule."""
    root, blocks = read(page)
    if not blocks:
        return ""

    def pick(r):
        main, fixed = r["main"], set(r["template"])
        return [t for p, t in blocks if (p == main or p.startswith(main + ">")) and p not in fixed]

    found = pick(rule) if rule else []
    return "\n".join(found or pick(rule_of(root)))


def host_of(url: Column) -> Column:
    """Lower-case host of a url, "" where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _flush(kept: dict[str, Node]) -> pa.RecordBatch:
    told = [json.dumps(n.dump(), ensure_ascii=False) for n in kept.values()]
    rows = pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(told, pa.string())], ["host", "wrapper"])
    kept.clear()
    return rows


def _merged(parts: pa.Table) -> Node:
    node = None
    for w in parts.column("wrapper").to_pylist():
        other = Node.load(json.loads(w))
        if node is None:
            node = other
        else:
            absorb(node, other, True)
    return node


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per host: host, wrapper (JSON tree), pattern, n_pages, rule (JSON)."""
    ship(pages.sparkSession)
    df = pages.select(host_of(F.col(f"`{url}`")).alias("host"), whole_text(F.col(f"`{html}`")).alias("html"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, Node] = {}
        for b in batches:
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                root, _ = read(page)
                if host in kept:
                    absorb(kept[host], root, True)
                else:
                    kept[host] = root
                    if len(kept) >= HOSTS_IN_TASK:
                        yield _flush(kept)
        yield _flush(kept)

    def by_salt(key, parts):
        return pa.table({"host": pa.array([key[0].as_py()], pa.string()),
                         "wrapper": pa.array([json.dumps(_merged(parts).dump(), ensure_ascii=False)], pa.string())})

    def by_host(key, parts):
        root = _merged(parts)
        told = [json.dumps(root.dump(), ensure_ascii=False), root.pattern(), json.dumps(rule_of(root), ensure_ascii=False)]
        w, p, r = (pa.array([x], pa.string()) for x in told)
        return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "wrapper": w, "pattern": p,
                         "n_pages": pa.array([root.pages], pa.int64()), "rule": r})

    partial = df.mapInArrow(local, "host string, wrapper string")
    salted = partial.groupBy("host", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")) \
        .applyInArrow(by_salt, "host string, wrapper string")
    return salted.groupBy("host").applyInArrow(
        by_host, "host string, wrapper string, pattern string, n_pages long, rule string")


def main_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without ``html``, plus ``text`` (these names of the caller are replaced)."""
    ship(pages.sparkSession)
    rules = materialize(wrappers(pages, url, html).select("host", "rule"), "rules")
    kept = [c for c in pages.columns if c not in (html, "text")]
    n = len(kept)
    # Columns go by position below, so that no name of the caller's can clash.
    df = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], whole_text(F.col(f"`{html}`")).alias("html"),
                      host_of(F.col(f"`{url}`")).alias("host"))
    df = df.join(rules, "host", "left").select(*[f"c{i}" for i in range(n)], "html", "rule")
    schema = schema_plus(pages.select(*[F.col(f"`{c}`") for c in kept]), ("text", "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str, dict] = {}
        for b in batches:
            out = []
            for page, rule in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist(), strict=True):
                if rule is not None and rule not in parsed:
                    parsed[rule] = json.loads(rule)
                out.append(extract(page, parsed.get(rule)))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(out, pa.string())], [*kept, "text"])

    return df.mapInArrow(run, schema)
