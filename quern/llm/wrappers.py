"""Main text of web pages by wrappers inferred from the pages of their host.

A page is read as a tree of tags. The trees of a host are aligned one after the other: children
with the same tag and class are matched in order, a child that some pages lack becomes
optional, neighbours (or runs of neighbours) of one shape become a repeated group. What results
is a union-free regular expression, ``wrapper``.

Every page is then matched against the wrapper of its host, so that each block of its text falls
to a part of the wrapper. A text that stands in a part on nearly all different pages which have
that part is template text; where the texts of a part differ it is a slot. The main text of a page
is its text in slots. Left out are template text and elements that say by tag or class that they
are boilerplate, unless they hold the article or most of the text. Template headings stay above
text that stays.

Pages of equal shape count as one; shapes are aligned in slices of a host before the slices
are, so a host with very many pages is no single task.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field as part
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.tables import columns, field, stored, table_schema

# Elements of HTML by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe object".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
BOILERPLATE = frozenset("nav header footer aside form menu dialog button select head script style noscript template title svg iframe object textarea".split())
BOILERPLATE_CLASS = frozenset(
    "ad ads advert adverts advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus dialog disclaimer footer form gdpr header hidden links login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pagination popup promo promoted related replies respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
# Class words that tell even in an article, on whatever element; the others need a container there.
ALWAYS_CLASS = frozenset("ad ads advert adverts advertisement advertising comment comments disqus respond replies sponsored".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote caption figcaption".split()) | INLINE
# Elements nested deeper lie flat in their ancestor of that depth, as in browsers.
DEEPEST = 128
CLOSED_BY = {
    "p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 pre blockquote section article form hr aside nav header footer main figure address details fieldset".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
MAIN = ("article", "main")
# Never the main part, however long, unless an article or main element is inside.
ASIDE = frozenset("nav footer aside menu button select head".split())
LABELS = frozenset("h1 h2 h3 h4 h5 h6 dt th caption figcaption".split())
# Template text stands on so many different pages at least, and on this share of those with its part.
TEMPLATE_PAGES = 3
TEMPLATE_SHARE = 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:\s+|/|[^\s\"'>/=]+|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"[-_]?\d+$")


@dataclass
class Node:
    """An element; ``children`` are nodes and texts."""

    tag: str
    names: str = ""
    classes: frozenset = frozenset()
    children: list = part(default_factory=list)
    chars: int = 0
    marked: int = 0

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.names}" if self.names else self.tag

    @property
    def boilerplate(self) -> bool:
        return self.tag in BOILERPLATE or not BOILERPLATE_CLASS.isdisjoint(self.classes)


def _names(attributes: str) -> tuple[str, frozenset[str]]:
    """Lower-case words of class, id and role, without numbers; and the whole names."""
    found: list[str] = []
    whole: list[str] = []
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        found += _NAME.findall(value)
        whole += (_NUMBER.sub("", n) for n in value.split())
    return ".".join(dict.fromkeys(found)), frozenset(whole)


def read(page: str | None) -> Node:
    """The tree of a page. Unclosed elements end where their parent or a follower ends them; what is
    nested more than ``DEEPEST`` deep follows one another in the element of that depth."""
    root = Node("#root")
    open_ = [root]  # elements that take children
    tags = ["#root"]  # of all open elements, those too deep included
    counts = {"#root": 1}
    page, at = page or "", 0

    def close(depth: int) -> None:
        for t in tags[depth:]:
            counts[t] -= 1
        del tags[depth:], open_[depth:]

    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end() if m else at + 1
        if not m:
            continue
        closing, tag, attributes, text = m.groups()
        if text:
            open_[-1].children.append(text)
        elif m[0].startswith("<![CDATA["):
            open_[-1].children.append(html.escape(m[0][9:].removesuffix("]]>")))
        elif tag and closing:
            tag = tag.lower()
            if counts.get(tag):
                depth = len(tags) - 1
                while tags[depth] != tag:
                    depth -= 1
                close(depth)
        elif tag:
            tag = tag.lower()
            if tag not in INLINE:
                for depth in range(len(tags) - 1, max(0, len(tags) - 1 - DEEPEST), -1):
                    if tag in CLOSED_BY.get(tags[depth], ()):
                        close(depth)
                        break
                    if tags[depth] not in INLINE and tags[depth] not in CLOSED_BY:
                        break
            node = Node(tag, *_names(attributes)) if attributes else Node(tag)
            open_[-1].children.append(node)
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, at)
                at = end.end()
            elif tag not in VOID and not attributes.rstrip().endswith("/"):
                tags.append(tag)
                counts[tag] = counts.get(tag, 0) + 1
                if len(open_) < DEEPEST:
                    open_.append(node)
    return root


# A shape is [label, optional, repeated, children]; "#" is a text slot, "()" a group.


def _same(a: list, b: list) -> bool:
    return a[0] == b[0] and (a[0] != "()" or [c[0] for c in a[3]] == [c[0] for c in b[3]])


def align(a: list[list], b: list[list]) -> list[list]:
    """Two sequences of shapes as one: matched in order, the rest optional."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if _same(a[i], b[j]) else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and _same(a[i], b[j]) and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], 1, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], 1, *b[j][2:]])
            j += 1
    return fold(out)


def merge(a: list, b: list) -> list:
    return a if a == b else [a[0], a[1] | b[1], a[2] | b[2], align(a[3], b[3])]


def fold(shapes: list[list]) -> list[list]:
    """Neighbours of one shape become one that repeats, runs of up to three a repeated group."""
    out: list[list] = []
    for s in shapes:
        if out and _same(out[-1], s):
            last = out[-1]
            out[-1] = [s[0], last[1] & s[1], 1, align(last[3], s[3]) if last[3] != s[3] else s[3]]
        else:
            out.append(s)
    for width in (2, 3):
        i = 0
        while i + 2 * width <= len(out):
            x, y = out[i : i + width], out[i + width : i + 2 * width]
            if all(_same(p, q) for p, q in zip(x, y)):
                out[i : i + 2 * width] = [["()", 0, 1, [merge(p, q) for p, q in zip(x, y)]]]
            elif out[i][0] == "()" and [c[0] for c in out[i][3]] == [c[0] for c in out[i + 1 : i + 1 + width]]:
                out[i : i + 1 + width] = [["()", 0, 1, [merge(p, q) for p, q in zip(out[i][3], out[i + 1 : i + 1 + width])]]]
            else:
                i += 1
    return out


def shape(node: Node) -> list:
    children = []
    for c in node.children:
        if isinstance(c, Node):
            children.append(shape(c))
        elif c.strip():
            children.append(["#", 0, 0, []])
    return [node.label, 0, 0, fold(children)]


def expression(s: list) -> str:
    """A shape as a union-free regular expression."""
    inside = "".join(map(expression, s[3]))
    text = inside if s[0] == "()" else "#text" if s[0] == "#" else f"<{s[0]}>{inside}</>"
    many = {(0, 0): "", (1, 0): "?", (0, 1): "+", (1, 1): "*"}[s[1], s[2]]
    return f"({text}){many}" if many else text


class Part:
    """An element of a wrapper, numbered in document order. ``items`` are its children: which
    labels may stand there, and whether they repeat."""

    def __init__(self, s: list, path: str, paths: list[str]):
        self.path = f"{path}/{s[0]}"
        self.slot = len(paths)
        paths.append(self.path)
        self.items: list[tuple[dict[str, Part], int]] = []
        for c in s[3]:
            within: dict[str, Part] = {}
            self._collect(c, within, paths)
            if within:
                self.items.append((within, c[2]))

    def _collect(self, c: list, within: dict[str, Part], paths: list[str]) -> None:
        if c[0] == "()":
            for d in c[3]:
                self._collect(d, within, paths)
        elif c[0] != "#":
            within[c[0]] = Part(c, self.path, paths)

    def match(self, nodes: list[Node]) -> list[Part | None]:
        """The child of this part that each node is, in order; None where there is none."""
        found: list[Part | None] = []
        j, items = 0, self.items
        for node in nodes:
            while j < len(items) and node.label not in items[j][0]:
                j += 1
            if j == len(items):
                return self._best(nodes)
            found.append(items[j][0][node.label])
            j += not items[j][1]
        return found

    def _best(self, nodes: list[Node]) -> list[Part | None]:
        n, m, items = len(nodes), len(self.items), self.items
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            for j in range(m - 1, -1, -1):
                best[i][j] = max(best[i + 1][j], best[i][j + 1])
                if nodes[i].label in items[j][0]:
                    best[i][j] = max(best[i][j], 1 + best[i + 1][j + (not items[j][1])])
        found: list[Part | None] = [None] * n
        i = j = 0
        while i < n and j < m:
            to = j + (not items[j][1])
            if nodes[i].label in items[j][0] and best[i][j] == 1 + best[i + 1][to]:
                found[i] = items[j][0][nodes[i].label]
                i, j = i + 1, to
            elif best[i][j] == best[i][j + 1]:
                j += 1
            else:
                i += 1
        return found


@dataclass
class Block:
    """Text between the borders of block elements; ``slot`` is the part of the wrapper it is in.
    ``label`` marks headings, up to ``end`` follow the blocks of their parent."""

    slot: int
    label: bool = False
    pieces: list[str] = part(default_factory=list)
    text: str = ""
    end: int = 0


def _measure(node: Node) -> None:
    """Sets the characters of text of each node, and those in article and main elements."""
    for c in node.children:
        if isinstance(c, str):
            node.chars += len(c.strip())
        else:
            _measure(c)
            node.chars += c.chars
            node.marked += c.marked
    if node.tag in MAIN:
        node.marked = node.chars


def _left_out(node: Node, parent: Node, root: Node, inside: bool) -> bool:
    """Whether a node is boilerplate; the one with the page's article or most of its text is not.

    ``inside`` an article a text element goes only by the class words of adverts and comments.
    """
    if not node.boilerplate:
        return False
    if inside and node.tag in TEXT_TAGS and ALWAYS_CLASS.isdisjoint(node.classes):
        return False
    if node.tag == "header" and parent.tag in MAIN and BOILERPLATE_CLASS.isdisjoint(node.classes):
        return False
    if root.marked:
        return 2 * node.marked < root.marked
    return node.tag in ASIDE or 2 * node.chars <= root.chars


def _walk(
    node: Node, slot: int, at: Part | None, root: Node, out: list[Block], above: list[Block] | None, inside: bool = False
) -> None:
    inside = inside or node.tag in MAIN
    nodes = [c for c in node.children if isinstance(c, Node)]
    parts = iter(at.match(nodes) if at else [None] * len(nodes))
    labels: list[Block] = []
    for c in node.children:
        if isinstance(c, str):
            out[-1].pieces.append(c)
            continue
        to = next(parts)
        if c.tag == "br":
            out[-1].pieces.append("\n")
        elif not _left_out(c, node, root, inside):
            # A node that the wrapper lacks is told by its label within its parent.
            own = to.slot if to else -1 - zlib.crc32(f"{slot}/{c.label}".encode())
            if c.tag in INLINE:
                _walk(c, own, to, root, out, above, inside)
            else:
                under = labels if c.tag in LABELS and above is None else above
                out.append(Block(own, under is not None))
                if under is not None:
                    under.append(out[-1])
                _walk(c, own, to, root, out, under, inside)
                out.append(Block(slot, above is not None))
                if above is not None:
                    above.append(out[-1])
    for block in labels:
        block.end = len(out)


def blocks(page: str | None, wrapper: Part | None) -> list[Block]:
    """Blocks of a page in document order, without elements that are boilerplate by themselves."""
    root = read(page)
    _measure(root)
    out = [Block(wrapper.slot if wrapper else -1)]
    _walk(root, out[0].slot, wrapper, root, out, None)
    for block in out:
        block.text = " ".join(html.unescape("".join(block.pieces)).split())
    return out


def text_hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def main_text(page: str | None, wrapper: Part | None, template: frozenset[tuple[int, int]] = frozenset()) -> str:
    """Text of a page that is not in ``template``, pairs of slot and text. A page that has no other
    text keeps it."""
    if not page:
        return ""
    found = blocks(page, wrapper)
    kept = [bool(b.text) and (b.slot, text_hash(b.text)) not in template for b in found]
    if template and any(kept):
        for i, b in enumerate(found):
            if b.text and b.label and not kept[i]:
                under = next((k for k in range(i + 1, b.end) if found[k].text and not found[k].label), None)
                kept[i] = under is not None and kept[under]
        found = [b for b, k in zip(found, kept) if k]
    return " ".join(b.text for b in found if b.text)


def main_path(inside: dict[str, int]) -> str:
    """The article or main element with most text in slots; else the deepest part with most of it."""
    marked = [p for p in inside if p.rsplit("/", 1)[-1].split(".")[0] in MAIN and inside[p]]
    if marked:
        # An article within main is the narrower of the two.
        top = [p for p in marked if not any(q != p and q.startswith(p + "/") for q in marked)]
        return max(sorted(top), key=inside.__getitem__)
    path, total = "/#root", inside.get("/#root", 0)
    while True:
        below = [p for p in sorted(inside) if p.startswith(path + "/") and "/" not in p[len(path) + 1 :]]
        block = [p for p in below if p.rsplit("/", 1)[-1].split(".")[0] not in INLINE | {"p"}]
        best = max(block, key=inside.__getitem__, default=None)
        if best is None or inside[best] < 0.7 * total:
            return path
        path = best


def _main(tree: str, chars: dict[int, int] | None) -> str:
    """Path of the part with most text in slots."""
    paths: list[str] = []
    Part(json.loads(tree), "", paths)
    inside: dict[str, int] = {}
    for slot, n in (chars or {}).items():
        steps = paths[slot].split("/")
        for k in range(2, len(steps) + 1):
            path = "/".join(steps[:k])
            inside[path] = inside.get(path, 0) + n
    return main_path(inside)


OUT = columns(text="string", n_chars="long", wrapper="string")
OUT_ARROW = to_arrow_type(OUT)


def host(url: Column | str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][\w+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def _shapes(html_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {
                (name, json.dumps(shape(read(page)), separators=(",", ":")))
                for name, page in zip(batch.column("host").to_pylist(), field(batch, html_col).to_pylist())
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in sorted(found)], pa.string()) for i in (0, 1)], ["host", "shape"]
            )

    return run


def _align(shapes: pd.DataFrame) -> pd.DataFrame:
    """One wrapper from the shapes of a slice of a host."""
    wrapper = None
    for s in sorted(shapes["shape"].unique()):
        s = json.loads(s)
        wrapper = s if wrapper is None else merge(wrapper, s)
    text = json.dumps(wrapper, separators=(",", ":"))
    return pd.DataFrame({"host": shapes["host"].iloc[:1], "shape": [text]})


def _wrapper(tree: str | None, known: dict[str, Part]) -> Part | None:
    if tree is None:
        return None
    if tree not in known:
        known[tree] = Part(json.loads(tree), "", [])
    return known[tree]


def _seen(html_col: str):
    """For each page the texts in each part of the wrapper; with a null text the part as such."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Part] = {}
        for batch in batches:
            out: dict[tuple, int] = {}
            names, trees = batch.column("host").to_pylist(), batch.column("tree").to_pylist()
            for name, page, tree in zip(names, field(batch, html_col).to_pylist(), trees):
                found = [b for b in blocks(page, _wrapper(tree, known)) if b.text]
                whole = text_hash("\n".join(b.text for b in found))
                inside: dict[tuple, int] = {}
                for b in found:
                    key = name, b.slot, text_hash(b.text), whole
                    if key not in inside:
                        inside[key] = len(b.text)
                        inside[name, b.slot, None, whole] = inside.get((name, b.slot, None, whole), 0) + len(b.text)
                out |= inside
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k[i] for k in out], kind) for i, kind in enumerate(kinds)), pa.array(out.values(), pa.int64())],
                ["host", "slot", "text", "page", "chars"],
            )

    return run


def infer_wrappers(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", slice_shapes: int = 200, described: bool = True
) -> DataFrame:
    """``host``, ``tree``, the wrapper as nested lists, and ``template``, the slots and hashes of
    template text; if ``described`` also ``wrapper`` (see ``expression``) and ``main``, the path of its
    main part."""
    rows = pages.select(host(url_col).alias("host"), F.struct(F.col(html_col).alias(html_col)).alias("row"))
    shapes = stored(rows.mapInArrow(_shapes(html_col), "host string, shape string").distinct(), "shapes")
    left = shapes.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    while True:
        slices = max(1, -(-left // slice_shapes))
        shapes = (
            shapes.withColumn("slice", F.pmod(F.xxhash64("shape"), F.lit(slices)))
            .groupBy("host", "slice")
            .applyInPandas(_align, "host string, shape string")
        )
        left = slices
        if slices == 1:
            break
    trees = stored(shapes.select("host", F.col("shape").alias("tree")), "trees")
    seen = (
        rows.join(trees, "host")
        .mapInArrow(_seen(html_col), "host string, slot long, text long, page long, chars long")
        .groupBy("host", "slot", "text", "page")
        .agg(F.max("chars").alias("chars"))
        .groupBy("host", "slot", "text")
        .agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    )
    seen = stored(seen.where(F.col("text").isNull() | (F.col("n") >= TEMPLATE_PAGES)), "texts")
    parts = seen.where("text is null").select("host", "slot", F.col("n").alias("pages"), F.col("chars").alias("all"))
    template = seen.where("text is not null").join(parts.drop("all"), ["host", "slot"])
    template = stored(template.where(F.col("n") >= TEMPLATE_SHARE * F.col("pages")), "template")
    texts = template.groupBy("host").agg(F.to_json(F.collect_list(F.array("slot", "text"))).alias("template"))
    if not described:
        return stored(trees.join(texts, "host", "left"), "wrappers")
    fixed = template.groupBy("host", "slot").agg(F.sum("chars").alias("fixed"))
    # Parts that the wrapper lacks have negative numbers.
    chars = (
        parts.where("slot >= 0")
        .join(fixed, ["host", "slot"], "left")
        .groupBy("host")
        .agg(F.map_from_entries(F.collect_list(F.struct("slot", F.col("all") - F.coalesce("fixed", F.lit(0))))).alias("chars"))
    )
    choose = F.udf(lambda tree, chars: _main(tree, chars), "string")
    render = F.udf(lambda s: expression(json.loads(s)), "string")
    known = trees.join(chars, "host", "left").join(texts, "host", "left")
    return stored(
        known.select("host", render("tree").alias("wrapper"), choose("tree", "chars").alias("main"), "tree", "template"),
        "wrappers",
    )


def _extract(html_col: str, with_wrapper: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Part] = {}
        fixed: dict[str | None, frozenset] = {None: frozenset()}
        for batch in batches:
            out = []
            trees, templates, wrappers = (batch.column(c).to_pylist() for c in ("tree", "template", "wrapper"))
            for page, tree, template, wrapper in zip(field(batch, html_col).to_pylist(), trees, templates, wrappers):
                if template not in fixed:
                    fixed[template] = frozenset(map(tuple, json.loads(template)))
                text = main_text(page, _wrapper(tree, known), fixed[template])
                out.append({"text": text, "n_chars": len(text), "wrapper": wrapper if with_wrapper else None})
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, OUT_ARROW)], ["row", "out"])

    return run


def extract_main_text(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", with_wrapper: bool = True
) -> DataFrame:
    """``row`` and ``out``: the main text of each page, by the wrapper of its host.

    Null and empty pages have an empty text; pages of null or strange addresses share the host
    of empty name. Repeated rows change nothing. Writes intermediate tables when called.
    """
    wrappers = infer_wrappers(pages, url_col, html_col, described=with_wrapper)
    if not with_wrapper:
        wrappers = wrappers.withColumn("wrapper", F.lit(None).cast("string"))
    rows = pages.select(F.struct("*").alias("row")).withColumn("host", host(F.col("row")[url_col]))
    return (
        rows.join(wrappers, "host", "left")
        .select("row", "tree", "template", "wrapper")
        .mapInArrow(_extract(html_col, with_wrapper), table_schema(pages, OUT))
    )
