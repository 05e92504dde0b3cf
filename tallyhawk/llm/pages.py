"""Main text of web pages by wrapper induction over the pages of a host.

Every page becomes a small tree: elements that hold text blocks, equal siblings as one
node. The trees of a host are aligned by simple tree matching and merged, level by level,
into one wrapper that counts for each node its pages, its text, its links and whether the
text is always the same. Nodes that never change are template; of the slots that vary, the
wrapper keeps the subtree that carries the article. Trees of equal shape are added up
before anything is aligned, so a host with a third of all pages costs what its shapes cost.

Equal siblings are one node, and inside an article a node holds what varies and what does
not. So blocks are aligned one by one as well: a block of a node that nearly all pages of
the host with that node have is template, also inside an article.

Each page is parsed once. Its blocks and the number of their node are stored, and the
decisions of its host's wrapper pick from them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.bitmaps import groups
from tallyhawk.llm.common import cut_lineage, ship_package, spread

#: Trees merged together in one step.
FAN_IN = 64
#: Pages a node is seen on before an unchanging text counts as template.
SEEN = 3
#: A block is template if so many different pages of its host have it in the same node,
BLOCK_SEEN = 8
#: and this share of the pages that have text in that node.
BLOCK_SHARE = 0.9
#: Elements nested deeper hang their text on the one at this depth, but for noise and articles.
DEPTH = 64

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset(
    "script style title textarea noscript iframe noembed noframes template xmp svg "
    "annotation annotation-xml".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br img "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow "
    "ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
#: Elements that are never part of an article.
_NOISE_TAGS = frozenset("nav footer aside form button select menu dialog fieldset object applet".split())
#: Words of class, id or role that mark what is not part of an article.
_NOISE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|sidebar|side-bar|menu|nav|navbar|navigation|"
    r"breadcrumbs?|footer|masthead|comments?|commentlist|disqus|respond|replies|cookies?|consent|gdpr|"
    r"notice|notices|alert|banner|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|"
    r"social|related|recommended|widget|toolbar|pagination|pager|skip|search|complementary|contentinfo)"
    r"(?=$|[\s_-])",
    re.I,
)
#: Words that say nothing beside those: inside an article, ``related-posts`` is noise and
#: ``related-work`` is not.
_PLAIN_WORDS = frozenset(
    "area article articles bar block blog body bottom box btn button buttons card container content entry form "
    "group icons inner item items left link links list main module outer page panel post posts right row section "
    "side site slot story text title top unit wrap wrapper".split()
)
#: Elements whose id tells what they hold; that of a heading or paragraph is a link target.
_CONTAINERS = frozenset("div section ul ol dl table header center ins".split())
_ARTICLE = frozenset(["article", "main"])
#: An element of the first kind ends an open one of the second.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
_SCOPE = frozenset("ul ol dl table body html div article section main td th".split())
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DIGITS = re.compile(r"\d+")


def _says_noise(tag: str, names: list[tuple[str, str]], inside: bool) -> bool:
    """Whether class, id, role or itemprop mark an element as no part of an article.

    ``inside`` an article a compound name counts only if the rest of it says nothing.
    """
    for kind, value in names:
        if kind == "id" and tag not in _CONTAINERS or not _NOISE_WORDS.search(value):
            continue
        if not inside:
            return True
        for word in value.lower().split():
            parts = [p for p in re.split(r"[-_]+", word) if p and not p.isdigit()]
            told = [bool(_NOISE_WORDS.fullmatch(p)) for p in parts]
            if _NOISE_WORDS.fullmatch(word) or any(told) and all(
                t or p in _PLAIN_WORDS for p, t in zip(parts, told, strict=True)
            ):
                return True
    return False


class Page:
    """The blocks of a page and the tree of elements that hold them."""

    def __init__(self, html: str) -> None:
        #: (parent, label, is noise) by node; equal siblings are one node.
        self.nodes: list[tuple[int, str, bool]] = [(-1, "", False)]
        self.blocks: list[tuple[int, str]] = []
        self.links: list[int] = [0]
        self._child: dict[tuple[int, str], int] = {}
        self._stack: list[tuple[str, int]] = [("", 0)]
        self._text: list[str] = []
        self._parse(html)

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text.clear()
            if text:
                self.blocks.append((self._stack[-1][1], text))

    def _open(self, tag: str, attributes: str) -> None:
        parent = self._stack[-1][1]
        named = [
            (kind.lower(), a or b or c) for kind, a, b, c in _NAMES.findall(attributes)
        ] if attributes.strip() else []
        names = " ".join(value for _, value in named)
        within = self.nodes[parent][2]
        inside = within or any(t in _ARTICLE for t, _ in self._stack)
        noise = (
            within or tag in _NOISE_TAGS or tag == "header" and not inside
            or bool(named) and tag not in ("html", "body", "main") and _says_noise(tag, named, inside)
        )
        # Noise, and an article, get a node at any depth; what is below them has one already.
        if len(self._stack) > DEPTH and not (noise and not within or tag in _ARTICLE and not inside):
            self._stack.append((tag, parent))
            return
        label = f"{tag}.{_DIGITS.sub('0', names)}" if names else tag
        node = self._child.get((parent, label))
        if node is None:
            node = self._child[parent, label] = len(self.nodes)
            self.nodes.append((parent, label, noise))
            self.links.append(0)
        self._stack.append((tag, node))

    def _close(self, tag: str) -> None:
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][0] == tag:
                del self._stack[k:]
                return

    def _parse(self, html: str) -> None:
        at, link = 0, False
        match = _TOKEN.search(html)
        while match is not None:
            if match.start() > at:
                self._add(html[at : match.start()], link)
            at = match.end()
            end, tag, attributes = match[1], match[2], match[3]
            if tag is None:
                end, tag, attributes = match[4], match[5], match[6]
            if tag is not None:
                tag = tag.lower()
                if tag in _RAW:
                    if not end and not attributes.endswith("/"):
                        if not tag.startswith("annotation"):
                            self._flush()
                        close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                        at = close.end() if close else len(html)
                elif tag == "a":
                    link = not end
                elif tag in ("br", "wbr"):
                    self._text.append(" " if tag == "br" else "")
                elif tag not in _INLINE:
                    self._flush()
                    link = False
                    if end:
                        self._close(tag)
                    else:
                        self._implied(tag)
                        if tag not in _VOID and not attributes.endswith("/"):
                            self._open(tag, attributes)
            match = _TOKEN.search(html, at)
        self._add(html[at:], link)
        self._flush()

    def _implied(self, tag: str) -> None:
        if self._stack[-1][0] == "p":
            self._stack.pop()
        for k in range(len(self._stack) - 1, 0, -1):
            open_tag = self._stack[k][0]
            if open_tag in _CLOSES.get(tag, ()):
                del self._stack[k:]
                if tag != "tr" or open_tag == "tr":
                    return
            elif open_tag in _SCOPE and not (tag == "tr" and open_tag in ("td", "th")):
                return

    def _add(self, raw: str, link: bool) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self._text.append(text)
            if link:
                self.links[self._stack[-1][1]] += len(text)

    def marks(self) -> list[tuple[int, int]]:
        """For each block a hash of its node's path, and one of path and text."""
        paths: list[str] = []
        for parent, label, _ in self.nodes:
            paths.append(f"{paths[parent]}\n{label}" if paths else label)
        return [
            (xxhash.xxh64_intdigest(paths[node]) >> 1, xxhash.xxh64_intdigest(f"{paths[node]}\n\n{text}") >> 1)
            for node, text in self.blocks
        ]

    def stats(self) -> list[dict]:
        """Characters, link characters and a hash of each node's own text."""
        own: list[list[str]] = [[] for _ in self.nodes]
        for node, text in self.blocks:
            own[node].append(text)
        return [
            {"chars": sum(map(len, t)), "links": self.links[i],
             "h": xxhash.xxh64_intdigest("\n".join(t)) >> 1}
            for i, t in enumerate(own)
        ]


def host_of(url: str | None) -> str:
    """The host of a URL in small letters, without port and user; empty if there is none."""
    match = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", url or "")
    return match[1].rpartition("@")[2].split(":")[0].lower() if match else ""


# A wrapper node: [label, is noise, pages, chars, link chars, least hash, greatest hash, children,
# its number in the page]


def tree_of(nodes: list, stats: list) -> list:
    """The wrapper of one shape. ``stats`` has (pages, chars, links, lo, hi) by node."""
    built = [
        [label, noise, *s, [], k] for k, ((_, label, noise), s) in enumerate(zip(nodes, stats, strict=True))
    ]
    for (parent, _, _), node in zip(nodes[1:], built[1:], strict=True):
        built[parent][7].append(node)
    return built[0]


def match_trees(a: list, b: list) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching: the most nodes of ``a`` and ``b`` that can be paired.

    Roots must have the same label; children are paired in order, by dynamic programming.
    """
    if a[0] != b[0]:
        return 0, []
    rows, columns = a[7], b[7]
    size = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
    pairs: dict[tuple[int, int], tuple[int, list]] = {}
    for i, x in enumerate(rows):
        for j, y in enumerate(columns):
            best = max(size[i][j + 1], size[i + 1][j])
            if x[0] == y[0]:
                pairs[i, j] = match_trees(x, y)
                best = max(best, size[i][j] + pairs[i, j][0])
            size[i + 1][j + 1] = best
    found, i, j = [(a, b)], len(rows), len(columns)
    while i and j:
        if size[i][j] == size[i - 1][j]:
            i -= 1
        elif size[i][j] == size[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found += pairs[i, j][1]
    return size[-1][-1] + 1, found


def merge_trees(a: list, b: list) -> list:
    """``a`` with ``b`` added: paired nodes summed up, other nodes of ``b`` hung in."""
    _, pairs = match_trees(a, b)
    partner = {id(y): x for x, y in pairs}
    for x, y in pairs:
        x[1] = x[1] or y[1]
        for k in (2, 3, 4):
            x[k] += y[k]
        x[5], x[6] = min(x[5], y[5]), max(x[6], y[6])
        x[7].extend(child for child in y[7] if id(child) not in partner)
    return a


def _varying(node: list, total: dict[int, int]) -> int:
    """Characters below ``node`` outside noise and template, links taken off twice."""
    own = 0
    if not node[1]:
        if not (node[5] == node[6] and node[2] >= SEEN):
            own = max(0, node[3] - 2 * node[4])
        own += sum(_varying(child, total) for child in node[7])
    total[id(node)] = own
    return own


def _articles(node: list, total: dict[int, int], out: list) -> None:
    if node[1]:
        return
    tag = node[0].partition(".")[0]
    if (tag in _ARTICLE or "articleBody" in node[0]) and (total[id(node)] or node[3]):
        inner: list = []
        for child in node[7]:
            _articles(child, total, inner)
        out.extend(inner if inner and tag == "main" else [node])
        return
    for child in node[7]:
        _articles(child, total, out)


def kept_nodes(wrapper: list) -> set[int]:
    """Identities of the wrapper's nodes whose text is the article."""
    total: dict[int, int] = {}
    _varying(wrapper, total)
    named: list = []
    _articles(wrapper, total, named)
    kept: set[int] = set()

    def keep(node: list, whole: bool) -> None:
        if node[1]:
            return
        constant = node[5] == node[6] and node[2] >= SEEN and node[3]
        linked = node[3] and 2 * node[4] > node[3]
        if whole or not (constant or linked):
            kept.add(id(node))
        for child in node[7]:
            keep(child, whole)

    if named:
        # Every node inside an article belongs to it; what its blocks share, _templates() finds.
        for node in named:
            keep(node, True)
        return kept
    node = wrapper
    while True:
        rest = max(node[7], key=lambda child: total[id(child)], default=None)
        if rest is None or total[id(rest)] < 0.7 * total[id(node)] or not rest[7]:
            break
        node = rest
    keep(node, total[id(node)] == 0)
    return kept


def _parsed(pages: DataFrame) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, shapes, stats, blocks = [], [], [], []
            for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                page = Page(html or "")
                hosts.append(host_of(url))
                shapes.append(json.dumps(page.nodes, ensure_ascii=False))
                stats.append(page.stats())
                blocks.append([
                    {"node": node, "text": text, "slot": slot, "mark": mark}
                    for (node, text), (slot, mark) in zip(page.blocks, page.marks(), strict=True)
                    if not page.nodes[node][2]  # noise is never kept
                ])
            stat = pa.struct([("chars", pa.int64()), ("links", pa.int64()), ("h", pa.int64())])
            block = pa.struct([("node", pa.int32()), ("text", pa.string()), ("slot", pa.int64()), ("mark", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hosts, pa.string()), pa.array(shapes, pa.string()),
                 pa.array(stats, pa.list_(stat)), pa.array(blocks, pa.list_(block))],
                ["page_id", "url", "host", "shape", "stats", "blocks"],
            )

    schema = (
        f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, host string, shape string, "
        "stats array<struct<chars:long,links:long,h:long>>, "
        "blocks array<struct<node:int,text:string,slot:long,mark:long>>"
    )
    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    return cut_lineage(rows.mapInArrow(scan, schema).withColumn("shape_id", F.xxhash64("shape")))


def _shapes(parsed: DataFrame) -> DataFrame:
    """(host, shape_id, tree): the pages of each host and shape, added up node by node."""
    nodes = parsed.select("host", "shape_id", "shape", F.posexplode("stats").alias("node", "stat"))
    summed = nodes.groupBy("host", "shape_id", "node").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("stat.chars").alias("chars"),
        F.sum("stat.links").alias("links"), F.min("stat.h").alias("lo"), F.max("stat.h").alias("hi"),
        F.max(F.when(F.col("node") == 0, F.col("shape"))).alias("shape"),
    )
    whole = summed.groupBy("host", "shape_id").agg(
        F.max("shape").alias("shape"),
        F.sort_array(F.collect_list(F.struct("node", "pages", "chars", "links", "lo", "hi"))).alias("stats"),
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [
                json.dumps(tree_of(json.loads(shape), [
                    (s["pages"], s["chars"], s["links"], s["lo"], s["hi"]) for s in stats
                ]), ensure_ascii=False)
                for shape, stats in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(trees, pa.string())], ["host", "shape_id", "tree"]
            )

    return cut_lineage(whole.mapInArrow(build, "host string, shape_id long, tree string"))


def _wrappers(shapes: DataFrame) -> DataFrame:
    """(host, wrapper): the trees of each host merged, FAN_IN at a time."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["host", "bucket"]):
            trees = map(json.loads, table.column("tree").to_pylist())
            tree = next(trees)
            for other in trees:
                tree = merge_trees(tree, other)
            yield pa.RecordBatch.from_arrays(
                [table.column("host")[:1].combine_chunks(), table.column("shape_id")[:1].combine_chunks(),
                 pa.array([json.dumps(tree, ensure_ascii=False)], pa.string())],
                ["host", "shape_id", "tree"],
            )

    trees = shapes
    while True:
        sizes = trees.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / FAN_IN).cast("int").alias("buckets"))
        most = sizes.agg(F.max("buckets")).first()[0] or 1
        merged = (
            trees.join(sizes, "host")
            .select("host", F.pmod(F.xxhash64("shape_id", F.lit(most)), F.col("buckets")).alias("bucket"), "shape_id", "tree")
            .repartition(spread(shapes), "host", "bucket")
            .sortWithinPartitions("host", "bucket", "shape_id")
            .mapInArrow(merge, "host string, shape_id long, tree string")
        )
        trees = cut_lineage(merged)
        if most == 1:
            return trees.select("host", F.col("tree").alias("wrapper"))


def _choices(shapes: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, shape_id, keep): for each node of a shape whether its text is kept."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keeps = []
            for text, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                tree, wrapper = json.loads(text), json.loads(wrapper)
                wanted = kept_nodes(wrapper)
                _, pairs = match_trees(wrapper, tree)
                kept = {id(y) for x, y in pairs if id(x) in wanted}
                if not kept:  # nothing of the wrapper's article is here: the page's own
                    kept = kept_nodes(tree)
                keeps.append([tree, kept])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([_in_order(tree, kept) for tree, kept in keeps], pa.list_(pa.bool_()))],
                ["host", "shape_id", "keep"],
            )

    return shapes.join(wrappers, "host").mapInArrow(
        choose, "host string, shape_id long, keep array<boolean>"
    )


def _templates(parsed: DataFrame) -> DataFrame:
    """(host, template): the marks of the blocks that the pages of a host share.

    Pages of a host with the same blocks count once: copies of a page say nothing about
    what is template.
    """
    marks = F.array_distinct(F.transform("blocks", lambda b: F.struct(b["slot"].alias("slot"), b["mark"].alias("mark"))))
    pages = parsed.select("host", marks.alias("marks")).groupBy(
        "host", F.xxhash64("marks").alias("page")
    ).agg(F.first("marks").alias("marks"))
    slots = F.transform(
        F.array_distinct(F.col("marks.slot")), lambda s: F.struct(s.alias("slot"), F.lit(None).cast("long").alias("mark"))
    )
    counted = cut_lineage(
        pages.select("host", F.explode(F.concat("marks", slots)).alias("m"))
        .groupBy("host", "m.slot", "m.mark").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= BLOCK_SEEN)
    )
    whole = counted.where("mark is null").select("host", "slot", F.col("n").alias("pages"))
    return (
        counted.where("mark is not null").join(whole, ["host", "slot"])
        .where(F.col("n") >= BLOCK_SHARE * F.col("pages"))
        .groupBy("host").agg(F.collect_list("mark").alias("template"))
    )


def _in_order(tree: list, kept: set[int]) -> list[bool]:
    """Kept or not by node number: nodes are numbered as they were found in the page."""
    found: dict[int, bool] = {}

    def walk(node: list) -> None:
        found[node[8]] = id(node) in kept
        for child in node[7]:
            walk(child)

    walk(tree)
    return [found[k] for k in range(len(found))]


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    The text is that of the article without menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles, markup, comments and blocks that at least BLOCK_SEEN
    pages of the host share: character references decoded,
    white space inside a block as one space, blocks joined by a newline in page order.
    Null and empty html give an empty text; a page without url belongs to the host of
    the empty name. Repeated rows each give a row. Other columns are left out.
    """
    ship_package(pages.sparkSession)
    parsed = _parsed(pages)
    shapes = _shapes(parsed)
    choices = cut_lineage(
        _choices(shapes, _wrappers(shapes)).join(_templates(parsed), "host", "left")
    ).select(F.col("host").alias("h"), F.col("shape_id").alias("s"), "keep", "template")
    joined = parsed.join(choices, (F.col("host") == F.col("h")) & (F.col("shape_id") == F.col("s")))
    kept = F.filter("blocks", lambda b: F.element_at(F.col("keep"), b["node"] + 1))
    own = F.filter("kept", lambda b: ~F.array_contains(F.coalesce("template", F.array().cast("array<bigint>")), b["mark"]))
    # A page of nothing but shared blocks keeps them.
    own = F.when(F.col("template").isNull() | (F.size(own) == 0), F.col("kept")).otherwise(own)
    text = F.array_join(F.transform(own, lambda b: b["text"]), "\n")
    return joined.select("page_id", "url", kept.alias("kept"), "template").select(
        "page_id", "url", text.alias("text")
    ).withColumn(
        "n_chars", F.length("text").cast("long")
    )
