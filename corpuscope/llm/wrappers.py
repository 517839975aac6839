"""Main text of web pages by wrappers induced from the pages of a host.

Every page is read into a tree; runs of like siblings fold into one *slot*. The folded trees (skeletons)
of a host's pages are aligned with the host's most frequent skeleton by simple tree matching, which gives
slots of different pages a common name. Text that a slot repeats on nearly all different articles of the
host is template; varying text is content. Versions of one article count as one. Elements that HTML itself names as something other
than main text (navigation, footers, forms, scripts ...) never are content.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpuscope.runtime import written

#: Share of a host's different articles whose slot repeats a text that makes it template, and the fewest articles.
TEMPLATE_SHARE = 0.9
TEMPLATE_PAGES = 4
#: Slots are named by so many steps from the root; what is deeper belongs to the slot above.
DEPTH = 60

# Names of HTML elements by their meaning.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp", "svg", "math")
#: Of these, the ones that may be closed by a slash in their own tag.
_FOREIGN = frozenset(("svg", "math"))
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_NEVER = frozenset(
    "head script style noscript template iframe object embed canvas svg math audio video nav footer aside button "
    "select option input textarea dialog menu noembed noframes xmp title".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
# Words in class, id and role attributes that name parts other than main text.
_NOT_MAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "widget footer copyright comment comments reply replies respond disqus discussion share sharing "
    "social related recommended newsletter subscribe subscription signup login search pagination pager toolbar skip "
    "complementary contentinfo".split()
)
_HEAD = frozenset("header masthead".split())
_MAIN_WORDS = frozenset("article articlebody main content post entry story".split())
_NOT_ARTICLE = frozenset("ad ads advert advertisement sponsored promo comment comments reply replies related".split())
#: Of these, the ones that are never main text, whatever the element holds.
_HARD = _NOT_ARTICLE - {"related"}
# Words that name a part only alone, or beside words that do so or are in the second list: ``related-posts``, but not
# ``search-results`` or ``tag-related-work``.
_LONE = frozenset("nav related search social".split())
_BESIDE = frozenset(
    "articles bar block box button buttons form icons items left links list main media posts primary right secondary section "
    "stories top".split()
)
#: ``with-sidebar`` names a page that has a sidebar, not the sidebar.
_HAVING = frozenset("with has no without".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMING = frozenset("class id role itemprop".split())
_SPACE = re.compile(r"\s+")
_NAME_PART = re.compile(r"[a-z]+")


class Node:
    """An element, with the text that stands directly in it between its child elements."""

    __slots__ = ("tag", "label", "kids", "drop", "named", "head", "main", "chars", "marked")

    def __init__(self, tag: str, attributes: str) -> None:
        self.tag, self.kids, self.label = tag, [], tag
        self.drop, self.head, self.main = tag in _NEVER, tag == "header", 2 if tag == "article" else int(tag == "main")
        #: Left out for its name (or as a form), unless :func:`_settle` finds the main text in it.
        self.named = tag == "form"
        if not attributes:
            return
        names: list[str] = []
        lone: list[list[str]] = []
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key == "hidden" or (key == "aria-hidden" and (a or b or c).lower() == "true"):
                self.drop = True
            elif key in _NAMING:
                for name in (a or b or c).lower().split():
                    parts = _NAME_PART.findall(name)
                    names += parts
                    if not _LONE.isdisjoint(parts):
                        lone.append(parts)
        if names and tag not in ("html", "body"):
            self.label = f"{tag}.{'.'.join(names[:4])}"
            own = self.main > 0
            against = _NOT_ARTICLE if own or "main" in names else _NOT_MAIN
            found = against.intersection(names)
            if found and lone:
                clear = _NOT_MAIN | _BESIDE
                found -= {w for w in _LONE if not any(w in parts and clear.issuperset(parts) for parts in lone)}
            if found and not _HAVING.intersection(names):
                if own or _HARD.isdisjoint(found):
                    self.named = True
                    if _MAIN_WORDS.intersection(names):
                        self.main = max(self.main, 1)
                else:
                    self.drop = True
            elif _HEAD.intersection(names):
                self.head = True
            elif _MAIN_WORDS.intersection(names):
                self.main = max(self.main, 1)


def parse(page: str) -> Node:
    """The tree of a page, however broken its markup: unclosed elements end with their parents."""
    root = Node("", "")
    stack, at = [root], 0
    lower = None
    tags = _TAG.finditer(page)
    while (m := next(tags, None)) is not None:
        begin, end = m.span()
        if begin > at:
            stack[-1].kids.append(page[at:begin])
        at = end
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            else:
                if tag == "br" or tag == "p":
                    stack[-1].kids.append(Node(tag, ""))
            continue
        if tag in _CLOSES_P:
            # A paragraph ends here, with the inline elements left open in it.
            depth = len(stack) - 1
            while depth > 0 and stack[depth].tag in _INLINE:
                depth -= 1
            if stack[depth].tag == "p":
                del stack[depth:]
        if tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
            own = {"td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(tag, (tag,))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in own:
                    del stack[depth:]
                    break
                if stack[depth].tag in ("ul", "ol", "table", "dl", "select"):
                    break
        node = Node(tag, m[3])
        stack[-1].kids.append(node)
        if tag in _RAW and not (tag in _FOREIGN and m[3].endswith("/")):
            lower = page.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
            stop = page.find(">", at)
            at = len(page) if stop < 0 else stop + 1
            tags = _TAG.finditer(page, at)
        elif tag not in _VOID and not m[3].endswith("/"):
            stack.append(node)
    if at < len(page):
        stack[-1].kids.append(page[at:])
    _settle(root)
    return root


def _settle(root: Node) -> None:
    """Leave out the elements that are named like other parts, but not one that holds the page's main text.

    That is more than half of the characters marked as main content, or of all if none are marked.
    """
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [kid for kid in node.kids if not isinstance(kid, str) and not kid.drop]
    for node in reversed(order):
        below = [kid for kid in node.kids if not isinstance(kid, str) and not kid.drop]
        node.chars = sum(len(kid.strip()) for kid in node.kids if isinstance(kid, str)) + sum(kid.chars for kid in below)
        node.marked = node.chars if node.main else sum(kid.marked for kid in below)
    for node in order:
        if node.named:
            most = 2 * node.marked > root.marked if root.marked else 2 * node.chars > root.chars
            node.drop = not most


def _tidy(parts: list[str]) -> str:
    text = "".join(parts)
    if "&" in text:
        text = html.unescape(text)
    return " ".join(text.split()) if text.isascii() else _SPACE.sub(" ", text).strip()


def blocks(root: Node) -> list[tuple[int, str, str]]:
    """Text blocks in page order: how main their place is, their path of folded slots, their text.

    A place inside an article is 2, inside other marked main content 1, else 0. A header is left out
    unless it stands within such content.
    """
    out: list[tuple[int, str, str]] = []
    texts: list[str] = []
    place = ["", 0]

    def close() -> None:
        if texts:
            text = _tidy(texts)
            if text:
                out.append((place[1], place[0], text))
            texts.clear()

    # Explicit stack: pages may nest elements deeper than Python's calls.
    todo: list = [("open", root, "", 0)]
    while todo:
        what, node, path, main = todo.pop()
        if what == "text":
            if not texts:
                place[:] = [path, main]
            texts.append(node)
        elif what == "close":
            close()
        elif node.tag == "br":
            texts.append(" ")
        elif not (node.drop or (node.head and not main)):
            main = max(main, node.main)
            inline = node.tag in _INLINE
            if not inline:
                close()
                path = f"{path}/{node.label}" if node.tag and path.count("/") < DEPTH else path
                todo.append(("close", None, "", 0))
            for kid in reversed(node.kids):
                todo.append(("text", kid, path, main) if isinstance(kid, str) else ("open", kid, path, main))
    return out


def skeleton(paths: list[str]) -> str:
    """The folded tree of a page as its distinct slot paths in order of first occurrence."""
    return "\n".join(dict.fromkeys(paths))


def _tree(paths: tuple[str, ...]) -> dict:
    root: dict = {}
    for path in paths:
        at = root
        for label in path.split("/")[1:]:
            at = at.setdefault(label, {})
    return root


def simple_tree_matching(a: dict, b: dict) -> tuple[int, list]:
    """The most nodes that can be matched in order, root by root, and the matched child pairs with theirs.

    The score of two nodes is 1 plus the best order-preserving matching of their children, whose
    elements must be equal (their classes may differ).
    """
    left, right = list(a.items()), list(b.items())
    best = [[(0, None)] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, (x, below_x) in enumerate(left, 1):
        for j, (y, below_y) in enumerate(right, 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], key=lambda s: s[0])
            if x.split(".")[0] == y.split(".")[0]:
                score, inner = simple_tree_matching(below_x, below_y)
                score += best[i - 1][j - 1][0] + (1 if x == y else 0.5)
                if score > best[i][j][0]:
                    best[i][j] = (score, (x, y, inner, best[i - 1][j - 1][1]))
    pairs, link = [], best[-1][-1][1]
    while link:
        pairs.append(link[:3])
        link = link[3]
    return 1 + best[-1][-1][0], pairs[::-1]


@lru_cache(maxsize=4096)
def align(reference: str, own: str) -> dict[str, str]:
    """The reference's name of each slot path of a page's skeleton; unmatched slots keep their own."""
    names = {p: p for p in own.split("\n")}
    if reference == own or not reference:
        return names

    def walk(pairs: list, ours: str, theirs: str) -> None:
        for x, y, inner, *_ in pairs:
            names[f"{ours}/{y}"] = f"{theirs}/{x}"
            walk(inner, f"{ours}/{y}", f"{theirs}/{x}")

    walk(simple_tree_matching(_tree(tuple(reference.split("\n"))), _tree(tuple(own.split("\n"))))[1], "", "")
    return names


def least_mark(found: list[tuple[int, str, str]]) -> int:
    """The mark that a block needs to be content: an article's if articles hold most of the marked text.

    Otherwise any mark will do, so that a teaser does not stand for the page; without marks all is content.
    """
    marked = sum(len(t) for main, _, t in found if main)
    return 2 if 2 * sum(len(t) for main, _, t in found if main == 2) > marked else int(marked > 0)


def _digest(text: str) -> int:
    """64 bits that stand for a slot path or a text."""
    return xxhash.xxh3_64_intdigest(text) - 2**63


def _slots(tables):
    """Every (slot, text) of a page, whether it is content, and the page's skeleton."""
    for table in tables:
        rows = defaultdict(list)
        for host, page in zip(table.column("host").to_pylist(), table.column("html").to_pylist()):
            found = blocks(parse(page or ""))
            own = skeleton([p for _, p, _ in found])
            rows["host"].append(host)
            rows["skeleton"].append(own)
            rows["page"].append(_digest(repr(found)))
            rows["slots"].append([p for _, p, _ in found])
            rows["texts"].append([_digest(t) for _, _, t in found])
            least = least_mark(found)
            rows["content"].append([main >= least for main, _, _ in found])
        kinds = [("host", pa.string()), ("skeleton", pa.string()), ("page", pa.int64()),
                 ("slots", pa.list_(pa.string())), ("texts", pa.list_(pa.int64())), ("content", pa.list_(pa.bool_()))]
        yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in kinds], [n for n, _ in kinds])


def _named(tables):
    """Every distinct pair of a page, its slot named as in the reference skeleton of the host, and how many are content.

    From here on slots are digests like the texts: a host's template goes with each of its pages.
    """
    for table in tables:
        slots, texts, content, sizes = [], [], [], []
        columns = ("reference", "skeleton", "slots", "texts", "content")
        for ref, own, *blocks in zip(*(table.column(c).to_pylist() for c in columns)):
            names, pairs = align(ref or "", own), {}
            for slot, text, main in zip(*blocks):
                pair = (names[slot], text)
                pairs[pair] = main or pairs.get(pair, False)
            slots.append([_digest(s) for s, _ in pairs])
            texts.append([t for _, t in pairs])
            content.append(list(pairs.values()))
            sizes.append(sum(pairs.values()))
        yield pa.RecordBatch.from_arrays(
            [table.column("host"), table.column("page"), pa.array(slots, pa.list_(pa.int64())), pa.array(texts, pa.list_(pa.int64())),
             pa.array(content, pa.list_(pa.bool_())), pa.array(sizes, pa.int32())],
            ["host", "page", "slots", "texts", "content", "size"],
        )


def induce(pages: DataFrame) -> DataFrame:
    """Per ``host``: its reference skeleton and the (slot, text) pairs that are template.

    ``pages`` has ``host`` and ``html``. All pages count, equal ones once, and pages that share most of
    their content blocks together about once: a page counts 1 / m if more than half of its content pairs
    stand on m pages or more each. These counts added up are the host's articles. A pair is template if it
    has ``TEMPLATE_SHARE`` of them, and they are ``TEMPLATE_PAGES`` at least; a host has at most its
    pages' mean number of blocks / ``TEMPLATE_SHARE`` such pairs.
    """
    schema = "host string, skeleton string, page long, slots array<string>, texts array<long>, content array<boolean>"
    slots = written(pages.mapInArrow(_slots, schema), "page-slots")
    shapes = slots.groupBy("host", "skeleton").agg(F.count(F.lit(1)).alias("n"))
    # The most frequent skeleton; aggregated, so that no task sorts the shapes of a host.
    reference = shapes.groupBy("host").agg(F.max(F.struct("n", "skeleton"))["skeleton"].alias("reference"))
    reference = written(reference.withColumnRenamed("host", "h"), "references")
    named = slots.dropDuplicates(["host", "page"]).join(reference, F.col("host").eqNullSafe(F.col("h")), "left").drop("h")
    schema = "host string, page long, slots array<long>, texts array<long>, content array<boolean>, size int"
    named = written(named.mapInArrow(_named, schema), "named-slots")
    pairs = named.select("host", "page", "size", F.explode(F.arrays_zip("slots", "texts", "content")).alias("x"))
    pairs = pairs.select("host", "page", "size", F.col("x.slots").alias("slot"), F.col("x.texts").alias("text"), F.col("x.content").alias("content"))
    # Pairs of one page only make no template and fold nothing.
    often = pairs.groupBy("host", "slot", "text").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    often = written(often.toDF("h", "s", "t", "n"), "repeated-pairs")
    same = F.col("host").eqNullSafe(F.col("h")) & (F.col("slot") == F.col("s")) & (F.col("text") == F.col("t"))
    shared = written(pairs.join(often, same).drop("h", "s", "t"), "shared-pairs")
    half = F.floor(F.col("size") / 2).cast("int")
    folded = shared.filter("content").groupBy("host", "page", "size").agg(F.sort_array(F.collect_list("n"), False).alias("counts"))
    folded = folded.filter(F.size("counts") > half).select(
        F.col("host").alias("h"), F.col("page").alias("p"), (1 - 1 / F.element_at("counts", half + 1)).alias("less")
    )
    folded = written(folded, "folded-pages")
    less = folded.groupBy("h").agg(F.sum("less").alias("less"))
    each = named.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= TEMPLATE_PAGES)
    each = each.join(less, F.col("host").eqNullSafe(F.col("h")), "left")
    # Rounded, so that thirds and the like add up to whole articles.
    each = each.select(F.col("host").alias("h"), F.round(F.col("pages") - F.coalesce("less", F.lit(0.0)), 6).alias("articles"))
    each = each.filter(F.col("articles") >= TEMPLATE_PAGES)
    there = F.col("host").eqNullSafe(F.col("h")) & (F.col("page") == F.col("p"))
    support = shared.filter(F.col("n") >= TEMPLATE_PAGES).join(folded, there, "left").drop("h", "p")
    support = support.groupBy("host", "slot", "text").agg(F.sum(1 - F.coalesce("less", F.lit(0.0))).alias("support"))
    fixed = support.join(written(each, "host-articles"), F.col("host").eqNullSafe(F.col("h")))
    fixed = fixed.filter(F.round("support", 6) >= F.round(TEMPLATE_SHARE * F.col("articles"), 6)).drop("h")
    fixed = fixed.groupBy("host").agg(F.collect_list(F.struct("slot", "text")).alias("template"))
    out = reference.join(fixed, F.col("h").eqNullSafe(F.col("host")), "left").drop("host")
    return written(out, "wrappers")


def main_text(page: str | None, reference: str, template: set[tuple[int, int]]) -> str:
    """The content blocks of a page, one a line.

    Content are the blocks of articles if these hold most of the text in marked main content, else
    all in marked main content, else all. Of them, template blocks are left out, unless that leaves nothing.
    """
    found = blocks(parse(page or ""))
    if not found:
        return ""
    least = least_mark(found)
    names = align(reference or "", skeleton([p for _, p, _ in found]))
    own = [(names[p], t) for main, p, t in found if main >= least]
    kept = [t for s, t in own if (_digest(s), _digest(t)) not in template] if template else []
    return "\n".join(kept or [t for _, t in own])


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Add ``text_col`` and ``n_chars`` to every row: the main text of its page (empty if there is none).

    Pages without a host share one wrapper. White space in a block becomes one space, character
    references are decoded, blocks are joined by a line feed. Null and broken pages give what can be
    read of them. Existing columns of those names are replaced; the page itself is left out.
    """
    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    wrappers = induce(pages.select(host.alias("host"), F.col(html_col).alias("html")))
    wrappers = wrappers.select(F.col("h").alias("_host"), F.col("reference").alias("_reference"), F.col("template").alias("_template"))
    pages = pages.drop(text_col, "n_chars").withColumn("_h", host)
    rows = pages.join(wrappers, F.col("_h") == F.col("_host"), "left").drop("_h", "_host")
    kept = [f for f in rows.schema if f.name not in ("_reference", "_template", html_col)]
    schema = StructType([*kept, StructField(text_col, StringType()), StructField("n_chars", LongType())])

    def run(tables):
        for table in tables:
            texts, columns = [], (table.column(c) for c in (html_col, "_reference", "_template"))
            for page, reference, template in zip(*columns):  # row by row, so that a batch is not held as Python's values
                found = {(x["slot"], x["text"]) for x in template.as_py() or []}
                texts.append(main_text(page.as_py(), reference.as_py(), found))
            yield pa.RecordBatch.from_arrays(
                [*(table.column(f.name) for f in kept), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                schema.names,
            )

    return rows.mapInArrow(run, schema)
