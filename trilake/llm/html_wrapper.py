"""Main text of web pages by wrapper induction.

1. Each page is parsed to a tree; runs of equal siblings (paragraphs, list items) become
   one node, as a wrapper's iterators do. Every text block gives (host, slot, hash of its
   text), the slot being the path of its node.
2. Over all pages of a host, copies and near copies of a page counted about once, the texts
   of every node are counted: of a path as a whole, and of each place among its equal
   siblings, from the front and from the back. A node is constant if at least half of what
   stands there are texts that a fifth of its pages (and three of them) share; a place must
   also be on at least half of the pages with its path. The host's
   wrapper is the tree of its slots with the constant nodes' texts; a rare slot that is not
   constant is left out.
3. Each page's tree is aligned with its host's wrapper by simple tree matching (the largest
   order-preserving match of nodes with equal tags). Blocks that stand at a constant node
   with one of its texts are template and go, in article and main elements too. All others
   stay: a text of a varying node is content, however often the host repeats it. A page of
   template only has an empty text. Elements that are furniture by their tag (menus, footers,
   forms that do not hold the page's own text) go in any case. Elements that a class word,
   id or role names as furniture go too, unless hardly any text is left without them: then
   their long blocks stay if their slot varies.

The counts combine before they shuffle; the wrappers (small, whatever the number of pages)
are written first, so both sides of the join with the pages are plain tables and a hot host
is split.

Cases: null and empty html give an empty text; a null url has the empty host; unclosed and
truncated markup is closed where the page ends; deep nesting costs memory in proportion to
the page (paths are folded); repeated rows are rows like any other; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import materialise, text_blocks

#: Different pages of a host with the same text at a node from which on it may be repeated.
REPEATED = 3
#: Share of the node's pages that such a text is on at least. Pages are counted by their
#: contents: copies and near copies of one page count about once.
SHARE = 0.2
#: Share of repeated texts from which on a node is constant.
CONSTANT = 0.5
#: Keys of a path after which its beginning is folded into a hash, and a key's longest name.
FOLD, KEY = 64, 48
#: Article, main or h1 elements, or so many paragraphs, make a form the page's own text.
FORM_TEXT = 3
#: Words in a row that tell whether two pages are copies.
SHINGLE = 4
#: Share of a host's pages that a slot without repeated texts needs to be in its wrapper.
SUPPORT = 0.01
#: Characters of a long text: of less a page's main text is not certain, and varying long
#: blocks that only a name has put aside come back.
LONG = 200

# Element names and the class, id and role words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head script style noscript template iframe svg canvas object audio video map math".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("nav footer aside form menu dialog button select textarea input fieldset datalist option".split())
NAMED = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
                  "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar sidenav "
                  "aside widget widgets cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
                  "signup login share sharing social related recommended comment comments respond disqus replies "
                  "pagination pager contentinfo complementary search form copyright skip".split())
#: First parts of class words that say a thing is missing or shown: "no-comments", "has-sidebar".
SAYS = frozenset("no not without has with have is hide hidden show off on js".split())
#: Names that an article's own headings have.
HEADER = frozenset(("header", "masthead"))
HEADING = frozenset("header hgroup h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset(("article", "main"))
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "thead": (), "tbody": ("thead", "tbody", "tr", "td", "th")}
#: Elements that an implied end does not reach over.
SCOPE = frozenset("ul ol dl table article section div body html main aside nav header footer td th form".split())

_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<other>[!?])[^>]*(?:>|\Z)|"
                  r"(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z))", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "names", "kids", "holds")

    def __init__(self, tag, names=()):
        self.tag, self.names, self.kids, self.holds = tag, names, [], 0

    @property
    def key(self) -> str:
        first = _WORD.search(" ".join(self.names)) if self.names else None
        key = self.tag + ("." + first[0] if first else "")
        return key if len(key) <= KEY and "/" not in key and "#" not in key else f"{self.tag[:8].strip('/#.~')}~{xxhash.xxh64_hexdigest(key)}"


class _Open:
    """The open elements, with how many of each tag are open in all and in each scope: a stray
    or implied end costs as much as it closes."""

    def __init__(self, root: Node):
        self.nodes, self.forms = [root], []
        self.all: Counter = Counter()
        self.scopes: list[Counter] = [Counter()]

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.all[node.tag] += 1
        if node.tag in SCOPE:
            self.scopes.append(Counter())
        else:
            self.scopes[-1][node.tag] += 1
        if node.tag == "form":
            self.forms.append(node)

    def pop(self) -> Node:
        node = self.nodes.pop()
        self.all[node.tag] -= 1
        if node.tag in SCOPE:
            self.scopes.pop()
        else:
            self.scopes[-1][node.tag] -= 1
        if node.tag == "form":
            form = self.forms.pop()
            if self.forms:
                self.forms[-1].holds += form.holds
        return node

    def end(self, name: str) -> None:
        if self.all[name]:
            while self.pop().tag != name:
                pass

    def imply(self, shut: tuple) -> None:
        """End the elements that an opening tag ends, up to the scope's border."""
        while any(self.scopes[-1][t] for t in shut):
            self.pop()
        while self.nodes[-1].tag in shut and self.nodes[-1].tag in SCOPE:  # a cell ends a cell
            self.pop()
            while any(self.scopes[-1][t] for t in shut):
                self.pop()


def parse(page: str) -> Node:
    """The page's tree; text is a str among a node's kids."""
    root = Node("html")
    opened = _Open(root)
    pos = 0
    while True:
        m = _TAG.search(page, pos)
        if m is None or m.start() > pos:
            opened.nodes[-1].kids.append(page[pos:m.start() if m else len(page)])
        if m is None:
            while len(opened.nodes) > 1:
                opened.pop()
            return root
        pos = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in ("html", "body"):
            continue
        if m["end"]:
            opened.end(name)
            continue
        if name not in INLINE:
            opened.imply(("p", *CLOSES.get(name, ())))
        attrs = m["attrs"]
        names = tuple(w for x in _NAMES.findall(attrs) for w in "".join(x).lower().split()) if attrs else ()
        node = Node(name, names)
        opened.nodes[-1].kids.append(node)
        if opened.forms and name in ("article", "main", "h1", "p"):
            opened.forms[-1].holds += 1 if name == "p" else FORM_TEXT
        if name in RAW:
            close = _close(name).search(page, pos)
            stop = close.start() if close else len(page)
            if name not in SKIPPED:
                node.kids.append(page[pos:stop])
            pos = stop
        if name not in VOID and not attrs.endswith("/"):
            opened.push(node)


@lru_cache(maxsize=64)
def _close(name: str):
    return re.compile(f"</{name}", re.I)


@lru_cache(maxsize=65536)
def name_of(word: str) -> str:
    """The furniture that a class word, id or role names as a whole or by its last part, or ""."""
    parts = _WORD.findall(word)
    return parts[-1] if parts and parts[-1] in NAMED and not (len(parts) > 1 and parts[0] in SAYS) else ""


def furniture(node: Node, in_article: bool) -> int:
    """Whether an element says that it is not main text: 2 by its tag, 1 by its name, 0 no."""
    if node.tag == "form" and node.holds >= FORM_TEXT:
        return 0
    if node.tag in SKIPPED or node.tag in FURNITURE:
        return 2
    if node.tag == "header" and not in_article:
        return 2
    if node.tag == "main" or in_article and node.tag in HEADING:
        return 0
    said = {name_of(w) for w in node.names} - {""}
    return int(bool(said - HEADER if in_article else said))


def _below(path: str, key: str) -> str:
    """The path of a child; a deep path's beginning is folded into a hash."""
    if path.count("/") >= FOLD:
        path = f"/~{xxhash.xxh64_hexdigest(path)}"
    return f"{path}/{key}"


def blocks(root: Node) -> list[tuple[str, str, int, bool]]:
    """(path, text, furniture (see above), in an article) of the page's text blocks in order. A path
    names tags and first class words; equal siblings have equal paths."""
    out: list[tuple[str, str, int, bool]] = []
    held: list[str] = []

    def flush(state):
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((state[0], text, state[1], state[2]))

    # (node, state) or a state to return to; a state is (path, furniture, in an article)
    stack: list = [(root, ("", 0, False))]
    while stack:
        node, state = stack.pop()
        if node is None:  # a block ends
            flush(state)
            continue
        if isinstance(node, str):
            held.append(node)
            continue
        if node.tag in SKIPPED:
            continue
        if node.tag in ("br", "hr", "img"):
            held.append(" ")
            if node.tag != "hr":
                continue
        inner = (state[0], max(state[1], furniture(node, state[2])), state[2] or node.tag in ARTICLE)
        if node.tag in INLINE and inner == state:
            stack += [(k, state) for k in reversed(node.kids)]
            continue
        flush(state)
        inner = (_below(state[0], node.key), *inner[1:])
        stack.append((None, inner))
        for k in reversed(node.kids):
            if isinstance(k, Node) and not (k.tag in INLINE and not furniture(k, inner[2])):
                # what stands before a block child belongs to this block
                stack.append((k, inner))
                stack.append((None, inner))
            else:
                stack.append((k, inner))
    return out


# -- wrapper ---------------------------------------------------------------------------

def tree_of(paths) -> dict:
    """Paths as a nested dict, children in the order they first appear."""
    root: dict = {}
    for p in paths:
        at = root
        for key in p.split("/")[1:]:
            at = at.setdefault(key, {})
    return root


def _tag(key: str) -> str:
    return key.partition(".")[0]


def _matches(page: dict, wrapper: dict) -> dict[tuple[int, int], tuple[float, dict]]:
    """(weight, matched child keys) of the children of every two nodes that are compared, by
    the nodes' ids; with a stack of its own, as pages may be nested to any depth."""
    known: dict[tuple[int, int], tuple[float, dict]] = {}
    work = [(page, wrapper)]
    while work:
        a, b = work[-1]
        if (id(a), id(b)) in known:
            work.pop()
            continue
        same = [(p, q) for p in a for q in b if _tag(p) == _tag(q)]
        open_ = [(a[p], b[q]) for p, q in same if (id(a[p]), id(b[q])) not in known]
        if open_:
            work += open_
            continue
        gain = {(p, q): 1 + 0.5 * (p == q) + known[id(a[p]), id(b[q])][0] for p, q in same}
        x, y = list(a), list(b)
        best = [[0.0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                best[i + 1][j + 1] = max(best[i][j] + gain.get((p, q), 0.0), best[i][j + 1], best[i + 1][j])
        pairs, i, j = {}, len(x), len(y)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs[x[i]] = y[j]
        known[id(a), id(b)] = best[-1][-1], pairs
        work.pop()
    return known


def align(page: dict, wrapper: dict) -> dict[str, str]:
    """Simple tree matching: page path -> wrapper path of the largest order-preserving match.
    Nodes match if their tags are equal; equal class words count half a node more."""
    known = _matches(page, wrapper)
    out: dict[str, str] = {}
    work = [(page, wrapper, "", "")]
    while work:
        a, b, pa_, pb = work.pop()
        for p, q in known[id(a), id(b)][1].items():
            out[f"{pa_}/{p}"] = f"{pb}/{q}"
            work.append((a[p], b[q], f"{pa_}/{p}", f"{pb}/{q}"))
    return out


def aligned(page_paths, wrapper_paths) -> dict[str, str]:
    """``align`` for these paths only (a deep page has very many longer beginnings of them)."""
    page, wrapper = tree_of(page_paths), tree_of(wrapper_paths)
    known = _matches(page, wrapper)
    out = {}
    for path in page_paths:
        a, b, twin = page, wrapper, []
        for p in path.split("/")[1:]:
            q = known[id(a), id(b)][1].get(p)
            if q is None:
                break
            a, b = a[p], b[q]
            twin.append(q)
        else:
            out[path] = "/" + "/".join(twin)
    return out


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def mark(found) -> int:
    """A page's smallest hash of ``SHINGLE`` words in a row: the same for copies and, mostly,
    for near copies. Blocks that name themselves count only if there are no others."""
    least = 1 << 63
    for _, text, _, _ in [b for b in found if not b[2]] or found:
        w = text.split()
        for i in range(max(1, len(w) - SHINGLE + 1)):
            h = xxhash.xxh64_intdigest(" ".join(w[i:i + SHINGLE])) >> 1
            if h < least:
                least = h
    return least


def places(found) -> list[tuple[str, str, str]]:
    """The nodes that each block stands at: its path, and its place among the blocks with
    that path counted from the front and from the back."""
    total = Counter(b[0] for b in found)
    seen: Counter = Counter()
    out = []
    for path, *_ in found:
        seen[path] += 1
        out.append((path, f"#{seen[path]}", f"#{seen[path] - total[path] - 1}"))
    return out


class Wrapper:
    """A host's slots: their tree, and the constant nodes with their texts."""

    def __init__(self, slots):
        self.paths = sorted({s["path"].partition("#")[0] for s in slots})
        self.constant = {s["path"]: frozenset(s["texts"]) for s in slots if s["constant"]}
        self.twins: dict[tuple, dict] = {}

    def twin(self, page_paths: tuple[str, ...]) -> dict[str, str]:
        """Page path -> wrapper path by tree matching; pages of one layout are matched once."""
        if page_paths not in self.twins:
            if len(self.twins) >= 1024:
                self.twins.clear()
            self.twins[page_paths] = aligned(page_paths, self.paths)
        return self.twins[page_paths]


def main_text(found, wrapper: Wrapper | None = None) -> str:
    """The page's content blocks, one a line."""
    found = [b for b in found if b[2] < 2]
    twin, constant = {}, {}
    if wrapper is not None:
        twin, constant = wrapper.twin(tuple(dict.fromkeys(b[0] for b in found))), wrapper.constant

    def nodes(path):  # the slot the path is aligned with, and that of its own name
        return {path, twin.get(path, path)}

    def template(block, place):
        h = _hash(block[1])
        return any(h in constant.get(q + p, ()) for q in nodes(block[0]) for p in ("", *place[1:]))

    rest = [b for b, p in zip(found, places(found)) if not template(b, p)] if constant else found
    keep = [not b[2] for b in rest]
    if sum(len(b[1]) for b, k in zip(rest, keep) if k) < LONG:  # a name may have put the main text aside
        keep = [k or b[2] == 1 and len(b[1]) >= LONG and not any(q in constant for q in nodes(b[0])) for b, k in zip(rest, keep)]
    return "\n".join(b[1] for b, k in zip(rest, keep) if k)


def _host():
    return F.coalesce(F.lower(F.regexp_extract(F.col("url"), r"://([^/?#]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame, html: str = "html") -> DataFrame:
    """host, slots (path or place, constant, hashes of its repeated texts) for every host, from
    all its pages. Places are kept where they are constant, paths where they are not rare."""

    kind = pa.list_(pa.struct([("path", pa.string()), ("texts", pa.list_(pa.int64()))]))

    def slots(batches):
        for block in text_blocks(batches, "html", 1 << 22):
            out: list[list] = [[], [], [], []]
            for host, page in zip(block.column("host").to_pylist(), block.column("html").to_pylist()):
                found = [b for b in blocks(parse(page or "")) if b[2] < 2]
                if not found:
                    continue
                by_path: dict[str, set] = {"": {-1}}  # "" counts the page, -1 the pages with a slot
                for (path, text, _, _), (_, front, back) in zip(found, places(found)):
                    for node in (path, path + front, path + back):
                        by_path.setdefault(node, {-1}).add(_hash(text))
                row = host, mark(found), _hash(page), [{"path": p, "texts": sorted(t)} for p, t in sorted(by_path.items())]
                for column, v in zip(out, row):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                              pa.array(out[3], kind)], names=["host", "mark", "page", "found"])

    rows = pages.select(_host().alias("host"), F.col(html).alias("html")).mapInArrow(
        slots, "host string, mark long, page long, found array<struct<path:string,texts:array<long>>>")
    # one page of each group of copies
    once = rows.groupBy("host", "mark").agg(F.min_by("found", "page").alias("found")).select("host", F.explode("found").alias("f"))
    texts = once.select("host", F.col("f.path").alias("path"), F.explode("f.texts").alias("h"))
    texts = materialise(texts.groupBy("host", "path", "h").agg(F.count(F.lit(1)).alias("c")), "slot-texts")
    per_slot = texts.groupBy("host", "path").agg(F.sum(F.when(F.col("h") < 0, F.col("c"))).alias("n"),
                                                 F.sum(F.when(F.col("h") >= 0, F.col("c"))).alias("all"))
    again = texts.where((F.col("h") >= 0) & (F.col("c") >= REPEATED)).join(per_slot, ["host", "path"]).where(
        F.col("c") >= SHARE * F.col("n")).groupBy("host", "path").agg(F.sum("c").alias("again"), F.array_sort(F.collect_list("h")).alias("texts"))
    host = per_slot.where("path = ''").select("host", F.col("n").alias("pages"))
    constant = F.coalesce("again", F.lit(0)) >= CONSTANT * F.col("all")
    slot = F.struct("path", "constant", F.when(F.col("constant"), F.col("texts")).otherwise(F.array().cast("array<long>")).alias("texts"))
    held = per_slot.where("path <> ''").join(host, "host").join(again, ["host", "path"], "left").withColumn("constant", constant)
    # a place counts only if most pages with its path have it: the same place on every page
    base = F.substring_index("path", "#", 1)
    of_path = per_slot.where(~F.contains("path", F.lit("#"))).select("host", F.col("path").alias("_base"), F.col("n").alias("_n"))
    held = held.withColumn("_base", base).join(of_path, ["host", "_base"])
    is_path = F.col("path") == F.col("_base")
    return held.where(F.when(is_path, F.col("constant") | (F.col("n") >= SUPPORT * F.col("pages"))).otherwise(
        F.col("constant") & (F.col("n") >= CONSTANT * F.col("_n")))).groupBy("host").agg(F.array_sort(F.collect_list(slot)).alias("slots"))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    own = pages.select("page_id", "url", F.col(html).alias("html"), _host().alias("_host"))
    slots = materialise(wrappers(pages, html), "wrappers")
    joined = own.join(slots, F.col("_host") == F.col("host"), "left").select("page_id", "url", "html", "host", "slots")

    def texts(batches):
        known: dict = {None: None}  # the wrappers of the hosts met last
        for block in text_blocks(batches, "html", 1 << 22):
            out = []
            slots = block.column("slots")
            for i, (page, host) in enumerate(zip(block.column("html").to_pylist(), block.column("host").to_pylist())):
                if host not in known:
                    if len(known) > 256:
                        known = {None: None}
                    known[host] = Wrapper(slots[i].as_py())
                out.append(main_text(blocks(parse(page or "")), known[host]))
            yield pa.RecordBatch.from_arrays(
                [block.column("page_id"), block.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(texts, "page_id long, url string, text string, n_chars long")
