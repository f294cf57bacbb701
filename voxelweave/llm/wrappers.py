"""Main text of web pages by union-free wrappers inferred per host.

A page is a stream of tags and texts, nested by its elements. A wrapper is such a stream in which elements can be optional or
repeated, neighbours can form a repeated group, and texts are constants or slots. Two streams of one host are aligned element by
element: equal labels meet, what only one side has becomes optional, runs of one label and repeating neighbours fold
into repeated groups, and texts that differ become slots. Alignment takes wrappers as well as pages, so tasks first align
their own pages of a host, then these results are aligned in groups, then per host: every page takes part, and a host
with a third of all pages is spread over all tasks.

Elements that hold menus, headers, footers, adverts and the like are known by tag, role or class; the mark is part of an element's
label, so a hidden paragraph never meets a plain one. The main part of a wrapper is its article (or main) element with most
text, else the smallest element with nearly all unlinked text. Each page is then matched with its host's wrapper, and the texts
in the main part are given out block by block. Constants go, slots stay: a text that is the same, compared whole, on ``SHARE`` of a
host's pages (``PAGES`` or more) is part of the frame wherever it stands, unless a page has nothing else. A page that has nothing in the
main part (another template of the host) is matched with its own wrapper.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.common import written

# Names of HTML elements and roles, and class words in common use (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
RAW = set("script style textarea title select".split())
NOISE_TAGS = set("head nav header footer aside form button dialog menu".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement adsbygoogle sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer comment comments disqus reply replies respond notice notices "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended widget toolbar pagination pager skip alert copyright".split()
)
#: Words that only name a place or a shape, beside a noise word in a class inside the article.
PLACE_WORDS = set(
    "area bar block box btn button buttons container content group inline inner item items left link links list outer page pages panel "
    "post posts right row section site slot top bottom unit wrap wrapper".split()
)
PLAIN_TAGS = ("html", "body", "article", "main")  # never noise by class
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
GROUP = 16  # parts of a host's wrapper aligned in one go
DEEPEST = 150  # elements below have no wrapper nodes of their own: they go by name, block by block
SHARE, PAGES = 0.9, 8

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw.strip("/ \n\t\r") else {}


def _noisy(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether an element is noise by tag, role, style or class.

    Outside the article one noise word in a class or id is enough. Inside, all words of a name must be noise words or name a place,
    as "related-work" and "share-price" are subjects, "related-posts" and "share-buttons" are not.
    """
    if tag in NOISE_TAGS:
        return True
    if attributes.get("role", "").lower() in NOISE_ROLES or "hidden" in attributes:
        return True
    if attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in _WORDS.findall(name)]
        known = [w in NOISE_WORDS for w in words]
        if any(known) and (not inside or (all(k or w in PLACE_WORDS for k, w in zip(known, words)) and words != ["skip", "list"])):
            return True
    return False


class Element:
    """An element of a page: its label, whether it is noise by name, and its children (elements, texts, breaks)."""

    __slots__ = ("tag", "label", "noise", "children")

    def __init__(self, tag: str, label: str, noise: bool):
        self.tag, self.label, self.noise, self.children = tag, label, noise, []


def parse(page: str) -> Element:
    """Nested elements of a page; children are elements or ``(text, linked)``; ``None`` marks a line break.

    Inline elements leave no trace but links, unless they are noise by name. Missing end tags are implied by what follows.
    """
    root = Element("#page", "#page", False)
    stack, linked, at, size = [root], False, 0, len(page)
    opened: Counter[str] = Counter()

    def leave() -> Element:
        element = stack.pop()
        opened[element.tag] -= 1
        return element

    def text(until: int) -> None:
        if until > at and (piece := page[at:until]):
            stack[-1].children.append((entities.unescape(piece), linked))

    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            text(size)
            break
        text(m.start())
        at = m.end()
        close, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            linked = not close
        if close:
            if opened[tag]:
                while leave().tag != tag:
                    pass
                if tag not in INLINE:
                    linked = False
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if end or tag in ("script", "style"):
                at = end.end() if end else size
            continue
        attributes = _attributes(raw)
        if tag in VOID:
            if tag in ("br", "hr"):
                stack[-1].children.append(None)
            continue
        noise = _noisy(tag, attributes, bool(opened["article"] or opened["main"]))
        if tag in INLINE and not noise:
            continue
        if tag not in INLINE:
            linked = False
            while stack[-1].tag == "p" or stack[-1].tag in INLINE or stack[-1].tag in CLOSES.get(tag, ()):
                leave()
            if tag == "body" and stack[-1].tag == "head":
                leave()
        name = re.sub(r"\d+", "", (attributes.get("class", "") or attributes.get("id", "")).strip().lower())
        # Classes of these name the page's topic or template, of which a host has many.
        name += "!" * (noise and tag not in PLAIN_TAGS)
        element = Element(tag, f"{tag}.{name}" if name and tag not in ("html", "body", "main") else tag, noise)
        stack[-1].children.append(element)
        stack.append(element)
        opened[tag] += 1
    return root


# A wrapper node is a list: [label, optional, repeated, noise, children] for an element, ["(", optional, True, False,
# children] for a repeated group, ["#", optional, repeated, constant or None, [characters, linked characters]] for text.


def wrapper_of(element: Element, depth: int = 0) -> list:
    children = []
    for child in element.children if depth < DEEPEST else _below(element):
        if child is None:
            continue
        if isinstance(child, Element):
            children.append(wrapper_of(child, depth + 1))
        else:
            words = " ".join(child[0].split())
            if words:
                children.append(["#", False, False, _digest(words), [len(words), len(words) * child[1]]])
    return [element.label, False, False, element.noise, fold(children)]


def _below(element: Element) -> Iterator[tuple[str, bool] | None]:
    """All texts below an element that are not noise, in order."""
    todo = [iter(element.children)]
    while todo:
        child = next(todo[-1], element)
        if child is element:
            todo.pop()
        elif isinstance(child, Element):
            if not child.noise:
                todo.append(iter(child.children))
        else:
            yield child


def _digest(words: str) -> int:
    return xxhash.xxh3_64_intdigest(words.encode()) - (1 << 63)


def blocks_of(page: Element) -> set[int]:
    """Digests of the blocks of a page, noise included."""
    return {_digest(words) for words, _ in _blocks(page, None)}


def _shape(node: list) -> str:
    return node[0] if node[0] != "(" else "(" + " ".join(_shape(c) for c in node[4])


def fold(nodes: list) -> list:
    """Fold repeating neighbours: runs of one label, then of groups of two to four labels."""
    for period in (1, 2, 3, 4):
        out, at = [], 0
        while at < len(nodes):
            group = nodes[at : at + period]
            shape = [_shape(n) for n in group]
            end = at + period
            if len(group) == period and (period == 1 or len(set(shape)) > 1):
                merged = group
                while [_shape(n) for n in nodes[end : end + period]] == shape:
                    merged = [merge(a, b) for a, b in zip(merged, nodes[end : end + period])]
                    end += period
                if end > at + period:
                    if period == 1:
                        merged[0][2] = True
                        out.append(merged[0])
                    else:
                        out.append(["(", False, True, False, merged])
                    at = end
                    continue
            out.append(nodes[at])
            at += 1
        nodes = out
    return nodes


def merge(a: list, b: list) -> list:
    """Align two nodes of one shape."""
    flags = [a[0], a[1] or b[1], a[2] or b[2]]
    if a[0] == "#":
        return [*flags, a[3] if a[3] == b[3] else None, [x + y for x, y in zip(a[4], b[4])]]
    return [*flags, a[3] or b[3], fold(align(a[4], b[4]))]


def align(a: list, b: list) -> list:
    """Align two child sequences: a longest common subsequence of shapes meets, the rest becomes optional."""
    sa, sb = [_shape(n) for n in a], [_shape(n) for n in b]
    if sa == sb:
        return [merge(x, y) for x, y in zip(a, b)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if sa[i] == sb[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and sa[i] == sb[j]:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], True, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], True, *b[j][2:]])
            j += 1
    return out


def _amounts(node: list) -> int:
    """Unlinked characters of a node's texts; links count against."""
    if node[0] == "#":
        return node[4][0] - 3 * node[4][1]
    return sum(_amounts(c) for c in node[4])


def _has_main(node: list) -> bool:
    return node[0] != "#" and (node[0].split(".")[0] in ("article", "main") or any(_has_main(c) for c in node[4]))


def _is_noise(node: list) -> bool:
    """Noise by name, unless it wraps the article itself."""
    tag = node[0].split(".")[0]
    return bool(node[0] not in ("#", "(") and node[3] and tag not in PLAIN_TAGS and not _has_main(node))


def mark_main(wrapper: list) -> list:
    """The wrapper as ``[label, state, children]`` with state 2 for the main element, 1 inside noise, else 0."""
    found: list[tuple[int, int, list]] = []

    def look(node: list, inside: bool) -> None:
        if node[0] == "#" or _is_noise(node):
            return
        main = node[0].split(".")[0] in ("article", "main")
        if main and not inside:
            found.append((1 if node[0].startswith("article") else 0, _amounts(node), node))
        for child in node[4]:
            # An article inside main is looked at too; an article inside an article is not.
            look(child, inside or node[0].startswith("article"))

    def clean(node: list) -> int:
        if node[0] == "#":
            return node[4][0] - 3 * node[4][1]
        return 0 if _is_noise(node) else sum(max(0, clean(c)) for c in node[4])

    look(wrapper, False)
    if found:
        best = max(found, key=lambda f: (f[0], f[1]))[2]
    else:
        best, total = wrapper, clean(wrapper)
        while True:
            inner = [c for c in best[4] if c[0] != "#" and not _is_noise(c) and clean(c) >= 0.9 * total]
            if not inner or total <= 0:
                break
            best = inner[0]

    def marked(node: list) -> list:
        state = 2 if node is best else 1 if _is_noise(node) else 0
        return [node[0], state, [marked(c) for c in node[4] if c[0] != "#"]]

    return marked(wrapper)


def _flat(children: list) -> list:
    """Child elements of a marked node with groups opened."""
    out = []
    for c in children:
        out += _flat(c[2]) if c[0] == "(" else [c]
    return out


def extract(page: Element, wrapper: list, frame: frozenset[int] = frozenset()) -> str:
    """Texts of the page's main part: one line per block, without the host's constant texts ``frame``.

    A page that has nothing in the main part of its host's wrapper follows another template: its own wrapper counts. A page all of
    whose blocks are constant (copies of one page) keeps them.
    """
    blocks = list(_blocks(page, wrapper)) or list(_blocks(page, mark_main(wrapper_of(page))))
    kept = [words for words, _ in blocks if _digest(words) not in frame] if frame else []
    return "\n".join(kept or [words for words, _ in blocks])


def _blocks(page: Element, wrapper: list | None) -> Iterator[tuple[str, None]]:
    """Blocks of the main part of ``wrapper`` (without one: of the whole page, noise included), in page order."""
    current: list[str] = []

    def flushed() -> Iterator[tuple[str, None]]:
        words = " ".join("".join(current).split())
        current.clear()
        if words:
            yield words, None

    # What is open: the element, its children left, the wrapper's elements expected, the next of them, whether in the main part.
    todo = [[page, iter(page.children), _flat(wrapper[2]) if wrapper else [], 0, not wrapper or wrapper[1] == 2]]
    while todo:
        element, children, expected, at, main = top = todo[-1]
        child = next(children, element)
        if child is element:
            todo.pop()
            if element.tag not in INLINE:
                yield from flushed()
        elif child is None:
            yield from flushed()
        elif isinstance(child, Element):
            # The wrapper's next element of this label, going round for repeats.
            order = [*range(at, len(expected)), *range(at)]
            hit = next((i for i in order if expected[i][0] == child.label), None)
            found = expected[hit] if hit is not None else None
            top[3] = hit if hit is not None else at
            if wrapper and (found[1] == 1 if found else child.noise):
                continue
            if child.tag not in INLINE:
                yield from flushed()
            inner = main or bool(found and found[1] == 2)
            todo.append([child, iter(child.children), _flat(found[2]) if found else [], 0, inner])
        elif main:
            current.append(child[0])
    yield from flushed()


def _infer_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host over the pages of a task, its pages, and on how many of them each block is."""
    found: dict[str, list] = {}
    pages: Counter[str] = Counter()
    blocks: dict[str, Counter[int]] = {}
    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            parsed = parse(page.as_py())
            new = wrapper_of(parsed)
            found[host] = merge(found[host], new) if host in found else new
            pages[host] += 1
            blocks.setdefault(host, Counter()).update(blocks_of(parsed))
    if found:
        counts = [[{"block": b, "pages": n} for b, n in blocks[host].items()] for host in found]
        kind = pa.list_(pa.struct([("block", pa.int64()), ("pages", pa.int64())]))
        arrays = [pa.array(list(found)), pa.array([json.dumps(w) for w in found.values()]), pa.array([pages[h] for h in found])]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, kind)], names=["host", "wrapper", "pages", "blocks"])


def _merge_group(final: bool):
    def group(rows: pa.Table) -> pa.Table:
        merged = None
        for text in sorted(rows["wrapper"].to_pylist()):
            new = json.loads(text)
            merged = merge(merged, new) if merged else new
        out = json.dumps(mark_main(merged) if final else merged)
        return pa.table({"host": [rows["host"][0].as_py()], "wrapper": [out]})

    return group


def _extract_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list] = {}
    for batch in batches:
        texts = []
        for page, wrapper, frame in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            if wrapper not in known:
                if len(known) > 10_000:
                    known.clear()
                known[wrapper] = json.loads(wrapper)
            texts.append(extract(parse(page.as_py()), known[wrapper], frozenset(frame or ())))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper, frame)`` from ``pages (host, html)``: the wrapper with its main part marked, and the digests of the
    blocks that ``SHARE`` of the host's pages have (null for hosts below ``PAGES`` pages or without such blocks).

    Empty pages give a wrapper without elements; repeated pages count as often as they occur; no pages give no rows.
    """
    kind = "host string, wrapper string, pages long, blocks array<struct<block: long, pages: long>>"
    inferred = written(pages.select("host", "html").mapInArrow(_infer_task, kind), "wrapper-parts")
    totals = inferred.groupBy("host").agg(F.sum("pages").alias("total")).where(F.col("total") >= PAGES)
    each = inferred.select("host", F.explode("blocks").alias("b")).groupBy("host", "b.block").agg(F.sum("b.pages").alias("n"))
    constant = each.join(totals, "host").where(F.col("n") >= SHARE * F.col("total"))
    # At most the blocks of a page over SHARE: bounded by a page, not by the host.
    frames = written(constant.groupBy("host").agg(F.collect_list("block").alias("frame")), "frames")
    return _merged(inferred.select("host", "wrapper")).join(frames, "host", "left")


def _merged(parts: DataFrame) -> DataFrame:
    schema = "host string, wrapper string"
    while True:  # a tree: about GROUP parts of a host meet at a time
        counts = parts.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups"))
        if (counts.agg(F.max("groups")).first()[0] or 1) == 1:
            return parts.groupBy("host").applyInArrow(_merge_group(True), schema)
        salted = parts.join(counts, "host").withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.col("groups")))
        some = salted.select("host", "salt", "wrapper").groupBy("host", "salt").applyInArrow(_merge_group(False), schema)
        parts = written(some, "wrapper-parts")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars``.

    ``text`` is the article's blocks in page order, one per line, without the host's constant texts, character references decoded, white space inside a block made one
    space; a line break ends a block. A null or empty page, or one without main text, gives an empty text. Pages without
    a host in their url share one wrapper. Null ids stay null; repeated rows repeat; an empty table gives an empty result; other
    columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        host.alias("host"),
    )
    wrappers = written(host_wrappers(rows), "wrappers")
    # One short row per host: sent to all tasks where Spark finds the table small, else joined by shuffle.
    joined = rows.join(wrappers, "host").select("page_id", "url", "html", "wrapper", "frame")
    return joined.mapInArrow(_extract_task, "page_id long, url string, text string, n_chars long")
