"""Main-text extraction with wrappers inferred per template of a host.

The templates of a host are told apart by the containers of its pages outside
furniture (:func:`signature`).  All distinct pages of a template are aligned,
pair by pair, into a wrapper: a union-free regular expression over the token stream, nested by element.
Aligning starts with one page; texts that differ become slots, tokens that one
side lacks become optional, and repeated neighbours become repeated groups.
The wrapper shows where the template keeps its article: a marked element
(``article``, ``main`` ...) or else the deepest element that holds most of the
text outside furniture.  Every page is then read against its template's
wrapper; a page without that place, or with less than ``LITTLE`` there of the
text that it gives as its own wrapper, is its own wrapper.

Furniture is told by element (``nav``, ``footer``, ``form`` ...) or by a word
of its class, id or role (``menu``, ``sidebar``, ``comments`` ...), and, where
nothing marks the article, by the expression: its literals - short texts that
all of at least ``MIN_PAGES`` distinct pages have at the same place, menus of
repeated neighbours included - are the template's; slots are the page's.  In a
marked article texts that are equal on all pages stay.

Blocks are the block-level elements; white space inside a block (``br``
included) becomes one space; character references are decoded.

Pages travel as skeletons without long texts, and equal ones are dropped
before the shuffle; at most about ``FAN`` of a template meet in a group, level
by level, so a hot host is many groups; wrappers are joined to pages by host
and template (an equi-join whose skewed side adaptive execution splits, or a broadcast
where the stored wrapper table is within Spark's own limit).

Defined cases: null or empty html gives an empty text; a null or odd url is a
host of its own (the empty host); repeated rows are each extracted; broken
markup is read leniently (unclosed tags, comments and quotes); other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import difflib
import hashlib
import html as _html
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.util import by_value, stage

#: Pages or partial wrappers of a template that are aligned in one group.
FAN = 64
#: Share of a page's own text below which the wrapper has not found its article.
LITTLE = 0.25
#: Longer texts are slots from the start.
MAX_LITERAL = 40
#: Literals of repeated neighbours that are kept (a menu's entries); more are a slot.
MENU = 32
#: Distinct pages of a template from which its literals are the template's own
#: text: fewer may share a text by chance.
MIN_PAGES = 8
#: Elements below this depth are read as part of their ancestor.
MAX_DEPTH = 64
#: Children of one element that are aligned (after folding); beyond them, runs
#: of children that cannot hold the article are slots.
MAX_CHILDREN = 400

# A tag whose quotes are closed before the next "<"; possessive, so one pass.
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>""")
_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Fixed word lists.
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in
        "script style textarea title noscript template iframe svg select button".split()}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
section summary table tbody td tfoot th thead tr ul""".split())
_CLOSES_P = _BLOCK - set("td th tr tbody thead tfoot caption html body option optgroup legend".split())
_FURNITURE = set("nav header footer aside form menu dialog head".split())
_FURNITURE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|banner|nav(?:bar|igation)?|menu|breadcrumbs?|"
    r"sidebar|side-bar|rail|header|masthead|footer|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|signup|"
    r"login|search|share|sharing|social|related|recommended|comments?|commentlist|replies|respond|disqus|pagination|pager|"
    r"skip|toolbar|widget)(?:$|[\s_-])", re.I)
_MARKED = re.compile(r"(?:^|[\s_-])(?:article-?body|post-?body|entry-?content|article-?content|post-?content|main-?content|"
                     r"story-?body|content-?body)(?:$|[\s_-])", re.I)
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
_CONTAINERS = set("html body main article section div".split())
_SCOPE = set("table ul ol dl div article section main body html td th".split())


def tokens(page: str) -> Iterator[tuple[int, int, str, bool, int, int]]:
    """Markup of a page: ``(start, stop, tag, is end tag, attributes from, to)``,
    the tag empty for comments, declarations and raw elements (which are taken
    whole).  Any text is scanned in linear time: what a tag looks at ends at the
    next ``<``, and the next ``>`` is looked for once.

    A ``>`` within quotes does not end a tag, if they are closed before the next
    ``<``; a tag without any ``>`` after it takes the rest."""
    n = len(page)
    gt = -1  # the next ">" at or after what was scanned

    def closing(at: int) -> int:
        nonlocal gt
        if gt < at and gt != n:
            gt = page.find(">", at)
            gt = n if gt < 0 else gt
        return gt

    at = page.find("<")
    while 0 <= at < n - 1:
        m = _TAG.match(page, at)
        end = bool(m and m[1]) or page[at + 1] == "/"
        tag = ""
        inside = (0, 0)
        if m:
            tag, stop, inside = m[2].lower(), m.end(), m.span(3)
        elif page[at + 1] in "!?":
            if page.startswith("<!--", at):
                stop = page.find("-->", at + 4)
                stop = n if stop < 0 else stop + 3
            else:
                stop = min(n, closing(at) + 1)
        elif m := _NAME.match(page, at + 1 + end):
            stop = closing(m.end()) + 1
            if stop <= n:
                tag, inside = m[0].lower(), (m.end(), stop - 1)
            stop = min(n, stop)
        elif end:
            stop = min(n, closing(at) + 1)
        else:  # a "<" of the text
            at = page.find("<", at + 1)
            continue
        if tag in _RAW and not end:
            over = _RAW[tag].search(page, stop)
            stop, tag = over.end() if over else n, ""
        yield at, stop, tag, end, *inside
        at = page.find("<", stop)


def events(page: str) -> Iterator[tuple]:
    """``("open", tag, signature, kind)``, ``("close", tag)``, ``("text", s)``
    of a page, with implied end tags; kind: 1 furniture, 2 marked article.

    The places of each open tag, of open blocks and of scopes are kept, so that
    no question about the open elements goes through all of them."""
    stack: list[str] = []
    places: dict[str, list[int]] = defaultdict(list)
    blocks: list[int] = []
    scopes: list[int] = []
    at = 0

    def close(to: int):
        while len(stack) > to:
            t = stack.pop()
            places[t].pop()
            if t in _BLOCK:
                blocks.pop()
            if t in _SCOPE:
                scopes.pop()
            yield "close", t

    for start, stop, tag, end, attrs_from, attrs_to in tokens(page):
        if start > at:
            yield "text", _html.unescape(page[at:start])
        at = stop
        if not tag:
            continue
        if end:
            k = places[tag]
            # an inline end tag does not close blocks around what follows
            if k and (tag in _BLOCK or not (blocks and blocks[-1] > k[-1])):
                yield from close(k[-1])
            continue
        if tag in _CLOSES_P:
            k = places["p"]
            if k and not (scopes and scopes[-1] > k[-1]):
                yield from close(k[-1])
        if tag in _SIBLINGS:
            k = max((places[t][-1] for t in _SIBLINGS[tag] if places[t]), default=-1)
            if k >= 0 and not (scopes and scopes[-1] > k):
                yield from close(k)
        kind, sign, single = _element(tag, page[attrs_from:attrs_to])
        yield "open", tag, sign, kind
        if single:
            yield "close", tag
        else:
            places[tag].append(len(stack))
            if tag in _BLOCK:
                blocks.append(len(stack))
            if tag in _SCOPE:
                scopes.append(len(stack))
            stack.append(tag)
    if at < len(page):
        yield "text", _html.unescape(page[at:])
    yield from close(0)


@lru_cache(maxsize=50_000)
def _element(tag: str, attrs: str) -> tuple[int, str, bool]:
    """Kind, signature, and whether the element has no content."""
    names = " ".join(a or b or c for _, a, b, c in _ATTR.findall(attrs)) if attrs else ""
    kind = 1 if tag in _FURNITURE or names and _FURNITURE_WORDS.search(names) else \
        2 if tag in ("article", "main") or names and _MARKED.search(names) else 0
    if tag in ("html", "body"):
        kind = 0
    sign = tag + ("." + re.sub(r"\d+", "9", names.split()[0]) if names.split() else "")
    return kind, sign, tag in _VOID or attrs.endswith("/") and tag not in _BLOCK


# -- wrappers: items [signature, quantifier, kind, children | None, literal | None, characters] -------

def page_items(page: str) -> list:
    """A page as nested items, repeated neighbours folded."""
    top: list = []
    stack = [top]
    depth = 0
    for e in events(page):
        if e[0] == "open":
            depth += 1
            if depth <= MAX_DEPTH:
                item = [e[2], "", e[3], [], None, 0]
                stack[-1].append(item)
                stack.append(item[3])
        elif e[0] == "close":
            if depth <= MAX_DEPTH:
                stack[-1][:] = fold(stack[-1])
                stack.pop()
            depth -= 1
        else:
            s = " ".join(e[1].split())
            if s:
                stack[-1].append(["#text", "", 0, None, [s] if len(s) <= MAX_LITERAL else None, len(s)])
    return fold(top)


def fold(items: list) -> list:
    """Repeated neighbours as one repeated group."""
    for n in (1, 2, 3):
        out: list = []
        k = 0
        while k < len(items):
            head = items[k:k + n]
            signs = [x[0] for x in head]
            if n == 1 and signs[0] == "#text":
                out += head
                k += 1
                continue
            more = k + n
            while len(head) == n and [x[0] for x in items[more:more + n]] == signs:
                head = [merge_item(a, b, True) for a, b in zip(head, items[more:more + n])]
                more += n
            if more == k + n:
                out.append(items[k])
                k += 1
            else:
                for x in head:
                    x[1] = "*" if x[1] in ("?", "*") else "+"
                out += head if n == 1 else [["(" + " ".join(signs) + ")", "+", 0, head, None, 0]]
                k = more
        items = out
    return bounded(items)


def bounded(items: list) -> list:
    """Of too many children those that are marked, hold marked ones or hold
    most of the text; slots for the runs of others."""
    if len(items) <= MAX_CHILDREN:
        return items
    sizes = [_size(x) for x in items]
    total = sum(sizes)
    out: list = []
    run = False  # the last one is a slot of this list
    for x, size in zip(items, sizes):
        if x[3] is not None and (_holds_marked(x) or 2 * size > total):
            out.append(x)
            run = False
        elif run:
            out[-1][5] += size
        else:
            out.append(["#text", "*", 0, None, None, size])
            run = True
    return out


def _holds_marked(item: list) -> bool:
    return item[2] != 1 and (item[2] == 2 or any(_holds_marked(x) for x in item[3] or ()))


def _size(item: list) -> int:
    """Characters outside furniture."""
    return 0 if item[2] == 1 else item[5] if item[3] is None else sum(map(_size, item[3]))


def _quantifier(a: str, b: str) -> str:
    many = "+" in a + b or "*" in a + b
    none = "?" in a + b or "*" in a + b
    return "*" if many and none else "+" if many else "?" if none else ""


def merge_item(a: list, b: list, repeats: bool = False) -> list:
    """``repeats``: neighbours of one page, whose literals are collected; of
    two pages, literals that differ become a slot."""
    if a[3] is None or b[3] is None:
        literal = a[4] if a[4] == b[4] else None
        if repeats and a[4] and b[4] and literal is None:
            literal = sorted({*a[4], *b[4]})
            literal = literal if len(literal) <= MENU else None
        return [a[0], _quantifier(a[1], b[1]), a[2], None, literal, a[5] + b[5]]
    return [a[0], _quantifier(a[1], b[1]), max(a[2], b[2]), align(a[3], b[3], repeats), None, 0]


def align(a: list, b: list, repeats: bool = False) -> list:
    """Union-free alignment of two sequences: common items are merged, items
    of one side only are optional."""
    out: list = []
    left, right = [x[0] for x in a], [x[0] for x in b]
    if left == right:
        return [merge_item(x, y, repeats) for x, y in zip(a, b)]
    match = difflib.SequenceMatcher(None, left, right, autojunk=False)
    for op, i, j, k, m in match.get_opcodes():
        if op == "equal":
            out += [merge_item(x, y, repeats) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += [[x[0], _quantifier(x[1], "?"), *x[2:]] for x in a[i:j] + b[k:m]]
    return bounded(out)


def written(items: list) -> str:
    """The wrapper as an expression."""
    parts = []
    for x in items:
        body = ("#slot" if x[4] is None else " ".join(json.dumps(t, ensure_ascii=False) for t in x[4])) if x[3] is None else \
            f"<{x[0]}>{written(x[3])}</{x[0].split('.')[0]}>" if not x[0].startswith("(") else f"({written(x[3])})"
        parts.append(f"({body}){x[1]}" if x[1] and not body.startswith("(") else body + x[1])
    return " ".join(parts)


def article_path(items: list) -> list[str]:
    """Signatures down to the element that holds the article."""
    best: list[tuple] = []

    def marked(items: list, path: list):
        for x in items:
            if x[3] is None or x[2] == 1:
                continue
            here = path if x[0].startswith("(") else [*path, x[0]]
            if x[2] == 2:
                best.append((_text(x), here))
            else:
                marked(x[3], here)

    def _text(x: list) -> int:
        return 0 if x[2] == 1 else x[5] if x[3] is None else sum(_text(y) for y in x[3])

    marked(items, [])
    if best:
        return max(best, key=lambda b: (b[0], -len(b[1])))[1]
    path: list[str] = []
    while True:  # down while one child holds most of the text
        total = sum(_text(x) for x in items)
        inner = [x for x in items if x[3] is not None and x[2] != 1 and _text(x) > 0.7 * total
                 and not x[1] and x[0].split(".")[0] not in ("p", "li", "td", "span", "b", "i", "a")]
        if not inner:
            return path
        path.append(inner[0][0])
        items = inner[0][3]


def literals(items: list, path: list[str]) -> list[str]:
    """What every page says at the same place of the article: the literals of
    the expression below ``path`` that no optional part holds, each after the
    signatures down to it."""
    out: list[str] = []

    def walk(items: list, trail: tuple, left: list[str]):
        for x in items:
            if x[2] == 1 and not left or x[1] in ("?", "*"):
                continue
            if x[3] is None:
                if not left:
                    out.extend("\x1f".join([*trail, t]) for t in x[4] or ())
            elif x[0].startswith("("):
                walk(x[3], trail, left)
            elif not left:
                walk(x[3], (*trail, x[0]), left)
            elif x[0] == left[0]:
                walk(x[3], trail, left[1:])

    walk(items, (), path)
    return sorted(set(out))


def infer(pages: list[str]) -> tuple[str, list[str]]:
    """Wrapper expression and article path of pages of one template."""
    items = reduce(align, map(page_items, pages))
    return written(items), article_path(items)


def signature(items: list) -> str:
    """Template of a page: a digest of the paths of its containers, without
    furniture and without the inside of marked articles."""
    paths: set[str] = set()

    def walk(items: list, path: str):
        for x in items:
            if x[3] is None or x[2] == 1:
                continue
            if x[0].startswith("("):
                walk(x[3], path)
            elif x[0].split(".")[0] in _CONTAINERS or x[2] == 2:
                here = f"{path}/{x[0]}"
                paths.add(here)
                if x[2] != 2:
                    walk(x[3], here)

    walk(items, "")
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def read(page: str, path: list[str], fixed: frozenset | set = frozenset()) -> str | None:
    """Text blocks under ``path``, or None if the page has no such place.
    Blocks that hold nothing but ``fixed`` texts (:func:`literals`) belong to
    the template."""
    blocks: list[str] = []
    buffer: list[str] = []
    trail: list[str] = []  # signatures inside the article
    own = False  # the block holds a text of this page
    depth = matched = 0
    inside = drop = 0  # depth at which the article, or furniture in it, began
    found = not path
    if not path:
        inside = -1

    def flush():
        nonlocal own
        s = " ".join("".join(buffer).split())
        buffer.clear()
        if s and own:
            blocks.append(s)
        own = False

    for e in events(page):
        if e[0] == "open":
            depth += 1
            if inside:
                trail.append(e[2])
            if not inside and depth == matched + 1 and matched < len(path) and e[2] == path[matched]:
                matched += 1
                if matched == len(path):
                    inside, found = depth, True
            elif inside and not drop and e[3] == 1:
                flush()
                drop = depth
            if inside and not drop:
                if e[1] in _BLOCK:
                    flush()
                elif e[1] == "br":
                    buffer.append(" ")
        elif e[0] == "close":
            if inside and not drop and e[1] in _BLOCK:
                flush()
            if drop == depth:
                drop = 0
            if inside == depth:
                flush()
                inside = 0
            elif inside:
                trail.pop()
            depth -= 1
            matched = min(matched, depth)
        elif inside and not drop:
            buffer.append(e[1])
            if not own:
                s = " ".join(e[1].split())
                own = bool(s) and not (fixed and len(s) <= MAX_LITERAL and "\x1f".join([*trail, s]) in fixed)
    flush()
    return "\n".join(blocks) if found else None


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def marked_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(id, url, html, host, sign, own, items)``: what one parse of a page
    gives.  ``items`` is null where the task has sent the same page of that host
    before, and for empty pages."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                       host_of(F.col(url_col)).alias("host"), F.xxhash64(html_col).alias("h"))
    id_type = src.schema["id"].dataType.simpleString()
    kinds = [("sign", pa.string()), ("own", pa.list_(pa.string())), ("items", pa.string())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, rows = b.slice(at, 256), []
                for page, host, h in zip(*(part.column(k).to_pylist() for k in (2, 3, 4))):
                    items = page_items(page) if page else []
                    new = bool(page) and (host, h) not in seen
                    if len(seen) >= 100_000:
                        seen.clear()
                    seen.add((host, h))
                    rows.append((signature(items), article_path(items),
                                 json.dumps(items, ensure_ascii=False, separators=(",", ":")) if new else None))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], *(pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds))],
                    ["id", "url", "html", "host", *(n for n, _ in kinds)])

    return src.mapInArrow(run, f"id {id_type}, url string, html string, host string, sign string, own array<string>, items string")


def wrappers_of(skeletons: DataFrame, fan: int = FAN) -> DataFrame:
    """``(host, sign, wrapper, path, fixed)`` from all distinct pages ``(host,
    sign, items)`` of each template."""
    def merged(t) -> list:
        return reduce(align, map(json.loads, sorted(t["items"].to_pylist())))

    def some(key, t):
        items = json.dumps(merged(t), ensure_ascii=False, separators=(",", ":"))
        return pa.table({"host": [key[0].as_py()], "sign": [key[1].as_py()], "items": [items],
                         "n": pa.array([sum(t["n"].to_pylist())], pa.int64())})

    def whole(key, t):
        items = merged(t)
        path = article_path(items)
        # a marked article says itself what belongs to it
        known = sum(t["n"].to_pylist()) >= MIN_PAGES and not any(map(_holds_marked, items))
        fixed = literals(items, path) if known else []
        return pa.table({"host": [key[0].as_py()], "sign": [key[1].as_py()], "wrapper": [written(items)],
                         "path": pa.array([path], pa.list_(pa.string())), "fixed": pa.array([fixed], pa.list_(pa.string()))})

    level = stage(skeletons.where("items IS NOT NULL").select("host", "sign", "items").distinct()
                  .withColumn("n", F.lit(1).cast("bigint")), "skeletons")
    while (most := level.groupBy("host", "sign").count().agg(F.max("count")).first()[0] or 0) > fan:
        salt = F.pmod(F.xxhash64("items"), F.lit(-(-2 * most // fan)))  # half full on average; the same in any layout
        level = stage(level.groupBy("host", "sign", salt.alias("salt")).applyInArrow(
            some, "host string, sign string, items string, n bigint"), "skeletons")
    return level.groupBy("host", "sign").applyInArrow(
        whole, "host string, sign string, wrapper string, path array<string>, fixed array<string>")


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", fan: int = FAN) -> DataFrame:
    """``(host, sign, wrapper, path, fixed)`` from all distinct pages of each
    template: the expression, the path down to its article, and the literals
    below it."""
    return wrappers_of(marked_pages(pages, url_col, url_col, html_col), fan)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            fan: int = FAN) -> DataFrame:
    """``(id_col, url_col, text)``: the main text of every page."""
    marked = stage(marked_pages(pages, id_col, url_col, html_col), "marked")
    wrappers = stage(wrappers_of(marked, fan), "wrappers").select("host", "sign", "path", "fixed")
    id_type = marked.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = []
                for page, own, path, fixed in zip(*(part.column(k).to_pylist() for k in (2, 3, 4, 5))):
                    text = ""
                    if page:
                        fixed = frozenset(fixed or ())
                        text = read(page, path or own, fixed)
                        if path and path != own:
                            alone = read(page, own) or ""
                            text = text if text and len(text) >= LITTLE * len(alone) else alone
                    texts.append(text or "")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 ["id", "url", "text"])

    out = marked.join(wrappers, ["host", "sign"], "left").select("id", "url", "html", "own", "path", "fixed").mapInArrow(
        run, f"id {id_type}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")


by_value(__name__)
