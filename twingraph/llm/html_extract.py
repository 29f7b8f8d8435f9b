"""Main text of web pages by wrappers: union-free regular expressions per page class.

Pages of one host with the same frame of containers form a class. Each page is a
stream of tags and text slots. Repeated runs of the stream fold into ``( )+``
groups; streams are then aligned one after the other: what matches stays, what
only one of them has becomes optional, and texts that differ become slots, while
texts that are the same everywhere stay constant. The result is the wrapper of the
class. It says which container holds the varying running text (an article or main
element is only a hint for that), and which boxes inside it hold nothing but constant
text. Each page is aligned with the wrapper of its class, and what falls into
constant boxes is cut out of its text.

Tasks infer wrappers of their own pages, and the wrappers are aligned with each
other in two grouped steps; so a host with a third of all pages meets in one task
only as one small wrapper per earlier task.
"""

from __future__ import annotations

import html
import itertools
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, positive_partitions, small_batches

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?:svg|math)(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|title|button|object|canvas|math|audio|video|xmp)(?=[\s/>])"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME = re.compile(r"[a-z]+")

# The roles of HTML elements, and words that sites use in class and id names.
CONTAINERS = frozenset("html body div section article main nav header footer aside form table ul ol dl dialog menu "
                       "fieldset figure details center".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav header footer aside form dialog menu fieldset head".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "sidebar footer header masthead banner cookie cookies consent gdpr notice notices alert comment comments "
    "commentlist respond disqus reply replies share sharing social related recommended breadcrumb breadcrumbs pagination "
    "pager popup modal overlay newsletter subscribe subscription signup login widget widgets toolbar skip tagcloud "
    "complementary contentinfo search dialog".split())
MAIN_NAMES = frozenset("main article articlebody".split())


class Element:
    __slots__ = ("tag", "names", "drop", "main")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.names, hidden = tag, (), False
        found: dict[str, str] = {}
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                found.setdefault(m[1].lower(), (m[2] or "").strip("\"'").lower())
            hidden = "hidden" in found or found.get("aria-hidden") == "true"
            self.names = tuple(NAME.findall(" ".join(found.get(k, "") for k in ("class", "id", "role", "itemprop"))))
        self.main = tag in ("article", "main") or tag in CONTAINERS and any(n in MAIN_NAMES for n in self.names)
        named = bool(self.names) and tag in CONTAINERS and self.is_boilerplate(found)
        self.drop = hidden or tag in BOILERPLATE or (named and tag not in ("html", "body"))
        if self.main and named:
            self.main = False  # an advertisement or a comment marked up as an article
        elif self.main:
            self.drop = hidden

    def is_boilerplate(self, found: dict[str, str]) -> bool:
        """Whether names mark a container: any part of a class, an id only with all its parts (ids are anchors
        of headings as well), an article only by a whole class or role."""
        if self.tag in ("article", "main"):
            return any(n in BOILERPLATE_NAMES for k in ("class", "role") for n in found.get(k, "").split())
        anchor = NAME.findall(found.get("id", ""))
        return (bool(anchor) and all(n in BOILERPLATE_NAMES for n in anchor)
                or any(n in BOILERPLATE_NAMES for k in ("class", "role", "itemprop") for n in NAME.findall(found.get(k, ""))))

    @property
    def sign(self) -> str:
        return ".".join((self.tag, *self.names)) if self.names else self.tag


def page_stream(source: str | None) -> list[tuple]:
    """Tokens of a page: ``("open"|"close", sign)`` and ``("text", text, path, state, link, block)``.

    ``path`` names the open containers, ``state`` is 2 inside an article, 1 in the open,
    0 in what is dropped; texts with one ``block`` number stand in one block.
    """
    out: list[tuple] = []
    stack: list[tuple[Element, int]] = []
    state, block, links, path = 1, 0, 0, ""
    for m in TOKEN.finditer(source or ""):
        if m[5] is not None:
            out.append(("text", m[5], path, state, links > 0, block))
            continue
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag not in INLINE:
            block += 1
        if m[2]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0].tag == tag), None)
            if at is None or (tag not in CONTAINERS and any(e.tag in CONTAINERS for e, _ in stack[at + 1:])):
                continue
            out.append(("close", stack[at][0].sign))
            gone = stack[at:]
            state = gone[0][1]
            del stack[at:]
            links -= sum(e.tag == "a" for e, _ in gone)
            if any(e.tag in CONTAINERS for e, _ in gone):
                path = ">".join(e.sign for e, _ in stack if e.tag in CONTAINERS)
            continue
        e = Element(tag, m[4])
        out.append(("open", e.sign))
        if tag in VOID or m[4].endswith("/") and tag not in CONTAINERS:
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0].tag == tag:
            state = stack.pop()[1]  # an end tag that may be left out
        stack.append((e, state))
        if e.main and not (e.tag != "article" and e.tag != "main" and state == 2):
            state = 2 if state != 0 or e.tag in ("article", "main") else 0
        elif e.drop and not (tag == "header" and state == 2):
            state = 0
        links += tag == "a"
        if tag in CONTAINERS:
            path = f"{path}>{e.sign}" if path else e.sign
    return out


def frame(stream: list[tuple]) -> str:
    """The containers that a page opens, each once, in order: its page class within a host."""
    return " ".join(dict.fromkeys(t[1] for t in stream if t[0] == "open" and t[1].split(".")[0] in CONTAINERS))


# --- wrappers: lists of items. A tag is {"t": sign}; a text slot {"s": path, "h": hash or None,
# "n": pages, "c": characters, "l": characters in links, "d": in dropped parts, "m": inside an article};
# a repeated group {"r": items}. "o": True marks what not every page has, "k": True a slot to cut. Slots
# of a single page may carry "i": the positions of their texts in the stream.

LEAST_PAGES = 3            # pages that show a text before it can be template text,
LEAST_OPTIONAL_PAGES = 10  # and if it is not on every page of the class


def items_of(stream: list[tuple], positions: bool = False) -> list[dict]:
    out = []
    for at, t in enumerate(stream):
        if t[0] != "text":
            out.append({"t": ("/" if t[0] == "close" else "") + t[1]})
        elif t[1].strip():
            text = t[1].strip()
            out.append({"s": t[2], "h": zlib.crc32(text.encode("utf-8", "replace")), "n": 1, "c": len(text),
                        "l": len(text) if t[4] else 0, "d": t[3] == 0, "m": t[3] == 2})
            if positions:
                out[-1]["i"] = [at]
    return out


def sign(item: dict) -> str:
    if "t" in item:
        return f"<{item['t']}>"
    if "s" in item:
        return "#"
    return "(" + "".join(map(sign, item["r"])) + ")+"


def both(a: dict, b: dict, same_page: bool) -> dict:
    """Two matching items as one."""
    if "t" in a:
        out = {"t": a["t"]}
    elif "s" in a:
        if same_page:  # the texts of a repeated slot are constant together
            h = None if a["h"] is None or b["h"] is None else a["h"] + b["h"] & 0xFFFFFFFF
        else:
            h = a["h"] if a["h"] == b["h"] else None
        out = {"s": a["s"], "h": h, "n": max(a["n"], b["n"]) if same_page else a["n"] + b["n"],
               "c": a["c"] + b["c"], "l": a["l"] + b["l"], "d": a["d"] and b["d"], "m": a["m"] and b["m"]}
        if "i" in a and "i" in b:
            out["i"] = a["i"] + b["i"]
    else:
        out = {"r": align(a["r"], b["r"], same_page)}
    if a.get("o") or b.get("o"):
        out["o"] = True
    return out


def fold_repeats(items: list[dict], longest: int = 8) -> list[dict]:
    """Runs of equal neighbouring blocks become groups, shorter blocks first, until none is left."""
    changed = True
    while changed:
        changed = False
        for period in range(1, longest + 1):
            signs = [sign(i) for i in items]
            out, at = [], 0
            while at < len(items):
                block = signs[at:at + period]
                if len(block) == period and (period > 1 or "r" not in items[at]) and signs[at + period:at + 2 * period] == block:
                    body, at = items[at:at + period], at + period
                    while signs[at:at + period] == block:
                        body = [both(x, y, True) for x, y in zip(body, items[at:at + period])]
                        at += period
                    out.append({"r": body})
                    changed = True
                elif period == 1 and "r" in items[at] and signs[at + 1:at + 2] == block:
                    items[at + 1] = both(items[at], items[at + 1], True)
                    at += 1
                    changed = True
                else:
                    out.append(items[at])
                    at += 1
            items = out
    return items


def wrap_known(items: list[dict], other: list[dict]) -> list[dict]:
    """A single block that the other stream repeats counts as a group of one."""
    for g in other:
        if "r" not in g:
            continue
        body = [sign(i) for i in g["r"]]
        out, at = [], 0
        while at < len(items):
            if [sign(i) for i in items[at:at + len(body)]] == body:
                out.append({"r": items[at:at + len(body)]})
                at += len(body)
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def _matches(a: dict, b: dict) -> bool:
    if "t" in a:
        return a["t"] == b.get("t")
    if "s" in a:
        return "s" in b
    return "r" in b and sign(a["r"][0]) == sign(b["r"][0])


def align(a: list[dict], b: list[dict], same_page: bool = False) -> list[dict]:
    """One union-free expression for two: a longest common subsequence stays, the rest is optional."""
    if [sign(i) for i in a] == [sign(i) for i in b]:
        return [both(x, y, same_page) for x, y in zip(a, b)]
    a, b = wrap_known(a, b), wrap_known(b, a)
    whole = []
    for x, y in _pairs(a, b):
        whole.append(both(x, y, same_page) if x and y else (x or y) | {"o": True})
    return fold_repeats(whole)


def _pairs(a: list[dict], b: list[dict]) -> Iterator[tuple[dict | None, dict | None]]:
    """Items of a longest common subsequence in pairs, all others with None on the other side, in order."""
    head = 0
    while head < min(len(a), len(b)) and _matches(a[head], b[head]):
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and _matches(a[-1 - tail], b[-1 - tail]):
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if _matches(x[i], y[j]) else max(best[i + 1][j], best[i][j + 1])
    yield from zip(a[:head], b[:head])
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and _matches(x[i], y[j]):
            yield x[i], y[j]
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and best[i + 1][j] >= best[i][j + 1]:
            yield x[i], None
            i += 1
        else:
            yield None, y[j]
            j += 1
    yield from zip(a[len(a) - tail:], b[len(b) - tail:])


def template_texts(wrapper: list[dict], page: list[dict]) -> Iterator[int]:
    """Stream positions of the texts of a page (folded, with positions) that stand in slots to cut."""
    if [sign(i) for i in wrapper] != [sign(i) for i in page]:
        wrapper, page = wrap_known(wrapper, page), wrap_known(page, wrapper)
    for w, p in _pairs(wrapper, page):
        if w and p:
            if "r" in w:
                yield from template_texts(w["r"], p["r"])
            elif w.get("k") and w["h"] == p["h"]:
                yield from p["i"]


def expression(wrapper: list[dict]) -> str:
    """The wrapper as text: tags, ``#`` for slots, ``( )+`` for repeats and ``?`` after what is optional."""
    return "".join((f"({expression(i['r'])})+" if "r" in i else sign(i)) + ("?" if i.get("o") else "") for i in wrapper)


def _slots(wrapper: list[dict]) -> Iterator[dict]:
    for i in wrapper:
        if "r" in i:
            yield from _slots(i["r"])
        elif "s" in i:
            yield i


def _varies(slot: dict) -> bool:
    return slot["h"] is None or slot["n"] == 1


def main_container(wrapper: list[dict]) -> str:
    """Path of the container with the most running text in slots that vary (or stand on one page only).

    Text in links counts against a container, and a container's own slots come before
    those of containers inside it unless those hold less than half of the text.
    """
    own: dict[str, int] = {}
    for s in _slots(wrapper):
        if not s["d"] and _varies(s):
            own[s["s"]] = own.get(s["s"], 0) + s["c"] - 2 * s["l"]
    if not own:
        return ""
    total = {p: sum(v for q, v in own.items() if q == p or q.startswith(p + ">")) for p in
             {">".join(q.split(">")[:k]) for q in own for k in range(1, q.count(">") + 2)}}
    at = min(total, key=lambda p: (p.count(">"), -total[p], p))
    while True:
        inner = [p for p in total if p.startswith(at + ">") and p.count(">") == at.count(">") + 1]
        top = max(inner, key=lambda p: (total[p], p), default=None)
        if top is None or total[top] * 2 <= total[at]:
            return at
        at = top


def article_is_main(wrapper: list[dict]) -> bool:
    """Whether the hint of an article or main element holds: text varies in it, and running text outside is not four times as much."""
    varying = [s for s in _slots(wrapper) if not s["d"] and _varies(s)]
    if not varying:
        return any(s["m"] for s in _slots(wrapper))
    inside, outside = (sum(s["c"] - 2 * s["l"] for s in varying if s["m"] is m) for m in (True, False))
    return any(s["m"] for s in varying) and outside <= 4 * max(inside, 0)


def mark_template(wrapper: list[dict]) -> bool:
    """Mark the slots to cut ("k") and tell whether there are any.

    These are constant texts on enough pages whose innermost container holds no text that varies. A
    constant heading or phrase beside varying text belongs to it. Where nothing varies at all (one page,
    or copies of one) nothing is marked.
    """
    kept, slots, opened, boxes = set(), [], [(0, "")], itertools.count(1)
    pages = max((s["n"] for s in _slots(wrapper)), default=0)

    def walk(items: list[dict], optional: bool) -> None:
        for i in items:
            if "r" in i:
                walk(i["r"], optional or i.get("o", False))
            elif "t" in i and i["t"].lstrip("/").split(".")[0] in CONTAINERS:
                if not i["t"].startswith("/"):
                    opened.append((next(boxes), i["t"]))
                elif at := next((k for k in range(len(opened) - 1, 0, -1) if opened[k][1] == i["t"][1:]), 0):
                    del opened[at:]
            elif "s" in i and not i["d"]:
                least = LEAST_OPTIONAL_PAGES if optional or i.get("o") else LEAST_PAGES
                constant = i["h"] is not None and i["n"] >= least and 2 * i["n"] > pages
                if not constant:
                    kept.update(n for n, _ in opened)
                slots.append((i, constant, opened[-1][0]))

    walk(wrapper, False)
    if all(constant for _, constant, _ in slots):
        return False
    marked = [i for i, constant, box in slots if constant and box not in kept]
    for i in marked:
        i["k"] = True
    return bool(marked)


def extract(source: str | None, container: str, article: bool = True, wrapper: list[dict] | None = None) -> str:
    """The main text of one page, given the main container of its class, whether articles are the
    main region there, and the marked wrapper if it has slots to cut."""
    stream = page_stream(source)
    cut = set(template_texts(wrapper, fold_repeats(items_of(stream, True)))) if wrapper else ()
    inside = article and any(t[0] == "text" and t[3] == 2 and t[1].strip() for t in stream)
    blocks: dict[int, list[str]] = {}
    for at, t in enumerate(stream):
        if t[0] == "text" and at not in cut and (t[3] == 2 if inside else t[3] != 0 and (
                not container or t[2] == container or t[2].startswith(container + ">"))):
            blocks.setdefault(t[5], []).append(t[1])
    texts = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return " ".join(t for t in texts if t)


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _dump(wrapper: list[dict]) -> str:
    return json.dumps(wrapper, separators=(",", ":"))


def infer_wrappers(df: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``host, frame, wrapper (JSON), expression, container, article, template`` of every page class.

    ``article`` tells whether article and main elements are the main region, and ``template`` is the
    wrapper with its slots to cut marked (null if it has none).
    """
    spark = df.sparkSession
    n = positive_partitions(spark)
    pages = df.select(_host(df[url]).alias("host"), df[source].cast("string").alias("_html"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[str, list[dict]]] = {}
        size = 0
        for big in batches:
            for b in small_batches(big, "_html", 1 << 20):
                for host, text in zip(b.column("host").to_pylist(), b.column("_html").to_pylist()):
                    stream = page_stream(text)
                    items = fold_repeats(items_of(stream))
                    forms = held.setdefault((host, frame(stream)), {})
                    key = "".join(map(sign, items))
                    size += 0 if key in forms else 1
                    forms[key] = [both(x, y, False) for x, y in zip(forms[key], items)] if key in forms else items
                if size > 5_000:  # what is held is bounded; the rest of the work is the same later
                    yield emitted(held)
                    held, size = {}, 0
        yield emitted(held)

    def emitted(held) -> pa.RecordBatch:
        rows = []
        for (host, shape), forms in held.items():
            rows.append((host, shape, _dump(together(list(forms.values())))))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["host", "frame", "wrapper"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for b in batches:
            for host, shape, w in zip(*(b.column(c).to_pylist() for c in ("host", "frame", "wrapper"))):
                if now != (host, shape):
                    if now:
                        yield row(now, parts)
                    now, parts = (host, shape), []
                parts.append(json.loads(w))
                if len(parts) == 64:
                    parts = [together(parts)]
        if now:
            yield row(now, parts)

    def together(wrappers: list[list[dict]]) -> list[dict]:
        wrappers = sorted(wrappers, key=lambda w: (len(w), "".join(map(sign, w))))
        out = wrappers[0]
        for w in wrappers[1:]:
            out = align(out, w)
        return out

    def row(key: tuple[str, str], parts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (*key, _dump(together(parts)))],
                                          names=["host", "frame", "wrapper"])

    schema = "host string, frame string, wrapper string"
    part = pages.mapInArrow(local, schema)
    # Two steps: pieces of a class meet under a salt, then the few results under the class.
    part = part.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(n))).repartition(n, "host", "frame", "salt")
    part = part.sortWithinPartitions("host", "frame", "salt", "wrapper").select("host", "frame", "wrapper").mapInArrow(merged, schema)
    part = part.repartition(n, "host", "frame").sortWithinPartitions("host", "frame", "wrapper").mapInArrow(merged, schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parsed = [json.loads(w) for w in b.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(map(expression, parsed)), pa.string()),
                                              pa.array(list(map(main_container, parsed)), pa.string()),
                                              pa.array(list(map(article_is_main, parsed)), pa.bool_()),
                                              pa.array([_dump(w) if mark_template(w) else None for w in parsed], pa.string())],
                                             names=["host", "frame", "wrapper", "expression", "container", "article", "template"])

    return part.mapInArrow(finish, schema + ", expression string, container string, article boolean, template string")


def extract_pages(df: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``page_id, url, text`` of every row; a null or empty page has an empty text.

    Pages without a host form a class of their own. Repeated rows come out each;
    other columns are ignored; no rows give no rows.
    """
    wrappers, _ = materialise(infer_wrappers(df, url, source).select("host", "frame", "container", "article", "template"), "wrappers")
    pages = df.select(df[page_id].alias("page_id"), df[url].alias("url"), _host(df[url]).alias("host"),
                      df[source].cast("string").alias("_html"))
    with_frame = T.StructType([*pages.schema.fields, T.StructField("frame", T.StringType())])

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in small_batches(big, "_html", 1 << 20):
                shapes = [frame(page_stream(t)) for t in b.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shapes, pa.string())], names=with_frame.names)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str, list[dict]] = {}
        for big in batches:
            for b in small_batches(big, "_html", 1 << 20):
                out = []
                for t, c, m, w in zip(*(b.column(k).to_pylist() for k in ("_html", "container", "article", "template"))):
                    if w is not None and w not in parsed:
                        if len(parsed) == 256:
                            parsed.clear()
                        parsed[w] = json.loads(w)
                    out.append(extract(t, c or "", m is not False, parsed.get(w)))
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())],
                                                 names=["page_id", "url", "text"])

    joined = (pages.mapInArrow(framed, with_frame).join(wrappers, ["host", "frame"], "left")
              .select("page_id", "url", "_html", "container", "article", "template"))
    return joined.mapInArrow(texts, T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType(), False)]))
