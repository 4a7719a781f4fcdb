"""Main text of web pages through wrappers inferred per host.

A wrapper is a union-free regular expression over a host's token streams: tags,
text slots, optional groups ``( )?`` and repeated groups ``( )+``. It starts as the
first page's stream. Every further page is aligned with it, level by level: equal
tags match; neighbouring items of the same kind become a repeated group; a stretch
found on one side only becomes optional; differing texts at one place turn template
text into a slot. Tasks infer wrappers of their own pages and send one per host;
these are aligned with each other in the same way, so a host with a third of all
pages costs one small row per task. Wrappers that grow too large are generalised and
still aligned: optional siblings of one tag become one group, then all siblings of
one tag, whatever their class, long rows of them first, and at last what lies deepest
becomes a slot.

A wrapper tells template text (the same on all of three or more different pages)
from content, and the region of a host's pages: the element that holds most of the
varying, unlinked text. Article markup is a prior within it: the search for the
region goes into elements that contain an ``article`` or ``main`` element and ends at
one, and of a region that contains some only these count. A page's text is what lies
there without template text and without menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts and styles, which are known by tag, role and class.

Character references are decoded, white space inside a block becomes one space, and
blocks are joined by an empty line, in page order. Null, empty or text-less html
gives an empty text. Pages whose url has no host share one wrapper. Broken markup
is closed as browsers do: unclosed elements end with their parent. Repeated pages
are one page for inference and each a row of the result; urls and keys may be null.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import map_arrow, skew_join, stored

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>", re.S)
ATTR = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# HTML element names.
VOID = set("area base br col embed hr img input link meta source track wbr param".split())
RAW = set("script style textarea title noscript template iframe svg xmp noembed noframes".split())
BLOCK = set("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html", "head"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
OUT_TAGS = set("head nav footer aside form button select input label dialog menu object canvas audio video".split()) | RAW
OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words of class names and ids that mark page furniture.
OUT_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs "
                "footer masthead cookie cookies consent gdpr notice notices popup modal comment comments disqus reply replies respond share sharing social "
                "related recommended recommendations newsletter subscribe subscription signup login toolbar pagination pager teaser skip".split())
# What may stand beside them in one name: "cookie-banner" is furniture, "related-work" is not.
BESIDE_WORDS = set("top bottom left right main site page post article entry story content global primary secondary inner outer first last my the js is has "
                   "banner box bar slot unit list lists item items link links wrap wrapper container holder block area section region zone panel column col row "
                   "widget widgets button buttons icon icons form header title text label image img posts articles stories overlay bottombar tabs tab".split())
MAIN = "@main"          # marks the key of an element that is main by role or itemprop
WHOLE = {"html", "body", "main", "article"}
MAX_DEPTH = 150         # deeper elements are taken as part of their ancestor, as browsers do, and deeper furniture is left out
MAX_ITEMS = 4000        # of two wrappers that are aligned; larger ones are generalised first
ANY = ".*"              # in a key: elements of this tag, whatever their class


class Element:
    __slots__ = ("tag", "key", "kids", "out", "main")

    def __init__(self, tag, key, out=False, main=False):
        self.tag, self.key, self.kids, self.out, self.main = tag, key, [], out, main


def furniture(names: str) -> set[str]:
    """Words of page furniture among class names or ids, of names that say nothing else."""
    found = set()
    for name in names.split():
        words = {w.lower() for w in WORDS.findall(name) if not w.isdigit()}
        if words & OUT_WORDS and words <= OUT_WORDS | BESIDE_WORDS:
            found |= words & OUT_WORDS
    return found


def _element(tag: str, attrs: str) -> Element:
    found = {}
    if attrs:
        for m in ATTR.finditer(attrs):
            found.setdefault(m[1].lower(), next((x for x in m.groups()[1:] if x is not None), ""))
    names = found.get("class", "") + " " + found.get("id", "")
    words = furniture(names)
    role = found.get("role", "").lower()
    out = (tag in OUT_TAGS or role in OUT_ROLES or found.get("aria-hidden", "").lower() == "true" or "hidden" in found
           or "display:none" in found.get("style", "").replace(" ", "").lower())
    if tag not in WHOLE and words or tag == "article" and words & {"comment", "comments", "reply", "teaser", "ad", "advert", "related"}:
        out = True
    main = tag in ("article", "main") or role == "main" or found.get("itemprop", "").lower() == "articlebody"
    cls = ".".join(sorted(found.get("class", "").split())[:3])
    if main and tag not in ("article", "main"):
        cls += MAIN
    return Element(tag, f"{tag}.{cls}" if cls else tag, out, main)


def parse(page: str) -> Element:
    """Element tree of a page; texts are raw strings among the children."""
    root = Element("", "")
    stack = [root]
    flat: dict = {}         # open elements below MAX_DEPTH
    mute = None             # the outermost furniture among them, and how many of its tag were open before
    at = 0
    n = len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            if mute is None:
                stack[-1].kids.append(page[at:])
            break
        if m.start() > at and mute is None:
            stack[-1].kids.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if flat.get(tag):
                flat[tag] -= 1
                if mute == (tag, flat[tag]):
                    mute = None
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    flat, mute = {}, None       # what was open below ends with it
                    break
            continue
        if tag in CLOSES_P:         # an open paragraph ends where a block begins
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in SAME:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SAME[tag]:
                    del stack[i:]
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "select"):
                    break
        if len(stack) > MAX_DEPTH and tag not in RAW and tag not in VOID:
            if mute is None and _element(tag, m[3]).out:
                mute = tag, flat.get(tag, 0)
            flat[tag] = flat.get(tag, 0) + 1
            continue
        e = _element(tag, m[3])
        stack[-1].kids.append(e)
        if tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(page, at)
            at = n if end is None else max(end.start(), at)
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(e)
    return root


def clean(raw: str) -> str:
    return " ".join((html.unescape(raw) if "&" in raw else raw).split())


def _hash(s: str) -> str:
    return hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=6).hexdigest()


# A wrapper item: [key, repeated, optional, children, text hash or "" (a slot), characters, linked characters]
KEY, REPEATED, OPTIONAL, KIDS, TEXT, CHARS, LINKED = range(7)


def _fold(items: list) -> list:
    """Neighbours of one kind become a repeated group; then groups of two or three kinds."""
    out: list = []
    for x in items:
        if out and out[-1][KEY] == x[KEY]:
            out[-1] = align(out[-1], x)
            out[-1][REPEATED] = 1
        else:
            out.append(x)
    for size in (2, 3):
        i = 0
        while i + 2 * size <= len(out):
            keys = [x[KEY] for x in out[i:i + size]]
            j = i + size
            while [x[KEY] for x in out[j:j + size]] == keys:
                for k in range(size):
                    out[i + k] = align(out[i + k], out[j + k])
                j += size
            if j > i + size:
                for k in range(size):
                    out[i + k][REPEATED] = 1
                del out[i + size:j]
            i += 1
    return out


def skeleton(e: Element, linked: bool = False) -> list:
    """A page as a wrapper of its own."""
    kids = []
    linked = linked or e.tag == "a"
    for c in e.kids:
        if isinstance(c, Element):
            if c.tag not in RAW and c.tag not in VOID:
                kids.append(skeleton(c, linked))
        else:
            t = clean(c)
            if t:
                kids.append(["#", 0, 0, [], _hash(t), len(t), len(t) if linked else 0])
    return [e.key, 0, 0, _fold(kids), "", 0, 0]


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """Longest common subsequence of two key lists, as index pairs."""
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    pairs = [(i, i) for i in range(head)]
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    if x and y:
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x) - 1, -1, -1):
            for j in range(len(y) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < len(x) and j < len(y):
            if x[i] == y[j]:
                pairs.append((head + i, head + j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    return pairs + [(len(a) - tail + k, len(b) - tail + k) for k in range(tail)]


def align(a: list, b: list) -> list:
    """The least wrapper item found here that covers two items of one key."""
    text = a[TEXT] if a[TEXT] == b[TEXT] else ""
    kids: list = []
    i = j = 0
    for p, q in [*_common([x[KEY] for x in a[KIDS]], [x[KEY] for x in b[KIDS]]), (len(a[KIDS]), len(b[KIDS]))]:
        for extra in (*a[KIDS][i:p], *b[KIDS][j:q]):
            extra[OPTIONAL] = 1
            kids.append(extra)
        if p < len(a[KIDS]):
            kids.append(align(a[KIDS][p], b[KIDS][q]))
        i, j = p + 1, q + 1
    folded: list = []
    for x in kids:          # optional stretches may have brought equal neighbours
        if folded and folded[-1][KEY] == x[KEY]:
            x = align(folded.pop(), x)
            x[REPEATED] = 1
        folded.append(x)
    return [a[KEY], a[REPEATED] | b[REPEATED], a[OPTIONAL] | b[OPTIONAL], folded, text, a[CHARS] + b[CHARS], a[LINKED] + b[LINKED]]


def size(w: list) -> int:
    return 1 + sum(map(size, w[KIDS]))


def _gathered(w: list, many: int | None) -> list:
    """Siblings of one tag as one optional, repeated group: the optional ones, and all
    where a tag has ``many`` siblings."""
    kids: list = []
    at: dict = {}
    count = Counter(x[KEY].partition(".")[0] for x in w[KIDS])
    for x in w[KIDS]:
        x = _gathered(x, many)
        tag = x[KEY].partition(".")[0]
        if not (x[OPTIONAL] or many and count[tag] >= many):
            kids.append(x)
        elif tag not in at:
            at[tag] = len(kids)
            kids.append(x)
        else:
            old = kids[at[tag]]
            new = align(old, x)
            new[KEY] = x[KEY] if x[KEY] == old[KEY] else tag + ANY
            new[REPEATED] = new[OPTIONAL] = 1
            kids[at[tag]] = _gathered(new, many)
    return [*w[:KIDS], kids, *w[TEXT:]]


def _cut(w: list, depth: int) -> list:
    """A wrapper with one optional slot in place of what lies below a depth."""
    def sums(x):
        return np.array(x[CHARS:LINKED + 1]) + sum(map(sums, x[KIDS]))
    if not w[KIDS]:
        return w
    if depth == 0:
        chars, linked = sums(w).tolist()
        return [*w[:KIDS], [["#", 1, 1, [], "", chars, linked]], *w[TEXT:]]
    return [*w[:KIDS], [_cut(x, depth - 1) for x in w[KIDS]], *w[TEXT:]]


def generalised(w: list, most: int) -> list:
    """A wrapper of at most ``most`` items that covers what ``w`` covers."""
    for many in (None, 65, 9, 2):       # the longest rows of siblings first
        if size(w) > most:
            w = _gathered(w, many)
    depth = 24
    while size(w) > most and depth >= 0:
        w = _cut(w, depth)
        depth -= 1
    return w


def expression(w: list) -> str:
    """The wrapper as a readable regular expression."""
    if w[KEY] == "#":
        s = "text" if w[TEXT] else "#slot"
    else:
        inner = " ".join(map(expression, w[KIDS]))
        s = f"<{w[KEY]}> {inner} </>" if w[KEY] else inner
    return f"({s})+" if w[REPEATED] else f"({s})?" if w[OPTIONAL] else s


def decide(w: list, pages: int) -> dict:
    """What a wrapper tells about its host's pages: paths of template texts and the
    path of the element with most of the varying text."""
    drop: list = []

    def out(key: str) -> bool:
        tag, _, cls = key.partition(".")
        return tag in OUT_TAGS or tag == "header" or bool(furniture(cls.replace(".", " ")))

    def weigh(x: list, path: str, always: bool) -> float:
        always = always and not x[REPEATED] and not x[OPTIONAL]
        if x[KEY] == "#":
            if x[TEXT] and always and pages >= 3:
                drop.append([path, x[TEXT]])
                return 0.0
            return x[CHARS] - 2.0 * x[LINKED]
        total = 0.0
        for c in x[KIDS]:
            v = weigh(c, path if c[KEY] == "#" else f"{path}/{c[KEY]}", always)
            total += 0.0 if c[KEY] != "#" and out(c[KEY]) else v
        weights[path] = max(weights.get(path, 0.0), total)
        return total
    def is_main(x: list) -> bool:
        return x[KEY].partition(".")[0] in ("article", "main") or x[KEY].endswith(MAIN)

    def holds_main(x: list) -> bool:
        return not out(x[KEY]) and (is_main(x) or any(map(holds_main, x[KIDS])))
    weights: dict = {}
    weigh(w, "", True)
    region, here = "", w
    while True:
        elements = [c for c in here[KIDS] if c[KEY] != "#" and not out(c[KEY]) and not c[KEY].endswith(ANY)]
        elements = [c for c in elements if holds_main(c)] or elements
        best = max(elements, key=lambda c: weights[f"{region}/{c[KEY]}"], default=None)
        if best is None or weights[f"{region}/{best[KEY]}"] < 0.7 * weights[region] or best[REPEATED] or best[KEY].partition(".")[0] in ("p", "pre", "h1", "h2"):
            return {"region": region, "drop": drop}
        region, here = f"{region}/{best[KEY]}", best
        if is_main(best):
            return {"region": region, "drop": drop}


def main_text(page: str, rule: dict | None = None) -> str:
    """Blocks of main text of a page, by its own markup and its host's wrapper."""
    root = parse(page)
    if rule is None:
        rule = decide(skeleton(root), 1)
    template = {tuple(x) for x in rule["drop"]}

    def has_main(e: Element) -> bool:
        return any(isinstance(c, Element) and not c.out and (c.main or has_main(c)) for c in e.kids)

    def spots(e: Element, path: str, in_main: bool) -> list:
        """Elements of the region, and whether each is main or lies in one that is."""
        in_main = in_main or e.main
        if path == rule["region"]:
            return [(e, in_main)]
        return [x for c in e.kids if isinstance(c, Element) and not c.out and f"{rule['region']}/".startswith(f"{path}/{c.key}/")
                for x in spots(c, f"{path}/{c.key}", in_main)]
    found = spots(root, "", False)
    if not found:               # a page without the host's region is judged by itself
        rule = decide(skeleton(root), 1)
        found = spots(root, "", False)
    marked = any(in_main or has_main(e) for e, in_main in found)
    blocks: list[str] = []
    line: list[str] = []

    def flush():
        t = clean("".join(line))
        if t:
            blocks.append(t)
        line.clear()

    # explicit stack: pages may nest deeper than the recursion limit
    todo: list = [(root, "", False, False, False)]
    while todo:
        e, path, in_region, in_main, closing = todo.pop()
        if closing:
            flush()
            continue
        inside = in_region and (in_main or not marked)
        if isinstance(e, str):
            if inside and (path, _hash(clean(e))) not in template:
                line.append(e)
            continue
        if e.out or e.tag == "header" and not (marked and inside):
            if e.tag in BLOCK:
                flush()
            continue
        if e.tag == "br":
            line.append(" ")
            continue
        in_region, in_main = in_region or path == rule["region"], in_main or e.main
        if e.tag in BLOCK:
            flush()
            todo.append((None, "", False, False, True))
        for c in reversed(e.kids):
            todo.append((c, path if isinstance(c, str) else f"{path}/{c.key}", in_region, in_main, False))
    flush()
    return "\n\n".join(blocks)


def _host(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _merge(old, new):
    """Two (wrapper, hashes of up to three different pages) of one host."""
    (a, x), (b, y) = old, new
    if size(a) + size(b) > MAX_ITEMS:
        a, b = generalised(a, MAX_ITEMS // 2), generalised(b, MAX_ITEMS // 2)
    return align(a, b), sorted({*x, *y})[:3]


def wrappers(df: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, wrapper, rule): one row per host, inferred from all its pages."""
    def infer(batches):
        hosts: dict = {}
        seen: set = set()
        for b in batches:
            for host, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = _hash(raw)
                if (host, h) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add((host, h))
                new = (skeleton(parse(raw)), [h])
                hosts[host] = _merge(hosts[host], new) if host in hosts else new
                if len(hosts) > 20_000:     # many small hosts: send what there is
                    yield send(hosts)
                    hosts = {}
        if hosts:
            yield send(hosts)

    def send(hosts):
        return pa.RecordBatch.from_arrays([pa.array(list(hosts)), pa.array([json.dumps(w) for w, _ in hosts.values()]), pa.array([p for _, p in hosts.values()], pa.list_(pa.string()))],
                                          names=["host", "wrapper", "pages"])

    def unite(batches):
        current, held = None, None

        def out():
            w, pages = held
            return pa.RecordBatch.from_arrays([pa.array([current]), pa.array([expression(w)]), pa.array([json.dumps(decide(w, len(pages)))])], names=["host", "wrapper", "rule"])
        for b in batches:
            for host, w, pages in zip(*(c.to_pylist() for c in b.columns), strict=True):
                new = (json.loads(w), pages)
                if host != current:
                    if held is not None:
                        yield out()
                    current, held = host, new
                else:
                    held = _merge(held, new)
        if held is not None:
            yield out()
    parts = map_arrow(df.select(_host(url).alias("host"), F.coalesce(F.col(page), F.lit("")).alias("html")), infer, "host string, wrapper string, pages array<string>")
    # one row per host and task; the order of merging is fixed
    return map_arrow(parts.repartition("host").sortWithinPartitions("host", "wrapper"), unite, "host string, wrapper string, rule string")


def extract(df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text) of each row."""
    rules = stored(wrappers(df, url, page).select("host", "rule"), "wrappers")
    rows = df.select(F.col(key).alias("__id"), F.col(url).alias("__url"), _host(url).alias("host"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    kinds = dict(df.dtypes)

    def run(batches):
        known: dict = {}
        for b in batches:
            out = []
            for raw, rule in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                r = known.get(rule)
                if r is None:
                    if len(known) > 1000:
                        known.clear()
                    r = known[rule] = json.loads(rule)
                out.append(main_text(raw, r))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=[key, url, "text"])
    return map_arrow(skew_join(rows, rules, "host").select("__id", "__url", "html", "rule"), run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string")
