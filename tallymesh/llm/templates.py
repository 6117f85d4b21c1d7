"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its elements (by path of tags, class names and place among like siblings)
and its text blocks (by path and text). Tokens of the distinct pages of one host that have the
same occurrence vector, so many times on the same pages, form an equivalence class. A text token
belongs to the host's template when its class is valid: it has two tokens or more on SUPPORT_PAGES
pages or more, and it nests, that is its element is of the same class or holds that very text on
SHARE of the pages it is on. What a page holds beside the template are its slots. The slot of the
article is the region of an article or main element; where a page marks none, it is found by going
down from the page into the container that holds most of the slots' text, measured over all pages
of the host that have the container.

Tags and class names only rule regions out (menus, adverts, forms, reader comments) or mark the
article. A page is parsed once; its parsed form is staged. Vectors are order-free hashes that Spark
sums up partially, so the pages of a hot host never meet in one task.
"""

from __future__ import annotations

import html
import pickle
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .urlrules import host_path

SUPPORT_PAGES = 3  # distinct pages of a host that a template token is on at least
SHARE = 0.8  # share of an element's pages on which a text must be the same to be template text
VOTE = 8  # times its text that a marked article counts beside what the page holds elsewhere
HEAVY = 0.6  # share of the slots' text from which a container is entered
BROADCAST_TOKENS = 1_000_000  # template and container entries that may be broadcast (about 100 bytes each)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
_SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_KEEPS_P_OPEN = frozenset("li dd dt td th tr tbody thead tfoot caption option optgroup legend summary figcaption body html head title".split())
_LISTED = frozenset("li dd td".split())  # elements that menus are made of where no tag or class says so
_SCOPE = frozenset("table td th ul ol dl button object caption html body article div section aside nav main form".split())
_OUT_TAGS = frozenset("nav footer aside form script style noscript template iframe object svg canvas video audio select button textarea head title dialog menu".split())
_OUT_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead topbar notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup social share sharing related recommended recommendations widget toolbar pagination pager login search".split())
_COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: Words that say what a region is where they end its name, whatever stands before them.
_LAST_WORDS = frozenset("ad ads advert adverts advertisement advertisements sidebar newsletter".split())
#: Words beside those in names of regions that are out, as in "site-footer" or "related-posts".
_NEUTRAL_WORDS = frozenset("site main page left right top bottom box wrapper wrap container block bar list lists post posts article articles item items area section inner outer link links primary secondary global header content widget widgets col column row bg form panel group text img icon id js the".split())
#: Elements that hold regions; names on others, such as headings and paragraphs, say nothing.
_CONTAINERS = frozenset("address article aside body center dd details dialog dir div dl fieldset figure footer form header hgroup html main menu nav ol section span table tbody td tr ul".split())
_OUT_ROLES = frozenset("navigation banner complementary contentinfo search form alert dialog menu menubar".split())
_MAIN_PAIRS = frozenset(("article body", "entry content", "post content", "story body", "article content", "main content"))

_PLACES = 8  # siblings told apart by place
_HEADER = frozenset(("header",))

BODY, MAIN, ARTICLE, OUT, COMMENTS = range(5)


def _says(words: list[str], kinds: frozenset) -> bool:
    """A name says it is such a region: one of its words does, and no word says something else."""
    return bool(kinds.intersection(words)) and all(w in kinds or w in _NEUTRAL_WORDS or w in _OUT_WORDS or w.isdigit() for w in words)


def _region(name: str, raw: str, around: int) -> tuple[int, str]:
    """Kind of region an element starts (or the one around it) and its signature.

    What is out or a comment stays so inside; only outside of these an article can start. Ids of
    sections inside an article are anchors of their headings, which say nothing of the kind; only one
    that names reader comments does.
    """
    names: list[list[str]] = []
    sign, role, hidden = name, "", False
    if raw:
        for key, value in _ATTR.findall(raw):
            key = key.lower()
            value = value.strip("\"'")
            if key == "class" or key == "id" and (around not in (ARTICLE, MAIN) or name != "section" or _says([w.lower() for w in _WORD.findall(value)], _COMMENT_WORDS)):
                names += [[w.lower() for w in _WORD.findall(x)] for x in value.split()]
                if key == "class":
                    sign = f"{name}.{' '.join(sorted(value.split()))}"
            elif key == "role":
                role = value.lower()
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
                hidden = True
    if name in ("html", "body") or around in (OUT, COMMENTS):
        return around, sign
    told = names if name in _CONTAINERS else []
    if name != "main" and any(_says(x, _COMMENT_WORDS) or x and x[-1] in _COMMENT_WORDS for x in told):
        return COMMENTS, sign
    if name in _OUT_TAGS or hidden or role in _OUT_ROLES or any(_says(x, _OUT_WORDS) or x and x[-1] in _LAST_WORDS for x in told if name not in ("article", "main")):
        return OUT, sign
    if name == "article":
        return ARTICLE, sign
    if name == "main" or role == "main":
        return max(around, MAIN), sign
    if (name == "header" or any("header" in x and _says(x, _HEADER) for x in told)) and around not in (ARTICLE, MAIN):
        return OUT, sign
    if any(len(x) > 1 and any(f"{a} {b}" in _MAIN_PAIRS for a, b in zip(x, x[1:], strict=False)) for x in told):
        return ARTICLE, sign
    return around, sign


def _digest(*parts) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts)))


def blocks(page: str) -> tuple[list[tuple[int, int, str, int, float, bool]], dict[int, tuple[int, int, bool]]]:
    """The text blocks and elements of a page.

    Blocks: (region, path, text, characters in links, share of a list item's text in links, in
    a heading). Elements: {path: (parent, how many, is a container)}.
    """
    stack: list[tuple[str, int, int]] = [("", 0, BODY)]
    elements: dict[int, tuple[int, int, bool]] = {}
    like: dict[tuple[int, str], int] = {}
    out: list[tuple[int, int, str, int, float, bool]] = []
    parts: list[str] = []
    linked = total = links = 0
    last: dict[str, int] = {}

    def flush() -> None:
        nonlocal linked, total
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                spot = next((s for s in reversed(stack) if s[0] in _BLOCK), stack[0])
                out.append((stack[-1][2], spot[1], text, linked, linked / total if total and spot[0] in _LISTED else 0.0, spot[0] in ("h1", "h2")))
            parts.clear()
        linked = total = 0

    def closes_last(name: str) -> int:
        if name not in last:
            last[name] = max((m.start() for m in re.finditer(f"</{re.escape(name)}", page, re.I)), default=-1)
        return last[name]

    def drop(to: int) -> None:
        nonlocal links
        if any(s[0] in _BLOCK or s[2] != stack[to - 1][2] for s in stack[to:]):
            flush()
        links -= sum(s[0] == "a" for s in stack[to:])
        del stack[to:]

    def text(raw: str) -> None:
        nonlocal linked, total
        if raw:
            got = html.unescape(raw) if "&" in raw else raw
            parts.append(got)
            total += len(got)
            linked += len(got) * bool(links)

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        shut, name, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if shut:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if k:
                drop(k)
            elif name in _BLOCK:
                flush()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in _BLOCK:
            flush()
            closes = _SELF_CLOSING.get(name, ())
            if name not in _KEEPS_P_OPEN:
                closes = (*closes, "p")
            if closes:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in closes:
                        drop(i)
                        break
                    if stack[i][0] in _SCOPE:
                        break
        if name in ("article", "main") and stack[-1][2] in (OUT, COMMENTS):
            k = next(i for i, x in enumerate(stack) if x[2] in (OUT, COMMENTS))
            if closes_last(stack[k][0]) < at:  # what is never closed ends here
                drop(k)
        kind, sign = _region(name, raw, stack[-1][2])
        if kind != stack[-1][2]:
            flush()
        holds = name in _CONTAINERS and name not in _LISTED and name != "span"
        if holds:  # its place among like siblings tells containers without names apart
            like[stack[-1][1], sign] = place = like.get((stack[-1][1], sign), 0) + 1
            sign = f"{sign}[{min(place, _PLACES)}]"
        path = _digest(stack[-1][1], sign)
        elements[path] = (stack[-1][1], elements.get(path, (0, 0))[1] + 1, holds)
        if name in _VOID or raw.endswith("/") and name not in _BLOCK:
            continue
        if name in _RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*+>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        links += name == "a"
        stack.append((name, path, kind))
    flush()
    return out, elements


def _token(path: int, text: str) -> int:
    return _digest(path, "t", text)


def _sizes(found, elements, template) -> dict[int, int]:
    """Characters of the page's slots below each container: text that is no template, link or ruled out."""
    own: dict[int, int] = {}
    for kind, path, text, linked, share, _ in found:
        if kind in (BODY, MAIN, ARTICLE) and share < 0.8 and _token(path, text) not in template:
            n, at = max(0, len(text) - linked), path
            while True:
                own[at] = own.get(at, 0) + n
                if not at:
                    break
                at = elements[at][0]
    return {p: n for p, n in own.items() if not p or elements[p][2]}


def _below(path: int, top: int, elements) -> bool:
    while path and path != top:
        path = elements[path][0]
    return path == top


def _slot(own, found, elements, shares) -> int:
    """The container whose slots are the article: down from the page while one child holds most of the text.

    shares: over the host's pages, the part of its parent's slot text that a container holds;
    where a container has none (too few pages), the page's own part decides. A container that
    leaves out the page's first headline is not entered.
    """
    top, first = 0, next((b[1] for b in found if b[5] and b[0] == BODY), None)
    while True:
        children = [p for p in own if p and _container(p, elements) == top and own[p]]
        part = {p: shares.get(p, own[p] / max(own[top], 1)) for p in children}
        best = max(children, key=lambda p: (part[p], p), default=None)
        if best is None or part[best] < HEAVY or first is not None and not _below(first, best, elements):
            return top
        top = best


def _container(path: int, elements) -> int:
    """The container around an element; 0 is the page."""
    path = elements[path][0]
    while path and not elements[path][2]:
        path = elements[path][0]
    return path


def _mass(found) -> int:
    return sum(max(0, len(b[2]) - b[3]) for b in found)


def assemble(found, elements, template: frozenset = frozenset(), shares: dict | None = None) -> str:
    """The article of one parsed page: the blocks of its slots, joined by newlines.

    Slots compete by their text beside the template, wherever they lie. A mark is a vote: a
    marked article, and after it a main element, wins where its text counts, VOTE times, for as much as all that
    lies outside it; a card or teaser that happens to be an article element does not. Where a
    marked article has less than half of its text of its own, those pages
    are copies of it, not of a template: it stays whole.
    """
    rest = [b for b in found if _token(b[1], b[2]) not in template] if template else found
    inside = [b for b in found if b[0] in (BODY, MAIN, ARTICLE) and b[4] < 0.8]
    for kind in (ARTICLE, MAIN):
        own, around = [b for b in found if b[0] == kind], [b for b in inside if b[0] < kind and (not template or _token(b[1], b[2]) not in template)]
        if own and _mass(own) * VOTE >= _mass(around):
            left = [b for b in rest if b[0] == kind]
            if sum(len(b[2]) for b in left) * 2 < sum(len(b[2]) for b in own):
                left = own
            return "\n".join(b[2] for b in left)
    rest = [b for b in rest if b[0] == BODY and b[4] < 0.8]
    if not rest:  # all of it is shared: copies again
        rest = [b for b in found if b[0] == BODY and b[4] < 0.8]
    top = _slot(_sizes(rest, elements, frozenset()), rest, elements, shares or {})
    return "\n".join(b[2] for b in rest if _below(b[1], top, elements))


def main_text(page: str, template: frozenset = frozenset(), shares: dict | None = None) -> str:
    return assemble(*blocks(page), template, shares)


def _parsed(pages: DataFrame) -> DataFrame:
    """(row, page_id, url, host, mark, page): mark: hash of the html; page: blocks and elements, packed."""

    def run(batches):
        for b in batches:
            made, marks = [], []
            for page in b.column(4).to_pylist():
                made.append(pickle.dumps(blocks(page or ""), 5))
                marks.append(xxhash.xxh64_intdigest(page or ""))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(np.array(marks, np.uint64).view(np.int64)), pa.array(made, pa.binary())], ["row", "page_id", "url", "host", "mark", "page"])

    return pages.select("row", "page_id", "url", "host", "html").mapInArrow(run, "row long, page_id long, url string, host string, mark long, page binary")


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _tokens(parsed: DataFrame) -> DataFrame:
    """(host, mark, token, parent, is_text, n, row) of every page."""

    def run(batches):
        for b in batches:
            of, toks, parents, texts, ns = [], [], [], [], []
            for i, raw in enumerate(b.column(3).to_pylist()):
                found, elements = pickle.loads(raw)
                seen: dict[int, tuple[int, bool, int]] = {k: (p, False, n) for k, (p, n, _) in elements.items()}
                for _, path, text, *_ in found:
                    k = _token(path, text)
                    seen[k] = (path, True, seen.get(k, (0, True, 0))[2] + 1)
                seen[0] = (0, False, 1)  # the page itself
                for k, (p, is_text, n) in seen.items():
                    of.append(i), toks.append(k), parents.append(p), texts.append(is_text), ns.append(n)
            at = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), _signed(toks), _signed(parents), pa.array(texts, pa.bool_()), pa.array(ns, pa.int32())], ["host", "mark", "row", "token", "parent", "is_text", "n"])

    return parsed.select("host", "mark", "row", "page").mapInArrow(run, "host string, mark long, row long, token long, parent long, is_text boolean, n int")


def deduce(tokens: DataFrame) -> DataFrame:
    """(host, token): the text tokens of each host's template, from the tokens of its distinct pages."""
    once = tokens.groupBy("host", "token", "mark").agg(F.first("parent").alias("parent"), F.first("is_text").alias("is_text"), F.first("n").alias("n"))
    vector = F.bit_xor(F.xxhash64("mark", "n")), F.sum(F.pmod(F.xxhash64("n", "mark"), F.lit(1 << 40)))
    per = once.groupBy("host", "token").agg(F.first("parent").alias("parent"), F.first("is_text").alias("is_text"), F.count("*").alias("pages"), vector[0].alias("v1"), vector[1].alias("v2"))
    per = stage(per.where(F.col("pages") >= SUPPORT_PAGES), "tokens")
    classes = per.groupBy("host", "v1", "v2").agg(F.count("*").alias("size"))
    element = per.where("not is_text").select("host", F.col("token").alias("parent"), F.col("pages").alias("around"), F.col("v1").alias("e1"), F.col("v2").alias("e2"))
    text = per.where("is_text").join(classes, ["host", "v1", "v2"]).join(element, ["host", "parent"])
    same = (F.col("v1") == F.col("e1")) & (F.col("v2") == F.col("e2"))
    return text.where((F.col("size") >= 2) & (same | (F.col("pages") >= F.lit(SHARE) * F.col("around")))).select("host", "token")


def _given(parsed: DataFrame, tokens: DataFrame, entries: DataFrame, name: str) -> tuple[DataFrame, object]:
    """parsed with what of entries (host, token, value) each page has, as arrays ``ks`` and ``vs``, or entries for all hosts.

    Few entries are broadcast; more are joined by host and token and grouped by page, so that
    no host's entries are gathered.
    """
    entries = stage(entries, name)
    if entries.count() <= BROADCAST_TOKENS:
        table = entries.toArrow()
        held: dict[str, dict[int, float]] = {}
        for h, k, v in zip(table["host"].to_pylist(), table["token"].to_pylist(), table["value"].to_pylist(), strict=True):
            held.setdefault(h, {})[k & 0xFFFFFFFFFFFFFFFF] = v
        none = F.lit(None).cast("array<long>").alias("ks"), F.lit(None).cast("array<double>").alias("vs")
        return parsed.select("*", *none), parsed.sparkSession.sparkContext.broadcast(held)
    mine = tokens.select("row", "host", "token").join(entries, ["host", "token"]).groupBy(F.col("row").alias("own")).agg(F.collect_list(F.struct("token", "value")).alias("kv"))
    both = parsed.join(mine, parsed.row == mine.own, "left")
    return both.select(*[parsed[c] for c in parsed.columns], F.col("kv.token").alias("ks"), F.col("kv.value").alias("vs")), None


def _entries(held, host: str, ks, vs) -> dict[int, float]:
    if held is not None:
        return held.value.get(host, {})
    return {k & 0xFFFFFFFFFFFFFFFF: v for k, v in zip(ks, vs, strict=True)} if ks else {}


def _containers(given: DataFrame, held) -> DataFrame:
    """(host, token, value): of each container, the part of its parent's slot text, over pages that mark no article."""

    def run(batches):
        for b in batches:
            of, toks, own_n, all_n = [], [], [], []
            for i, (host, raw, ks, vs) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)):
                found, elements = pickle.loads(raw)
                if any(x[0] in (ARTICLE, MAIN) for x in found):
                    continue
                own = _sizes(found, elements, _entries(held, host, ks, vs))
                for path, n in own.items():
                    if path:
                        of.append(i), toks.append(path), own_n.append(n), all_n.append(own[_container(path, elements)])
            at = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), _signed(toks), pa.array(own_n, pa.int64()), pa.array(all_n, pa.int64())], ["host", "mark", "token", "own", "around"])

    per = given.select("host", "mark", "page", "ks", "vs").mapInArrow(run, "host string, mark long, token long, own long, around long")
    once = per.groupBy("host", "token", "mark").agg(F.first("own").alias("own"), F.first("around").alias("around"))
    sums = once.groupBy("host", "token").agg(F.count("*").alias("pages"), F.sum("own").alias("own"), F.sum("around").alias("around"))
    return sums.where((F.col("pages") >= SUPPORT_PAGES) & (F.col("around") > 0)).select("host", "token", (F.col("own") / F.col("around")).alias("value"))


def extract(pages: DataFrame) -> DataFrame:
    """Per row of pages (page_id, url, html): page_id, url, text, n_chars.

    The article without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles, markup and comments; references decoded, white space in a block made one space,
    blocks joined by a newline. Null, empty or text-free html: the empty string. Pages without
    host share the empty host; repeated rows and null ids are kept and count once for the
    template; other columns are ignored.
    """
    host, _ = host_path(F.col("url"))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))
    parsed = stage(_parsed(base.withColumn("row", F.monotonically_increasing_id())), "parsed", "zstd")
    tokens = _tokens(parsed)
    given, held = _given(parsed, tokens, deduce(tokens).withColumn("value", F.lit(1.0)), "templates")
    shared, parts = _given(given.withColumnsRenamed({"ks": "tk", "vs": "tv"}), tokens, _containers(given, held), "containers")

    def run(batches):
        for b in batches:
            texts = []
            for host, raw, tk, tv, ks, vs in zip(*(b.column(i).to_pylist() for i in range(2, 8)), strict=True):
                texts.append(assemble(*pickle.loads(raw), frozenset(_entries(held, host, tk, tv)), _entries(parts, host, ks, vs)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return shared.select("page_id", "url", "host", "page", "tk", "tv", "ks", "vs").mapInArrow(run, "page_id long, url string, text string, n_chars long")
