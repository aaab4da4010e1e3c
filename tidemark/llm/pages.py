"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from the same template, so the tokens that the template
writes occur equally often on the same pages.  Tokens here are block-level tags
with their path and whole text blocks with their path.

1. Occurrence vectors.  A token's vector is its count on every distinct article of the
   host; copies, and near copies that agree in their three longest texts but for digits, vote once.
   It is never built: each page adds a hash of (page, count), combined by xor, and
   the number of pages and occurrences are summed.  That aggregates map-side and
   through the shuffle, so a host with a third of all pages is no hot group.
2. Classes.  Tokens of a host with equal vectors are one equivalence class.  Kept
   are those on at least half of the host's pages (two or more) that have two or
   more tokens; tokens without a class are kept for their page counts.  A token on half the pages is one of at most twice the tokens of a
   mean page, which bounds a host's template.  Tags are counted over the whole
   corpus too, for hosts with a single distinct page.
3. Nesting.  On each page the classes are placed by support: all tokens present,
   in the order of their mean positions, and the span neither crossing that of a
   class placed before.  The placed classes are the page's template, and what
   lies between their tokens are its slots.
4. Fixed and varying.  A passage (the texts of one element, with the headings,
   paragraphs and list items in it) that is the same on nine tenths of the distinct
   pages that have its place is frame; so is a single text on nine tenths of them, eight
   pages or more.  A text that only half of the pages share, in a place that varies, is
   no frame.  What stands on fewer than half of a host's pages can't be judged, and nothing
   is fixed where less than half of the marked article, or of an unmarked page, would be left.
5. Extraction.  Each block lies in the slot of the deepest template element around
   it.  Words in tags, classes, ids and roles are evidence: menus, headers, footers,
   sidebars, notices, adverts, forms, scripts, styles and comments are left out, and a
   marked article (``article``, else ``main``, else an element whose class, id or role
   says so) is the text, without its fixed blocks unless nothing in it varies.  Without
   a marked article, an element left out for its name that holds most of the varying
   text is not left out (menus, sidebars, footers and comments are), fixed blocks are dropped
   and the deepest template element that holds most of the rest is taken.

A block is the text between block-level tags; a ``br`` counts as white space.

Defined results: a null or empty html gives an empty text; a null url is a host
of its own; repeated rows get equal results; cut-off tags at the end are ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import re
import struct
from collections import Counter, defaultdict
from collections.abc import Collection, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

#: A comment, a declaration or a tag.  A quoted value begins right after its equals sign; other quotes are letters.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)>", re.S)
_CUT_TAG = re.compile(r"<[a-zA-Z/!][^<>]*\Z")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"[0-9]+")
RAW = {n: re.compile(rf"</{n}\s*(?:>|\Z)", re.I) for n in ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "select", "button")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html"
    " legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that belong to the passage around them, unless a class, id or role sets them apart.
TEXT_LEVEL = HEADINGS | frozenset("p li pre blockquote dd dt td th tr tbody thead tfoot figcaption summary".split())
#: A text on this share of the pages that have its place is fixed.  A single text in a place
#: that varies must stand on more pages for that, as a few near copies share texts too.
FIXED_SHARE = 0.9
FIXED_PAGES, FIXED_TEXT_PAGES = 2, 8
#: Nothing counts as fixed where less than this share of the text of the marked article, or of the page, would be left.
LEAST_LEFT = 0.5
#: Pages of a host that agree in so many of their longest texts, digits aside, are near copies.
COPY_TEXTS = 3
#: Elements that stay out of the text even where they hold most of it.
NEVER = frozenset("nav aside footer dialog menu head".split())
#: Elements that never hold article text, and words of class, id or role that say the same of any element.
OUTSIDE = frozenset("nav aside footer form dialog menu head header".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal"
    " newsletter subscribe signup sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar share sharing social"
    " related recommended recommendations login search widget pagination pager contentinfo complementary".split()
)
OUTSIDE_STARTS = ("advert", "adsby", "cookie", "sidebar", "newsletter", "breadcrumb")
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
#: Marks of an article, from the weakest: words of class, id or role, then the two elements.
MARK_WORDS = frozenset("article post entry story content".split())
MARKS = {"main": 2, "article": 3}
#: Elements that a new sibling closes, and where that stops.
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt", {"dl"}), "dd": ("dd", {"dl"}), "tr": ("tr", {"table"}), "td": ("td", {"tr", "table"}), "th": ("th", {"tr", "table"}), "option": ("option", {"form"})}
KEEP, OUT, HARD = 0, 1, 2
TEXT, TAG, PASSAGE = 0, 1, 2
_PACKED = "<Qbqq"


class Page:
    """Blocks and template tokens of one page.

    Elements are numbered as they start: name, parent, path hash, state, the strongest
    mark of an article on or around the element.  Blocks are (element, text).  Tokens are
    (hash, is_tag, number of the element or block) in page order.  Places are the
    elements that hold a passage; each has the hash of its own texts.  Elements in
    ``trusted`` are not left out, whatever they are named.
    """

    def __init__(self, source: str, trusted: Collection[int] = ()):
        self.source, self.trusted, self.place = source, trusted, [0]
        self.names, self.parent, self.path, self.state, self.inside = ["#"], [-1], [0], [KEEP], [0]
        self.blocks: list[tuple[int, str]] = []
        self.tokens: list[tuple[int, bool, int]] = []
        self._open, self._pieces = [0], []
        self._muted: set[int] = set()  # inline elements that are left out of the block around them
        self.never = {0}
        at = 0
        source = _CUT_TAG.sub("", source)
        end, last = len(source), source.rfind(">")
        while at < end:
            if at > last:  # no tag ends any more; a comment that doesn't end hides the rest
                self._text(source[at:].partition("<!--")[0])
                break
            m = _TOKEN.search(source, at)
            if not m:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            name = m.group(2)
            if not name:
                continue
            name = name.lower()
            if m.group(1):
                self._close(name)
            elif name in RAW:
                if name in ("script", "style") or not m.group(3).endswith("/"):
                    stop = RAW[name].search(source, at)
                    at = stop.end() if stop else end
            else:
                self._start(name, m.group(3))
        self._flush()

    def _text(self, text: str) -> None:
        if self._open[-1] not in self._muted:
            self._pieces.append(text)

    def _flush(self) -> None:
        if not self._pieces:
            return
        text = " ".join(html_lib.unescape("".join(self._pieces)).split())
        self._pieces = []
        if text:
            e = next(x for x in reversed(self._open) if x not in self._muted)
            self.tokens.append((xxhash.xxh64_intdigest(text, self.path[e]), False, len(self.blocks)))
            self.blocks.append((e, text))

    def _pop_to(self, name: str, until) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            n = self.names[self._open[k]]
            if n == name:
                del self._open[k:]
                return
            if n in until:
                return

    def _start(self, name: str, attrs: str) -> None:
        words: set[str] = set()
        if attrs and "=" in attrs:
            words = {w.lower() for _, a, b, c in _ATTR.findall(attrs) for w in _NAME.findall(a or b or c)}
        outside = bool(words & OUTSIDE_WORDS) or any(w.startswith(OUTSIDE_STARTS) for w in words)
        block = name in BLOCK
        if name == "br":
            self._text(" ")
            return
        if block:
            self._flush()
            self._pop_to("p", BLOCK - {"p"})
            if name in CLOSES:
                self._pop_to(*CLOSES[name])
        elif name in VOID or not (outside or words & COMMENT_WORDS):
            return  # other inline elements don't part the text
        if name in VOID:
            return
        up = self._open[-1]
        state, inside = self.state[up], self.inside[up]
        if words & COMMENT_WORDS or name in NEVER or name in ("article", "main"):
            self.never.add(len(self.names))
        if len(self.names) in self.trusted:
            pass
        elif name in ("article", "main"):
            if words & COMMENT_WORDS or (inside == 3 and outside):
                state = HARD
            elif state == OUT:
                state = KEEP  # a wrapper that is only named like a frame part
            inside = max(inside, MARKS[name])
        elif words & COMMENT_WORDS:
            state = HARD if name not in ("html", "body") else state
        elif name in OUTSIDE:
            state = max(state, OUT if name == "header" else HARD)
        elif name in HEADINGS and inside and state == OUT and self._in_header(up):
            state = KEEP  # an article's own headline
        elif outside and name not in ("html", "body"):
            state = max(state, OUT)
        elif words & MARK_WORDS and block and name not in ("html", "body"):
            inside = max(inside, 1)
        key = xxhash.xxh64_intdigest(name + " " + " ".join(sorted(words)), self.path[up])
        self.place.append(self.place[up] if name in TEXT_LEVEL and not words else len(self.names))
        self.names.append(name)
        self.parent.append(up)
        self.path.append(key)
        self.state.append(state)
        self.inside.append(inside)
        self._open.append(len(self.names) - 1)
        if not block:
            self._muted.add(len(self.names) - 1)
        self.tokens.append((key, True, len(self.names) - 1))

    def passages(self) -> dict[int, int]:
        """Hash of the texts that stand in each place itself, by place."""
        texts = defaultdict(list)
        for e, text in self.blocks:
            texts[self.place[e]].append(text)
        return {e: xxhash.xxh64_intdigest("\0".join(t), self.path[e] ^ 1) for e, t in texts.items()}

    def copy_key(self) -> bytes:
        """Equal for near copies: the longest texts without their digits, or all tokens of a page without text."""
        longest = sorted({_DIGITS.sub("", t) for _, t in self.blocks}, key=lambda t: (-len(t), t))[:COPY_TEXTS]
        if longest:
            return xxhash.xxh3_128_digest("\0".join(longest).encode("utf-8", "surrogatepass"))
        return xxhash.xxh3_128_digest(struct.pack(f"<{len(self.tokens)}Q", *(t[0] for t in self.tokens)))

    def _in_header(self, e: int) -> bool:
        while e > 0 and self.state[e] == OUT:
            if self.names[e] == "header":
                return True
            e = self.parent[e]
        return False

    def _close(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
        for k in range(len(self._open) - 1, 0, -1):
            if self.names[self._open[k]] == name:
                if self._open[k] not in self._muted:
                    self._flush()
                del self._open[k:]
                return


def placed_classes(page: Page, template: list[tuple[int, int, float, int]]) -> set[int]:
    """Indexes of the page's tokens that its template writes: classes by support, in order and nested.

    ``template``: (token, class, mean position, support) of the host; tokens without a class are not placed.
    """
    where = defaultdict(list)
    for i, (h, _, _) in enumerate(page.tokens):
        where[h].append(i)
    classes = defaultdict(list)
    for token, cls, mean, support in template:
        if cls is not None:
            classes[cls].append((mean, token, support))
    spans: list[tuple[int, int]] = []
    out: set[int] = set()
    for cls in sorted(classes, key=lambda c: (-classes[c][0][2], c)):
        members = [t for _, t, _ in sorted(classes[cls])]
        times = {len(where.get(t, ())) for t in members}
        if 0 in times or len(times) != 1:
            continue  # the class isn't on this page as a whole
        n = times.pop()
        # occurrence k of each token: in the order of the class, and before occurrence k + 1 begins
        rounds = [[where[t][k] for t in members] for k in range(n)]
        if any(r != sorted(r) for r in rounds) or any(a[-1] >= b[0] for a, b in zip(rounds, rounds[1:])):
            continue
        first, last = rounds[0][0], rounds[-1][-1]
        if any(a < first < b < last or first < a < last < b for a, b in spans):
            continue
        spans.append((first, last))
        out.update(i for r in rounds for i in r)
    return out


def fixed_blocks(page: Page, support: dict[int, int]) -> set[int]:
    """Blocks that the template writes: texts that don't vary where they stand, on the pages of the host that have the place."""

    def fixed(token: int, path: int, least: int) -> bool:
        n = support.get(token, 0)
        return n >= least and n >= FIXED_SHARE * support.get(path, math.inf)

    places = {e for e, h in page.passages().items() if fixed(h, page.path[e], FIXED_PAGES)}
    texts = {i: h for h, tag, i in page.tokens if not tag}
    return {i for i, (e, _) in enumerate(page.blocks) if page.place[e] in places or fixed(texts[i], page.path[e], FIXED_TEXT_PAGES)}


def _wrapper(page: Page, fixed: set[int], support: dict[int, int]) -> int:
    """The element that is left out though it holds most of the text that varies, or 0."""
    held: Counter = Counter()
    for i, (e, text) in enumerate(page.blocks):
        if i not in fixed:
            held[e] += len(text)
    for e in range(len(page.names) - 1, 0, -1):
        if held[e]:
            held[page.parent[e]] += held[e]
    outer = (e for e in range(1, len(page.names)) if page.state[e] != KEEP and page.state[page.parent[e]] == KEEP)
    return next((e for e in outer if 2 * held[e] > held[0] and e not in page.never and page.path[e] in support), 0)


def main_blocks(page: Page, template: list[tuple[int, int | None, float, int]], own: bool = True) -> list[str]:
    """Texts of the slots that hold the article.

    The frame is made of the elements that the template writes and of marked
    articles; each block lies in the slot of the deepest frame element around it.
    Fixed blocks are frame, inside a marked article too, unless nothing varies.
    A template that isn't the host's ``own`` doesn't tell what varies.
    """
    support = {t: n for t, _, _, n in template} if own else {}
    fixed = fixed_blocks(page, support)
    # an article that is marked and not left out says where the text is, else what varies does
    if support and not any(m and st == KEEP for m, st in zip(page.inside, page.state)):
        found = _wrapper(page, fixed, support)
        while found:
            page = Page(page.source, {*page.trusted, found})
            found = _wrapper(page, fixed, support)
    written = placed_classes(page, template)
    frame = {page.tokens[i][2] for i in written if page.tokens[i][1]}
    # a marked article bounds a slot even where the template misses it
    frame.update(e for e in range(1, len(page.names)) if page.inside[e] > page.inside[page.parent[e]])
    # parents come before their children, so one pass finds every element's frame element
    slot = [0] * len(page.names)
    for e in range(1, len(page.names)):
        slot[e] = e if e in frame else slot[page.parent[e]]
    slots: dict[int, list[int]] = defaultdict(list)
    for i, (e, _) in enumerate(page.blocks):
        if page.state[e] == KEEP:
            slots[slot[e]].append(i)
    marked = max((page.inside[s] for s in slots), default=0)
    if marked:
        main = {s for s in slots if page.inside[s] == marked}
        ids = sorted(i for s in main for i in slots[s])
        left = [i for i in ids if i not in fixed]
        return [page.blocks[i][1] for i in (left if _chars(page, left) >= LEAST_LEFT * _chars(page, ids) else ids)]
    varying = {s: left for s, ids in slots.items() if (left := [i for i in ids if i not in fixed])}
    if varying and sum(_chars(page, ids) for ids in varying.values()) < LEAST_LEFT * sum(_chars(page, ids) for ids in slots.values()):
        varying = slots
    if not varying and _has_empty_slot(page, frame):
        return []
    slots = varying or slots
    # the deepest frame element that holds most of the text; without a template, the deepest element
    around = slot if len(frame) > 1 else range(len(page.names))
    held: Counter = Counter()
    for ids in slots.values():
        for i in ids:
            held[around[page.blocks[i][0]]] += len(page.blocks[i][1])
    for e in range(len(page.names) - 1, 0, -1):
        if held[e]:
            held[page.parent[e]] += held[e]
    top = max((e for e in held if 2 * held[e] > held[0] and page.names[e] not in HEADINGS | {"p", "li", "pre"}), default=0)
    within = {top}
    for e in range(top + 1, len(page.names)):
        if page.parent[e] in within:
            within.add(e)
    return [page.blocks[i][1] for i in sorted(i for ids in slots.values() for i in ids) if page.blocks[i][0] in within]


def _chars(page: Page, ids: Collection[int]) -> int:
    return sum(len(page.blocks[i][1]) for i in ids)


def _has_empty_slot(page: Page, frame: set[int]) -> bool:
    """Does the template write an element that holds nothing on this page?"""
    full = {e for e, _ in page.blocks} | set(page.parent)
    return any(page.state[e] == KEEP and e not in full for e in frame)


def _host(url: str | None) -> str:
    rest = (url or "").partition("://")[2]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower()


def distinct_pages(pages: DataFrame) -> DataFrame:
    """(host, page, tokens): the tokens of each host's distinct articles, packed as (hash, kind, count, sum of places).

    Near copies are one article and vote once, by the page of least hash among them, so pages that
    differ in a date or a counter don't vote their text into the template.  Copies are
    merged before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                hosts, keys, marks, packed = [], [], [], []
                for url, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    page = Page(source or "")
                    tokens, sums = page.tokens, {}
                    counted = [(h, TAG if tag else TEXT, i) for i, (h, tag, _) in enumerate(tokens)]
                    for h, kind, i in counted + [(h, PASSAGE, 0) for h in page.passages().values()]:
                        s = sums.setdefault(h, [h, kind, 0, 0])
                        s[2] += 1
                        s[3] += i
                    hosts.append(_host(url))
                    keys.append(page.copy_key())
                    marks.append(xxhash.xxh3_128_digest(struct.pack(f"<{len(tokens)}Q", *(t[0] for t in tokens))))
                    packed.append(b"".join(struct.pack(_PACKED, *s) for s in sums.values()))
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.binary()), pa.array(marks, pa.binary()), pa.array(packed, pa.binary())], names=["host", "page", "mark", "tokens"])

    every = pages.select("url", "html").mapInArrow(run, "host string, page binary, mark binary, tokens binary")
    return every.groupBy("host", "page").agg(F.min(F.struct("mark", "tokens")).alias("least")).select("host", "page", "least.mark", "least.tokens")


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, kind, vector, pages, total, place): each host's tokens, and tags over the whole corpus (host null).

    Each distinct page votes once for its host and once for the corpus, so copies
    neither carry a text into a template nor cancel in the xor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                sums: dict[tuple[str | None, int], list] = {}
                for host, key, packed in zip(*(part.column(c).to_pylist() for c in range(3))):
                    key = int.from_bytes(key[:8], "little")
                    # token 0 is the page itself
                    for h, kind, n, place in [(0, TAG, 1, 0), *struct.iter_unpack(_PACKED, packed)]:
                        if host is None and kind != TAG:
                            continue
                        s = sums.setdefault((host, h, kind), [0, 0, 0, 0])
                        s[0] ^= xxhash.xxh64_intdigest(n.to_bytes(8, "little"), key)
                        s[1] += 1
                        s[2] += n
                        s[3] += place
                signed = lambda v: v - (1 << 64) if v >> 63 else v
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in sums], pa.string()),
                        pa.array([signed(k[1]) for k in sums], pa.int64()),
                        pa.array([k[2] for k in sums], pa.int32()),
                        pa.array([signed(v[0]) for v in sums.values()], pa.int64()),
                        pa.array([v[1] for v in sums.values()], pa.int64()),
                        pa.array([v[2] for v in sums.values()], pa.int64()),
                        pa.array([float(v[3]) for v in sums.values()], pa.float64()),
                    ],
                    names=["host", "token", "kind", "vector", "pages", "total", "place"],
                )

    schema = "host string, token bigint, kind int, vector bigint, pages bigint, total bigint, place double"
    own = stage(distinct_pages(pages), "pages")
    everywhere = own.groupBy("page").agg(F.min(F.struct("mark", "tokens")).alias("least"))
    everywhere = everywhere.select(F.lit(None).cast("string").alias("host"), "page", F.col("least.tokens").alias("tokens"))
    return (
        own.select("host", "page", "tokens").unionByName(everywhere)
        .mapInArrow(run, schema)
        .groupBy("host", "token", "kind")
        .agg(F.bit_xor("vector").alias("vector"), F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.sum("place").alias("place"))
    )


def deduce_templates(pages: DataFrame) -> DataFrame:
    """(host, template): each host's frequent tokens as an array of (token, class, place, support).

    The class is null for passages and for tokens that are alone in theirs.

    Hosts with a single distinct page are left out; the row with a null host is the corpus-wide template.
    """
    seen = stage(occurrences(pages), "tokens")
    sizes = seen.where("token = 0").select(F.col("host").alias("h"), F.col("pages").alias("host_pages"))
    frequent = (
        seen.where("token != 0 and pages >= 2")
        .join(sizes, F.col("host").eqNullSafe(F.col("h")))
        .where("2 * pages >= host_pages")
        .withColumn("class", F.when(F.col("kind") != PASSAGE, F.xxhash64("vector", "pages", "total")))
        .select("host", "token", "class", (F.col("place") / F.col("total")).alias("place"), F.col("pages").alias("support"))
    )
    alone = F.size("members") < 2
    members = frequent.groupBy("host", "class").agg(F.collect_list(F.struct("token", "class", "place", "support")).alias("members"))
    members = members.withColumn("members", F.when(alone, F.transform("members", lambda m: m.withField("class", F.lit(None).cast("bigint")))).otherwise(F.col("members")))
    return stage(members.groupBy("host").agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("template")), "templates")


def extract_text(pages: DataFrame, carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``carry`` columns of every page (``url`` among them), ``text`` and ``n_chars`` (its code points)."""
    templates = deduce_templates(pages)
    common = [tuple(t) for r in templates.where("host is null").select("template").collect() for t in r.template]
    shared = pages.sparkSession.sparkContext.broadcast(common)  # tags on half of all pages: bounded by a page
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))
    rows = pages.select(*carry, F.col("html").cast("string").alias("html_"), host.alias("host_"))
    rows = rows.join(templates.where("host is not null").select(F.col("host").alias("host_"), "template"), "host_", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common_template = [(t % (1 << 64), c, p, s) for t, c, p, s in shared.value]
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                k = len(carry)
                texts, known, hosts, memo = [], part.column(k + 1), part.column(k + 2).to_pylist(), {}
                for i, source in enumerate(part.column(k).to_pylist()):
                    own = hosts[i]
                    if own not in memo:
                        found = known[i].as_py()
                        template = [(t["token"] % (1 << 64), t["class"], t["place"], t["support"]) for t in found] if found else common_template
                        memo[own] = template, bool(found)
                    texts.append("\n".join(main_blocks(Page(source or ""), *memo[own])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in range(k)] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*carry, "text", "n_chars"],
                )

    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return rows.select(*carry, "html_", "template", "host_").mapInArrow(run, ", ".join([f"`{c}` {types[c]}" for c in carry] + ["text string", "n_chars bigint"]))
