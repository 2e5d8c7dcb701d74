"""Main text of web pages: structure rules and site template removal.

Template removal: every element's subtree (tag, class, id, text and the hashes
of its children) is hashed; Spark counts in how many different surroundings
each hash occurs on a host; subtrees that recur in many are deleted.

The surroundings are the text blocks of the rest of the page, or inside an
article or main element of the rest of these, furniture left out, and without
the blocks that ``common_share`` of the host's pages have.  Their three longest
blocks stand for them, and the count of different surroundings is
(different blocks - different triples) / 2.  Surroundings that have nothing in
common count 1 each; copies of a page count once, and so do near copies, a
counter, date or byline being one block of three: each new triple brings one
new block.  What only such pages share is content.  (Two blocks count likewise,
without the half; a single one counts if it is another.)  Pages are parsed once
for this, into a written table of block and subtree hashes.

Counting is an aggregate on (host, hash, block or triple), then one on (host, hash),
both combined on the map side, so a host with a third of all pages is no hot
key.  A host's lists of common blocks and of template hashes are bounded (each
is on at least a share of its pages, or of its different contents) and joined to
the pages by host: Spark broadcasts the written list where its size allows,
else it joins by shuffle and splits hot hosts.

Inside an article or main element, subtrees are deleted at the stricter
``inner_share`` alone.  Near copies that hold ``common_share`` of their host's
pages can't be told from its template.

Defined results: null or empty html gives an empty text; a null url is a host
of its own; broken markup is closed as a browser would, to the degree needed;
repeated rows give one row each and count as one content; a host with fewer
than ``min_contents`` different contents has no templates; an empty table gives
no row.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_map, materialise, pick

# Element names and the class, id and role words of page furniture.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
DROPPED = RAW | set("head nav footer aside form noscript template object svg math canvas audio video map "
                    "button select option optgroup label fieldset dialog menu".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section "
             "summary table tbody tfoot thead tr ul".split())
CELLS = {"br", "td", "th"}  # white space inside their block
ROOTS = ("article", "main")
ROOT_BITS = {"article": 1, "main": 2}
FURNITURE = set("nav navbar navigation menu breadcrumb breadcrumbs masthead header footer sidebar widget ad ads advert "
                "adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
                "notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social "
                "related recommended comment comments disqus reply replies respond pagination pager toolbar search "
                "skip".split())
CONTENT_WORDS = {"article", "entry", "post", "content", "body", "title", "page", "story"}
NOT_ARTICLES = {"comment", "comments", "reply", "related", "teaser", "promo", "ad", "ads", "sponsored"}
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# A start tag ends open elements of the second set, up to one of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
SCOPES = {"table", "td", "th", "caption", "button", "object", "html", "template"}

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"""
                    r"""|<(/?)([A-Za-z][^\s/>]*)""", re.S)
ATTRIBUTES = re.compile(r"""((?:[^>"']|"[^"]*"|'[^']*')*+)>""")  # a > in quotes ends no tag
UNCLOSED_QUOTES = 16  # tags of a page whose quotes are tried to the page's end
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
LONGEST = 3  # blocks that stand for surroundings
HASH = (1 << 63) - 1
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@dataclass(frozen=True)
class Thresholds:
    """A template is on ``min_pages`` pages, copies included, and in as many
    different surroundings (in all of them on a host with fewer, but in
    ``min_contents``) that are ``share`` of the host's different contents."""
    min_pages: int = 5
    share: float = 0.1
    inner_min_pages: int = 20
    inner_share: float = 0.5
    min_contents: int = 3
    common_share: float = 0.8


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def is_furniture(tag: str, attrs: dict[str, str]) -> bool:
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    if attrs.get("role", "").lower() in ROLES:
        return True
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = [w.lower() for w in WORD.findall(name)]
        if not words or words[0] in ("has", "with", "no", "is", "without"):
            continue
        hit = FURNITURE.intersection(words)
        if tag == "article":
            hit &= NOT_ARTICLES
        if hit and not (hit == {"header"} and CONTENT_WORDS.intersection(words)):
            return True
    return False


class Frame:
    __slots__ = ("tag", "cut", "parts", "items", "label", "begin")

    def __init__(self, tag: str, cut: bool, label: str, begin: int):
        self.tag, self.cut, self.label, self.begin = tag, cut, label, begin  # begin: blocks of the page before it
        self.parts: list = []  # what the hash is made of
        self.items: list = []  # text, None at block ends, and lists of kept children


class Page:
    """One pass over the markup with a stack of open elements.  ``templates``
    holds the hashes to delete.  ``blocks`` collects (hash, length, root bits)
    of the texts of elements, furniture left out, equal ones once; ``seen`` the
    subtrees of this page as (hash, inside an article), with the part of the
    page that surrounds them (a bit of ROOT_BITS, 0 for the page) and the range
    of their blocks."""

    def __init__(self, html: str, templates: frozenset[int] = frozenset(), inner: frozenset[int] = frozenset()):
        self.templates, self.inner = templates, inner
        self.seen: dict[tuple[int, bool], tuple[int, int, int]] = {}
        self.blocks: dict[tuple[int, int], int] = {}  # (hash, bits) -> length, in order
        self.roots: dict[str, list] = {"article": [], "main": []}
        self.stack = [Frame("", False, "", 0)]
        self.open: dict[str, int] = {}
        self.cuts = 0
        at = unclosed = 0
        while True:
            m = MARKUP.search(html, at)
            self.text(html[at:m.start() if m else len(html)])
            if m is None:
                break
            at, closing, tag, attrs = m.end(), m[1], m[2], ""
            if tag:
                inside = ATTRIBUTES.match(html, at) if unclosed < UNCLOSED_QUOTES else None
                if inside is None:  # a quote that nothing closes: the tag ends at the next >
                    unclosed += 1
                    end = html.find(">", at)
                    if end < 0:
                        break  # an unfinished tag is no text
                    attrs, at = html[at:end], end + 1
                else:
                    attrs, at = inside[1], inside.end()
            else:
                if m[0].startswith("<![CDATA["):
                    self.text(m[0][9:].removesuffix("]]>"), decode=False)
                continue
            tag = tag.lower()
            if closing:
                self.end(tag)
                continue
            self.start(tag, attrs)
            if tag in RAW and self.stack[-1].tag == tag:
                stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                at = stop.start() if stop else len(html)
        while len(self.stack) > 1:
            self.pop()
        self.add_block(self.stack[0], 0)

    def text(self, raw: str, decode: bool = True) -> None:
        if raw:
            text = entities.unescape(raw) if decode and "&" in raw else raw
            self.stack[-1].items.append(text)
            self.stack[-1].parts.append(text)

    def start(self, tag: str, raw: str) -> None:
        if tag in CELLS:
            self.stack[-1].items.append(" ")
        if tag in VOID:
            if tag == "hr":
                self.stack[-1].items.append(None)
            return
        if tag in BLOCKS and self.open.get("p"):
            self.end("p", SCOPES)
        if tag in CLOSES:
            for other in CLOSES[tag][0]:
                if self.open.get(other):
                    self.end(other, CLOSES[tag][1])
        attrs = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)} if raw else {}
        if tag in ("html", "body", "main"):
            cut = False
        else:
            cut = (tag in DROPPED or tag == "header" and not (self.open.get("article") or self.open.get("main"))
                   or bool(attrs) and is_furniture(tag, attrs))
        frame = Frame(tag, cut, f"{tag}|{attrs.get('class', '')}|{attrs.get('id', '')}", len(self.blocks))
        self.stack.append(frame)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.cuts += cut

    def end(self, tag: str, until: set[str] = frozenset()) -> None:
        if not self.open.get(tag):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                while len(self.stack) > k:
                    self.pop()
                return
            if self.stack[k].tag in until:
                return

    def add_block(self, frame: Frame, bits: int) -> None:
        own = " ".join(" ".join(p for p in frame.parts if isinstance(p, str)).split())
        if own:
            self.blocks.setdefault((xxhash.xxh64_intdigest(own) >> 1, bits), len(own))

    def pop(self) -> None:
        frame = self.stack.pop()
        tag, parent = frame.tag, self.stack[-1]
        self.open[tag] -= 1
        self.cuts -= frame.cut
        if tag in RAW:
            return
        inside = bool(self.open.get("article") or self.open.get("main"))
        digest = xxhash.xxh64_intdigest("\0".join([frame.label, *map(str, frame.parts)])) >> 1
        parent.parts.append(digest)
        kept = not (frame.cut or self.cuts)
        if kept:
            self.add_block(frame, sum(bit for r, bit in ROOT_BITS.items() if self.open.get(r) or tag == r))
        if tag in BLOCKS:
            parent.items.append(None)
            if tag not in ("html", "body", *ROOTS):
                if kept:
                    part = next((ROOT_BITS[r] for r in ROOTS if self.open.get(r)), 0)
                    self.seen.setdefault((digest, inside), (part, frame.begin, len(self.blocks)))
                if digest in (self.inner if inside else self.templates):
                    return
        if frame.cut:
            return
        if tag in BLOCKS:
            frame.items.append(None)
        if tag in ROOTS and not self.open.get(tag) and not self.cuts:
            self.roots[tag].append(frame.items)
        parent.items.append(frame.items)

    def main_text(self) -> str:
        """Of the articles; without one, of the main element or the body."""
        for root in (self.roots["article"], self.roots["main"], self.stack[0].items):
            text = joined(root)
            if text:
                return text
        return ""


def joined(items: list) -> str:
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        block = " ".join("".join(run).split())
        run.clear()
        if block:
            blocks.append(block)

    walk = [iter(items)]
    while walk:
        for item in walk[-1]:
            if item is None:
                flush()
            elif isinstance(item, str):
                run.append(item)
            else:
                walk.append(iter(item))
                break
        else:
            walk.pop()
    flush()
    return "\n".join(blocks)


def page_rows(pages: DataFrame) -> DataFrame:
    return pick(pages, page_id="long", url="string", html="string").withColumn("host", host_of(F.col("url")))


PARSED = ("host string, blocks array<long>, lengths array<int>, bits array<int>, hashes array<long>, inside array<boolean>, "
          "parts array<int>, begins array<int>, ends array<int>")


def parse_pages(pages: DataFrame) -> DataFrame:
    """The blocks of every page and its subtrees with the ranges of their blocks."""
    names = [field.split()[0] for field in PARSED.split(", ")][1:]

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict = {"host": batch.column("host")} | {name: [] for name in names}
        for html in batch.column("html"):
            page = Page(html.as_py() or "")
            blocks = [(h, n, bits) for (h, bits), n in page.blocks.items()]
            trees = [(digest, inside, *at) for (digest, inside), at in page.seen.items()]
            for columns, found in ((names[:3], blocks), (names[3:], trees)):
                for name, values in zip(columns, zip(*found) if found else [()] * len(columns)):
                    out[name].append(list(values))
        return out

    return arrow_map(page_rows(pages).select("host", "html"), rows, PARSED)


def common_blocks(parsed: DataFrame, share: float) -> DataFrame:
    """host, common: the blocks that so large a share of the host's pages have."""
    n_pages = parsed.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    return (parsed.select("host", F.explode(F.array_distinct("blocks")).alias("block"))
            .groupBy("host", "block").agg(F.count(F.lit(1)).alias("n")).join(n_pages, "host")
            .filter(F.col("n") >= share * F.col("n_pages")).groupBy("host").agg(F.collect_list("block").alias("common")))


def running_tops(blocks: list[tuple[int, int]]) -> list[tuple]:
    """For each k, the LONGEST longest of the first k blocks, longest first."""
    out, top = [()], ()
    for block in blocks:
        if len(top) < LONGEST or block > top[-1]:
            top = tuple(sorted({*top, block}, reverse=True)[:LONGEST])
        out.append(top)
    return out


def surroundings(blocks: list[tuple[int, int, int]], trees: list[tuple[int, int, int]], common: set[int]) -> list[list[int]]:
    """``blocks``: (hash, length, root bits), ``trees``: (part, begin, end).
    For each tree the hash of the set of the longest blocks around it, and
    these blocks if they are two or more."""
    tops: dict[int, tuple[list, list]] = {}
    out = []
    for part, begin, end in trees:
        if part not in tops:
            own = [(n, h) if h not in common and (not part or bits & part) else (0, 0) for h, n, bits in blocks]
            tops[part] = running_tops(own), running_tops(own[::-1])
        before, after = tops[part]
        best = sorted({*before[begin], *after[len(blocks) - end]} - {(0, 0)}, reverse=True)[:LONGEST]
        found = [h for _, h in best]
        out.append([sum(found) & HASH, *(found if len(found) > 1 else ())])
    return out


def site_templates(pages: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """host, outer and inner (arrays of hashes): the subtrees that recur in
    many surroundings on the host, outside and inside articles."""
    parsed = materialise(parse_pages(pages), "parsed-pages")
    common = materialise(common_blocks(parsed, limits.common_share), "common-blocks")

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict = {"host": [], "hash": [], "inside": [], "around": []}
        for row in batch.to_pylist():
            blocks = list(zip(row["blocks"], row["lengths"], row["bits"]))
            every = 0
            for _, _, bits in blocks:
                every |= bits
            root = next((ROOT_BITS[r] for r in ROOTS if every & ROOT_BITS[r]), 0)
            trees = [(0, 0, 0), (root, 0, 0), *zip(row["parts"], row["begins"], row["ends"])]
            out["host"] += [row["host"]] * len(trees)
            out["hash"] += [None, None, *row["hashes"]]  # the null hash counts contents: of the page, of its articles
            out["inside"] += [False, True, *row["inside"]]
            out["around"] += surroundings(blocks, trees, set(row["common"] or ()))
        return out

    values = (arrow_map(parsed.join(common, "host", "left"), rows, "host string, hash long, inside boolean, around array<long>")
              .select("host", "hash", "inside", F.size("around").alias("size"), F.posexplode("around").alias("at", "value"))
              .withColumn("whole", F.col("at") == 0))
    weight = F.when(F.col("size") == 1, 1.0).otherwise(F.when(F.col("whole"), -1.0).otherwise(1.0) / (F.col("size") - 2))
    counts = (values.groupBy("host", "hash", "inside", "size", "whole", "value").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("host", "hash", "inside").agg(F.sum(F.when(F.col("whole"), F.col("n"))).alias("n"), F.sum(weight).alias("n_around")))
    counts = materialise(counts.filter(F.col("hash").isNull() | (F.col("n") >= limits.min_pages)
                                       & (F.col("n_around") >= limits.min_contents)), "subtree-counts")
    totals = counts.filter("hash IS NULL").select("host", "inside", F.col("n_around").alias("n_contents"))

    def many(min_pages: int, share: float) -> Column:
        return ((F.col("n") >= min_pages) & (F.col("n_around") >= F.least(F.lit(min_pages), F.col("n_contents")))
                & (F.col("n_around") >= share * F.col("n_contents")))

    recur = F.when(F.col("inside"), many(limits.inner_min_pages, limits.inner_share)).otherwise(many(limits.min_pages, limits.share))
    return (counts.filter("hash IS NOT NULL").join(totals, ["host", "inside"]).filter(recur).groupBy("host")
            .agg(F.collect_list(F.when(~F.col("inside"), F.col("hash"))).alias("outer"),
                 F.collect_list(F.when(F.col("inside"), F.col("hash"))).alias("inner")))


def extract_text(pages: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    templates = materialise(site_templates(pages, limits), "site-templates")

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict = {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": [], "n_chars": []}
        for html, outer, inner in zip(batch.column("html"), batch.column("outer").to_pylist(), batch.column("inner").to_pylist()):
            text = Page(html.as_py() or "", frozenset(outer or ()), frozenset(inner or ())).main_text()
            out["text"].append(text)
            out["n_chars"].append(len(text))
        return out

    return arrow_map(page_rows(pages).join(templates, "host", "left").drop("host"), rows,
                     "page_id long, url string, text string, n_chars long")
