"""Main text of web pages, without the template of their site.

Every block element outside a page's article is a subtree with a hash of its
markup. The hashes are counted per host over all pages; a subtree that recurs
on many pages of its host belongs to the site's template, and its text is
deleted. Elements whose tag, role, class or id name a menu, header, footer,
sidebar, notice, advert, form, script or comment list are left out on any page.

Where a page marks its article (``article``, ``main`` or role ``main``), the
article's own blocks are its text, less containers (``div``, lists, tables) that
recur there with many different texts of the host. Copies of an article have
one text, and near copies share more than half of it, so neither are a template;
nor is a paragraph or heading, which articles may quote. Elsewhere the body's
blocks count, less the template, and so they do beside a marked element that
holds only a small part of the text (a teaser or a comment).

Pages are parsed once, each on its own, into a stored table. Hash counts are
summed per task before they are shuffled, so a hot host or subtree sends one
row per task.

Null or empty html gives the empty text. Null urls share one empty host.
Repeated rows give repeated results. An empty table gives an empty result.
Extra columns are ignored. Unclosed and stray tags are tolerated.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import by_value, slices, stored

by_value(__name__)

# A subtree is template from so many pages of its host on, if it is on this share of them.
MIN_PAGES = 5
MIN_SHARE = 0.3
# On so many pages it is one whatever their share.
MANY_PAGES = 100
# A marked element with less than this share of the text isn't all of the article.
MAIN_SHARE = 0.2
# Template blocks hold this share of an article at most; where more recurs it is a near copy.
INNER_SHARE = 0.5

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
ROOTS = frozenset("html body article main".split())
CONTAINERS = frozenset("center details div dl ol section table ul".split())
BOILERPLATE = frozenset(
    "head nav header footer aside form menu dialog button select option fieldset object canvas svg math audio video "
    "map applet".split()
) | RAW
# Words of a class, id or role that name something other than the article.
NAMES = frozenset(
    "nav navbar navigation navi menu menubar breadcrumb breadcrumbs header masthead footer contentinfo colophon sidebar "
    "aside complementary notice notices cookie cookies consent gdpr banner alert ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion comment comments commentlist reply replies respond disqus form search "
    "login signup signin subscribe newsletter popup modal overlay dialog share sharing social related recommended widget "
    "toolbar pagination pager skip".split()
)
# An open element of these is closed by the start of one of the others.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NOT_IN_P = frozenset(
    "address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr li main menu nav ol p pre section table td th tr ul".split()
)

TAG = re.compile(
    r"<!--(?:.*?-->|.*+\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:\s]*)")


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower().rstrip(".") if found else ""


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html_lib.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def left_out(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element is no part of the article by its tag, role, class, id, or because it is hidden."""
    if tag in BOILERPLATE:
        return True
    if tag in ROOTS or not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return True
    named = f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}"
    return any(part.lower() in NAMES for part in NAME_PARTS.findall(named))


class Page:
    """Blocks of text of one page, and the subtrees outside and inside its article.

    ``blocks``: (text, whether in the article, hashes of the subtrees around it,
    on its side of the article's border); ``subtrees``: hashes of all block
    elements outside the article; ``inner``: of the containers inside.
    """

    def __init__(self, html: str):
        self.html = html
        self.blocks: list[tuple[str, bool, list[int]]] = []
        self.subtrees: list[int] = []
        self.inner: list[int] = []
        # Open elements: [tag, start, left out, in article, number of the first block inside].
        self.open: list[list] = []
        self.text: list[str] = []
        self.parse()

    def parse(self) -> None:
        html, at = self.html, 0
        while True:
            found = TAG.search(html, at)
            if found is None:
                break
            self.add(html[at : found.start()])
            at = found.end()
            tag = (found[2] or found[5] or "").lower()
            if not tag:
                continue
            if found[1] or found[4]:
                self.end(tag, found.start(), at)
                continue
            self.start(tag, found[3] or found[6] or "", found.start())
            if tag in RAW:
                closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
                at = closing.start() if closing else len(html)
        self.add(html[at:])
        while self.open:
            self.close(len(html))
        self.flush()

    def add(self, text: str) -> None:
        if text and not (self.open and self.open[-1][2]):
            self.text.append(text)

    def flush(self) -> None:
        """End the block of text gathered so far."""
        if self.text:
            text = " ".join(html_lib.unescape("".join(self.text)).split())
            self.text.clear()
            if text:
                self.blocks.append((text, bool(self.open and self.open[-1][3]), []))

    def start(self, tag: str, attrs: str, at: int) -> None:
        if tag in INLINE and not attrs:
            if tag == "br":
                self.add(" ")
            elif tag not in VOID:
                self.open.append([tag, at, *(self.open[-1][2:4] if self.open else (False, False)), len(self.blocks)])
            return
        if tag in NOT_IN_P:
            self.close_open({"p"}, {"div", "article", "section", "main", "td", "li", "body", "aside", "form"}, at)
        if tag in CLOSES:
            self.close_open(*CLOSES[tag], at)
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            if tag == "br":
                self.add(" ")
            return
        found = attributes(attrs) if attrs.strip(" /\n\t") else {}
        out, inside = self.open[-1][2:4] if self.open else (False, False)
        out = out or left_out(tag, found)
        inside = inside or not out and (tag in ("article", "main") or found.get("role", "").lower() == "main")
        if out and tag in INLINE:
            self.flush()
        self.open.append([tag, at, out, inside, len(self.blocks)])

    def close_open(self, tags: set[str], within: set[str], at: int) -> None:
        """Close the innermost open element of ``tags``, unless one of ``within`` is around it first."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                while len(self.open) > i:
                    self.close(at)
                return
            if self.open[i][0] in within:
                return

    def end(self, tag: str, at: int, after: int) -> None:
        if any(x[0] == tag for x in self.open):
            while self.open[-1][0] != tag:
                self.close(at)
            self.close(after)

    def close(self, at: int) -> None:
        tag, start, out, inside, first = self.open[-1]
        if tag not in INLINE:
            if not out:
                self.flush()
            # A root is the page, not a part of it.
            if tag not in ROOTS and (not inside or tag in CONTAINERS and not out and len(self.blocks) > first):
                mark = xxhash.xxh3_64_intdigest(self.html[start:at].encode("utf-8", "surrogatepass"), seed=int(inside)) - 2**63
                (self.inner if inside else self.subtrees).append(mark)
                for block in self.blocks[first:]:
                    if block[1] == inside:
                        block[2].append(mark)
        self.open.pop()


PARSED = (
    "uid long, page_id long, url string, host string, main boolean, text string, "
    "blocks array<struct<text:string,inside:boolean,marks:array<long>>>, subtrees array<long>, inner array<long>, digest long"
)


def parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page: its article's text, or its blocks with the subtrees around them where templates can change it."""
    marks = pa.list_(pa.int64())
    schema = pa.schema([
        ("uid", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("main", pa.bool_()),
        ("text", pa.string()), ("blocks", pa.list_(pa.struct([("text", pa.string()), ("inside", pa.bool_()), ("marks", marks)]))),
        ("subtrees", marks), ("inner", marks), ("digest", pa.int64()),
    ])
    for batch in batches:
        for part, texts in slices(batch, "html"):
            rows = []
            keys = zip(part.column("page_id").to_pylist(), part.column("url").to_pylist(), texts)
            for page_id, url, raw in keys:
                page = Page(raw.decode("utf-8", "replace"))
                own = sum(len(t) for t, inside, _ in page.blocks if inside)
                main = own > 0 and not page.inner and own >= MAIN_SHARE * sum(len(t) for t, _, _ in page.blocks)
                uid = xxhash.xxh3_64_intdigest(f"{page_id}\n{url}\n".encode() + raw) - 2**63
                text = "\n".join(t for t, inside, _ in page.blocks if inside)
                rest = [] if main else [{"text": t, "inside": i, "marks": m} for t, i, m in page.blocks]
                digest = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63
                rows.append({
                    "uid": uid, "page_id": page_id, "url": url, "host": host_of(url), "main": main, "text": text if main else "",
                    "blocks": rest, "subtrees": sorted(set(page.subtrees)), "inner": sorted(set(page.inner)), "digest": digest,
                })
            yield pa.RecordBatch.from_pylist(rows, schema)


def count_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, mark, pages) of what a task reads, in parts of bounded size; mark NULL counts the host's pages."""
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        keys = list(counts)
        return pa.RecordBatch.from_pydict({
            "host": pa.array([k[0] for k in keys], pa.string()), "mark": pa.array([k[1] for k in keys], pa.int64()),
            "pages": pa.array(list(counts.values()), pa.int64()),
        })

    for batch in batches:
        for host, marks in zip(batch.column("host").to_pylist(), batch.column("subtrees").to_pylist()):
            counts[(host, None)] += 1
            counts.update((host, m) for m in marks)
        if len(counts) > 200_000:
            yield out()
            counts.clear()
    yield out()


def site_templates(parsed: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, mark) of the subtrees that recur on many pages of their host."""
    counted = parsed.select("host", "subtrees").mapInArrow(count_marks, "host string, mark long, pages long")
    summed = counted.groupBy("host", "mark").agg(F.sum("pages").alias("pages"))
    # One row per (host, mark) that is on enough pages, and one row per host.
    summed = stored(summed.filter(col("mark").isNull() | (col("pages") >= min_pages)), "html-counts")
    hosts = summed.filter(col("mark").isNull()).select("host", col("pages").alias("_all"))
    outer = summed.filter(col("mark").isNotNull())
    # Inside articles different texts are counted, not pages: copies are one.
    articles = parsed.select("host", "digest").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("_all"))
    inner = parsed.select("host", "digest", F.explode("inner").alias("mark")).distinct().groupBy("host", "mark").agg(F.count(F.lit(1)).alias("pages"))
    enough = (col("pages") >= min_pages) & ((col("pages") >= min_share * col("_all")) | (col("pages") >= MANY_PAGES))
    found = [side.join(total, "host").filter(enough).select("host", "mark") for side, total in ((outer, hosts), (inner, articles))]
    return found[0].unionByName(found[1])


def chosen_text(blocks: list[dict], deleted: set[int]) -> str:
    """The text of a page, less the subtrees to be deleted."""
    keep = [not deleted.intersection(b["marks"]) for b in blocks]
    size = [len(b["text"]) for b in blocks]
    own = sum(n for n, b in zip(size, blocks) if b["inside"])
    left = sum(n for n, b, k in zip(size, blocks, keep) if b["inside"] and k)
    if left < (1 - INNER_SHARE) * own:
        keep = [k or b["inside"] for k, b in zip(keep, blocks)]
        left = own
    total = sum(n for n, k in zip(size, keep) if k)
    alone = left > 0 and left >= MAIN_SHARE * total
    return "\n".join(b["text"] for b, k in zip(blocks, keep) if k and (b["inside"] or not alone))


def choose_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        deleted = batch.column("_deleted").to_pylist()
        texts = [chosen_text(b, set(d or ())) for b, d in zip(batch.column("blocks").to_pylist(), deleted)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text) of every row of (page_id, url, html)."""
    given = pages.select(col("page_id").cast("long"), "url", "html")
    parsed = stored(given.mapInArrow(parse_pages, PARSED), "html-parsed")
    templates = stored(site_templates(parsed, min_pages, min_share), "html-templates")
    whole = parsed.filter("main").select("page_id", "url", "text")
    # Pages that templates can change: their blocks, less those inside a template subtree.
    open_pages = parsed.filter(~col("main"))
    marks = open_pages.select("uid", "host", F.explode("blocks").alias("_b")).select(
        "uid", "host", F.explode("_b.marks").alias("mark")
    ).distinct()
    deleted = marks.join(templates, ["host", "mark"]).groupBy("uid").agg(F.collect_set("mark").alias("_deleted"))
    bare = open_pages.join(deleted, "uid", "left").select("page_id", "url", "blocks", "_deleted")
    bare = bare.mapInArrow(choose_text, "page_id long, url string, text string")
    return whole.unionByName(bare)


def op2_html_text(pages: DataFrame) -> DataFrame:
    return main_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))
