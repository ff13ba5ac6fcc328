"""Main text of web pages: page structure plus a host suffix array (operator 9).

1. Each page becomes a stream of text blocks.  Scripts, styles, forms, menus,
   headers, footers, side bars, notices, adverts and comments are left out by
   element, role, state and class name.  Blocks inside ``article`` or ``main``
   belong to the page's text.
2. All other blocks, beside an article or on a page without one, are undecided
   and go through the host's suffix array: every suffix of a page's token stream
   (all blocks, decided or not), cut at ``run`` tokens, is a key of its host,
   equal keys are brought together by the shuffle and reduced to their first and
   last page with partial aggregation; undecided tokens covered by a key of two
   distinct pages are boilerplate and go, the unique runs stay.  A block beside
   an article that is shorter than a key goes if it stands on another page as
   it is.  Pages with equal streams count as one page.  Hosts without an
   undecided block need no keys.

Keys are spread by host *and* suffix, so a host with a third of all pages is
split over all tasks.  Special cases: null or empty html gives an empty text;
a missing url is a host of its own; broken or truncated markup is read as far
as it goes; an empty table gives an empty result; clashing columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.llm.vectors import stored

# HTML elements by their role in a page.
RAW = frozenset("script style noscript template svg iframe object canvas textarea select head title".split())
TO_THE_END = frozenset(["script", "style"])  # without an end tag these hold the rest of the page
CHROME = frozenset("nav aside footer form dialog menu button audio video".split())
BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(["article", "main"])
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CHROME_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
    "notification popup modal overlay newsletter subscribe signup sidebar aside nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs footer masthead toolbar pagination pager comment comments commentlist disqus respond reply replies share "
    "sharing social related recommended widget login search skip".split()
)

# Inside an article a class or id marks page furniture only on these elements,
# when the whole name is one of CHROME_NAMES, alone or followed by one of these words.
HOLDERS = frozenset("div section ul ol dl table span".split())
HOLDER_WORDS = frozenset(
    "area bar block box buttons container content form icons inner links list panel posts section slot thread unit widget wrap wrapper".split()
)

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*))(?:>|\Z)", re.S)
ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


BLOCK_TAG = re.compile(rf"(?=</?(?:{'|'.join(sorted(BLOCK))})\b)", re.I)
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")  # a slash of its own, not the end of an unquoted value


def _named_chrome(name: str, value: str, in_article: bool) -> bool:
    """Whether a class or id marks page furniture.  Outside articles any word of a name
    does; inside, only whole names on elements that hold others."""
    if not in_article:
        return not CHROME_NAMES.isdisjoint(re.split(r"[\s_-]+", value))
    if name not in HOLDERS:
        return False
    for one in value.split():
        first, *rest = re.split(r"[_-]+", one)
        if first in CHROME_NAMES and all(w in HOLDER_WORDS or w in CHROME_NAMES or w.isdigit() for w in rest):
            return True
    return False


def _is_chrome(name: str, attrs: str, in_article: bool = False) -> bool:
    if name in CHROME:
        return True
    if not attrs or name in ("body", "html"):
        return False
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value in ROLES:
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key in ("class", "id") and _named_chrome(name, value, in_article):
            return True
    return False


def page_blocks(page: str) -> list[tuple[str, bool]]:
    """(block, whether it is inside article or main), in page order."""
    blocks: list[tuple[str, bool]] = []
    parts: list[str] = []
    depth = 0  # open article / main elements
    skip, skipped = "", 0  # element being left out and its depth

    def flush():
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((text, depth > 0))
            parts.clear()

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if not skip:
            parts.append(html_lib.unescape(page[at : m.start() if m else n]))  # references end with their text node
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        alone = bool(SELF_CLOSED.search(m[3]))
        if name in RAW and not closing and not (alone and name == "svg"):
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if name == "head" and not end:
                end = re.compile(r"(?=<body\b)", re.I).search(page, at)
            elif not end and name not in TO_THE_END:
                end = BLOCK_TAG.search(page, at)  # a missing end tag hides no more than its own block
            at = end.end() if end else at if name == "head" else n
            continue
        if skip:
            if name == skip:
                skipped += -1 if closing else name not in VOID and not alone
                if skipped == 0:
                    skip = ""
            elif name in MAIN and not closing and not depth and not _is_chrome(name, m[3]):
                skip = ""  # an unclosed menu does not hide the article
            if skip or closing:
                continue
        if not closing and name not in VOID and (_is_chrome(name, m[3], depth > 0) or name == "header" and not depth):
            flush()
            if not alone:
                skip, skipped = name, 1
            continue
        if name == "br":
            parts.append(" ")
        elif name in BLOCK:
            flush()
            if name in MAIN:
                depth = max(0, depth + (-1 if closing else 1))
    if not skip:
        flush()
    return blocks


def read_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """One row per page: (_page, _url, blocks array, inside array: which blocks are decided)."""

    def run(batches):
        for batch in batches:
            found = [page_blocks(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([[text for text, _ in f] for f in found], pa.list_(pa.string())),
                    pa.array([[decided for _, decided in f] for f in found], pa.list_(pa.bool_())),
                ],
                names=["_page", "_url", "blocks", "inside"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, f"_page {kinds[id_col]}, _url {kinds[url_col]}, blocks array<string>, inside array<boolean>"
    )


FEW_HOSTS = 100_000
UNDECIDED = "exists(inside, d -> NOT d)"


def boilerplate(streams: DataFrame, run: int) -> DataFrame:
    """(_page, _url, _bad array) of pages with undecided blocks: first positions of ``run``-token
    strings that stand on two distinct pages of the host, and -1, -2 .. for its first, second ..
    block where that is shorter and stands on two pages."""
    host = F.lower(F.coalesce(F.try_parse_url("_url", F.lit("HOST")), F.lit("")))
    own = streams.withColumn("_host", host).withColumn("_open", F.expr(UNDECIDED))
    hosts = own.where("_open").select("_host").distinct()
    few = hosts.limit(FEW_HOSTS + 1).count() <= FEW_HOSTS  # sent to all tasks: the texts of other hosts are not shuffled
    own = own.join(F.broadcast(hosts) if few else hosts, "_host", "left_semi")
    tokens = own.where(F.size("blocks") > 0).select(
        "_page", "_url", "_host", "_open", "blocks",
        F.xxhash64("blocks", "inside").alias("_same"),
        F.split(F.array_join("blocks", " "), " ").alias("_w"),
    )
    keys = F.transform(F.sequence(F.lit(1), F.size("_w") - run + 1), lambda i: F.array_join(F.slice("_w", i, run), " "))
    long = tokens.where(F.size("_w") >= run).select("_page", "_url", "_same", "_open", "_host", F.posexplode(keys).alias("_at", "_suffix"))
    short = tokens.select("_page", "_url", "_same", "_open", "_host", F.posexplode("blocks").alias("_k", "_suffix"))
    short = short.where(F.size(F.split("_suffix", " ")) < run).withColumn("_at", -1 - F.col("_k"))
    suffixes = long.unionByName(short.drop("_k")).select(
        "_page", "_url", "_same", "_open", "_at", "_host",
        F.xxhash64("_suffix", F.col("_at") < 0).alias("_a"), F.xxhash64(F.lit(run), "_suffix").alias("_b"),
    )
    repeated = (
        suffixes.groupBy("_host", "_a", "_b")
        .agg(F.min("_same").alias("_x"), F.max("_same").alias("_y"))
        .where(F.col("_x") != F.col("_y"))
        .select("_host", "_a", "_b")
    )
    return (
        suffixes.where("_open").join(repeated, ["_host", "_a", "_b"])
        .groupBy("_page", "_url", "_same")
        .agg(F.collect_set("_at").alias("_bad"))
    )


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = 8
) -> DataFrame:
    """One row per page: id, url, text (blocks joined by an empty line), n_chars."""
    streams = stored(read_pages(pages, id_col, url_col, html_col), "page-blocks")  # pages are parsed once
    undecided = streams.where(UNDECIDED)
    bad = boilerplate(streams, run)

    def unique_runs(batches):
        for batch in batches:
            texts = []
            for blocks, inside, starts in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4))):
                covered = {s + k for s in starts or () if s >= 0 for k in range(run)}
                gone = {-1 - s for s in starts or () if s < 0} if any(inside) else ()
                out, at = [], 0
                for n, (b, decided) in enumerate(zip(blocks, inside)):
                    words = b.split(" ")
                    kept = b if decided else "" if n in gone else " ".join(w for k, w in enumerate(words) if at + k not in covered)
                    at += len(words)
                    if kept:
                        out.append(kept)
                texts.append("\n\n".join(out))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[id_col, url_col, "text"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    same = F.xxhash64("blocks", "inside")
    u, b = undecided.withColumn("_same", same).alias("u"), bad.alias("b")
    rest = (
        u.join(
            b,
            F.col("u._page").eqNullSafe(F.col("b._page"))
            & F.col("u._url").eqNullSafe(F.col("b._url"))
            & (F.col("u._same") == F.col("b._same")),
            "left",
        )
        .select("u._page", "u._url", "u.blocks", "u.inside", "b._bad")
        .mapInArrow(unique_runs, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string")
    )
    done = streams.where(f"NOT {UNDECIDED}").select(
        F.col("_page").alias(id_col), F.col("_url").alias(url_col), F.array_join("blocks", "\n\n").alias("text")
    )
    return done.unionAll(rest).withColumn("n_chars", F.char_length("text").cast("long"))
