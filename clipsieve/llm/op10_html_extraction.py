"""HTML main-text extraction with a site style tree.

Pages of one host are merged into one tree: a node is a path of elements with their classes, with the
child sequences (presentation) and texts (content) seen there and how often. Every element is in it, page
furniture and articles too; inline elements are part of their parent's presentation and text, as a block is the least that is removed. A node's importance is
the larger of the entropies of its presentations and of its texts over the distinct pages of the host (copies
of a page count once), each over the logarithm of the times the node occurs: 0 where all pages of the host look and read the same, 1 where all differ. Branches that
occur at least ``MIN_SEEN`` times with an importance under ``LOW`` are removed from each page.

If a page has an article or main element, its text is what lies inside. Nodes inside are counted over the host's distinct
articles, so that one article on many pages is no furniture, and a branch around an article is not removed, as what it holds is judged itself.
Headings and parts of a list or table that recur from article to article stay or go with the branch around them. Where
the branches would take half of an article's text or more, it is a near copy of others and stays whole.

Blocks of elements named or classed as page furniture go whatever their importance: a site of few pages says little about them, and
rotating menus and adverts are as varied as articles.

Character references are decoded once, white space inside a block becomes one space, inline
elements and line breaks do not end a block; blocks are joined by one line feed in page order.

A null or empty html has the empty text. Pages without a host (null or odd url) are judged alone.
Repeated rows and null ids each give their row. Other columns are not read. Unclosed elements end
with their parent; an unclosed script, style or comment runs to the end of the page.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, slices, table

MIN_SEEN, LOW = 8, 0.3
#: Hosts with removable branches are broadcast while all their branches number at most this many.
BROADCAST_NODES = 200_000

#: Element and class names with a meaning of their own.
ROOT = {"html", "body"}
PARTS = set("h1 h2 h3 h4 h5 h6 li dt dd thead tbody tfoot tr th td caption figcaption".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
RAW = "script|style|noscript|template|iframe|svg|textarea|title|object|canvas|math|select"
FURNITURE = set("head nav header footer aside form button dialog menu fieldset".split())
CLASSES = set(
    """ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored comment comments commentlist disqus reply replies respond
    sidebar side-bar widget menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer site-footer page-footer header site-header
    page-header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay share sharing social related recommended
    newsletter subscribe subscription signup login search search-form skip toolbar tags byline copyright legal disclaimer""".split()
)
CONTENT = {"article", "main"}
PLAIN = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tr td th section figure figcaption div".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}


def name_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def parse(page: str) -> tuple[list, list, list]:
    """(blocks, elements, inner): blocks are (mark, hashes of the element paths that can take it away, text), mark 1 inside
    article or main, else 0, and only those inside if there are any, without furniture; elements are (path hash, presentation hash, text hash)
    of all elements, inner those of article, main and what is inside them but furniture."""
    blocks: list = []
    elements: list = []
    inner: list = []
    said: list[str] = []  # texts of all blocks, for the elements' text hashes
    open_: list = [["", 0, 0, None, [], 0]]  # name, path hash, mark, (path hash, those around it), children, first text
    buf: list[str] = []

    def flush() -> None:
        if buf:
            text = " ".join(entities.unescape("".join(buf)).split())
            buf.clear()
            if text:
                paths, at = [], open_[-1][3]
                while at:
                    paths.append(at[0])
                    at = at[1]
                blocks.append((open_[-1][2], paths, text))
                said.append(text)

    def close(n: int) -> None:
        """Ends the innermost elements until n are open."""
        flush()
        while len(open_) > n:
            _, path, mark, _, children, first = open_.pop()
            (inner if mark == 1 else elements).append((path, name_hash(" ".join(children)), name_hash("\n".join(said[first:]))))

    last = 0
    for m in TOKEN.finditer(page):
        if m.start() > last:
            buf.append(page[last : m.start()])
        last = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            if m[1]:
                buf.append(" ")
            continue
        attrs = m[4] or m[7] or ""
        if m[2] or m[5]:
            at = next((i for i in range(len(open_) - 1, 0, -1) if open_[i][0] == name), 0)
            if at:
                close(at)
            elif name == "p" or name not in INLINE:
                flush()
            continue
        words = [w for a in ATTR.findall(attrs) for w in (a[1] or a[2] or a[3]).lower().split()] if "=" in attrs else []
        bad = name in FURNITURE or any(w in CLASSES or w in ROLES for w in words)
        if name in INLINE and not bad:
            open_[-1][4].append(name)
            if name in ("br", "img", "wbr"):
                buf.append(" " if name == "br" else "")
            continue
        flush()
        if name in VOID:
            open_[-1][4].append(name)
            continue
        shut = CLOSES.get(name)
        for i in range(len(open_) - 1, 0, -1):
            if open_[i][0] == "p" and (name in PLAIN or name in FURNITURE or name in CONTENT) or shut and open_[i][0] in shut:
                close(i)
            elif open_[i][0] not in INLINE:
                break
        top = open_[-1]
        if name in CONTENT and top[2] != -1:
            mark = -1 if bad else 1
        elif name == "header" and top[2] == 1 and not any(w in CLASSES for w in words):
            mark = 1  # an article's own heading
        else:
            mark = -1 if bad or top[2] == -1 else top[2]
        label = name + "".join("." + w for w in words if not any(c.isdigit() for c in w))
        path = name_hash(f"{top[1]}/{label}")
        top[4].append(label)
        # a branch around an article may not take its text away, nor may the root or a recurring heading, cell or item
        around = top[3] if mark != 1 or top[2] == 1 else None
        open_.append([name, path, mark, around if name in ROOT or mark == 1 and name in PARTS else (path, around), [], len(said)])
    if last < len(page):
        buf.append(page[last:])
    close(1)
    inside = any(b[0] == 1 for b in blocks)
    blocks = [b for b in blocks if b[0] == 1 or b[0] == 0 and not inside]
    return blocks, elements, inner


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).withColumn("page", F.xxhash64("html"))
    node = pa.list_(pa.struct([("path", pa.int64()), ("shape", pa.int64()), ("said", pa.int64())]))
    kinds = pa.list_(pa.struct([("mark", pa.int8()), ("paths", pa.list_(pa.int64())), ("text", pa.string())])), pa.list_(pa.struct([("page", pa.int64()), ("elements", node)]))

    def named(elements: list) -> list:
        return [{"path": p, "shape": s, "said": t} for p, s, t in elements]

    def run(batches):
        for batch, _, _ in slices(batches, "html"):
            got = [parse(h or "") for h in batch.column(2).to_pylist()]
            blocks = pa.array([[{"mark": m, "paths": ps, "text": t} for m, ps, t in b] for b, _, _ in got], kinds[0])
            # the articles of a page are judged as a page of their own, named by what they hold
            trees = [[(p, e), (name_hash(repr(i)), i)] for p, (_, e, i) in zip(batch.column(3).to_pylist(), got, strict=True)]
            trees = pa.array([[{"page": p, "elements": named(e)} for p, e in t if e] for t in trees], kinds[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), blocks, trees], names=["id", "url", "blocks", "trees"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, url string, blocks array<struct<mark:tinyint,paths:array<long>,text:string>>, trees array<struct<page:long,elements:array<struct<path:long,shape:long,said:long>>>>")


def low_nodes(rows: DataFrame) -> DataFrame:
    """(host, low): the path hashes of each host's unimportant branches. Counts are summed in each task first.

    A page that a host has ``copies`` times is counted that often and divided by it, so that only the repeated pages' hashes are joined."""
    pages = rows.where("host IS NOT NULL").select("host", F.explode("trees").alias("t")).select("host", "t.page", "t.elements")
    again = durable(pages.groupBy(F.col("host").alias("h"), F.col("page").alias("p")).agg(F.count("*").alias("copies")).where("copies > 1"))
    few = again.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    pages = pages.join(F.broadcast(again) if few else again, (F.col("host") == F.col("h")) & (F.col("page") == F.col("p")), "left")
    e = pages.select("host", F.coalesce("copies", F.lit(1)).alias("copies"), F.explode("elements").alias("e")).select("host", "copies", "e.path", "e.shape", "e.said")
    views = e.select("host", "copies", "path", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("shape").alias("v")), F.struct(F.lit(1).alias("k"), F.col("said").alias("v")))).alias("x"))
    n = views.groupBy("host", "path", "x", "copies").count().groupBy("host", "path", "x").agg(F.sum(F.expr("count div copies")).alias("count")).groupBy("host", "path", "x.k")
    share = n.agg(F.sum("count").alias("m"), F.sum(F.col("count") * F.log("count")).alias("nlogn")).where(F.col("m") >= MIN_SEEN)
    entropy = (F.log("m") - F.col("nlogn") / F.col("m")) / F.log("m")
    nodes = share.groupBy("host", "path").agg(F.max(entropy).alias("importance")).where(F.col("importance") < LOW)
    return nodes.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("low"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    host = F.nullif(F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    rows = durable(parsed(pages, id_col, url_col, html_col).withColumn("host", host))
    low = durable(low_nodes(rows))
    few = low.select(F.explode("low")).limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    full = rows.drop("trees").join(F.broadcast(low) if few else low, "host", "left")
    left = F.filter("blocks", lambda b: ~F.coalesce(F.arrays_overlap(b.paths, F.col("low")), F.lit(False)))
    size = lambda bs: F.aggregate(bs, F.lit(0).cast("long"), lambda n, b: n + F.length(b.text))
    near = (F.get("blocks", F.lit(0))["mark"] == 1) & (size(left) * 2 <= size(F.col("blocks")))
    keep = F.when(near, F.col("blocks")).otherwise(left)
    text = F.array_join(F.transform(keep, lambda b: b.text), "\n")
    return full.withColumn("text", text).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
