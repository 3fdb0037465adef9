"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions only.

A test item is contained in a document if at least ``threshold`` of its distinct shingles of
``n`` words occur there. An item's sketch is its floor((1 - t) size) + 1 shingles of lowest hash: a document
that contains the item lacks at most floor((1 - t) size) of its shingles, so it holds one of the sketch at least, and the
search misses nothing. Items are partitioned by the binary logarithm of their size. Documents probe the sketches with the
hashes of their shingles, and only those partitions of which they are long enough to contain an item; the pairs that meet
are candidates. Candidates alone are verified, by the exact number of the item's shingles in the whole document.

Words are runs of letters and digits in lower case. Null and empty texts, and items of fewer than
``n`` words, contain and are contained in nothing. A document is an id with a text (by its hash): rows with a
null id, and rows of one id with different texts, are each judged on their own text; repeated rows give one answer
each pair. Items of one id with different texts are judged each, and repeated items once. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, table

#: Sketches, candidate pairs and documents to drop are broadcast while they have at most so many rows; beyond it the joins shuffle.
BROADCAST_ROWS = 500_000
#: Items are broadcast while their shingles count at most this many.
BROADCAST_SHINGLES = 500_000


def shingles(text: Column, n: int) -> Column:
    """Array of the runs of ``n`` words, joined by one space."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    runs = lambda ws: F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - (n - 1), F.lit(0))), lambda w, i: F.concat_ws(" ", w, *[F.get(ws, i + k) for k in range(1, n)]))
    # the one-element array binds the words to a variable, so that they are split once
    return F.flatten(F.transform(F.array(words), runs))


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def small(df: DataFrame, bound: int) -> DataFrame:
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def lacking(size: Column, threshold: float) -> Column:
    """How many of so many shingles may be missing."""
    return F.floor(F.round(F.lit(1 - threshold) * size, 9))


def item_table(items: DataFrame, item_col: str, text_col: str, n: int) -> DataFrame:
    """(item, ih, n_shingles, all, part): one row for each different item of a shingle or more."""
    text = F.col(text_col).cast("string")
    it = items.select(F.col(item_col).alias("item"), text.alias("t")).dropDuplicates()
    it = it.select("item", F.array_distinct(shingles(F.col("t"), n)).alias("all")).where(F.size("all") > 0)
    it = it.withColumn("ih", F.xxhash64("all")).dropDuplicates(["item", "ih"])
    return it.select("item", "ih", F.size("all").alias("n_shingles"), "all", F.floor(F.log2(F.size("all"))).cast("int").alias("part"))


def sketches(it: DataFrame, threshold: float) -> DataFrame:
    """(h, item, ih, least): the sketch of every item, with the size a document needs to contain any item of its partition."""
    size = F.pow(F.lit(2.0), F.col("part"))
    low = F.slice(F.array_sort(F.transform("all", lambda s: F.xxhash64(s))), F.lit(1), (lacking(F.col("n_shingles"), threshold) + 1).cast("int"))
    return it.select("item", "ih", (size - lacking(size, threshold)).cast("int").alias("least"), F.explode(low).alias("h"))


def candidates(docs: DataFrame, sketch: DataFrame, n: int) -> DataFrame:
    """(id, th, item, ih) of the documents (id, th, text) that hold a shingle of an item's sketch and are long enough."""
    # The size is taken before the array is unfolded, so that its rows carry the number and not the array. For a plain explode
    # Spark infers a filter on the array's size and pushes it down to the scan, where the shingles are made a second time.
    probe = docs.select("id", "th", shingles(F.col("text"), n).alias("all")).withColumn("n_doc", F.size("all"))
    probe = probe.select("id", "th", "n_doc", F.explode_outer("all").alias("s")).where("s IS NOT NULL").withColumn("h", F.xxhash64("s"))
    return probe.join(sketch, "h").where("n_doc >= least").select("id", "th", "item", "ih").distinct()


def found(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 5, threshold: float = 0.8) -> DataFrame:
    """(id, text hash, item id, n_hit, n_shingles, containment) of every pair at or above ``threshold``."""
    it = durable(item_table(items, item_col, item_text_col, n))
    docs = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.col(text_col).cast("string").alias("text"))
    met = durable(candidates(docs, small(sketches(it, threshold), BROADCAST_ROWS), n))
    keys = met.select(F.col("id").alias("mid"), F.col("th").alias("mth")).distinct()
    read = docs.join(small(keys, BROADCAST_ROWS), F.col("id").eqNullSafe(F.col("mid")) & (F.col("th") == F.col("mth")), "left_semi").dropDuplicates(["id", "th"])
    read = read.select("id", "th", F.array_distinct(shingles(F.col("text"), n)).alias("has"))
    pairs = met.select(F.col("id").alias("mid"), F.col("th").alias("mth"), "item", "ih")
    few = it.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0] <= BROADCAST_SHINGLES
    own = it.select(F.col("item").alias("iid"), F.col("ih").alias("iih"), "n_shingles", "all")
    pairs = pairs.join(F.broadcast(own) if few else own, F.col("item").eqNullSafe(F.col("iid")) & (F.col("ih") == F.col("iih")))
    both = read.join(pairs, F.col("id").eqNullSafe(F.col("mid")) & (F.col("th") == F.col("mth")))
    both = both.withColumn("n_hit", F.size(F.array_intersect("has", "all")).cast("long")).where(F.col("n_hit") >= F.col("n_shingles") - lacking(F.col("n_shingles"), threshold))
    return both.select(F.col("id").alias(id_col), F.col("th").alias("__th"), F.col("item").alias(item_col), "n_hit", F.col("n_shingles").cast("long").alias("n_shingles"), (F.col("n_hit") / F.col("n_shingles")).alias("containment"))


def contained(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """(id, item id, n_hit, n_shingles, containment) of every pair of a document and an item at or above the threshold."""
    return found(docs, items, **how).drop("__th")


def clean(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` in whose text no item is contained; other rows of the same id, or of a null id, stay."""
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    bad = durable(found(docs, items, **how).select(F.col(id_col).alias("__bad"), "__th").distinct())
    return docs.join(small(bad, BROADCAST_ROWS), F.col(id_col).eqNullSafe(F.col("__bad")) & (text_hash(text_col) == F.col("__th")), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM dw)),
its AS (SELECT DISTINCT item_id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM iw)),
n AS (SELECT item_id, count(*) AS n FROM its GROUP BY 1)
SELECT doc_id, item_id, count(*) AS n_hit, n AS n_shingles, count(*) / n AS containment
FROM ds JOIN its USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n
HAVING count(*) >= n - floor(round((1 - 0.8) * n, 9))
"""
