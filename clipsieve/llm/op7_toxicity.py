"""Toxicity by class-conditional Kneser-Ney models.

Texts are folded to 64 symbols (letters without case, one digit, white space, punctuation,
UTF-8 continuation bytes; lead bytes are left out, so that an accented letter is one symbol). Each class has an interpolated
Kneser-Ney model of order ``ORDER`` over the symbols of a word, whose contexts begin with the word, with
continuation counts of the class down to order 4 and below that one shared model whose continuation counts
come from all documents, labelled or not, so that expressions rare in a class are smoothed
by what the whole corpus knows; its discount is estimated from the corpus' counts of counts. A symbol's log-likelihood ratio is toxic against ordinary; where
an n-gram is new to both classes, the ratio of the backoff weights and the ratio one order
below are left, and below order 4 the shared part cancels.

Toxic documents are ordinary but for a few words, so their model of a word mixes the two: (1 - e) ordinary + e toxic. The
log-likelihood ratio of this against ordinary, summed over the words and divided by their number, leads the score, for two
values of e; beside it stand the sum over the root of the number, the number and share of words of a high ratio, and the highest ratios.
A logistic curve over these, fitted on labelled rows that the counts have not seen, gives the score. Words end
after ``LONGEST`` symbols, so that texts without blanks have words too.

Bounds, for the classifier alone: ``MAX_ROWS`` labelled rows a class, those of lowest hash, and of
these as many as hold ``MAX_BYTES``; a text of over a ``SHARE``-th of those bytes comes after all others, shortest
first, and only if it fits whole (of a class of such texts alone, the shortest is taken). The shared counts cover every document and have at most
64**4 keys. Labels, language, source and id are no inputs of a score.

Null and empty texts have no symbol and get the score of an all-zero ratio. Repeated rows and null
ids are scored like any other row, and a null id is not held out; labels of a null id, null labels and ids with contradictory
labels are left out of training. With a class missing from training, all scores are 0.5 less a bit
(predicted 0). Columns beyond the named ones are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, forget, slices, table

ORDER, HIGH, DISCOUNT, LONGEST = 7, 4.0, 0.75, 24
#: Shares of toxic words that the model of toxic documents assumes.
SHARES = 0.003, 0.03
FEATURES = 8
MAX_ROWS, MAX_BYTES, SHARE = 4000, 12 << 20, 16
PAD = ORDER - 1


def fold_table() -> np.ndarray:
    """Byte to one of 64 symbols."""
    t = np.full(256, 30, np.uint8)
    for c in range(26):
        t[97 + c] = t[65 + c] = c + 1
    t[[9, 10, 11, 12, 13, 32]] = 0
    t[48:58] = 27
    t[[ord(".")]], t[[ord(",")]] = 28, 29
    t[128:192] = 32 + (np.arange(64) & 31)
    return t


FOLD = fold_table()


def symbols(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded texts, each after PAD blanks, and the place of each text's first symbol and of its end."""
    n = len(offs) - 1
    keep = data < 192
    offs = np.concatenate([[0], np.cumsum(keep)])[offs]
    folded = FOLD[data[keep]]
    s = np.zeros(len(folded) + PAD * n, np.uint8)
    at = offs[:-1] + PAD * np.arange(1, n + 1)
    end = at + np.diff(offs)
    for i in range(n):
        s[at[i] : end[i]] = folded[offs[i] : offs[i + 1]]
    return s, at, end


def in_word(s: np.ndarray) -> np.ndarray:
    """How many symbols each place is after the last blank before it."""
    at = np.arange(len(s))
    last = np.maximum.accumulate(np.where(s == 0, at, 0))
    return at - np.concatenate([last[:1], last[:-1]])


def grams(s: np.ndarray, order: int) -> np.ndarray:
    """At each place, the key of the n-gram that ends there; what is before the word counts as blank."""
    wide = np.int64 if order > 5 else np.int32
    key = s.astype(wide)
    for k in range(1, order):
        key[k:] |= s[:-k].astype(wide) << wide(6 * k)
    return key & ((wide(1) << (6 * np.clip(in_word(s), 1, order)).astype(wide)) - wide(1))


def inside(s: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which places are symbols of texts and not padding."""
    edge = np.zeros(len(s) + 1, np.int8)
    np.add.at(edge, at, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


def shared_counts(docs: DataFrame, text_col: str) -> tuple[np.ndarray, float]:
    """(how many symbols precede each 3-gram of the corpus, the discount n1 / (n1 + 2 n2) of its 4-grams).

    4-grams of all documents are counted in each task before the shuffle; the driver gets counts of the 64**3 3-grams."""

    def run(batches):
        total = np.zeros((16, 64**4 // 16), np.uint32)  # a task reads a few input blocks
        for _, data, offs in slices(batches, "text", 1 << 20):
            s, at, end = symbols(data, offs)
            if len(s):
                key = grams(s, 4)[inside(s, at, end)]
                high = key >> 20
                for part in np.unique(high):  # counts of a part at a time need little room
                    total[part] += np.bincount(key[high == part] & (2**20 - 1), minlength=2**20).astype(np.uint32)
        total = total.ravel()
        hit = np.flatnonzero(total)
        for lo in range(0, len(hit), 200_000):
            k = hit[lo : lo + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(total[k].astype(np.int64))], names=["key", "n"])

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "key int, n long").groupBy("key").agg(F.sum("n").alias("n"))
    below = counts.groupBy(F.col("key").bitwiseAND(64**3 - 1).alias("key")).agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") == 2).alias("two")).toArrow()
    kinds = np.zeros(64**3)
    kinds[below["key"].to_numpy()] = below["kinds"].to_numpy()
    one, two = (int(below[c].to_numpy().sum()) for c in ("one", "two"))
    return kinds, one / (one + 2 * two) if one and two else DISCOUNT


def shared_model(kinds: np.ndarray, discount: float = DISCOUNT) -> np.ndarray:
    """P(symbol | 2 before) for all 64**3 keys: Kneser-Ney, interpolated down to the uniform."""
    conts = [kinds]
    for w in (2, 1):  # continuation counts: kinds of symbols seen before
        conts.append((conts[-1].reshape(64, 64**w) > 0).sum(0).astype(np.float64))
    p = np.full(1, 1 / 64)
    for c in reversed(conts):
        c = c.reshape(-1, 64)
        low = np.broadcast_to(p, (64, p.size)).reshape(-1, 64) if p.size > 1 else np.full((1, 64), p[0])
        n, some = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            q = np.maximum(c - discount, 0) / n + discount * some / n * low
        p = np.where(n > 0, q, low).reshape(-1)
    return p


def class_counts(rows: DataFrame) -> pd.DataFrame:
    """(key, t, o): the ORDER-grams of rows (text, toxic), by class."""

    def run(batches):
        for batch, data, offs in slices(batches, "text", 1 << 20):
            s, at, end = symbols(data, offs)
            if not len(s):
                continue
            ok = inside(s, at, end)
            toxic = np.repeat(np.asarray(batch.column(1).to_pylist(), np.int64), end - at)
            key, n = np.unique(grams(s, ORDER)[ok] << 1 | toxic, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key >> 1), pa.array(np.where(key & 1, n, 0)), pa.array(np.where(key & 1, 0, n))], names=["key", "t", "o"])

    got = rows.select("text", "toxic").mapInArrow(run, "key long, t long, o long").groupBy("key").agg(F.sum("t").cast("int").alias("t"), F.sum("o").cast("int").alias("o")).toArrow()
    at = np.argsort(got["key"].to_numpy())
    return pd.DataFrame({c: got[c].to_numpy()[at] for c in ("key", "t", "o")})


def ratio_tables(counts: pd.DataFrame, shared: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For orders ORDER down to 4: (n-gram keys, their ratio, context keys, the ratio of their backoff weights)."""
    levels = {ORDER: (counts["key"].to_numpy(), {c: counts[c].to_numpy() for c in ("t", "o")})}
    for order in range(ORDER - 1, 3, -1):
        key, where = np.unique(levels[order + 1][0] & (64**order - 1), return_inverse=True)
        levels[order] = (key, {c: np.bincount(where, n > 0, len(key)) for c, n in levels[order + 1][1].items()})
    out: list = []
    below, p_below = np.arange(64**3), {"t": shared, "o": shared}
    for order in range(4, ORDER + 1):
        key, by = levels[order]
        ctx, where = np.unique(key >> 6, return_inverse=True)
        low = np.searchsorted(below, key & (64 ** (order - 1) - 1))
        p, lam = {}, {}
        for c, n in by.items():
            total, kinds = np.bincount(where, n, len(ctx)), np.bincount(where, n > 0, len(ctx))
            with np.errstate(divide="ignore", invalid="ignore"):
                lam[c] = np.where(total > 0, DISCOUNT * kinds / total, 1.0)
                p[c] = np.where(total[where] > 0, np.maximum(n - DISCOUNT, 0) / total[where], 0) + lam[c][where] * p_below[c][low]
        out.append((key, np.log(p["t"] / p["o"]).astype(np.float32), ctx, np.log(lam["t"] / lam["o"]).astype(np.float32)))
        below, p_below = key, p
    return out[::-1]


def find(keys: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of k in the sorted keys, and which are there."""
    if not len(keys):
        return np.zeros(len(k), np.int64), np.zeros(len(k), bool)
    i = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
    return i, keys[i] == k


class Scorer:
    """Features of texts under the ratio tables, which are searched as they are: hash tables over them would take several times their room."""

    def __init__(self, tables):
        self.levels = tables

    def ratios(self, key: np.ndarray) -> np.ndarray:
        key, where = np.unique(key, return_inverse=True)
        r = np.zeros(len(key), np.float32)
        left = np.arange(len(key))
        for order, (keys, val, ctxs, back) in zip(range(ORDER, 3, -1), self.levels, strict=True):
            k = key[left] & (64**order - 1)
            i, hit = find(keys, k)
            r[left[hit]] += val[i[hit]]
            left, k = left[~hit], k[~hit]
            j, hit = find(ctxs, k >> 6)
            r[left[hit]] += back[j[hit]]
        return r[where]

    def features(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        n = len(offs) - 1
        out = np.zeros((n, FEATURES))
        s, at, end = symbols(data, offs)
        if not len(s):
            return out
        ok = inside(s, at, end)
        begins = np.flatnonzero(ok & (s != 0) & (in_word(s) % LONGEST == 1))
        full = np.flatnonzero(np.searchsorted(begins, end) > np.searchsorted(begins, at))
        if not len(full):
            return out
        word = np.add.reduceat(np.where(ok, self.ratios(grams(s, ORDER)), 0), begins, dtype=np.float64)
        first, last = np.searchsorted(begins, at[full]), np.searchsorted(begins, end[full])
        many = last - first
        odds = np.exp(np.clip(word, -20, 20))
        total = lambda x: np.add.reduceat(x, first, dtype=np.float64)
        mean = [total(np.log1p(e * (odds - 1))) / many for e in SHARES]
        high = total(word > HIGH)
        order = np.lexsort((-word, np.repeat(np.arange(len(full)), many)))
        top = [np.where(many > k, word[order[np.minimum(first + k, last - 1)]], np.nan) for k in range(3)]
        out[full] = np.column_stack([*mean, mean[0] * np.sqrt(many), np.log1p(high), high / many, total(word > HIGH / 2) / many, np.nanmean(top, axis=0), top[0]])
        return out


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method with a small ridge: (mean, scale, weights with the intercept last)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + 0.05 * w
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(len(w))
        w -= np.linalg.solve(h, g)
    return mean, scale, w


def curve(x: np.ndarray, fit) -> np.ndarray:
    mean, scale, w = fit
    return 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, held_mod: int, held_rest: int, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame | None:
    """(id, text, y, part) of the bounded training sample, or None if a class has no row; part counts 0 to 2."""
    spark = docs.sparkSession
    lab = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
    lab = lab.where(F.crc32(F.col("id").cast("string")) % held_mod != held_rest).groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z")
    chosen = [lab.where(F.col("y") == c).orderBy(F.xxhash64("id"), "id").limit(max_rows) for c in (0, 1)]
    ids = spark.createDataFrame(chosen[0].unionByName(chosen[1]).toArrow())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    here = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(F.broadcast(ids), "id")
    size = here.groupBy("id", "y").agg(F.max(F.octet_length("text")).alias("n")).orderBy(F.xxhash64("id"), "id").toPandas()  # at most 2 * max_rows
    big = size["n"] > max_bytes // SHARE
    size = size.assign(big=big, late=size["n"].where(big, 0)).sort_values(["big", "late"], kind="stable")
    size["sum"] = size.groupby("y")["n"].cumsum()
    size = size[(size["sum"] <= max_bytes) | ~size["big"] & (size["sum"] - size["n"] < max_bytes) | (size["sum"] == size["n"])]
    if size["y"].nunique() < 2:
        return None
    kept = spark.createDataFrame(pa.Table.from_pandas(size[["id", "y"]], preserve_index=False))
    once = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(F.broadcast(kept), "id")
    once = once.groupBy("id", "y").agg(F.max("text").alias("text"))
    return once.withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(3)))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", held_mod: int = 5, held_rest: int = 0):
    """(broadcast ratio tables, logistic curve), or None if a class has no labelled row."""
    rows = sample(docs, labels, label_col, id_col, text_col, held_mod, held_rest, MAX_ROWS, MAX_BYTES)
    if rows is None:
        return None
    rows = durable(rows.withColumnRenamed("y", "toxic").select("text", "toxic", "part"))
    tables = ratio_tables(class_counts(rows.where("part > 0")), shared_model(*shared_counts(docs, text_col)))
    model = docs.sparkSession.sparkContext.broadcast(tables)
    del tables
    pa.default_memory_pool().release_unused()
    names = [f"x{k}" for k in range(FEATURES)]

    def run(batches):
        scorer = Scorer(model.value)
        for batch, data, offs in slices(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(x) for x in scorer.features(data, offs).T)], names=["y", *names])

    unseen = rows.where("part = 0").select("text", "toxic").mapInArrow(run, "y int, " + ", ".join(f"{x} double" for x in names)).toPandas()
    forget(docs.sparkSession, rows.inputFiles())
    if unseen["y"].nunique() < 2:
        weights = np.zeros(FEATURES + 1)
        weights[-2:] = 1.0, -HIGH
        return model, (np.zeros(FEATURES), np.ones(FEATURES), weights)
    unseen = unseen.sort_values(["y", *names])
    return model, logistic(unseen[names].to_numpy(), unseen["y"].to_numpy())


def score(docs: DataFrame, model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``; all other columns pass through. The model's size is bounded and it is broadcast."""
    docs = docs.drop(out)
    if model is None:
        return docs.withColumn(out, F.lit(math.nextafter(0.5, 0)))
    tables, fitted = model
    names = docs.columns
    frame = docs.withColumn("__text", F.col(text_col).cast("string"))

    def run(batches):
        scorer = Scorer(tables.value)
        for batch, data, offs in slices(batches, "__text", 1 << 19):
            got = curve(scorer.features(data, offs), fitted)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(got)], names=[*names, out])

    return frame.mapInArrow(run, docs.withColumn(out, F.lit(0.0)).schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
