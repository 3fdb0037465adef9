"""N-gram Jaccard join by chosen paths.

A document is the set of its shingles of ``N`` words (fewer words: the one run of all). Documents
of equal sets share one key. In each run a set chooses tokens whose hash falls below
1/(t |set|); sets that chose a token share a bucket. Buckets of over ``SMALL`` sets are split again by tokens chosen with
hashes of the path, ``DEPTH`` levels deep; small buckets, and the last level in blocks, are compared pairwise by
MinHash signatures, with a wide margin, and give a star of candidate edges each, not all pairs. A pair of
similarity t chooses one common token a run and path at least, on average, so it is lost in a run with the chance that a
branching of Poisson(1) dies out within ``DEPTH`` levels. Runs are repeated until the chance to lose a pair in all of them is below
1 - ``RECALL``, reckoned as if every bucket were split to the last level.

Candidate components are then resolved exactly: the sets of each are compared all with all, in
blocks of ``BLOCK``, every pair once, on their full shingles. So all links inside a component are found whichever
run joined it, links are counted and not written as pairs, and the classes are the components of exact links.

Result: one row per document with the class id (least id of its class) and the number of other texts it
is linked to: texts that differ in any byte are different, also where their sets are equal (a set has the weight of its texts). Null and empty texts, and texts without a word, are linked to nothing and are a class each. Rows with a null id take part;
a class of such rows alone has a null id. Repeated rows each give their row. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, run_hashes, slices, spread, table
from .components import components

N, SMALL, BLOCK, SIGNATURE, DEPTH, RECALL = 5, 48, 512, 48, 3, 0.999


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met in a bucket of the last level with this chance."""
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(lost - 1)
    return math.ceil(math.log(1 - recall) / math.log(lost))


RUNS = runs_for(RECALL, DEPTH)
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


_BYTE = mix(np.arange(1, 257, dtype=U))
_PLACE = mix(np.arange(101, 101 + N, dtype=U)) | U(1)
_RUN = mix(np.arange(1001, 1001 + RUNS, dtype=U))
_SIG = mix(np.arange(5001, 5001 + SIGNATURE, dtype=U)) | U(1)
#: Letters, digits and all bytes beyond ASCII are parts of words.
_SOLID = np.zeros(256, bool)
_SOLID[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def shingle_sets(data: np.ndarray, offs: np.ndarray):
    """For each text (in lower case) the sorted distinct shingle hashes."""
    n = len(offs) - 1
    solid = _SOLID[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    heads = offs[:-1][np.diff(offs) > 0]
    begin[heads] = solid[heads]
    at = np.flatnonzero(begin)
    if not len(at):
        return [np.zeros(0, U)] * n
    h = mix(run_hashes(np.where(solid, _BYTE[data], U(0)), at))
    first = np.searchsorted(at, offs)
    runs = np.zeros(len(h), U)
    for k in range(min(N, len(h))):
        runs[: len(h) - k] += h[k:] * _PLACE[k]
    runs = mix(runs)
    out = []
    for i in range(n):
        lo, hi = first[i], first[i + 1]
        if hi - lo >= N:
            out.append(np.unique(runs[lo : hi - N + 1]))
        elif hi > lo:
            out.append(mix((h[lo:hi] * _PLACE[: hi - lo]).sum(keepdims=True) ^ U(hi - lo)))
        else:
            out.append(np.zeros(0, U))
    return out


def set_key(x: np.ndarray) -> bytes:
    return mix(x).sum().tobytes() + mix(x ^ U(0x5851F42D4C957F2D)).sum().tobytes()


def signature(x: np.ndarray) -> bytes:
    return ((x[:, None] * _SIG) ^ ((x[:, None] * _SIG) >> U(32))).min(0).astype(np.uint16).tobytes() if len(x) <= 20_000 else np.min([signature_block(b) for b in np.array_split(x, len(x) // 20_000 + 1)], axis=0).astype(np.uint16).tobytes()


def signature_block(x: np.ndarray) -> np.ndarray:
    return ((x[:, None] * _SIG) ^ ((x[:, None] * _SIG) >> U(32))).min(0)


def paths(x: np.ndarray, threshold: float) -> list:
    """[(bucket, [(bucket, [bucket])])]: chosen tokens of each run, of each path of one, of each path of two."""
    limit = U(min(2**64 - 1, int(2**64 / (threshold * len(x)))))

    def choose(nodes: np.ndarray):
        which, token = [], []
        step = max(1, 200_000 // len(x))
        for lo in range(0, len(nodes), step):
            a, b = np.nonzero(mix(x[None, :] ^ nodes[lo : lo + step, None]) < limit)
            which.append(a + lo)
            token.append(x[b])
        which, token = np.concatenate(which), np.concatenate(token)
        return which, mix(token + nodes[which] * U(3))

    w1, n1 = choose(_RUN)
    if not len(n1):
        return []
    w2, n2 = choose(n1)
    w3, n3 = choose(n2) if len(n2) else (np.zeros(0, np.int64), np.zeros(0, U))
    s = lambda v: int(v.astype(np.int64))
    third: list = [[] for _ in n2]
    for i, v in zip(w3, n3, strict=True):
        third[i].append(s(v))
    second: list = [[] for _ in n1]
    for j, (i, v) in enumerate(zip(w2, n2, strict=True)):
        second[i].append({"b": s(v), "kids": third[j]})
    return [{"b": s(v), "kids": k} for v, k in zip(n1, second, strict=True)]


LEAVES = "array<struct<b:long,kids:array<struct<b:long,kids:array<long>>>>>"
LEAF_TYPE = pa.list_(pa.struct([("b", pa.int64()), ("kids", pa.list_(pa.struct([("b", pa.int64()), ("kids", pa.list_(pa.int64()))])))]))


def lowered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text in lower case, hash of the text as it stands)"""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.lower(text).alias("text"), F.xxhash64(text).alias("th"))


def sketched(docs: DataFrame, threshold: float) -> DataFrame:
    """(id, text hash, key, sig, leaves) of each document; key is null without a word."""

    def run(batches):
        for batch, data, offs in slices(batches, "text", 1 << 20):
            keys, sigs, leaves, seen = [], [], [], set()
            for x in shingle_sets(data, offs):
                key = set_key(x) if len(x) else None
                again = key is None or key in seen  # sketched once a slice; the first row of a key stands for all
                seen.add(key)
                keys.append(key)
                sigs.append(None if again else signature(x))
                leaves.append(None if again else paths(x, threshold))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), pa.array(leaves, LEAF_TYPE)], names=["id", "th", "key", "sig", "leaves"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, th long, key binary, sig binary, leaves {LEAVES}")


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each member's component under the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def grouped(batches, by: int):
    """Whole groups of rows, as one batch each, from batches sorted by the first ``by`` columns."""
    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        diff = np.zeros(batch.num_rows - 1, bool)
        for c in range(by):
            v = batch.column(c).to_numpy(zero_copy_only=False)
            diff |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(diff) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(lo, hi - lo)
            if held and any(held[-1].column(c)[held[-1].num_rows - 1].as_py() != part.column(c)[0].as_py() for c in range(by)):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]


def pair_blocks(members: DataFrame, group: Column, size: Column, block: int) -> DataFrame:
    """Deals each group to pairs of blocks of about ``block`` rows: columns i <= j and which of the two a row is of."""
    blocks = F.greatest(F.lit(1), F.ceil(size / block)).cast("int")
    own = F.pmod(F.xxhash64("key", F.lit(13)), blocks).cast("int")
    d = members.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    return d.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": F.col("own")})


def candidate_edges(reps: DataFrame, threshold: float) -> DataFrame:
    """(a, b): stars of sets that met in a bucket and whose signatures agree."""
    margin = threshold - 4 * math.sqrt(threshold * (1 - threshold) / SIGNATURE)
    level = reps.select("key", F.explode("leaves").alias("x")).select("key", F.col("x.b").alias("bucket"), F.col("x.kids").alias("kids"))
    met = []
    for depth in (1, 2, 3):
        size = level.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        level = durable(level.join(size, "bucket"))
        last = depth == 3
        met.append((level if last else level.where(F.col("size") <= SMALL)).select("key", "bucket", "size"))
        if not last:
            kid = level.where(F.col("size") > SMALL).select("key", F.explode("kids").alias("x"))
            level = kid.select("key", F.col("x.b").alias("bucket"), F.col("x.kids").alias("kids")) if depth == 1 else kid.select("key", F.col("x").alias("bucket"), F.lit(None).cast("array<long>").alias("kids"))
    rows = met[0].unionByName(met[1]).unionByName(met[2]).distinct()
    rows = pair_blocks(rows, F.col("bucket"), F.col("size"), BLOCK).select("bucket", "i", "j", "side", "key")
    rows = rows.join(reps.select("key", "sig"), "key").select("bucket", "i", "j", "side", "key", "sig")

    def run(batches):
        a, b = [], []
        for g in grouped(batches, 3):
            if g.num_rows < 2:
                continue
            side = g.column(3).to_numpy()
            sig = np.frombuffer(b"".join(g.column(5).to_pylist()), np.uint16).reshape(g.num_rows, SIGNATURE)
            i, j = g.column(1)[0].as_py(), g.column(2)[0].as_py()
            n = g.num_rows
            p, q = [], []
            for lo in range(0, n, 64):
                u, v = np.nonzero((sig[lo : lo + 64, None, :] == sig[None, :, :]).mean(2) >= margin)
                p.append(lo + u)
                q.append(v)
            p, q = np.concatenate(p), np.concatenate(q)
            if i == j:
                label, ends = stars(n, p[p != q], q[p != q]), np.arange(n)
            else:  # each block's own links come from where it is compared with itself; here one edge joins two of their stars
                same = side[p] == side[q]
                inner = stars(n, p[same], q[same])
                label, ends = stars(n, inner[p[~same]], inner[q[~same]]), np.unique(inner)
            for k in ends[label[ends] != ends]:
                a.append(g.column(4)[int(k)])
                b.append(g.column(4)[int(label[k])])
            if len(a) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array([v.as_py() for v in x], pa.binary()) for x in (a, b)], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array([v.as_py() for v in x], pa.binary()) for x in (a, b)], names=["a", "b"])

    n = spread(reps.sparkSession)
    return rows.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(run, "a binary, b binary")


def agree(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, tenths: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (left, right) with Jaccard similarity of at least tenths/1000; exact, in whole numbers."""
    size = np.array([len(s) for s in sets])
    if len(left) * len(right) <= 16:
        got = [(i, j) for i in left for j in right if i != j and 1000 * (c := len(np.intersect1d(sets[i], sets[j], assume_unique=True))) >= tenths * (size[i] + size[j] - c)]
        return np.array([g[0] for g in got], np.int64), np.array([g[1] for g in got], np.int64)
    row = np.repeat(np.arange(len(sets)), size)
    kinds, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    common = np.zeros((len(left), len(right)), np.float32)
    at = np.full(len(sets), -1), np.full(len(sets), -1)
    at[0][left], at[1][right] = np.arange(len(left)), np.arange(len(right))
    for lo in range(0, len(kinds), 2048):
        r, t = (v[np.searchsorted(token, lo) : np.searchsorted(token, lo + 2048)] for v in (row, token))
        m = [np.zeros((len(s), 2048), np.float32) for s in (left, right)]
        for k in (0, 1):
            ok = at[k][r] >= 0
            m[k][at[k][r[ok]], t[ok] - lo] = 1
        common += m[0] @ m[1].T
    c = np.rint(common).astype(np.int64)
    p, q = np.nonzero(1000 * c >= tenths * (size[left][:, None] + size[right][None, :] - c))
    p, q = left[p], right[q]
    return p[p != q], q[p != q]


def exact_links(members: DataFrame, threshold: float) -> DataFrame:
    """(key, hub, links) for each set and pair of blocks it was compared in, links the weights of the sets it is linked to;
    members has label, size, key, weight, text."""
    tenths = round(threshold * 1000)

    def tokens(batches):
        for batch, data, offs in slices(batches, "text", 1 << 20):
            sets = shingle_sets(data, offs)
            keep = pa.array([set_key(x) == k for x, k in zip(sets, batch.column(2).to_pylist(), strict=True)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([x.tobytes() for x in sets], pa.binary())], names=["label", "size", "key", "weight", "tokens"]).filter(keep)

    sets = members.select("label", "size", "key", "weight", "text").mapInArrow(tokens, "label binary, size long, key binary, weight long, tokens binary")
    rows = pair_blocks(sets, F.col("label"), F.col("size"), BLOCK).select("label", "i", "j", "side", "key", "tokens", "weight")

    def run(batches):
        for g in grouped(batches, 3):
            keys = g.column(4).to_pylist()
            if len(set(keys)) < len(keys):  # repeated rows
                g = g.take(pa.array(sorted({k: n for n, k in enumerate(keys)}.values())))
                keys = g.column(4).to_pylist()
            side = g.column(3).to_numpy()
            sets = [np.frombuffer(t, U) for t in g.column(5).to_pylist()]
            i, j = g.column(1)[0].as_py(), g.column(2)[0].as_py()
            left, right = (np.arange(len(sets)),) * 2 if i == j else (np.flatnonzero(side == i), np.flatnonzero(side == j))
            p, q = agree(sets, left, right, tenths) if len(left) and len(right) else (np.zeros(0, np.int64),) * 2
            weight = g.column(6).to_numpy()
            links = np.bincount(p, weight[q], len(sets)) + (np.bincount(q, weight[p], len(sets)) if i != j else 0)
            yield pa.RecordBatch.from_arrays([g.column(4), pa.array([keys[k] for k in stars(len(sets), p, q)], pa.binary()), pa.array(links.astype(np.int64))], names=["key", "hub", "links"])

    n = spread(members.sparkSession)
    return rows.repartition(n, "label", "i", "j").sortWithinPartitions("label", "i", "j").mapInArrow(run, "key binary, hub binary, links long")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """(id, class_id, n_links) of every row."""
    return classed(docs, id_col, text_col, threshold).drop("th")


def classed(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(id, text hash, class_id, n_links) of every row."""
    low = lowered(docs, id_col, text_col)
    sets = durable(sketched(low, threshold))
    reps = durable(sets.where("leaves IS NOT NULL").select("key", "sig", "leaves").dropDuplicates(["key"]))
    near = components(candidate_edges(reps, threshold))
    near = durable(near.join(near.groupBy("label").agg(F.count("*").alias("size")), "label"))
    # one document for each set of a component stands for it
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    texts_of = sets.where("key IS NOT NULL").groupBy("key", "th").agg(F.min(name).alias("name"))
    heads = durable(texts_of.groupBy("key").agg(F.min(F.struct("name", "th")).alias("s"), F.count("*").alias("weight")))
    stands = heads.join(near.withColumnRenamed("node", "key"), "key")
    texts = low.withColumn("name", name).drop("id").join(stands.select("key", "label", "size", "weight", "s.name", "s.th"), ["name", "th"])
    found = durable(exact_links(texts, threshold))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("key").alias("a"), F.col("hub").alias("b"))).withColumnRenamed("node", "key")
    links = heads.join(links, "key", "left").select("key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")).where("links > 0")
    marked = sets.select("id", "th", "key").join(links, "key", "left").join(classes, "key", "left")
    marked = marked.select("id", "th", "key", F.coalesce("label", "key").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    least = marked.where("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("class_id"))
    out = marked.join(least, "label", "left")
    return out.select(F.col("id").alias(id_col), "th", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.col("links").alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their text's class; rows with a null id stay."""
    gone = classed(docs, id_col, text_col, threshold).where(F.col("class_id") != F.col(id_col)).select(F.col(id_col).alias("__gone"), F.col("th").alias("__th")).distinct()
    return docs.join(gone, (F.col(id_col) == F.col("__gone")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__th")), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))
