"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` bytes (the last may be longer by half). Each passage is
described by the shares of byte kinds and of pairs of coarse kinds and by how varied its words are,
encoded as h = tanh(W x), weighted by gated attention a = softmax(w'(tanh(V h) * sigmoid(U h))) over
the bag, and the text's score is sigmoid(c'(sum a h) + b). Only documents carry labels; which passages matter
is learned from them. Training is full-batch Adam from a fixed seed, in NumPy.

Bound, for the classifier alone: ``MAX_ROWS`` labelled rows a class, those of lowest hash, and of
these as many as hold ``MAX_BYTES``, very long texts last (see ``op7_toxicity.sample``); every row is scored over its whole text. Labels, language,
source and id are no inputs of a score.

Null and empty texts are a bag of one all-zero passage and get a score too. Repeated rows and null
ids are scored like any other row, and a null id is not held out; labels of a null id, null labels and ids with contradictory
labels are left out of training. With a class missing from training, all scores are 0.5.
Columns beyond the named ones are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import run_hashes, slices, table
from .op7_toxicity import sample

PASSAGE, HIDDEN, GATE, STEPS, RATE = 1024, 24, 12, 250, 0.02
MAX_ROWS, MAX_BYTES = 3000, 12 << 20


def kinds() -> tuple[np.ndarray, np.ndarray]:
    """Byte to one of 48 kinds, and kind to one of 8 coarse kinds (lower, upper, digit, blank, line
    end, full stop or comma, other sign, beyond ASCII)."""
    fine, coarse = np.full(256, 47, np.uint8), np.full(48, 6, np.uint8)
    fine[97:123], fine[65:91], fine[48:58] = 0, 1, 2
    fine[[32, 9]], fine[[10, 13]] = 3, 4
    signs = [c for c in range(33, 127) if not chr(c).isalnum()]
    fine[signs] = 8 + np.arange(len(signs))
    fine[[ord("."), ord(",")]] = 5
    fine[128:192], fine[192:256] = 6, 7
    coarse[[0, 1, 2, 3, 4, 5, 6, 7]] = [0, 1, 2, 3, 4, 5, 7, 7]
    return fine, coarse


FINE, COARSE = kinds()
N_FINE, N_COARSE = 48, 8
WIDTH = N_FINE + N_COARSE**2 + 6
_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) ^ np.uint64(0x2545F4914F6CDD1D)


def passages(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, first passage of each text with the number of all at the end)."""
    size = np.diff(offs)
    many = np.maximum(1, (size + PASSAGE // 2) // PASSAGE)
    bag = np.concatenate([[0], np.cumsum(many)])
    total = int(bag[-1])
    x = np.zeros((total, WIDTH))
    if not len(data):
        return x, bag
    # passages end every PASSAGE bytes of a text, the last at its end
    of = np.repeat(np.arange(len(size)), many)
    head = offs[of] + (np.arange(total) - bag[of]) * PASSAGE
    tail = np.append(head[1:], len(data))
    tail[bag[1:] - 1] = offs[1:]
    p = np.repeat(np.arange(total), tail - head)
    fine = FINE[data]
    n = np.bincount(p, minlength=total).astype(np.float64)
    part = np.maximum(n, 1)[:, None]
    x[:, :N_FINE] = np.bincount(p * N_FINE + fine, minlength=total * N_FINE).reshape(total, N_FINE) / part
    c = COARSE[fine].astype(np.int64)
    same = p[1:] == p[:-1]
    pair = (p[1:] * N_COARSE**2 + c[:-1] * N_COARSE + c[1:])[same]
    x[:, N_FINE : N_FINE + N_COARSE**2] = np.bincount(pair, minlength=total * N_COARSE**2).reshape(total, -1) / part
    # words: runs without blanks within a passage
    solid = (c != 3) & (c != 4)
    begin = solid.copy()
    begin[1:] &= ~(solid[:-1] & same)
    at = np.flatnonzero(begin)
    if len(at):
        h = run_hashes(np.where(solid, _BYTE[data], np.uint64(0)), at)
        wp = p[at]
        words = np.bincount(wp, minlength=total).astype(np.float64)
        bits = np.uint64(64 - max(16, int(total).bit_length()))

        def runs(of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """(passage, times) of each distinct word of a passage; by one sort of packed keys."""
            key = np.sort((of.astype(np.uint64) << bits) | (h >> (np.uint64(64) - bits)))
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            return (key[start] >> bits).astype(np.int64), np.diff(np.append(start, len(key)))

        h *= np.uint64(0xFF51AFD7ED558CCD)
        own, times = runs(wp, h)
        most = np.zeros(total)
        np.maximum.at(most, own, times)
        near = wp[1:] == wp[:-1]
        again = (h[1:] == h[:-1]) & near
        both, _ = runs(wp[1:][near], ((h[1:] ^ (h[:-1] >> np.uint64(7))) * np.uint64(0xC4CEB9FE1A85EC53))[near])
        w = np.maximum(words, 1)
        base = N_FINE + N_COARSE**2
        x[:, base] = np.bincount(own, minlength=total) / w
        x[:, base + 1] = most / w
        x[:, base + 2] = np.bincount(wp[1:], again, total) / w
        x[:, base + 3] = np.bincount(both, minlength=total) / w
        x[:, base + 4] = np.log1p(n / w)
        x[:, base + 5] = np.log1p(words) / 6
    return x, bag


class Model:
    """Parameters, scaling and the forward and backward passes."""

    def __init__(self, width: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        g = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"W": g(width, HIDDEN), "d": np.zeros(HIDDEN), "V": g(HIDDEN, GATE), "U": g(HIDDEN, GATE), "w": g(GATE), "c": g(HIDDEN), "b": np.zeros(1)}
        self.mean, self.scale = np.zeros(width), np.ones(width)

    def forward(self, x: np.ndarray, bag: np.ndarray):
        p = self.p
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(z @ p["W"] + p["d"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        of = np.repeat(np.arange(len(bag) - 1), np.diff(bag))
        e = np.exp(e - np.maximum.reduceat(e, bag[:-1])[of])
        a = e / np.add.reduceat(e, bag[:-1])[of]
        m = np.add.reduceat(a[:, None] * h, bag[:-1])
        y = 1 / (1 + np.exp(-np.clip(m @ p["c"] + p["b"], -30, 30)))
        return y, (z, h, t, s, a, m, of)

    def train(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> None:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            p = self.p
            out, (z, h, t, s, a, m, of) = self.forward(x, bag)
            do = (out - y) * weight
            g = {"b": do.sum(keepdims=True), "c": m.T @ do}
            dm = do[:, None] * p["c"]
            da = (h * dm[of]).sum(1)
            de = a * (da - np.add.reduceat(a * da, bag[:-1])[of])
            g["w"] = (t * s).T @ de
            dg = de[:, None] * p["w"]
            dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
            g["V"], g["U"] = h.T @ dt, h.T @ ds
            dh = (a[:, None] * dm[of] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
            g["W"], g["d"] = z.T @ dh, dh.sum(0)
            for k in p:
                u, v = moment[k]
                gr = g[k] + 1e-4 * p[k]
                u[...] = 0.9 * u + 0.1 * gr
                v[...] = 0.999 * v + 0.001 * gr * gr
                p[k] = p[k] - RATE * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", held_mod: int = 3, held_rest: int = 1) -> Model | None:
    rows = sample(docs, labels, label_col, id_col, text_col, held_mod, held_rest, MAX_ROWS, MAX_BYTES)
    if rows is None:
        return None

    def run(batches):
        for batch, data, offs in slices(batches, "text"):
            x, bag = passages(data, offs)
            n = np.diff(bag)
            lists = pa.ListArray.from_arrays(pa.array(bag * WIDTH, pa.int32()), pa.array(x.ravel().astype(np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array(n.astype(np.int32)), lists], names=["id", "y", "n", "x"])

    got = rows.select(F.col("id").cast("string").alias("id"), "y", "text").select("id", "y", "text").mapInArrow(run, "id string, y int, n int, x array<float>").toPandas()
    got = got.sort_values("id", ignore_index=True)
    model = Model(WIDTH)
    x = np.concatenate([np.asarray(v, np.float64) for v in got["x"]]).reshape(-1, WIDTH)
    model.train(x, np.concatenate([[0], np.cumsum(got["n"])]), got["y"].to_numpy().astype(np.float64))
    return model


def score(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``; all other columns pass through."""
    docs = docs.drop(out)
    if model is None:
        return docs.withColumn(out, F.lit(0.5))
    names = docs.columns
    frame = docs.withColumn("__text", F.col(text_col).cast("string"))

    def run(batches):
        for batch, data, offs in slices(batches, "__text", 2 << 20):
            got = model.forward(*passages(data, offs))[0]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(got)], names=[*names, out])

    return frame.mapInArrow(run, docs.withColumn(out, F.lit(0.0)).schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
