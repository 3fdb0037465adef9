"""Exact substring dedup by suffix arrays of shards.

Every byte covered by a string of ``WINDOW`` bytes that also starts earlier (smaller id, or same
document and earlier place) is removed; overlaps count, and strings are judged on the input.

1. Each window of 100 bytes is assigned to its anchor, the K-gram of least hash inside it (leftmost of
   equals). Equal windows have equal anchors at equal offsets. The windows of one anchor make a context, a stretch of under 180 bytes.
2. Anchors that occur once are dropped (no window of theirs repeats). Contexts with equal bytes are
   one context with its earliest occurrence; in all others of its occurrences every window repeats.
3. An equal window holds, beside its anchor, the 38 bytes to the left or the 38 to the right in full: an anchor's different
   contexts are dealt to groups by these halves, and those that share neither with another are done. A group goes to one shard, whose
   suffix array is built by induced sorting and its permuted common prefixes computed; neighbours that share 100 bytes are equal windows, and
   all but the earliest of each such class are marked in their context's first occurrence. A group of over ``HOT`` contexts
   is split again in the same way, by half of what a window has left beside the shared stretch, as often as it takes; where nothing
   is left, the stretch is the window.
4. Marked stretches are united and cut out of their document.

Contexts are compared by the 64-bit anchor hash and a 64-bit hash of the whole context (128 bits together); shared stretches by 128 bits.

Null texts are empty; empty and short texts lose nothing. A null id sorts before all others. Rows
with equal id and text are one document and each give the same row; rows of equal id and different text are
different documents in the order of their text's hash. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, forget, out_batch, slices, spread, table
from .induced_sort import Shard

WINDOW, K, HOT = 100, 24, 2_000
#: Bytes of text that one step works on.
SLICE = 1 << 19
SPAN = WINDOW - K + 1  # places an anchor can have in a window
HALF = SPAN // 2
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(29))


_BYTE = mix(np.arange(77, 77 + 256, dtype=U) * U(0x9E3779B97F4A7C15))
_G = U(0x5851F42D4C957F2D)
_BACK = U(pow(0x5851F42D4C957F2D, -1, 2**64))


def anchors(data: np.ndarray, offs: np.ndarray):
    """(document, start, length, anchor offset, anchor hash, context hash, two 32-bit hashes) of each context.

    The last are of the anchor with HALF bytes before and after it, the one before in the high bits, and 0 where
    no window of the context holds them."""
    n = len(data)
    size = np.diff(offs)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, U, U, U))
    if n < WINDOW or size.max(initial=0) < WINDOW:
        return none
    words = np.ndarray((n,), "<u8", np.concatenate([data, np.zeros(32, np.uint8)]).tobytes(), strides=(1,))
    g = n - K + 1
    h = mix(words[:g] * U(0x9E3779B97F4A7C15) + mix(words[8 : 8 + g]) * U(0xBF58476D1CE4E5B9) + mix(words[16 : 16 + g] + U(1)) * U(0x94D049BB133111EB))
    # least of each SPAN places by suffix and prefix minima of blocks; low bits hold the place in the block
    pad = -g % SPAN + SPAN
    low = np.concatenate([h & ~U(127), np.full(pad, ~U(127), U)]).reshape(-1, SPAN) | np.arange(SPAN, dtype=U)
    tail = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1].ravel()
    head = np.minimum.accumulate(low, axis=1).ravel()
    starts = np.arange(n - WINDOW + 1)
    doc = np.repeat(np.arange(len(size)), size)[: len(starts)]
    starts = starts[starts + WINDOW <= offs[doc + 1]]
    a, b = tail[starts], head[starts + SPAN - 1]
    first = (a >> U(7)) <= (b >> U(7))
    block = np.where(first, starts // SPAN, (starts + SPAN - 1) // SPAN)
    at = block * SPAN + (np.where(first, a, b) & U(127)).astype(np.int64)
    doc = doc[starts]
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])))
    s0 = starts[new]
    e = starts[np.append(new[1:], len(starts)) - 1] + WINDOW
    p = at[new]
    sums = np.concatenate([np.zeros(1, U), np.cumsum(_BYTE[data] * np.cumprod(np.full(n, _G, U), dtype=U), dtype=U)])
    back = np.cumprod(np.full(n, _BACK, U), dtype=U)
    # the sum over [a, b) taken back to a power of one, so that the hash depends on the bytes alone
    stretch = lambda a, b: mix((sums[b] - sums[a]) * back[a] + (b - a).astype(U))
    before = np.where(p - HALF >= s0, stretch(np.maximum(p - HALF, 0), p + K) >> U(32) | U(1), U(0))
    after = np.where(p + K + HALF <= e, stretch(p, np.minimum(p + K + HALF, n)) >> U(32) | U(1), U(0))
    return doc[new], s0 - offs[doc[new]], e - s0, p - s0, h[p], stretch(s0, e), before << U(32) | after


def context_table(docs: DataFrame) -> DataFrame:
    """Contexts (h, c, id, th, at, near) with at = start << 16 | length << 8 | anchor offset."""

    def run(batches):
        for batch, data, offs in slices(batches, "text", SLICE):
            doc, start, length, off, h, c, near = anchors(data, offs)
            which = pa.array(doc)
            at = (start << 16) | (length << 8) | off
            yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(c.astype(np.int64)), batch.column(0).take(which), batch.column(1).take(which), pa.array(at), pa.array(near.astype(np.int64))], names=["h", "c", "id", "th", "at", "near"])

    return docs.mapInArrow(run, "h long, c long, id long, th long, at long, near long")


def repeats_in(shard: list[tuple]) -> list[tuple[int, int, int]]:
    """(piece, from, to) of the windows of each piece that are equal to a window of an earlier place.

    ``shard`` holds (document's order key, start, bytes); pieces may overlap, and a window is not earlier than itself."""
    if len(shard) < 2:
        return []
    s = Shard([x[2] for x in shard])
    sa = s.suffix_array()
    prefix = s.common_prefixes(sa)
    whose = np.repeat(np.arange(len(shard)), np.diff(np.append(s.start, s.n)))
    place = {k: i for i, k in enumerate(sorted({x[0] for x in shard}))}
    order = np.array([place[x[0]] << 40 | x[1] for x in shard], np.int64) - s.start
    group = np.cumsum(prefix[sa] < WINDOW) - 1
    fits = sa + WINDOW <= s.ends[whose[sa]]
    places, group = sa[fits], group[fits]
    rank = order[whose[places]] + places
    least = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, group, rank)
    later = places[rank > least[group]]
    if not len(later):
        return []
    later.sort()
    new = np.flatnonzero(np.append(True, (later[1:] != later[:-1] + 1) | (whose[later[1:]] != whose[later[:-1]])))
    last = np.append(new[1:], len(later)) - 1
    w = whose[later[new]]
    return list(zip(w.tolist(), (later[new] - s.start[w]).tolist(), (later[last] - s.start[w] + WINDOW).tolist(), strict=True))


SHARD_BYTES = 1 << 19
#: A piece of a context in a group: where it starts in its document, and where in it the shared stretch starts and stops.
PIECE = [("g", pa.binary()), ("id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("text", pa.binary())]
PIECE_SQL = "g binary, id long, th long, start long, lo int, hi int, text binary"


def pieces(rows: list[tuple]) -> pa.RecordBatch:
    return out_batch(PIECE, *(zip(*rows, strict=True) if rows else [[]] * len(PIECE)))


def piece(key: bytes, d: int | None, th: int, start: int, lo: int, hi: int, text: bytes) -> tuple:
    """The windows around text[lo:hi] as a row of the group of that stretch under the anchor or group ``key``."""
    a, b = max(0, hi - WINDOW), min(len(text), lo + WINDOW)
    return hashlib.blake2b(text[lo:hi], digest_size=16, key=key).digest(), d, th, start + a, lo - a, hi - a, text[a:b]


def shard_marks(groups: DataFrame) -> DataFrame:
    """(id, th, start, stop) of repeated stretches in first occurrences; groups are rows as PIECE has them."""

    def run(batches):
        held: list = []
        size, last = 0, None
        for batch in batches:
            for g, d, th, start, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 3, 6)), strict=True):
                if size > SHARD_BYTES and g != last:
                    yield marks(held)
                    held, size = [], 0
                held.append(((d is not None, d or 0, th), start, text))
                size, last = size + len(text), g
        yield marks(held)

    def marks(held):
        got = []
        for i, lo, hi in repeats_in(held):
            (known, d, th), start, _ = held[i]
            got.append((d if known else None, th, start + lo, start + hi))
        cols = list(zip(*got, strict=True)) if got else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "th", "start", "stop"])

    n = spread(groups.sparkSession)
    return groups.repartition(n, "g").sortWithinPartitions("g").mapInArrow(run, "id long, th long, start long, stop long")


def halved(groups: DataFrame) -> DataFrame:
    """The groups of a finer split: each piece under its stretch with half of a window's rest before it, and after it."""

    def run(batches):
        for batch in batches:
            rows = []
            for g, d, th, start, lo, hi, text in zip(*(batch.column(k).to_pylist() for k in range(len(PIECE))), strict=True):
                step = (WINDOW - (hi - lo) + 1) // 2
                if lo >= step:
                    rows.append(piece(g + b"l", d, th, start, lo - step, hi, text))
                if hi + step <= len(text):
                    rows.append(piece(g + b"r", d, th, start, lo, hi + step, text))
            yield pieces(rows)

    return groups.mapInArrow(run, PIECE_SQL)


def group_marks(groups: DataFrame) -> DataFrame:
    """(id, th, start, stop) of repeated stretches; groups are rows as PIECE has them, with m, the size of the group."""
    marks = shard_marks(groups.where(F.col("m") <= HOT).drop("m"))
    rest = WINDOW - K - HALF
    while rest and not (large := groups.where(F.col("m") > HOT)).isEmpty():
        finer = durable(halved(large.drop("m")))
        shared = durable(finer.groupBy("g").agg(F.count("*").alias("m")).where("m > 1"))
        groups = durable(finer.join(shared, "g"))
        rest //= 2
        if rest:
            marks = marks.unionByName(shard_marks(groups.where(F.col("m") <= HOT).drop("m")))
        else:
            least = groups.groupBy("g").agg(F.min(F.struct("id", "th", "start")).alias("o"))
            later = groups.join(least, "g").where(~F.struct("id", "th", "start").eqNullSafe(F.col("o")))
            marks = marks.unionByName(later.select("id", "th", "start", (F.col("start") + WINDOW).alias("stop")))
    return marks


def keyed(docs: DataFrame, id_col: str, text_col: str, more: list[str] = []) -> DataFrame:  # noqa: B006
    """(id, th, text): th tells documents of equal id apart, and is 0 where the id is unique."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)
    twice = d.groupBy("id").count().where("count > 1").select(F.col("id").alias("rid"), F.lit(True).alias("again"))
    if twice.isEmpty():
        return d.select("id", F.lit(0).cast("long").alias("th"), "text", *more)
    d = d.join(twice, d.id.eqNullSafe(F.col("rid")), "left")
    return d.select("id", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0)).cast("long").alias("th"), "text", *more)


def removed_stretches(docs: DataFrame) -> DataFrame:
    """(id, th, cuts): for each document that loses something, the stretches [start, stop), unsorted; docs as from ``keyed``."""
    spark = docs.sparkSession
    every = durable(context_table(docs))
    often = durable(every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    some = durable(every.join(often, "h"))
    gone = every.inputFiles(), often.inputFiles()
    del every, often
    forget(spark, *gone)
    kinds = durable(some.groupBy("h", "c").agg(F.min(F.struct("id", "th", "at")).alias("o"), F.count("*").alias("n"), F.first("near").alias("near")))
    start = F.shiftright("at", 16)
    copies = some.join(kinds.where("n > 1").select("h", "c", "o"), ["h", "c"]).where(~F.struct("id", "th", "at").eqNullSafe(F.col("o")))
    copies = durable(copies.select("id", "th", start.alias("start"), (start + F.shiftright("at", 8).bitwiseAND(255)).alias("stop")))
    gone = some.inputFiles()
    del some
    forget(spark, gone)
    sides = F.array(F.struct(F.lit(0).alias("side"), F.shiftrightunsigned("near", 32).alias("v")), F.struct(F.lit(1).alias("side"), F.col("near").bitwiseAND(0xFFFFFFFF).alias("v")))
    halves = kinds.select("h", "o", F.explode(sides).alias("x")).select("h", "o", "x.side", "x.v").where("v <> 0")
    shared = halves.groupBy("h", "side", "v").agg(F.count("*").alias("m")).where("m > 1")
    met = durable(halves.join(shared, ["h", "side", "v"]).select("h", "side", "m", "o.id", "o.th", "o.at"))
    gone = kinds.inputFiles()
    del kinds, halves, shared
    forget(spark, gone)
    wanted = met.groupBy("id", "th").agg(F.collect_list(F.struct("h", "side", "m", "at")).alias("want"))
    sources = docs.join(wanted.withColumnsRenamed({"id": "wid", "th": "wth"}), F.col("id").eqNullSafe(F.col("wid")) & (F.col("th") == F.col("wth"))).dropDuplicates(["id", "th"]).select("id", "th", "text", "want")

    def cut(batches):
        for batch, data, offs in slices(batches, "text", SLICE):
            for i, (d, th, want) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True)):
                text = data[offs[i] : offs[i + 1]].tobytes()
                rows, sizes = [], []
                for w in want.as_py():
                    start, length, off = w["at"] >> 16, (w["at"] >> 8) & 255, w["at"] & 255
                    lo, hi = (off - HALF, off + K) if w["side"] == 0 else (off, off + K + HALF)
                    rows.append(piece(w["h"].to_bytes(8, "little", signed=True) + b"rl"[w["side"] : w["side"] + 1], d, th, start, lo, hi, text[start : start + length]))
                    sizes.append(w["m"])
                batch_ = pieces(rows)
                yield pa.RecordBatch.from_arrays([*batch_.columns, pa.array(sizes, pa.int64())], names=[*batch_.schema.names, "m"])

    groups = durable(sources.mapInArrow(cut, f"{PIECE_SQL}, m long"))
    marks = group_marks(groups).unionByName(copies)
    return durable(marks.groupBy("id", "th").agg(F.collect_list(F.struct("start", "stop")).alias("cuts")))


def uncovered(cuts: pa.ListArray, offs: np.ndarray) -> np.ndarray:
    """Which bytes of a slice of texts no stretch covers; cuts holds each text's stretches, in any order."""
    count = pc.fill_null(pc.list_value_length(cuts), 0).to_numpy(zero_copy_only=False)
    flat = cuts.flatten()
    base = np.repeat(offs[:-1], count)
    edge = np.bincount(flat.field("start").to_numpy() + base, minlength=offs[-1] + 1).astype(np.int32)
    edge -= np.bincount(flat.field("stop").to_numpy() + base, minlength=offs[-1] + 1).astype(np.int32)
    return np.cumsum(edge[:-1]) == 0


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row; kept is the remaining bytes, which need not be whole characters."""
    d = keyed(docs, id_col, text_col)
    cuts = removed_stretches(d).withColumnsRenamed({"id": "cid", "th": "cth"})
    both = d.join(cuts, d.id.eqNullSafe(F.col("cid")) & (d.th == F.col("cth")), "left").select("id", "text", "cuts")

    def run(batches):
        for batch, data, offs in slices(batches, "text", SLICE):
            stay = uncovered(batch.column(2), offs)
            upto = np.concatenate([[0], np.cumsum(stay)])[offs]
            begins = ~stay
            begins[1:] &= stay[:-1]
            heads = offs[:-1][np.diff(offs) > 0]
            begins[heads] = ~stay[heads]
            spans = np.diff(np.concatenate([[0], np.cumsum(begins)])[offs])
            kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(upto), pa.py_buffer(data[stay])]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offs)), pa.array(np.diff(offs) - np.diff(upto)), pa.array(spans), kept], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return both.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("id", id_col)


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut out of its texts. Bytes of a character that was cut in half go too.
    Rows of which nothing is left go; rows that were empty or null before stay as they are."""
    cuts = removed_stretches(keyed(docs, id_col, text_col)).withColumnsRenamed({"id": "cid", "th": "cth"})
    rest = [c for c in docs.columns if c != text_col]
    whole = docs.withColumns({"__rest": F.struct(*[F.col(f"`{c}`") for c in rest]), "__null": F.col(text_col).isNull()})
    ids = keyed(whole, id_col, text_col, ["__rest", "__null"])
    both = ids.join(cuts, ids.id.eqNullSafe(F.col("cid")) & (ids.th == F.col("cth")), "left").select("text", "cuts", "__rest", "__null")

    def run(batches):
        for batch, data, offs in slices(batches, "text", SLICE):
            stay = uncovered(batch.column(1), offs)
            upto = np.concatenate([[0], np.cumsum(stay)])[offs]
            left, hit = data[stay], np.diff(upto) < np.diff(offs)
            kept = [left[upto[i] : upto[i + 1]].tobytes().decode("utf-8", "ignore") if hit[i] else None for i in range(len(hit))]
            text = pc.if_else(pa.array(hit), pa.array(kept, pa.string()), pc.if_else(batch.column(3), pa.scalar(None, pa.string()), batch.column(0).cast(pa.string())))
            gone = pc.and_(pa.array(hit), pc.equal(pc.fill_null(text, "x"), ""))
            yield pa.RecordBatch.from_arrays([text, batch.column(2)], names=["text", "rest"]).filter(pc.invert(gone))

    row = whole.select(F.col("__rest").alias("rest")).schema["rest"].dataType.simpleString()
    out = both.mapInArrow(run, f"text string, rest {row}")
    return out.select(*[(F.col("text") if c == text_col else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
