"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut where no vocabulary piece can reach across, and each distinct cut is merged once:
its symbols form a doubly linked list, all adjacent pairs that are pieces wait in a heap by rank
(ties: leftmost first), and the lowest is popped until none is left. The count is the initial
symbols less the merges, plus the extra bytes of symbols outside the vocabulary; identifiers are
never made.

Null and empty texts have no token. Rows are never joined, so repeated rows, null ids and further
columns pass through as they are.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

SPACE = "▁"
#: Counts of at most this many distinct cuts, no longer than CACHED_CHARS, are remembered twice over in a worker.
CACHED, CACHED_CHARS = 300_000, 48


def piece_ranks(model_file: str) -> dict[str, float]:
    """Piece to rank (lower merges first) of a BPE model with byte fallback and no text normaliser
    but the word-start mark; other models are refused."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    ranks = {sp.id_to_piece(i): -sp.get_score(i) for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    if not any(sp.is_byte(i) for i in range(n)) or any(SPACE in p.lstrip(SPACE) for p in ranks) or sp.encode(" Ａ ", out_type=str)[0] != SPACE * 2:
        raise ValueError("needs a BPE model with byte fallback, an identity normaliser and word-start marks only at the start of pieces")
    return ranks


def merged_count(text: str, ranks: dict[str, float]) -> int:
    """Tokens of one cut. Nodes are positions in ``sym``; ``nxt`` and ``prv`` link those that are left."""
    sym: list = list(text)
    n = len(sym)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i, p) for i in range(n - 1) if (r := get(p := sym[i] + sym[i + 1])) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, pair = heapq.heappop(heap)
        a = sym[i]
        if a is None or (j := nxt[i]) >= n or len(a) + len(b := sym[j]) != len(pair):
            continue  # one of the two has been merged since
        sym[i], sym[j] = pair, None
        merges += 1
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            if (r := get(p := pair + sym[k])) is not None:
                heapq.heappush(heap, (r, i, p))
        h = prv[i]
        if h >= 0 and (r := get(p := sym[h] + pair)) is not None:
            heapq.heappush(heap, (r, h, p))
    return n - merges + sum(len(c.encode("utf-8", "surrogatepass")) - 1 for c in sym if c is not None and len(c) == 1 and c not in ranks)


class Counter(dict):
    """Word (without its leading mark) to tokens, bounded: the older half goes when the newer is full."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks, self.old, self.tails = ranks, {}, {}
        self.meet = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}

    def __missing__(self, word: str) -> int:
        n = self.old.get(word)
        if n is None:
            # two symbols that meet in no piece are never merged: what lies before and after counts by itself
            cut = next((i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.meet), 0)
            n = self[word[:cut]] + self.tail(word[cut:]) if cut else merged_count(SPACE + word, self.ranks)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[word] = n
        return n

    def tail(self, rest: str) -> int:
        n = self.tails.get(rest)
        if n is None:
            n = lo = 0
            for i in range(1, len(rest) + 1):
                if i == len(rest) or rest[i - 1 : i + 1] not in self.meet:
                    n += merged_count(rest[lo:i], self.ranks)
                    lo = i
            if len(rest) <= 4:
                if len(self.tails) >= CACHED // 10:
                    self.tails.clear()
                self.tails[rest] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
            return sum(merged_count(m, self.ranks) if m.startswith(SPACE * 2) or len(m) == 1 else self[m[1:]] for m in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE)))
        return sum(map(self.__getitem__, text.split(" ")))


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row. The vocabulary, whose size is fixed, is broadcast."""
    ranks = docs.sparkSession.sparkContext.broadcast(piece_ranks(model_file))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        counter = Counter(ranks.value)
        for batch, _, _ in slices(batches, "text"):
            text = batch.column(1)
            n = [counter.count(t) for t in text.to_pylist()]
            size = pc.fill_null(pc.cast(pc.binary_length(text), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["id", "n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
