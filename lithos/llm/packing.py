"""Vector best-fit packing of tokenized documents into training sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared
lengths). Items go from long to short into the bin that all three admit and that the rule
prefers: the least weighted norm of what remains after placing ("norm"), or the largest
weighted dot product of item and remainder ("dot"), each in shares of the capacity.

What an item needs depends on its length alone, so the choice of bins needs only the number
of pieces of each length, at most ``tokens`` numbers whatever the corpus. Bins with the
same history are one group, a range of sequence numbers, and one step fills or splits a
whole group. The plan is a table of such steps, bounded by the number of lengths too; each
piece finds its place from its length and its rank among pieces of that length. Ranks come
from windows of about ``ranked`` pieces, so one very common length is ranked by many tasks.

Defined results: a null text counts as empty; every document ends with ``end_id``, so an
empty one is a piece of one token; documents longer than a sequence are cut into full
pieces and a rest. Repeated rows are packed each. No documents give no rows. Columns other
than id and text are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lithos.llm.tokens import encoder
from lithos.session import staged


@dataclass(frozen=True)
class Params:
    """Capacities of one sequence; a capacity of None follows from ``tokens`` and never binds."""

    tokens: int = 4096
    documents: int | None = None
    attention: int | None = None
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    end_id: int = 1
    ranked: int = 20_000
    parts: int = 100_000

    @property
    def capacity(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.int64)


def pieces(docs: DataFrame, tokenizer: str, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: each document's ids, cut at the token capacity.

    ``tokenizer`` is the tokenizer file's path, the same on every executor.
    """
    step = 4 * int(p.tokens)
    end = int(p.end_id).to_bytes(4, "little")
    kind = docs.schema[id_col].dataType
    fields = [T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids
    names = [f.name for f in fields]

    def run(batches):
        encode = encoder(tokenizer).encode
        for batch in batches:
            owner, cut, texts = [], [], batch.column("text")
            for k in range(len(texts)):
                ids = encode(texts[k].as_py() or "") + end
                for n, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    owner.append(k)
                    cut.append((n, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            columns = list(zip(*cut)) or [()] * 5
            arrays = [batch.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(columns[0], pa.int32())]
            arrays += [pa.array(c, pa.int64()) for c in columns[1:4]]
            arrays += [pa.array(columns[4], pa.binary())] * with_ids
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, T.StructType(fields))


def plan(counts: dict[int, int], p: Params = Params()) -> np.ndarray:
    """Rows (length, first rank, items a bin, bins, first sequence, first offset) that place all items.

    Raises ValueError if an item alone exceeds a capacity.
    """
    capacity, weights = p.capacity, np.array(p.weights)
    room = np.zeros((64, 3), np.int64)
    first, bins, groups = np.zeros(64, np.int64), np.zeros(64, np.int64), 0
    steps, sequences = [], 0

    def add(left: np.ndarray, at: int, n: int) -> None:
        nonlocal room, first, bins, groups
        if groups == len(bins):
            room, first, bins = np.vstack([room, room * 0]), np.append(first, first * 0), np.append(bins, bins * 0)
        room[groups], first[groups], bins[groups] = left, at, n
        groups += 1

    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if (need > capacity).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity of {capacity.tolist()}")
        left, rank = counts[length], 0
        while left:
            fits = np.flatnonzero((room[:groups] >= need).all(1) & (bins[:groups] > 0))
            if len(fits):
                share = room[fits] / capacity
                if p.rule == "dot":
                    best = fits[int(np.argmax((share * (need / capacity)) @ weights))]
                else:
                    best = fits[int(np.argmin(((share - need / capacity) ** 2) @ weights))]
                space, at, n = room[best].copy(), int(first[best]), int(bins[best])
                most = min(int((space // need).min()), left)
                filled = min(n, left // most)
                if filled == n:  # the group moves on as a whole
                    room[best] = space - need * most
                else:
                    bins[best], first[best] = n - filled, at + filled
                    add(space - need * most, at, filled)
            else:
                space, at = capacity, sequences
                most = min(int((space // need).min()), left)
                filled = left // most
                sequences += filled
                add(space - need * most, at, filled)
            offset = p.tokens - int(space[0])
            steps.append((length, rank, most, filled, at, offset))
            rank, left = rank + most * filled, left - most * filled
    return np.array(steps, np.int64).reshape(-1, 6)


def placed(parts: DataFrame, steps: np.ndarray) -> DataFrame:
    """``parts``, which have ``length`` and ``rank``, with ``sequence_id`` and ``offset`` in place of ``rank``."""
    order = np.lexsort((steps[:, 1], steps[:, 0]))
    shared = parts.sparkSession.sparkContext.broadcast(steps[order])
    kept = [f for f in parts.schema if f.name != "rank"]
    names = [f.name for f in kept]

    def run(batches):
        table = shared.value
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length.astype(np.int64) << 44) + rank, "right") - 1
            _, rank0, each, _, first, offset = table[at].T
            n = rank - rank0
            columns = [batch.column(c) for c in names] + [pa.array(first + n // each), pa.array(offset + n % each * length)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    more = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return parts.mapInArrow(run, T.StructType([*kept, *more]))


def pack(docs: DataFrame, tokenizer: str, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of every document with ``sequence_id`` and ``offset``; ``with_ids`` keeps the ids as bytes."""
    parts = staged(pieces(docs, tokenizer, p, id_col, text_col, with_ids), "pieces")
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most p.tokens rows
    steps = plan(counts, p)
    # A length is ranked in as many parts as its pieces need; there are at most p.parts + p.tokens parts in all.
    each = max(p.ranked, sum(counts.values()) // p.parts)
    salts = {n: -(-k // each) for n, k in counts.items() if k > each}
    most = F.coalesce(F.create_map(*[F.lit(x) for pair in salts.items() for x in pair])[F.col("length")], F.lit(1)) if salts else F.lit(1)
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), most).cast("int"))
    sizes = parts.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = parts.withColumn("rank", F.row_number().over(inside) - 1)
    # At most p.parts + p.tokens rows of three numbers.
    ranked = ranked.join(F.broadcast(sizes), ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before"))
    return placed(ranked.select(*[c for c in parts.columns if c != "salt"], "rank"), steps)
