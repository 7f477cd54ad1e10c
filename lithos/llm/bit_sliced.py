"""Exact top-k inner products over a bit-sliced index.

Components are quantised to integers. A block of the index holds its rows' components as
bit slices: for each attribute and bit position one bitmap over the block's rows, in two's
complement. A query adds up slices with bitmap arithmetic: a component of the query is a
sum of signed powers of two (non-adjacent form), each of which shifts an attribute's slices,
and carry-save adders bring all shifted slices down to one bit-sliced sum. The top k rows
are then chosen from the most significant slice downward (O'Neil and Quass, 1997): a slice
keeps those that are certainly in and narrows those that may be; what is left at the end ties
exactly, and the boundary takes the smallest ids, in whose order the rows stand.

Every row is indexed. Blocks have about ``block_rows`` rows; queries are a stated set and go
in groups of ``group_rows`` to every block; each pair of a group and a block gives the
block's best k for each query, and a ranking by query over those is the result.

Defined results: vectors that are null or hold a null or non-finite component take no part.
Sums have as many slices as they need, so components of any size are exact; a component
or one of the best scores that does not fit 64 bits raises an error. Vectors of another length than the query's
are not compared with it; vectors of no components score 0 with each other. Rows that
repeat an id are rows of their own, as queries and as candidates; a query leaves out its own row only.
Rows without an id take no part. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithos.session import staged

FOUND = "query_row long, query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Params:
    k: int = 20
    scale: int = 64
    block_rows: int = 65_536
    group_rows: int = 256


def quantised(vectors: DataFrame, p: Params, id_col: str, vec_col: str) -> DataFrame:
    """``(row, vec_id, q)`` with floor(scale * component) of each row that takes part."""
    v = F.col(vec_col)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: x.cast("double")).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(F.forall("v", fine), F.lit(False)))
    large = F.raise_error(F.lit("a component times the scale does not fit 64 bits")).cast("long")
    fit = lambda x: F.when(F.abs(x * float(p.scale)) < 2.0**63, F.floor(x * float(p.scale)).cast("long")).otherwise(large)
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.transform("v", fit).alias("q"))


def _block(rows: np.ndarray, ids: np.ndarray, values: np.ndarray) -> dict:
    """A block of the index: bitmaps of 64-bit words by attribute and bit, the highest bit the sign."""
    order = np.lexsort((rows, ids))
    rows, ids, values = rows[order], ids[order], values[order]
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    bits = max(low if low >= 0 else ~low, high if high >= 0 else ~high).bit_length() + 1
    n = len(ids)
    words = -(-n // 64)
    slices = np.zeros((values.shape[1], bits, words * 8), np.uint8)
    for b in range(bits):
        slices[:, b, : -(-n // 8)] = np.packbits((values.T >> b) & 1, axis=1, bitorder="little")
    return {"rows": rows, "ids": ids, "bits": bits, "slices": slices.view(np.uint64), "words": words}


def _digits(x: int) -> list[tuple[int, int]]:
    """(power, sign) of the non-adjacent form."""
    out, at = [], 0
    while x:
        if x & 1:
            d = 2 - (x & 3)
            out.append((at, d))
            x -= d
        x >>= 1
        at += 1
    return out


def scores(block: dict, query: list[int]) -> np.ndarray:
    """The bit-sliced inner products of a block with a query, lowest slice first, the last one the sign.

    A subtracted slice is its complement; what the complements and signs leave over is a constant.
    """
    bits, words = block["bits"], block["words"]
    reach = sum(abs(x) for x in query) << (bits - 1)
    width = reach.bit_length() + 2
    heap: list[list[np.ndarray]] = [[] for _ in range(width)]
    constant = 0
    for attribute, x in zip(block["slices"], query):
        for power, sign in _digits(x):
            for b in range(bits):
                at, s = power + b, sign if b < bits - 1 else -sign
                if s > 0:
                    heap[at].append(attribute[b])
                else:  # -v * 2**at = ~v * 2**at - 2**at
                    heap[at].append(~attribute[b])
                    constant -= 1 << at
    full = np.full(words, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(width):
        if constant >> at & 1:
            heap[at].append(full)
    out = np.empty((width, words), np.uint64)
    for at in range(width):
        column, up = heap[at], heap[at + 1] if at + 1 < width else []
        head = 0
        while len(column) - head > 2:
            a, b, c = column[head : head + 3]
            head += 3
            ab = a ^ b
            column.append(ab ^ c)
            up.append((a & b) | (ab & c))
        rest = column[head:]
        if len(rest) == 2:
            up.append(rest[0] & rest[1])
            out[at] = rest[0] ^ rest[1]
        elif rest:
            out[at] = rest[0]
        else:
            out[at] = 0
        heap[at] = []
    return out


def top(block: dict, sums: np.ndarray, k: int, but: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k highest rows, ties at the boundary to smaller ids; the row ``but`` is left out."""
    n, words = len(block["ids"]), block["words"]
    maybe = np.packbits(np.arange(words * 64) < n, bitorder="little").view(np.uint64)
    if but is not None:
        for at in np.flatnonzero(block["rows"] == but):
            maybe[at // 64] &= ~(np.uint64(1) << np.uint64(at % 64))
    sure, have = np.zeros(words, np.uint64), 0
    for level in range(len(sums) - 1, -1, -1):
        one = ~sums[level] if level == len(sums) - 1 else sums[level]
        both = maybe & one
        count = have + int(np.bitwise_count(both).sum())
        if count > k:
            maybe = both
        else:
            sure |= both
            have = count
            maybe = maybe & ~one
            if count == k:
                maybe[:] = 0
                break
    rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    if have < k:
        rows = np.concatenate([rows, np.flatnonzero(np.unpackbits(maybe.view(np.uint8), bitorder="little"))[: k - have]])
    at, bit = rows // 64, (rows % 64).astype(np.uint64)
    picked = (sums[:, at] >> bit & np.uint64(1)).astype(np.int64)
    if len(sums) < 64:
        weight = np.left_shift(np.int64(1), np.arange(len(sums), dtype=np.int64))
        weight[-1] = -weight[-1]
        return block["ids"][rows], weight @ picked
    wide = [sum((-x if i == len(sums) - 1 else x) << i for i, x in enumerate(column)) for column in picked.T.tolist()]
    if any(abs(x) >= 1 << 63 for x in wide):
        raise OverflowError("a score among the best does not fit 64 bits")
    return block["ids"][rows], np.array(wide, np.int64)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def index(rows: DataFrame, p: Params) -> DataFrame:
    """``(dim, block, rows, ids, bits, slices)``, a row for each block of about ``block_rows`` vectors of one length."""
    sizes = {r.dim: r.n for r in rows.groupBy(F.size("q").alias("dim")).agg(F.count("*").alias("n")).collect()}
    blocks = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, max(1, round(n / p.block_rows)))])
    dealt = rows.withColumn("dim", F.size("q"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row"), blocks[F.col("dim")]).cast("int"))

    def run(key, tables):
        table = pa.concat_tables([tables]) if isinstance(tables, pa.Table) else pa.Table.from_batches(tables)
        table = table.combine_chunks()
        n = table.num_rows
        made = _block(table.column("row").to_numpy(), table.column("vec_id").to_numpy(), _matrix(table.column("q").chunk(0), n))
        return pa.table(
            {
                "dim": pa.array([key[0].as_py()], pa.int32()),
                "block": pa.array([key[1].as_py()], pa.int32()),
                "rows": pa.array([made["rows"].tobytes()], pa.binary()),
                "ids": pa.array([made["ids"].tobytes()], pa.binary()),
                "bits": pa.array([made["bits"]], pa.int32()),
                "slices": pa.array([made["slices"].tobytes()], pa.binary()),
            }
        )

    return dealt.select("dim", "block", "row", "vec_id", "q").groupBy("dim", "block").applyInArrow(run, "dim int, block int, rows binary, ids binary, bits int, slices binary")


def search(vectors: DataFrame, is_query: Column, p: Params = Params(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that ``is_query`` holds, its k best other rows.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = staged(quantised(vectors, p, id_col, vec_col), "quantised")
    blocks = staged(index(rows, p), "index") if not rows.isEmpty() else None
    if blocks is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = rows.where(is_query).withColumn("dim", F.size("q"))
    groups = max(1, math.ceil(asked.count() / p.group_rows))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int"))
    asked = asked.groupBy("dim", "part").agg(F.collect_list(F.struct("row", "vec_id", "q")).alias("asked"))  # about group_rows each
    # Every group of the stated queries meets every block of its dimension: both go to each such place.
    places = blocks.select("dim", "block").join(asked.select("dim", "part"), "dim")
    pairs = places.join(asked, ["dim", "part"]).join(blocks, ["dim", "block"]).repartition("dim", "block", "part")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = {
                    "rows": np.frombuffer(batch.column("rows")[i].as_buffer(), np.int64),
                    "ids": np.frombuffer(batch.column("ids")[i].as_buffer(), np.int64),
                    "bits": batch.column("bits")[i].as_py(),
                }
                block["words"] = -(-len(block["ids"]) // 64)
                dim = batch.column("dim")[i].as_py()
                block["slices"] = np.frombuffer(batch.column("slices")[i].as_buffer(), np.uint64).reshape(dim, block["bits"], block["words"])
                for query in batch.column("asked")[i].as_py():
                    ids, values = top(block, scores(block, query["q"]), p.k, query["row"])
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.full(len(ids), query[c])) for c in ("row", "vec_id")), pa.array(ids), pa.array(values)], ["query_row", "query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= p.k).select("query_id", "rank", "vec_id", "score")
