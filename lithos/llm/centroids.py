"""K-means over integer vectors with Drake's adaptive bounds.

Of each vector are kept an upper bound of the distance to its own centroid, lower bounds of those to the next
nearest ones, and one lower bound for all the rest. After a round the bounds move by how far the centroids
moved; a vector whose own centroid is still certified as the nearest is not measured again. Where the order is not
certain, the listed centroids are measured exactly, and all of them if the remainder bound does not hold either.

Vectors and bounds stand in blocks, one row for some two thousand vectors, as little-endian numbers; a round is one map over
the blocks, written to the shared folder, and moves only sums of what changed its centroid.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.session import discard, staged


@dataclass(frozen=True)
class Params:
    """``scale``: components become floor(scale * x). ``listed``: nearest centroids with a lower bound of their own."""

    dims: int = 64
    scale: int = 1024
    clusters: int = 8
    rounds: int = 10
    listed: int = 3
    seed: str = "3"
    block_rows: int = 2048


#: Up to this size squared distances are exact in double precision: 4 * 64 * 2**44 < 2**53. Beyond it they are Python's integers.
FAST = 1 << 22
#: Bounds give way by this share, far more than rounding can take.
SLACK = 1e-9

_BLOCK = "ids binary, missing binary, vectors binary, state binary, moved array<decimal(38,0)>, inertia array<decimal(38,0)>, distance binary"
_BLOCK_SCHEMA = pa.schema(
    [("ids", pa.binary()), ("missing", pa.binary()), ("vectors", pa.binary()), ("state", pa.binary()), ("moved", pa.list_(pa.decimal128(38, 0))), ("inertia", pa.list_(pa.decimal128(38, 0))), ("distance", pa.binary())]
)


def quantised(vectors: DataFrame, p: Params) -> DataFrame:
    """``vec_id`` and ``q``, the floor of the scaled components, of vectors with exactly ``dims`` finite ones."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf)))
    kept = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") == p.dims)).where(~F.coalesce(bad, F.lit(False)))
    scaled = lambda v: F.lit(float(p.scale)) * v
    too_large = F.raise_error(F.lit("a scaled component does not fit 62 bits")).cast("long")
    return kept.select("vec_id", F.transform(x, lambda v: F.when(F.abs(scaled(v)) < F.lit(2.0**62), F.floor(scaled(v))).otherwise(too_large)).alias("q"))


def starts(rows: DataFrame, p: Params) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``; rows without an id are never among them."""
    key = F.sha2(F.concat_ws(":", F.lit(p.seed), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").select(key.alias("key"), "q").orderBy("key", "q").limit(p.clusters)
    return [list(r.q) for r in first.collect()]


def clustered(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    """Each kept vector's cluster after ``rounds`` rounds and one more assignment, from rows with ``vec_id`` and ``embedding``.

    Vectors that are null, have another number of components, or hold null or non-finite ones take no part. Equal
    distances go to the smaller number, empty clusters keep their centroid, repeated rows count as often as they stand.
    Rows with a null id are clustered but never start a cluster. Fewer such vectors than ``clusters`` give fewer
    clusters, none give no rows. A scaled component beyond 62 bits or a squared distance beyond 63 raises. Other columns are left out.
    """
    rows = quantised(vectors, p)
    centroids = starts(rows, p)
    if not centroids:
        return rows.select("vec_id", *_outputs(F.lit(0), F.lit(0).cast("long"), [0], 0, [""])).limit(0)
    blocks = rows.mapInArrow(_blocked(p.dims, p.block_rows), _BLOCK)
    totals = [[0] * (p.dims + 1) for _ in centroids]
    drift: list[float] | None = None
    for _ in range(p.rounds):
        before, blocks = blocks, staged(blocks.mapInArrow(_assigned(centroids, drift, p, False), _BLOCK), "clusters")
        discard(before)
        for at, change in blocks.select(F.posexplode("moved").alias("at", "v")).groupBy("at").agg(F.sum("v")).collect():
            totals[at // (p.dims + 1)][at % (p.dims + 1)] += int(change)
        new = [[s // t[-1] for s in t[:-1]] if t[-1] else c for t, c in zip(totals, centroids, strict=True)]
        drift = [math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))) for x, y in zip(new, centroids, strict=True)]
        centroids = new
    before, blocks = blocks, staged(blocks.mapInArrow(_assigned(centroids, drift, p, True), _BLOCK), "clusters")
    discard(before)
    inertia = [0] * len(centroids)
    for at, part in blocks.select(F.posexplode("inertia").alias("at", "v")).groupBy("at").agg(F.sum("v")).collect():
        inertia[at] += int(part)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    out = blocks.select("ids", "missing", "state", "distance").mapInArrow(_rows(len(centroids), p), "vec_id long, cluster int, distance long")
    return out.select("vec_id", *_outputs(F.col("cluster"), F.col("distance"), inertia, sum(inertia), digests))


def _outputs(cluster: Column, distance: Column, inertia: list[int], total: int, digests: list[str]) -> list[Column]:
    own = F.array(*[F.lit(x).cast("long") for x in inertia])
    return [
        cluster.alias("cluster"),
        distance.alias("distance"),
        F.get(own, cluster).alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), cluster).alias("centroid_sha256"),
    ]


def _state_type(k: int, listed: int) -> np.dtype:
    """Own centroid, its upper bound, the listed centroids with lower bounds, and the bound of the rest."""
    n = max(0, min(listed, k - 1))
    return np.dtype([("own", "<i2"), ("upper", "<f8"), ("near", "<i2", (n,)), ("lower", "<f8", (n,)), ("rest", "<f8")])


def _packed(q: np.ndarray) -> bytes:
    """Integers in the least width of 2, 4 or 8 bytes that holds them, after a byte that says which."""
    width = next(w for w in (2, 4, 8) if w == 8 or not len(q) or (q >= -(1 << 8 * w - 1)).all() and (q < 1 << 8 * w - 1).all())
    return bytes([width]) + q.astype(f"<i{width}").tobytes()


def _unpacked(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64).reshape(-1, dims)


def _blocked(dims: int, size: int):
    """Rows of vectors as blocks without a state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), size):
                part = batch.slice(start, size)
                ids = part.column(0)
                row = {
                    "ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                    "missing": ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                    "vectors": _packed(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)),
                }
                yield pa.RecordBatch.from_pylist([row], _BLOCK_SCHEMA)

    return run


def squared(q: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector to every centroid: doubles without rounding, or Python's integers."""
    if max((int(np.abs(x).max()) if x.size else 0) for x in (q, centroids)) <= FAST and q.shape[1] <= 64:
        a, b = q.astype(float), centroids.astype(float)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    a, b = q.astype(object), centroids.astype(object)
    return np.stack([((a - c) ** 2).sum(1) for c in b], 1)


def _assigned(centroids: list[list[int]], drift: list[float] | None, p: Params, last: bool):
    """A round over blocks: new states, and what moved between clusters; the last one has distances instead."""
    where, k = np.array(centroids, object), len(centroids)
    if max(abs(x) for c in centroids for x in c) < 1 << 62:
        where = where.astype(np.int64)
    kind = _state_type(k, p.listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q = _unpacked(row["vectors"], p.dims)
                if row["state"] is None:
                    old, state = np.full(len(q), -1), np.zeros(len(q), kind)
                    measure(q, where, state, np.arange(len(q)))
                else:
                    state = np.frombuffer(row["state"], kind).copy()
                    old = state["own"].astype(int)
                    moved_bounds(state, np.array(drift))
                    certify(q, where, state)
                row |= {"state": state.tobytes(), "moved": None}
                if last:
                    d = own_distance(q, where, state["own"])
                    if len(d) and max(d.tolist()) >= 1 << 63:
                        raise OverflowError("a squared distance does not fit 64 bits")
                    row |= {"inertia": [sum(map(int, d[state["own"] == c])) for c in range(k)], "distance": d.astype("<i8").tobytes(), "vectors": None}
                elif (changed := np.flatnonzero(old != state["own"])).size:
                    row["moved"] = [v for c in range(k) for v in _change(q[changed], (state["own"][changed] == c).astype(int) - (old[changed] == c))]
                yield pa.RecordBatch.from_pylist([row], _BLOCK_SCHEMA)

    return run


def _change(q: np.ndarray, sign: np.ndarray) -> list[int]:
    """Componentwise sum of the vectors that came less those that went, and how many more came."""
    small = not q.size or int(np.abs(q).max()) < 1 << 40  # of at most some thousand vectors
    sums = (sign @ q) if small else (sign.astype(object) @ q.astype(object))
    return [*map(int, sums), int(sign.sum())]


def own_distance(q: np.ndarray, centroids: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact squared distance of every vector to its own centroid."""
    out = np.zeros(len(q), object)
    for c in range(len(centroids)):
        mine = np.flatnonzero(own == c)
        if mine.size:
            found = squared(q[mine], centroids[c : c + 1])[:, 0]
            out[mine] = [int(x) for x in found]
    return out


def moved_bounds(state: np.ndarray, drift: np.ndarray) -> None:
    """Bounds after the centroids moved by ``drift``, kept on the safe side of rounding."""
    far = drift * (1 + SLACK)
    state["upper"] = (state["upper"] + far[state["own"]]) * (1 + SLACK)
    state["lower"] = (state["lower"] - far[state["near"]]) * (1 - SLACK)
    state["rest"] = (state["rest"] - far.max()) * (1 - SLACK)
    np.maximum(state["lower"], 0, out=state["lower"])
    np.maximum(state["rest"], 0, out=state["rest"])


def measure(q: np.ndarray, centroids: np.ndarray, state: np.ndarray, rows: np.ndarray) -> None:
    """All centroids measured for some rows: exact order, ties to the smaller number."""
    if not rows.size:
        return
    d = squared(q[rows], centroids)
    order = np.argsort(d, axis=1, kind="stable")
    n = state["near"].shape[1]
    root = np.sqrt(np.take_along_axis(d, order, 1).astype(float))
    state["own"][rows], state["near"][rows] = order[:, 0], order[:, 1 : n + 1]
    state["upper"][rows], state["lower"][rows] = root[:, 0] * (1 + SLACK), root[:, 1 : n + 1] * (1 - SLACK)
    state["rest"][rows] = root[:, n + 1] * (1 - SLACK) if d.shape[1] > n + 1 else np.inf


def certify(q: np.ndarray, centroids: np.ndarray, state: np.ndarray) -> tuple[int, int]:
    """Measures again where the own centroid may not be the nearest; how many by the listed ones, and by all."""
    nearest_other = np.minimum(state["lower"].min(1, initial=np.inf), state["rest"])
    rows = np.flatnonzero(state["upper"] >= nearest_other)
    if not rows.size:
        return 0, 0
    # the own centroid alone first: its bound has only grown
    for c in range(len(centroids)):
        mine = rows[state["own"][rows] == c]
        if mine.size:
            state["upper"][mine] = np.sqrt(squared(q[mine], centroids[c : c + 1])[:, 0].astype(float)) * (1 + SLACK)
    rows = rows[state["upper"][rows] >= nearest_other[rows]]
    if not rows.size:
        return 0, 0
    # then the listed ones: those are certain against the rest if their least distance is below its bound
    listed = np.concatenate([state["own"][rows, None], state["near"][rows]], 1)
    listed.sort(axis=1)  # so that the first of equal distances is the smallest number
    d = np.take_along_axis(squared(q[rows], centroids), listed.astype(np.int64), 1) if len(centroids) <= 2 * listed.shape[1] else _some(q[rows], centroids, listed)
    order = np.argsort(d, axis=1, kind="stable")
    root, number = np.sqrt(np.take_along_axis(d, order, 1).astype(float)), np.take_along_axis(listed, order, 1)
    sure = root[:, 0] * (1 + SLACK) < state["rest"][rows]
    at = rows[sure]
    state["own"][at], state["near"][at] = number[sure, 0], number[sure, 1:]
    state["upper"][at], state["lower"][at] = root[sure, 0] * (1 + SLACK), root[sure, 1:] * (1 - SLACK)
    measure(q, centroids, state, rows[~sure])
    return len(at), int((~sure).sum())


def _some(q: np.ndarray, centroids: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to the centroids whose numbers stand in its row."""
    out = [None] * numbers.shape[1]
    for j in range(numbers.shape[1]):
        diff = q.astype(object if centroids.dtype == object else np.int64) - centroids[numbers[:, j]]
        out[j] = (diff.astype(float) ** 2).sum(1) if diff.dtype != object and (not diff.size or np.abs(diff).max() <= 2 * FAST) else (diff.astype(object) ** 2).sum(1)
    return np.stack(out, 1)


def _rows(k: int, p: Params):
    """Blocks of the last round as rows."""
    kind = _state_type(k, p.listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, missing, state, distance in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                arrays = [
                    pa.array(np.frombuffer(ids, "<i8"), mask=np.frombuffer(missing, bool)),
                    pa.array(np.frombuffer(state, kind)["own"].astype(np.int32)),
                    pa.array(np.frombuffer(distance, "<i8")),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance"])

    return run
