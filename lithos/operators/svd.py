"""Truncated singular value decomposition of sparse feature rows, by randomised subspace iteration.

The rows stay where they are. A pass sends an orthonormal basis (features x columns) to the tasks; each multiplies its rows
by it and back, and what comes home is summed by feature, so only matrices of features x columns leave the
tasks, whatever the rows. A pass also gives the basis's Rayleigh quotients; passes end when these settle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TruncatedSVD:
    """``k`` components, from a basis of ``extra`` more columns; at most ``most_passes``, fewer if no value moves by more than ``tolerance``."""

    k: int
    extra: int = 10
    most_passes: int = 12
    tolerance: float = 1e-4
    seed: int = 0

    def fit(self, rows: DataFrame, features: str = "features") -> SVDModel:
        """The largest singular values and their right vectors of the rows' vectors, sparse or dense.

        Null vectors count as no row. Fewer features or rows than ``k`` give fewer components (those above rounding); no rows give none.
        The sign of a component makes its largest entry positive.
        """
        parts = sparse(rows.where(F.col(features).isNotNull()), features)
        size = parts.agg(F.max("size")).first()[0] or 0
        wide = min(self.k + self.extra, size)
        values, basis = np.zeros(0), np.zeros((size, 0))
        if wide:
            q = np.linalg.qr(np.random.default_rng(self.seed).normal(size=(size, wide)))[0]
            before = None
            for _ in range(self.most_passes):
                z = product(parts, q)
                quotients, turn = np.linalg.eigh((m := q.T @ z) / 2 + m.T / 2)
                values, basis = np.sqrt(np.maximum(quotients[::-1], 0))[: self.k], (q @ turn[:, ::-1])[:, : self.k]
                if before is not None and (np.abs(values - before) <= self.tolerance * values.max(initial=0)).all():
                    break
                before, q = values, np.linalg.qr(z)[0]
            kept = values > values.max(initial=0) * 1e-6
            values, basis = values[kept], basis[:, kept]
            basis *= np.sign(basis[np.abs(basis).argmax(0), np.arange(basis.shape[1])])
        return SVDModel(values, basis, features)


def sparse(rows: DataFrame, features: str, *others: str) -> DataFrame:
    """``others`` and ``size``, ``indices``, ``values`` of a vector column; a dense vector has all its indices."""
    v = F.unwrap_udt(F.col(features))
    every = F.sequence(F.lit(0), F.size(v["values"]) - 1)
    indices = F.when(v["type"] == 0, v["indices"]).when(F.size(v["values"]) > 0, every).otherwise(F.array().cast("array<int>"))
    return rows.select(*others, F.coalesce(v["size"], F.size(v["values"])).alias("size"), indices.alias("indices"), v["values"].alias("values"))


def _entries(batch: pa.RecordBatch) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Rows in a batch, and row, feature and value of each entry."""
    lists = batch.column("indices")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    return len(lengths), row, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), batch.column("values").flatten().to_numpy(zero_copy_only=False)


def _times(n: int, row: np.ndarray, feature: np.ndarray, value: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Rows times a matrix; the entries come by row."""
    out = np.zeros((n, q.shape[1]))
    if len(row):
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        for j in range(q.shape[1]):  # a column at a time, for memory in proportion to the entries
            out[row[starts], j] = np.add.reduceat(value * q[feature, j], starts)
    return out


def product(parts: DataFrame, q: np.ndarray) -> np.ndarray:
    """The rows' transpose times the rows times ``q``."""
    shared = parts.sparkSession.sparkContext.broadcast(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, total, seen = shared.value, None, None
        for batch in batches:
            n, row, feature, value = _entries(batch)
            if total is None:
                total, seen = np.zeros(q.shape), np.zeros(len(q), bool)
            y = _times(n, row, feature, value, q)
            order = np.argsort(feature, kind="stable")
            feature, row, value = feature[order], row[order], value[order]
            if len(feature):
                starts = np.flatnonzero(np.r_[True, feature[1:] != feature[:-1]])
                for j in range(q.shape[1]):
                    total[feature[starts], j] += np.add.reduceat(value * y[row, j], starts)
                seen[feature[starts]] = True
        if total is not None:
            at = np.flatnonzero(seen)
            for lo in range(0, len(at), 4096):
                part = at[lo : lo + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *(pa.array(total[part, j]) for j in range(q.shape[1]))], names=names)

    names = ["feature", *(f"c{j}" for j in range(q.shape[1]))]
    sums = parts.select("indices", "values").mapInArrow(run, ", ".join(["feature int", *(f"c{j} double" for j in range(q.shape[1]))]))
    found = sums.groupBy("feature").agg(*[F.sum(c).alias(c) for c in names[1:]]).toArrow()
    out = np.zeros(q.shape)
    if found.num_rows:
        out[found.column("feature").to_numpy()] = np.stack([found.column(c).to_numpy() for c in names[1:]], 1)
    shared.unpersist()
    return out


@dataclass
class SVDModel:
    """``values`` in falling order and ``components`` (features x values)."""

    values: np.ndarray
    components: np.ndarray
    features: str = "features"

    def transform(self, rows: DataFrame, out: str | None = None) -> DataFrame:
        """``rows`` with the vectors in ``out`` (the features' own name if none is given) projected onto the components; null stays null."""
        shared = rows.sparkSession.sparkContext.broadcast(self.components)
        v = F.unwrap_udt(F.col(self.features))
        every = F.sequence(F.lit(0), F.size(v["values"]) - 1)
        indices = F.when(v["type"] == 0, v["indices"]).when(F.size(v["values"]) > 0, every).otherwise(F.array().cast("array<int>"))

        @F.arrow_udf("array<double>")
        def projected(indices: pa.Array, values: pa.Array) -> pa.Array:
            n, row, feature, value = _entries(pa.RecordBatch.from_arrays([indices.fill_null([]), values.fill_null([])], names=["indices", "values"]))
            found = _times(n, row, feature, value, shared.value)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
            return lists

        found = F.when(F.col(self.features).isNotNull(), array_to_vector(projected(indices, v["values"])))
        return rows.withColumn(out or self.features, found)
