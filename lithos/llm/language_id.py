"""Language identification by hierarchical discrimination.

A linear model first picks the language family; within the family, one linear support
vector machine per pair of languages votes. Features are hashed letter 1- to 3-grams of
the whole text, as relative frequencies under a square root.

Defined results: a null text, an empty one and one without a letter get ``und`` with
score 0. Without a labelled text every prediction is ``und``. With one language (or one
in a family) there is nothing to separate and it wins. Repeated rows are predicted alike;
other columns of the input pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lithos.llm.arrays import lowered, text_slices

#: ISO 639-1 codes by family; a language of none of them is a family of its own.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}
FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}
DIM = 4096


@dataclass
class Model:
    """Weights with the bias last; a pair's positive side is its first language."""

    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of DIM + 1 for each text; only letters and non-ASCII bytes count, other bytes are one blank."""
    low = lowered(data).astype(np.uint32)
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    low[~letter] = 32
    n = len(low)
    a = low * np.uint32(0x9E3779B1)
    one = a >> np.uint32(20)
    b = np.zeros(n, np.uint32)
    b[:-1] = (a[:-1] ^ (low[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    c = np.zeros(n, np.uint32)
    c[:-2] = (b[:-2] ^ (low[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    two, three = b >> np.uint32(20), c >> np.uint32(20)
    out = np.zeros((len(offsets) - 1, DIM + 1), np.float32)
    for i in range(len(offsets) - 1):
        s, e = offsets[i], offsets[i + 1]
        counts = np.bincount(one[s:e], minlength=DIM) + np.bincount(two[s : e - 1], minlength=DIM)
        counts += np.bincount(three[s : max(s, e - 2)], minlength=DIM)
        row = np.sqrt(counts, dtype=np.float32)
        out[i, :DIM] = row / max(float(np.sqrt(row @ row)), 1e-9)
    out[:, DIM] = 1
    return out


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 12, seed: int = 5) -> np.ndarray:
    """A linear support vector machine with squared hinge loss, by dual coordinate descent (Hsieh et al., 2008)."""
    n, w, alpha = len(y), np.zeros(x.shape[1], np.float64), np.zeros(len(y))
    weight = np.where(y > 0, n / max(1, 2 * (y > 0).sum()), n / max(1, 2 * (y < 0).sum())) * c
    norms = np.einsum("ij,ij->i", x, x) + 0.5 / weight
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in draw.permutation(n):
            step = (1 - y[i] * (x[i] @ w) - alpha[i] * 0.5 / weight[i]) / norms[i]
            new = max(0.0, alpha[i] + step)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w.astype(np.float32)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 300, languages: int | None = None, sample: int = 16_000, key_col: str = "doc_id") -> Model:
    """Train on a bounded sample: the ``per_language`` labelled texts of each language whose hashes, of key and text, are least.

    All values of ``lang_col`` are learnt, or the ``languages`` most frequent if that is given; with many of them fewer texts
    of each, ``sample`` in all but one of each at least. Rows of one key and text count once. About 1.6 times as many feature rows
    reach the driver, whatever the size of ``labelled``. The machines are trained side by side in tasks, over that sample.
    """
    model = Model()
    rows = labelled.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    at = F.xxhash64(F.col(key_col).cast("string"), F.col(text_col))
    counts = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.approx_count_distinct(at).alias("n"))
    sizes = {r.lang: max(1, r.n) for r in counts.orderBy(F.desc("n"), "lang").limit(languages or (1 << 31) - 1).collect()}
    if not sizes:
        return model
    per_language = min(per_language, max(1, sample // len(sizes)))
    share = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, (1.6 * per_language + 30) / n))])
    drawn = rows.where(at.cast("double") / F.lit(2.0**64) + 0.5 <= share[F.col(lang_col)])
    drawn = drawn.select(F.col(lang_col).alias("lang"), at.alias("at"), F.col(text_col).alias("text"))

    def rows_of(batches):
        for batch in batches:
            langs, ats = batch.column("lang"), batch.column("at")
            for i, j, data, offsets in text_slices(batch.column("text")):
                x = features(data, offsets).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [langs.slice(i, j - i), ats.slice(i, j - i), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "at", "x"]
                )

    table = drawn.mapInArrow(rows_of, "lang string, at long, x binary").dropDuplicates(["lang", "at"]).toArrow().sort_by([("lang", "ascending"), ("at", "ascending")])
    langs = np.array(table.column("lang").to_pylist())
    keep = np.concatenate([np.flatnonzero(langs == k)[:per_language] for k in sorted(set(langs))])
    langs, x = langs[keep], table.column("x").take(pa.array(keep))
    family = np.array([FAMILY.get(k, k) for k in langs])
    model.families = sorted(set(family))
    model.languages = {f: sorted(set(langs[family == f])) for f in model.families}
    own = {f: i for i, f in enumerate(model.families)}
    tasks = [(i, "", "") for i in own.values()] if len(own) > 1 else []
    tasks += [(own[f], a, b) for f in model.families for a, b in combinations(model.languages[f], 2)]
    for (f, a, b), w in _trained(labelled.sparkSession, tasks, langs, np.array([own[f] for f in family]), x):
        if a:
            model.pairs[a, b] = w
        else:
            model.family_weights = np.zeros((len(own), DIM + 1), np.float32) if model.family_weights is None else model.family_weights
            model.family_weights[f] = w
    return model


def _trained(spark: SparkSession, tasks: list[tuple[int, str, str]], langs: np.ndarray, family: np.ndarray, x: pa.ChunkedArray):
    """(task, weights) of each machine: a family against the others, or one language of it against another; ``x`` are feature rows of half floats."""
    if not tasks:
        return
    shared = spark.sparkContext.broadcast((langs, family, b"".join(v.as_buffer() for v in x)))

    def run(batches):
        langs_, family_, rows_ = shared.value
        x_ = np.frombuffer(rows_, np.float16).reshape(len(langs_), DIM + 1)
        for batch in batches:
            out = []
            for f, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                some = (langs_ == a) | (langs_ == b) if a else np.ones(len(langs_), bool)
                y = np.where(langs_[some] == a if a else family_ == f, 1, -1)
                out.append(svm(x_[some].astype(np.float32), y).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*"fab", "w"])

    rows = spark.createDataFrame(tasks, "f int, a string, b string").repartition(min(len(tasks), 16 + len(tasks) // 16))
    found = rows.mapInArrow(run, "f int, a string, b string, w binary").collect()
    shared.destroy()
    for r in found:
        yield (r.f, r.a, r.b), np.frombuffer(r.w, np.float32)


def classify(model: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The language of each feature row and a score: the share of the winning side at each step, multiplied."""
    n = len(x)
    if model.family_weights is None:
        family, score = np.zeros(n, int), np.ones(n)
    else:
        margins = x @ model.family_weights.T
        family = margins.argmax(1)
        exp = np.exp(3 * (margins - margins.max(1, keepdims=True)))
        score = 1 / exp.sum(1)
    langs = np.empty(n, object)
    for k, name in enumerate(model.families):
        at = np.flatnonzero(family == k)
        names = model.languages[name]
        votes, margin = np.zeros((len(at), len(names))), np.zeros((len(at), len(names)))
        for i, j in combinations(range(len(names)), 2):
            m = x[at] @ model.pairs[names[i], names[j]]
            p = 1 / (1 + np.exp(-3 * m))
            votes[:, i] += m > 0
            votes[:, j] += m <= 0
            margin[:, i] += p
            margin[:, j] += 1 - p
        won = (votes + margin / max(1, len(names))).argmax(1) if len(at) else np.zeros(0, int)
        langs[at] = np.array(names, object)[won]
        if len(names) > 1:
            score[at] *= margin[np.arange(len(at)), won] / (len(names) - 1)
    return langs, np.clip(score, 0, 1)


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with ``lang_out`` and ``score_out``; columns of those names are replaced."""
    kept = [c for c in docs.columns if c not in (lang_out, score_out)]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few weight rows of DIM each
    mark = max(kept, key=len) + "_"  # a name that no column has
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col).rlike(r"\p{L}").alias(mark))
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])

    def run(batches):
        m = shared.value
        for batch in batches:
            letter = np.array(batch.column(mark).fill_null(False).to_pylist(), bool)
            langs, scores = np.full(len(letter), "und", object), np.zeros(len(letter))
            if m.families:
                for i, j, data, offsets in text_slices(batch.column(text_col)):
                    if letter[i:j].any():
                        lang, score = classify(m, features(data, offsets))
                        langs[i:j] = np.where(letter[i:j], lang, "und")
                        scores[i:j] = np.where(letter[i:j], score, 0)
            columns = [batch.column(c) for c in kept] + [pa.array(langs, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, lang_out, score_out])

    return rows.mapInArrow(run, schema)
