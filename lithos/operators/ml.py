"""Text classifiers: features, one model a label, evaluation splits, active learning."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IDF, HashingTF, NGram, OneHotEncoder, RegexTokenizer, StopWordsRemover, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.operators.active import greedy, what_if  # noqa: F401  the model-based choice, beside the simpler ones here
from lithos.operators.svd import SVDModel, TruncatedSVD
from lithos.session import discard, staged


def vectoriser(texts: list[str], categories: list[str] = (), features: int = 1 << 16) -> Pipeline:
    """TF-IDF of words and word pairs of each text column, and one-hot categories; unseen categories are zeros."""
    stages, parts = [], []
    for t in texts:
        stages += [
            RegexTokenizer(inputCol=t, outputCol=f"{t}_w", pattern=r"[^\p{L}\p{N}]+"),
            StopWordsRemover(inputCol=f"{t}_w", outputCol=f"{t}_s"),
            NGram(inputCol=f"{t}_s", outputCol=f"{t}_g", n=2),
        ]
        for kind in ("s", "g"):
            stages += [HashingTF(inputCol=f"{t}_{kind}", outputCol=f"{t}_{kind}f", numFeatures=features), IDF(inputCol=f"{t}_{kind}f", outputCol=f"{t}_{kind}i")]
            parts.append(f"{t}_{kind}i")
    for c in categories:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_x", handleInvalid="keep"), OneHotEncoder(inputCol=f"{c}_x", outputCol=f"{c}_o")]
        parts.append(f"{c}_o")
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol="features")])


def classifier(kind: str, c: float = 10.0, trees: int = 50):
    """One binary model with class weights in ``weight``."""
    same = {"labelCol": "label", "featuresCol": "features", "weightCol": "weight"}
    if kind == "LR":
        return LogisticRegression(regParam=1 / c, maxIter=50, **same)
    if kind == "SVM":
        return LinearSVC(regParam=1 / c, maxIter=50, **same)
    return RandomForestClassifier(numTrees=trees, seed=1, **same)


def balanced(rows: DataFrame, label: Column) -> DataFrame:
    """``label`` as a double and ``weight`` in inverse proportion to its class."""
    rows = rows.withColumn("label", label.cast("double"))
    n = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    weight = F.create_map(*[F.lit(x) for k, v in n.items() for x in (k, total / (len(n) * v))])
    return rows.withColumn("weight", weight[F.col("label")])


@dataclass
class Features:
    """A fitted vectoriser, and a decomposition of what it gives if one was asked for."""

    pipeline: PipelineModel
    svd: SVDModel | None = None

    def transform(self, rows: DataFrame) -> DataFrame:
        out = self.pipeline.transform(rows)
        return self.svd.transform(out) if self.svd else out


def fit_labels(rows: DataFrame, labels: list[str], text: list[str], kind: str = "LR", svd: int | None = None, **kwargs) -> tuple[Features, dict]:
    """The features, of ``svd`` components if that is given, and a model for each 0/1 column in ``labels``."""
    stages = vectoriser(text, **{k: v for k, v in kwargs.items() if k in ("categories", "features")}).getStages()
    # Texts are cut into counted words once; the fits, and every pass of the decomposition, read these.
    counting = [s for s in stages if isinstance(s, (RegexTokenizer, StopWordsRemover, NGram, HashingTF))]
    counts = [s.getOutputCol() for s in counting if isinstance(s, HashingTF)]
    counted = staged(PipelineModel(counting).transform(rows).select(*counts, *kwargs.get("categories", ()), *labels), "counted")
    fitted = Pipeline(stages=[s for s in stages if s not in counting]).fit(counted)
    vectors = fitted.transform(counted)
    if svd:
        vectors = staged(vectors.select("features", *labels), "vectors")
    features = Features(PipelineModel([*counting, *fitted.stages]), TruncatedSVD(svd).fit(vectors) if svd else None)
    ready = (features.svd.transform(vectors) if svd else vectors).select("features", *labels).cache()
    models = {x: classifier(kind, **{k: v for k, v in kwargs.items() if k in ("c", "trees")}).fit(balanced(ready, F.col(x))) for x in labels}
    ready.unpersist()
    for used in (counted, vectors):
        discard(used)
    return features, models


def predict_labels(rows: DataFrame, features: Features, models: dict) -> DataFrame:
    """``rows`` with a score column for each label."""
    out = features.transform(rows)
    for name, model in models.items():
        raw = "probability" if model.hasParam("probabilityCol") else "rawPrediction"
        out = model.transform(out).withColumn(f"{name}_score", vector_to_array(raw)[1]).drop("rawPrediction", "probability", "prediction")
    return out.select(*rows.columns, *[f"{x}_score" for x in models])


def split(rows: DataFrame, key: str, share: float = 0.75, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A fixed split by the key's hash."""
    at = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(10_000)) < int(share * 10_000)
    return rows.where(at), rows.where(~at)


def override(annotations: Column, predicted: Column, categories: list[str]) -> Column:
    """Hand labels, as far as they are categories, where there are any; else the prediction."""
    return F.when(F.size(annotations) > 0, F.filter(annotations, lambda a: a.isin(*categories))).otherwise(predicted)


def binarise(labels: Column, names: list[str]) -> Column:
    """A 0/1 array over the sorted names."""
    return F.array(*[F.array_contains(labels, n).cast("int") for n in sorted(names)])


def grid(spark: SparkSession) -> DataFrame:
    """The configurations to try, as (clf, value, epochs, model, svd)."""
    rows = [("LR", str(c), None, None, s) for c, s in product((0.01, 0.1, 1, 10, 100, 1000), (None, 32, 64, 128))]
    rows += [("SVM", str(c), None, None, s) for c, s in product((0.01, 0.1, 1, 10, 100, 1000), (None, 32, 64, 128))]
    rows += [("RF", str(n), None, None, s) for n, s in product((50, 100, 200), (None, 16, 32, 64, 128, 256))]
    return spark.createDataFrame(rows, "clf string, value string, epochs int, model string, svd int")


def undecided(scores: Column, least: float) -> Column:
    return F.array_max(scores) < least


def chosen(docs: DataFrame, mode: str, order: str, score: str | None = None, popularity: str | None = None, least: float = 0.5) -> DataFrame:
    """The one document to annotate next, the last by ``order`` among equals.

    ``mode`` is "bestoutcome" (highest ``score``, an expected change), "popular" (highest ``popularity``; with ``score``,
    a label's, only above ``least``) or "confident" (highest ``score``, a label's).
    """
    if mode == "popular":
        rows = docs.where(F.col(popularity).isNotNull())
        rows, key = (rows.where(F.col(score) > least) if score else rows), popularity
    elif mode in ("bestoutcome", "confident") and score:
        rows, key = docs, score
    else:
        raise ValueError(f"no such mode, or one that needs a score: {mode}")
    return rows.orderBy(F.desc(key), F.desc(order)).limit(1)


def coverage(undecided_rows: DataFrame, challenge: DataFrame) -> DataFrame:
    """``(coverage)``: one minus the share of challenge documents that are undecided, to three places."""
    n, m = undecided_rows.agg(F.count("*").alias("u")), challenge.agg(F.count("*").alias("c"))
    return n.crossJoin(m).select(F.round(1 - F.try_divide("u", "c"), 3).alias("coverage"))  # one row each


def queue_rows(document: DataFrame, doc_col: str, task: int, feature_hash: Column, covered: DataFrame) -> DataFrame:
    """``(document_id, task_id, dochash, current_coverage)`` to append to the queue."""
    rows = document.select(F.col(doc_col).alias("document_id"), F.lit(task).alias("task_id"), feature_hash.alias("dochash"))
    return rows.crossJoin(covered.select(F.col("coverage").alias("current_coverage")))  # one document, one number


def replace_table(rows: DataFrame, path: str) -> None:
    """Writes a table of confidences in place of the one that is there."""
    rows.write.mode("overwrite").parquet(path)
