"""The five classifiers on Spark ML: fitting, grid search, prediction, storage and importances."""
from __future__ import annotations

import itertools
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditecho.config import FEATURE_KINDS, PARAM_GRIDS, SEED
from creditecho.operators import grid as G
from creditecho.operators.encoders import class_weights
from creditecho.operators.knn import knn_classify
from creditecho.operators.metrics import auc_ks, auc_ks_of_counts, score_counts
from creditecho.operators.preprocess import Preprocessor, fit_preprocessor
from creditecho.operators.resample import smote
from creditecho.operators.totals import ranked
from creditecho.session import checkpointed, stored

SCALED = ("logistic_regression", "knn")
MAX_TREE_DEPTH = 30
BLOCK_ROWS = 1_024  # consecutive places whose rows and values travel as arrays


@dataclass
class KnnModel:
    """Stored training rows (doc_id, vector, label) with the number of neighbours and the metric."""

    rows: DataFrame
    k: int
    metric: str


def classifier(name: str, params: dict, n_rows: int, weight: str | None = None):
    """Spark ML estimator for a model name and reference-style parameters."""
    common = {"featuresCol": "features", "labelCol": "label", "seed": SEED}
    if name == "logistic_regression":
        # the penalty applies to the mean loss here, and C multiplies the summed loss
        est = LogisticRegression(
            featuresCol="features", labelCol="label", maxIter=1000, standardization=False,
            regParam=1.0 / (params.get("C", 1.0) * max(1, n_rows)),
            elasticNetParam=1.0 if params.get("penalty") == "l1" else 0.0,
        )
    elif name == "hist_gradient_boosting":
        est = GBTClassifier(
            **common, maxIter=params.get("max_iter", 100), maxDepth=params.get("max_depth", 5),
            stepSize=params.get("learning_rate", 0.1),
        )
    elif name == "random_forest":
        est = RandomForestClassifier(
            **common, numTrees=params.get("n_estimators", 100), maxDepth=params.get("max_depth") or MAX_TREE_DEPTH,
            minInstancesPerNode=params.get("min_samples_leaf", 1),
        )
    elif name == "xgboost":
        est = GBTClassifier(
            **common, maxIter=params.get("n_estimators", 100), maxDepth=params.get("max_depth", 5),
            stepSize=params.get("learning_rate", 0.1), subsamplingRate=params.get("subsample", 1.0),
            featureSubsetStrategy=str(params.get("colsample_bytree", 1.0)) if params.get("colsample_bytree", 1.0) < 1 else "all",
        )
    else:
        raise ValueError(f"unknown model name: {name}")
    return est.setWeightCol(weight) if weight else est


def balanced(train: DataFrame, balance: str) -> tuple[DataFrame, str | None]:
    """Training rows under one balancing method, never two at once."""
    if balance == "smote":
        return checkpointed(smote(train)), None
    if balance == "weights":
        return class_weights(train, "label"), "weight"
    if balance == "none":
        return train, None
    raise ValueError(f"unknown balance: {balance}")


def fit_classifier(name: str, rows: DataFrame, params: dict, weight: str | None, n_rows: int):
    if name == "knn":
        keyed = checkpointed(rows.select(
            F.monotonically_increasing_id().alias("doc_id"), vector_to_array("features").alias("vector"), "label"
        ))
        return KnnModel(keyed, params.get("n_neighbors", 5), params.get("metric", "minkowski"))
    return classifier(name, params, n_rows, weight).fit(rows)


def score_rows(model, rows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., probability, prediction) for transformed rows."""
    if isinstance(model, KnnModel):
        parts = [F.col(c) for c in keep if c != "label"]
        if len(parts) == 1:
            asked = rows.withColumn("query_id", parts[0].cast("long"))
        else:  # numbers of a stored table: a hash of several columns could join two rows
            asked = checkpointed(rows.withColumn("query_id", F.monotonically_increasing_id()))
        votes = knn_classify(
            asked.select("query_id", vector_to_array("features").alias("vector")), model.rows, model.k, model.metric
        )
        return asked.join(votes, "query_id").select(*keep, "probability", "prediction")
    out = model.transform(rows)
    return out.select(*keep, F.get(vector_to_array("probability"), F.lit(1)).alias("probability"), F.col("prediction").cast("int").alias("prediction"))


@dataclass
class FittedModel:
    name: str
    preprocessor: Preprocessor
    model: object
    params: dict
    target: str
    key: str

    def predict(self, df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        """(model, key, extra..., label, probability, prediction)."""
        keep = [self.key, *extra, "label"]
        rows = self.preprocessor.transform(df.withColumn("label", F.col(self.target).cast("int")), keep)
        return score_rows(self.model, rows, keep).withColumn("model", F.lit(self.name))

    def save(self, spark: SparkSession, folder: str) -> None:
        info = {k: getattr(self, k) for k in ("name", "params", "target", "key")}
        spark.createDataFrame([(json.dumps(info),)], "info string").coalesce(1).write.mode("overwrite").text(f"{folder}/info")
        self.preprocessor.save(spark, f"{folder}/preprocessor")
        if isinstance(self.model, KnnModel):
            self.model.rows.write.mode("overwrite").parquet(f"{folder}/model")
        else:
            self.model.write().overwrite().save(f"{folder}/model")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> FittedModel:
        info = json.loads(spark.read.text(f"{folder}/info").first()[0])
        name, params = info["name"], info["params"]
        if name == "knn":
            rows = spark.read.parquet(f"{folder}/model")
            model = KnnModel(rows, params.get("n_neighbors", 5), params.get("metric", "minkowski"))
        else:
            kind = {"logistic_regression": LogisticRegressionModel, "random_forest": RandomForestClassificationModel}
            model = kind.get(name, GBTClassificationModel).load(f"{folder}/model")
        return FittedModel(name, Preprocessor.load(spark, f"{folder}/preprocessor"), model, params, info["target"], info["key"])


def _prepared(name, train, target, key, balance, config):
    pre = fit_preprocessor(train, target, key, name in SCALED, config)
    rows = checkpointed(pre.transform(train.withColumn("label", F.col(target).cast("int")), [key, "label"]))
    rows = rows.withColumnRenamed(key, "id") if key != "id" else rows
    fitted_on, weight = balanced(rows, balance)
    return pre, fitted_on, weight


def train_model(
    name: str, train: DataFrame, params: dict | None = None, target: str = "default_flag", key: str = "id",
    balance: str = "smote", config: dict = FEATURE_KINDS,
) -> FittedModel:
    """Preprocess, balance and fit one model on the training part."""
    if name not in PARAM_GRIDS:
        raise ValueError(f"unknown model name: {name}")
    params = params or {}
    pre, rows, weight = _prepared(name, train, target, key, balance, config)
    return FittedModel(name, pre, fit_classifier(name, rows, params, weight, rows.count()), params, target, key)


def param_grid(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def grid_search(
    name: str, folded: DataFrame, grid: dict[str, list] | None = None, target: str = "default_flag", key: str = "id",
    balance: str = "smote", parallelism: int = 4, config: dict = FEATURE_KINDS,
) -> tuple[list[dict], dict]:
    """Mean ROC-AUC per candidate over the ``fold`` column; returns all rows and the best one.

    Preprocessing and balancing are fitted inside each fold, once for all candidates. Logistic and neighbour candidates share their
    passes over the data (``operators/grid``); of the trees a few are fitted at the same time, every fit a distributed job.
    """
    candidates = param_grid(grid or PARAM_GRIDS[name])
    prepare = lambda inside: _prepared(name, inside, target, key, balance, config)
    scores: dict[int, list[float | None]] = {i: [] for i in range(len(candidates))}
    if name in ("logistic_regression", "knn"):
        train, held = G.stacks(folded, prepare, target, key)
        found = G.logistic_scores(held, G.fit_logistic_grid(train, candidates)) if name != "knn" else G.knn_scores(train, held, candidates)
        for i, _, auc in G.fold_scores(found):
            scores[i].append(auc)
    else:
        for i, auc in _tree_scores(name, folded, candidates, prepare, target, key, parallelism):
            scores[i].append(auc)
    rows = []
    for i, c in enumerate(candidates):
        known = [s for s in scores[i] if s is not None]
        rows.append({"model": name, "params": c, "mean_auc": sum(known) / len(known) if known else None, "folds": len(known)})
    best = max((r for r in rows if r["mean_auc"] is not None), key=lambda r: r["mean_auc"])
    return rows, best


def _tree_scores(name, folded, candidates, prepare, target, key, parallelism):
    """(candidate, ROC-AUC) for every candidate and fold."""
    for fold in sorted(r[0] for r in folded.select("fold").distinct().collect()):
        outside = folded.filter(F.col("fold") == fold).drop("fold").withColumn("label", F.col(target).cast("int"))
        pre, rows, weight = prepare(folded.filter(F.col("fold") != fold).drop("fold"))
        held, n = checkpointed(pre.transform(outside, [key, "label"])), rows.count()

        def run(i, rows=rows, weight=weight, held=held, n=n):
            model = fit_classifier(name, rows, candidates[i], weight, n)
            found = score_rows(model, held, [key, "label"]).withColumn("candidate", F.lit(i))
            return i, auc_ks(found, ["candidate"]).first()["roc_auc"]

        with ThreadPoolExecutor(parallelism) as pool:
            yield from pool.map(run, range(len(candidates)))


def train_all(
    train: DataFrame, settings: dict[str, dict], target: str = "default_flag", key: str = "id", balance: str = "smote",
    config: dict = FEATURE_KINDS,
) -> tuple[dict[str, FittedModel], dict[str, str]]:
    """Fits the listed models; a failing one is reported and the others go on."""
    models, errors = {}, {}
    for name, params in settings.items():
        try:
            models[name] = train_model(name, train, params, target, key, balance, config)
        except Exception as e:
            errors[name] = f"{type(e).__name__}: {e}"
    return models, errors


def predict_all(models: dict[str, FittedModel], test: DataFrame) -> DataFrame:
    """One prediction table of all models."""
    out = None
    for model in models.values():
        part = model.predict(test)
        out = part if out is None else out.unionByName(part)
    return out


def native_importance(fitted: FittedModel, spark: SparkSession) -> DataFrame:
    """(feature, importance) by vector slot, largest first; trees or absolute coefficients."""
    m = fitted.model
    if isinstance(m, KnnModel):
        raise ValueError("this model has no native importances; use permutation_importance")
    values = m.featureImportances.toArray() if hasattr(m, "featureImportances") else abs(m.coefficients.toArray())
    rows = [(n, float(v)) for n, v in zip(fitted.preprocessor.names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def shifted_copies(sample: DataFrame, columns: list[str], repeats: int) -> DataFrame:
    """``repeats`` copies of the rows for every column, in which it comes from the row some places on; ``_at`` numbers the rows from 1.

    A block holds the rows of BLOCK_ROWS places. The values that a block needs for a copy lie in at most three blocks (the last may be short);
    these pieces are cut there and sent to the block.
    """
    spark, size = sample.sparkSession, BLOCK_ROWS
    n = sample.count()
    names = [c for c in sample.columns if c != "_at"]
    blocks = sample.groupBy(F.floor((F.col("_at") - 1) / size).cast("long").alias("_block")).agg(
        F.sort_array(F.collect_list(F.struct("_at", *names))).alias("_rows")
    )
    blocks, count = stored(blocks, "importance-blocks"), -(-n // size)
    trials = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(r).alias("repeat")) for c in columns for r in range(repeats)
    ])
    shift = 1 + F.pmod(F.xxhash64("feature", "repeat", F.lit(SEED)), F.lit(max(1, n - 1)))
    held = lambda block: F.least(F.lit(size), F.lit(n) - block * size)
    asked = spark.range(count).select(F.col("id").alias("_to"), F.inline(trials)).withColumns({
        "_from": F.pmod(F.col("_to") * size + shift, F.lit(max(1, n))), "_size": held(F.col("_to")),
    }).withColumn("_b0", F.floor(F.col("_from") / size).cast("long"))
    asked = asked.withColumns({f"_b{i}": F.pmod(F.col("_b0") + i, F.lit(max(1, count))) for i in (1, 2)})
    asked = asked.withColumn("_first", F.col("_from") - F.col("_b0") * size)
    asked = asked.withColumn("_s0", F.least(F.col("_size"), held(F.col("_b0")) - F.col("_first")))
    asked = asked.withColumn("_s1", F.least(F.col("_size") - F.col("_s0"), held(F.col("_b1"))))
    asked = asked.withColumn("_s2", F.col("_size") - F.col("_s0") - F.col("_s1"))
    zero = F.lit(0).cast("long")
    before = (zero, F.col("_s0"), F.col("_s0") + F.col("_s1"))
    pieces = asked.select("feature", "repeat", "_to", F.inline(F.array(*[
        F.struct(F.col(f"_b{i}").alias("_source"), ((F.col("_first") if i == 0 else zero) + 1).cast("int").alias("_begin"),
                 F.col(f"_s{i}").cast("int").alias("_n"), (before[i] + 1).cast("int").alias("_place")) for i in range(3)
    ]))).filter("_n > 0")
    kinds = dict(sample.dtypes)
    types = list(dict.fromkeys(kinds[c] for c in columns))

    def values(kind: str):
        out = F.array().cast(f"array<{kind}>")
        for c in columns:
            if kinds[c] == kind:
                out = F.when(F.col("feature") == c, F.slice(F.col("_rows")[c], F.col("_begin"), F.col("_n"))).otherwise(out)
        return out

    sent = pieces.join(blocks, F.col("_source") == F.col("_block")).select(
        "feature", "repeat", "_to", "_n", "_place", *[values(t).alias(f"_d{i}") for i, t in enumerate(types)]
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    met = sent.repartition(tasks, "_to").join(blocks, F.col("_to") == F.col("_block"))
    met = met.select("feature", "repeat", F.slice("_rows", F.col("_place"), F.col("_n")).alias("_r"), *[f"_d{i}" for i in range(len(types))])
    copies = met.select("feature", "repeat", F.inline(F.arrays_zip("_r", *[f"_d{i}" for i in range(len(types))])))
    own = {c: F.when(F.col("feature") == c, F.col(f"_d{types.index(kinds[c])}")).otherwise(F.col("_r")[c]) for c in columns}
    return copies.select("feature", "repeat", *[own.get(c, F.col("_r")[c]).alias(c) for c in names])


def permutation_importance(
    fitted: FittedModel, df: DataFrame, columns: list[str], repeats: int = 10, sample_rows: int | None = None
) -> DataFrame:
    """Mean loss of ROC-AUC when one raw column is shuffled, over all rows or a stated sample in hash order.

    Rows get places in one hash order without a single-task sort. In a copy, a row takes the column from the row some places on (around the end);
    how many follows from feature and repeat. All copies are scored in one job. Only the column's values travel for a copy, in arrays of
    consecutive places; its rows are made, scored and counted by score in the same task.
    """
    key = fitted.key
    rows = df.orderBy(F.xxhash64(key, F.lit(SEED)), key).limit(sample_rows) if sample_rows else df
    rows = rows.withColumns({"_score": F.xxhash64(key).cast("double"), "_tie": F.xxhash64(key, F.lit(SEED))})
    sample = stored(ranked(rows, [], "_score", "_tie", "_at").drop("_score", "_tie"), "importance-rows")
    mixed = shifted_copies(sample, columns, repeats)
    base = auc_ks(fitted.predict(sample.drop("_at")), ["model"]).select("roc_auc").scalar()
    by = ["feature", "repeat"]
    shuffled = auc_ks_of_counts(stored(score_counts(fitted.predict(mixed, tuple(by)), by), "importance-scores"), by)
    return shuffled.withColumn("_base", base).groupBy("feature").agg(
        F.avg(F.col("_base") - F.col("roc_auc")).alias("importance")
    ).orderBy(F.col("importance").desc(), "feature")


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)
