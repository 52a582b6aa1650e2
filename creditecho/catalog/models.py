"""Model queries over the loan table and the labelled vectors."""
from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditecho.catalog.loans import cleaned_loans
from creditecho.catalog.registry import Registry, rounded
from creditecho.config import NOTEBOOK_SELECTED, PARAM_GRIDS
from creditecho.operators import features as X
from creditecho.operators import knn
from creditecho.operators import metrics as M
from creditecho.operators import models as L
from creditecho.operators import splits as S
from creditecho.operators.cleaning import clean_loans
from creditecho.operators.preprocess import fit_preprocessor
from creditecho.operators.resample import smote
from creditecho.session import checkpointed, drop_checkpoints
from creditecho.sources import sinks
from creditecho.sources.tables import doc_vectors, stored_loans

R = Registry()
SETTINGS = {
    "logistic_regression": {"C": 1.0, "penalty": "l2"},
    "hist_gradient_boosting": {"max_iter": 10, "max_depth": 3, "learning_rate": 0.1},
    "knn": {"n_neighbors": 5, "metric": "euclidean"},
    "random_forest": {"n_estimators": 20, "max_depth": 5, "min_samples_leaf": 2},
    "xgboost": {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8},
}
COLUMNS = [*dict.fromkeys(NOTEBOOK_SELECTED)]


def credit_parts(spark, sf):
    """(train, test) of the cleaned loans with the selected features, written once."""
    source = stored_loans(spark, sf)
    clean = checkpointed(clean_loans(source, keep=("id",)).data)
    drop_checkpoints(source)
    made = X.engineer_features(clean, [c for c in COLUMNS if c != "annual_inc"])
    chosen = checkpointed(made.select("id", "default_flag", *COLUMNS))
    drop_checkpoints(clean)
    parts = checkpointed(S.stratified_split(chosen))
    drop_checkpoints(chosen)
    return parts.filter(~F.col("is_test")).drop("is_test"), parts.filter(F.col("is_test")).drop("is_test")


def fitted(spark, sf, name, balance="smote"):
    train, test = credit_parts(spark, sf)
    return L.train_model(name, train, SETTINGS[name], balance=balance), test


@R.add("preprocess")
def _(spark, sf):
    df = checkpointed(cleaned_loans(spark, sf))
    pre = fit_preprocessor(df, "default_flag", "id", scale=True)
    rows = pre.transform(df, ["id"])
    return rows.select("id", vector_to_array("features").alias("f")).select("id", F.size("f").alias("slots"), F.get("f", F.lit(0)).alias("first_slot"))


@R.add("smote")
def _(spark, sf):
    train, _ = credit_parts(spark, sf)
    pre = fit_preprocessor(train, "default_flag", "id", scale=True)
    rows = checkpointed(pre.transform(train.withColumn("label", F.col("default_flag")), ["id", "label"]))
    return smote(rows).groupBy("label").agg(F.count("*").alias("n"))


def _model(name, key, balance="smote"):
    @R.add(key)
    def _(spark, sf):
        model, test = fitted(spark, sf, name, balance)
        return M.evaluate_all(checkpointed(model.predict(test)))


_model("logistic_regression", "ml_logreg")
_model("hist_gradient_boosting", "ml_hgb")
_model("random_forest", "ml_rf", "weights")
_model("xgboost", "ml_xgb")


@R.add("join_knn_class")
def _(spark, sf):
    model, test = fitted(spark, sf, "knn")
    return M.evaluate_all(checkpointed(model.predict(test)))


_HASHED = "md5(concat(vec_id, ':42')) || '|' || vec_id"


@R.add("ml_knn", f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS y FROM embeddings),
p AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {_HASHED}) <= round(0.2::DOUBLE*count(*) OVER (PARTITION BY y)) AS is_test FROM e),
d AS (SELECT q.vec_id AS query_id, t.y, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_distance(q.v, t.v),9), t.vec_id) AS r FROM p q, p t WHERE q.is_test AND NOT t.is_test)
SELECT query_id, round(avg(y),6) AS probability, CASE WHEN avg(y) > 0.5 THEN 1 ELSE 0 END AS prediction FROM d WHERE r <= 5 GROUP BY query_id""")
def _(spark, sf):
    rows = doc_vectors(spark, sf).select("doc_id", F.col("embedding").alias("vector"), (F.col("label") >= 5).cast("int").alias("label"))
    parts = checkpointed(S.stratified_split(rows, "doc_id", "label"))
    test = parts.filter("is_test").select(F.col("doc_id").alias("query_id"), "vector")
    return rounded(knn.knn_classify(test, parts.filter("NOT is_test"), 5))


@R.add("predict")
def _(spark, sf):
    model, test = fitted(spark, sf, "logistic_regression", "weights")
    return model.predict(test).select("id", "label", "probability", "prediction")


@R.add("train_all")
def _(spark, sf):
    train, test = credit_parts(spark, sf)
    models, errors = L.train_all(train, SETTINGS, balance="none")
    failed = spark.createDataFrame(list(errors.items()), "model string, error string")
    compared = M.compare_models(M.evaluate_all(checkpointed(L.predict_all(models, test))))
    return compared.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)


@R.add("grid_search")
def _(spark, sf):
    name, balance = "logistic_regression", "weights"
    train, test = credit_parts(spark, sf)
    rows, best = L.grid_search(name, checkpointed(S.stratified_folds(train)), PARAM_GRIDS[name], balance=balance)
    refit = M.auc_ks(L.train_model(name, train, best["params"], balance=balance).predict(test)).first()["roc_auc"]
    flat = [(r["model"], str(r["params"]), r["mean_auc"], r["folds"], r is best, refit if r is best else None) for r in rows]
    return spark.createDataFrame(flat, "model string, params string, mean_auc double, folds int, is_best boolean, refit_test_auc double")


@R.add("sink_model")
def _(spark, sf):
    model, test = fitted(spark, sf, "random_forest", "none")
    folder = sinks.work_folder(spark, "model")
    model.save(spark, folder)
    return spark.read.text(f"{folder}/info")


@R.add("src_model")
def _(spark, sf):
    model, test = fitted(spark, sf, "logistic_regression", "none")
    folder = sinks.work_folder(spark, "model")
    model.save(spark, folder)
    return L.FittedModel.load(spark, folder).predict(test).select("id", "probability", "prediction")


@R.add("importance_native")
def _(spark, sf):
    return L.native_importance(fitted(spark, sf, "random_forest", "none")[0], spark)


@R.add("top_features")
def _(spark, sf):
    return L.top_features(L.native_importance(fitted(spark, sf, "hist_gradient_boosting", "weights")[0], spark))


@R.add("importance_perm")
def _(spark, sf):
    model, test = fitted(spark, sf, "hist_gradient_boosting", "none")
    return L.permutation_importance(model, test, COLUMNS)
