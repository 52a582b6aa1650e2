from pathlib import Path

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditecho.catalog.models import SETTINGS
from creditecho.config import PARAM_GRIDS
from creditecho.operators import encoders as E
from creditecho.operators import metrics as M
from creditecho.operators import models as L
from creditecho.operators import splits as P
from creditecho.operators.preprocess import Preprocessor, fit_preprocessor
from creditecho.operators.resample import smote
from creditecho.session import checkpointed, drop_checkpoints

KINDS = {
    "numeric_features": ("x", "z"), "ordinal_features": ("years",), "low_cardinality_nominal": ("term",), "high_cardinality_nominal": ("title",),
}


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        (i, float(i % 50) if i % 7 else None, float(i % 3), i % 4, 36 if i % 2 else 60, f"t{i % 6}" if i % 5 else None, int(i % 50 > 44))
        for i in range(600)
    ]
    return spark.createDataFrame(rows, "id long, x double, z double, years int, term int, title string, default_flag int")


def test_encoders_follow_their_rules(spark):
    rows = spark.createDataFrame([("a", 1)] * 20 + [("b", 0)] * 2, "c string, y int")
    got = {r._category: r._encoded for r in E.fit_target(rows, "c", "y").collect()}
    prior = 20 / 22
    assert got["a"] == pytest.approx(0.5 * 1 + 0.5 * prior)  # twenty rows weigh one half
    unseen = E.encode_target(spark.createDataFrame([("z",)], "c string"), rows, "c", "y").first()[0]
    assert unseen == pytest.approx(prior)
    df = spark.createDataFrame([(2,), (9,), (None,)], "v int")
    assert [r[0] for r in df.select(E.encode_ordinal("v", [1, 2, 3])).collect()] == [1.0, -1.0, -1.0]
    assert list(E.encode_onehot("v", [1, 2, 3])) == ["v_2", "v_3"]
    ties = spark.createDataFrame([(3,), (1,), (3,), (1,), (None,)], "v int")
    assert E.mode_table(ties, "v").first()[0] == 1
    with pytest.raises(ValueError):
        E.sorted_categories(ties, "v", limit=1)


def test_preprocessor_round_trip(spark, table, tmp_path):
    pre = fit_preprocessor(table, "default_flag", "id", True, KINDS)
    assert pre.names == ["x", "z", "years", "term_60", "title"]
    pre.save(spark, str(tmp_path / "p"))
    again = Preprocessor.load(spark, str(tmp_path / "p"))
    a, b = (p.transform(table, ["id"]).orderBy("id").collect() for p in (pre, again))
    assert a == b and len(a) == 600


def test_smote_reaches_parity_between_minority_points(spark, table):
    rows = fit_preprocessor(table, "default_flag", "id", False, KINDS).transform(
        table.withColumn("label", F.col("default_flag")), ["id", "label"]
    )
    out = smote(rows).withColumn("f", vector_to_array("features"))
    assert len({r["count"] for r in out.groupBy("label").count().collect()}) == 1
    low, high = out.filter("label = 1").agg(F.min(F.get("f", F.lit(0))), F.max(F.get("f", F.lit(0)))).first()
    assert low >= 22 and high <= 49  # missing x became the median, all else lies above 44


@pytest.mark.parametrize("name,balance", [("logistic_regression", "weights"), ("random_forest", "smote"), ("knn", "none")])
def test_models_learn_a_separable_rule_and_reload(spark, table, tmp_path, name, balance):
    params = {"random_forest": {"n_estimators": 5, "max_depth": 4}, "knn": {"n_neighbors": 3}}.get(name, {})
    fitted = L.train_model(name, table, params, balance=balance, config=KINDS)
    result = M.auc_ks(fitted.predict(table)).first()
    assert result.roc_auc > 0.8
    fitted.save(spark, str(tmp_path / "m"))
    again = L.FittedModel.load(spark, str(tmp_path / "m")).predict(table)
    key = lambda df: sorted((r.id, round(r.probability, 9)) for r in df.collect())
    assert key(again) == key(fitted.predict(table))


def test_grid_search_errors_and_importance(spark, table):
    folded = P.stratified_folds(table, folds=2)
    rows, best = L.grid_search("logistic_regression", folded, {"C": [0.1, 10.0]}, balance="none", config=KINDS)
    assert len(rows) == 2 and best["folds"] == 2 and best["mean_auc"] > 0.6
    models, errors = L.train_all(table, {"nope": {}, "random_forest": {"n_estimators": 3, "max_depth": 3}}, balance="none", config=KINDS)
    assert list(models) == ["random_forest"] and "nope" in errors
    assert L.native_importance(models["random_forest"], spark).first()["feature"] == "x"
    assert L.permutation_importance(models["random_forest"], table, ["x", "z"], repeats=2).first()["feature"] == "x"
    with pytest.raises(ValueError):
        L.train_model("nope", table)


def test_boosted_trees_are_a_candidate_of_the_grid(spark):
    settings = SETTINGS["xgboost"]
    assert settings.keys() == PARAM_GRIDS["xgboost"].keys() and all(v in PARAM_GRIDS["xgboost"][k] for k, v in settings.items())
    fit = L.classifier("xgboost", settings, 1000)
    assert fit.getMaxIter() >= 100 and fit.getSubsamplingRate() == 0.8 and fit.getFeatureSubsetStrategy() == "0.8"


@pytest.mark.parametrize("n,size", [(5, 4), (24, 4), (50, 64)])
def test_copies_take_a_column_from_rows_some_places_on(spark, monkeypatch, n, size):
    monkeypatch.setattr(L, "BLOCK_ROWS", size)
    df = spark.range(n).select(
        (F.col("id") + 1).alias("_at"), "id", F.when(F.col("id") % 3 != 0, F.col("id") + 0.5).alias("a"), F.concat(F.lit("t"), "id").alias("t")
    )
    got = {(r.feature, r.repeat, r.id): (r.a, r.t) for r in L.shifted_copies(df, ["a", "t"], 3).collect()}
    shift = spark.createDataFrame([(f, r) for f in "at" for r in range(3)], "feature string, repeat int")
    shift = shift.withColumn("by", 1 + F.pmod(F.xxhash64("feature", "repeat", F.lit(L.SEED)), F.lit(n - 1))).collect()
    rows, want = df.orderBy("_at").collect(), {}
    for f, r, by in shift:
        for x in rows:
            y = rows[(x.id + by) % n]
            want[f, r, x.id] = (y.a, x.t) if f == "a" else (x.a, y.t)
    assert got == want and len(got) == 6 * n


def test_checkpoints_that_were_stored_again_are_deleted(spark):
    first = checkpointed(spark.range(10))
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.glob("rdd-*"))
    again = checkpointed(first.withColumn("x", F.col("id") + 1))
    assert len(set(folder.glob("rdd-*")) - before) == 1
    drop_checkpoints(first)
    assert len(before - set(folder.glob("rdd-*"))) == 1 and again.count() == 10
