"""Column transformer fitted on the training part: impute, scale, encode, assemble."""
from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditecho.config import FEATURE_KINDS
from creditecho.operators import encoders as E
from creditecho.operators.cleaning import numeric_columns
from creditecho.operators.features import classify_columns
from creditecho.operators.joins import lookup_join


def column_kinds(train: DataFrame, target: str, key: str, config: dict = FEATURE_KINDS) -> dict[str, list[str]]:
    """Listed columns by kind; the rest by type and number of distinct values."""
    listed = {k: [c for c in cs if c in train.columns] for k, cs in config.items()}
    known = {c for cs in listed.values() for c in cs} | {target, key}
    rest = [c for c in train.columns if c not in known]
    numbers = [c for c in numeric_columns(train) if c in rest]
    listed["numeric_features"] += numbers
    texts = [c for c in rest if c not in numbers]
    if texts:
        for row in classify_columns(train.select(*texts), []).collect():
            listed[row["kind"]].append(row["feature"])
    if not any(listed.values()):
        raise ValueError("no usable feature columns in the training table")
    return listed


@dataclass
class Preprocessor:
    """Fitted statistics. Category means live in tables, everything else in small dictionaries."""

    target: str
    scale: bool
    numeric: dict[str, dict] = field(default_factory=dict)
    modes: dict[str, object] = field(default_factory=dict)
    ordinal: dict[str, list] = field(default_factory=dict)
    onehot: dict[str, list] = field(default_factory=dict)
    means: dict[str, DataFrame] = field(default_factory=dict)
    priors: dict[str, float] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        """Names of the vector slots in order."""
        hot = [f"{c}_{v}" for c, vs in self.onehot.items() for v in vs[1:]]
        return [*self.numeric, *self.ordinal, *hot, *self.means]

    def transform(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Adds ``features``; keeps only it and the ``keep`` columns."""
        slots: dict[str, object] = {}
        for c, s in self.numeric.items():
            x = F.coalesce(F.col(c).cast("double"), F.lit(s["median"]).cast("double"))
            slots[c] = (x - s["mean"]) / s["std"] if self.scale else x
        for c, values in self.ordinal.items():
            filled = df.withColumn(c, F.coalesce(F.col(c), F.lit(self.modes[c]))) if self.modes.get(c) is not None else df
            df, slots[c] = filled, E.encode_ordinal(c, values)
        for c, values in self.onehot.items():
            if self.modes.get(c) is not None:
                df = df.withColumn(c, F.coalesce(F.col(c), F.lit(self.modes[c])))
            slots |= E.encode_onehot(c, values)
        for c, table in self.means.items():
            df = df.withColumn(c, F.coalesce(F.col(c), F.lit("Unknown")))
            lookup = table.withColumnsRenamed({"_category": f"_k_{c}", "_encoded": f"_e_{c}"})
            df = lookup_join(df, lookup, F.col(c) == F.col(f"_k_{c}"))
            slots[c] = F.coalesce(F.col(f"_e_{c}"), F.lit(self.priors[c]))
        # slot columns get plain names so that category values never act as column syntax
        order = self.names
        flat = df.select(*keep, *[slots[n].alias(f"_f{i}") for i, n in enumerate(order)])
        return VectorAssembler(inputCols=[f"_f{i}" for i in range(len(order))], outputCol="features").transform(flat).select(*keep, "features")

    def save(self, spark: SparkSession, folder: str) -> None:
        state = {k: getattr(self, k) for k in ("target", "scale", "numeric", "modes", "ordinal", "onehot", "priors")}
        state["means"] = list(self.means)
        spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").text(f"{folder}/state")
        for i, table in enumerate(self.means.values()):
            table.write.mode("overwrite").parquet(f"{folder}/means_{i}")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Preprocessor:
        state = json.loads(spark.read.text(f"{folder}/state").first()[0])
        tables = {c: spark.read.parquet(f"{folder}/means_{i}") for i, c in enumerate(state.pop("means"))}
        return Preprocessor(**state, means=tables)


def fit_preprocessor(train: DataFrame, target: str, key: str, scale: bool, config: dict = FEATURE_KINDS) -> Preprocessor:
    kinds = column_kinds(train, target, key, config)
    out = Preprocessor(target, scale)
    if kinds["numeric_features"]:
        out.numeric = E.fit_numeric(train, kinds["numeric_features"])
    for c in kinds["ordinal_features"] + kinds["low_cardinality_nominal"]:
        out.modes[c] = E.mode_table(train, c).first()[0]
    out.ordinal = {c: E.sorted_categories(train, c) for c in kinds["ordinal_features"]}
    out.onehot = {c: E.sorted_categories(train, c) for c in kinds["low_cardinality_nominal"]}
    for c in kinds["high_cardinality_nominal"]:
        filled = train.withColumn(c, F.coalesce(F.col(c), F.lit("Unknown")))
        out.means[c] = E.fit_target(filled, c, target)
        out.priors[c] = train.agg(F.avg(F.col(target).cast("double"))).first()[0]
    return out
