"""Text to unit vectors: hashed words weighted by inverse document frequency, or a user model."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditecho.functions.text import tokens, with_prefix


@dataclass
class Encoder:
    model: PipelineModel

    def encode(self, df: DataFrame, text: str, name: str = "embedding") -> DataFrame:
        out = self.model.transform(df.withColumn("_words", tokens(F.col(text))))
        return out.withColumn(name, vector_to_array("_unit", "float32")).drop("_words", "_counts", "_weighted", "_unit")


def fit_encoder(docs: DataFrame, text: str, dim: int = 384) -> Encoder:
    """One pass for document frequencies; the vectors themselves are never collected."""
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim)
    words = docs.select(tokens(F.col(text)).alias("_words"))
    idf = IDF(inputCol="_counts", outputCol="_weighted").fit(counts.transform(words))
    return Encoder(PipelineModel([counts, idf, Normalizer(inputCol="_weighted", outputCol="_unit")]))


def encode_with(
    df: DataFrame, model: Callable[[pd.Series], np.ndarray], key: str, text: str, kind: str | None = None
) -> DataFrame:
    """(key, embedding) from a user model over batches of texts; ``kind`` adds a passage or query mark."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.asarray(model(b["_text"]), dtype=np.float64)
            v = v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-12)
            yield pd.DataFrame({key: b[key].to_numpy(), "embedding": list(v.astype(np.float32))})

    source = with_prefix(F.col(text), kind) if kind else F.col(text)
    return df.select(key, source.alias("_text")).mapInPandas(task, f"{key} {dict(df.dtypes)[key]}, embedding array<float>")
