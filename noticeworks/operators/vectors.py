"""Texts to vectors, selection of pending notices and vector write-back."""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from noticeworks import model as M
from noticeworks.functions import text as X


def hash_vectors(df: DataFrame, text: str = "text", dim: int = M.EMBED_DIM, out: str = "embedding") -> DataFrame:
    """Default vectors: hashed word counts of the text, scaled to length one (JVM-side).

    A text without any word has no vector.
    """
    words = F.filter(
        F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != ""
    )
    counted = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim).transform(
        df.withColumn("_words", F.coalesce(words, F.array().cast("array<string>")))
    )
    scaled = Normalizer(inputCol="_tf", outputCol="_unit").transform(counted)
    vector = F.when(F.size("_words") > 0, vector_to_array("_unit", "float32"))
    return scaled.withColumn(out, vector).drop("_words", "_tf", "_unit")


def embed(
    df: DataFrame,
    embed_batch: Callable[[list[str]], list],
    text: str = "text",
    out: str = "embedding",
    chunk: int = M.EMBED_BATCH,
) -> DataFrame:
    """Vectors from a caller's batch function, null for blank texts and for failures.

    Texts go to ``embed_batch`` in chunks; when a chunk fails, its texts are tried one by one, so
    that one bad text costs only itself.
    """

    def one_by_one(texts):
        vectors = []
        for t in texts:
            try:
                vectors.append(embed_batch([t])[0])
            except Exception:  # any failure of the caller's model leaves the vector empty
                vectors.append(None)
        return vectors

    @F.pandas_udf("array<float>")
    def run(texts: pd.Series) -> pd.Series:
        vectors: list = [None] * len(texts)
        wanted = [i for i, t in enumerate(texts) if isinstance(t, str)]
        for start in range(0, len(wanted), chunk):
            places = wanted[start:start + chunk]
            part = [texts.iloc[i] for i in places]
            try:
                got = list(embed_batch(part))
                if len(got) != len(part):
                    raise ValueError("one vector per text expected")
            except Exception:
                got = one_by_one(part)
            for i, vector in zip(places, got):
                vectors[i] = None if vector is None else np.asarray(vector, dtype=np.float32)
        return pd.Series(vectors, index=texts.index, dtype=object)

    ready = F.when(X.strip(F.col(text)) != "", F.col(text))
    return df.withColumn(out, run(ready))


def pending(notices: DataFrame, n: int | None = M.EMBED_BATCH, id_col: str = "id") -> DataFrame:
    """Up to ``n`` notices without a vector: detailed ones, or any only if none is detailed.

    All notices without a vector if ``n`` is None; without the column ``embedding`` none has one.

    One top-n ordered by (not detailed, id) holds the answer: if any detailed notice is pending,
    the top-n starts with detailed ones, and the others in it are dropped.
    """
    if "embedding" in notices.columns:
        notices = notices.where(F.col("embedding").isNull())
    if n is None:
        return notices
    tier = F.when(F.col("detail_scraped"), 0).otherwise(1)
    top = (
        notices.withColumn("_tier", tier)
        .orderBy("_tier", id_col).limit(n)
    )
    # The window runs over the n rows of the top-n, nothing more.
    best = F.min("_tier").over(Window.partitionBy(F.lit(0)))
    return top.withColumn("_best", best).where("_tier = _best").drop("_tier", "_best")
