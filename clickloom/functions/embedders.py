"""Embedders: a text or token column becomes an ``array<float>`` column in place.

Every row keeps its own vector, so no positional id and no join is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import non_blank
from clickloom.functions.vectors import DIMENSION, enforce_contract, float_array


class Embedder(Protocol):
    """Adds the vector of the tokens in column ``words`` as column ``vector``.

    A costly embedder is shown each distinct text once.
    """

    dimension: int
    costly: bool

    def embed(self, df: DataFrame, words: str, vector: str) -> DataFrame: ...


class HashingEmbedder:
    """Feature hashing: count the tokens per bucket, scale to length 1.

    Needs no model and runs in the JVM only. A token's bucket is the first 32 bits of its MD5
    modulo the dimension; a text without tokens has the zero vector.
    """

    costly = False

    def __init__(self, dimension: int = DIMENSION) -> None:
        self.dimension = dimension

    def embed(self, df: DataFrame, words: str, vector: str) -> DataFrame:
        buckets, counts, unit = (f"_{vector}_{part}" for part in ("buckets", "counts", "unit"))

        # If a few low digits decide the remainder, only they are converted.
        digits = next((n for n in range(1, 8) if 16**n % self.dimension == 0), 8)

        def bucket(word):
            low = F.conv(F.substring(F.md5(word), 9 - digits, digits), 16, 10).cast("bigint")
            return (low % self.dimension).cast("string")

        hashed = df.withColumn(buckets, F.transform(non_blank(words), bucket))
        # The bucket numbers are the whole vocabulary, so counting is one pass per row.
        counter = CountVectorizerModel.from_vocabulary(
            [str(i) for i in range(self.dimension)], inputCol=buckets, outputCol=counts
        )
        scaled = Normalizer(p=2.0, inputCol=counts, outputCol=unit).transform(counter.transform(hashed))
        return scaled.withColumn(vector, float_array(unit)).drop(buckets, counts, unit)


class ModelEmbedder:
    """A sentence model run on the executors.

    ``factory`` is called once per Python worker and returns a function from a list of texts to
    their vectors. Vectors are cut to ``dimension``; a shorter one fails the job.
    """

    costly = True

    def __init__(
        self,
        factory: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]],
        dimension: int = DIMENSION,
        batch_size: int = 256,
    ) -> None:
        self.factory = factory
        self.dimension = dimension
        self.batch_size = batch_size

    def embed_text(self, df: DataFrame, text: str, vector: str) -> DataFrame:
        factory, dimension, batch_size = self.factory, self.dimension, self.batch_size

        @F.pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = factory()
            for texts in batches:
                vectors: list[np.ndarray] = []
                for start in range(0, len(texts), batch_size):
                    part = texts.iloc[start : start + batch_size].tolist()
                    found = [np.asarray(v, dtype=np.float32)[:dimension] for v in model(part)]
                    if len(found) != len(part):
                        raise ValueError(f"{len(part)} texts gave {len(found)} vectors")
                    vectors.extend(found)
                yield pd.Series(vectors, index=texts.index, dtype=object)

        embedded = df.withColumn(vector, run(F.coalesce(F.col(text), F.lit(""))))
        return enforce_contract(embedded, vector, dimension)

    def embed(self, df: DataFrame, words: str, vector: str) -> DataFrame:
        text = f"_{vector}_text"
        prepared = df.withColumn(text, F.array_join(non_blank(words), " "))
        return self.embed_text(prepared, text, vector).drop(text)
