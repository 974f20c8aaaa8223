"""A pluggable encoder from texts to dense vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VECTOR_COLUMN = "text_vector"


def encode(
    df: DataFrame,
    text_col: str,
    load_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    vector_col: str = VECTOR_COLUMN,
) -> DataFrame:
    """Add a dense vector per text; null texts give null.

    ``load_encoder`` runs once per task and returns a function from texts to a
    two-dimensional array, called once per Arrow batch.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load_encoder()
        for texts in batches:
            present = texts.drop_null().to_pylist()
            rows = iter(np.asarray(model(present), dtype="float32") if present else ())
            vectors = [next(rows).tolist() if t.is_valid else None for t in texts]
            yield pa.array(vectors, pa.list_(pa.float32()))

    return df.withColumn(vector_col, run(F.col(text_col)))
