"""Text vectors and exact vector search."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costwatch.functions.terms import hashed_cells, list_slices
from costwatch.functions.text import tokenize
from costwatch.operators.blocks import dense_top_k
from costwatch.settings import TOP_K

DIMENSIONS = 64


def encode(
    df: DataFrame,
    id_col: str,
    text_col: str = "text",
    dimensions: int = DIMENSIONS,
    encoder: Callable[[list[str]], np.ndarray] | None = None,
) -> DataFrame:
    """(id, embedding): unit-norm vectors of whole texts; a text without tokens gives zeros.

    Default: signed feature hashing of the tokens. An own `encoder` maps a list of texts to
    a matrix and runs batch by batch on the executors.
    """
    if encoder is not None:
        return _encode_with(df, id_col, text_col, encoder)
    terms = F.transform(tokenize(F.col(text_col)), lambda t: F.struct(t.alias("term"), F.lit(1).cast("bigint").alias("tf")))
    return _hashed(df.select(id_col, terms.alias("_counts")), id_col, dimensions)


def encode_counted(counted: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """`encode` of the texts of an index of `tokenize`, from its counted terms: no text is read again."""
    return _hashed(counted.select("document_id", F.col("counts").alias("_counts")), "document_id", dimensions)


def _hashed(rows: DataFrame, id_col: str, dimensions: int) -> DataFrame:
    """(id, embedding) of (id, _counts), lists of (term, tf); rows of one id are added up.

    Each distinct term of a batch is hashed once; a row leaves its task as one row of cells.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in hashed_cells(list_slices(batch), dimensions):
                yield pa.record_batch(list(columns), [id_col, "_cells"])

    kind = rows.schema[id_col].dataType.simpleString()
    none = F.array().cast("array<struct<term:string,tf:bigint>>")
    cells = rows.select(id_col, F.coalesce("_counts", none).alias("_counts"))
    cells = cells.mapInArrow(add_up, f"`{id_col}` {kind}, _cells array<bigint>")
    sums = [F.sum(F.col("_cells")[i]).cast("double").alias(f"_{i}") for i in range(dimensions)]
    added = cells.groupBy(id_col).agg(*sums).select(id_col, F.array(*[f"_{i}" for i in range(dimensions)]).alias("_cells"))
    norm = F.sqrt(F.aggregate("_cells", F.lit(0.0), lambda total, v: total + v * v))
    added = added.withColumn("_norm", norm)
    unit = lambda v: F.when(F.col("_norm") > 0, v / F.col("_norm")).otherwise(0.0).cast("float")
    return added.select(id_col, F.transform("_cells", unit).alias("embedding"))


def _encode_with(df: DataFrame, id_col: str, text_col: str, encoder: Callable) -> DataFrame:
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            matrix = np.asarray(encoder(list(frame[text_col])), dtype=np.float64)
            norms = np.linalg.norm(matrix, axis=1, keepdims=True)
            matrix = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
            yield pd.DataFrame(
                {id_col: frame[id_col], "embedding": list(matrix.astype(np.float32))}
            )

    schema = T.StructType(
        [df.schema[id_col], T.StructField("embedding", T.ArrayType(T.FloatType()))]
    )
    return df.select(id_col, text_col).mapInPandas(batches, schema)


def dense_search(queries: DataFrame, corpus: DataFrame, k: int = TOP_K) -> DataFrame:
    """`k` nearest documents per query by cosine: (query_id, document_id, score, rank).

    Exact. `corpus` (document_id, embedding) is counted first, so pass a written table.
    """
    return dense_top_k(queries, corpus, corpus.count(), k)
