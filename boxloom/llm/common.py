"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxloom.session import checkpointed

#: White space of the contracts: [\x20\x09-\x0D].
SPACE = " \t\n\v\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_AZ = {ord(c): ord(c) + 32 for c in UPPER}
#: Stands for a null id inside operators: smaller than every id that a table can hold in practice.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text: str) -> str:
    """Lower-case A-Z only."""
    return text.lower() if text.isascii() else text.translate(LOWER_AZ)


def texts(column: pa.Array) -> list[str]:
    """The strings of an Arrow column, a null as an empty text."""
    return [x or "" for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice hold about `most` bytes; one longer text is a slice of its own."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()  # workers stay alive between tasks


def lists(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def known_id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def real_id(name: str, alias: str | None = None) -> Column:
    """Undo `known_id`."""
    return F.when(F.col(name) != NULL_ID, F.col(name)).alias(alias or name)


__all__ = ["SPACE", "LOWER_AZ", "NULL_ID", "table", "lower_az", "texts", "slices", "lists", "known_id", "real_id", "checkpointed"]
