"""Helpers that the text operators share.

All operators take a table with `doc_id` (long) and `text` (string) and select these columns before
anything else, so further columns, whatever their names, cannot clash with their own. A null text
counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import scratch_path

#: Characters that a task handles at once; longer texts are handled alone.
BATCH_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared scratch folder and read it back; later steps start from there."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id apart by their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores in front until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def groups(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = BATCH_CHARS):
    """Rows of Arrow batches as (first columns..., texts) in groups of about `most` characters.

    Yields (dict of column -> list without `text`, list of texts); null texts come as "".
    """
    for batch in batches:
        names = [n for n in batch.schema.names if n != text]
        sizes = pa.compute.fill_null(pa.compute.utf8_length(batch[text]), 0).to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            total = np.cumsum(sizes[start:])
            count = max(1, int(np.searchsorted(total, most, side="right")))
            part = batch.slice(start, count)
            yield {n: part[n].to_pylist() for n in names}, [t or "" for t in part[text].to_pylist()]
            start += count


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, field.type) for c, field in zip(columns, schema)], schema=schema
    )
