"""Helpers shared by the corpus operators."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editengine.session import shared_dir

# Texts handled at a time inside a task, by count and by characters.
SLICE_ROWS, SLICE_CHARS = 256, 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read from there: computed once, whatever is lost later."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text is the empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def crc_rest(column: str, modulus: int):
    """crc32 of the id as text, by a modulus: the split into training and held-out documents."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batches, short enough to be handled at once, with one column as a list."""
    for batch in batches:
        k = batch.schema.get_field_index(column)
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            values, first, size = part.column(k).to_pylist(), 0, 0
            for i, value in enumerate(values):
                size += len(value or "")
                if size > chars or i + 1 == len(values):
                    yield part.slice(first, i + 1 - first), values[first : i + 1]
                    first, size = i + 1, 0


def by_slice(df: DataFrame, fn: Callable[[pa.RecordBatch, list], list], schema: str, column: str = "text", chars: int = SLICE_CHARS) -> DataFrame:
    """Apply ``fn(rows, texts) -> columns`` slice by slice in the tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for part, values in slices(batches, column, chars):
            columns = fn(part, values)
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(columns, target.types, strict=True)],
                    schema=target,
                )

    return df.mapInArrow(run, schema)


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row after the other, for rows that are large."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def crc32(data: bytes, start: int = 0) -> int:
    return zlib.crc32(data, start) & 0xFFFFFFFF


def joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and where each value begins (with the end as the last entry)."""
    ends = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in values], out=ends[1:])
    return np.frombuffer(b"".join(values), dtype=np.uint8), ends


def components(links: DataFrame, label: str) -> DataFrame:
    """``node``, ``root``: for every node that is not the smallest of its component over the links
    (``a``, ``b``), the one that is.

    Large-star and small-star rounds: each hangs neighbours on the smallest one known, until every node hangs
    on one that hangs on none. A node's neighbours are only summed up by their minimum and then joined, never
    gathered; every round is written to the shared folder.
    """
    edges = cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    while not _stars(edges):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = cut(small.select("e.a", "e.b").where("a != b").distinct(), label)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether each ``a`` has one ``b`` that has none itself; the smaller end is then the smallest of its component."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("e"))
    held = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.count(F.lit(1)).alias("n"))
    return held.where("up > 1 OR (up = 1 AND n > 1)").isEmpty()


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
