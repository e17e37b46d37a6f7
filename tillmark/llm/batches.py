"""Arrow batches of texts, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

# A-Z to a-z in UTF-8 bytes, all else unchanged.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def pieces(
    batch: pa.RecordBatch, texts: pa.Array, most_bytes: int = 4 << 20
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch whose texts come to about `most_bytes` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(batch):
        reach = (ends[start - 1] if start else 0) + most_bytes
        stop = max(start + 1, int(np.searchsorted(ends, reach, side="right")))
        yield batch.slice(start, stop - start), texts.slice(start, stop - start)
        start = stop


def bounded(spark: SparkSession, most_bytes: int = 8 << 20) -> None:
    """From now on Arrow batches stop at about `most_bytes`, so that rows with long texts don't
    come by the ten thousand. A single row may be larger. It stays so: results are lazy, and the setting
    counts when they are run."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts as bytes, null as empty."""
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def strings(texts: pa.Array) -> list[str]:
    """The texts, null as empty, bytes that aren't UTF-8 as U+FFFD."""
    return [t.decode("utf-8", "replace") for t in utf8(texts)]


def extended(schema: StructType, ddl: str) -> StructType:
    """A schema and further columns."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])
