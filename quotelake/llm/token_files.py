"""Token ids in ORC files: integer run-length encoding, row index, Bloom filter.

Files hold whole documents in ascending order of their ids, so a reader that asks
for some of them skips files and stripes by the smallest and largest doc_id and
by its Bloom filter, and stripes are read in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelake.llm.common import or_empty
from quotelake.llm.tokens import ID_BYTES, PIECE, encoder, in_pieces, little_endian

#: ORC settings: what a reader needs to skip stripes and groups of rows.
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.create.index": "true",
    "orc.row.index.stride": "10000",
    "orc.stripe.size": str(64 << 20),
}


def _encoding(path: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, end, done = encoder(path), little_endian([end_id]), 0
        for batch in in_pieces(batches, rows=4096, size=PIECE):
            ids = [x + end for x in found.encode(batch.column("text"))]
            sizes = np.array([len(x) // ID_BYTES for x in ids], np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            values = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))
            before = pa.array(done + ends[:-1])
            done += int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), before, lists],
                names=["doc_id", "tie", "before", "ids"],
            )

    return encode


def write_token_ids(docs: DataFrame, folder: str, path: str, end_id: int = 2) -> None:
    """Write the ids of every whole text, ``end_id`` after each, to ORC files.

    Columns: doc_id, tie (a hash of the text, which orders rows of one doc_id),
    before (ids of the file before the row) and ids. ``path`` names a file of the
    tokenizers library that every worker can open. A null text is an empty one
    and has ``end_id`` alone; rows without doc_id come first; repeated rows are
    all written; an empty table gives files without rows. Other columns are left
    out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", or_empty("text").alias("text"))
    texts = texts.withColumn("tie", F.xxhash64("text"))
    ordered = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    encoded = ordered.mapInArrow(
        _encoding(path, end_id), f"doc_id {kind}, tie bigint, before bigint, ids array<int>"
    )
    encoded.write.options(**ORC_OPTIONS).orc(folder)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        values = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        ends = ID_BYTES * np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
        sums = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        rest = [batch.column(n) for n in ("file", "doc_id", "tie", "before")]
        yield pa.RecordBatch.from_arrays(
            [*rest, ids.value_lengths().cast(pa.int64()), pa.array(sums, pa.int64())],
            names=["file", "doc_id", "tie", "before", "n_tokens", "ids_crc32"],
        )


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per written row: file, doc_id, tie, before, n_tokens and ids_crc32."""
    files = spark.read.orc(folder)
    kind = files.schema["doc_id"].dataType.simpleString()
    shape = f"file string, doc_id {kind}, tie bigint, before bigint, n_tokens bigint, ids_crc32 bigint"
    named = files.select(F.col("_metadata.file_name").alias("file"), *files.columns)
    return named.mapInArrow(_digests, shape)


def with_starts(digests: DataFrame) -> DataFrame:
    """doc_id, start (ids of all rows before it in all files), n_tokens, ids_crc32.

    Only one row per file is put in order in one place; their number is that of
    the writer's tasks.
    """
    first = F.min(F.struct("doc_id", "tie")).alias("first")
    files = digests.groupBy("file").agg(first, F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    joined = digests.join(bases, "file")
    return joined.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
