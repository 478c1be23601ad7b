"""Token-ID output: documents as ids in range-coded frames, in ascending document order, and back.

`write_tokens` range-partitions the documents by id (ties by a hash of the text, so that no task gets all rows of one
id with different texts), sorts each partition, and turns it into frames of whole documents (see `rangecoder`). A folder of
frames is a Parquet table with one row per frame, so any store that Spark writes will do, and a lost task writes its frames
again. Ranges ascend with the partition's number, so (shard, frame) is the order of the documents.

`read_tokens` reads the frames back, checks every block, and gives each document's place in the whole stream. Starts come from
sums per frame within a shard and sums per shard, whose number is that of the writing tasks.

A null text is a document of the end id alone. A null id sorts first. Repeated ids are repeated documents. An empty table
gives no frames and no documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.columns import as_values, slices
from gaugeworks.llm.rangecoder import BLOCK, Frame, pack_frame
from gaugeworks.llm.tokens import encoder, ids_crc32
from gaugeworks.session import fresh_folder

END = 1
#: Words that a writing process remembers, about 150 MB; frames need little memory beside them.
REMEMBERED = 700_000
#: Text encoded at a time: a word is looked up once in it.
ENCODED_BYTES = 16 << 20
#: A frame is closed when it holds so many ids; it ends with a document.
FRAME_IDS = 8192 * BLOCK

FRAMES = "shard long, frame long, n_ids long, n_docs long, payload binary"
DOCUMENTS = "shard long, frame long, doc_id long, before long, n_tokens long, ids_crc32 long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = END, frame_ids: int = FRAME_IDS) -> None:
    """The documents' ids, each followed by ``end``, as frames in ``folder``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("body"))
    ties = [F.col("id").asc_nulls_first(), F.xxhash64("body")]
    rows = rows.repartitionByRange(*ties).sortWithinPartitions(*ties)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        ids: list = []
        bodies: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            data = pack_frame(ids, bodies)
            return pa.RecordBatch.from_pydict(
                {"shard": [shard], "frame": [number], "n_ids": [size], "n_docs": [len(ids)], "payload": [data]},
                pa.schema([("shard", pa.int64()), ("frame", pa.int64()), ("n_ids", pa.int64()), ("n_docs", pa.int64()), ("payload", pa.binary())]),
            )

        for whole in batches:
            for batch in slices(whole, [1], ENCODED_BYTES):
                flat, at = encoder(tokenizer, REMEMBERED).encode(as_values(batch.column(1)), end)
                for doc, a, b in zip(as_values(batch.column(0)), at, at[1:]):
                    ids.append(doc)
                    bodies.append(flat[a:b].tobytes())
                    size += int(b - a)
                    if size >= frame_ids:
                        yield close()
                        ids, bodies, size, number = [], [], 0, number + 1
        if ids:
            yield close()

    rows.mapInArrow(frames, FRAMES).write.mode("errorifexists").parquet(folder)


def read_frames(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(FRAMES).parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    frames = read_frames(spark, folder)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, payload in zip(*(batch.column(k).to_pylist() for k in range(3))):
                frame = Frame(payload)
                lengths = frame.lengths.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(lengths), pa.int64()),
                        pa.array([number] * len(lengths), pa.int64()),
                        pa.array(frame.doc_ids, pa.int64()),
                        pa.array(np.cumsum(lengths) - lengths),
                        pa.array(lengths),
                        pa.array([ids_crc32(np.frombuffer(d, "<u4")) for d in frame.documents()], pa.int64()),
                    ],
                    names=["shard", "frame", "doc_id", "before", "n_tokens", "ids_crc32"],
                )

    found = frames.select("shard", "frame", "payload").mapInArrow(documents, DOCUMENTS)
    earlier = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards = frames.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shard_start"))
    inside = W.partitionBy("shard").orderBy("frame").rowsBetween(W.unboundedPreceding, -1)
    places = frames.select("shard", "frame", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("frame_start")).join(shards, "shard")
    return found.join(places, ["shard", "frame"]).select(
        "doc_id", (F.col("shard_start") + F.col("frame_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = fresh_folder(spark, f"{spark.conf.get('spark.sql.warehouse.dir')}/llm")
    write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, folder)
