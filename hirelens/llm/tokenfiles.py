"""Token-ID / binary output: flat unsigned integer files with document offsets.

A set of shards in ascending document order. Shard k has three files:

* ``<name>.bin``  the ids of its documents one after another, unsigned
  little-endian integers (16 bits if the vocabulary fits, else 32);
* ``<name>.idx``  64-bit offsets: where each document starts within the
  shard, in ids, plus the shard's length;
* ``<name>.doc``  the 64-bit document ids (those of the first ``n_null``
  documents are null).

``manifest`` (Parquet, in the same folder) has a row per shard with its number
of documents and ids and its base: the ids of all shards before it, a prefix
sum. base + offset is a document's place in the whole corpus. Readers map the
files into memory.

Each attempt of a task writes files of its own name, and only the attempt that
Spark commits reaches the manifest, so a lost executor, a retry or a
speculative twin leaves nothing but unlisted files.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.tokens import encoder, shipped, some_texts

SHARD = "shard int, name string, n_docs long, n_null long, n_tokens long"


def _store(where: str):
    """(filesystem, path) of a folder that all executors see."""
    from pyarrow import fs
    if "://" in where or where.startswith("file:"):
        return fs.FileSystem.from_uri(where.replace("file:/", "file:///", 1) if where.startswith("file:/")
                                      and not where.startswith("file://") else where)
    return fs.LocalFileSystem(), where


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False) -> DataFrame:
    """Write ``docs`` as token files under ``folder`` (in a store that driver
    and executors share) and return the manifest. ``tokenizer``: the path of a
    ``tokenizers`` file where the job is planned; a special token's string in a
    text is that token unless ``special_as_text``.

    A null text has no ids but its end id. Documents are in ascending order of
    id, null ids first; rows with the same id follow a hash of their text, so
    the files do not depend on the input's order. Other columns are ignored.
    An empty table gives no shards. The ranges are Spark's: a hot id with many
    texts is dealt by the text's hash; identical rows stay together.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"),
                       F.xxhash64(docs[text_col]).alias("h"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")
    run = uuid.uuid4().hex[:8]
    file = shipped(spark, tokenizer)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        enc, out = encoder(file, special_as_text), None
        end = np.array([end_id], enc.dtype).tobytes()
        name = f"{run}-{task.partitionId():06d}-{task.taskAttemptId()}"
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        n_null = 0
        store, base = _store(folder)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if texts and out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}.bin")
            for lo, hi in some_texts(texts):
                parts = [t + end for t in enc.encode(texts[lo:hi])]
                out.write(b"".join(parts))
                lengths.append(np.fromiter(map(len, parts), np.int64, len(parts)) // enc.dtype.itemsize)
            keys = batch.column("doc_id")
            n_null += keys.null_count
            ids.append(np.asarray(keys.fill_null(0)))
        if out is None:
            return
        out.close()
        size = np.concatenate(lengths)
        offsets = np.zeros(len(size) + 1, "<i8")
        np.cumsum(size, out=offsets[1:])
        for ending, data in (("idx", offsets), ("doc", np.concatenate(ids).astype("<i8"))):
            with store.open_output_stream(f"{base}/{name}.{ending}") as f:
                f.write(data.tobytes())
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([task.partitionId()], pa.int32()), "name": [name],
            "n_docs": pa.array([len(size)], pa.int64()), "n_null": pa.array([n_null], pa.int64()),
            "n_tokens": pa.array([int(offsets[-1])], pa.int64())})

    listed = f"{folder.rstrip('/')}/shards-{run}"
    ordered.mapInArrow(write, SHARD).write.parquet(listed)
    shards = spark.read.schema(SHARD).parquet(listed)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    (shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
     .withColumn("id_bytes", F.lit(_id_bytes(tokenizer)))
     .write.mode("overwrite").parquet(f"{folder.rstrip('/')}/manifest"))
    return manifest(spark, folder)


def _id_bytes(tokenizer: str) -> int:
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))])
    return 2 if most < 1 << 16 else 4


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{SHARD}, base long, id_bytes int").parquet(f"{folder.rstrip('/')}/manifest")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """A row per document, from the files alone: doc_id, start (its place in
    the corpus), n_tokens, ids_crc32 (of the ids as 32-bit integers) and, if
    asked for, ids (an array). One task reads a shard or a few, mapped."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    shards = manifest(spark, folder)
    shards = shards.repartition(max(1, shards.count()), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, keys = mapped(folder, row["name"], row["id_bytes"])
                for lo in range(0, row["n_docs"], 2000):
                    hi = min(lo + 2000, row["n_docs"])
                    off = offsets[lo:hi + 1]
                    wide = ids[off[0]:off[-1]].astype("<u4")
                    at = off - off[0]
                    key = np.arange(lo, hi) < row["n_null"]
                    out = {
                        "doc_id": pa.array(np.asarray(keys[lo:hi], np.int64), mask=key),
                        "start": pa.array(row["base"] + np.asarray(off[:-1], np.int64)),
                        "n_tokens": pa.array(np.diff(off).astype(np.int64)),
                        "ids_crc32": pa.array([zlib.crc32(wide[a:b]) for a, b in zip(at[:-1], at[1:])], pa.int64()),
                    }
                    if with_ids:
                        out["ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(wide.astype(np.int64)))
                    yield pa.RecordBatch.from_pydict(out)

    return shards.mapInArrow(read, schema)


def mapped(folder: str, name: str, id_bytes: int):
    """(ids, offsets, document ids) of a shard: memory maps where the folder
    is a mounted one, else arrays over what the store returns."""
    from pyarrow import fs
    store, base = _store(folder)
    kinds = (("bin", f"<u{id_bytes}"), ("idx", "<i8"), ("doc", "<i8"))
    if isinstance(store, fs.LocalFileSystem):
        return tuple(np.memmap(f"{base}/{name}.{ending}", kind, "r") for ending, kind in kinds)
    out = []
    for ending, kind in kinds:
        with store.open_input_file(f"{base}/{name}.{ending}") as f:
            out.append(np.frombuffer(f.read_buffer(), kind))
    return tuple(out)
