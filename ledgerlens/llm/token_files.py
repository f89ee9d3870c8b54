"""Token-id files with a shared zstandard dictionary and an offset index.

A file set is a Parquet container that Spark's committer writes (so lost
executors leave no half-written file, and any store that Spark reaches will
do).  Each container row is one block of the binary format:

* ``index``: per document, little-endian: int64 doc_id, uint32 place of its
  frame in the payload, uint32 frame size, uint64 tokens (24 bytes);
* ``payload``: one zstandard frame per document, compressed with the shared
  dictionary; the frame's content is the ids as little-endian uint16 or
  uint32 (``width`` bytes each);
* ``format``, ``width``, ``dictionary_hash``, ``shard``, ``block``,
  ``first_doc``, ``last_doc``, ``n_docs``, ``start_in_shard``, ``n_tokens``.

Beside it lie ``dictionary`` (its bytes and hash) and ``shards`` (tokens before
each shard).  A document is read by its block (first_doc and last_doc are
pushed to the scan), its index entry and one frame.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from . import tokens
from .common import documents, text_batches

FORMAT = "idpack-1"
END_ID = 2
ENTRY = np.dtype([("doc_id", "<i8"), ("at", "<u4"), ("size", "<u4"), ("tokens", "<u8")])
#: Bytes of payload and documents of a block (one longer document may exceed the first).
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4096
#: The dictionary's size, and the documents and tokens of each that it is trained on at most.
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_TOKENS = 64 << 10, 2000, 4096
LEVEL = 3
NO_ID = -(1 << 63)


def _serial(ids: np.ndarray, width: int) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


def train_dictionary(docs: DataFrame, path: str, width: int, end: int = END_ID) -> bytes:
    """A zstandard dictionary from the serialized ids of a bounded, hash-chosen sample of documents.

    The sample bounds only what the dictionary learns from; every document is
    encoded.  With too little text to train on, the sample itself serves as
    raw dictionary content.
    """
    import zstandard

    some = docs.where("text is not null and text <> ''")
    count = some.count()
    share = min(1.0, 0.9 * SAMPLE_DOCS / max(count, 1))
    chosen = some.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1)).limit(SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        for _, data, offsets in text_batches(batches):
            flat, borders = tokens.with_end(*encode.encode(data, offsets), end)
            yield pa.RecordBatch.from_arrays([pa.array([_serial(flat[a:b][:SAMPLE_TOKENS], width)
                                                        for a, b in zip(borders, borders[1:])], pa.binary())], ["ids"])

    samples = sorted(bytes(r["ids"]) for r in chosen.select("doc_id", "text").mapInArrow(run, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _shared(data: bytes):
    import zstandard
    return zstandard.ZstdCompressionDict(data) if data else None


def write(docs: DataFrame, out: str, path: str | None = None, end: int = END_ID) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the file set ``out`` in ascending doc_id order.

    A null text is empty, so its document holds ``end`` alone.  A null doc_id
    sorts first.  Rows with one doc_id are documents of their own, in the
    order of token count and checksum.  Other columns are ignored.
    """
    import zstandard

    spark = docs.sparkSession
    path = path or tokens.tokenizer_path("byte_bpe_50k.json")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = 2 if tokens.encoder(path).tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else 4
    dictionary = train_dictionary(docs, path, width, end)
    digest = hashlib.sha256(dictionary).hexdigest()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / parts for i in range(1, parts)] or [0.5]
    found = docs.agg(F.percentile_approx("doc_id", steps, 10_000).alias("q")).first()["q"]
    bounds = np.unique(np.array(found or [], dtype=np.int64))
    kind = "shard int, doc_id long, n_tokens long, ids_crc32 long, frame binary"

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_shared(dictionary))
        for rows, data, offsets in text_batches(batches):
            flat, borders = tokens.with_end(*encode.encode(data, offsets), end)
            doc = rows.column("doc_id")
            shard = np.searchsorted(bounds, doc.fill_null(NO_ID).to_numpy(), side="left")
            pairs = list(zip(borders.tolist(), borders[1:].tolist(), strict=False))
            yield pa.RecordBatch.from_arrays([
                pa.array(shard, pa.int32()), doc, pa.array(np.diff(borders), pa.int64()),
                pa.array([zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in pairs], pa.int64()),
                pa.array([pack.compress(_serial(flat[a:b], width)) for a, b in pairs], pa.binary()),
            ], ["shard", "doc_id", "n_tokens", "ids_crc32", "frame"])

    block_kind = ("format string, width int, dictionary_hash string, shard int, block int, first_doc long, last_doc long, "
                  "n_docs int, start_in_shard long, n_tokens long, index binary, payload binary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        state = {"shard": None, "block": 0, "start": 0, "bytes": 0}

        def flush() -> pa.RecordBatch:
            index, at = np.zeros(len(held), ENTRY), 0
            for i, (doc, n, frame) in enumerate(held):
                index[i] = (NO_ID if doc is None else doc, at, len(frame), n)
                at += len(frame)
            total = int(index["tokens"].sum())
            row = {"format": FORMAT, "width": width, "dictionary_hash": digest, "shard": state["shard"], "block": state["block"],
                   "first_doc": int(index["doc_id"][0]), "last_doc": int(index["doc_id"][-1]), "n_docs": len(held),
                   "start_in_shard": state["start"], "n_tokens": total, "index": index.tobytes(),
                   "payload": b"".join(f for _, _, f in held)}
            state.update(block=state["block"] + 1, start=state["start"] + total, bytes=0)
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=BLOCK)

        for batch in batches:
            for shard, doc, n, frame in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "n_tokens", "frame")), strict=True):
                if held and (shard != state["shard"] or state["bytes"] >= BLOCK_BYTES or len(held) >= BLOCK_DOCS):
                    yield flush()
                if shard != state["shard"]:
                    state.update(shard=shard, block=0, start=0, bytes=0)
                held.append((doc, n, frame))
                state["bytes"] += len(frame)
        if held:
            yield flush()

    frames = docs.mapInArrow(compress, kind)
    sorted_ = frames.repartition(parts, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "n_tokens", "ids_crc32")
    sorted_.mapInArrow(blocks, block_kind).write.parquet(f"{out}/blocks")
    spark.createDataFrame([(digest, bytearray(dictionary))], "hash string, dictionary binary").coalesce(1).write.parquet(f"{out}/dictionary")
    sizes = spark.read.parquet(f"{out}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_docs").alias("n_docs"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard, so at most a row per task
    sizes.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{out}/shards")


BLOCK = pa.schema([("format", pa.string()), ("width", pa.int32()), ("dictionary_hash", pa.string()), ("shard", pa.int32()),
                   ("block", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("n_docs", pa.int32()),
                   ("start_in_shard", pa.int64()), ("n_tokens", pa.int64()), ("index", pa.binary()), ("payload", pa.binary())])


def _dictionary(spark: SparkSession, path: str) -> tuple[bytes, str]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(row["dictionary"])
    if hashlib.sha256(data).hexdigest() != row["hash"]:
        raise ValueError("the dictionary's hash does not match")
    return data, row["hash"]


def _unpack(index: bytes, payload: bytes, width: int, unpacker, doc: int | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc_id, tokens before it in the block, ids) of a block's documents, or of those with id ``doc``."""
    entries = np.frombuffer(index, ENTRY)
    before = np.cumsum(entries["tokens"]) - entries["tokens"]
    view = memoryview(payload)
    for i in range(len(entries)) if doc is None else np.flatnonzero(entries["doc_id"] == doc):
        at, size = int(entries["at"][i]), int(entries["size"][i])
        raw = unpacker.decompress(view[at: at + size])
        ids = np.frombuffer(raw, "<u2" if width == 2 else "<u4").astype(np.uint32)
        if len(ids) != entries["tokens"][i]:
            raise ValueError(f"document {entries['doc_id'][i]}: {len(ids)} ids, {entries['tokens'][i]} expected")
        yield int(entries["doc_id"][i]), int(before[i]), ids


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """All documents of a file set: doc_id, start, n_tokens, ids_crc32 and, with ``ids``, the ids."""
    data, digest = _dictionary(spark, path)
    kind = "doc_id long, shard int, start_in_shard long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpacker = zstandard.ZstdDecompressor(dict_data=_shared(data))
        for batch in batches:
            for row in batch.to_pylist():
                if row["format"] != FORMAT or row["dictionary_hash"] != digest:
                    raise ValueError("block of another format or dictionary")
                found = [(None if doc == NO_ID else doc, row["shard"], row["start_in_shard"] + start, len(x),
                          zlib.crc32(x.astype("<u4").tobytes()), *([x] if ids else []))
                         for doc, start, x in _unpack(row["index"], row["payload"], row["width"], unpacker)]
                cols = list(zip(*found, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                names = ["doc_id", "shard", "start_in_shard", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=False)], names[: len(cols)])

    blocks = spark.read.parquet(f"{path}/blocks").select(
        "format", "width", "dictionary_hash", "shard", "start_in_shard", "index", "payload")
    shards = spark.read.parquet(f"{path}/shards").select("shard", F.col("start").alias("_shard_start"))
    found = blocks.mapInArrow(run, kind).join(shards, "shard")
    return found.select("doc_id", (F.col("_shard_start") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32",
                        *(["ids"] if ids else []))


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this id, from their blocks' indexes and their own frames only."""
    import zstandard

    data, _ = _dictionary(spark, path)
    unpacker = zstandard.ZstdDecompressor(dict_data=_shared(data))
    rows = spark.read.parquet(f"{path}/blocks").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    return [ids.tolist() for row in rows.orderBy("shard", "block").toLocalIterator()
            for _, _, ids in _unpack(bytes(row["index"]), bytes(row["payload"]), row["width"], unpacker, doc_id)]


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token-id files below ``spark.checkpoint.dir`` and read every document back."""
    out = f"{checkpoint_root(spark).rstrip('/')}/llm-token-files-{uuid.uuid4().hex}"
    write(documents(spark, sf_dir), out)
    return read(spark, out)
