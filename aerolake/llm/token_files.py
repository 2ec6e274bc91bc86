"""Binary token files: ids under a canonical Huffman code, in ascending key order.

``encode`` turns texts into ids once and writes them; ``write_files`` counts them,
builds one code for all, deals the documents out by ranges of the key and lets
every task write one file.  A file is a run of blocks that can be read alone:

    n_documents u32 | n_ids u64 | payload bytes u64 | keys i64[] | key is null u8[] | ids per document u32[]
    | bit offset of every 64th id u64[] | codes

A block holds whole documents, about ``BLOCK_IDS`` ids.  The index has one row per
block, and the codebook (id, code length) is a table beside the files.  A task that
is run again writes a new file, and the index names only files of ended tasks.

Defined results: a null text is empty and still gets its end id; null keys come
first; rows with equal keys are put in order by a hash of their text; an empty
table gives an empty index and codebook.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.llm.common import as_uri, small_batches, stored
from aerolake.llm.huffman import CHECKPOINT, Decoder, canonical_codes, code_lengths, pack
from aerolake.llm.tokens import packed, shared_encoder, slices_by_bytes

END_ID = 2
BLOCK_IDS = 1 << 20
_HEAD = "<IQQ"


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Written table (key, tie, n, ids): each text's ids with the end id, as compressed u32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, squeeze = shared_encoder(tokenizer), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at, n in slices_by_bytes(batch.column(2)):
                part = batch.slice(at, n)
                ids, counts = encoder.encode(part.column(2))
                ends = np.cumsum(counts + 1) - 1
                out = np.empty(len(ids) + len(counts), np.uint32)
                is_end = np.zeros(len(out), bool)
                is_end[ends] = True
                out[is_end], out[~is_end] = end_id, ids
                # Bytes of equal rank side by side: the upper ones are mostly zero.
                data = [squeeze.compress(x.view(np.uint8).reshape(-1, 4).T.tobytes()) for x in np.split(out, ends[:-1] + 1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts + 1, pa.int64()), pa.array(data, pa.binary())], ["key", "tie", "n", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("tie"), F.col(text).cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        return stored(rows.mapInArrow(run, "key long, tie long, n long, ids binary"), "token-ids", "none")


def _unsqueezed(data: bytes, reader: zstandard.ZstdDecompressor) -> np.ndarray:
    return np.frombuffer(reader.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)


def count_ids(encoded: DataFrame) -> DataFrame:
    """(id, count) over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = [_unsqueezed(x, reader) for x in batch.column(0)[at:at + 512].to_pylist()]
                found = np.bincount(np.concatenate(part))
                if len(found) > len(total):
                    total, found = found, total
                total[:len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "count"])

    return encoded.select("ids").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def _lengths(codebook: DataFrame) -> np.ndarray:
    rows = codebook.collect()  # one row per id of the vocabulary
    lengths = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.uint8)
    for r in rows:
        lengths[r["id"]] = r["length"]
    return lengths


def write_files(encoded: DataFrame, folder: str) -> DataFrame:
    """Write the token files and the codebook below ``folder``; returns the written index."""
    spark = encoded.sparkSession
    rows = count_ids(encoded).collect()  # one row per id of the vocabulary
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["count"]
    book = code_lengths(counts)
    spark.createDataFrame([(int(i), int(book[i])) for i in np.flatnonzero(book)], "id long, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    base = as_uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        lengths, codes, reader = book, canonical_codes(book), zstandard.ZstdDecompressor()
        system, root = fs.FileSystem.from_uri(f"{base}/files")
        part, name = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.tokens"
        out, offset, start, index, block, held = None, 0, 0, [], [], 0

        def flush() -> None:
            nonlocal offset, start, block, held
            keys, sizes, data = zip(*block)
            ids = np.concatenate([_unsqueezed(x, reader) for x in data])
            bits, checkpoints = pack(ids, lengths, codes)
            data = b"".join([
                struct.pack(_HEAD, len(block), len(ids), len(bits)), np.array([k or 0 for k in keys], "<i8").tobytes(),
                np.array([k is None for k in keys], np.uint8).tobytes(), np.array(sizes, "<u4").tobytes(),
                checkpoints.astype("<u8").tobytes(), bits])
            out.write(data)
            index.append((part, name, offset, len(data), start, len(ids), len(block)))
            offset, start, block, held = offset + len(data), start + len(ids), [], 0

        try:
            for batch in batches:
                for key, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None:
                        system.create_dir(root, recursive=True)
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    if held and held + n > BLOCK_IDS:
                        flush()
                    block.append((key, n, ids))
                    held += n
            if block:
                flush()
        finally:
            if out is not None:
                out.close()
        if index:
            names = ["part", "file", "offset", "length", "start", "n_ids", "n_docs"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*index)], names)

    ordered = encoded.select("key", "n", "ids", "tie").repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "n", "ids")
    return stored(ordered.mapInArrow(run, "part long, file string, offset long, length long, start long, n_ids long, n_docs long"), "token-index")


def read_files(index: DataFrame, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids): the documents of the ``index`` blocks, ids as little-endian u32.

    ``start`` is the number of ids in all documents before, over the whole index.
    """
    spark: SparkSession = index.sparkSession
    book, base = _lengths(spark.read.schema("id long, length int").parquet(f"{folder}/codebook")), as_uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        decoder = Decoder(book)
        system, root = fs.FileSystem.from_uri(f"{base}/files")
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{root}/{row['file']}") as source:
                    data = source.read_at(row["length"], row["offset"])
                n_docs, n_ids, n_bytes = struct.unpack_from(_HEAD, data)
                at = struct.calcsize(_HEAD)
                keys = np.frombuffer(data, "<i8", n_docs, at)
                null = np.frombuffer(data, np.uint8, n_docs, at := at + 8 * n_docs).astype(bool)
                sizes = np.frombuffer(data, "<u4", n_docs, at := at + n_docs).astype(np.int64)
                marks = -(-n_ids // CHECKPOINT)
                checkpoints = np.frombuffer(data, "<u8", marks, at := at + 4 * n_docs)
                ids = decoder.unpack(data[at + 8 * marks:at + 8 * marks + n_bytes], checkpoints, n_ids)
                starts = row["start"] + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n_docs, row["part"])), pa.array(keys, mask=null), pa.array(starts), pa.array(sizes),
                     packed(ids, sizes).cast(pa.binary())], ["part", "key", "start", "n_tokens", "ids"])

    # One row per file.
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored(parts.select("part", before.alias("before")), "token-starts")
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), index.agg(F.count(F.lit(1))).first()[0] // 16)
    blocks = index.select("part", "file", "offset", "length", "start").repartitionByRange(width, "part", "offset")
    found = blocks.mapInArrow(run, "part long, key long, start long, n_tokens long, ids binary")
    return found.join(starts, "part").select("key", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")
