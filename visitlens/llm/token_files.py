"""Token-id files of patched frame-of-reference blocks (operator 11).

Documents are sorted by doc_id, tokenised in their sorted partitions and
written as binary files, one segment of whole documents a file:

    header   magic, partition, ids before it in the partition, number of ids,
             of documents and of blocks, block size, place of the index
    blocks   the ids of all documents end to end (see :mod:`pfor`)
    table    doc_id, whether it is null, and number of ids, a document
    index    start of each block in the file, and the blocks' end
    newline  the record end of Spark's writer

Spark's text writer stores the bytes (one record a file), ``binaryFile``
reads them back, so files lie wherever Spark can write. ``block_range``
decodes some ids of a segment by its index alone.

Rows of one doc_id (also null, which comes first) are ordered by a hash of
the text and then by arrival, so a hot doc_id is dealt over partitions too.

Edge cases: a null or empty text is the end id alone; repeated rows are
written each; an empty table gives no rows; one text is tokenised whole, so
memory follows the longest text; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.llm import pfor
from visitlens.llm.frames import Shared, map_batches, saved, small_batches
from visitlens.llm.packing import worker_cache
from visitlens.llm.text import SLICE_BYTES, slices, string_buffer

#: Fixed values of the format.
MAGIC = b"PFORIDS1"
HEADER = np.dtype([("magic", "S8"), ("part", "<u8"), ("before", "<u8"), ("ids", "<u8"),
                   ("docs", "<u8"), ("blocks", "<u8"), ("block", "<u8"), ("index", "<u8")])
TABLE = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u8")])
ROWS = "doc_id long, part long, first long, n_tokens long, ids_crc32 long"


def segment(part: int, before: int, ids: np.ndarray, doc_ids: pa.Array,
            counts: np.ndarray, block: int = pfor.BLOCK) -> bytes:
    """The bytes of one segment."""
    blocks, starts = pfor.encode(ids, block)
    starts = starts + HEADER.itemsize
    head = np.zeros(1, HEADER)
    head[0] = (MAGIC, part, before, len(ids), len(counts), len(starts) - 1, block,
               starts[-1] + TABLE.itemsize * len(counts))
    table = np.zeros(len(counts), TABLE)
    table["null"] = np.asarray(doc_ids.is_null())
    table["doc_id"] = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
    table["n"] = counts
    return b"".join((head.tobytes(), blocks.tobytes(), table.tobytes(),
                     starts.astype("<u8").tobytes()))


class Segment:
    """A segment read from its bytes."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        head = np.frombuffer(data, HEADER, 1)[0]
        if head["magic"] != MAGIC:
            raise ValueError("not a token-id segment")
        self.part, self.before, self.n_ids, docs, blocks, self.block, index = (
            int(head[k]) for k in HEADER.names[1:])
        self.starts = np.frombuffer(data, "<u8", blocks + 1, index).astype(np.int64)
        self.table = np.frombuffer(data, TABLE, docs, int(self.starts[-1]))

    def block_range(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` up to ``stop`` of the segment; only their blocks are decoded."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, -(-stop // self.block)
        ids = pfor.decode(self.data, self.starts[a:b], self.block)
        return ids[start - a * self.block:stop - a * self.block]


def write_token_files(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 2,
                      segment_ids: int = 1 << 22) -> None:
    """Write ``docs`` (doc_id, text) in ascending doc_id order under ``path``.

    A segment is closed after ``segment_ids`` ids; it holds whole documents.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = Shared(spark, tokenizer_json)

    def encode(batches):
        cache, part = worker_cache(shared.value), TaskContext.get().partitionId()
        keys, counts, found, size, before = [], [], [], 0, 0

        def close():
            data = segment(part, before, np.concatenate(found), pa.concat_arrays(keys),
                           np.concatenate(counts))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["segment"])

        for batch in batches:
            data, offs = string_buffer(batch.column(1))
            for a, b in slices(offs, min(SLICE_BYTES, segment_ids)):
                ids, n = cache.encode(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                found.append(np.insert(ids, np.cumsum(n), np.uint32(end_id)))
                counts.append(n + 1)
                keys.append(batch.column(0).slice(a, b - a))
                size += len(found[-1])
                if size >= segment_ids:
                    yield close()
                    before += size
                    keys, counts, found, size = [], [], [], 0
        if size:
            yield close()

    order = ["doc_id", "_h", "_m"]
    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .withColumn("_h", F.xxhash64("text"))
            .withColumn("_m", F.monotonically_increasing_id())
            .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    (rows.transform(map_batches, encode, "segment binary")
     .select(F.col("segment").cast("string").alias("value"))
     .write.mode("overwrite").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, part, first, n_tokens, ids_crc32[, ids]) of each document in the files.

    ``first`` counts the ids before it in its partition, ``ids`` are
    little-endian u32, ``ids_crc32`` their unsigned crc32.
    """
    small_batches(spark)
    names = [c.split()[0] for c in ROWS.split(", ")] + ["ids"] * with_ids

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                data = content.as_buffer()
                if not data or not data.size:
                    continue
                seg = Segment(data.to_pybytes())
                n = seg.table["n"].astype(np.int64)
                ends = np.cumsum(n)
                # about 2^22 ids at a time, whole documents
                for a, b in slices(np.concatenate([[0], ends]), 1 << 22):
                    base = int(ends[a] - n[a])
                    ids = seg.block_range(base, int(ends[b - 1])).astype("<u4")
                    raw = memoryview(ids).cast("B")
                    at = 4 * np.concatenate([[0], ends[a:b] - base])
                    cuts = at.tolist()
                    crc = [zlib.crc32(raw[x:y]) for x, y in zip(cuts, cuts[1:])]
                    k = b - a
                    columns = [pa.array(seg.table["doc_id"][a:b], mask=seg.table["null"][a:b] > 0),
                               pa.array(np.full(k, seg.part)),
                               pa.array(seg.before + ends[a:b] - n[a:b]),
                               pa.array(n[a:b]), pa.array(np.array(crc, np.int64))]
                    if with_ids:
                        columns.append(pa.Array.from_buffers(pa.binary(), k, [
                            None, pa.py_buffer(at.astype(np.int32).tobytes()),
                            pa.py_buffer(ids.tobytes())]))
                    yield pa.RecordBatch.from_arrays(columns, names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.transform(map_batches, read, ROWS + ", ids binary" * with_ids)


def with_starts(rows: DataFrame, chunk: int = 1000) -> DataFrame:
    """``start``: the ids of all documents before a row, in the order of the files.

    One total a partition; their prefix sums are taken in two levels of
    ``chunk`` partitions. ``rows`` is read twice, so store it.
    """
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn(
        "c", F.floor(F.col("part") / chunk))
    before = F.lit(1).cast("int")
    chunks = parts.groupBy("c").agg(F.sum("n").alias("n")).select("c", F.coalesce(F.sum("n").over(
        Window.partitionBy(before).orderBy("c").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("base"))
    within = F.sum("n").over(Window.partitionBy("c").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1))
    base = parts.withColumn("within", F.coalesce(within, F.lit(0))).join(chunks, "c").select(
        "part", (F.col("base") + F.col("within")).alias("base"))
    return rows.join(base, "part").withColumn(
        "start", (F.col("base") + F.col("first")).cast("long")).drop("base")


def token_digests(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 2) -> DataFrame:
    """Write the files, read them back: (doc_id, start, n_tokens, ids_crc32) a document."""
    write_token_files(docs, path, tokenizer_json, end_id)
    rows = saved(read_token_files(docs.sparkSession, path, with_ids=False), "token-rows")
    return with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")
