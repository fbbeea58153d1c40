"""Operator 7, token-ID output: binary files of frequency-ranked, byte-aligned ids.

Method: the corpus counts of all ids give each id a rank (most frequent first,
ties by id).  Ranks are written in 1 to 4 bytes; the lengths stand apart, two
bits an id, in control bytes, so a numpy table of 256 rows turns each control
byte into four lengths and a second table turns ranks back into ids.

File format.  A folder holds ``part-*`` files, which in the order of their
names hold the documents in ascending order of doc id, and ``codebook``, a
Parquet table (rank, id).  A file is a run of blocks, each followed by a line
feed: the magic ``LTK1``, then the little-endian unsigned 64-bit numbers file,
block, documents, ids, control bytes, data bytes; then for each document its id
(int64), whether that is null (uint8) and its count of ids (int64); then the
control bytes and the data bytes.  Blocks decode alone.

Tokens are made once, staged compressed in the shared folder, and shuffled once
into doc-id order.  What reaches the driver is the codebook, bounded by the
vocabulary.

Defined cases: null text counts as empty; null doc ids come first; repeated ids
are ordered by their tokens; further columns are not read; an empty table gives
an empty folder and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revscope.llm._common import new_folder, pick, ship, staged

END_ID = 0
SLICE_BYTES = 6 << 20
BLOCK_IDS = 1 << 19
BLOCKS_A_FILE = 16
MAGIC = b"LTK1"
HEAD = "<4s6Q"

#: lengths (1 to 4) of the four ids of each control byte
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ``ranks``."""
    n, top = len(ranks), int(ranks.max()) if len(ranks) else 0
    padded = np.zeros(-(-n // 4) * 4, np.uint8)
    more = padded[:n]  # bytes of each rank after its first
    for bound in (0xFF, 0xFFFF, 0xFFFFFF):
        if top > bound:
            more += ranks > bound
    quad = padded.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    at = np.cumsum(more, dtype=np.int64) - more + np.arange(n)
    data = np.empty(n + int(more.sum(dtype=np.int64)), np.uint8)
    data[at] = ranks.astype(np.uint8)
    for k in (1, 2, 3):
        if top >> (8 * k):
            longer = np.flatnonzero(more >= k)
            data[at[longer] + k] = (ranks[longer] >> np.uint32(8 * k)).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """Ranks from control and data bytes, by table lookup."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        if not len(longer):
            break
        out[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _tokenised(path: str):
    """Per document its ids, compressed; at the end of a task one row of counts of all ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        from revscope.llm._segments import lean, slices, token_ids
        from revscope.llm._tokenizer import vocabulary

        lean()
        vocab = vocabulary(path)
        press = zstandard.ZstdCompressor(level=1).compress
        total = np.zeros(END_ID + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, counts = token_ids(part.column("text"), vocab)
                found = np.bincount(ids, minlength=len(total))
                found[: len(total)] += total
                total = found
                total[END_ID] += len(counts)
                raw, size = memoryview(ids).cast("B"), ids.itemsize
                ends = (np.cumsum(counts) * size).tolist()
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n": pa.array(counts),
                        "width": pa.array(np.full(len(counts), size, np.int32)),
                        "ids": pa.array([press(raw[a:b]) for a, b in zip([0, *ends], ends)], pa.binary()),
                    }
                )
        if total.any():
            yield pa.record_batch(
                {
                    "doc_id": pa.nulls(1, pa.int64()),
                    "n": pa.array([len(total)]),
                    "width": pa.array([0], pa.int32()),
                    "ids": pa.array([total.tobytes()], pa.binary()),
                }
            )

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for raw in batch.column("ids"):
            more = np.frombuffer(raw.as_buffer(), np.int64).copy()
            small, total = sorted((total, more), key=len)
            total[: len(small)] += small
    at = np.flatnonzero(total)
    yield pa.record_batch({"id": pa.array(at), "n": pa.array(total[at])})


def codebook(tokens: DataFrame) -> DataFrame:
    """(rank, id) by descending corpus count, ties by id; at most one row per vocabulary entry."""
    counts = tokens.filter("width = 0").select("ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return counts.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).cast("long").alias("rank"), "id")


def _blocks(rank_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        from revscope.llm._segments import lean

        lean()
        expand = zstandard.ZstdDecompressor().decompress
        file, block = TaskContext.get().partitionId(), 0
        docs: list[tuple[int | None, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            nonlocal block, docs
            ids = np.concatenate([x for _, x in docs])
            control, data = encode_ranks(rank_of[ids])
            content = b"".join(
                [
                    struct.pack(HEAD, MAGIC, file, block, len(docs), len(ids), len(control), len(data)),
                    np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
                    bytes(d is None for d, _ in docs),
                    np.array([len(x) for _, x in docs], "<i8").tobytes(),
                    control,
                    data,
                ]
            )
            block, docs = block + 1, []
            return pa.record_batch({"content": pa.array([content], pa.binary())})

        held = 0
        for batch in batches:
            for doc, width, raw in zip(batch.column("doc_id").to_pylist(), batch.column("width").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(expand(raw), f"<u{width}") if raw else np.zeros(0, np.uint32)
                docs.append((doc, np.append(ids.astype(np.uint32), np.uint32(END_ID))))
                held += len(ids) + 1
                if held >= BLOCK_IDS:
                    held = 0
                    yield packed()
        if docs:
            yield packed()

    return run


def write_tokens(docs: DataFrame, vocabulary_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenise ``docs`` and write the files of the format above into ``folder``."""
    spark = docs.sparkSession
    ship(spark)
    narrow = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )
    tokens = staged(narrow.mapInArrow(_tokenised(vocabulary_path), "doc_id long, n long, width int, ids binary"), "tokens")
    book = codebook(tokens)
    book.coalesce(1).write.parquet(f"{folder}/codebook")
    ranks = spark.read.parquet(f"{folder}/codebook").toPandas()
    rank_of = np.zeros(int(ranks["id"].max()) + 1 if len(ranks) else 1, np.uint32)
    rank_of[ranks["id"].to_numpy()] = ranks["rank"].to_numpy()
    ordered = tokens.filter("width > 0").select("doc_id", "width", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    # a string is written byte for byte, whether or not it is UTF-8
    ordered.mapInArrow(_blocks(rank_of), "content binary").select(F.col("content").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", BLOCKS_A_FILE
    ).text(f"{folder}/files")


def _decoded(id_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from revscope.llm._segments import lean

        lean()
        for batch in batches:
            for value in batch.column("content"):
                content, at = value.as_py(), 0
                while at < len(content):
                    magic, file, block, n_docs, n_ids, n_control, n_data = struct.unpack_from(HEAD, content, at)
                    if magic != MAGIC:
                        raise ValueError("not a block of token ids")
                    at += struct.calcsize(HEAD)
                    doc = np.frombuffer(content, "<i8", n_docs, at)
                    absent = np.frombuffer(content, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
                    n = np.frombuffer(content, "<i8", n_docs, at + 9 * n_docs)
                    at += 17 * n_docs
                    data = at + n_control
                    ids = id_of[decode_ranks(content[at:data], content[data : data + n_data], n_ids)].astype("<u4")
                    at = data + n_data + 1
                    raw, ends = memoryview(ids).cast("B"), np.cumsum(n)
                    spans = [raw[4 * a : 4 * b] for a, b in zip((ends - n).tolist(), ends.tolist())]
                    yield pa.record_batch(
                        {
                            "doc_id": pa.array(doc, mask=absent),
                            "file": pa.array(np.full(n_docs, file, np.int64)),
                            "block": pa.array(np.full(n_docs, block, np.int64)),
                            "before": pa.array(ends - n),
                            "n_tokens": pa.array(n),
                            "ids": pa.array([bytes(x) for x in spans], pa.binary()),
                        }
                    )

    return run


def _read(spark: SparkSession, folder: str, last: str, then=None) -> DataFrame:
    """Decoded documents of the files, their column ``last`` made of their ids by ``then`` in the decoding task."""
    ship(spark)
    ranks = spark.read.parquet(f"{folder}/codebook").toPandas()
    id_of = np.zeros(len(ranks) or 1, np.uint32)
    id_of[ranks["rank"].to_numpy()] = ranks["id"].to_numpy()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/files").select("content")
    decoded = _decoded(id_of)
    run = (lambda batches: then(decoded(batches))) if then else decoded
    return files.mapInArrow(run, f"doc_id long, file long, block long, before long, n_tokens long, {last}")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files: doc_id, file, block, before (ids before it in its block), n_tokens, ids."""
    return _read(spark, folder, "ids binary")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
        yield pa.record_batch([*batch.columns[:-1], pa.array(crc, pa.int64())], names=[*batch.schema.names[:-1], "ids_crc32"])


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document's ids start in the files' whole run of ids, their count and checksum.

    Starts are sums over files, then blocks, then documents; only the counts per
    file (one row a file) and per block (one window a file) are ordered.
    """
    docs = staged(_read(spark, folder, "ids_crc32 long", _crc), "token-index")
    blocks = docs.groupBy("file", "block").agg(F.sum("n_tokens").alias("n"))
    files = blocks.groupBy("file").agg(F.sum("n").alias("n"))
    before_file = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("file_start"))
    before_block = blocks.select("file", "block", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("block_start"))
    starts = before_block.join(before_file, "file").select("file", "block", (F.col("block_start") + F.col("file_start")).alias("first"))
    return docs.join(starts, ["file", "block"]).select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, vocabulary_path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` into ``folder`` (a new shared one if none is named) and index what was written."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    write_tokens(docs, vocabulary_path, folder, id_col, text_col)
    return token_index(spark, folder)
