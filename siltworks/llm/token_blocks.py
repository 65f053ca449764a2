"""Token ids in binary files: patched frame-of-reference blocks.

A file is one byte string: a header, an index and a run of blocks. Ids are cut into blocks of
``BLOCK`` values. A block subtracts its least value and packs the rest at the width that holds
``PERCENTILE`` of its values; larger values keep their low bits there and stand, with their
position, in the block's exception list. The index gives the place where each block starts and
the length of each document, so that any document is found without reading what lies before.

Layout, little-endian: magic 4s, version u32, documents u32, ids u64, blocks u32; lengths u32
and start of document numbers u64 per document; start of each block u64, one more for the end;
blocks. A block: least value u32, width u8, padding u8, exceptions u16, packed values (LSB
first, whole bytes), exception positions u16, exception high parts u32.

``write`` sorts documents by doc_id (nulls first, then by text) over range partitions; each
partition makes files of whole documents, and Spark writes them as rows of a table, because
executors share no folder that Python could open. ``read`` gives the documents back with their
place among all ids. Null text counts as empty; empty documents hold the end id alone; equal
rows are written as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.chunk_encoder import library_encoder
from siltworks.llm.common import map_rows, stored

BLOCK, PERCENTILE = 2048, 90
#: Ids after which a file ends, at the next end of a document.
FILE_IDS = 1_000_000
_MAGIC, _VERSION = b"PFOR", 1
_HEADER, _BLOCK_HEAD = struct.Struct("<4sIIQI"), struct.Struct("<IBBH")


def _bits(values: np.ndarray) -> np.ndarray:
    """Number of bits of each value, 0 for 0. Exact, as doubles hold 32-bit integers."""
    return np.frexp(values.astype(np.float64))[1]


def pack_block(values: np.ndarray) -> bytes:
    """One block of unsigned 32-bit values, at least one."""
    least = int(values.min())
    rest = values - np.uint32(least)
    widths = np.sort(_bits(rest))
    width = int(widths[-(-len(rest) * PERCENTILE // 100) - 1])
    large = np.flatnonzero(_bits(rest) > width)
    octets = np.ascontiguousarray(rest, "<u4").view(np.uint8).reshape(-1, 4)
    if width % 8 == 0:  # whole bytes: the low ones of each value as they are
        packed = octets[:, : width // 8].tobytes()
    else:
        bits = np.unpackbits(octets, axis=1, bitorder="little")[:, :width]
        packed = np.packbits(bits.reshape(-1), bitorder="little").tobytes()
    high = (rest[large].astype(np.uint64) >> np.uint64(width)).astype("<u4")
    return _BLOCK_HEAD.pack(least, width, 0, len(large)) + packed + large.astype("<u2").tobytes() + high.tobytes()


def unpack_block(data: bytes, at: int, n: int) -> np.ndarray:
    """The ``n`` values of the block that starts at ``at``."""
    least, width, _, exceptions = _BLOCK_HEAD.unpack_from(data, at)
    at += _BLOCK_HEAD.size
    size = -(-n * width // 8)
    packed = np.frombuffer(data, np.uint8, size, at)
    octets = np.zeros((n, 4), np.uint8)
    if width % 8 == 0:
        octets[:, : width // 8] = packed.reshape(n, -1) if width else 0
    else:
        bits = np.zeros((n, 32), np.uint8)
        bits[:, :width] = np.unpackbits(packed, bitorder="little", count=n * width).reshape(n, width)
        octets = np.packbits(bits, axis=1, bitorder="little")
    rest = octets.view("<u4")[:, 0]
    at += size
    places = np.frombuffer(data, "<u2", exceptions, at)
    high = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    rest[places] |= (high.astype(np.uint64) << np.uint64(width)).astype("<u4")
    return rest + np.uint32(least)


def pack_file(documents: list[tuple[int | None, bytes]]) -> bytes:
    """A file of (doc_id, ids as little-endian u32) pairs; doc_ids are kept beside it."""
    ids = np.frombuffer(b"".join(d for _, d in documents), "<u4")
    blocks = [pack_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    lengths = np.array([len(d) // 4 for _, d in documents], dtype="<u4")
    firsts = np.cumsum(lengths, dtype="<u8") - lengths
    index = np.zeros(len(blocks) + 1, dtype="<u8")
    index[1:] = np.cumsum([len(b) for b in blocks])
    head = _HEADER.pack(_MAGIC, _VERSION, len(documents), len(ids), len(blocks))
    return head + lengths.tobytes() + firsts.astype("<u8").tobytes() + index.tobytes() + b"".join(blocks)


class File:
    """Reader of one file: any document, through the index of block starts."""

    def __init__(self, data: bytes):
        magic, version, docs, self.n_ids, blocks = _HEADER.unpack_from(data)
        if (magic, version) != (_MAGIC, _VERSION):
            raise ValueError("not a token file of this version")
        at = _HEADER.size
        self.lengths = np.frombuffer(data, "<u4", docs, at)
        self.firsts = np.frombuffer(data, "<u8", docs, at + 4 * docs)
        self.starts = np.frombuffer(data, "<u8", blocks + 1, at + 12 * docs)
        self.base = at + 12 * docs + 8 * (blocks + 1)
        self.data = data

    def block(self, k: int) -> np.ndarray:
        return unpack_block(self.data, self.base + int(self.starts[k]), min(BLOCK, self.n_ids - k * BLOCK))

    def document(self, k: int) -> np.ndarray:
        first, n = int(self.firsts[k]), int(self.lengths[k])
        if not n:
            return np.empty(0, "<u4")
        blocks = [self.block(b) for b in range(first // BLOCK, (first + n - 1) // BLOCK + 1)]
        return np.concatenate(blocks)[first % BLOCK : first % BLOCK + n]

    def documents(self) -> Iterator[bytes]:
        """All documents in their order; every block is unpacked once."""
        blocks = [self.block(b) for b in range(len(self.starts) - 1)]
        data = np.concatenate(blocks).tobytes() if blocks else b""
        for first, n in zip(self.firsts.tolist(), self.lengths.tolist()):
            yield data[4 * first : 4 * (first + n)]


def write(docs: DataFrame, tokenizer: str, end_id: int, name: str = "token-blocks") -> DataFrame:
    """Encodes the texts and writes them in ascending doc_id order: rows (part, file, before, n_docs, n_ids, doc_ids, data).

    ``before`` counts the ids of the part's earlier files.
    """
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        # The beginning of the text splits documents of one id, or of none; it sorts as the text does.
        .repartitionByRange(int(parts), F.col("doc_id").asc_nulls_first(), F.substring("text", 1, 64))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    end, run = np.uint32(end_id).tobytes(), uuid.uuid4().hex

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        encoder = library_encoder(tokenizer, keep_space=False, run=run)
        held, size, number, before = [], 0, 0, 0

        def row() -> tuple:
            known = np.array([i is not None for i, _ in held])
            ids = np.array([i or 0 for i, _ in held], dtype="<i8")
            return number, before, len(held), size, known.tobytes() + ids.tobytes(), pack_file(held)

        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"], encoder.encode_all(batch["text"])):
                held.append((doc_id, ids + end))
                size += len(held[-1][1]) // 4
                if size >= FILE_IDS:
                    yield row()
                    held, size, number, before = [], 0, number + 1, before + size
        if held:
            yield row()

    files = map_rows(ordered, make, "file int, before bigint, n_docs bigint, n_ids bigint, doc_ids binary, data binary", run)
    return stored(files.withColumn("part", F.spark_partition_id()), name)


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; start counts the ids of all files before."""
    # A row per part, as many as the writer's partitions.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0)))
    placed = files.join(F.broadcast(parts.drop("n")), "part").withColumn("base", F.col("base") + F.col("before"))

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        for batch in batches:
            for base, n, keys, data in zip(batch["base"], batch["n_docs"], batch["doc_ids"], batch["data"]):
                known, ids = np.frombuffer(keys, "?", n), np.frombuffer(keys, "<i8", n, n)
                file = File(data)
                for doc_id, there, first, doc in zip(ids.tolist(), known.tolist(), file.firsts.tolist(), file.documents()):
                    yield doc_id if there else None, base + first, len(doc) // 4, doc

    return map_rows(placed.select("base", "n_docs", "doc_ids", "data"), make, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def query(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Digest of what is read back from the files."""
    back = read(write(docs, tokenizer, end_id))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
