"""Cost-balanced packing of documents into training sequences.

A piece of n tokens costs ``n + n * n / QUADRATIC``: the linear layers and the attention within
a document. Each task encodes its documents and packs them in blocks of about ``BLOCK_TOKENS``
ids. Documents are cut into pieces of at most one sequence; pieces go, longest first, to the
sequence of lowest cost that has room for them. A piece that fits nowhere fills the sequence
with the most room and goes on with its rest. The sequences of a block hold 1024 tokens each;
what is left over is laid into sequences of 512, 256 and so on, powers of two, so that all are
full. Blocks depend on no other task: no shuffle, no hot key, and a lost task packs the same again.

Null text counts as empty: the end id alone. Equal rows are packed as often as they come. An
empty table gives no piece. A very long document closes its block and only enlarges that block.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.chunk_encoder import ROOM, library_encoder
from siltworks.llm.common import map_rows

CAPACITY = 1024
#: Tokens at which attention costs as much as the linear layers.
QUADRATIC = 512
#: Ids packed together. A block of this size takes some tens of megabytes in a task.
BLOCK_TOKENS = 2_000_000

PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def cost(n: int) -> float:
    return n + n * n / QUADRATIC


def place(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) for documents of these lengths.

    Sequences by free room: ``free[r]`` is a heap of (cost, sequence) that have r tokens left.
    """
    full, rest = divmod(sum(lengths), capacity)
    rooms = [capacity] * full + [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if rest >> b & 1]
    free: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
    for s, room in enumerate(rooms):
        free[room].append((0.0, s))
    used, out = [0] * len(rooms), []
    lowest = np.array([heap[0][0] if heap else np.inf for heap in free])
    pieces = [(-min(capacity, n - at), d, at) for d, n in enumerate(lengths) for at in range(0, n, capacity)]
    heapq.heapify(pieces)
    while pieces:
        n, d, at = heapq.heappop(pieces)
        n = -n
        r = n + int(lowest[n:].argmin())
        if not free[r]:  # fits nowhere: fill the largest room, the rest takes its turn again
            r = int(np.flatnonzero(lowest < np.inf)[-1])
            heapq.heappush(pieces, (r - n, d, at + r))
            n = r
        now, s = heapq.heappop(free[r])
        lowest[r] = free[r][0][0] if free[r] else np.inf
        out.append((d, at, n, s, used[s]))
        used[s] += n
        if r > n:
            heapq.heappush(free[r - n], (now + cost(n), s))
            lowest[r - n] = free[r - n][0][0]
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int, room: int = ROOM) -> DataFrame:
    """One row per piece, with its ids; ``sequence_id`` and ``offset`` say where it lies.

    ``room`` bounds the encoder's memory in bytes: less of it costs time and changes no result.
    """

    run = uuid.uuid4().hex

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        encoder = library_encoder(tokenizer, keep_space=True, room=room, run=run)
        end = end_id.to_bytes(4, "little")
        task, done = TaskContext.get().partitionId() << 40, 0
        held, size = [], 0

        def block() -> Iterator[tuple]:
            placed = place([len(ids) // 4 for _, ids in held])
            for d, start, n, s, offset in placed:
                doc_id, ids = held[d]
                yield doc_id, start, n, len(ids) // 4, task + done + s, offset, ids[4 * start : 4 * (start + n)]

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                held.append((doc_id, encoder.encode(text) + end))
                size += len(held[-1][1]) // 4
                if size >= BLOCK_TOKENS:
                    yield from block()
                    done += size // CAPACITY + CAPACITY.bit_length()
                    held, size = [], 0
        if held:
            yield from block()

    return map_rows(docs.select("doc_id", "text"), make, PIECES, run)


def query(docs: DataFrame, tokenizer: str, end_id: int, room: int = ROOM) -> DataFrame:
    pieces = pack(docs, tokenizer, end_id, room)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
