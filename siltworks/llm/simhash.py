"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint bit is set if it is set in over half of the hashes of a text's word shingles.
Distinct fingerprints are the leaves of binary tries. Node pairs of a trie are traversed
together from the root; a pair carries the bits in which its paths differ and is dropped when
they exceed the budget.

Tries are dealt out to tasks by their first levels. Two fingerprints within 4 bits agree in two
of six blocks at least, so each of the 15 choices of two blocks makes a trie with those blocks
first, where only equal paths need be followed: a unit is the subtree below one such path. A
unit of more than ``UNIT_ROWS`` leaves is split into pairs of its own subtrees, again and again,
each a unit in its turn, so that no task gets an unbounded one.

A task joins what it links as it goes on and skips a node pair whose leaves are all linked
already; close pairs go first. A dense group is thus not listed pair by pair, and a task
hands on a spanning forest, which has the same components as all its links.

Null text counts as empty; a text without words has fingerprint zero and links like any other.
Equal rows have equal fingerprints. component_id is the smallest doc_id of the component, null
only if it has none. An empty table gives an empty result. Texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import map_rows, row_key, stored, word_pieces
from siltworks.llm.components import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Widths of the blocks, high bits first. Two of them are equal in any pair within MAX_BITS.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Bits below the two leading blocks, for the traversal. The widest two leave 42, the narrowest 44.
REST = 44
UNIT_ROWS, SPLIT_BITS = 20_000, 4
#: Leaves that a task joins at once, and node pairs that it expands at once.
FOREST_ROWS, PAIRS = 200_000, 100_000

_BIT = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)


def _bits(words: list[bytes], shingle: int) -> np.ndarray:
    """How many hashes of the words' shingles have each bit set; at least one shingle."""
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
    seen = np.bincount((octets + 256 * np.arange(8)).ravel(), minlength=2048).reshape(8, 256)
    return (seen @ _BIT).ravel()


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text, taken piece by piece: bits are counted as it goes on, and the last words of a piece open the next."""
    set_bits, n, words = np.zeros(64, np.int64), 0, []
    for piece in word_pieces((text or "").encode()):
        words = words + piece.lower().split()
        if len(words) >= shingle:
            set_bits, n = set_bits + _bits(words, shingle), n + len(words) - shingle + 1
            words = words[len(words) - shingle + 1 :]
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row, fp): fp as a signed 64-bit integer, row a hash of the text."""

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        for batch in batches:
            for doc_id, row, text in zip(batch["doc_id"], batch["row"], batch["text"]):
                value = fingerprint(text, shingle)
                yield doc_id, row, value - ((value >> 63) << 64)

    return map_rows(docs.select("doc_id", row_key("text").alias("row"), "text"), make, "doc_id bigint, row bigint, fp bigint")


def _led_by(first: int, second: int) -> Column:
    """The fingerprint with two blocks moved to the front: a path of that trie."""
    order = [first, second] + [b for b in range(len(BLOCKS)) if b not in (first, second)]
    path, at = F.lit(0).cast("bigint"), 64
    for b in order:
        at -= BLOCKS[b]
        below = sum(BLOCKS[b + 1 :])
        block = F.shiftrightunsigned("fp", below).bitwiseAND(F.lit((1 << BLOCKS[b]) - 1))
        path = path.bitwiseOR(F.shiftleft(block, at))
    return path


def _units(distinct: DataFrame) -> DataFrame:
    """(trie, left, right, side, fp, path): every fingerprint below every leading path. left = right: a subtree with itself."""
    tries = list(combinations(range(len(BLOCKS)), 2))
    rows = distinct.select("fp", F.posexplode(F.array(*[_led_by(*t) for t in tries])).alias("trie", "path"))
    lead = F.array(*[F.lit(64 - BLOCKS[a] - BLOCKS[b]) for a, b in tries])
    node = F.call_function("shiftrightunsigned", F.col("path"), F.element_at(lead, F.col("trie") + 1))
    return rows.select("trie", node.alias("left"), node.alias("right"), F.lit(0).alias("side"), "fp", "path")


def _split(rows: DataFrame, depth: int, max_bits: int) -> DataFrame:
    """Units cut into pairs of their subtrees ``SPLIT_BITS`` below; depth counts the bits split before."""
    shift = REST - depth - SPLIT_BITS
    own = F.shiftrightunsigned("path", shift).bitwiseAND(F.lit((1 << SPLIT_BITS) - 1))
    other = F.explode(F.array(*[F.lit(k).cast("bigint") for k in range(1 << SPLIT_BITS)]))
    opened = rows.select("*", own.alias("own"), other.alias("other"))
    near = opened.filter(F.bit_count(F.col("own").bitwiseXOR(F.col("other"))) <= max_bits)
    same = F.col("left") == F.col("right")
    first = F.when(same, F.col("own") <= F.col("other")).otherwise(F.col("side") == 0)

    def child(node: str, of: Column) -> Column:
        return F.xxhash64(F.lit(depth), node, of)  # a name, no longer a path

    left = F.when(same, F.least("own", "other")).otherwise(F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")))
    right = F.when(same, F.greatest("own", "other")).otherwise(F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own")))
    return near.select("trie", child("left", left).alias("left"), child("right", right).alias("right"), F.when(first, 0).otherwise(1).alias("side"), "fp", "path")


class _Forest:
    """Leaves of many units at once, as one sorted array: rank of the subtree, then the rest of the path."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parent = np.arange(len(codes))
        self.label = self.parent.copy()
        self.changes = self.parent.copy()
        self.links = 0

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(self, left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist()):
            a, b = self.find(a), self.find(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                self.links += 1

    def relabel(self) -> None:
        """Component of every leaf, and the number of changes of component up to it."""
        label = self.parent
        while True:
            nearer = label[label]
            if np.array_equal(nearer, label):
                break
            label = nearer
        self.parent = label.copy()
        self.label = label
        self.changes = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        self.links = 0

    def linked(self, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
        """Pairs of nodes whose leaves are all in one component."""
        changes = self.changes
        return (changes[a_end - 1] == changes[a]) & (changes[b_end - 1] == changes[b]) & (self.label[a] == self.label[b])

    def traverse(self, roots: list[np.ndarray], budget: int) -> None:
        """Follows node pairs (a, a_end, b, b_end) down to the leaves, depth first in slices."""
        bits = np.zeros(len(roots[0]), np.int64)
        stack = [(REST, [*roots, bits])]
        while stack:
            level, pairs = stack.pop()
            if len(pairs[0]) > PAIRS:
                half = len(pairs[0]) // 2
                stack += [(level, [p[half:] for p in pairs]), (level, [p[:half] for p in pairs])]
                continue
            if self.links:
                self.relabel()
            a, a_end, b, b_end, bits = pairs
            keep = ~self.linked(a, a_end, b, b_end)
            a, a_end, b, b_end, bits = (p[keep] for p in (a, a_end, b, b_end, bits))
            leaves = (a_end - a == 1) & (b_end - b == 1)
            if leaves.any():  # two single paths: compare what is left of them at once
                left, right = a[leaves], b[leaves]
                near = np.bitwise_count((self.codes[left] ^ self.codes[right]) & _LOW)
                self.union(left[near <= budget], right[near <= budget])
                a, a_end, b, b_end, bits = (p[~leaves] for p in (a, a_end, b, b_end, bits))
            if not len(a) or not level:
                continue
            level -= 1
            a_mid, b_mid = self._middle(a, a_end, level), self._middle(b, b_end, level)
            same = a == b
            children = [
                (a, a_mid, b, b_mid, bits),
                (a_mid, a_end, b_mid, b_end, bits),
                (a, a_mid, b_mid, b_end, bits + 1),
                tuple(p[~same] for p in (a_mid, a_end, b, b_mid, bits + 1)),
            ]
            joined = [np.concatenate(p) for p in zip(*children)]
            a, a_end, b, b_end, bits = joined
            keep = (a < a_end) & (b < b_end) & (bits <= budget) & ((a != b) | (a_end - a > 1))
            if keep.any():
                stack.append((level, [p[keep] for p in joined]))

    def _middle(self, start: np.ndarray, end: np.ndarray, level: int) -> np.ndarray:
        """Where the leaves with the bit of this level set begin."""
        high = np.uint64(level + 1)
        cut = ((self.codes[start] >> high) << high) | np.uint64(1 << level)
        return np.clip(np.searchsorted(self.codes, cut), start, end)


_LOW = np.uint64((1 << REST) - 1)


def forest_links(units: np.ndarray, sides: np.ndarray, crossing: np.ndarray, paths: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) that span the links within each unit. Rows are sorted by unit and side.

    ``crossing`` marks units of two different subtrees: sides meet each other, not themselves.
    """
    tree = 2 * units + sides
    rank = np.cumsum(np.concatenate([[0], tree[1:] != tree[:-1]])).astype(np.uint64)
    codes = (rank << np.uint64(REST)) | (paths.view(np.uint64) & _LOW)
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    forest = _Forest(codes)
    begins = np.flatnonzero(np.concatenate([[True], (codes[1:] ^ codes[:-1]) >> np.uint64(REST) != 0]))
    ends = np.append(begins[1:], len(codes))
    unit, across = units[order][begins], crossing[order][begins]
    own = ~across & (ends - begins > 1)
    pair = np.flatnonzero(across[:-1] & (unit[1:] == unit[:-1]))
    a, a_end = np.concatenate([begins[own], begins[pair]]), np.concatenate([ends[own], ends[pair]])
    b, b_end = np.concatenate([begins[own], begins[pair + 1]]), np.concatenate([ends[own], ends[pair + 1]])
    for budget in sorted({max_bits // 4, max_bits // 2, max_bits}):
        forest.traverse([a, a_end, b, b_end], budget)
    forest.relabel()
    linked = np.flatnonzero(forest.label != np.arange(len(codes)))
    return order[linked], order[forest.label[linked]]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints that span every component."""
    if max_bits > len(BLOCKS) - 2:
        raise ValueError("more bits than the blocks allow for")
    rows = stored(_units(distinct), "simhash-units")
    key = ["trie", "left", "right"]
    done, depth = [], 0
    while depth + SPLIT_BITS <= REST - 2:
        large = rows.groupBy(*key).count().filter(F.col("count") > unit_rows).drop("count")
        if large.isEmpty():
            break
        large = stored(large, "simhash-large")
        done.append(rows.join(large, key, "left_anti"))
        # The narrowest lead leaves 44 bits, wider ones agree in the first of them.
        rows = stored(_split(rows.join(large, key, "left_semi"), depth, max_bits), "simhash-units")
        depth += SPLIT_BITS
    for part in done:
        rows = rows.unionByName(part)

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        held: list[np.ndarray] = []

        def joined(data: np.ndarray) -> Iterator[tuple]:
            unit = np.cumsum(np.concatenate([[0], (data[1:, :3] != data[:-1, :3]).any(axis=1)]))
            alone = np.bincount(unit)[unit] == 1
            data, unit = data[~alone], unit[~alone]
            if len(data):
                i, j = forest_links(unit, data[:, 3], data[:, 1] != data[:, 2], data[:, 5].copy(), max_bits)
                yield from zip(data[i, 4].tolist(), data[j, 4].tolist())

        for batch in batches:
            held.append(np.array([batch[c] for c in ("trie", "left", "right", "side", "fp", "path")], dtype=np.int64).T)
            if sum(map(len, held)) >= FOREST_ROWS:
                data = np.concatenate(held)
                changes = np.flatnonzero((data[1:, :3] != data[:-1, :3]).any(axis=1))
                cut = int(changes[-1]) + 1 if len(changes) else 0
                yield from joined(data[:cut]) if cut else ()
                held = [data[cut:]]
        if held and len(data := np.concatenate(held)):
            yield from joined(data)

    dealt = rows.repartition(*[F.col(c) for c in key]).sortWithinPartitions(*key, "side", "path")
    return map_rows(dealt, make, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, row, fp, component_id, root), one row per document; root tells components apart, component_id need not:
    texts that share a doc_id may lie in several."""
    prints = stored(fingerprints(docs, shingle), "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), max_bits), "simhash-components").withColumnsRenamed({"node": "fp"})
    placed = stored(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-placed")
    # Written before they are joined, so that a root or a fingerprint of very many rows is split.
    least = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    named = stored(placed.join(least, "root").select("fp", "component_id", "root"), "simhash-named")
    return prints.join(named, "fp")


def query(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
