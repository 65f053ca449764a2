"""Repeated passages, by a logarithmic family of sparse suffix arrays.

Every byte that lies in a ``SPAN``-byte string which also starts elsewhere is removed. The suffix arrays
are sparse: they hold the suffixes that begin at anchors. The anchor of a window of SPAN bytes is the place of
its least ``GRAM``-byte hash, the first if several are equal. Equal windows have their anchors at
the same place in them, so a match of SPAN bytes holds equal suffixes of GRAM bytes at least, and is found from these. A posting is an anchor with
the run of windows it stands for, and a hash of all bytes they cover (its context).

Index: documents come in batches. A batch gets a level of its own: its suffixes, cut to GRAM bytes, in the order of their
bytes, equal neighbours as one with their number. It is merge-scanned (a sort-merge join of tables bucketed and sorted
by suffix, without a shuffle) against every level that exists; suffixes found in both, or more than once in the batch, are matches. Two levels
of equal size are merged in the same way before the next batch comes, so n batches leave about log n levels. An
index may be kept in a folder: a later call goes on with its levels and does not index earlier documents again.

Matches are then checked in full. Postings of equal context repeat as a whole. For suffixes with
several contexts the bytes of one posting per context are fetched and their windows compared
byte by byte. A suffix with over ``HOT`` contexts isn't gathered in one task: blocks of windows, and
the windows of blocks that repeat in part, are grouped by their own 128-bit hashes instead. Contexts are told apart by
64 bits of hash within a suffix that itself is named by 64 bits, 128 together, wherever they are grouped.

Copies of one text are indexed once; a text of SPAN bytes or more that occurs twice is removed
wholly. Null text counts as empty. Texts below SPAN bytes stay. Matches never cross documents.
An empty table gives an empty result. Texts are taken whole, long ones in pieces that overlap.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.common import Bitmap, map_rows, maybe_in, release, ship, slices, stored
from siltworks.session import scratch_path

SPAN, GRAM = 200, 64
_WINDOW = SPAN - GRAM + 1  # grams in a window; fits a byte
BATCHES, HOT = 3, 1000
GRAIN = 16
POSTINGS = "suffix binary, key bigint, context bigint, t bigint, place bigint"
_PAIR = struct.Struct("<qq")
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every place, eight at a time."""
    n = len(data) - GRAM + 1
    h = np.full(n, 0x2545F4914F6CDD1D, np.uint64)
    for at in range(0, GRAM, 8):
        h = (h ^ np.ndarray(n, "<u8", data, at, (1,))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` values, from minima forward and backward within blocks."""
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


# Windows of a text that are looked at at once.
WINDOWS = 1 << 18


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(hash, place, first window, last window) of every anchor, in order; long texts go in pieces that overlap."""
    if len(data) < SPAN:
        return None
    octets, found = np.frombuffer(data, np.uint8), []
    for begin in range(0, len(data) - SPAN + 1, WINDOWS):
        h = gram_hashes(octets[begin : begin + WINDOWS + SPAN - 1])
        ranked = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        at = (sliding_least(ranked, _WINDOW) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.append(first[1:], len(at)) - 1
        found.append((h[at[first]].view(np.int64), at[first] + begin, first + begin, last + begin))
    key, at, first, last = (np.concatenate(c) for c in zip(*found))
    # A run of windows that goes on over the end of a piece is one.
    opens = np.concatenate([[True], at[1:] != at[:-1]])
    closes = np.append(opens[1:], True)
    return key[opens], at[opens], first[opens], last[closes]


def _open(place: int) -> tuple[int, int]:
    """First window of a posting and the number of further ones."""
    return (place >> 16) - (place >> 8 & 255), place & 255


def postings(texts: DataFrame) -> DataFrame:
    """(suffix, key, context, t, place) of every anchor in (t, text); key is a hash of the suffix. A text is taken once per task."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: set[int] = set()
        names = ["suffix", "key", "context", "t", "place"]
        for batch in (part for whole in batches for part in slices(whole)):
            held: list[tuple] = []
            for t, text in zip(batch["t"].to_pylist(), batch["text"].to_pylist()):
                data = text.encode()
                found = None if t in seen else anchors(data)
                seen.add(t)
                if found is None:
                    continue
                key, at, first, last = found
                spans = zip(first.tolist(), (last + SPAN).tolist())
                context = np.array([xxhash.xxh64_intdigest(data[a:b]) for a, b in spans], np.uint64).view(np.int64)
                suffixes = pa.array([data[a : a + GRAM] for a in at.tolist()], pa.binary())
                held.append((key, context, np.full(len(key), t), (at << 16) | ((at - first) << 8) | (last - first), suffixes))
            if held:
                *columns, suffixes = zip(*held)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(suffixes), *(pa.array(np.concatenate(c)) for c in columns)], names=names)

    return texts.mapInArrow(run, POSTINGS)


def _named(spark: SparkSession, name: str) -> DataFrame:
    """A table that knows its buckets. Its name is given up at once; the files, which lie elsewhere, stay."""
    df = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return df


class SuffixIndex:
    """Levels of the index, (batches in it, sorted table of (suffix, key, n)), and the postings behind them.

    With a ``folder``, in a place that all executors share, the index is noted there after every batch and can be opened again.
    """

    def __init__(self, folder: str | None = None, spark: SparkSession | None = None):
        self.folder = folder
        self.seed: int | None = None
        self.levels: list[tuple[int, DataFrame]] = []
        self.postings: list[DataFrame] = []
        self._paths: dict[int, str] = {}
        self._notes = 0
        if folder and spark:
            self._open(spark)

    def _path(self, spark: SparkSession, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex}" if self.folder else scratch_path(spark, f"llm-{name}")

    def _write(self, array: DataFrame) -> DataFrame:
        """A sorted level. It has as many buckets as what comes before it has partitions, so its files need no shuffle."""
        spark = array.sparkSession
        buckets, path = int(spark.conf.get("spark.sql.shuffle.partitions")), self._path(spark, "suffix-level")
        name = f"llm_suffixes_{uuid.uuid4().hex}"
        array.write.option("compression", "zstd").bucketBy(buckets, "suffix").sortBy("suffix").option("path", path).saveAsTable(name)
        level = _named(spark, name)
        self._paths[id(level)] = f"{buckets} {path}"
        return level

    def add(self, posted: DataFrame) -> DataFrame:
        """Takes a batch of postings in; keys of suffixes that it shares with the index or holds twice."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, young), (_, old) = self.levels.pop(), self.levels.pop()
            other = old.withColumnsRenamed({"key": "old_key", "n": "old_n"})
            n = F.coalesce("n", F.lit(0)) + F.coalesce("old_n", F.lit(0))
            both = young.join(other.hint("merge"), "suffix", "full").select("suffix", F.coalesce("key", "old_key").alias("key"), n.alias("n"))
            self.levels.append((2 * size, self._write(both)))
        array = self._write(posted.groupBy("suffix").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("n")))
        found = array.filter("n > 1").select("key")
        for _, level in self.levels:
            found = found.unionByName(array.join(level.select("suffix"), "suffix", "left_semi").select("key"))
        self.levels.append((1, array))
        return found

    def take(self, texts: DataFrame) -> DataFrame:
        """Indexes a batch of (t, text): its postings are stored, its array is added; matching keys as ``add`` gives them."""
        path = self._path(texts.sparkSession, "suffix-postings")
        posted = postings(texts)
        posted.write.option("compression", "zstd").parquet(path)
        posted = texts.sparkSession.read.schema(posted.schema).parquet(path)
        self._paths[id(posted)] = path
        found = self.add(posted)
        self.postings.append(posted)
        return found

    def note(self) -> None:
        """Writes down what the index consists of, for a later call."""
        if self.folder:
            rows = [("level", size, self._paths[id(level)]) for size, level in self.levels]
            rows += [("postings", 0, self._paths[id(posted)]) for posted in self.postings] + [("seed", self.seed or 0, "")]
            spark = SparkSession.active()
            spark.createDataFrame(rows, "kind string, size int, path string").coalesce(1).write.parquet(f"{self.folder}/index/note={self._notes + 1}")
            self._notes += 1

    def _open(self, spark: SparkSession) -> None:
        try:
            notes = spark.read.parquet(f"{self.folder}/index")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        self._notes = notes.agg(F.max("note")).first()[0]
        # A row per level, batch and index.
        for r in sorted(notes.filter(F.col("note") == self._notes).collect(), key=lambda r: -r["size"]):
            if r["kind"] == "seed":
                self.seed = r["size"]
            elif r["kind"] == "postings":
                posted = spark.read.schema(POSTINGS).parquet(r["path"])
                self._paths[id(posted)] = r["path"]
                self.postings.append(posted)
            else:
                buckets, path = r["path"].split(" ", 1)
                name = f"llm_suffixes_{uuid.uuid4().hex}"
                spark.sql(
                    f"CREATE TABLE {name} (suffix BINARY, key BIGINT, n BIGINT) USING parquet "
                    f"CLUSTERED BY (suffix) SORTED BY (suffix) INTO {buckets} BUCKETS LOCATION '{path}'"
                )
                level = _named(spark, name)
                self._paths[id(level)] = r["path"]
                self.levels.append((r["size"], level))


def _windows(data: bytes, place: int) -> list[bytes]:
    return [data[i : i + SPAN] for i in range((place & 255) + 1)]


def _runs(first: int, marked: list[int]) -> Iterator[tuple[int, int]]:
    """Spans covered by the windows of a posting with these numbers, ascending."""
    start = end = None
    for i in marked:
        if end is not None and first + i <= end:
            end = first + i + SPAN
            continue
        if end is not None:
            yield start, end
        start, end = first + i, first + i + SPAN
    if end is not None:
        yield start, end


def _equal_windows(posted: DataFrame) -> DataFrame:
    """(t, start, stop) by comparing windows within each key, for rows (key, single, t, place, data)."""

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        held: list[tuple] = []

        def compared() -> Iterator[tuple]:
            seen: dict[bytes, tuple[int, int] | None] = {}
            marks: list[list[int]] = [[] for _ in held]
            for r, (_, _, place, data) in enumerate(held):
                for i, window in enumerate(_windows(data, place)):
                    other = seen.get(window, 0)
                    if other == 0:
                        seen[window] = (r, i)
                        continue
                    marks[r].append(i)
                    if other is not None:
                        marks[other[0]].append(other[1])
                        seen[window] = None
            for (single, t, place, _), marked in zip(held, marks):
                if single and marked:
                    for start, stop in _runs(_open(place)[0], sorted(marked)):
                        yield t, start, stop

        now = None
        for batch in batches:
            for key, single, t, place, data in zip(*(batch[c] for c in ("key", "single", "t", "place", "data"))):
                if key != now:
                    yield from compared()
                    held, now = [], key
                held.append((single, t, place, data))
        yield from compared()

    dealt = posted.repartition("key").sortWithinPartitions("key")
    return map_rows(dealt.select("key", "single", "t", "place", "data"), make, "t bigint, start bigint, stop bigint")


def _hash(data: bytes) -> tuple[int, int]:
    return _PAIR.unpack(xxhash.xxh3_128_digest(data))


def _blocks(data: bytes, place: int) -> Iterator[tuple[int, bytes, bytes | None]]:
    """(block, core, all) of a posting's windows, in blocks of GRAIN by the anchor's place in the window.

    The core lies in every window of the block, so windows are equal only where cores are. If
    the posting has the whole block, ``all`` is what its windows cover: where that repeats, each does.
    """
    most = place >> 8 & 255
    least = most - (place & 255)
    for k in range(least // GRAIN, most // GRAIN + 1):
        at = most - GRAIN * k
        whole = least <= GRAIN * k and GRAIN * (k + 1) - 1 <= most
        yield k, data[at : at + SPAN - GRAIN + 1], data[at - GRAIN + 1 : at + SPAN] if whole else None


def _grouped_windows(posted: DataFrame) -> DataFrame:
    """The same for keys of any size, by grouping hashes: of blocks of windows, then of the windows
    of blocks whose core repeats while the whole does not."""

    def blocks(batches: Iterator[dict]) -> Iterator[tuple]:
        for batch in batches:
            for key, single, t, place, data in zip(*(batch[c] for c in ("key", "single", "t", "place", "data"))):
                for k, core, whole in _blocks(data, place):
                    u, v = _hash(whole) if whole else (None, None)
                    yield key, k, _hash(core)[0], u, v, single, t, place

    def windows(batches: Iterator[dict]) -> Iterator[tuple]:
        for batch in batches:
            for key, k, single, t, place, data in zip(*(batch[c] for c in ("key", "k", "single", "t", "place", "data"))):
                first, more = _open(place)
                most = place >> 8 & 255
                for i in range(max(0, most - GRAIN * (k + 1) + 1), min(more, most - GRAIN * k) + 1):
                    h, g = _hash(data[i : i + SPAN])
                    yield key, h, g, single, t, first + i

    listed = ["key", "single", "t", "place", "data"]
    rows = stored(map_rows(posted.select(listed), blocks, "key bigint, k int, c bigint, u bigint, v bigint, single boolean, t bigint, place bigint"), "suffix-blocks")
    # What is counted is written before it is joined, so that Spark splits a block or window that very many postings have.
    cores = stored(rows.groupBy("key", "k", "c").count().filter("count > 1").drop("count"), "suffix-cores")
    near = stored(rows.join(cores, ["key", "k", "c"], "left_semi"), "suffix-blocks")
    same = near.filter("u IS NOT NULL").groupBy("key", "k", "u", "v").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "place")).alias("at"))
    near = stored(near.join(stored(same.filter("n > 1"), "suffix-same"), ["key", "k", "u", "v"], "left"), "suffix-near")
    place = F.shiftright("place", 16) - GRAIN * F.col("k")
    whole = near.filter("n IS NOT NULL AND single").select("t", (place - GRAIN + 1).alias("start"), (place + SPAN).alias("stop"))
    # Blocks that repeat as a whole stand for each other: one of them meets the rest.
    rest = near.filter("n IS NULL OR (t = at.t AND place = at.place)").select("key", "k", "t", "place")
    data = rest.join(posted.select(listed), ["key", "t", "place"])
    split = stored(map_rows(data.select("k", *listed), windows, "key bigint, h bigint, g bigint, single boolean, t bigint, start bigint"), "suffix-windows")
    twice = stored(split.groupBy("key", "h", "g").count().filter("count > 1").drop("count"), "suffix-twice")
    found = split.filter("single").join(twice, ["key", "h", "g"], "left_semi")
    return whole.unionByName(found.select("t", "start", (F.col("start") + SPAN).alias("stop")))


def _keyed(docs: DataFrame, seed: int) -> tuple[DataFrame, Column]:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64(F.lit(seed), text).alias("t"), text.alias("text")), text


def _texts(docs: DataFrame, fixed: int | None) -> tuple[int, DataFrame]:
    """A seed under which no two texts share a 64-bit name, and the texts that occur twice: (t, n, bytes)."""
    seed = fixed or 0
    while True:
        keyed, text = _keyed(docs, seed)
        named = keyed.select("t", F.xxhash64(F.lit("other"), "text").alias("o"), F.octet_length("text").cast("bigint").alias("bytes"))
        copies = stored(named.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"), F.min("o").alias("a"), F.max("o").alias("z")).filter("n > 1"), "suffix-copies")
        if copies.filter("a <> z").isEmpty():
            return seed, copies.select("t", "n", "bytes")
        if fixed is not None:
            raise ValueError("two texts share a name under the index's seed: index all documents anew")
        seed += 1


def _fetch(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, single, t, place, data) for wanted (key, single, t, place): the bytes a posting stands for."""
    lists = wanted.groupBy("t").agg(F.collect_list(F.struct("key", "single", "place")).alias("wanted"))
    near = maybe_in(keyed.withColumnRenamed("t", "digest"), Bitmap(wanted.select(F.col("t").alias("digest"))))
    once = near.select(F.col("digest").alias("t"), "text").join(lists, "t")
    ship(keyed.sparkSession)
    # Copies of a text yield the same rows, one for each: keep one.
    rows = once.withColumn("data", F.encode("text", "utf-8")).select("t", "data", F.explode("wanted").alias("w"))
    first = (F.shiftright("w.place", 16) - F.shiftright("w.place", 8).bitwiseAND(F.lit(255))).cast("int")
    size = (F.col("w.place").bitwiseAND(F.lit(255)) + SPAN).cast("int")
    return rows.select("w.key", "w.single", "t", "w.place", F.substr("data", first + 1, size).alias("data")).dropDuplicates(["key", "t", "place"])


def repeated_spans(
    docs: DataFrame, batches: int = BATCHES, hot: int = HOT, index: SuffixIndex | None = None, earlier: DataFrame | None = None
) -> tuple[int, DataFrame, DataFrame]:
    """(seed of text names, texts that occur twice, (t, start, stop) of repeated strings in the others).

    ``earlier`` are the documents that the index holds already.
    """
    index = index or SuffixIndex()
    texts = docs.select("text") if earlier is None else docs.select("text").unionByName(earlier.select("text"))
    seed, copies = _texts(texts, index.seed)
    index.seed = seed
    keyed, new = _keyed(texts, seed)[0], _keyed(docs, seed)[0]
    if earlier is not None:  # a text that is indexed already brings nothing new
        new = new.join(stored(_keyed(earlier, seed)[0].select("t").distinct(), "suffix-known"), "t", "left_anti")
    found = None
    for batch in range(batches):
        # Copies of a text in several tasks make matches of their own; they are made one below.
        matched = index.take(new.filter(F.pmod(F.shiftright("t", 7), F.lit(batches)) == batch))
        found = matched if found is None else found.unionByName(matched)
    posted = index.postings[0].drop("suffix")
    for other in index.postings[1:]:
        posted = posted.unionByName(other.drop("suffix"))
    index.note()
    keys = stored(found.distinct(), "suffix-keys")
    # Copies of a posting stay until the contexts are counted: a join with nothing behind it is one that Spark splits.
    near = maybe_in(posted.withColumnRenamed("key", "digest"), Bitmap(keys.select(F.col("key").alias("digest"))))
    near = near.withColumnRenamed("digest", "key").join(keys, "key", "left_semi")
    near = stored(near, "suffix-matches")

    contexts = stored(near.distinct().groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "place")).alias("at")), "suffix-contexts")
    first = F.shiftright("place", 16) - F.shiftright("place", 8).bitwiseAND(F.lit(255))
    whole = near.join(contexts.filter("n > 1"), ["key", "context"], "left_semi").select(
        "t", first.alias("start"), (first + F.col("place").bitwiseAND(F.lit(255)) + SPAN).alias("stop")
    )
    mixed = stored(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "suffix-mixed")
    wanted = stored(
        contexts.join(mixed, "key").select("key", (F.col("n") == 1).alias("single"), "at.t", "at.place", (F.col("kinds") > hot).alias("hot")),
        "suffix-wanted",
    )
    data = stored(_fetch(keyed, wanted.drop("hot")).join(mixed, "key").withColumn("hot", F.col("kinds") > hot), "suffix-bytes")
    # Written one by one, so that Spark splits a hot context in the join of its own job.
    whole, compared, grouped = (
        stored(spans, "suffix-spans") for spans in (whole, _equal_windows(data.filter("not hot")), _grouped_windows(data.filter("hot")))
    )
    return seed, copies, whole.unionByName(compared).unionByName(grouped)


def _cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, list[bytes]]:
    """Number of maximal runs covered by the spans, and the pieces outside them."""
    runs, at, kept = 0, 0, []
    end = None
    for start, stop in sorted(spans):
        if end is None or start > end:
            runs += 1
            kept.append(data[at:start])
        at = end = max(stop, end or 0)
    kept.append(data[at:])
    return runs, kept


def remove_repeats(
    docs: DataFrame,
    batches: int = BATCHES,
    hot: int = HOT,
    with_left: bool = False,
    index: SuffixIndex | None = None,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """(own, n_bytes, n_spans, kept): each row of ``docs`` as a struct, and its remaining bytes.

    With an ``index`` and the ``earlier`` documents that it holds, strings that also start in those are removed as well;
    earlier documents are not indexed again, and only the texts of theirs that match are read for their bytes.

    ``with_left`` adds ``left``: the same as text, without the parts of characters at the ends of each piece.
    """
    seed, copies, spans = repeated_spans(docs, batches, hot, index, earlier)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("own"), F.xxhash64(F.lit(seed), text).alias("digest"), text.alias("text"))
    lists = spans.groupBy("t").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    twice = copies.filter(F.col("bytes") >= SPAN).select("t", "bytes")
    changes = twice.select("t", F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("bytes").alias("stop"))).alias("spans"))
    changes = stored(lists.join(twice, "t", "left_anti").unionByName(changes), "suffix-changes")
    bitmap = Bitmap(changes.select(F.col("t").alias("digest")))
    data = F.encode("text", "utf-8")
    same = maybe_in(rows, bitmap, wanted=False).select(
        "own", F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_spans"), data.alias("kept"),
        *([F.col("text").alias("left")] if with_left else []),
    )
    near = maybe_in(rows, bitmap).withColumnRenamed("digest", "t").join(changes, "t", "left")
    near = near.select("own", data.alias("data"), F.to_json("spans").alias("spans"))
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            sizes, runs, kept, left = [], [], [], []
            for text, found in zip(batch["data"].to_pylist(), batch["spans"].to_pylist()):
                n, pieces = _cut(text, [(s["start"], s["stop"]) for s in json.loads(found or "[]")])
                sizes.append(len(text))
                runs.append(n)
                kept.append(b"".join(pieces))
                if with_left:
                    left.append("".join(p.decode(errors="ignore") for p in pieces))
            columns = [batch["own"], pa.array(sizes, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())]
            names = ["own", "n_bytes", "n_spans", "kept"]
            if with_left:
                columns, names = [*columns, pa.array(left, pa.string())], [*names, "left"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return same.unionByName(near.mapInArrow(run, same.schema))


def query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(
        "own.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


SQL = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, h, unnest(range(0, len(h) // 2 - {SPAN - 1})) AS i FROM d WHERE len(h) >= {2 * SPAN}
), k AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * SPAN})) AS m FROM w
), r AS (
  SELECT doc_id, i FROM k JOIN (SELECT m FROM k GROUP BY m HAVING count(*) > 1) USING (m)
), g AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {SPAN} THEN 0 ELSE 1 END AS fresh FROM r
), s AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM g
), runs AS (
  SELECT doc_id, run, min(i) AS a, max(i) + {SPAN} AS z FROM s GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, run, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY run), 0) AS f, a AS t FROM runs
  UNION ALL
  SELECT doc_id, max(run) + 1, max(z), any_value(len(h) // 2) FROM runs JOIN d USING (doc_id) GROUP BY doc_id
), kept AS (
  SELECT doc_id, CAST(count(*) - 1 AS BIGINT) AS n_spans, string_agg(substr(h, 2 * f + 1, 2 * (t - f)), '' ORDER BY run) AS rest
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(len(h) // 2 - len(coalesce(rest, h)) // 2 AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
