"""Quality rules of documents, tightened by host.

Each document gets its counts and two verdicts on itself: the base rules, which alone reject
it, and warnings (many symbols, repeated lines, odd word lengths). A host, here the column
``source``, is judged by the share of its documents that fail a rule or a warning. Shares of
small hosts are shrunk towards all hosts by a beta prior whose mean and strength come from the
hosts themselves (method of moments, hosts weighted by their documents, the spread that chance alone makes taken off). On a host whose shrunk share exceeds ``HOST_LIMIT`` a
warning rejects a document as well; elsewhere it doesn't. A clean document stays on any host.

Null text counts as empty: no words, so it fails. Null source is a host like any other. Equal
rows get equal verdicts and count as often as they come. An empty table gives an empty result.
Whole texts are counted, of any length.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from io import BytesIO
from itertools import count

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import map_rows, row_key, stored, word_pieces

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT = 20, 30
MIN_WORD_CHARS, MAX_WORD_CHARS = 2, 15
HOST_LIMIT = 0.5
#: Windows that are compared at once.
WINDOWS = 1_000_000
#: Bounds of the prior's strength, in documents.
WEAKEST, STRONGEST = 1.0, 10_000.0

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint"

WARNING = (
    f"100 * n_symbols > {MAX_SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines"
    f" OR word_chars < {MIN_WORD_CHARS} * n_words OR word_chars > {MAX_WORD_CHARS} * n_words"
)
BASE = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words"


def repeated_in(ids: np.ndarray, kinds: int) -> int:
    """Words, given by their numbers below ``kinds``, that lie in a three-word window found twice or more, the first one included.

    Windows are compared ``WINDOWS`` or so at a time, those of equal remainder together, so a long text needs no more memory for it.
    """
    n = len(ids) - 2
    if n < 2:
        return 0
    if kinds < 2_000_000:  # three numbers fit 63 bits
        windows = (ids[:-2] * np.int64(kinds) + ids[1:-1]) * kinds + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * np.int64(kinds) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * kinds + ids[2:]
    covered, passes = np.zeros(len(ids), bool), -(-n // WINDOWS)
    for k in range(passes):
        places = np.flatnonzero(windows % passes == k) if passes > 1 else np.arange(n)
        some = windows[places]
        order = np.argsort(some, kind="stable")
        same = some[order][1:] == some[order][:-1]
        again = np.zeros(len(some), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        for step in range(3):
            covered[places[again] + step] = True
    return int(covered.sum())


def repeated_words(words: list[bytes]) -> int:
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return repeated_in(np.array([numbers[w] for w in words], np.int32), len(numbers))


def duplicate_lines(data: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one.

    Lines are told apart by a hash; only lines whose hash comes twice are kept and compared as they are.
    """
    hashes = array("Q", (xxhash.xxh64_intdigest(line) for line in _lines(data)))
    seen, times = np.unique(np.frombuffer(hashes, np.uint64), return_counts=True) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    twice = set(seen[times > 1].tolist())
    distinct = {line for line, h in zip(_lines(data), hashes) if h in twice} if twice else set()
    return len(hashes), int(times[times > 1].sum()) - len(distinct)


def _lines(data: bytes) -> Iterator[bytes]:
    """Lines with a word, without their line end."""
    return (line.removesuffix(b"\n") for line in BytesIO(data) if not line.isspace())


def counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    text = text or ""
    data = text.encode()
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = array("i")
    for piece in word_pieces(data):
        ids.extend(map(numbers.__getitem__, piece.split()))
    word_chars = len(text) - sum(map(text.count, SPACE))
    n_lines, n_dup_lines = duplicate_lines(data)
    words = np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32)
    return len(ids), word_chars, sum(map(text.count, SYMBOLS)), n_dup_lines, repeated_in(words, len(numbers)), n_lines


def measure(docs: DataFrame) -> DataFrame:
    """Counts and own verdicts of every document; ``row`` tells rows of one doc_id apart."""

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        for batch in batches:
            for doc_id, source, row, text in zip(batch["doc_id"], batch["source"], batch["row"], batch["text"]):
                yield doc_id, source, row, *counts(text)

    named = docs.select("doc_id", "source", row_key("text", "source").alias("row"), "text")
    return map_rows(named, make, f"doc_id bigint, source string, row bigint, {COUNTS}").withColumns(
        {"base_failed": F.expr(BASE), "warned": F.expr(WARNING)}
    )


def prior(hosts: int, documents: int, failed: int, squares: float, failed_squares: float) -> tuple[float, float]:
    """Mean and strength of the beta prior from sums over hosts of 1, n, failed, n * n and failed * failed / n.

    Shares of hosts spread by chance as well: that part, as large as it is on hosts that all fail alike,
    is taken off before what is left is read as the hosts' own difference.
    """
    mean = failed / documents if documents else 0.0
    chance = mean * (1 - mean)
    spread = failed_squares - mean * failed - chance * (hosts - 1)
    most = chance * (documents - squares / documents - (hosts - 1)) if documents else 0.0
    if spread <= 0 or most <= 0:
        return mean, STRONGEST
    return mean, min(max(most / spread - 1, WEAKEST), STRONGEST)


def host_rates(measured: DataFrame) -> DataFrame:
    """(source, n, failed, rate): the shrunk share of failing documents of every host."""
    hosts = measured.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("base_failed") | F.col("warned")).cast("bigint")).alias("failed")
    )
    sums = hosts.agg(F.count(F.lit(1)), F.sum("n"), F.sum("failed"), F.sum(F.col("n") * F.col("n").cast("double")), F.sum(F.col("failed") * F.col("failed") / F.col("n")))
    mean, strength = prior(*(v or 0 for v in sums.first()))  # one row
    rate = (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.withColumn("rate", rate)


def judge(docs: DataFrame) -> DataFrame:
    """Counts, base_failed, warned, host_rate and kept of every document, with its ``row`` hash."""
    measured = stored(measure(docs), "quality-counts")
    hosts = host_rates(measured).select(F.col("source").alias("host"), F.col("rate").alias("host_rate"))
    joined = measured.join(hosts, F.col("source").eqNullSafe(F.col("host")), "left").drop("host")
    rejected = F.col("base_failed") | ((F.col("host_rate") > HOST_LIMIT) & F.col("warned"))
    return joined.withColumn("kept", ~rejected)


def query(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), u AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), t AS (
  SELECT doc_id, i, word, lead(word, 1) OVER p AS second, lead(word, 2) OVER p AS third
  FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), r AS (
  SELECT doc_id, i, third IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, second, third) > 1 AS again FROM t
), c AS (
  SELECT doc_id, i, again OR coalesce(lag(again, 1) OVER p, false) OR coalesce(lag(again, 2) OVER p, false) AS covered
  FROM r WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), repeats AS (
  SELECT doc_id, count(*) FILTER (WHERE covered) AS n_repeat_words FROM c GROUP BY doc_id
), l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT w.doc_id, w.source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)
), j AS (
  SELECT *, {BASE} AS base_failed, {WARNING} AS warned FROM m
), h AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed OR warned) AS failed FROM j GROUP BY source
), p AS (
  SELECT sum(failed) / sum(n) AS mean, sum(failed) / sum(n) * (1 - sum(failed) / sum(n)) AS chance, count(*) - 1 AS others,
    sum(failed) AS failures, sum(n) AS documents, sum(CAST(n AS DOUBLE) * n) AS squares, sum(failed * failed / n) AS failed_squares
  FROM h
), q AS (
  SELECT mean, failed_squares - mean * failures - chance * others AS spread, chance * (documents - squares / documents - others) AS most FROM p
), s AS (
  SELECT mean, CASE WHEN spread > 0 AND most > 0 THEN least(greatest(most / spread - 1, {WEAKEST}), {STRONGEST}) ELSE {STRONGEST} END AS strength
  FROM q
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR (warned AND (failed + mean * strength) / (n + strength) > {HOST_LIMIT})) AS kept
FROM j JOIN h ON j.source IS NOT DISTINCT FROM h.source, s
"""
