"""Benchmark decontamination: windows of test items sought in documents through a broadcast hash set.

Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. A window
is ``n`` consecutive words of an item; an item of fewer words, but not none, is one window. Distinct windows are
written once with their 64-bit hash. A document's words are laid out place by place within
its task, each place's hash is looked up in the broadcast table of windows, and a hit is verified
word by word there and then, while the words are at hand: places without a hit never leave the
compiled loop. What leaves a task is one slim row per document and one per verified hit. Hits are
united per text, not per document, so copies of a text are put together on the map side; documents
then take up the findings of their text by its digest.

The windows are broadcast only if they number at most ``BROADCAST_ROWS`` with ``BROADCAST_CHARS``
characters. Beyond that a bitmap of fixed size stands in for the hash set: places that it can't rule out are shuffled
to the windows by hash and verified there. Results are the same.

Null texts and texts without a word have no words and no hits. Repeated rows give a row each. Items with a
null text or no word have no window; items of one id are one item; a null id is an item whose id
reads as empty text. An empty benchmark hits nothing; an empty table gives an empty result.
Only the named columns are read, so others may have any name. Texts are taken whole, of any length
that fits a row. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import Bitmap, maybe_in, stored

# Words of a window.
N = 10
# Bounds of what is broadcast.
BROADCAST_ROWS, BROADCAST_CHARS = 300_000, 24_000_000

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before capitals are lowered, and what stands between.
_TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
_LEAD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; plain ASCII takes the quicker function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _CAPITALS, _CAPITALS.lower()))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _hash_at(words: Column, place: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, place + k) for k in range(n)])


def windows(items: DataFrame, n: int = N, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, length, digest, tokens), and which items hold them (window, item); both written."""
    words = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("words")).filter("size(words) > 0")
    placed = words.withColumn("place", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - n, F.lit(0)))))
    held = stored(placed.select("item", F.slice("words", F.col("place") + 1, n).alias("tokens")).distinct(), "item-windows")
    digest = F.coalesce(*[F.when(F.size("tokens") == k, _hash_at(F.col("tokens"), F.lit(0), k)) for k in range(1, n + 1)])
    distinct = held.select("tokens").distinct().select("tokens", F.size("tokens").alias("length"), digest.alias("digest"))
    distinct = stored(distinct.withColumn("window", F.monotonically_increasing_id()), "windows")
    return distinct, stored(held.join(distinct, "tokens").select("window", "item"), "window-items")


def _places(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """Every place of every document with the hash of the window there, for each window length; and a place -1."""
    texts = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest_of_text"), words_of(F.col("text")).alias("words"))
    places = texts.select("*", F.explode(F.sequence(F.lit(-1), F.size("words") - 1)).alias("place"))
    if len(lengths) > 1:
        places = places.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("long")).filter((F.col("place") >= 0) | (F.col("long") == lengths[0]))
    else:
        places = places.withColumn("long", F.lit(lengths[0] if lengths else 1))
    inside = (F.col("place") >= 0) & (F.col("place") + F.col("long") <= F.size("words"))
    digest = F.lit(None).cast("bigint")
    for k in lengths:
        digest = F.when(inside & (F.col("long") == k), _hash_at(F.col("words"), F.col("place"), k)).otherwise(digest)
    return places.withColumn("digest", digest)


def occurrences(
    docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text", most_rows: int = BROADCAST_ROWS, most_chars: int = BROADCAST_CHARS
) -> DataFrame:
    """A row per document (place -1, its number of words) and one per verified occurrence of a window; written.

    (doc_id, digest_of_text, n_words, place, long, window); ``found`` are the windows.
    """
    size = found.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.array_join("tokens", " "))).alias("chars")).first()
    lengths = sorted(r["length"] for r in found.select("length").distinct().collect())  # n numbers at most
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    places = _places(docs, lengths)
    listed = found.select("window", F.col("digest").alias("window_digest"), "tokens")
    columns = ["doc_id", "digest_of_text", F.size("words").cast("bigint").alias("n_words"), "place", "long"]
    own = F.slice("words", F.col("place") + 1, F.col("long"))
    if size["n"] <= most_rows and (size["chars"] or 0) <= most_chars:
        met = places.join(F.broadcast(listed), F.col("digest") == F.col("window_digest"), "left")
        kept = met.filter((F.col("place") == -1) | (F.col("window").isNotNull() & (own == F.col("tokens"))))
        return stored(kept.select(*columns, "window"), "occurrences")
    marked = places.filter("place = -1").select(*columns, F.lit(None).cast("bigint").alias("window"))
    near = maybe_in(places.filter("place >= 0"), Bitmap(found.select("digest"))).select(*columns, "digest", own.alias("own"))
    met = near.join(listed, (F.col("digest") == F.col("window_digest")) & (F.col("own") == F.col("tokens")))
    return stored(marked.unionByName(met.drop("digest", "own", "window_digest", "tokens")), "occurrences")


def _united(spans: Column) -> Column:
    """Words that lie in any of the spans (first, past), sorted by their first word."""
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).cast("bigint").alias("words"))

    def add(state: Column, span: Column) -> Column:
        new = F.greatest(span["past"] - F.greatest(span["first"], state["reach"]), F.lit(0))
        return F.struct(F.greatest(state["reach"], span["past"]).alias("reach"), (state["words"] + new).alias("words"))

    return F.aggregate(spans, start, add, lambda state: state["words"])


def contaminated(docs: DataFrame, items: DataFrame, n: int = N, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """Per document: doc_id, digest_of_text, n_words, n_hit, items (sorted as text) and spans (first word, word past the last; may overlap)."""
    found, held = windows(items, n)
    rows = occurrences(docs, found, doc_id, text, **bounds)
    hits = rows.filter("window IS NOT NULL")
    span = F.struct(F.col("place").alias("first"), (F.col("place") + F.col("long")).alias("past"))
    spans = hits.groupBy("digest_of_text").agg(F.collect_set(span).alias("spans"), F.collect_set("window").alias("windows"))
    spans = stored(spans, "hit-texts")
    named = spans.select("digest_of_text", F.explode("windows").alias("window")).join(held, "window")
    named = named.groupBy("digest_of_text").agg(F.collect_set("item").alias("items"))
    texts = spans.select("digest_of_text", F.array_sort("spans").alias("spans")).join(named, "digest_of_text")
    texts = stored(texts.select(F.col("digest_of_text").alias("of"), "spans", _united(F.col("spans")).alias("n_hit"), F.array_sort("items").alias("items")), "findings")
    every = rows.filter("place = -1")
    return every.join(texts, F.col("digest_of_text") == F.col("of"), "left").select(
        "doc_id",
        "digest_of_text",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,past:int>>")).alias("spans"),
    )


def clean(docs: DataFrame, items: DataFrame, remove: str = "spans", n: int = N, **bounds: int) -> DataFrame:
    """The documents, all columns, without what the benchmark holds: ``spans`` cuts hit words out of
    the texts, each with what stands up to the next word; ``documents`` drops whole rows."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove: spans or documents, not {remove!r}")
    found = contaminated(docs, items, n, **bounds).filter("n_hit > 0").select(F.col("digest_of_text").alias("of"), "spans")
    found = stored(found.groupBy("of").agg(F.first("spans").alias("spans")), "to-clean")
    tagged = docs.select(F.struct("*").alias("own"), F.md5(F.coalesce("text", F.lit(""))).alias("digest_of_text"))
    same = F.col("digest_of_text") == F.col("of")
    if remove == "documents":
        return tagged.join(found.select("of"), same, "left_anti").select("own.*")
    text = tagged.join(found, same, "left_semi").groupBy("digest_of_text").agg(F.first("own.text").alias("text"))
    tokens = text.select("digest_of_text", F.posexplode(F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0))).alias("place", "token"))
    out = found.select(F.col("of").alias("out_of"), F.explode("spans").alias("span"))
    out = out.select("out_of", F.explode(F.sequence(F.col("span.first"), F.col("span.past") - 1)).alias("out")).distinct()
    stay = tokens.join(out, (F.col("digest_of_text") == F.col("out_of")) & (F.col("place") == F.col("out")), "left_anti")
    stay = stay.groupBy("digest_of_text").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "token"))), lambda t: t["token"]), "").alias("rest"))
    cut = text.select("digest_of_text", F.regexp_extract("text", _LEAD, 0).alias("lead")).join(stay, "digest_of_text", "left")
    cut = stored(cut.select(F.col("digest_of_text").alias("of"), F.concat("lead", F.coalesce("rest", F.lit(""))).alias("cut")), "cut-texts")
    return tagged.join(cut, same, "left").select(
        *[(F.coalesce("cut", F.col("own.text")) if c == "text" else F.col("own").getField(c)).alias(c) for c in docs.columns]
    )


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = contaminated(docs, items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), i AS (
  SELECT DISTINCT item_id, words[s + 1 : s + {N}] AS part FROM (SELECT item_id, words, unnest(range(0, greatest(len(words) - {N}, 0) + 1)) AS s FROM b WHERE len(words) > 0)
), l AS (
  SELECT DISTINCT len(part) AS n FROM i
), d AS (
  SELECT doc_id, n, s, words[s + 1 : s + n] AS part
  FROM (SELECT doc_id, words, n, unnest(range(0, greatest(len(words) - n + 1, 0))) AS s FROM w, l)
), h AS (
  SELECT DISTINCT doc_id, item_id, s, n FROM d JOIN i USING (part)
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM h GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
