"""Language identification by error-correcting output codes.

Every language has a codeword of bits. Linear classifiers over byte n-grams, one per bit, tell
the languages with a one there from the others. A text goes to the language whose codeword is
nearest to what they say: each bit costs its logistic loss, weighted by how well its classifier
does on that language in training (loss-weighted decoding). If the second language is almost as
near, the text is flagged as ambiguous.

Features are counts of hashed byte pairs and triples over the whole text, in lower case with
anything but letters as space. Classifiers are fitted on the driver from a sample of every
language: ``PER_LANGUAGE`` distinct texts with a letter, or all if there are fewer, those of
least hash, whatever their copies; only their feature vectors travel, 8 KB each. If that makes over
``TOTAL`` texts, all languages get fewer, but ``LEAST`` each: some 80 MB on the driver. All texts are judged.

A null text or one without a letter is ``und``. Null languages are not learned. Without any
learned language all texts are ``und``, and with one that one is given. Equal texts get equal
results. An empty table gives an empty result. Texts of any length are taken whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import map_rows, stored

PER_LANGUAGE, TOTAL, LEAST = 300, 9_600, 4
WIDTH = 4096
#: Difference of mean weighted loss below which two languages are too near to tell.
MARGIN = 0.05
_ROUNDS, _DECAY, _STEPS, _ROWS = 150, 1e-4, 1 << 30, 1024

# ASCII other than letters becomes a space.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Square roots of n-gram counts, as a vector of length one."""
    data = np.frombuffer(b" " + text.lower().encode().translate(_LETTERS) + b" ", np.uint8).astype(np.uint32)
    pairs = data[:-1] * np.uint32(257) + data[1:]
    triples = pairs[:-1] * np.uint32(263) + data[2:] + np.uint32(1 << 20)
    hashed = np.concatenate([pairs, triples]) * np.uint32(2654435761) >> np.uint32(20)
    counts = np.sqrt(np.bincount(hashed, minlength=WIDTH)).astype(np.float32)
    return counts / np.linalg.norm(counts)


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 per language, no two columns equal or opposite: all such columns while they are few."""
    if n <= 6:
        return np.array([[1 if i == 0 or not (c >> (i - 1) & 1) else -1 for c in range(1, 1 << (n - 1))] for i in range(n)], dtype=np.float32)
    random = np.random.default_rng(n)
    best, distance = None, -1
    for _ in range(200):
        code = random.choice([-1, 1], size=(n, 15 * int(np.ceil(np.log2(n))))).astype(np.float32)
        code = np.unique(code * code[0], axis=1)
        code = code[:, (code != code[0]).any(axis=0)]
        same = code @ code.T
        np.fill_diagonal(same, -code.shape[1])
        apart = (code.shape[1] - same.max()) / 2
        if apart > distance:
            best, distance = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        if not text or not self.languages or not has_letter(text):
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        bits = features(text) @ self.weights + self.bias
        loss = (np.logaddexp(0, -self.code * bits) * self.trust).sum(axis=1)
        first, second = np.argsort(loss, kind="stable")[:2]
        near = np.exp(loss[first] - loss)
        return self.languages[first], float(1 / near.sum()), bool(loss[second] - loss[first] < MARGIN)


def fit(languages: list[str], rows: list[tuple[str, np.ndarray]]) -> Model:
    """Logistic regression for every bit at once, by accelerated gradient descent on the whole sample."""
    code = codewords(len(languages)) if len(languages) > 1 else np.ones((len(languages), 0), np.float32)
    number = {lang: i for i, lang in enumerate(languages)}
    of = np.array([number[lang] for lang, _ in rows], dtype=np.int64)
    weights, bias = np.zeros((WIDTH, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    if not code.shape[1]:
        return Model(languages, code, weights, bias, code)
    x, y = np.stack([v for _, v in rows]), code[of]
    slices = [slice(at, at + _ROWS) for at in range(0, len(x), _ROWS)]  # of half precision, widened for a product only
    share = 1 / (np.bincount(of, minlength=len(languages))[of][:, None] * len(languages))
    ahead, ahead_bias, rate = weights, bias, np.float32(4.0)
    for k in range(_ROUNDS):
        slope, slope_bias = -_DECAY * ahead, np.zeros_like(bias)
        for s in slices:
            some = x[s].astype(np.float32)
            pull = (y[s] * share[s] / (1 + np.exp(np.clip(y[s] * (some @ ahead + ahead_bias), -30, 30)))).astype(np.float32)
            slope, slope_bias = slope + some.T @ pull, slope_bias + pull.sum(axis=0)
        before, before_bias = weights, bias
        weights, bias = ahead + rate * slope, ahead_bias + rate * slope_bias
        momentum = np.float32(k / (k + 3))
        ahead, ahead_bias = weights + momentum * (weights - before), bias + momentum * (bias - before_bias)
    right = np.concatenate([y[s] * (x[s].astype(np.float32) @ weights + bias) > 0 for s in slices]).astype(np.float32)
    trust = np.stack([right[of == i].mean(axis=0) if (of == i).any() else np.ones(code.shape[1]) for i in range(len(languages))])
    trust = np.maximum(trust - 0.5, 1e-3)
    return Model(languages, code, weights, bias, (trust / trust.sum(axis=1, keepdims=True)).astype(np.float32))


def held_out() -> Column:
    """Documents kept from learning: crc32 of the id as text leaves 1 when divided by 3. A null id doesn't."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame) -> Model:
    """The model of the documents that may be learned from."""
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("lang", F.xxhash64("text").alias("name"), "text")

    def usable(batches: Iterator[dict]) -> Iterator[tuple]:
        for batch in batches:
            yield from ((lang, name) for lang, name, text in zip(batch["lang"], batch["name"], batch["text"]) if has_letter(text))

    names = stored(map_rows(known, usable, "lang string, name bigint").distinct(), "language-texts")
    place = F.pmod("name", F.lit(_STEPS))
    # A row per language.
    counts = names.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min(place).alias("first")).collect()
    if not counts:
        return fit([], [])
    each = max(LEAST, min(PER_LANGUAGE, TOTAL // len(counts)))
    # So many more that fewer than ``each`` are next to impossible.
    wide = each + 6 * math.isqrt(each) + 20
    cuts = [(r["lang"], max(r["first"] + 1, min(_STEPS, wide * _STEPS // r["count"]))) for r in counts]
    limits = docs.sparkSession.createDataFrame(cuts, "lang string, cut bigint")
    near: dict[str, list[tuple[int, int]]] = {}
    for r in names.join(F.broadcast(limits), "lang").filter(place < F.col("cut")).select("lang", "name").collect():
        near.setdefault(r["lang"], []).append((r["name"] % _STEPS, r["name"]))
    chosen = [(lang, name) for lang, listed in near.items() for _, name in sorted(listed)[:each]]
    # About TOTAL rows, or LEAST per language where that is more.
    wanted = docs.sparkSession.createDataFrame(chosen, "lang string, name bigint")
    sample = known.join(F.broadcast(wanted), ["lang", "name"], "left_semi").dropDuplicates(["lang", "name"])

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        for batch in batches:
            for lang, name, text in zip(batch["lang"], batch["name"], batch["text"]):
                if has_letter(text):
                    yield lang, name, features(text).astype(np.float16).tobytes()

    # As many vectors of 8 KB, a partition of them at a time.
    vectors = stored(map_rows(sample.select("lang", "name", "text"), make, "lang string, name bigint, vector binary"), "language-vectors")
    taken = [(r["lang"], r["name"], np.frombuffer(r["vector"], np.float16)) for r in vectors.toLocalIterator()]
    rows = [(lang, vector) for lang, _, vector in sorted(taken, key=lambda r: r[:2])]
    return fit(sorted({lang for lang, _ in rows}), rows)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous), one row per document."""
    model = train(docs)

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        for batch in batches:
            for doc_id, out, text in zip(batch["doc_id"], batch["held_out"], batch["text"]):
                yield doc_id, out, *model.predict(text)

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return map_rows(rows, make, "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean")
