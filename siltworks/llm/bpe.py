"""BPE encoding by a priority queue of merge ranks over a linked list of symbols, and decoding.

Reads a tokenizer file of the word kind: lower case, white space dropped, an end-of-word suffix
on the last symbol of a word, and byte symbols. ``WordBpe.merge`` is the method: symbols of a
word form a doubly linked list, and a queue holds (rank, place) of every neighbouring pair
that may merge. The lowest rank, leftmost first, is taken; an entry whose symbols have changed
since is stale and skipped; the new symbol offers its pairs with both neighbours. Decoding
concatenates the vocabulary strings, with a space between, as the file names no decoder.

Null text counts as empty: no ids, empty text. Equal rows are encoded as often as they come; an
empty table gives an empty result; texts of any length are taken whole.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
import uuid
from array import array
from collections.abc import Iterator

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.chunk_encoder import _LOADED, ChunkEncoder, byte_symbols
from siltworks.llm.common import map_rows

# White space as the file's patterns mean it; a language's own \s may hold more characters.
_SPACE = r"\p{White_Space}"


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        model = config["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        symbols = byte_symbols()
        self.inner = [vocab[c] for c in symbols]
        self.last = [vocab[c + self.suffix] for c in symbols]
        self.strings = {i: s for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.strings.update({i: s for s, i in self.special.items()})
        split = next(p["pattern"]["Regex"] for p in config["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split.replace(r"\s", _SPACE))
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece, given as UTF-8."""
        n = len(data)
        symbol = [self.inner[b] for b in data]
        symbol[-1] = self.last[data[-1]]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        merges, queue = self.merges, []
        for i in range(n - 1):
            found = merges.get((symbol[i], symbol[i + 1]))
            if found:
                queue.append((found[0], i, found[1], symbol[i], symbol[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, new, left, right = heapq.heappop(queue)
            j = after[i]
            if symbol[i] != left or j == n or symbol[j] != right:
                continue  # stale
            symbol[i], symbol[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = merges.get((new, symbol[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, found[1], new, symbol[k]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbol[h], new))
                if found:
                    heapq.heappush(queue, (found[0], h, found[1], symbol[h], new))
        return [s for s in symbol if s >= 0]

    def encode_text(self, text: str) -> list[int]:
        """Ids of a text: special tokens first, then normal form, pieces and merges."""
        out: list[int] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
                continue
            # Capital sigma has one lower-case form here, wherever it stands.
            plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for piece in self.pieces.findall(plain):
                out += self.merge(piece.encode())
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


def loaded(path: str, run: str) -> tuple[WordBpe, ChunkEncoder]:
    """The coder of a file, and its memory of chunks; one per worker process and run."""
    if (run, path) not in _LOADED:
        coder = WordBpe(path)
        _LOADED[run, path] = coder, ChunkEncoder(lambda word: array("I", coder.encode_text(word.decode())).tobytes(), keep_space=False)
    return _LOADED[run, path]


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian unsigned 32-bit integers, and the text they decode to."""

    run = uuid.uuid4().hex

    def make(batches: Iterator[dict]) -> Iterator[tuple]:
        coder, chunks = loaded(tokenizer, run)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = chunks.encode(text)
                yield doc_id, ids, coder.decode(array("I", ids).tolist())

    return map_rows(docs.select("doc_id", "text"), make, "doc_id bigint, ids binary, decoded string", run)


def query(docs: DataFrame, tokenizer: str) -> DataFrame:
    return encode(docs, tokenizer).select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
