"""Token ids of whole texts, encoded by white-space chunks that are remembered.

Both public vocabularies split a text before they merge, and no piece goes on over the start
of a run of white space. A text is therefore the concatenation of its chunks, each a run of
white space and the non-space after it, and equal chunks have equal ids. A run of punctuation
after a Latin letter is a piece of its own, so a chunk that is not known yet is cut there once
more, into chunks. Where white space is no part of the pieces, a stop or comma after a letter or digit is cut off at once, and
A-Z are lower-cased first if the vocabulary does so: a word is remembered once, not in each of its forms. The memory has two generations bounded in bytes: what was used lately is carried over, the
rest goes; chunks of over ``LONG`` bytes are encoded each time and never kept. It lives as long as
one run of a query: workers that go on to another start anew.

Long texts are encoded in pieces of about ``PIECE`` bytes, cut where a single space follows an ASCII letter or digit.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a generation, counted as keys, ids and ``ENTRY``; a worker holds two generations.
ROOM = 128_000_000
#: Bytes that an entry takes besides its key and ids: two objects and a place in the table.
ENTRY = 170
#: Bytes of the longest chunk that is kept.
LONG = 64
# Punctuation that goes on as one piece; an apostrophe may begin a contraction.
_STOPS = b".,;:!?&$%#*+=-_/|<>()[]{}\"@^~`\\"
PIECE = 1_000_000

# White space outside ASCII, as UTF-8. It may stand in one piece with ASCII white space.
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
# White space in some versions of Unicode and not in others: texts with it are not cut.
_DOUBTFUL = "\u180e".encode()
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WIDE_CHUNK = re.compile(f"[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+")
# Without these, every space and line end starts a run of its own, and a zero byte can mark it.
_NOT_SINGLE = (b"\0", b"\t", b"\x0b", b"\x0c", b"\r", b"  ", b" \n", b"\n ", b"\n\n")
_CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+")


def _ends_in_letter(word: str) -> bool:
    """Whether the last character is a Latin letter and still is one, without a mark, in lower-case normal form."""
    last = unicodedata.normalize("NFC", word[-1:]).lower()[-1:]
    return "A" <= last <= "\u024f" and last.isalpha()


class Memory(dict):
    """Key -> ids, made at first use. Two generations of ``room`` bytes: what is used goes on."""

    def __init__(self, make: Callable[[bytes], bytes], room: int):
        super().__init__()
        self.make = make
        self.room = room
        self.size = 0
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, key: bytes) -> bytes:
        if len(key) > LONG:
            return self.make(key)
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        self.keep(key, ids)
        return ids

    def keep(self, key: bytes, ids: bytes) -> None:
        if self.size > self.room:
            self.old = dict(self)
            self.clear()
            self.size = 0
        self[key] = ids
        self.size += len(key) + len(ids) + ENTRY


# A run of white space that is one space, and begins where a run does.
_SAFE_CUT = re.compile(rb"(?<=[0-9A-Za-z]) ")

# A single stop after an ASCII letter or digit or a letter of Latin-1, before a space: a piece of its own.
_LONE_STOP = re.compile(rb"[.,](?= )(?:(?<=[0-9A-Za-z][.,])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][.,]))")
# First bytes of the combining marks that an ASCII letter may be composed with; of some, the capital has no composed form.
_MARKS = (b"\xcc", b"\xcd")


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text in pieces that begin at a run of white space; one piece if that is nowhere certain."""
    at = 0
    while at < len(data):
        found = _SAFE_CUT.search(data, at + PIECE) if len(data) - at > PIECE and _DOUBTFUL not in data else None
        end = found.start() if found else len(data)
        yield data[at:end]
        at = end


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    ``encode_one`` gives the ids of a string by itself. ``keep_space`` says whether white space
    belongs to the pieces; if it does not, chunks are plain words. ``lower`` says that case makes no difference.
    ``encode_words`` gives the ids of several words of plain letters.
    """

    def __init__(
        self,
        encode_one: Callable[[bytes], bytes],
        keep_space: bool,
        room: int = ROOM,
        lower: bool = False,
        encode_words: Callable[[list[bytes]], list[bytes]] | None = None,
    ):
        self.keep_space = keep_space
        self.encode_words = encode_words
        self.lower = lower
        self.encode_one = encode_one
        self.chunks = Memory(self._from_parts, room)

    def _from_parts(self, chunk: bytes) -> bytes:
        if chunk[:1] == b"\n" and len(chunk) > 1 and not chunk[1:2].isspace() and not _WIDE_SPACE.match(chunk, 1) and _DOUBTFUL not in chunk:
            return self.chunks[b"\n"] + self.chunks[chunk[1:]]  # a line end right before a word is a piece
        word = chunk.rstrip(_STOPS)
        if len(word) < len(chunk) and b"<|" not in chunk and _ends_in_letter(word.decode()):  # special tokens stay whole
            return self.chunks[word] + self.chunks[chunk[len(word) :]]
        return self.encode_one(chunk)

    def _spaced(self, data: bytes) -> bytes:
        """A text whose runs of non-space have the same ids, one after the other, and are more often alike."""
        if b"<|" in data:  # special tokens stay whole, and as they are written
            return data
        if self.lower and not any(mark in data for mark in _MARKS):
            data = data.lower()
        return _LONE_STOP.sub(rb" \g<0>", data)

    def _cut(self, data: bytes) -> list[bytes]:
        if not self.keep_space:
            return self._spaced(data).split()
        if not data.isascii():
            if _DOUBTFUL in data:
                return [data]
            if _WIDE_SPACE.search(data):
                return [c.encode() for c in _WIDE_CHUNK.findall(data.decode())]
        if not any(mark in data for mark in _NOT_SINGLE):
            chunks = data.replace(b" ", b"\0 ").replace(b"\n", b"\0\n").split(b"\0")
            return chunks if chunks[0] else chunks[1:]
        chunks = _CHUNK.findall(data)
        end = len(data.rstrip(b" \t\n\r\x0b\x0c"))
        return chunks + [data[end:]] if end < len(data) else chunks

    def encode(self, text: str | None) -> bytes:
        data = (text or "").encode()
        if len(data) <= PIECE:
            return b"".join(map(self.chunks.__getitem__, self._cut(data)))
        return b"".join(b"".join(map(self.chunks.__getitem__, self._cut(piece))) for piece in _pieces(data))

    def _learn(self, chunks: list[bytes]) -> None:
        """Keeps the ids of those chunks that are plain words and not known yet."""
        fresh = [c for c in chunks if len(c) <= LONG and c not in self.chunks.old]
        for words in ([c for c in fresh if c.isalpha()], [c for c in fresh if not c.isascii() and _PLAIN_WORD.fullmatch(c.decode())]):
            for word, ids in zip(words, self.encode_words(words) if words else ()):
                self.chunks.keep(word, ids)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each of several texts. If white space is no part of the pieces, each distinct word is looked up once for all of them."""
        datas = [(text or "").encode() for text in texts]
        if self.keep_space or not datas or max(map(len, datas)) > PIECE:
            return list(map(self.encode, texts))
        words = pc.ascii_split_whitespace(pa.array(map(self._spaced, datas), pa.string()))
        coded = words.values.dictionary_encode()
        chunks = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.chunks.get, chunks))
        if self.encode_words is not None:
            self._learn([c for c, ids in zip(chunks, known) if ids is None])
        known = [self.chunks[c] if ids is None else ids for c, ids in zip(chunks, known)]
        ends = np.zeros(len(known) + 1, np.int32)
        np.cumsum([len(ids) // 4 for ids in known], out=ends[1:])
        ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(known), "<u4")).take(coded.indices)
        at = (4 * ids.offsets.to_numpy().astype(np.int64)[words.offsets.to_numpy()]).tolist()
        data = ids.values.to_numpy().tobytes()
        return [data[first:end] for first, end in zip(at, at[1:])]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b not in set(hidden) else chr(256 + hidden.index(b)) for b in range(256)]


# One piece in either vocabulary, in normal form, whose lower case has one form.
_PLAIN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

_LOADED: dict[tuple, object] = {}


def forget(run: str | None = None) -> None:
    """Gives the memory back when a worker goes on to other work than the named run."""
    for key in [k for k in _LOADED if k[0] != run]:
        del _LOADED[key]


def library_encoder(path: str, keep_space: bool, room: int = ROOM, run: str | None = None) -> ChunkEncoder:
    """An encoder over a tokenizer file, one per worker process and run.

    A word of plain letters goes straight to the library's model, as its one piece; anything
    else takes the library's whole way.
    """
    if (run, path, keep_space, room) not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        model = tokenizer.model
        lower = "Lowercase" in str(tokenizer.normalizer)
        symbols = dict(enumerate(byte_symbols()))

        def encode_one(data: bytes) -> bytes:
            spaced = keep_space and data[:1] == b" "
            if data[spaced:].isalpha():  # ASCII letters stand for themselves
                piece = symbols[0x20] * spaced + (data.lower() if lower else data)[spaced:].decode()
                return array("I", [t.id for t in model.tokenize(piece)]).tobytes()
            text = data.decode()
            if _PLAIN_WORD.fullmatch(text, int(spaced)):
                piece = text.lower().encode() if lower else data
                return array("I", [t.id for t in model.tokenize(piece.decode("latin-1").translate(symbols))]).tobytes()
            return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

        def encode_words(words: list[bytes]) -> list[bytes]:
            text = b"\n".join(words).decode()
            text = text.lower() if lower else text
            if text.isascii():
                pieces = text.split("\n")
            else:
                pieces = text.encode().decode("latin-1").translate(symbols).split(symbols[0x0A])
            return [array("I", [t.id for t in model.tokenize(piece)]).tobytes() for piece in pieces]

        _LOADED[run, path, keep_space, room] = ChunkEncoder(encode_one, keep_space, room, lower and not keep_space, encode_words)
    return _LOADED[run, path, keep_space, room]
