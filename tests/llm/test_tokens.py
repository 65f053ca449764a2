"""BPE, token files and packing against the public library."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from siltworks.llm import bpe, chunk_encoder, packing, token_blocks
from siltworks.llm.chunk_encoder import ChunkEncoder, library_encoder
from siltworks.llm.queries import BYTE_BPE, WORD_BPE, op5_bpe, op9_packing, op10_token_blocks


@pytest.fixture(scope="module")
def strings(texts):
    rng = random.Random(8)
    alphabet = "abcXYZ '\"’.,!?<|>09éÉßñİΣς漢字한글😀́  　\x00\x1c\x1f\x85 \t\n\r\x0b  stlremd"
    made = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    made += ["<|endoftext|>", " <|endoftext|> a", "a  <|startoftext|>b", "x <|endoftext", "Don't they'LL WE'RE", "a \n b", "one.\n\ntwo\n three \n"]
    return made + [t for _, t in texts if t is not None]


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_word_bpe_equals_the_library(strings):
    library, coder = Tokenizer.from_file(WORD_BPE), bpe.WordBpe(WORD_BPE)
    for s in strings:
        ids = library.encode(s, add_special_tokens=False).ids
        assert coder.encode_text(s) == ids
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("path, keep_space", [(WORD_BPE, False), (BYTE_BPE, True)])
def test_chunks_equal_whole_texts(strings, path, keep_space):
    library, encoder = Tokenizer.from_file(path), library_encoder(path, keep_space)
    for s in strings:
        assert ids_of(encoder.encode(s)) == library.encode(s, add_special_tokens=False).ids


SPACES = [" ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028", "\u202f", "\u3000"]


@pytest.mark.parametrize("path, keep_space", [(WORD_BPE, False), (BYTE_BPE, True)])
def test_all_pairs_and_triples_of_white_space(path, keep_space):
    """At the start, in the middle and at the end of a text, before and after letters, stops and digits."""
    library, encoder = Tokenizer.from_file(path), library_encoder(path, keep_space)
    for n in (1, 2, 3):
        for spaces in itertools.product(SPACES, repeat=n):
            run = "".join(spaces)
            for text in (run, f"{run}x", f"x{run}", f"ab.{run}x {run}9,", f"\n{run}x{run}\n{run}"):
                assert ids_of(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_long_texts_go_in_pieces(monkeypatch, strings):
    """With pieces of a few bytes every safe cut is taken; ids stay those of the whole text."""
    monkeypatch.setattr(chunk_encoder, "PIECE", 5)
    for path, keep_space in ((WORD_BPE, False), (BYTE_BPE, True)):
        library, encoder = Tokenizer.from_file(path), chunk_encoder.library_encoder(path, keep_space, run="pieces")
        for s in [*strings[:1500], "a  b \n c d\xa0 e f " * 50, "日本語" * 100, "x" * 50]:
            assert ids_of(encoder.encode(s)) == library.encode(s, add_special_tokens=False).ids
    chunk_encoder.forget()


def test_memory_is_bounded_and_forgets_safely():
    encoder = ChunkEncoder(lambda word: word, keep_space=False, room=3 * chunk_encoder.ENTRY)
    for i in range(50):
        assert encoder.encode(f"a{i} b c a{i}, d{i % 4}") == f"a{i}bca{i},d{i % 4}".encode()
        assert len(encoder.chunks) <= 4 and len(encoder.chunks.old) <= 4


def test_several_texts_at_once_and_words_in_one_form(strings):
    """Ids are those of each text by itself, also where a mark is composed with small letters only, or stops stand together."""
    library, encoder = Tokenizer.from_file(WORD_BPE), library_encoder(WORD_BPE, False, room=40 * chunk_encoder.ENTRY, run="several")
    odd = ["H\u0331 T\u0308, W\u030a. h\u0331", "a», b!, c.. d,. e, ñ. Ñ, ×, 3. 4, '. . ,", "I'M, DON'T. <|endoftext|>, <|ENDOFTEXT|>", "ÀÉ ÀÉ. àé, ẞ. İ, \u212a.", None, "", " \n", "日本, 語. "]
    for several in (odd, strings, odd * 3, []):
        assert [ids_of(ids) for ids in encoder.encode_all(several)] == [library.encode(s or "", add_special_tokens=False).ids for s in several]
    byte_level = library_encoder(BYTE_BPE, True, run="several")
    assert byte_level.encode_all(odd) == [byte_level.encode(s) for s in odd]
    fresh = library_encoder(WORD_BPE, False, run="forms")
    fresh.encode_all(["word Word WORD, word.", "word, WORD. año AñO, x"])
    assert set(fresh.chunks) == {c.encode() for c in ("word", "word.", "año", "x", ",", ".")}
    chunk_encoder.forget()


def test_long_chunks_are_not_kept():
    encoder = ChunkEncoder(lambda word: word, keep_space=True)
    for i in range(200):
        encoder.encode(f"{'日本語' * 300}{i}\xa0{'é' * 500}")
    kept = [encoder.chunks, encoder.chunks.old]
    assert sum(len(k) + len(v) for m in kept for k, v in m.items()) < 100_000


def test_a_worker_starts_anew_with_every_run():
    first = chunk_encoder.library_encoder(WORD_BPE, False, run="a")
    first.encode("some words")
    chunk_encoder.forget("a")
    assert chunk_encoder.library_encoder(WORD_BPE, False, run="a") is first
    chunk_encoder.forget("b")
    assert not chunk_encoder._LOADED


def test_bpe_query(spark, messy, texts):
    library = Tokenizer.from_file(WORD_BPE)
    wanted = []
    for i, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        wanted.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)) for r in op5_bpe(spark, messy).collect())


def test_block_round_trip():
    rng = np.random.default_rng(4)
    for high in (1, 2, 3, 255, 70_000, 2**31, 2**32):
        for n in (1, 7, token_blocks.BLOCK):
            values = rng.integers(0, high, n, dtype=np.uint64).astype("<u4")
            values[rng.random(n) < 0.05] = 2**32 - 1
            data = b"xx" + token_blocks.pack_block(values) + b"yy"
            assert token_blocks.unpack_block(data, 2, n).tolist() == values.tolist()


def test_exceptions_keep_blocks_small():
    values = np.full(token_blocks.BLOCK, 1000, "<u4") + np.arange(token_blocks.BLOCK, dtype="<u4") % 4
    plain = len(token_blocks.pack_block(values))
    values[5] = 2**31
    assert len(token_blocks.pack_block(values)) <= plain + 8


def test_file_gives_any_document():
    rng = np.random.default_rng(6)
    docs = [(i, rng.integers(0, 50_000, n).astype("<u4").tobytes()) for i, n in enumerate([0, 1, 5000, 3, 0, 2048, 2047, 9])]
    file = token_blocks.File(token_blocks.pack_file(docs))
    assert [d for _, d in docs] == list(file.documents())
    assert all(file.document(i).tobytes() == d for i, d in docs)
    assert list(token_blocks.File(token_blocks.pack_file([(1, b"")])).documents()) == [b""]


def test_token_files_query(spark, messy, texts):
    library = Tokenizer.from_file(WORD_BPE)
    ordered = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    wanted, at = [], 0
    for i, text in ordered:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        wanted.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    found = sorted((tuple(r) for r in op10_token_blocks(spark, messy).collect()), key=lambda r: r[1])
    assert found == wanted


def test_small_files_are_placed_after_one_another(spark, messy, monkeypatch):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    whole = token_blocks.read(token_blocks.write(docs, WORD_BPE, 2)).select("doc_id", "start", "ids").collect()
    starts = sorted((r["start"], len(r["ids"]) // 4) for r in whole)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_placing_fills_every_sequence():
    rng = random.Random(7)
    for _ in range(200):
        lengths = [rng.choice([1, 3, 40, 500, 1024, 3000]) + rng.randint(0, 30) for _ in range(rng.randint(0, 40))]
        pieces = packing.place(lengths)
        by_doc, by_seq = defaultdict(list), defaultdict(list)
        for d, start, n, s, offset in pieces:
            by_doc[d].append((start, n))
            by_seq[s].append((offset, n))
        for d, n in enumerate(lengths):
            at = 0
            for start, size in sorted(by_doc[d]):
                assert start == at and size > 0
                at += size
            assert at == n
        for found in by_seq.values():
            at = 0
            for offset, size in sorted(found):
                assert offset == at
                at += size
            assert at & (at - 1) == 0 and at <= packing.CAPACITY  # no padding


def test_costs_are_balanced():
    rng = random.Random(1)
    lengths = [rng.randint(20, 700) for _ in range(3000)]
    costs = defaultdict(float)
    for _, _, n, s, _ in packing.place(lengths):
        costs[s] += packing.cost(n)
    first = defaultdict(float)
    room, s = packing.CAPACITY, 0
    for n in lengths:  # next fit, with cuts
        while n:
            k = min(n, room)
            first[s] += packing.cost(k)
            n, room = n - k, room - k
            if not room:
                room, s = packing.CAPACITY, s + 1
    assert np.std(list(costs.values())) < np.std(list(first.values()))


def test_packing_query(spark, messy, texts):
    library = Tokenizer.from_file(BYTE_BPE)
    wanted = defaultdict(int)
    for i, text in texts:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        wanted[i, len(ids)] += len(ids)
    found, seqs = defaultdict(int), defaultdict(list)
    encoded = {(i, len(library.encode(t or "", add_special_tokens=False).ids) + 1): library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts}
    for r in op9_packing(spark, messy).collect():
        found[r["doc_id"], r["doc_tokens"]] += r["length"]
        piece = encoded[r["doc_id"], r["doc_tokens"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert found == wanted
    for pieces in seqs.values():
        ends = [a + n for a, n in sorted(pieces)]
        assert [a for a, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 1024
