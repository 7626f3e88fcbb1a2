"""Operators 1, 3 and 10: token files, byte-level BPE, packing."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from fixtures_llm import SF_DIR, awkward, documents
from tickloom.llm import packing, queries, token_files
from tickloom.llm.byte_bpe import ByteBpe, decode_documents, encode_documents, round_trip_digests
from tickloom.llm.word_tokens import WordEncoder
from tickloom.session import shared_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def codec():
    return ByteBpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tik(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_have_the_librarys_ids(library):
    draw = random.Random(3)
    parts = ["Ab", "q'", "'s", "'S", ".", ",!", "é", "é", "12", "¶", "\t", "\n", "\x1c", " ", "漢", "İ", "Σ", "<|endoftext|>", "'"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(9))) for _ in range(300)]
    texts = [" ".join(draw.choices(texts, k=4)) for _ in range(300)] + [t or "" for _, t in awkward()]
    expected = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    encoder = WordEncoder(WORDS)
    for _ in range(2):  # the second time from memory
        assert [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode(texts)] == expected


def test_token_files_hold_the_documents_in_order(spark, library):
    path = shared_path(spark, "tokens")
    rows = awkward()
    manifest = token_files.write_token_files(documents(spark, rows), path, WORDS, 2, sequence_tokens=16, sequences_per_batch=3)
    found = token_files.read_token_files(spark, path, manifest).collect()
    expected, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    file = token_files.TokenFile(f"{path}/{manifest.first().file}")
    ids, mask = file.sequence(0)
    assert len(ids) == len(mask) == 16 and not ids.flags.owndata and ids.dtype == np.uint16


def test_only_the_last_sequence_is_padded_and_masked(spark, tmp_path):
    path = shared_path(spark, "tokens")
    manifest = token_files.write_token_files(documents(spark, [(1, "a b c d e"), (2, "f")]).coalesce(1), path, WORDS, 2, 4, 2)
    total = 0
    for row in manifest.collect():
        file = token_files.TokenFile(f"{path}/{row.file}")
        count = -(-row.n_tokens // 4)
        masks = [file.sequence(i)[1].tolist() for i in range(count)]
        assert all(all(m) for m in masks[:-1]) and sum(masks[-1]) == row.n_tokens - 4 * (count - 1)
        total += row.n_tokens
    assert total == 8


def test_no_documents_no_files(spark):
    path = shared_path(spark, "tokens")
    manifest = token_files.write_token_files(documents(spark, []), path, WORDS, 2)
    assert manifest.count() == 0
    assert token_files.read_token_files(spark, path, manifest).count() == 0


def test_byte_bpe_is_the_librarys(codec, tik):
    draw = random.Random(1)
    letters = [" ", "\n", "\t", "a", "b", "é", "漢", "1", "'", "s", ".", "\x1c", "\x85", "😀", "\x00", "ll", "the", "​"]
    for _ in range(3000):
        text = "".join(draw.choices(letters, k=draw.randrange(14)))
        assert np.frombuffer(codec.encode_raw(text), "<u4").tolist() == tik.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 20000, "abc" * 7000, "".join(random.Random(2).choices("abcdefgh", k=20000))])
def test_very_long_pre_tokens(codec, tik, text):
    assert codec.encode(text) == tik.encode_ordinary(text)
    assert codec.decode(codec.encode(text)) == text.encode()


def test_encode_and_decode_documents(spark, tik):
    rows = awkward()
    docs = documents(spark, rows)
    encoded = encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    got = sorted(((r.doc_id, list(r.ids)) for r in encoded.collect()), key=repr)
    assert got == sorted(((i, tik.encode_ordinary(t or "")) for i, t in rows), key=repr)
    back = decode_documents(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((bytes(r.text) for r in back)) == sorted((t or "").encode() for _, t in rows)
    digests = round_trip_digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for key, text in rows:
        ids, raw = tik.encode_ordinary(text or ""), (text or "").encode()
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((key, len(ids), sha, hashlib.sha256(raw).hexdigest()))
    assert sorted(map(tuple, digests), key=repr) == sorted(expected, key=repr)
    assert encode_documents(documents(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def checked(rows, tokens=4096):
    """The number of sequences, after checking that each is gapless and within its limit."""
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= tokens
    return len(places)


def test_packing_of_all_documents(spark, library):
    found = packing.pack_documents(documents(spark, awkward()), WORDS, 1, tokens=64).collect()
    expected = []
    for key, text in awkward():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 64):
            expected.append((key, at // 64, at, len(ids[at : at + 64]), crc(ids[at : at + 64])))
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(expected, key=repr)
    assert checked(found, 64) <= sum(e[3] for e in expected) // 64 + 2
    assert packing.pack_documents(documents(spark, []), WORDS, 1).count() == 0


def test_query_packs_close_to_the_least(spark):
    found = queries.queries()["op10_best_fit_packing"](spark, SF_DIR).collect()
    assert checked(found) <= sum(r.length for r in found) / 4096 * 1.03 + 1


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_every_capacity_holds(score):
    draw = np.random.default_rng(1)
    lengths = draw.integers(1, 60, 400)
    place, offset = packing.best_fit(lengths, (100, 4, 4000), score=score, weights=(1, 1, 1))
    for number in np.unique(place):
        own = lengths[place == number]
        assert own.sum() <= 100 and len(own) <= 4 and (own.astype(float) ** 2).sum() <= 4000
        assert sorted(offset[place == number]) == np.concatenate([[0], np.cumsum(own[np.argsort(offset[place == number])])[:-1]]).tolist()
    with pytest.raises(ValueError, match="exceeds"):
        packing.best_fit(np.array([200]), (100, 4, 40000))


def test_pieces_without_a_length_take_no_room(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 0), (4, 5)], "sequence long, length int")
    found = {r.sequence: (r.sequence_id, r.offset) for r in packing.pack_pieces(rows, 10).collect()}
    assert found[2] == found[3] == (None, None) and sorted((found[1][1], found[4][1])) == [0, 5]
