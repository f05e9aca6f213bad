"""Token counts and the streaming codec against the tokenizers library."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe_codec, bpe_vocab, token_count
from tests.llm.rows import clashing, edge_frame, edge_rows, empty_frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", "'", "'ll", "'s", " ", "  ", "\n", "\t", "1", "22", "é", "中", "!", "...",
          "<|endoftext|>", "the", "in", "ing", "aaaa", "　", "\U0001F600", "<|endo", "====", "\x1c"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    with open(PATH, "rb") as f:
        return bpe_vocab.load(f.read())


def _texts(n):
    rng = random.Random(5)
    for _ in range(n):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.15:
            text += rng.choice(["a", " ", "=", "1", "the", "\n", "aB", "\x00"]) * rng.randint(50, 900)
            text += rng.choice(PIECES)
        yield text


def test_small_windows_give_the_librarys_ids(library, vocab):
    codec = bpe_codec.Codec(vocab, chunk=16, window=4)
    whole = bpe_codec.Codec(vocab)
    for text in _texts(3000):
        ids = library.encode(text, add_special_tokens=False).ids
        packed = b"".join(codec.encode(text))
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids, text
        assert b"".join(whole.encode(text)) == packed
        assert token_count.count_text(vocab, text) == len(ids)
        assert "".join(codec.decode(packed)) == library.decode(ids, skip_special_tokens=False)


def test_state_stays_within_the_window(vocab):
    run = bpe_codec.RunEncoder(vocab, bpe_codec.sufficient_lookahead(vocab), window=64)
    held = 0
    for _ in range(2000):
        run.feed(b"the" * 7)
        held = max(held, len(run.held))
    assert held <= 64 + run.lookahead + 64


def test_lookahead_is_needed_and_enough():
    # a chain of rules that carries an effect to the left, two bytes a rule
    rules = [(0, 1, 2), (1, 2, 3), (2, 3, 4)]

    class Tiny:
        bytes_of = {0: b"a", 1: b"b", 2: b"ab", 3: b"bab", 4: b"abbab"}
    Tiny.rules = rules
    assert bpe_codec.sufficient_lookahead(Tiny) == 4
    Tiny.rules = [(2, 1, 3), (0, 1, 2)]
    with pytest.raises(ValueError):
        bpe_codec.sufficient_lookahead(Tiny)


def test_long_run_of_one_kind(library, vocab):
    text = "x" * 5000 + " " * 3000 + "ab" * 4000 + "7" * 2500 + "\n" * 2000
    codec = bpe_codec.Codec(vocab, chunk=256, window=32)
    ids = library.encode(text, add_special_tokens=False).ids
    assert b"".join(codec.encode(text)) == struct.pack(f"<{len(ids)}I", *ids)


def test_broken_utf8_decodes_like_the_library(library, vocab):
    rng = random.Random(6)
    codec = bpe_codec.Codec(vocab)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(30)]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert "".join(codec.decode(packed)) == library.decode(ids, skip_special_tokens=False)


def test_operators_on_edge_rows(spark, library):
    df = clashing(edge_frame(spark), "n_tokens", "ids", "n_bytes", "__text", "__value")
    counts = token_count.count_tokens(df, PATH)
    assert counts.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want, digest = [], []
    for doc_id, text, *_ in edge_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len((text or "").encode()), len(ids), len(ids) > 1024))
        decoded = library.decode(ids, skip_special_tokens=False)
        digest.append((doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                       hashlib.sha256(decoded.encode()).hexdigest()))
    key = repr
    assert sorted(map(tuple, counts.collect()), key=key) == sorted(want, key=key)
    got = bpe_codec.digests(df, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(digest, key=key)


def test_encode_then_decode_gives_the_text(spark):
    df = edge_frame(spark)
    back = bpe_codec.decode(bpe_codec.encode(df, PATH), PATH).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted(
        (repr(r.doc_id), r.text or "") for r in df.collect())


def test_empty_table(spark):
    assert token_count.count_tokens(empty_frame(spark), PATH).count() == 0
    assert bpe_codec.digests(empty_frame(spark), PATH).count() == 0
