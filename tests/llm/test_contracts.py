"""Ids as the tokenizer has them, ids that don't fit, draws of rows without ids."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from tidewater.llm import mixing, packing, tokens, training_order

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y\n<|endoftext|>", "plain words, as ever", " <|endoftext", ""]


def test_ids_of_special_strings_are_the_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ours = tokens.encoder()
    for t in TEXTS:
        assert np.frombuffer(ours.ids(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t
    assert np.frombuffer(ours.ids(TEXTS[0]), "<u4").tolist() == [64, 220, 50256, 275]
    assert 50256 not in np.frombuffer(tokens.encoder(special_text=True).ids(TEXTS[0]), "<u4")


def test_packed_ids_are_the_tokenizers(docs_of):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack(docs_of(list(enumerate(TEXTS)))).collect()}
    for i, t in enumerate(TEXTS):
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes())), t


def test_ids_beyond_16_bits_are_an_error():
    with pytest.raises(ValueError, match="16 bits"):
        next(training_order._tokenize(None, 70_000)(iter([])))


def test_rows_without_ids_are_drawn_one_by_one(docs_of):
    rows = [(None if i % 3 == 0 else i, f"some text {i % 40} and more") for i in range(1800)]
    for seed in (17, 18):
        got = mixing.mixture(docs_of(rows), budget=0.5, seed=seed).collect()
        none = [r for r in got if r.doc_id is None]
        mean = sum(r.probability for r in none)
        spread = sum(r.probability * (1 - r.probability) for r in none) ** 0.5
        assert len(none) == 600 and abs(sum(r.selected for r in none) - mean) < 3 * spread
        assert 0 < sum(r.selected for r in none) < 600
