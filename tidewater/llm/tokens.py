"""Token ids of whole texts.

A tokenizer file that is plain byte-level BPE, with ids in the order of its
merges, is also a table of ranks. Its ids are then computed from those ranks
by ``tiktoken``, which gives the same ids in a fraction of the time; tests
compare both on every code point, every token and random texts. Any other
file, and a text that holds the string of a special token, goes through
``tokenizers`` itself.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# Fixed value: the split rule of byte-level BPE.
_PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_MODELS: dict[tuple[str, bool], "Encoder"] = {}


def _byte_of() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for:
    printable Latin-1 bytes are themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranks(path: str) -> dict[bytes, int] | None:
    """Rank, which is also the id, by token; None where the file is not plain
    byte-level BPE or its ids don't follow its merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if (
        model.get("type") != "BPE"
        or spec.get("normalizer")
        or any(split.get(k) != v for k, v in _LEVEL.items())
        or any(model.get(k) for k in odd)
    ):
        return None
    byte_of, vocab = _byte_of(), model["vocab"]
    special = {t["content"] for t in spec.get("added_tokens", ())}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    at = [vocab[t] for t in merged]
    single = [vocab[c] for c in byte_of if c in vocab]
    plain = {t: i for t, i in vocab.items() if t not in special}
    if len(single) < 256 or at != sorted(set(at)) or at and max(single) > at[0] or len(plain) != 256 + len(at):
        return None
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in plain.items()}


class Encoder:
    """A string such as ``<|endoftext|>`` in a text gives its special id, as
    the tokenizer has it by itself; with ``special_text`` it is ordinary text.
    ``top`` is the largest id."""

    def __init__(self, path: str, special_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = special_text
        self.top = max(self.model.get_vocab(with_added_tokens=True).values())
        added = sorted((t.content for t in self.model.get_added_tokens_decoder().values()), key=len, reverse=True)
        # Texts that hold such a string are encoded by the tokenizer.
        self.special = None if special_text or not added else re.compile("|".join(map(re.escape, added)))
        self.fast = None
        if table := ranks(path):
            import tiktoken

            self.fast = tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers; none for a null or
        empty text."""
        if not text:
            return b""
        if self.fast and not (self.special and self.special.search(text)):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def encoder(path: str | None = None, special_text: bool = False) -> Encoder:
    """The worker's encoder for a tokenizer file (default: byte_bpe_50k.json)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    key = (path, special_text)
    if key not in _MODELS:
        _MODELS[key] = Encoder(path, special_text)
    return _MODELS[key]
