"""Exact byte-level BPE token ids at the speed of the fastest library at hand."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np


def _byte_chars() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    out |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
    return out


class Encoder:
    """Ids of texts as arrays of 32-bit unsigned integers: those of ``Tokenizer.encode(text, add_special_tokens=False)``.

    Where the file is a plain byte-level BPE whose ids follow the ranks of its merges, tiktoken computes them from the
    same vocabulary, four times as fast; a text with the string of a special token, and any other file, goes through
    ``tokenizers``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._special = [t["content"] for t in spec.get("added_tokens") or []]
        self._fast = self._ranked(spec)

    def _ranked(self, spec: dict):
        try:
            import public_tokenizers
            import tiktoken
        except ImportError:
            return None
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
            return None
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        for n, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            if vocab.get(a + b) != 256 + n:
                return None
        chars = _byte_chars()
        ranks = {bytes(chars[c] for c in k): v for k, v in vocab.items() if k not in self._special}
        fast = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        sample = "It's 12 émue,\n\n  de_l'été -- naïve... \t ok 日本 🎉"
        return fast if fast.encode_ordinary(sample) == self._tokenizer.encode(sample, add_special_tokens=False).ids else None

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype="<u4")
        if self._fast is not None and not any(s in text for s in self._special):
            try:
                return np.asarray(self._fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
            except BaseException as e:  # its regex engine gives up on endless white space, with an exception of its own kind
                if type(e).__name__ != "PanicException":
                    raise
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, whatever number of tasks it runs."""
    return Encoder(path)
