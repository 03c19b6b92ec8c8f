"""Token ids of a byte-level BPE file of the tokenizers library.

The library spends most of its time on offsets that nobody asks for here. So texts are encoded by tiktoken with the
vocabulary, merges and special tokens of the same file, and the first text of every batch by tokenizers as well; a
difference stops the job.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: Fixed value: the pre-tokenizer pattern of byte-level BPE files with `use_regex`.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BpeCodec:
    """Little-endian unsigned 32-bit ids of texts, as `encode(text, add_special_tokens=False)` has them."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        first, added = spec["pre_tokenizer"], spec["added_tokens"]
        if first["type"] != "ByteLevel" or first["add_prefix_space"] or not first["use_regex"] or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE file")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens take in more than their own string")
        byte_of, vocabulary = _byte_of(), spec["model"]["vocab"]
        pairs = ("".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"])
        order = [vocabulary[p] for p in pairs]
        if order != sorted(order):
            raise ValueError("ids don't follow the order of merges")
        self.special = {t["content"]: t["id"] for t in added}
        ranks = {bytes(byte_of[c] for c in s): i for s, i in vocabulary.items() if s not in self.special}
        self.encoding = tiktoken.Encoding("from file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(path)
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def encode(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            return self.encoding.encode_to_numpy(text, disallowed_special=())
        out, at = [], 0
        for found in self._special.finditer(text):
            out += [*self.encoding.encode_ordinary(text[at : found.start()]), self.special[found[0]]]
            at = found.end()
        return np.array(out + self.encoding.encode_ordinary(text[at:]), np.uint32)

    def encode_batch(self, batch: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        out = [self.encode(t) for t in batch]
        if batch and out[0].tolist() != self.library.encode(batch[0], add_special_tokens=False).ids:
            raise ValueError(f"the tokenizers library has other ids for {batch[0][:100]!r}")
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> BpeCodec:
    """One codec for each worker process and vocabulary file."""
    return BpeCodec(path)
