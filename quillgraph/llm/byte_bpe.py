"""Byte-level BPE ids from a public tokenizer file."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import tiktoken


def default_path() -> str:
    """The installed vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_pattern() -> str:
    """The pattern that splits a text before merging."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself where printable, else one from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoder of a ``tokenizers`` file whose ids are in the order of its merges."""
    with open(path, encoding="utf-8") as source:
        spec = json.load(source)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def encode(encoder: tiktoken.Encoding, text: str | None) -> np.ndarray:
    """The ids of a text as ``tokenizers`` gives them without special tokens added; null counts as empty."""
    return encoder.encode_to_numpy(text or "", allowed_special="all")
