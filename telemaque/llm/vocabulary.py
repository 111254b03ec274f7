"""Vocabulary files of public tokenizers, loaded once per worker; their paths are parameters."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cache

#: How many bytes the byte-level alphabet writes as themselves; the others follow from 256 on. Fixed values.
PRINTABLE = (range(33, 127), range(161, 173), range(174, 256))
#: The split of a text before merging, as the byte-level pre-tokenizer has it. Fixed value.
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [b for r in PRINTABLE for b in r]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


@cache
def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@cache
def byte_encoder(path: str) -> Callable[[str], list[int]]:
    """Text to ids for a byte-level vocabulary in .json, special strings in texts as the library has them.

    Where ids follow the order of the merges and nothing but the common split comes before them, the
    same merging by rank is several times as fast in the library for rank files; it is used then.
    """
    file = load(path)
    vocab, merges = file["model"]["vocab"], file["model"]["merges"]
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    plain = (
        file["normalizer"] is None
        and file["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in file["added_tokens"])
        and len(vocab) == 256 + len(pairs)
        and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))
    )
    if plain:
        import tiktoken

        letter = {c: b for b, c in byte_letters().items()}
        ranks = {bytes(letter[c] for c in token): i for token, i in vocab.items()}
        encoding = tiktoken.Encoding("from_json", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> list[int]:
            try:
                return encoding.encode(text, allowed_special="all")
            except ValueError:  # its split has a limit, which very long runs of blanks meet
                return tokenizer(path).encode(text, add_special_tokens=False).ids

        return encode
    return lambda text: tokenizer(path).encode(text, add_special_tokens=False).ids


@cache
def tokenizer(path: str):
    """The vocabulary as its own library loads it."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)
