"""Public vocabulary files: where they are, and how tasks get at them.

A vocabulary is a small fixed file (1 to 2 MB) that lies on every machine, in
the installed package of public tokenizers; ``path`` may name another copy.
"""

from __future__ import annotations

import functools
import json


def vocabulary_path(name: str, path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def load_vocabulary(path: str) -> tuple[dict[str, int], list[tuple[str, str]], list[str]]:
    """Token ids, merges in order, and the strings of special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    return spec["model"]["vocab"], merges, [token["content"] for token in spec["added_tokens"]]


@functools.lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, to the byte.

    Printable Latin-1 characters stand for themselves; the other bytes take
    the code points from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def token_bytes(token: str) -> bytes:
    letters = byte_letters()
    return bytes(letters[letter] for letter in token)
