"""Ids of a public byte-level BPE file, encoded by the ``tiktoken`` library.

``tokenizers`` gives the same ids for the same file, at a fifth of the speed on one
core; the tests hold the two against each other.
"""

import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np


def byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


#: Fixed value: the pattern that byte-level BPE splits a text with before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The library's matcher keeps a state per character of white space and gives up at about a
#: million; runs from this length on are cut out by the pattern's own rule.
LONG_SPACE = 100_000
#: White space as the pattern understands it (Unicode's White_Space).
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """The entries of a byte-level BPE file by their bytes, and its special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    to_byte = byte_of_char()
    return {bytes(map(to_byte.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}, special


@lru_cache(maxsize=2)
def byte_encoding(path: str, with_special: bool = True) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids (uint32), without added special ids; the strings
    of special tokens inside a text become their ids, or with ``with_special=False`` are text
    as any other. Kept per Python worker."""
    import tiktoken

    ranks, special = vocabulary(path)
    special = special if with_special else {}
    encoding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        return encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    def encode_any(text: str) -> np.ndarray:
        if len(text) < LONG_SPACE:
            return encode(text)
        parts, begun = [], 0
        for run in SPACES.finditer(text):
            # white space is one piece up to the end of a part; else its last character goes with what follows
            last = run.end() == len(text) or any(text.startswith(s, run.end()) for s in special)
            cut = run.end() if last else run.end() - 1
            parts.append(encode(text[begun : run.start()]))
            parts.append(np.array(encoding._encode_single_piece(text[run.start() : cut]), np.uint32))
            begun = cut
        return np.concatenate([*parts, encode(text[begun:])])

    return encode_any
