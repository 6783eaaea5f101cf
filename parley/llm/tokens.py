"""Token ids of a public byte-level vocabulary, read from its file.

``load`` gives the faster of two libraries for the same vocabulary; texts with characters on which
their Unicode tables could differ go through the other one, so ids are always those of the file.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import cache

from tokenizers import Tokenizer

#: Letters, digits and signs that every Unicode version classifies alike.
_PLAIN = re.compile(r"[\t-\r -~¡-ɏ‐-‧€]*")


def _bytes_by_sign() -> dict[str, int]:
    """The public rule that writes every byte as one printable sign."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def load(path: str) -> Callable[[str], list[int]]:
    """A function from a text to its token ids, without special tokens around it."""
    import public_tokenizers
    import tiktoken

    exact = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    sign = _bytes_by_sign()
    ranks = {
        bytes(sign[c] for c in token): rank
        for token, rank in data["model"]["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def encode(text: str) -> list[int]:
        if _PLAIN.fullmatch(text) and not any(s in text for s in special):
            return fast.encode_ordinary(text)
        return exact.encode(text, add_special_tokens=False).ids

    return encode


def default_path() -> str:
    """The file of the production vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
