"""Token ids of a byte-level BPE vocabulary file, as the `tokenizers` library gives them.

The ids come from `tiktoken` over the same vocabulary and split pattern, which is about four times as fast. Texts
with a very long run without white space go to `tokenizers` itself, whose merge loop does not slow down on them.
Both give the same ids (tests compare them).
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np

# Fixed by the vocabulary: how byte-level BPE splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = re.compile(r"\S{1000}")
LONG_SPACE = re.compile(r"\s{1000}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable character: itself where printable, else from 256 upwards."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        byte_of = _byte_of_char()
        self.pieces = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
        ranks = {b: i for i, b in self.pieces.items()}
        self.fast = tiktoken.Encoding("corpus", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        self.exact = Tokenizer.from_file(path)
        self.pieces |= {i: t.encode() for t, i in special.items()}
        #: bytes of text per id
        self.widths = np.zeros(max(self.pieces) + 1, np.int64)
        self.widths[list(self.pieces)] = list(map(len, self.pieces.values()))

    def ids(self, text: str) -> np.ndarray:
        if LONG_RUN.search(text) or LONG_SPACE.search(text):
            return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    def text(self, ids) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    return Encoder(path)
