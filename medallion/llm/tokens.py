"""Token ids by a public tokenizer's vocabulary file."""

from __future__ import annotations

import json
import os
import re

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

DEFAULT = "byte_bpe_50k.json"
# Beyond Latin letters, two libraries' Unicode tables may sort a new character differently.
BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def path(name: str = DEFAULT) -> str:
    return public_tokenizers.path(name)


def byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones for
    themselves, the others, in order, for the characters from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """``tokenizers`` ids, no special tokens added.

    A special token's string inside a text becomes that token, as the library has it by
    default; with ``plain`` it is ordinary text.  For a plain byte-level BPE file, Latin
    texts go through ``tiktoken`` over the ranks of the same file, which gives the same ids
    several times faster (a test holds them against each other).  All other texts and files
    go through ``tokenizers``, as do texts with such a string unless ``plain``.
    """

    def __init__(self, file: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.exact = Tokenizer.from_file(file)
        self.exact.encode_special_tokens = plain
        self.fast, self.marks = None, ()
        with open(file, encoding="utf-8") as source:
            spec = json.load(source)
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        byte_level = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        if model.get("type") == "BPE" and byte_level and not spec.get("normalizer") and not model.get("dropout"):
            table, added = byte_of(), {t["content"] for t in spec.get("added_tokens", [])}
            self.marks = () if plain else tuple(sorted(added))
            ranks = {bytes(table[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and not BEYOND_LATIN.search(text) and not any(m in text for m in self.marks):
            return self.fast.encode_ordinary(text)
        return self.exact.encode_batch_fast([text], add_special_tokens=False)[0].ids


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(file: str, plain: bool = False) -> Encoder:
    """One per worker process."""
    if (file, plain) not in _encoders:
        _encoders[file, plain] = Encoder(file, plain)
    return _encoders[file, plain]
