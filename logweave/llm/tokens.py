"""Token ids of texts by a byte-level BPE vocabulary file.

The ids are those of the ``tokenizers`` library.  Texts made only of characters below U+0250, without
the vocabulary's special strings and without a very long word, go through ``tiktoken`` with the same
vocabulary and pattern, which gives the same ids several times faster; all others go through
``tokenizers`` itself."""

from __future__ import annotations

import json
import re

import numpy as np

# Fixed value: the pattern that byte-level BPE cuts texts by before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_WORD = 1000
_rare = re.compile("[^\x00-ɏ]")
_long = re.compile(r"\S{%d}" % LONG_WORD)
_made: dict[str, "Encoder"] = {}


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for
    themselves, the others in order for the characters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.fast = None
        if (spec["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                and not pre.get("add_prefix_space") and not spec.get("normalizer") and not spec.get("post_processor")):
            letters = byte_letters()
            ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
            self.fast = tiktoken.Encoding("ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if (self.fast is not None and (text.isascii() or not _rare.search(text))
                and not (self.special and self.special.search(text)) and not (len(text) >= LONG_WORD and _long.search(text))):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    if path not in _made:
        _made[path] = Encoder(path)
    return _made[path]
