"""Byte-level BPE as the tokenizers library does it, for one tokenizer file.

Files whose merges are in the order of their ids (checked when read) are encoded by tiktoken, which gives the
same ids several times as fast; all others by the tokenizers library itself.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import regex
import tiktoken
import tokenizers

#: The pattern of the byte-level pre-tokenizer (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the files: printable bytes are their own, others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        added = spec.get("added_tokens") or []
        vocab = spec["model"]["vocab"]
        #: One more than the greatest id.
        self.size = 1 + max([*(vocab.values() if isinstance(vocab, dict) else range(len(vocab))), *(t["id"] for t in added)])
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in added}
        self.fast: tiktoken.Encoding | None = None
        #: Bytes of each id.
        self.pieces: list[bytes] = []
        if self._is_plain(spec, added):
            letters = byte_letters()
            own = {bytes(letters[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()}
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own, special_tokens={})
            self.pieces = [b""] * self.size
            for piece, i in own.items():
                self.pieces[i] = piece
            for text, i in self.specials.items():
                self.pieces[i] = text.encode()
            longest_first = sorted(self.specials, key=len, reverse=True)
            self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

    @functools.cached_property
    def library(self) -> tokenizers.Tokenizer:
        """The library's own tokenizer; not loaded where tiktoken does the work."""
        tokenizer = tokenizers.Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def _is_plain(self, spec: dict, added: list[dict]) -> bool:
        """Byte-level BPE without any option, whose merge order is the order of the ids."""
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel":
            return False
        if pre.get("add_prefix_space") or not pre.get("use_regex", True):
            return False
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
        if any(model.get(k) for k in options):
            return False
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            return False
        vocab, letters = model["vocab"], byte_letters()
        if sorted(vocab.get(c, -1) for c in letters) != list(range(256)) or len(vocab) - sum(s in vocab for s in self.specials) != 256 + len(model["merges"]):
            return False
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        return all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))

    def segments(self, text: str) -> list[str]:
        """Ordinary text and special strings in turn (odd places are special)."""
        if self.special is None or not any(s in text for s in self.specials):
            return [text]
        return self.special.split(text)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, without added ids; special strings in it are their ids."""
        if self.fast is None:
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        parts = self.segments(text)
        if len(parts) == 1:
            return self.ordinary(text)
        ids = [np.asarray([self.specials[p]], np.uint32) if i % 2 else self.ordinary(p) for i, p in enumerate(parts) if p]
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32)

    def ordinary(self, text: str) -> np.ndarray:
        """The ids of a text without special strings."""
        return self.fast.encode_to_numpy(text, disallowed_special=())

    def decode(self, ids: np.ndarray) -> str:
        if self.fast is None:
            return self.library.decode(ids.tolist(), skip_special_tokens=False)
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """The codec of a file, read once per worker."""
    return Codec(path)


@functools.lru_cache(maxsize=1)
def pre_tokens() -> regex.Pattern:
    return regex.compile(PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))


@functools.lru_cache(maxsize=1)
def white_space() -> frozenset[str]:
    """The characters that the pattern's \\s stands for."""
    return frozenset(regex.findall(r"\p{White_Space}", "".join(map(chr, range(0x3001)))))
