"""Tokenising whole texts with a vocabulary file of the tokenizers library.

White space separates tokens in the word vocabulary and never joins them, so a text's ids are the
ids of its space-separated parts, one after another; a file that splits otherwise encodes whole texts. Each worker keeps the parts it has seen in a
bounded table; only new parts reach the tokenizer. A part outside plain Latin-1 letters, digits and
ASCII signs goes to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

#: Entries of a generation of a worker's tables of parts and of pieces.
KEPT_PARTS = 450_000
KEPT_PIECES = 150_000
#: Longer parts are not kept.
LONGEST_KEPT = 48

_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
#: The vocabulary's own split, on lower-case plain parts.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


#: How the word vocabulary's file normalises, splits and merges. Any other file is used on whole texts.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}


class _Kept(dict):
    """A bounded table in two generations: a full one becomes the old one, and what is still used moves up."""

    def __init__(self, most: int):
        self.old: dict[str, bytes] = {}
        self.most = most

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids


class _Pieces(_Kept):
    """Split piece of plain characters -> little-endian unsigned 32-bit ids, by the BPE model alone."""

    def __init__(self, tokenizer):
        super().__init__(KEPT_PIECES)
        from tokenizers.pre_tokenizers import ByteLevel

        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.mapped = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(33, 256) if _PLAIN.fullmatch(chr(c))}
        self.tokenize = tokenizer.model.tokenize
        self.data = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]

    def make(self, piece: str) -> bytes:
        text = piece if piece.isascii() else piece.translate(self.mapped)
        data = self.data
        return b"".join([data[t.id] for t in self.tokenize(text)])


class _Parts(_Kept):
    """Space-separated part -> ids; plain parts are put together from split pieces."""

    def __init__(self, tokenizer):
        super().__init__(KEPT_PARTS)
        self.tokenizer = tokenizer
        self.pieces = _Pieces(tokenizer)

    def make(self, part: str) -> bytes:
        if part.isascii() and part.isalpha():  # a piece by itself, kept here alone
            low = part.lower()
            ids = self.pieces.get(low)
            return self.pieces.make(low) if ids is None else ids
        if "<|" in part or not _PLAIN.fullmatch(part):
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
            return b"".join([i.to_bytes(4, "little") for i in ids])
        low = part.lower()
        if _LETTERS.fullmatch(low):
            return self.pieces[low]
        return b"".join(map(self.pieces.__getitem__, _SPLIT.findall(low)))


class TextEncoder:
    """Encodes texts as bytes of little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = _Parts(self.tokenizer)
        self.words = self._known()

    def _known(self) -> bool:
        """Whether the file normalises and splits text as the tables of parts and pieces assume."""
        config = json.loads(self.tokenizer.to_str())
        model = {k: config["model"].get(k) for k in MODEL}
        return (config["normalizer"], config["pre_tokenizer"], config["post_processor"], model) == (NORMALIZER, PRE_TOKENIZER, None, MODEL)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.words:
            import numpy as np

            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.parts.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder for each worker process and vocabulary."""
    return TextEncoder(path)


def default_vocabulary() -> str:
    """The public word vocabulary; its place comes from the installed package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
