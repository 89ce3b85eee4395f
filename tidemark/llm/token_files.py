"""Public tokenizer files, read on the driver and sent to tasks as broadcasts of a few MB.

`ByteLevel` gives the ids that the tokenizers library gives for a byte-level BPE file without
normaliser, without inserting special tokens. Such files number their merges in order, so an
id is a rank and the tiktoken library finds the same ids several times faster; the tests hold
both against each other over all characters. A text on which its pattern engine gives up (very
long runs of white space) is encoded by tree reduction instead.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import sentencepiece
import tiktoken

from tidemark.llm.byte_bpe import Vocabulary

#: How byte-level files cut a text before merging; fixed by that format.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: printable ones themselves, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class ByteLevelFile:
    """What a byte-level tokenizer file holds."""

    ranks: dict[bytes, int]
    specials: dict[str, int]
    name: str


def read_byte_level(path: str) -> ByteLevelFile:
    """A tokenizers file of a byte-level BPE whose merges are numbered in order."""
    with open(path, "rb") as file:
        data = file.read()
    parts = json.loads(data)
    model, cut = parts["model"], parts["pre_tokenizer"]
    plain = parts["normalizer"] is None and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
    specials = {t["content"]: t["id"] for t in parts["added_tokens"]}
    byte_of = _byte_of()
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in specials}
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if model["type"] != "BPE" or not plain or made != sorted(set(made)):
        raise ValueError(f"{path} is no byte-level BPE with merges in the order of their ids")
    return ByteLevelFile(ranks, specials, hashlib.sha256(data).hexdigest())


class ByteLevel:
    """Ids and token bytes of one byte-level file."""

    def __init__(self, file: ByteLevelFile):
        self.file = file
        self.size = 1 + max(*file.ranks.values(), *file.specials.values(), 0)
        self._fast = tiktoken.Encoding(file.name, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=file.ranks, special_tokens=file.specials)
        self._specials = re.compile("|".join(map(re.escape, sorted(file.specials, key=len, reverse=True))) or r"(?!)")

    @cached_property
    def _slow(self) -> Vocabulary:
        return Vocabulary(self.file.ranks, BYTE_LEVEL_PATTERN)

    @cached_property
    def bytes_of(self) -> list[bytes]:
        """The bytes of each id."""
        found = [b""] * self.size
        for token, i in self.file.ranks.items():
            found[i] = token
        for token, i in self.file.specials.items():
            found[i] = token.encode("utf-8")
        return found

    def encode(self, text: str, specials: bool) -> np.ndarray:
        """Ids as uint32; with `specials` the special tokens' strings in the text are those tokens, else plain text."""
        try:
            return self._fast.encode_to_numpy(text, allowed_special="all" if specials else set(), disallowed_special=())
        except ValueError:
            return np.array(self._encode_long(text, specials), np.uint32)

    def _encode_long(self, text: str, specials: bool) -> list[int]:
        ids: list[int] = []
        done = 0
        for found in self._specials.finditer(text) if specials else ():
            ids += self._slow.encode(text[done : found.start()])
            ids.append(self.file.specials[found[0]])
            done = found.end()
        return ids + self._slow.encode(text[done:])


@dataclass
class PieceFile:
    """The bytes of a sentencepiece model."""

    model: bytes
    name: str


def read_pieces(path: str) -> PieceFile:
    with open(path, "rb") as file:
        model = file.read()
    return PieceFile(model, hashlib.sha256(model).hexdigest())


class Pieces:
    """Ids and token bytes of one sentencepiece model with byte fallback."""

    def __init__(self, file: PieceFile):
        self._model = sentencepiece.SentencePieceProcessor(model_proto=file.model)
        self.size = self._model.get_piece_size()

    @cached_property
    def bytes_of(self) -> list[bytes]:
        """The bytes of each id: a byte piece is its byte, U+2581 a space."""
        model = self._model
        names = [model.id_to_piece(i) for i in range(self.size)]
        return [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode("utf-8") for i, n in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


_loaded: dict[str, ByteLevel | Pieces] = {}


def loaded(file: ByteLevelFile | PieceFile) -> ByteLevel | Pieces:
    """The tokenizer of a file, kept by the worker; names are digests of the files."""
    if file.name not in _loaded:
        if len(_loaded) >= 4:
            _loaded.clear()
        _loaded[file.name] = ByteLevel(file) if isinstance(file, ByteLevelFile) else Pieces(file)
    return _loaded[file.name]
