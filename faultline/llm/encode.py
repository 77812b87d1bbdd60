"""Exact, fast use of a public tokenizer file: whole texts are cut where the tokenizer
itself always cuts, and the ids of the pieces are remembered, so each distinct piece is
encoded by the library once per worker while it stays in use."""
from __future__ import annotations

import os
import re
import struct

import numpy as np

CACHE_PIECES = 700_000
#: characters of the longest piece whose ids are remembered
KEPT_LENGTH = 64
_ODD_SPACE = re.compile(r"[^\S \n]")
#: Texts of these characters alone are cut between letters and other characters. Outside
#: them (an apostrophe can open a contraction, a numeral can be no digit) only white space cuts.
_PLAIN = re.compile(r"[\n\x20-\x26\x28-\x7e¡«»¿À-ɏ“”‘…–—€]*\Z")
_LETTERS = r"[^\W\d_]+"
_OTHERS = r"(?:[\d_]|[^\w \n])+"
_FINE = {True: re.compile(rf" ?{_LETTERS}| ?{_OTHERS}|[ \n]+(?![^ \n])|[ \n]"), False: re.compile(f"{_LETTERS}|{_OTHERS}")}
_COARSE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_STOPS = (",", ".")
#: a comma or full stop before white space that ends no word or number, so is part of a longer run
_ODD_STOP = re.compile(r"[,.](?=[ \n])(?<![^\W_].)")
#: byte -> the character that stands for it in the entries of a byte-level tokenizer
_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: b for b in _BYTES} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _BYTES)}


class _Known(dict):
    """piece -> its ids, found by ``find`` at the first use. At half of ``most`` pieces a new
    generation begins: pieces still in use are taken over, the others go with the generation
    after. Long pieces, which seldom come again, are not kept."""

    def __init__(self, find, most: int):
        super().__init__()
        self.find, self.most, self.old = find, most, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.find(piece)
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= self.most // 2:
                self.old = self.copy()
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes, equal to
    ``tokenizer.encode(text, add_special_tokens=False)``. Texts that hold the string of an
    added token (as <|endoftext|>) or white space other than blank and newline are encoded
    whole. ``keeps_space``: the tokenizer's pieces hold white space and case;
    else it drops both. ``most``: pieces that are remembered."""

    def __init__(self, path: str, keeps_space: bool, most: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.keeps_space = keeps_space
        self.known = _Known(self._find, most)
        # a run of letters is one unit for the library's model, unless this tokenizer treats them otherwise
        self._model = self.tokenizer.model.tokenize
        probes = ["the", "straße", "çàéñõþÿ", "qzxjkvw" * 9] + ([" The", " ÉaBcÐé", " iPhone"] if keeps_space else [])
        self._units = [self._unit(x) for x in probes] == [self._ids(x) for x in probes]

    def _unit(self, piece: str) -> bytes:
        """The ids of one run of letters, by the library's model alone: normalising and cutting,
        which cost more than the merges, have nothing to do on it."""
        shown = piece.replace(" ", "Ġ") if piece.isascii() else piece.encode().decode("latin-1").translate(_SHOWN)
        ids = [x.id for x in self._model(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _find(self, piece: str) -> bytes:
        """The ids of a piece not met so far; the parts of a plain one are looked up first."""
        if not _PLAIN.match(piece):
            return self._ids(piece)
        if not self.keeps_space:
            piece = piece.lower()
        if self._units and (piece[1:] if piece[:1] == " " else piece).isalpha():
            return self._unit(piece)
        if self._units and piece[-1:] in _STOPS and piece[:-1].strip(" ").isalpha():
            return self.known[piece[:-1]] + self.known[piece[-1]]
        parts = _FINE[self.keeps_space].findall(piece)
        return self._ids(piece) if len(parts) == 1 else b"".join(map(self.known.__getitem__, parts))

    def _pieces(self, text: str) -> list | None:
        if any(x in text for x in self.added):
            return None
        plain = _PLAIN.match(text)
        if not plain and _ODD_SPACE.search(text):
            return None
        if not self.keeps_space:
            return text.split()
        if "  " in text or "\n " in text or "\0" in text:
            return (_FINE[True] if plain else _COARSE).findall(text)
        cut = text.replace(" ", "\0 ")  # every blank opens a piece
        if not _ODD_STOP.search(text):
            cut = cut.replace(",\0", "\0,\0").replace(".\0", "\0.\0").replace(".\n", "\0.\0\n")
        return cut.split("\0")

    def encode(self, texts: list) -> list:
        get = self.known.__getitem__
        cut = map(self._pieces, texts)
        return [self._ids(x) if pieces is None else b"".join(map(get, pieces)) for x, pieces in zip(texts, cut)]


_ENCODERS: dict = {}


def encoder(path: str, keeps_space: bool, most: int = CACHE_PIECES) -> Encoder:
    """One encoder per Python worker and file."""
    if (path, keeps_space, most) not in _ENCODERS:
        _ENCODERS[path, keeps_space, most] = Encoder(path, keeps_space, most)
    return _ENCODERS[path, keeps_space, most]


def slices(sizes, most: int):
    """Runs of rows whose sizes add up to about ``most``."""
    start = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)
