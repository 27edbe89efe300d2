"""Token ids of whole texts by the tokenizers library, with a cache of the pieces texts repeat.

Both public vocabularies used here cut a text at white space before they look for tokens, so the
ids of a text are those of its pieces in a row. A piece is encoded once per Python worker, whose
tasks share the pieces they know; a plain word goes straight to the vocabulary's model, any other
piece through the whole tokenizer.
"""

from __future__ import annotations

import functools
import re
import struct

CACHED_PIECES = 800_000  # a worker forgets its pieces beyond that many

# Letters whose lower case and normal form are simple, and marks that no special token holds.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~"
_ENDS = frozenset(".,;:!?")
_PACKED = [struct.Struct(f"<{n}H").pack for n in range(32)]
_WORD = re.compile(f"([{_MARKS}]*)([{_LETTERS}]+)([{_MARKS}]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Texts to bytes of unsigned 16-bit ids (little-endian).

    ``spaced``: the vocabulary keeps white space, one space going to the word that follows;
    otherwise it drops white space and letter case.
    """

    def __init__(self, path: str, spaced: bool):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.model = self.tokenizer.model
        self.spaced = spaced
        self.letters = _byte_letters()
        self.cache: dict[str, bytes] = {}      # pieces after a space, or all pieces if white space is dropped
        self.bare: dict[str, bytes] = {}       # pieces that no space precedes, or parts of pieces

    def _whole(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _model(self, part: str) -> list[int]:
        if part.isascii():  # of these marks and letters only the space has another letter
            mapped = self.letters[32] + part[1:] if part[0] == " " else part
        else:
            mapped = part.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(mapped)]

    def _piece(self, text: str) -> bytes:
        space = text[:1] == " "
        if self.spaced and text.isascii():
            word = text[1:] if space else text
            if word.isalpha():  # a plain word
                ids = [t.id for t in self.model.tokenize(self.letters[32] + word if space else word)]
                return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else struct.pack(f"<{len(ids)}H", *ids)
            if word[-1:] in _ENDS and word[:-1].isalpha():  # one with a mark after it, which is a piece of its own
                return self.known(word[:-1], self.cache if space else self.bare, text[:1] if space else "") + self.known(word[-1], self.bare)
        found = _WORD.fullmatch(text, 1 if space else 0)
        if not found:
            if self.spaced and "\n" in text:
                return self._lines(text)
            return self._whole(text)
        parts = [p for p in found.groups() if p]
        if not self.spaced:
            return b"".join([self._part(p.lower()) for p in parts])
        parts[0] = text[:1] + parts[0] if space else parts[0]
        ids = [i for p in parts for i in self._model(p)]
        return struct.pack(f"<{len(ids)}H", *ids)

    def _part(self, part: str) -> bytes:
        """Letters or marks of a piece in lower case, which pieces share whatever their case and marks."""
        ids = self.bare.get(part)
        if ids is None:
            found = self._model(part)
            ids = struct.pack(f"<{len(found)}H", *found)
            if len(self.bare) >= CACHED_PIECES:
                self.bare.clear()
            if len(part) <= 64:
                self.bare[part] = ids
        return ids

    def _lines(self, text: str) -> bytes:
        """A piece with line ends between other characters: every line end is a token of its own."""
        lines = text.split("\n")
        inner = [x for i, x in enumerate(lines) for x in (x[:1] if i else "x", x[-1:] if i < len(lines) - 1 else "x")]
        if any(not c or c.isspace() for c in inner):
            return self._whole(text)
        first = self._piece(lines[0])
        rest = [self.known(x, self.bare) for x in lines[1:]]
        return self.known("\n", self.bare).join([first, *rest])

    def known(self, piece: str, cache: dict[str, bytes], lead: str = "") -> bytes:
        ids = cache.get(piece)
        if ids is None:
            ids = self._whole(piece) if piece == "\n" else self._piece(lead + piece)
            if len(cache) >= CACHED_PIECES:
                cache.clear()
            if len(piece) <= 64:
                cache[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not self.spaced:
            # Only white space of ASCII cuts here; the tokenizer itself sees to any other.
            cache = self.cache
            pieces = [p.decode() for p in text.encode().split()] if _ODD.search(text) else text.split()
            return b"".join([cache.get(p) or self.known(p, cache) for p in pieces])
        pieces = text.split(" ")
        # A cut before a space holds only between two other characters.
        if "  " in text or " " in (text[:1], text[-1:]) or any(
                " " in text[max(0, m.start() - 1):m.end() + 1] for m in _OTHER.finditer(text)):
            pieces = self._joined(pieces)
        cache = self.cache
        out = [self.known(pieces[0], self.bare)] if pieces[0] else []
        out += [cache.get(p) or self.known(p, cache, " ") for p in pieces[1:]]
        return b"".join(out)

    @staticmethod
    def _joined(pieces: list[str]) -> list[str]:
        """Pieces put together again wherever white space meets a space."""
        out, open_ = [], [pieces[0]]
        for left, right in zip(pieces, pieces[1:]):
            if left and right and not left[-1].isspace() and not right[0].isspace():
                out.append(" ".join(open_))
                open_ = []
            open_.append(right)
        return [*out, " ".join(open_)]


@functools.lru_cache(maxsize=1)
def encoder(path: str, spaced: bool) -> Encoder:
    """The encoder of this worker; the next task finds the vocabulary loaded and its pieces known."""
    return Encoder(path, spaced)


_ODD = re.compile(r"[^\S \t-\r]")  # white space that only str.split cuts at
_OTHER = re.compile(r"[^\S ]")  # white space but the space
