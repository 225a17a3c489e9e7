"""Tokenizing whole texts with the tokenizers library, each distinct word once per worker.

Neither kind of vocabulary here joins anything across a blank, so a text's ids are those of its words in
turn. Words of letters go straight to the model, all others through the whole tokenizer. A Python
worker keeps the ids of the words that it saw, in two generations that are bounded in bytes.
"""

from __future__ import annotations

import os
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402

_TAIL = ".,!?;:*#$%&|"
#: Bytes of one generation of known words, with about ``ENTRY_BYTES`` besides the word and its ids for each.
KEEP_BYTES, ENTRY_BYTES = 48 << 20, 160
_encoders: dict[tuple[str, bool], "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 and up in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


class Encoder:
    """``encode(text)`` gives the ids of a whole text as an array.

    ``leading_blank``: the vocabulary's words include the blank before them (byte-level); otherwise
    letters are lowered and blanks dropped.
    """

    def __init__(self, path: str, leading_blank: bool, keep: int = KEEP_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.leading_blank = leading_blank
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.keep, self.held = keep, 0
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        self.code = "H" if self.dtype.itemsize == 2 else "I"

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _model(self, piece: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _fill(self, items: set[str]) -> None:
        """Put the ids of new words into the cache. A word stands for itself after a blank; after a line break it starts with one."""
        new, old, blank = self.new, self.old, self.letters[32] if self.leading_blank else ""
        rest = []
        for item in items:
            known = old.get(item)
            if known is None:
                core = item.rstrip(_TAIL)
                tail = item[len(core) :]
                known = (new.get(core) or old.get(core)) if tail and core else None
                if known is None:
                    word, after_break = (core[1:], True) if self.leading_blank and core[:1] == "\n" else (core, False)
                    if word.isascii() and word.isalpha():
                        piece = word if self.leading_blank else word.lower()
                    elif word.isalpha() and max(word) <= "\xff":
                        piece = (word if self.leading_blank else word.lower()).encode().decode("latin-1").translate(self.letters)
                    else:
                        rest.append(item)
                        continue
                    known = self._part("\n") + self._model(piece) if after_break else self._model(blank + piece)
                    if tail:
                        new[core] = known
                if tail:
                    known += self._part(tail)
            new[item] = known
        if rest:
            texts = [x if not self.leading_blank or x[0] == "\n" else " " + x for x in rest]
            new.update(zip(rest, self._whole(texts), strict=True))

    def _part(self, text: str) -> bytes:
        """A line break or a run of punctuation by itself."""
        key = "\0" + text
        if key not in self.new:
            self.new[key] = self._whole([text])[0]
        return self.new[key]

    def _joined(self, items: list[str]) -> bytes:
        try:
            return b"".join(map(self.new.__getitem__, items))
        except KeyError:
            if self.held > self.keep:
                self.old, self.new, self.held = self.new, {"": b""}, 0
            missing = set(items).difference(self.new)
            self._fill(missing)
            self.held += sum(len(m) + len(self.new[m]) + ENTRY_BYTES for m in missing)
            return b"".join(map(self.new.__getitem__, items))

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=self.dtype)
        if not self.leading_blank:
            ids = self._joined(text.replace("\n", " ").split(" "))
        elif len(text.split()) != text.count(" ") + text.count("\n") + 1:
            ids = self._whole([text])[0]  # runs of blanks, or blanks at an end, belong together
        else:
            first, *items = text.replace("\n", " \n").split(" ")
            ids = self._whole([first])[0] + self._joined(items)
        return np.frombuffer(ids, dtype=self.dtype)


def encoder(path: str, leading_blank: bool) -> Encoder:
    """This worker's encoder of a vocabulary file."""
    key = (path, leading_blank)
    if key not in _encoders:
        _encoders[key] = Encoder(path, leading_blank)
    return _encoders[key]
