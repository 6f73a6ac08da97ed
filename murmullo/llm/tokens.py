"""Token ids of whole texts from the tokenizers library, word by word.

A text is cut where white space begins after something else. No token of the two
supported kinds reaches across such a cut, so the ids of the pieces, one
after the other, are the ids of the text. A batch encodes each piece once, and
a worker keeps the pieces it has met, up to ``_REMEMBERED``. Texts for which
the cut is not certain are encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_REMEMBERED = 400_000
_SPACE = " \t\n\r\f\v"
# White space of other kinds, which the patterns of the library know and the cut does not.
_OTHER_SPACE = re.compile(
    "[\x1c-\x1f\x85\xa0  -     　]"
)
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# A piece of letters and signs without apostrophes, digits or markers: every run
# of letters and every run of signs is a word of the model.
_SIMPLE = re.compile(f"(?:[{_LETTERS}]+|[!-&(-/:-;=?@\\[-`{{}}~]+)+")
_RUN = re.compile(f"[{_LETTERS}]+|[^{_LETTERS}]+")


def _byte_letters() -> dict[int, str]:
    """How the byte-level models write a byte: as itself where it is printable,
    else as the next letter from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {}, 256
    for b in range(256):
        if b in shown:
            table[b] = chr(b)
        else:
            table[b], extra = chr(extra), extra + 1
    return table


class Remembered:
    """What was found for the last strings asked for: twice ``most`` at the most."""

    def __init__(self, most: int = _REMEMBERED):
        self.most, self.new, self.old = most, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Encoder:
    """Ids for many texts at once; one per worker and tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # Spaces vanish and case is folded, or both stay in the tokens.
        self.folds = '"Lowercase"' in json.dumps([spec["normalizer"], spec["pre_tokenizer"]])
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.code, self.dtype = ("H", np.uint16) if small else ("I", np.uint32)
        self.letters = _byte_letters()
        # Runs of letters, and pieces of several; a run that is a piece has the same ids.
        self.known = Remembered()

    def _run(self, run: str) -> bytes:
        ids = self.known.get(run)
        if ids is None:
            word = run if run.isalpha() and run.isascii() else (
                run.encode().decode("latin-1").translate(self.letters))
            ids = array(self.code, [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()
            self.known.put(run, ids)
        return ids

    def whole(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that go to the library as they are."""
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _simple(self, piece: str) -> bytes | None:
        """The ids of a piece of plain words and signs; None for any other."""
        body = piece[1:] if piece[0] == " " else piece
        space = " " if not self.folds and len(body) < len(piece) else ""
        # Most pieces are one word, or a word and one sign.
        if body.isascii() and body.isalpha():
            return self._run(space + (body.lower() if self.folds else body))
        word = body[:-1]
        if word.isascii() and word.isalpha() and body[-1] in ".,":
            return self._run(space + (word.lower() if self.folds else word)) + self._run(body[-1])
        if _SIMPLE.fullmatch(body) is None:
            return None
        runs = _RUN.findall(body.lower() if self.folds else body)
        runs[0] = space + runs[0]
        ids = b"".join([self._run(r) for r in runs])
        self.known.put(piece, ids)
        return ids

    def _pieces_ids(self, pieces: list[str]) -> list[bytes]:
        get, simple = self.known.get, self._simple
        ids = [get(p) if p else b"" for p in pieces]
        hard = []
        for i in [i for i, found in enumerate(ids) if found is None]:
            ids[i] = simple(pieces[i])
            if ids[i] is None:
                hard.append(i)
        for start in range(0, len(hard), 4096):
            part = hard[start:start + 4096]
            for i, found in zip(part, self.whole([pieces[i] for i in part])):
                ids[i] = found
                self.known.put(pieces[i], found)
        return ids

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, pa.Array]:
        """Pieces per text, and all pieces."""
        if not self.folds:
            found = [_PIECE.findall(t) for t in texts]
            return (np.fromiter(map(len, found), np.int64, len(found)),
                    pa.array(list(chain.from_iterable(found)), pa.string()))
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        return pc.list_value_length(cut).to_numpy(zero_copy_only=False), cut.flatten()

    def encode(self, texts: list[str]) -> tuple[bytes, np.ndarray]:
        """The ids of all texts in a row, as ``dtype``, and how many each text has."""
        odd = [i for i, t in enumerate(texts) if _OTHER_SPACE.search(t)]
        plain = list(texts)
        for i in odd:
            plain[i] = ""
        sizes, pieces = self._pieces(plain)
        coded = pieces.dictionary_encode()
        ids = self._pieces_ids(coded.dictionary.to_pylist())
        which = coded.indices.to_numpy(zero_copy_only=False)
        out = b"".join(map(ids.__getitem__, which.tolist()))
        width = np.dtype(self.dtype).itemsize
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        ends = np.concatenate(([0], np.cumsum(lengths[which]) if len(ids) else []))
        bounds = ends[np.concatenate(([0], np.cumsum(sizes)))].astype(np.int64)
        counts = np.diff(bounds)
        if odd:
            parts = [out[a * width:b * width] for a, b in zip(bounds[:-1], bounds[1:])]
            for i, found in zip(odd, self.whole([texts[i] for i in odd])):
                parts[i] = found
            counts = np.fromiter(map(len, parts), np.int64, len(parts)) // width
            out = b"".join(parts)
        return out, counts


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file that the worker can read."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
