"""Whole-text tokenisation in Arrow batches with a per-worker cache of words.

A text is cut before a space or newline that stands between two characters
that are no white space, and before a stop mark after an ASCII letter.  No token of the two supported kinds of tokenizer
(byte-level BPE whose words take one leading space, and word BPE that drops
white space) spans such a place, so encoding the pieces one by one gives the
ids of the whole text, and each distinct piece is encoded only once.  A text
that holds a tokenizer's added token (such as an end mark), in any case of its
letters, is encoded whole, as the library does it.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa

#: Marks that never share a token with a letter before them.
STOPS = np.isin(np.arange(256), np.frombuffer(b",.;:!?|", np.uint8))
#: Bytes of which no white space is part: printable ASCII; first bytes of two-byte letters and marks; ASCII letters.
PLAIN = (np.arange(256) > 0x20) & (np.arange(256) < 0x7F)
LEAD = (np.arange(256) >= 0xC3) & (np.arange(256) <= 0xDF)
LETTER = (np.arange(256) | 0x20 >= 0x61) & (np.arange(256) | 0x20 <= 0x7A)
GAP = np.isin(np.arange(256), [0x20, 0x0A])

_loaded: dict[str, Encoder] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


class Encoder:
    """Ids of many texts at once, as ``Tokenizer.encode`` without special tokens around the text gives them."""

    #: Pieces kept at most; a full cache starts anew.
    CACHED = 600_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.added = sorted({t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content})
        self.shared = os.path.commonprefix(self.added)
        self.folds = [x.ids for x in self.tokenizer.encode_batch(["a b", "A\nB"], add_special_tokens=False)] == [
            self.tokenizer.encode("a b", add_special_tokens=False).ids] * 2

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        known = self.known
        out = list(map(known.get, pieces))
        new = [i for i, x in enumerate(out) if x is None]
        if len(known) + len(new) > self.CACHED:
            known.clear()
        for at in range(0, len(new), 20_000):
            part = new[at: at + 20_000]
            found = self.tokenizer.encode_batch_fast([pieces[i].decode() for i in part], add_special_tokens=False)
            for i, e in zip(part, found, strict=True):
                out[i] = known[pieces[i]] = array("I", e.ids).tobytes()
        return out

    def _with_added(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """Texts that hold an added token, in any case of its letters."""
        low = data.tobytes().lower()
        if not self.added or low.find(self.shared) < 0:
            return []
        found = set()
        for token in self.added:
            at = low.find(token)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, side="right")) - 1
                found.add(i)  # also if it runs on into the next text: that text is then encoded whole for nothing
                at = low.find(token, max(at + 1, int(offsets[i + 1]) - len(token) + 1))
        return sorted(found)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, borders): the ids of all texts back to back as uint32 and the n + 1 borders between texts."""
        whole = self._with_added(data, offsets)
        if not whole:
            return self._encode_pieces(data, offsets)
        ids, sizes, first = [], [], 0
        for i in [*whole, len(offsets) - 1]:
            some, borders = self._encode_pieces(data[offsets[first]: offsets[i]], offsets[first: i + 1] - offsets[first])
            ids.append(some)
            sizes.append(np.diff(borders))
            if i < len(offsets) - 1:
                one = self.tokenizer.encode(data[offsets[i]: offsets[i + 1]].tobytes().decode(), add_special_tokens=False).ids
                ids.append(np.array(one, "<u4"))
                sizes.append(np.array([len(one)]))
            first = i + 1
        return np.concatenate(ids), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int64)

    def _encode_pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.folds:  # the tokenizer drops case and white space itself; equal words then share one piece
            data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, np.where(data == 0x0A, 0x20, data)).astype(np.uint8)
        borders = np.concatenate((cuts(data), offsets))
        borders.sort(kind="stable")
        borders = borders[np.concatenate(([True], borders[1:] != borders[:-1]))]
        if len(borders) < 2:
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        ids = self._ids(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        start = np.cumsum(size) - size
        which = coded.indices.to_numpy()
        lengths = size[which]
        ends = np.cumsum(lengths)
        out = flat[np.repeat(start[which] - (ends - lengths), lengths) + np.arange(ends[-1])]
        at = np.concatenate(([0], ends))
        return out, at[np.searchsorted(borders, offsets)]


def cuts(data: np.ndarray) -> np.ndarray:
    """Places of a space or newline between characters that are certainly no white space, or of a stop mark after a letter."""
    if len(data) < 3:
        return np.empty(0, np.int64)
    plain, lead = PLAIN[data], LEAD[data]
    ends = plain.copy()
    ends[1:] |= lead[:-1]
    starts = plain | lead
    after_letter = STOPS[data[1:-1]] & LETTER[data[:-2]]
    return np.flatnonzero((GAP[data[1:-1]] & ends[:-2] & starts[2:]) | after_letter) + 1


def with_end(ids: np.ndarray, borders: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' ids with ``end`` after each."""
    n = len(borders) - 1
    out = np.insert(ids, borders[1:], np.uint32(end)) if n else ids
    return out, borders + np.arange(n + 1)
