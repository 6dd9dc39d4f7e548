"""Token ids of whole texts under the byte-level BPE vocabulary, every distinct unit of a chunk encoded once.

The tokenizer cuts a text by a pattern before it merges, and never merges across those cuts.  A blank that is followed by
a character other than white space always begins a cut, whatever stands before it, and so does a line break there,
which is cut off on both sides; ``UNIT_START`` names the characters for which bytes alone tell that.  Units between such places are therefore
encoded on their own: numpy finds the places, Arrow the distinct units.  A run of Latin letters also ends where a mark
other than an apostrophe follows.  A unit that begins with a blank and has no other
begins with the only token that has one, so many of them go to the tokenizer as one text.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from txrisk.llm.common import utf8

#: Bytes that begin a character which is neither white space nor the first of a special token's name: printable
#: ASCII without ``<``, and the first bytes of U+00C0 to U+07FF.
UNIT_START = np.zeros(256, bool)
UNIT_START[0x21:0x7F] = True
UNIT_START[0xC3:0xE0] = True
UNIT_START[0x3C] = False

#: ASCII letters; marks that a run of letters never takes in (the bar stands inside a special token).
LETTER, MARK = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
MARK[[ord(c) for c in '!"#$%&()*+,-./:;=>?@[]_{}~']] = True

BLANK, BREAK = 0x20, 0x0A

#: The character by which the vocabulary writes a blank.
WRITTEN_BLANK = chr(256 + BLANK)

#: Units handed over in one text, and units that a worker keeps from chunk to chunk (then it starts anew).
TOGETHER, KEPT = 5_000, 800_000

_LOADED: dict[str, "ByteBpe"] = {}


class ByteBpe:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.begins = np.zeros(self.size, bool)
        self.begins[[i for t, i in vocabulary.items() if t.startswith(WRITTEN_BLANK)]] = True
        self._forget()

    def _forget(self) -> None:
        """Known units and their places in ``ids`` from ``starts`` on."""
        self.seen: dict[bytes, int] = {}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (texts + 1 places).  Null is empty."""
        data, offsets = utf8(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        begins = self._units(data, offsets)
        edges = np.append(begins, len(data))
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        coded = units.dictionary_encode()
        unit = self._places(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.starts[unit + 1] - self.starts[unit]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[unit] - ends[:-1], sizes)
        at += np.arange(len(at))
        return self.ids[at], ends[np.searchsorted(begins, offsets)]

    @staticmethod
    def _units(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where units begin: at a text's start, before a blank or break that a start character follows, after that break,
        and at a mark after a Latin letter."""
        begins = np.zeros(len(data), bool)
        follows = UNIT_START[data]
        begins[:-1] = ((data[:-1] == BLANK) | (data[:-1] == BREAK)) & follows[1:]
        # what ends one text is not followed by the next text's first character
        heads = offsets[:-1][offsets[:-1] < len(data)]
        begins[heads[heads > 0] - 1] = False
        begins[1:] |= (data[:-1] == BREAK) & begins[:-1]
        letter = LETTER[data]
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begins[1:] |= letter[:-1] & MARK[data[1:]]
        begins[heads] = True
        return np.flatnonzero(begins)

    def _places(self, units: pa.Array) -> np.ndarray:
        """Place of each distinct unit among the known ones; unknown ones are encoded and join them."""
        names = units.to_pylist()
        if len(self.seen) + len(names) > KEPT:
            self._forget()
        places = np.fromiter(map(self.seen.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(places < 0)
        if not len(new):
            return places
        single = pc.match_substring_regex(units.take(pa.array(new)), "^ [^ <]+$").to_numpy(zero_copy_only=False)
        order = np.concatenate([new[single], new[~single]])
        fresh = [names[i] for i in order.tolist()]
        count, parts, sizes = int(single.sum()), [], []
        for at in range(0, count, TOGETHER):
            part = fresh[at: min(at + TOGETHER, count)]
            ids = self._encoded([b"".join(part)])[0]
            ends = np.append(np.flatnonzero(self.begins[ids]), len(ids))
            assert len(ends) == len(part) + 1 and ends[0] == 0, "a unit must begin with the only token that has a blank"
            parts.append(ids)
            sizes.append(np.diff(ends))
        rest = self._encoded(fresh[count:])
        sizes.append(np.array([len(x) for x in rest], np.int64))
        known = len(self.starts) - 1
        self.ids = np.concatenate([self.ids, *parts, *rest])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])
        self.seen.update(zip(fresh, range(known, known + len(fresh))))
        places[order] = np.arange(known, known + len(fresh))
        return places

    def _encoded(self, texts: list[bytes]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(c.ids, np.uint32) for c in coded]


def load(path: str) -> ByteBpe:
    """The worker's tokenizer for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]
