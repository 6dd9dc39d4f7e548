"""Token ids of whole texts under the word-end BPE vocabulary, every distinct word of a chunk encoded once.

The tokenizer drops white space and never merges across it, so the ids of a text are the ids of its
white-space-separated words in a row.  A word of Latin letters with trailing marks is one lower-cased run of letters
and one run of marks; distinct runs go to the tokenizer's model together.  Every other distinct word goes through the
whole tokenizer.  Arrow splits the texts and finds
the distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from txrisk.llm.common import slices_by_bytes

#: Bytes of text worked on at once (more only if one text is longer), and words whose ids are joined at once.
CHUNK = 4 << 20
JOINED = 1 << 16

#: Composed Latin letters with one lower-case letter each, and marks that are no letters, digits or apostrophes.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = ".,:;!?|#$%&*-"

#: Runs handed to the model in one text, and runs that a worker keeps from chunk to chunk (then it starts anew).
RUNS = 10_000
SEEN = 200_000

#: Characters by which byte-level vocabularies write each byte: printable ones stand for themselves, the rest follow 256.
_SELF = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SPELL = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _SELF)}

_LOADED: dict[tuple[str, bool], "WordBpe"] = {}


class WordBpe:
    def __init__(self, path: str, special_as_text: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model_only = Tokenizer(self.tokenizer.model)
        self.model_only.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.seen: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        """Ids of all texts in a row (little-endian uint32), and where each text's ids begin (texts + 1 places).

        Null is empty.
        """
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = words.flatten().dictionary_encode()
        of_word = self._words(coded.dictionary)
        index = coded.indices.to_numpy(zero_copy_only=False)
        sizes = np.array([len(x) >> 2 for x in of_word], np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[index])])
        ids = b"".join(b"".join(map(of_word.__getitem__, index[at: at + JOINED].tolist())) for at in range(0, len(index), JOINED))
        return ids, ends[words.offsets.to_numpy() - words.offsets[0].as_py()]

    def _words(self, words: pa.Array) -> list[bytes]:
        """Ids of distinct words."""
        plain = pc.match_substring_regex(words, f"^[{LETTERS}]+[{MARKS}]*$").to_numpy(zero_copy_only=False)
        known = words.filter(pa.array(plain))
        cores = pc.utf8_lower(pc.ascii_rtrim(known, characters=MARKS)).dictionary_encode()
        tails = pc.replace_substring_regex(known, f"^[{LETTERS}]+", "").dictionary_encode()
        of_core, of_tail = self._runs(cores.dictionary.to_pylist()), self._runs(tails.dictionary.to_pylist())
        joined = iter([of_core[c] + of_tail[t] for c, t in zip(cores.indices.to_pylist(), tails.indices.to_pylist())])
        rest = iter(words.filter(pa.array(~plain)).cast(pa.large_binary()).to_pylist())
        return [next(joined) if p else self._any(next(rest)) for p in plain.tolist()]

    def _any(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _runs(self, runs: list[str]) -> list[bytes]:
        """Ids of runs that the tokenizer keeps whole (letters or marks); '' has none."""
        new = [r for r in runs if r and r not in self.seen]
        if len(self.seen) + len(new) > SEEN:
            self.seen.clear()
            new = [r for r in runs if r]
        for at in range(0, len(new), RUNS):
            part = new[at: at + RUNS]
            text = " ".join(r if r.isascii() else r.encode().decode("latin-1").translate(_SPELL) for r in part)
            ids = np.array(self.model_only.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.is_end[ids]) + 1) * 4
            assert len(ends) == len(part), "a run must end in exactly one word-end token"
            data = ids.tobytes()
            self.seen.update(zip(part, (data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist()))))
        return [self.seen[r] if r else b"" for r in runs]


def load(path: str, special_as_text: bool = False) -> WordBpe:
    """The worker's tokenizer for a vocabulary file."""
    key = (path, special_as_text)
    if key not in _LOADED:
        _LOADED[key] = WordBpe(path, special_as_text)
    return _LOADED[key]


def chunks(batches: Iterator[pa.RecordBatch], text_at: int, least: int = CHUNK) -> Iterator[pa.Table]:
    """The batches joined and cut to tables of about ``least`` bytes of text, at most twice as many; a longer text stands alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices_by_bytes(batches, text_at, least):
        more = batch.column(text_at).nbytes
        if held and size + more > 2 * least:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
        held.append(batch)
        size += more
        if size >= least:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def single(column: pa.ChunkedArray) -> pa.Array:
    """A table's column as one array."""
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
