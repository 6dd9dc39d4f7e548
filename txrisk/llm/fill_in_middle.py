"""Fill-in-the-middle documents: each text cut into prefix, middle and suffix, which change places between sentinels.

The units of a text are its runs of Latin letters and its other single characters.  Two cut points come from a hash of
the document's id, so a document is cut alike in every run, on every machine and whatever stands beside it.

Each Arrow batch goes through one chain of ``pyarrow.compute`` calls: the units become a list per text, the lists are
flattened with their parents' places, a unit's ordinal decides its role, the units of each role are filtered into lists
anew and joined, and the pieces are joined to the output.  Batches are cut by bytes before that, so memory follows the
longest text and not the number of rows.  Nothing is shuffled, and ``restored`` needs no Python.

Defined results: null text is empty and comes out plain with 0 units; a null id is hashed as an empty string; repeated
rows come out alike; an empty table gives no rows; other columns are not read.  A text that holds a sentinel stays plain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import slices_by_bytes

#: Sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Of a hundred documents, those that stay plain, and of the others those with the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20

UNIT = "([A-Za-z]+|[^A-Za-z])"

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers of 32 bits for a document: the first 8-digit groups of the hex sha256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _mark(texts: pa.Array) -> str:
    """A character that no text holds."""
    return next(c for c in map(chr, range(1, 0xD800)) if not pc.any(pc.match_substring(texts, c)).as_py())


def split_units(texts: pa.Array) -> pa.ListArray:
    """The units of each text after one empty string: a mark is set before every unit and the text split at the marks."""
    mark = _mark(texts)
    return pc.split_pattern(pc.replace_substring_regex(texts, UNIT, mark + r"\1"), mark)


def _modulo(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _joined(units: pa.Array, chosen: pa.Array, sizes: pa.Array) -> pa.Array:
    """The chosen units as one list a text, joined to one string."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.filter(units, chosen)), "")


def transform_batch(texts: pa.Array, h: list[pa.Array]) -> dict[str, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of every text; ``h`` are the columns of ``draws``."""
    lists = split_units(texts)
    n = pc.subtract(pc.cast(pc.list_value_length(lists), pa.int64()), 1)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    first = lists.offsets.slice(0, len(lists)).cast(pa.int64())
    ordinal = pc.subtract(pa.array(np.arange(len(units)) + lists.offsets[0].as_py()), pc.take(first, parent))
    ends = pc.add(n, 1)
    one, two = _modulo(h[0], ends), _modulo(h[1], ends)
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    # the empty string before a text's units has ordinal 0 and goes with the prefix
    in_prefix = pc.less_equal(ordinal, pc.take(low, parent))
    in_suffix = pc.greater(ordinal, pc.take(high, parent))
    in_middle = pc.invert(pc.or_(in_prefix, in_suffix))
    prefix = _joined(units, in_prefix, pc.add(low, 1))
    middle = _joined(units, in_middle, pc.subtract(high, low))
    suffix = _joined(units, in_suffix, pc.subtract(n, high))
    marked = pc.match_substring_regex(texts, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    plain = pc.or_(pc.or_(pc.equal(n, 0), marked), pc.greater_equal(_modulo(h[2], pa.scalar(100, pa.int64())), 100 - PLAIN_PERCENT))
    spm = pc.less(_modulo(h[3], pa.scalar(100, pa.int64())), SPM_PERCENT)
    as_psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    as_spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    cases = pc.make_struct(plain, spm)
    nothing = pa.scalar(None, pa.int64())
    return {"n": n, "form": pc.case_when(cases, pa.scalar("plain"), pa.scalar("spm"), pa.scalar("psm")),
            "prefix_chars": pc.if_else(plain, nothing, pc.cast(pc.utf8_length(prefix), pa.int64())),
            "middle_chars": pc.if_else(plain, nothing, pc.cast(pc.utf8_length(middle), pa.int64())),
            "output": pc.case_when(cases, texts, as_spm, as_psm)}


def transform(docs: DataFrame, seed: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, 1):
            texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
            made = transform_batch(texts, [batch.column(2 + k) for k in range(4)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.values()], ["doc_id", *made])

    doc_id = F.col(id_column).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.col(text_column).cast("string").alias("text"),
                       *(h.alias(f"h{k + 1}") for k, h in enumerate(draws(doc_id, seed))))
    return rows.mapInArrow(task, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text of an output: the pieces between its sentinels, put back in order."""
    piece = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    at = lambda k: F.get(piece, F.lit(k))
    return (F.when(form == "plain", output).when(form == "psm", F.concat(at(1), at(3), at(2)))
            .otherwise(F.concat(at(2), at(3), at(1))))
