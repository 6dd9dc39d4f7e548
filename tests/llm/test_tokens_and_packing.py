import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import documents, frame
from txrisk.llm import packing, token_files, word_bpe
from txrisk.llm.common import scratch, write_file

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def odd_texts():
    return [(1000 + i, t, "en") for i, t in enumerate([
        "<|endoftext|>x it's Don't İstanbul ΣΑΣ é ﬁ 12a a_b", "œuvre Ÿ ß ẞ × ÷ ÿ Éé,. --", "word.,!? #$% a|b x<|startoftext|>"])]


def test_pieces_are_the_tokenizers_ids_and_sequences_are_gapless(spark, tokenizer):
    rows = documents() + odd_texts()
    got = packing.pack(packing.tokenised_pieces(frame(spark, rows), VOCABULARY, 512), 512, group_pieces=40).collect()
    expected = []
    for doc_id, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 512)):
            part = ids[a: a + 512]
            expected.append((doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(expected, key=key)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512


def test_packing_of_an_empty_table(spark):
    assert packing.pack(packing.tokenised_pieces(frame(spark, []), VOCABULARY)).count() == 0


def test_smallest_piece_is_exchanged_for_two_that_fit_tighter():
    # greedy takes 6 and 3 of 10; 2 + 2 fill the widened gap of 4 and replace the 3
    sequence, offset = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert sequence[0] == sequence[2] == sequence[3] == 0 and sequence[1] == 1
    assert sorted([offset[0], offset[2], offset[3]]) == [0, 6, 8]


@pytest.mark.parametrize("seed", range(6))
def test_packing_is_whole_and_close_to_the_lower_bound(seed):
    r = random.Random(seed)
    lengths = np.array([r.choice([r.randint(1, 100), r.randint(1, 1000), 1000]) for _ in range(r.randint(1, 2000))])
    sequence, offset = packing.best_two_fit(lengths, 1000)
    fill = np.bincount(sequence, lengths)
    assert fill.max() <= 1000 and (fill > 0).all()
    for s in range(sequence.max() + 1):
        mine = np.argsort(offset[sequence == s])
        at = np.cumsum(lengths[sequence == s][mine])
        assert (offset[sequence == s][mine] == np.concatenate([[0], at[:-1]])).all()
    firsts = first_fit_decreasing(lengths.tolist(), 1000)
    assert sequence.max() + 1 <= firsts + 1


def first_fit_decreasing(lengths, size):
    room = []
    for length in sorted(lengths, reverse=True):
        for k, free in enumerate(room):
            if free >= length:
                room[k] -= length
                break
        else:
            room.append(size - length)
    return len(room)


def test_counts_by_separator_scan_equal_the_tokenizers(spark, tokenizer):
    rows = documents() + odd_texts()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    docs = token_files.write_token_files(frame(spark, rows).repartition(3), VOCABULARY, 49407)
    found = token_files.separator_scan(docs.select("path"), 49407, block_tokens=97)
    got = docs.join(found, ["path", "ordinal"], "full").collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert all(r.terminated for r in got)
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=key) == sorted(
        ((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows), key=key)


def test_scan_of_foreign_files(spark):
    folder = scratch(spark, "foreign")
    files = {"a": [1, 2, 9, 9, 3], "b": [], "c": [9], "d": [4] * 50 + [9], "e": [5] * 30}
    for name, tokens in files.items():
        write_file(f"{folder}/{name}", iter([np.array(tokens, "<u4").tobytes()]))
    paths = spark.createDataFrame([(f"{folder}/{n}",) for n in files], "path string")
    got = token_files.separator_scan(paths, 9, "<u4", block_tokens=8).collect()
    assert sorted((r.path[-1], r.ordinal, r.start, r.n_tokens, r.terminated) for r in got) == [
        ("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 1, False), ("c", 0, 0, 0, True),
        ("d", 0, 0, 50, True), ("e", 0, 0, 30, False)]


def test_several_tasks_search(spark):
    from pyspark.sql import functions as F
    path = f"{scratch(spark, 'long')}/one"
    write_file(path, iter([np.arange(10_000, dtype="<u2").tobytes()]))
    found = token_files.searched_blocks(spark.createDataFrame([(path,)], "path string"), 9, block_tokens=100)
    assert found.count() == 100 and found.select(F.spark_partition_id()).distinct().count() > 4


def test_token_counts_of_an_empty_table(spark):
    assert token_files.document_token_counts(frame(spark, []), VOCABULARY, 49407).count() == 0


def test_chunks_are_bounded_by_bytes_of_text():
    texts = [str(k % 10) * (50_000 if k % 7 else 400_000) for k in range(90)] + [None, "", "x" * 900_000, "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    parts = [word_bpe.single(t.column(1)) for t in word_bpe.chunks(iter([batch, batch.slice(0, 3)]), 1, 300_000)]
    assert [x for p in parts for x in p.to_pylist()] == texts + texts[:3]
    for p in parts:
        assert len(p) == 1 or sum(len(x or "") for x in p.to_pylist()) <= 600_000
    assert sum(len(p) > 1 for p in parts) > 5
