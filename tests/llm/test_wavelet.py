import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import documents, frame
from txrisk.llm import byte_bpe, wavelet
from txrisk.llm.common import scratch

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
key = lambda x: tuple((v is None, v) for v in x)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def odd_texts(n=4000):
    r = random.Random(3)
    parts = [" ", " ", "\n", "a", "b'", "s", "1", ".", "<", "<|endoftext|>", "é", " ", "\t", "中", "\r", "×.", "ß", "'ll", "é,", "-", "'t", "[",
             "|", "Ab", "　", "\u0085", " ", "́", "\x1c", "¡", "ñ(", "_", "\U0001F600", "|>", "  "]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_ids_are_the_tokenizers(tokenizer):
    texts = [None, "", *odd_texts(), *(t for _, t, _ in documents())]
    bpe = byte_bpe.ByteBpe(VOCABULARY)
    for part in (texts[:100], texts, texts[::-1], ["", None], []):
        ids, begins = bpe.encode(pa.array(part, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in part]


def test_a_worker_that_forgets_units_goes_on(tokenizer, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 50)
    bpe, texts = byte_bpe.ByteBpe(VOCABULARY), odd_texts(200)
    for at in range(0, 200, 20):
        ids, _ = bpe.encode(pa.array(texts[at: at + 20]))
        assert ids.tolist() == [i for t in texts[at: at + 20] for i in tokenizer.encode(t, add_special_tokens=False).ids]


@pytest.mark.parametrize("n,bits,seed", [(0, 4, 1), (1, 1, 2), (77, 3, 3), (5000, 16, 4), (200_000, 16, 5), (70_000, 17, 6)])
def test_questions_equal_brute_force(spark, n, bits, seed):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.zipf(1.4, n), (1 << bits) - 1).astype(np.int64)
    path = f"{scratch(spark, 'wavelet-test')}/one.wmx"
    wavelet.write_wavelet(path, ids, [5, None], np.array([0, n // 2, n]), bits)
    file = wavelet.WaveletFile(path)
    assert (file.read() == ids).all() and file.doc_ids == [5, None] and file.starts.tolist() == [0, n // 2, n]
    places = rng.integers(0, n, 300) if n else np.zeros(0, np.int64)
    assert (file.access(places) == ids[places]).all()
    for token in {*ids[:5].tolist(), 0, 1, (1 << bits) - 1, 1 << bits, int(ids.max(initial=0))}:
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        assert file.count(token, a, b) == (ids[a:b] == token).sum()
        assert file.occurrences(token).tolist() == np.flatnonzero(ids == token).tolist()
        assert file.occurrences(token, a, b).tolist() == (np.flatnonzero(ids[a:b] == token) + a).tolist()


def test_a_question_reads_few_blocks(spark):
    path = f"{scratch(spark, 'wavelet-test')}/long.wmx"
    wavelet.write_wavelet(path, np.random.default_rng(1).integers(0, 50_000, 1_000_000), [1], np.array([0, 1_000_000]))
    file = wavelet.WaveletFile(path)
    file.access(np.array([654_321]))
    assert len(file.kept) == 16


def test_a_file_of_another_kind(spark):
    from txrisk.llm.common import write_file
    path = f"{scratch(spark, 'wavelet-test')}/other"
    write_file(path, iter([b"something else"]))
    with pytest.raises(ValueError):
        wavelet.WaveletFile(path)


def brute(rows, tokenizer):
    """doc_id, start, n_tokens, crc32 of rows whose order is given."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents_equal_brute_force(spark, tokenizer):
    rows = [*documents(), *((9000 + i, t, "en") for i, t in enumerate(odd_texts(300)))]
    once = {i: t for i, t, _ in rows if i is not None}
    files = wavelet.write_shards(frame(spark, [(i, t, "en") for i, t in once.items()]).repartition(3), VOCABULARY, shard_tokens=2000)
    assert files.count() > 3
    got = [tuple(r) for r in wavelet.read_documents(files).collect()]
    assert sorted(got) == brute(sorted(once.items()), tokenizer)
    token = tokenizer.encode(" ").ids[0]
    expected = [(i, p) for i, t in once.items() for p, x in enumerate(tokenizer.encode(t or "").ids) if x == token]
    assert sorted(tuple(r) for r in wavelet.find(files, token).collect()) == sorted(expected)
    assert {r.token: r.n for r in wavelet.count(files, [token, 2, 50_000_000]).collect()} == {token: len(expected), 2: len(once) + sum(
        tokenizer.encode(t or "").ids.count(2) for t in once.values()), 50_000_000: 0}


def test_repeated_rows_and_null_ids_leave_no_gap(spark, tokenizer):
    rows = documents()
    got = sorted(wavelet.read_documents(wavelet.write_shards(frame(spark, rows), VOCABULARY, shard_tokens=500)).collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in got] == sorted((i for i, _, _ in rows), key=lambda i: (i is None, i or 0))
    plain = lambda four: (four[0], four[2], four[3])
    assert sorted((plain(tuple(r)) for r in got), key=key) == sorted((plain(x) for x in brute([(i, t) for i, t, _ in rows], tokenizer)), key=key)


def test_empty_table(spark):
    assert wavelet.read_documents(wavelet.write_shards(frame(spark, []), VOCABULARY)).count() == 0
