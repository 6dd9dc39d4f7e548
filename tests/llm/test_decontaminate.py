import random

import pyarrow as pa
import pytest

from tests.llm.helpers import CLASH, documents, frame, words
from txrisk.llm import decontaminate as d


def brute_tiles(a, b, least):
    """Greedy string tiling straight from the definition."""
    ma, mb, out = [False] * len(a), [False] * len(b), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ma[i + k] and not mb[j + k]:
                    k += 1
                if k >= least and (best is None or (-k, i, j) < best):
                    best = (-k, i, j)
        if best is None:
            return out
        n, i, j = best
        out.append((i, j, -n))
        for k in range(-n):
            ma[i + k] = mb[j + k] = True


@pytest.mark.parametrize("seed", range(25))
def test_tiles_equal_brute_force(seed):
    r = random.Random(seed)
    a = [r.choice("abc") for _ in range(r.randint(1, 25))]
    b = [r.choice("abc") for _ in range(r.randint(1, 40))]
    least = r.randint(2, 4)
    pairs = [(i, j) for i in range(len(a) - least + 1) for j in range(len(b) - least + 1) if a[i: i + least] == b[j: j + least]]
    assert sorted(d.tiles(pairs, least)) == sorted(brute_tiles(a, b, least))


def tables(spark):
    r = random.Random(9)
    items = [words(r, 40) for _ in range(6)]
    items += ["tiny item", "", None, "   ", items[0]]
    w = [x.split() for x in items[:6]]
    rows = documents() + [
        (600, "before " + items[1] + " after", "en"),
        (601, " ".join(w[2][20:] + ["and", "so"] + w[2][:20]), "en"),  # two halves in another order
        (602, " ".join(w[3][:12]), "en"),  # too little of it
        (603, items[4].upper().replace(" ", ", "), "en"),
        (604, "a tiny item here", "en"), (605, (words(r, 3000) + " ") * 3 + items[5], "en")]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    return frame(spark, rows), bench, rows


@pytest.mark.parametrize("block_words", [2_000_000, 60])
def test_passages_are_found_whatever_their_order(spark, block_words):
    docs, bench, rows = tables(spark)
    got = {(r.doc_id, r.item_id): r for r in d.contaminated(docs, bench, block_words=block_words).collect()}
    assert set(got) == {(600, 1), (601, 2), (603, 4), (604, 6), (605, 5)}
    assert got[601, 2].n_tiles == 2 and got[601, 2].coverage == 1.0


def test_clean_keeps_all_others_with_all_columns(spark):
    docs, bench, rows = tables(spark)
    kept = d.clean(docs, bench)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(i for i, _, _ in rows if i is not None and i not in (600, 601, 603, 604, 605))
    first = kept.first().asDict()
    assert tuple(first[c] for c in docs.columns[5:]) == CLASH
    assert kept.filter("doc_id IS NULL").count() == 2


def test_empty_tables(spark):
    docs, bench, rows = tables(spark)
    assert d.contaminated(docs, bench.limit(0)).count() == 0
    assert d.clean(docs, bench.limit(0)).count() == len(rows)
    assert d.contaminated(docs.limit(0), bench).count() == 0


def test_words_ignore_case_and_marks():
    a, b = (d.words_of(pa.array([t])) for t in ("Élan, VITAL! 12", "élan vital\n12"))
    assert (a.hash == b.hash).all() and len(a.hash) == 3
