import random
from collections import defaultdict

import pytest

from tests.llm.helpers import documents, frame, words
from txrisk.llm import common, ngram_join
from txrisk.llm.components import components


def brute(rows):
    """component_id and set size of every row, from all pairs."""
    sets = []
    for _, text, _ in rows:
        w = [x.lower() for x in (text or "").encode().split()]
        sets.append({tuple(w[i: i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    group = defaultdict(list)
    for a in range(len(rows)):
        group[root(a)].append(rows[a][0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in group.items()}
    return sorted(((rows[a][0], len(sets[a]), least[root(a)]) for a in range(len(rows))), key=str)


def result(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()), key=str)


def near_copies(r, start, many):
    """A group whose members are one to four edits away from a base, so that many of its pairs are not linked."""
    base = words(r, 150).split()
    out = []
    for k in range(many):
        copy = list(base)
        for _ in range(r.randint(1, 4)):
            copy[r.randrange(len(copy))] = f"edit{r.randrange(10**6)}"
        out.append((start + k, " ".join(copy), "en"))
    return out


def test_components_equal_brute_force(spark):
    rows = documents() + near_copies(random.Random(4), 700, 25)
    assert result(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("block", [3, 8])
def test_lists_of_many_blocks_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    r = random.Random(block)
    shared = words(r, 60)
    rows = near_copies(r, 0, 60) + [(100 + k, shared + " " + words(r, 12), "en") for k in range(30)]
    assert result(frame(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert ngram_join.join(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(12)]
    parent = {x: x for p in links for x in p}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}


def test_width_and_percent(spark):
    r = random.Random(9)
    base = [f"{w}{k}" for k, w in enumerate(words(r, 1000).split())]
    copy = ["edited" if k % 45 == 20 else w for k, w in enumerate(base)]
    rows = [(1, " ".join(base), "en"), (2, " ".join(copy), "en"), (3, "one two three four", "en"), (4, "one two three four", "en")]
    sets = [{tuple(x[i: i + 5]) for i in range(len(x) - 4)} for x in (base, copy)]
    assert 80 * len(sets[0] | sets[1]) <= 100 * len(sets[0] & sets[1])
    docs = frame(spark, rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs, width=5, percent=80).collect()} == {
        1: (996, 1), 2: (996, 1), 3: (1, 3), 4: (1, 3)}
    assert {r.doc_id: r.component_id for r in ngram_join.join(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 3}


def test_only_tokens_of_two_documents_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "RUN", 500)
    r = random.Random(12)
    some = words(r, 300).split()
    rows = [(k, " ".join(r.choices(some, k=300)), "en") for k in range(60)] + near_copies(r, 200, 20)
    docs = frame(spark, rows).selectExpr("text", "doc_id", "xxhash64(text, doc_id) AS mark")
    levels = spark.sparkContext.broadcast(ngram_join.sketch(docs.select("text")))
    keyed = ngram_join.written(ngram_join._keyed(docs, levels, 4, 85), "sets")
    tokens = defaultdict(list)
    for row in keyed.collect():
        for t in row.prefix:
            tokens[t].append((row.node, row.n))
    shared = sorted((node, n, t) for t, held in tokens.items() if len(held) > 1 for node, n in held)
    got = sorted((x.node, x.n, x.token) for x in ngram_join._meeting(keyed).collect())
    assert len(tokens) > 4 * len(shared) > 0
    assert set(shared) <= set(got) and len(got) <= len(shared) + 0.1 * len(tokens)


def test_sets_travel_as_texts_smaller_than_their_shingles(spark):
    rows = [(k, words(random.Random(k), 400), "en") for k in range(20)] + [(30, None, "en"), (31, " \n", "en"), (32, "x" * 3_000_000 + " y", "en")]
    docs = frame(spark, rows).selectExpr("text", "doc_id", "xxhash64(text, doc_id) AS mark")
    levels = spark.sparkContext.broadcast(ngram_join.sketch(docs.select("text")))
    every = spark.sparkContext.broadcast(ngram_join.np.full(1 << 13, 255, ngram_join.np.uint8))
    sent = ngram_join._texts(docs, levels, every, 4, 85).collect()
    sizes = {x.node: x.n for x in ngram_join._keyed(docs, levels, 4, 85).collect() if x.n}
    assert {x.node for x in sent} == set(sizes) and len(sent) == 21
    assert all(len(x.packed) < 0.5 * 9 * sizes[x.node] for x in sent if sizes[x.node] > 1) and min(len(x.packed) for x in sent) < 1000


def test_texts_are_taken_in_pieces_of_bounded_bytes(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TEXT_BYTES", 300)
    rows = documents() + near_copies(random.Random(6), 700, 12)
    docs = frame(spark, rows)
    levels = spark.sparkContext.broadcast(ngram_join.sketch(docs.select("text")))
    marked = docs.selectExpr("text", "doc_id", "xxhash64(text, doc_id) AS mark")
    sizes = spark.sparkContext.accumulator(0)

    class Counted(ngram_join.Shingles):
        def __init__(self, column, *more):
            sizes.add(int(len(column) > 1 and sum(len(x or "") for x in column.to_pylist()) > 300))
            super().__init__(column, *more)

    monkeypatch.setattr(ngram_join, "Shingles", Counted)
    assert ngram_join._keyed(marked, levels, 4, 85).count() == len(rows) and sizes.value == 0
    monkeypatch.undo()
    monkeypatch.setattr(ngram_join, "TEXT_BYTES", 300)
    assert result(docs) == brute(rows)


def test_a_task_gives_its_memory_back(monkeypatch):
    given = []

    class Pool:
        def release_unused(self):
            given.append(True)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    task = common.trimmed(lambda batches: (2 * b for b in batches))
    assert list(task(iter([1, 2]))) == [2, 4] and given == [True]
