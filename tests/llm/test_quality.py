import re
from collections import Counter

import numpy as np
import pandas as pd

from tests.conftest import SF_MID
from tests.llm.helpers import documents, frame
from txrisk.llm import quality
from txrisk.llm.common import table


def brute_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i: i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_base_rules_equal_brute_force(spark):
    rows = documents() + [(500, "a b c a b c\n\na b c a b c\n x # *\n x # *", "en"), (501, "| " * 60, "de")]
    got = quality.judge(frame(spark, rows), ["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        n, chars, symbols, dup, repeated = brute_rules(r.row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.base_failed and r.kept)


def test_empty_table_and_extra_columns(spark):
    none = quality.judge(frame(spark, []), ["doc_id"])
    assert none.count() == 0
    whole = quality.judge(frame(spark, documents()), frame(spark, []).columns).select("row.*")
    assert whole.columns == frame(spark, []).columns and whole.count() == len(documents())


def brute_kneser_ney(counts, order, classes):
    """Probabilities of modified Kneser-Ney straight from the definition, over tuples."""
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])

    def discount(k):
        few = [sum(1 for v in tables[k].values() if v == c) for c in (1, 2, 3, 4)]
        y = few[0] / (few[0] + 2 * few[1]) if few[0] else 0.5
        return [min(max(c - (c + 1) * y * few[c] / few[c - 1], 0), c) if few[c - 1] else y for c in (1, 2, 3)]

    d = {k: discount(k) for k in tables}

    def p(gram):
        if not gram:
            return 1 / classes
        table, take = tables[len(gram)], d[len(gram)]
        after = {g: v for g, v in table.items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return p(gram[1:])
        cut = {g: min(take[min(v, 3) - 1], v) for g, v in after.items()}
        own = (after[gram] - cut[gram]) / total if gram in after else 0
        return own + sum(cut.values()) / total * p(gram[1:])

    return p


def test_model_equals_the_definition_and_sums_to_one():
    r = np.random.default_rng(3)
    text = r.choice([0, 1, 2, 3, 5, 9], 400, p=[0.4, 0.2, 0.2, 0.1, 0.05, 0.05])
    grams = Counter(tuple(int(x) for x in text[i: i + 4]) for i in range(len(text) - 3))
    code = {g: g[0] << 15 | g[1] << 10 | g[2] << 5 | g[3] for g in grams}
    model = quality.KneserNey(pd.DataFrame({"slot": 1, "code": [code[g] for g in grams], "n": list(grams.values())}))
    p = brute_kneser_ney(grams, 4, quality.CLASSES)
    asked = [*list(grams)[:40], (0, 0, 0, 7), (9, 9, 9, 9), (31, 30, 29, 28), (1, 2, 9, 4)]
    got = np.exp(model.log_prob(1, np.array([g[0] << 15 | g[1] << 10 | g[2] << 5 | g[3] for g in asked])))
    assert np.allclose(got, [p(g) for g in asked])
    table = np.exp(model.table(1).astype(np.float64)).reshape(-1, quality.CLASSES)
    assert np.allclose(table.sum(axis=1), 1, atol=1e-4)
    assert (np.diff(model.keys.astype(np.float64)) >= 0).all()


def test_junk_lies_outside_the_bands(spark):
    import random
    r = random.Random(5)
    good = [(i, " ".join(r.choice(["the", "house", "and", "river", "stone", "with", "garden", "light"]) for _ in range(120)), "en") for i in range(200)]
    bad = [(1000 + i, "".join(r.choice("qxzjkvw#@^~{}0123456789 ") for _ in range(900)), "en") for i in range(3)]
    got = {x.row.doc_id: x for x in quality.judge(frame(spark, good + bad), ["doc_id"]).collect()}
    assert all(got[i].kept for i, _, _ in good if not got[i].base_failed)
    assert not any(got[i].kept for i, _, _ in bad)


def test_counts_are_those_of_all_texts(spark):
    rows = [(0, "abcde", "en"), (1, "abcd", "en"), (2, "ÁBCD", "fr"), (3, "abc", "en"), (4, None, "en"), (5, "abcd", None)]
    got = {(r.slot, r.code): r.n for r in quality.count_grams(frame(spark, rows)).collect()}
    code = 1 << 15 | 2 << 10 | 3 << 5 | 4
    assert got[1, code] == 2 and got[3, code] == 1 and got[len(quality.LANGUAGES), code] == 1 and sum(got.values()) == 5


def test_character_model_equals_the_definition(spark):
    import random
    r = random.Random(6)
    texts = {"ru": ["".join(r.choice("абвгд ж") for _ in range(60)) for _ in range(8)], None: ["日本語日本日語本日本語", "日本語日本本本"]}
    rows = [(100 * k + i, t, lang) for k, (lang, of) in enumerate(texts.items()) for i, t in enumerate(of)]
    docs = frame(spark, rows)
    none = quality.KneserNey(quality.count_grams(docs).toPandas())
    want = {}
    for lang, of in texts.items():
        grams = Counter(tuple(t[i: i + 4]) for t in of for i in range(len(t) - 3))
        p = brute_kneser_ney(grams, 4, len({g[3] for g in grams}) + 1)
        for k, t, x in rows:
            if x == lang:
                want[k] = -np.mean([np.log(p(tuple(t[i: i + 4]))) for i in range(len(t) - 3)])
    for most in (10 ** 6, 0):  # sent to the tasks, and joined
        got = {x.row.doc_id: x.char_score for x in quality.scored(docs, none, ["doc_id"], most).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_joined_scores_equal_those_of_the_sent_model(spark):
    docs = frame(spark, documents() + [(500, "abcd", None), (501, None, "abcd"), (502, "abc", "en")])
    model = quality.KneserNey(quality.count_grams(docs).toPandas())
    a, b = (sorted(((str(x.row), x.char_score) for x in quality.scored(docs, model, ["doc_id", "text"], most).collect()), key=str) for most in (10 ** 6, 0))
    assert [x for x, _ in a] == [x for x, _ in b]
    assert all((x is None) == (y is None) and (x is None or abs(x - y) < 1e-9) for (_, x), (_, y) in zip(a, b))


def test_other_scripts_and_small_languages_are_judged(spark):
    import random
    r = random.Random(7)

    def prose(words, n):
        return " ".join(r.choice(words) for _ in range(n))

    cyrillic = "дом река камень сад свет вода дорога окно стена лес поле город".split()
    greek = "σπίτι ποτάμι πέτρα κήπος φως νερό δρόμος παράθυρο τοίχος δάσος πεδίο πόλη".split()
    rows = [(i, prose(cyrillic, 120), "ru") for i in range(200)] + [(1000 + i, prose(greek, 120), "el") for i in range(40)]
    rows += [(2000, "".join(r.choice("щъэюфцчшжыё ") for _ in range(900)), "ru"), (2001, "".join(r.choice("αβγδζηθξψω ") for _ in range(900)), "el")]
    kept = {x.row.doc_id: x.kept for x in quality.judge(frame(spark, rows), ["doc_id"]).collect()}
    assert not kept.pop(2000) and not kept.pop(2001)
    assert all(kept.values())


def test_tables_and_marked_words_are_rejected_and_good_texts_kept(spark):
    docs = table(spark, SF_MID, "documents")
    label = {r.doc_id: r.quality for r in table(spark, SF_MID, "labels").collect()}
    kept = {"table": [], "marked": [], "good": []}
    for r in quality.judge(docs, ["doc_id", "text"]).filter("NOT base_failed").collect():
        if label.get(r.row.doc_id) == 1:
            kept["good"].append(r.kept)
        elif label.get(r.row.doc_id) == 0:
            for kind, mark in (("table", " | "), ("marked", "$$$")):
                if r.row.text.count(mark) >= 5:
                    kept[kind].append(r.kept)
    assert len(kept["good"]) > 200 and np.mean(kept["good"]) > 0.95
    for kind in ("table", "marked"):
        assert len(kept[kind]) >= 3 and np.mean(kept[kind]) < 0.5, (kind, kept[kind])
