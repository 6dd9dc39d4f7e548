"""Small documents with every awkward case."""

from __future__ import annotations

import random

#: Extra columns whose names clash with those that operators make for themselves.
EXTRA = "row string, n long, token string, score double, kept boolean, node long, component_id long, leaf long, grp long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
CLASH = ("r", 7, "t", 0.5, False, 3, 4, 5, 6)


def words(r: random.Random, n: int) -> str:
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n))


def documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang): plain texts, near and exact copies, nulls, blanks, a long text, repeated rows."""
    r = random.Random(seed)
    out: list[tuple] = []

    def add(text, lang="en"):
        out.append((len(out), text, lang))

    for _ in range(30):
        add("\n".join(words(r, r.randint(5, 40)) for _ in range(r.randint(1, 4))))
    for k in range(6):
        base = out[k][1].split(" ")
        for _ in range(3):
            edited = list(base)
            edited[r.randrange(len(edited))] = "changed"
            add(" ".join(edited))
    add(out[0][1])
    add(out[0][1].upper())
    add("")
    add("  \n\t ")
    add(None)
    add("one")
    add("One two three", None)
    add("éa ñb ç 中文 \U0001F600 x y \x1c z", "xx")
    add(words(r, 20_000))
    add("same " * 300)
    out.append(out[1])  # a repeated row
    out.append((None, out[2][1], "en"))
    out.append((None, None, None))
    return out


def frame(spark, rows):
    """The rows as a documents table with clashing extra columns."""
    return spark.createDataFrame([(i, t, lang, "src", len(t or ""), *CLASH) for i, t, lang in rows], SCHEMA)
