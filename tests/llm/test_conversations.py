import hashlib
import random
import zlib
from functools import lru_cache
from itertools import product

import pytest

from txrisk.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, piece long, conv string, place long"
SPACE = " \t\n\x0b\x0c\r"


def brute_edits(letters):
    """Cost, audit and resulting roles of the cheapest edits, least audit first, by trying every edit everywhere."""

    @lru_cache(None)
    def best(at, state, inserts):
        ways = []
        if at == len(letters) and state in "0a":
            ways.append((0, "", ""))
        call, after = ("assistant", "a") if state == "u" else ("user", "u")
        if inserts:
            c, audit, out = best(at, after, inserts - 1)
            ways.append((c + 3, "I" + audit, call[0] + out))
        if at < len(letters):
            letter = letters[at]
            extra = 3 * letter.isupper()
            c, audit, out = best(at + 1, state, 3)
            ways.append((c + 4, "D" + audit, "-" + out))
            if letter != "x":
                if letter.lower() == call[0]:
                    c, audit, out = best(at + 1, after, 3)
                    ways.append((c + extra, "K" + audit, "k" + out))
                if letter.lower() == "s" and state == "0":
                    c, audit, out = best(at + 1, "s", 3)
                    ways.append((c + extra, "K" + audit, "k" + out))
                c, audit, out = best(at + 1, after, 3)
                ways.append((c + 3 + extra, "R" + audit, call[0].upper() + out))
        return min(ways, default=(10 ** 9, "", ""))

    for at in range(len(letters), 0, -1):  # from the end, so that no call goes deep
        for state in "0sua":
            best(at, state, 3)
    return best(0, "0", 3)


def brute(rows, damaged=True):
    """The contract's row for every conversation of (conv_id, turn, role, text)."""
    kept = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        text = "" if lot == 1 else "".join(c for c in text if c not in ".!?") if lot == 2 else text
        kept[conv] += [(turn, "user" if lot == 4 else role, text)] * {0: 0, 3: 2}.get(lot, 1)
    out = {}
    for conv, turns in kept.items():
        order = lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest())
        turns.sort(key=order)
        numbers = {t for t, _, _ in turns if t is not None}
        letters, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in turns:
            ink = text.rstrip(SPACE)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters.append("x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
        cost, audit, plan = brute_edits("".join(letters))
        lines, at = [], 0
        names = {"u": "user", "a": "assistant"}
        for sign in plan:
            if sign in "ua":
                lines.append(f"{names[sign]}:")
                continue
            if sign != "-":
                lines.append(f"{turns[at][1] if sign == 'k' else names[sign.lower()]}:{turns[at][2]}")
            at += 1
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out[conv] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *counts.values(), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def report(spark, rows, damaged=True):
    given = frame(spark, rows)
    turns = C.turns_of(given)
    got = C.report(given, C.damage(turns) if damaged else turns).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}


def conversations(seed=1, many=120):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "u", "a", "", "User", None, "system: x"]
    texts = ["Yes.", "No!", "Why?", "Cut off", "", "  \t", None, "a. b", "Ends here.\n ", "\x1c", "\x1c.", "é", "Long " * 3 + ".", " "]
    out = []
    for conv in range(many):
        turn = r.randint(-3, 3)
        for _ in range(r.randint(1, 12)):
            out.append((conv, turn if r.random() < 0.9 else None, r.choice(roles[: r.choice([2, 3, 12])]), r.choice(texts) if r.random() < 0.7 else f"{r.random()}."))
            turn += r.choice([1, 1, 1, 1, 2, 0])
    out += out[:15]                                                # repeated rows
    out += [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "There.")]
    return out


def test_equals_brute_force(spark):
    rows = conversations()
    assert report(spark, rows) == brute(rows)


def test_undamaged(spark):
    rows = conversations(2, 60)
    assert report(spark, rows, False) == brute(rows, False)


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_conversations_of_many_pieces(spark, monkeypatch, bits):
    monkeypatch.setattr(C, "PIECE_BITS", bits)
    rows = conversations(3 + bits, 40)
    rows += [(999, t, ["user", "assistant"][t % 2 ^ (t % 7 == 0)], f"{t}" + "." * (t % 5 != 0)) for t in range(300)]
    assert report(spark, rows) == brute(rows)


def test_a_long_conversation(spark):
    rows = [(1, t // 2, ["user", "assistant", "tool"][t % 2 + (t % 11 == 0)], f"{t % 900}" + "." * (t % 5 != 0)) for t in range(1500)]
    assert report(spark, rows) == brute(rows)


def test_all_signatures_up_to_four(spark):
    kinds = ["s", "u", "a", "o", "S", "U", "A", "O", "x"]
    signatures = sorted(("".join(p) for n in range(1, 5) for p in product(kinds, repeat=n)), key=lambda x: x[::-1])
    for signature, _, node in C.solve((s, "end") for s in signatures):
        cost, audit, plan = brute_edits(signature)
        assert (node.costs[0], node.plans[0].translate(str.maketrans("uaUA", "IIRR"))) == (cost, audit)
        assert node.plans[0] == plan.replace("k", "K").replace("-", "D")


def test_each_ending_is_solved_once(monkeypatch):
    made = []
    plain = C.node_before
    monkeypatch.setattr(C, "node_before", lambda letter, after: made.append(letter) or plain(letter, after))
    signatures = sorted({"uaua", "sua", "ua", "xua", "aua", "uaoa", "a"}, key=lambda x: x[::-1])
    list(C.solve((s, "end") for s in signatures))
    assert len(made) == len({s[k:] for s in signatures for k in range(len(s))})


def test_empty_table(spark):
    assert report(spark, []) == {}


def test_all_turns_dropped(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    assert report(spark, [(conv, 1, "user", "Hi.")]) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
