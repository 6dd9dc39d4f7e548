"""Secret scans: fixed patterns, and a small character convolutional network over every other candidate.

A candidate is a maximal run of 16 or more characters ``[A-Za-z0-9+/_=-]`` with a digit.  The network, written in
numpy, reads the candidate with the text around it.  It is trained on all distinct labelled findings of the corpus itself:
matches of the patterns (1) and candidates that touch none (0), dealt by hash to pieces of about ``PIECE``.  In every round
each piece improves the shared weights on its own findings, and the weights are averaged by the pieces' findings.  Half of
the findings are held out: a temperature calibrates the scores there, and the threshold is the highest one that keeps the
wanted share of true findings, both counted over all of them.  Candidates at or above it are added to the matches; no match
is taken away.

Defined results: null and empty text have no findings; repeated rows are scanned alike; without findings of either
label nothing is added; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import batches_of, smallest, utf8, written

#: Fixed patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "model")


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


DIGITS = "0123456789"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
IS_HEX, IS_DIGIT, IS_KEY = _mask(DIGITS + "abcdef"), _mask(DIGITS), _mask(DIGITS + LETTERS + "+/_=-")

#: Characters read before, in and after a candidate.
BEFORE, INSIDE, AFTER = 24, 40, 8
SPAN = BEFORE + INSIDE + AFTER

#: Size of the network.
SYMBOLS, DEPTH, WIDTH, FILTERS = 96, 8, 5, 24

#: Findings of a piece, rounds of training, and least steps of a piece over all rounds.
PIECE, ROUNDS, STEPS = 8192, 6, 300

#: Temperatures to choose from.
TEMPERATURES = np.geomspace(0.25, 8, 41)


def runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte places of the maximal runs of ``mask`` inside one row that have at least ``least`` bytes."""
    n = len(mask)
    begin, end = mask.copy(), mask.copy()
    if n:
        begin[1:] &= ~mask[:-1]
        end[:-1] &= ~mask[1:]
        edge = np.unique(offsets[:-1][offsets[:-1] < n])
        begin[edge] = mask[edge]
        last = edge[edge > 0] - 1
        end[last] = mask[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def findings(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, str, list[tuple], list[tuple]]]:
    """(row, text, matches, other candidates) of every row that has any; spans are (start, kind, end) in code points."""
    hexes = runs(IS_HEX[data], offsets, 24)
    keys = runs(IS_KEY[data], offsets, 16)
    digits = np.concatenate([[0], np.cumsum(IS_DIGIT[data])])
    with_digit = digits[keys[1]] > digits[keys[0]]
    keys = keys[0][with_digit], keys[1][with_digit]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    of_hex, of_key = (np.searchsorted(x[0], offsets) for x in (hexes, keys))
    whole = data.tobytes()
    for row, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        part = whole[a:b]
        low = part.lower()
        assigned = any(k.encode() in low for k in KEYWORDS)
        if not (assigned or b"AKIA" in part or of_hex[row] < of_hex[row + 1] or of_key[row] < of_key[row + 1]):
            continue
        text = part.decode("utf-8", "replace")
        place = (lambda x: (points[x] - points[a]).tolist()) if len(text) == points[b] - points[a] else None

        def spans(found: tuple, of: np.ndarray, pattern: str) -> list[tuple[int, int]]:
            if place is None:  # invalid UTF-8: code points differ from those of the bytes
                return [m.span() for m in re.finditer(pattern, text)]
            at = slice(of[row], of[row + 1])
            return list(zip(place(found[0][at]), place(found[1][at])))

        matches = [(s, 2, e) for s, e in spans(hexes, of_hex, r"[0-9a-f]{24,}")]
        matches += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        if assigned:
            matches += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        matches.sort()
        others = [(s, 3, e) for s, e in spans(keys, of_key, r"[A-Za-z0-9+/_=-]{16,}")
                  if not any(s < y and x < e for x, _, y in matches) and any(c in DIGITS for c in text[s:e])]
        yield row, text, matches, others


def window(text: str, start: int, end: int) -> np.ndarray:
    """Symbols around a finding: its first ``INSIDE`` characters, padded, with the text before and after.

    A symbol's number is doubled and gets one more inside the finding.
    """
    out = np.zeros(SPAN, np.int16)
    before = text[max(0, start - BEFORE): start]
    inside = text[start: min(end, start + INSIDE)]
    after = text[end: end + AFTER]
    for at, part, flag in ((BEFORE - len(before), before, 0), (BEFORE, inside, 1), (BEFORE + INSIDE, after, 0)):
        codes = np.frombuffer(part.encode("utf-32-le"), np.uint32).astype(np.int64)
        out[at: at + len(part)] = 2 * np.where((codes >= 32) & (codes < 127), codes - 31, 0) + flag
    return out


class CharCnn:
    """Embedding, one convolution, maximum over places, logistic output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w = {"embed": r.normal(0, 0.3, (2 * SYMBOLS, DEPTH)), "conv": r.normal(0, 0.2, (WIDTH * DEPTH, FILTERS)),
                  "bias": np.zeros(FILTERS), "out": r.normal(0, 0.3, FILTERS), "shift": np.zeros(1)}
        self.temperature, self.threshold = 1.0, 0.5

    def _forward(self, x: np.ndarray) -> tuple:
        e = self.w["embed"][x]
        tiles = np.lib.stride_tricks.sliding_window_view(e, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(x), SPAN - WIDTH + 1, -1)
        h = tiles @ self.w["conv"] + self.w["bias"]
        best = h.argmax(axis=1)
        top = np.maximum(np.take_along_axis(h, best[:, None, :], 1)[:, 0, :], 0)
        return tiles, best, top, top @ self.w["out"] + self.w["shift"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self._forward(x[i: i + 512])[3] for i in range(0, len(x), 512))])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability that a finding is a secret."""
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 300, batch: int = 128, rate: float = 0.01, seed: int = 7,
            share: float | None = None) -> None:
        """Adam on the logistic loss, both labels weighted alike; ``share``: that of label 1, if it is known for more than ``y``.

        The rows are read in passes, each in an order of its own.
        """
        r = np.random.default_rng(seed)
        share = y.mean() if share is None else share
        weight = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(a) for k, a in self.w.items()}
        order = np.concatenate([r.permutation(len(x)) for _ in range(-(-steps * batch // len(x)))])
        for step in range(1, steps + 1):
            at = order[(step - 1) * batch: step * batch]
            tiles, best, top, z = self._forward(x[at])
            dz = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[at]) * weight[at] / batch
            dtop = dz[:, None] * self.w["out"] * (top > 0)
            chosen = tiles[np.arange(batch)[:, None], best]  # row, filter -> tile
            grad = {"out": top.T @ dz, "shift": np.array([dz.sum()]), "bias": dtop.sum(0),
                    "conv": np.einsum("bf,bfd->df", dtop, chosen), "embed": np.zeros_like(self.w["embed"])}
            dtile = dtop[:, :, None] * self.w["conv"].T[None]
            symbols = x[at][np.arange(batch)[:, None, None], best[:, :, None] + np.arange(WIDTH)]
            np.add.at(grad["embed"], symbols, dtile.reshape(batch, FILTERS, WIDTH, DEPTH))
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Temperature of the least held-out loss; highest threshold with at least ``recall`` of the held-out secrets."""
        z = self.logits(x)
        self.temperature = float(TEMPERATURES[np.argmin(losses(z, y))])
        true = np.sort(z[y == 1])
        self.threshold = self.calibrated(true[int((1 - recall) * len(true))]) if len(true) else 1.1

    def calibrated(self, logit: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(logit / self.temperature, -40, 40))))


def losses(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of the logistic loss at every temperature."""
    return np.array([np.logaddexp(0, np.where(y == 1, -z, z) / t).sum() for t in TEMPERATURES])


def labelled(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(deal, label, seen): the distinct findings of all texts with their windows; ``deal`` is the window's hash."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = {(window(text, start, end).tobytes(), int(kind != 3))
                    for _, text, matches, others in findings(*utf8(batch.column(0))) for start, kind, end in [*matches, *others]}
            rows = [(int.from_bytes(hashlib.blake2b(seen, digest_size=8).digest(), "little", signed=True), label, seen) for seen, label in kept]
            columns = list(zip(*rows)) if rows else [[], [], []]
            kinds = (pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["deal", "label", "seen"])

    batches_of(docs.sparkSession)
    found = docs.select(F.col(text_column).cast("string")).mapInArrow(task, "deal long, label int, seen binary")
    return found.dropDuplicates(["deal", "label"])


def train(docs: DataFrame, recall: float = 0.98, text_column: str = "text") -> CharCnn | None:
    """Fit on the distinct labelled findings of all texts.  None if a label has fewer than 8."""
    found = written(labelled(docs, text_column), "findings")
    held, known = F.col("deal").bitwiseAND(F.lit(1)) == 1, F.count_if
    n = found.agg(known(F.col("label") == 0), known(F.col("label") == 1), known(~held), known(~held & (F.col("label") == 1)),
                  known(held & (F.col("label") == 1))).first()
    if min(n[0], n[1]) < 8:
        return None
    pieces = max(1, -(-n[2] // PIECE))
    dealt = written(found.withColumn("piece", F.pmod(F.shiftright("deal", 1), F.lit(pieces)).cast("int")).repartition(pieces, "piece"), "findings")
    model = CharCnn()
    if n[2]:
        for turn in range(ROUNDS):
            model.w = _improved(dealt.filter(~held), model, n[3] / n[2], turn)
    if n[4]:
        _calibrate(dealt.filter(held), model, recall, n[4])
    else:
        model.threshold = 1.1
    return model


def _improved(rows: DataFrame, model: CharCnn, share: float, turn: int) -> dict[str, np.ndarray]:
    """The weights after each piece has gone over all its findings, averaged by the findings."""
    sent = rows.sparkSession.sparkContext.broadcast(model.w)

    def one(key: tuple, held: pa.Table) -> pa.Table:
        held = held.sort_by([("deal", "ascending"), ("label", "ascending")])
        x = np.frombuffer(b"".join(held.column("seen").to_pylist()), np.int16).reshape(-1, SPAN)
        own = CharCnn()
        own.w = {k: v.copy() for k, v in sent.value.items()}
        own.fit(x, held.column("label").to_numpy(), max(STEPS // ROUNDS, -(-len(x) // 128)), rate=0.01 * (1 - turn / (ROUNDS + 1)),
                seed=turn, share=share)
        weights = np.concatenate([v.ravel() for v in own.w.values()])
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([len(x)], pa.int64()),
                         "weights": pa.array([weights.astype("<f8").tobytes()], pa.binary())})

    got = rows.groupBy("piece").applyInArrow(one, "piece int, n long, weights binary").sort("piece").collect()
    mean = np.average([np.frombuffer(r["weights"], "<f8") for r in got], axis=0, weights=[r["n"] for r in got])
    out, at = {}, 0
    for k, v in model.w.items():
        out[k] = mean[at: at + v.size].reshape(v.shape)
        at += v.size
    return out


def _calibrate(rows: DataFrame, model: CharCnn, recall: float, true: int) -> None:
    """``CharCnn.calibrate`` over distributed findings, ``true`` of them secrets."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def one(key: tuple, held: pa.Table) -> pa.Table:
        held = held.sort_by([("deal", "ascending"), ("label", "ascending")])
        y = held.column("label").to_numpy()
        z = sent.value.logits(np.frombuffer(b"".join(held.column("seen").to_pylist()), np.int16).reshape(-1, SPAN))
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "losses": pa.array([losses(z, y).tolist()], pa.list_(pa.float64())),
                         "logits": pa.array([np.sort(z[y == 1]).tolist()], pa.list_(pa.float64()))})

    scored = written(rows.groupBy("piece").applyInArrow(one, "piece int, losses array<double>, logits array<double>"), "logits")
    sums = np.sum([r["losses"] for r in scored.select("piece", "losses").sort("piece").collect()], axis=0)
    model.temperature = float(TEMPERATURES[np.argmin(sums)])
    logits = scored.select(F.explode("logits").alias("value"), F.lit(1).alias("n"))
    model.threshold = model.calibrated(smallest(logits, int((1 - recall) * true)))


def scan(docs: DataFrame, model: CharCnn | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, spans): every text's findings as structs (start, kind, end), by start, then kind."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[tuple]] = [[] for _ in range(batch.num_rows)]
            for row, text, matches, others in findings(*utf8(batch.column(1))):
                if others and sent.value is not None:
                    score = sent.value.score(np.array([window(text, s, e) for s, _, e in others]))
                    matches = sorted([*matches, *(o for o, p in zip(others, score) if p >= sent.value.threshold)])
                out[row] = matches
            spans = [[{"start": s, "kind": k, "end": e} for s, k, e in x] for x in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    batches_of(docs.sparkSession)
    return (docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
            .mapInArrow(task, "doc_id long, spans array<struct<start: long, kind: int, end: long>>"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the patterns' spans, and all spans as text."""
    names = F.array(*(F.lit(k) for k in KINDS))

    def count(kind: int) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
