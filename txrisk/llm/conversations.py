"""Structure repair of conversations: the cheapest edits that leave turns of the roles ``(s?(ua)+)?``.

Every turn becomes one letter, its signature: the initial of its role (``s``, ``u``, ``a``, else ``o``; a capital if the
text is cut off), or ``x`` if it must go (blank, or a repetition).  Conversations are many, their signatures few: the
distinct ones are sorted from their ends and minimised into a suffix-shared automaton, whose nodes are the distinct
endings.  For each node and each of the four states of the grammar, the cost to the end and the best edits to the end are
worked out once, from those of the node that follows, for all conversations that end alike.

Edits: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or assistant turn 3; a cut-off turn that stays
costs 3 more.  Of equally cheap edits those whose initials come first in ASCII order are taken.  From a state each
letter leads one way only, so the least first letter among the cheapest decides.

Scale: turns are sorted by ranges of (conversation, turn), so a long conversation is dealt over many tasks and cut into
pieces of at most ``PIECE`` turns.  What follows a piece counts only by its four costs.  Of conversations with several
pieces, each distinct signature is solved for one possible exit state at a time, and a stream over the pieces from the
last to the first gives every piece its exit costs; pieces then are solved as (signature, exit costs) like all others.
Texts are shuffled twice, to meet their edits and to stand in their piece; everything else has small rows.  Only the
digest of a conversation of many pieces is one task's work, as a hash must be: it streams them.

Defined results: null role and text are one space, null turns come first, a null ``conv_id`` is one conversation; turns
with one number stand by role, then by the sha256 of role and text; of repeated rows all but one are repetitions; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from txrisk.llm.common import batches_of, written

#: Turns of a piece: 2^8.
PIECE_BITS = 8

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
CUT_OFF = 3

#: States: nothing yet, after s, after u, after a.  The role that each calls for, and the state after it.
CALLS = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
FINAL = (0, 3)
NEVER = 1 << 40

#: White space, and the end of a text that is not cut off.
INK, CLOSED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"

ROWS = "conv string, turn long, role string, text string"
SOLVED = "signature string, exit string, costs array<long>, plans array<string>, ends array<int>"


# --- grammar and automaton ----------------------------------------------------

class Node:
    """Costs, edits and last state from here to the end of the piece, for each state of the grammar.

    A plan has a letter per edit: ``D``, ``K``, ``U``/``A`` rerole and ``u``/``a`` insert (user or assistant).
    """

    __slots__ = ("costs", "plans", "ends")

    def __init__(self, costs: list[int], plans: list[str], ends: list[int]):
        self.costs, self.plans, self.ends = costs, plans, ends


def with_inserts(costs: list[int]) -> list[int]:
    """The costs if turns may be inserted first."""
    for _ in CALLS:
        costs = [min(c, COST[INSERT] + costs[AFTER[s]]) for s, c in enumerate(costs)]
    return costs


def exit_node(kind: str) -> Node:
    """What follows a piece: ``end``, ``only S`` (state S alone may follow, at no cost), or four costs."""
    if kind == "end":
        costs = with_inserts([0 if s in FINAL else NEVER for s in range(4)])
        plans = []
        for s in range(4):
            plan = ""
            while s not in FINAL:
                plan, s = plan + CALLS[s][0], AFTER[s]
            plans.append(plan)
        return Node(costs, plans, [3] * 4)
    if kind.startswith("only "):
        return Node([0 if s == int(kind[5:]) else NEVER for s in range(4)], [""] * 4, [0, 1, 2, 3])
    return Node([int(c) for c in kind.split(",")], [""] * 4, [0, 1, 2, 3])


def node_before(letter: str, after: Node) -> Node:
    """The node of a turn's signature letter and all that follows."""
    initial, extra = letter.lower(), CUT_OFF if letter.isupper() else 0
    ways: list[dict[str, tuple[int, str, int]]] = []
    for s in range(4):
        way = {DELETE: (COST[DELETE] + after.costs[s], DELETE, s)}
        if letter != "x":
            if initial == CALLS[s][0] or (s == 0 and initial == "s"):
                to = 1 if initial == "s" else AFTER[s]
                way[KEEP] = (COST[KEEP] + extra + after.costs[to], KEEP, to)
            way[REROLE] = (COST[REROLE] + extra + after.costs[AFTER[s]], CALLS[s][0].upper(), AFTER[s])
        ways.append(way)
    costs = with_inserts([min(c for c, _, _ in way.values()) for way in ways])
    plans, ends = [""] * 4, [0] * 4
    for s in sorted(range(4), key=costs.__getitem__):  # an insertion leads to a cheaper state, which is done before
        way = {**ways[s], INSERT: (COST[INSERT] + costs[AFTER[s]], CALLS[s][0], AFTER[s])}
        if costs[s] < NEVER:
            kind = min(k for k, (c, _, _) in way.items() if c == costs[s])
            _, sign, to = way[kind]
            plans[s] = sign + (plans[to] if kind == INSERT else after.plans[to])
            ends[s] = ends[to] if kind == INSERT else after.ends[to]
    return Node([min(c, NEVER) for c in costs], plans, ends)


def solve(signatures: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, Node]]:
    """The first node of every (signature, exit).  Neighbours share the nodes of their common ending, so sorted from the
    end (and by exit) each node is made once."""
    last_exit, last, path = None, "", []
    for signature, kind in signatures:
        turned, same = signature[::-1], 0
        if kind != last_exit:
            path = [exit_node(kind)]
        else:
            while same < min(len(turned), len(last)) and turned[same] == last[same]:
                same += 1
            del path[same + 1:]
        for letter in turned[same:]:
            path.append(node_before(letter, path[-1]))
        last_exit, last = kind, turned
        yield signature, kind, path[-1]


def solved(needed: DataFrame) -> DataFrame:
    """(signature, exit, costs, plans, ends) of every distinct (signature, exit) in ``needed``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[str, str]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        held = []
        for signature, kind, node in solve(pairs()):
            held.append((signature, kind, node.costs, list(node.plans), node.ends))
            if len(held) == 1000:
                yield _batch(held, SOLVED_ARROW)
                held = []
        if held:
            yield _batch(held, SOLVED_ARROW)

    order = [F.col("exit"), F.reverse("signature")]
    distinct = needed.select("signature", "exit").distinct()
    return written(distinct.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(task, SOLVED), "automaton")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


SOLVED_ARROW = pa.schema([("signature", pa.string()), ("exit", pa.string()), ("costs", pa.list_(pa.int64())),
                          ("plans", pa.list_(pa.string())), ("ends", pa.list_(pa.int32()))])


# --- turns and pieces ---------------------------------------------------------

def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text) with nulls as defined; ``conv`` is the id as text, empty for null."""
    space = F.lit(" ")
    return conversations.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("conv"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))


def damage(turns: DataFrame) -> DataFrame:
    """Damage by ``crc32(conv_id:turn) % 20``: 0 drops the turn, 1 empties it, 2 takes its ``[.!?]``, 3 repeats it, 4 makes it the user's."""
    key = F.concat(F.when(F.col("conv") == "", " ").otherwise(F.col("conv")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    lot = F.col("lot")
    return (turns.withColumn("lot", F.crc32(key.cast("binary")) % 20).filter(lot != 0)
            .select("conv", "turn", F.when(lot == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(lot == 1, "").when(lot == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.when(lot == 3, 2).otherwise(1).alias("copies")))


def _digest() -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256), 1, 32))


def signed_turns(turns: DataFrame) -> DataFrame:
    """One small row per turn in the order of conversations: (conv, turn, digest, initial, blank, cut, place).

    ``turns`` may have a number of ``copies``.  Places ascend in the order; those of a conversation in one task are adjacent.
    """
    spark = turns.sparkSession
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    small = turns.select("conv", "turn", "role", _digest().alias("digest"), F.substring("role", 1, 1).alias("initial"),
                         (~F.col("text").rlike(INK)).alias("blank"), (~F.col("text").rlike(CLOSED)).alias("cut"),
                         F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = small.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(dealt.drop("role").withColumn("place", F.monotonically_increasing_id()), "turns")


def pieces_of(signed: DataFrame) -> DataFrame:
    """One row per piece of a conversation: its signature, the digests of its turns and its counts."""
    first = signed.groupBy("conv", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    seen = F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    kind = F.when(F.col("blank"), "blank").when(seen, "duplicate").when(F.col("cut"), "truncated")
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    marked = (signed.join(first, ["conv", "digest"], "left").withColumn("fault", kind)
              .withColumn("letter", F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)))
    row = F.struct("place", "letter", "initial", "turn", "digest")
    grouped = (marked.groupBy("conv", F.shiftright("place", PIECE_BITS).alias("piece"))
               .agg(F.sort_array(F.collect_list(row)).alias("rows"), *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
                    F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn")))
    turns = F.size(F.array_distinct(F.filter("rows.turn", lambda t: t.isNotNull()))).cast("long")
    legal = F.transform("initials", lambda x, i: F.concat(x, F.coalesce(F.get("initials", i + 1), F.lit(""))).isin("su", "ua", "au"))
    return written(
        grouped.withColumn("initials", F.col("rows.initial"))
        .select("conv", "piece", F.array_join("rows.letter", "").alias("signature"), F.col("rows.digest").alias("digests"), "blank", "duplicate", "truncated",
                "first_turn", "last_turn", turns.alias("turns"), F.get("initials", F.lit(0)).alias("head"), F.element_at("initials", -1).alias("tail"),
                (F.size("initials") - 1 - F.size(F.filter(legal, lambda x: x))).cast("long").alias("illegal")), "pieces")


# --- plans --------------------------------------------------------------------

def _streamed(pieces: DataFrame, columns: list[str], backwards: bool, start: Callable, move: Callable, schema: str) -> DataFrame:
    """A value carried along the pieces of each conversation: ``move(value, row)`` gives what is returned and the next value."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, value = None, None
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    conv, value = row["conv"], start()
                out, value = move(value, row)
                made.append((conv, row["piece"], out))
            kind = pa.string() if "string" in schema.split(",")[-1] else pa.int32()
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), (pa.string(), pa.int64(), kind))], names)

    names = [c.split()[0] for c in schema.split(", ")]
    order = F.col("piece").desc() if backwards else F.col("piece")
    return pieces.select("conv", "piece", *columns).repartition("conv").sortWithinPartitions("conv", order).mapInArrow(task, schema)


def plans_of(pieces: DataFrame) -> DataFrame:
    """(conv, piece, whole, plan, cost): the cheapest edits of every piece; ``whole`` if it is all of its conversation."""
    of_conv = Window.partitionBy("conv").orderBy("piece")
    placed = written(pieces.select("conv", "piece", "signature", F.lag("piece").over(of_conv).isNull().alias("first"),
                                   F.lead("piece").over(of_conv).isNull().alias("last")), "placed")
    several = placed.filter("NOT (first AND last)")
    exits = written(_exits(several), "exits")
    ending = placed.join(exits, ["conv", "piece"], "left").withColumn("exit", F.coalesce("exit", F.lit("end")))
    ending = written(ending, "ending")
    whole = ending.join(solved(ending), ["signature", "exit"])
    entered = _streamed(whole.filter("NOT (first AND last)"), ["ends"], False, lambda: 0, lambda s, row: (s, row["ends"][s]), "conv string, piece long, state int")
    state = F.coalesce("state", F.lit(0))
    at_exit = F.when(F.col("last"), 0).otherwise(F.get(F.split("exit", ","), F.get("ends", state)).try_cast("long"))
    return (whole.join(entered, ["conv", "piece"], "left")
            .select("conv", "piece", (F.col("first") & F.col("last")).alias("whole"), F.get("plans", state).alias("plan"), (F.get("costs", state) - at_exit).alias("cost")))


def _exits(several: DataFrame) -> DataFrame:
    """(conv, piece, exit) of the pieces that another follows: the four costs of what follows, less their least."""
    kinds = F.when(F.col("last"), F.array(F.lit("end"))).otherwise(F.array(*(F.lit(f"only {s}") for s in range(4))))
    needed = several.filter("NOT first").select("conv", "piece", "signature", F.explode(kinds).alias("exit"))
    ways = needed.join(solved(needed), ["signature", "exit"]).groupBy("conv", "piece").agg(F.sort_array(F.collect_list(F.struct("exit", "costs"))).alias("ways"))
    rows = several.join(ways, ["conv", "piece"], "left")

    def move(after: list[int] | None, row: dict) -> tuple[str, list[int] | None]:
        kind = "end" if after is None else ",".join(map(str, after))
        if row["ways"] is None:  # the first piece
            return kind, None
        ways = [w["costs"] for w in row["ways"]]
        costs = ways[0] if after is None else [min(ways[t][s] + after[t] for t in range(4)) for s in range(4)]
        return kind, [c - min(costs) for c in costs]

    return _streamed(rows, ["ways"], True, lambda: None, move, "conv string, piece long, exit string")


# --- results ------------------------------------------------------------------

def repaired(turns: DataFrame, pieces: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv, piece, whole, line, role, text): the turns that remain, in order of piece and line; a line may come twice."""
    sign = F.substring("plan", F.col("pos") + 1, F.lit(1))
    edits = (pieces.select("conv", "piece", "digests").join(plans, ["conv", "piece"])
             .select("*", F.explode(F.sequence(F.lit(0), F.length("plan") - 1)).alias("pos")).filter(F.length("plan") > 0)
             .withColumn("sign", sign).filter(F.col("sign") != DELETE)
             .withColumn("row", F.length(F.translate(F.substring("plan", F.lit(1), F.col("pos")), "ua", "")))
             .select("conv", "piece", "whole", F.col("pos").alias("line"), "sign", F.when(~F.col("sign").isin("u", "a"), F.get("digests", F.col("row"))).alias("digest")))
    edits = written(edits, "edits")
    role = F.when(F.lower("sign") == "u", "user").when(F.lower("sign") == "a", "assistant").otherwise(F.col("role"))
    stay = (edits.filter("digest IS NOT NULL").join(turns.select("conv", "role", "text", _digest().alias("digest")), ["conv", "digest"])
            .select("conv", "piece", "whole", "line", role.alias("role"), "text"))
    inserted = edits.filter("digest IS NULL").select("conv", "piece", "whole", "line", F.when(F.col("sign") == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text"))
    return stay.unionByName(inserted)


def digests(repaired_turns: DataFrame) -> DataFrame:
    """(conv, sha256) of the ``role:text`` lines of every conversation that has any, joined by line breaks."""
    line = F.struct("line", F.concat("role", F.lit(":"), "text").alias("content"))
    joined = (repaired_turns.groupBy("conv", "piece", "whole").agg(F.sort_array(F.collect_set(line)).alias("lines"))
              .withColumn("content", F.array_join("lines.content", "\n"))
              .select("conv", "piece", F.when(F.col("whole"), F.sha2("content", 256)).alias("sha256"), F.when(~F.col("whole"), F.col("content")).alias("content")))
    joined = written(joined, "joined")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            made = []
            for key, content in zip(batch.column(0).to_pylist(), batch.column(2)):
                if key != conv:
                    if state is not None:
                        made.append((conv, state.hexdigest()))
                    conv, state = key, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(content.as_buffer())
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*made)], ["conv", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], ["conv", "sha256"])

    batches_of(repaired_turns.sparkSession, 100)
    long = joined.filter("sha256 IS NULL").select("conv", "piece", "content").repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(task, "conv string, sha256 string")
    return joined.filter("sha256 IS NOT NULL").select("conv", "sha256").unionByName(long)


def report(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """Faults, cost, edits and digest of every conversation in ``conversations``, repaired from ``turns``."""
    pieces = pieces_of(signed_turns(turns))
    plans = written(plans_of(pieces), "plans")
    of_conv = Window.partitionBy("conv").orderBy("piece")
    before = lambda c: F.lag(c).over(of_conv)
    known = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pair = F.concat(before("tail"), F.col("head"))
    facts = (pieces.withColumn("broken", F.when(pair.isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0))
             .withColumn("shared", F.when(F.max("last_turn").over(known) == F.col("first_turn"), 1).otherwise(0)))
    own = (facts.join(plans, ["conv", "piece"]).groupBy("conv")
           .agg((F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("turns") - F.col("shared"))).alias("gaps"),
                *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.sum(F.col("illegal") + F.col("broken")).alias("illegal"),
                F.sum("cost").alias("cost"), F.array_join(F.sort_array(F.collect_list(F.struct("piece", "plan")))["plan"], "").alias("plan")))
    ids = turns_of(conversations).select("conv").distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (ids.join(own, "conv", "left").join(digests(repaired(turns, pieces, plans)), "conv", "left")
            .select(F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id"),
                    *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                    F.translate(F.coalesce("plan", F.lit("")), "uaUA", INSERT * 2 + REROLE * 2).alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
