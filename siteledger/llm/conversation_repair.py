"""Repair of conversation structure through a suffix-shared automaton of role and fault signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteledger.llm.common import saved, turn_digest

#: What an edit costs. A truncated turn that is not deleted costs as much again as an edit of its role.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Grammar states: nothing yet, behind system, behind user, behind assistant. Initial to next state, by state.
LEGAL = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: What an inserted or renamed turn becomes, by state, and the state behind it.
WANTED = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
#: Neighbouring initials that are as they should be.
PAIRS = ("su", "ua", "au")
#: A null stands for this.
BLANK = " "
SPACE = " \t\n\x0b\x0c\r"

_COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_SIGNED = f"conv_id bigint, signature string, {_COUNTS}"
_PLANNED = "signature string, cost bigint, audit string"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows as crc32 of `conv_id:turn` damages them; a dropped row stays as a mark."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(BLANK))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        part("role").alias("role"),
        part("text").alias("text"),
        (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20).alias("harm"),
    )
    harm = F.col("harm")
    text = F.when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).when(harm != 0, F.col("text"))
    copies = F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    role = F.when(harm == 4, "user").when(harm != 0, F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (harm == 0).alias("gone"), copies.alias("copy")).drop("copy")


def _symbol() -> Column:
    """A turn as the automaton reads it: x must go; the initial s, u, a or o for others; in capitals if truncated."""
    plain = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    return F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(plain)).otherwise(plain)


def _in_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("digest")]


def signatures(rows: DataFrame) -> DataFrame:
    """(conv_id, signature, gaps, blank, duplicate, truncated, illegal) of ``damaged`` rows; their texts do not move."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    slim = rows.select(
        "conv_id", "turn", "gone",
        F.substring("role", 1, 1).alias("initial"),
        F.when(F.col("gone"), None).when(F.ltrim(end, F.lit(SPACE)) == "", "blank").when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated").alias("ending"),
        turn_digest(F.col("role"), F.col("text")).alias("digest"),
    ).repartition("conv_id")
    nth = F.row_number().over(Window.partitionBy("conv_id", "gone", "digest").orderBy(F.col("turn").asc_nulls_first()))
    faulty = slim.withColumn("nth", nth).withColumn("fault", F.when(F.col("ending") == "blank", "blank").when((F.col("nth") > 1) & ~F.col("gone"), "duplicate").otherwise(F.coalesce("ending", F.lit(""))))
    ready = faulty.sortWithinPartitions("conv_id", *_in_order()).select("conv_id", "turn", "gone", "initial", "fault", _symbol().alias("symbol"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = object(), None

        def signed() -> tuple:
            return (now, "".join(state["signature"]), state["turns"] and state["high"] - state["low"] + 1 - state["turns"], state["blank"], state["duplicate"], state["truncated"], state["illegal"])

        for batch in batches:
            out: list[tuple] = []
            for conv, turn, gone, initial, fault, symbol in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "gone", "initial", "fault", "symbol")), strict=True):
                if conv != now:
                    if state is not None:
                        out.append(signed())
                    now, state = conv, {"signature": [], "turns": 0, "low": None, "high": None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "initial": None}
                if gone:
                    continue
                if turn is not None and turn != state["high"]:  # turns arrive in order
                    state["low"] = turn if state["low"] is None else state["low"]
                    state["high"], state["turns"] = turn, state["turns"] + 1
                if fault:
                    state[fault] += 1
                if state["initial"] is not None and state["initial"] + initial not in PAIRS:
                    state["illegal"] += 1
                state["initial"] = initial
                state["signature"].append(symbol)
            yield _batch(out, _SIGNED)
        if state is not None:
            yield _batch([signed()], _SIGNED)

    return ready.mapInArrow(sign, _SIGNED)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


#: A best way to the end from one state: its cost, and the audit as (edit, rest).
Way = tuple[int, tuple | None]
#: A node of the automaton: the best way from each grammar state.
Node = tuple[Way, Way, Way, Way]
#: The node of the empty suffix: a user without an answer gets one, a lone system turn gets a user and an answer.
FINAL: Node = ((0, None), (2 * INSERT, ("I", ("I", None))), (INSERT, ("I", None)), (0, None))


def _step(cost: int, edit: str, rest: Way) -> Way:
    return cost + rest[0], (edit, rest[1])


def _better(ways: list[Way]) -> Way:
    """The cheapest; of equal ones the least audit, which its first edit decides: the ways compared begin differently."""
    return min(ways, key=lambda way: (way[0], way[1][0]))


def before(symbol: str, node: Node) -> Node:
    """The node whose suffix is ``symbol`` and then ``node``'s."""
    initial, more = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    direct = []
    for state in range(4):
        ways = [_step(DELETE, "D", node[state])]
        if symbol != "x":
            ways.append(_step(REROLE + more, "R", node[WANTED[state][1]]))
            if initial in LEGAL[state]:
                ways.append(_step(more, "K", node[LEGAL[state][initial]]))
        direct.append(_better(ways))
    user = _better([direct[2], _step(INSERT, "I", direct[3])])
    return (
        _better([direct[0], _step(INSERT, "I", user)]),
        _better([direct[1], _step(INSERT, "I", user)]),
        user,
        _better([direct[3], _step(INSERT, "I", direct[2])]),
    )


class SuffixAutomaton:
    """Minimal acyclic automaton of signatures, read from the end: equal suffixes are one node.

    Fed with signatures in the order of their reversed text, it holds the one chain of nodes that
    the next signature can share. A node is made, with the costs and audits of its four states,
    when the first signature with its suffix arrives, and let go when none can follow.
    """

    def __init__(self):
        self.chain: list[Node] = [FINAL]
        self.last = ""
        self.made = 0

    def add(self, reverse: str) -> Node:
        """The node of a whole signature, given from its end."""
        same, most = 0, min(len(reverse), len(self.last))
        while same < most and reverse[same] == self.last[same]:
            same += 1
        del self.chain[same + 1 :]
        for symbol in reverse[same:]:
            self.chain.append(before(symbol, self.chain[-1]))
            self.made += 1
        self.last = reverse
        return self.chain[-1]


def audit(way: Way) -> str:
    out, rest = [], way[1]
    while rest is not None:
        edit, rest = rest
        out.append(edit)
    return "".join(out)


def plans(distinct: DataFrame) -> DataFrame:
    """(signature, cost, audit) for a table of distinct ``signature``."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton()
        for batch in batches:
            out = []
            for signature, reverse in zip(batch.column("signature").to_pylist(), batch.column("reverse").to_pylist(), strict=True):
                way = automaton.add(reverse)[0]
                out.append((signature, way[0], audit(way)))
            yield _batch(out, _PLANNED)

    ranged = distinct.withColumn("reverse", F.reverse("signature")).repartitionByRange("reverse").sortWithinPartitions("reverse")
    return ranged.select("signature", "reverse").mapInArrow(plan, _PLANNED)


class _Repair:
    """Replays a conversation's audit over its turns and hashes what comes out."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state, self.sha, self.lines = edits, 0, 0, hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.sha.update((f"\n{role}:{text}" if self.lines else f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _wanted(self, text: str) -> None:
        role, self.state = WANTED[self.state]
        self._line(role, text)

    def insert(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            self._wanted("")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self.insert()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "R":
            self._wanted(text)
        elif edit == "K":
            self.state = LEGAL[self.state][role[:1]]
            self._line(role, text)

    def digest(self) -> str:
        self.insert()
        return self.sha.hexdigest()


def repair(rows: DataFrame) -> DataFrame:
    """Cheapest edits that make each conversation's role initials read `(s?(ua)+)?`.

    ``rows`` is (conv_id, turn, role, text, gone) without nulls in role and text where ``gone`` is
    false; a row that is ``gone`` only says that there is such a conversation. Returns (conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, signature), one row
    per conversation.

    A conversation becomes a signature, one symbol a turn for initial and fault. Each distinct signature is
    planned once: sorted from their ends, signatures run through an automaton that shares suffixes;
    cost-to-go and best audit are computed once for each of its nodes and grammar states. Two neighbouring
    ranges of that order both make the nodes of the one suffix they share. Plans come back by
    signature, and the audit is replayed over the turns, which stream by in order and move once.

    Copies of a conversation are one signature, so they cost one plan; adaptive execution splits a
    hot signature in the join. A conversation of any length streams; what a task holds of it is a
    few hundred bytes a turn of its signature, never its texts.

    Turns are in order of number, nulls first; equal numbers in order of the digest of role and
    text. An empty role has no legal initial. A null conv_id is a conversation of its own.
    """
    signed = saved(signatures(rows), "signatures")
    planned = saved(plans(saved(signed.select("signature").distinct(), "distinct-signatures")), "plans")
    known = signed.join(planned, "signature")
    counts = [part.split()[0] for part in _COUNTS.split(", ")] + ["signature", "cost", "audit"]
    head = known.select("conv_id", F.struct(*counts).alias("plan"))
    # a conversation's plan comes before its turns
    texts = rows.where("NOT gone").select("conv_id", "turn", "role", "text", turn_digest(F.col("role"), F.col("text")).alias("digest"))
    both = head.unionByName(texts, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("plan").isNull(), *_in_order())
    schema = "conv_id bigint, repaired_sha256 string, " + ", ".join(f"{c} {'string' if c in ('signature', 'audit') else 'bigint'}" for c in counts)

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out: list[tuple] = []
            for conv, plan, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "plan", "role", "text")), strict=True):
                if plan is not None:
                    if now is not None:
                        out.append(now())
                    work = _Repair(plan["audit"])
                    now = lambda conv=conv, work=work, plan=plan: (conv, work.digest(), *plan.values())
                else:
                    work.turn(role, text)
            yield _batch(out, schema)
        if now is not None:
            yield _batch([now()], schema)

    done = ordered.select("conv_id", "plan", "role", "text").mapInArrow(replay, schema)
    return done.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "signature")
