import hashlib
import itertools
import random
import re
import zlib

import pytest

from siteledger.llm.common import read_table
from siteledger.llm.conversation_repair import FINAL, SuffixAutomaton, audit, before, damaged, repair
from siteledger.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, plan string, gone int"
LEGAL = re.compile(r"(s?(ua)+)?").fullmatch
NONE = hashlib.sha256().hexdigest()


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def harmed(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out.setdefault(conv, [])
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub("[.!?]", "", text)
        if harm == 4:
            role = "user"
        kept += [(turn, role, text)] * (0, 1, 1, 2, 1)[harm if harm < 5 else 1]
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1], r[2]))) for c, v in out.items()}


def faults(turns):
    out, seen = [], set()
    for _, role, text in turns:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(turns, most=3):
    """All edit scripts with up to ``most`` insertions between turns, by brute force: (cost, audit, lines)."""
    found = faults(turns)
    ways = [(0, "", "", [])]  # cost, audit, initials, lines
    inserts = [p for n in range(most + 1) for p in itertools.product(("user", "assistant"), repeat=n)]

    def prefix(initials):
        return any(LEGAL(initials + tail) for tail in ("", "a", "ua"))

    def with_inserts(ways):
        for cost, edits, initials, lines in ways:
            for names in inserts:
                new = initials + "".join(n[0] for n in names)
                if prefix(new):
                    yield cost + 3 * len(names), edits + "I" * len(names), new, lines + [f"{n}:" for n in names]

    for (_, role, text), fault in zip(turns, found, strict=True):
        after = []
        for cost, edits, initials, lines in with_inserts(ways):
            after.append((cost + 4, edits + "D", initials, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                choices = [("K", 0, role)] if role else []
                for letter, price, name in [*choices, ("R", 3, "user"), ("R", 3, "assistant")]:
                    if prefix(initials + name[0]):
                        after.append((cost + price + more, edits + letter, initials + name[0], [*lines, f"{name}:{text}"]))
        best = {}  # what comes later depends on the initials only through whether they are empty and their end
        for way in after:
            key = (way[2][-1:], len(way[2]) > 0)
            best[key] = min(best.get(key, way), way)
        ways = list(best.values())
    cost, edits, _, lines = min(w for w in with_inserts(ways) if LEGAL(w[2]))
    return cost, edits, lines


def plain(rows):
    out = []
    for conv, turns in harmed(rows).items():
        found, numbers = faults(turns), {t[0] for t in turns} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [t[1][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, edits, lines = cheapest(turns)
        out.append((conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r)[:9] for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(4)


def drawn(n=400, seed=6):
    draw = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(draw.choice([1, 2, 3, 4, 9])):
            role = draw.choice(["user", "assistant"]) if draw.random() < 0.5 else ("user", "assistant")[turn % 2]
            role = draw.choice(["system", "tool", "", None, "User", "user"]) if draw.random() < 0.25 else role
            text = draw.choice(["Yes.", "No!", "so", "What? \n", " ", "é", None, "..", "a.b"])
            rows.append((conv, draw.choice([turn, turn * 2, None]) if draw.random() < 0.2 else turn, role, text))
    return rows


def test_brute_force(spark):
    rows = drawn()
    got, expected = result(repair(damaged(frame(spark, rows)))), plain(rows)
    assert got == expected
    assert {e for r in got for e in r[7]} == set("DIKR")


def test_every_short_signature():
    """The automaton against all edit scripts, for every signature of up to four symbols."""
    automaton, seen = SuffixAutomaton(), 0
    names = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    texts = itertools.count()
    signatures = ["".join(p) for n in range(4) for p in itertools.product("suaoSUAOx", repeat=n)]
    for reverse in sorted(signatures):
        way = automaton.add(reverse)[0]
        turns = [(0, names.get(c.lower(), "user"), "" if c == "x" else f"{next(texts)}" + ("" if c.isupper() else ".")) for c in reversed(reverse)]
        assert (way[0], audit(way)) == cheapest(turns)[:2]
        seen += 1
    assert automaton.made == seen - 1  # one node for each suffix, the empty one is there from the start


def test_nodes_are_shared_between_signatures():
    automaton = SuffixAutomaton()
    for reverse in sorted(s[::-1] for s in ("suaua", "uaua", "aua", "Saua")):
        automaton.add(reverse)
    assert automaton.made == 6  # a, ua, aua, uaua, suaua and Saua
    assert before("a", FINAL)[2] == (0, ("K", None))


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, None, None, None), (1, 0, "user", "x" * 100_000 + "."), (2, 5, "", "?"), (2, -(2**40), "assistant", "ok.")]
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "never seen"))
    rows += [(5000, 1, "user", "the same.")] * 300
    got = result(repair(damaged(frame(spark, rows))))
    assert got == plain(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", NONE) in got
    assert repair(damaged(frame(spark, rows).limit(0))).count() == 0


def test_long_conversation(spark):
    rows = [(100, k, ("user", "assistant")[k % 2], f"{k}.") for k in range(20_000)]
    (row,) = repair(damaged(frame(spark, rows))).collect()
    assert len(row.audit) > 19_000 and row.blank > 900 and row.duplicate > 900


@pytest.mark.parametrize("name", ["op11_conversation_repair"])
def test_whole_table(spark, sf_dir, name):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in read_table(spark, sf_dir, "conversations").collect()]
    assert result(QUERIES[name](spark, sf_dir)) == plain(rows)
