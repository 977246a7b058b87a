"""op13: the search against exhaustive enumeration, and the query against a plain version."""

import hashlib
import itertools
import re
import zlib

from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tipoff.llm import dialogue
from tipoff.llm.queries import QUERIES, table

CONV = "conv_id long, turn long, role string, text string"


def fits(initials):
    """Whether some choice of u or a for every ``?`` matches (s?(ua)+)?."""
    states = {0}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    for c in initials:
        states = {step[(q, x)] for q in states for x in ("ua" if c == "?" else c) if (q, x) in step}
    return bool(states & {0, 3})


def exhaustive(initials, fault, inserts=2):
    """Every edit sequence with up to ``inserts`` inserts before each row and at the end."""
    best = None
    n = len(initials)
    choices = [["D"] if fault[i] in ("blank", "duplicate") else ["D", "K", "R"] for i in range(n)]
    for edits in itertools.product(*choices):
        for gaps in itertools.product(range(inserts + 1), repeat=n + 1):
            audit, out, cost = "", "", 0
            for i in range(n + 1):
                audit += "I" * gaps[i]
                out += "?" * gaps[i]
                cost += 5 * gaps[i]
                if i == n:
                    break
                e = edits[i]
                audit += e
                extra = 5 if fault[i] == "truncated" and e != "D" else 0
                cost += {"D": 2, "K": extra, "R": 1 + extra}[e]
                out += {"D": "", "K": initials[i], "R": "?"}[e]
            if fits(out) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "", "blank", "duplicate", "truncated"])), max_size=4))
@settings(max_examples=150, deadline=None)
def test_search_equals_enumeration(rows):
    initials, fault = [r[0] for r in rows], [r[1] for r in rows]
    cost, audit, _ = dialogue.repair(initials, fault)
    assert (cost, audit) == exhaustive(initials, fault)


def test_long_conversation_is_repaired():
    """540 rows with many role faults: the search ends, and its edits give its cost and the pattern."""
    initials = list("suuaaxsua" * 60)
    fault = ["", "truncated", "", "", "duplicate", "", "", "blank", ""] * 60
    cost, audit, rows = dialogue.repair(initials, fault)
    assert audit.count("D") + audit.count("K") + audit.count("R") == len(initials)
    rows_iter, roles, paid = iter(range(len(initials))), [], 0
    for e in audit:
        if e == "I":
            paid += 5
            continue
        i = next(rows_iter)
        paid += {"D": 2, "K": 0, "R": 1}[e] + (5 if e != "D" and fault[i] == "truncated" else 0)
    roles = [(r or initials[i])[0] for i, r in rows]
    assert cost == paid and fits("".join(roles))


def plain(rows):
    """The contract step by step in Python."""
    out = {}
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if d == 0:
            continue
        text = "" if d == 1 else re.sub(r"[.!?]", "", text) if d == 2 else text
        role = "user" if d == 4 else role
        convs[conv] += [(turn, role, text)] * (2 if d == 3 else 1)
    for conv, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [r[0] for r in got if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        roles, texts = [r[1] for r in got], [r[2] for r in got]
        fault = dialogue.faults(roles, texts)
        initials = [r[:1] for r in roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = dialogue.repair(initials, fault)
        lines = [f"{(r or roles[i]) if i >= 0 else r}:{texts[i] if i >= 0 else ''}" for i, r in kept]
        counts = [fault.count(x) for x in ("blank", "duplicate", "truncated")]
        out[conv] = (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return sorted(out.values(), key=lambda t: (t[0] is not None, t[0] or 0))


def collected(df):
    return sorted((tuple(r) for r in df.select(*dialogue.RESULT_COLUMNS).collect()), key=lambda t: (t[0] is not None, t[0] or 0))


def test_given_conversations(spark):
    rows = [tuple(r) for r in table(spark, DATA, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = collected(QUERIES["op13_conversation_repair"](spark, DATA))
    assert got == plain(rows)
    assert len({r[0] for r in rows}) == len(got)


def test_edges(spark):
    rows = [
        (1, 1, "system", "Be kind."), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."), (1, None, None, None),
        (1, 5, "assistant", "cut off"), (2, None, "", "x."), (None, 3, "user", "Null id."), (3, 1, "user", "   "),
        (4, 7, "assistant", "A" * 50_000 + "."), (5, 1, "tool", "t."),
    ] + [(6, t, "user" if t % 2 else "assistant", f"Turn {t % 4}.") for t in range(400)]
    df = spark.createDataFrame(rows, CONV)
    for name in ("audit", "cost", "gaps", "_damage", "_copy", "_null_turn", "text_2"):
        df = df.withColumn(name, F.lit(1))
    got = collected(dialogue.with_all_ids(df, dialogue.repaired(dialogue.damaged(df))))
    assert got == plain(rows)
    assert dialogue.with_all_ids(df.limit(0), dialogue.repaired(dialogue.damaged(df.limit(0)))).count() == 0


def test_conversation_without_rows_after_damage(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 1, "user", "Gone.")], CONV)
    (row,) = collected(dialogue.with_all_ids(df, dialogue.repaired(dialogue.damaged(df))))
    assert row == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
