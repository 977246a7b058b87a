"""Conversation structure repair by iterative-deepening A* (op13).

Rows of a conversation are taken by turn (null first; equal turns by role, then text). Each row
gets at most one fault, the first that holds: blank (no character outside white space), duplicate
(the same role and text earlier in the conversation), truncated (its last character outside white
space is not one of ``.!?``). A repair turns the rows into a sequence whose role initials match
``(s?(ua)+)?`` with the edits Keep (0), Rerole to user or assistant (1), Delete (2, the only edit of
a blank or duplicate row) and Insert an empty user or assistant row anywhere (5); a truncated row
that stays costs 5 more.

The search runs over states (next row, place in the pattern). Depth-first, it tries the edits in
ASCII order of their initials (D, I, K, R) and cuts every path whose cost plus a lower bound of the
rest (2 for every remaining row that must go or is truncated) passes the current bound; the bound
starts at the lower bound of the start and rises to the least cut value until a path ends with all
rows used in an accepting place. That first path is the cheapest, and of the cheapest the one
whose edit initials are least in ASCII order. States that failed under some remaining budget are
kept and not searched again with that budget or less.

Spark plan: the damage of the contract and the role and text rules are SQL expressions; each
conversation is one group of an ``applyInPandas`` holding its rows' roles and texts (a repair is a
sequential search over the whole conversation, so a conversation is not split); conversations
that lose all rows come back from the distinct ids with zeros.

Edge cases: a null role or text is one space (a blank row, initial ``' '``); an empty role has no
initial and never fits; repeated rows are duplicates after the first; a null conversation id is a
conversation of its own; an empty table gives no rows; very long texts are hashed whole; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed: edit costs, the extra cost of a kept truncated row, and the legal adjacent initials.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL_PAIRS = ("su", "ua", "au")
_VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
_LAST_VISIBLE = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

# The pattern (s?(ua)+)? as states: 0 start, 1 after s, 2 after u, 3 after a; 0 and 3 accept.
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ACCEPT = (0, 3)
_NEXT_ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def faults(roles: list[str], texts: list[str]) -> list[str]:
    """First fault of each row: ``blank``, ``duplicate``, ``truncated`` or ``""``."""
    seen, out = set(), []
    for role, text in zip(roles, texts):
        if not _VISIBLE.search(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            last = _LAST_VISIBLE.search(text)
            out.append("truncated" if last.group(1) not in ".!?" else "")
        seen.add((role, text))
    return out


def repair(initials: list[str], fault: list[str]) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost, edit initials and repaired rows (row index or -1 for an insert, role or "" to keep)."""
    n = len(initials)
    if not n:
        return 0, "", []
    floor = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        floor[i] = floor[i + 1] + (DELETE if fault[i] else 0)

    def moves(i: int, q: int):
        if i < n:
            yield "D", DELETE, i + 1, q, None
        role = _NEXT_ROLE[q]
        yield "I", INSERT, i, _STEP[(q, role[0])], role
        if i < n and fault[i] not in ("blank", "duplicate"):
            extra = TRUNCATED if fault[i] == "truncated" else 0
            kept = _STEP.get((q, initials[i]))
            if kept is not None:
                yield "K", KEEP + extra, i + 1, kept, ""
            yield "R", REROLE + extra, i + 1, _STEP[(q, role[0])], role

    failed: dict[tuple[int, int], int] = {}
    bound = floor[0]
    while True:
        over = None
        path: list[tuple[str, int, str | None]] = []
        stack = [(0, 0, 0, moves(0, 0))]
        while stack:
            i, q, g, options = stack[-1]
            step = next(options, None)
            if step is None:
                failed[(i, q)] = max(failed.get((i, q), -1), bound - g)
                stack.pop()
                if path:
                    path.pop()
                continue
            letter, cost, j, r, role = step
            h = g + cost
            f = h + floor[j]
            if f > bound:
                over = f if over is None else min(over, f)
                continue
            path.append((letter, i, role))
            if j == n and r in _ACCEPT:
                audit = "".join(p[0] for p in path)
                rows = [(k if p[0] != "I" else -1, p[2]) for p in path for k in [p[1]] if p[0] != "D"]
                return h, audit, rows
            if failed.get((j, r), -1) >= bound - h:
                path.pop()
                continue
            stack.append((j, r, h, moves(j, r)))
        bound = over


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _conversation(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["_null_turn", "turn", "role", "text"], kind="stable")
    roles, texts = rows["role"].tolist(), rows["text"].tolist()
    turns = rows["turn"].dropna()
    gaps = int(turns.max() - turns.min() + 1 - turns.nunique()) if len(turns) else 0
    fault = faults(roles, texts)
    initials = [r[:1] for r in roles]
    illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
    cost, audit, kept = repair(initials, fault)
    lines = [f"{(role or roles[i]) if i >= 0 else role}:{texts[i] if i >= 0 else ''}" for i, role in kept]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = [sum(f == name for f in fault) for name in ("blank", "duplicate", "truncated")]
    return pd.DataFrame([[key[0], gaps, *counts, illegal, cost, audit, digest]], columns=RESULT_COLUMNS)


RESULT_COLUMNS = [c.split()[0] for c in RESULT.split(", ")]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the contract's damage: crc32 of ``conv_id:turn`` (nulls one space) mod 20 picks it."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(key) % 20).alias("_damage"),
    ).where("_damage != 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_damage") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_damage") == 1, F.lit(""))
        .when(F.col("_damage") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_damage") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def repaired(rows: DataFrame) -> DataFrame:
    """Fault counts, cheapest repair and its digest of every conversation of ``rows``."""
    ready = rows.withColumn("_null_turn", F.col("turn").isNotNull())
    return ready.groupBy("conv_id").applyInPandas(_conversation, RESULT)


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Repairs of every conversation of ``conversations`` after the contract's damage."""
    conversations = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return with_all_ids(conversations, repaired(damaged(conversations)))


def with_all_ids(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """Every original conversation id; those without rows after damage get zeros."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    joined = ids.join(found, ids["_id"].eqNullSafe(found["conv_id"]), "left")
    zeros = {c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in RESULT_COLUMNS[1:7]}
    return joined.select(
        F.col("_id").alias("conv_id"),
        *zeros.values(),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )
