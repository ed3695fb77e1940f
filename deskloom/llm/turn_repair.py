"""Repair of a conversation's structure by alignment to a grammar of alternating turns.

A repaired conversation is empty or an optional system turn and one or more (user, assistant)
pairs. Its turns are aligned to every target string of that grammar by Wagner and Fischer's
recurrence, with Keep, Rerole, Delete and Insert as edits. All targets end alike, so the table is
filled from the end: column j stands for the last j turns of a target, and one table serves every
feasible length; a target with a system turn meets the table behind the turn kept for it.

Ukkonen's band: a quick repair gives the incumbent cost, and a cell from which the surplus of turns
to delete or insert alone would cost more is never filled; the same bound cuts the lengths. Each
cell remembers which edits reach its cost, each length of least cost is traced back to its least
audit, and the audits are compared.

Turns are dealt by conversation, sorted, and read as a stream; a task holds one conversation at a
time. That is no bound by this module's choice: the result has an audit letter per turn and the
repaired turns in one row, so a conversation must fit a row.

Defined results: a null role or text is an empty string; turns are in order of turn number (nulls
first), then role and text, then ``again``; turns without a visible character and repeats of an
earlier (role, text) are always deleted; a role counts by its first
character, any other than s, u and a fits no target; a conversation without a turn gives zeros, an
empty audit and no repaired turns; a null conversation id is an id like any other; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.llm.common import pick

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = (".", "!", "?")
FAR = 1 << 40
NAMES = {"s": "system", "u": "user", "a": "assistant"}
D, I, K, R = 1, 2, 4, 8


def faults(turns: list[tuple[str, str]]) -> list[str]:
    """The first fault of each (role, text): blank, duplicate, truncated or none."""
    seen: set[tuple[str, str]] = set()
    out = []
    for turn in turns:
        if not VISIBLE.search(turn[1]):
            out.append("blank")
        elif turn in seen:
            out.append("duplicate")
        else:
            out.append("" if turn[1].rstrip(SPACE).endswith(ENDS) else "truncated")
        seen.add(turn)
    return out


def incumbent(initials: str, gone: list[bool], extra: list[int]) -> int:
    """The cost of a quick repair: the better of deleting all turns and walking through them once,
    where a turn out of place is given the wanted role if the next one then fits, else what is
    missing before it is inserted."""
    left = [i for i in range(len(initials)) if not gone[i]]
    cost = DELETE * (len(initials) - len(left)) + sum(extra[i] for i in left)
    if left and initials[left[0]] == "s":
        left = left[1:]
        cost += 0 if left else 2 * INSERT
    wanted = "u"
    for at, i in enumerate(left):
        other = "a" if wanted == "u" else "u"
        following = initials[left[at + 1]] if at + 1 < len(left) else ""
        if initials[i] == wanted:
            wanted = other
        elif initials[i] == other and following != other:
            cost += INSERT
        else:
            cost += REROLE
            wanted = other
    cost += INSERT if wanted == "a" else 0
    return min(cost, DELETE * len(initials))


def align(initials: str, gone: list[bool], extra: list[int]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; of equal ones the least audit. ``initials``: first
    characters of the roles, any single character where there is none; ``gone``: turns that must
    be deleted; ``extra``: what a turn costs that stays."""
    n = len(initials)
    most = incumbent(initials, gone, extra)
    below, above = most // DELETE, most // INSERT
    width = below + above + 1
    places = np.arange(width)
    ramp = INSERT * places
    # column d of row i stands for j = (n - i) - below + d target turns
    row = np.where(places >= below, INSERT * (places - below), FAR)
    edits = np.zeros((n, width), np.uint8)
    led: list[tuple[int, np.ndarray]] = []  # rows behind a system turn that may be kept
    for i in range(n - 1, -1, -1):
        if initials[i] == "s" and not gone[i] and DELETE * i <= most:
            led.append((i, row))
        j = n - i - below + places
        deleted = DELETE + np.append(row[1:], FAR)
        if gone[i]:
            base = matched = deleted
        else:
            # the last target turn, j = 1, is an assistant's; with one more it is a user's turn
            fits = (j % 2 == 1) if initials[i] == "a" else (j % 2 == 0) if initials[i] == "u" else np.zeros(width, bool)
            matched = np.where(j > 0, extra[i] + np.where(fits, 0, REROLE) + row, FAR)
            base = np.minimum(deleted, matched)
        base = np.where(j >= 0, base, FAR)
        row = np.minimum(np.minimum.accumulate(base - ramp) + ramp, FAR)
        marks = (row == deleted) * D
        if not gone[i]:
            marks = marks + (row == matched) * np.where(fits, K, R)
        marks[1:] += (row[1:] == row[:-1] + INSERT) * (j[1:] > 0) * I
        edits[i] = marks
    # targets: (first kept system turn or none, remaining length), by cost
    best, ends = most, []
    for d in range(width):
        length = n - below + d
        if length >= 0 and length % 2 == 0 and row[d] <= best:
            if row[d] < best:
                best, ends = int(row[d]), []
            ends.append((None, length))
    for i, behind in led:
        for d in range(width):
            length = n - i - 1 - below + d
            cost = DELETE * i + extra[i] + int(behind[d])
            if length >= 2 and length % 2 == 0 and cost <= best:
                if cost < best:
                    best, ends = cost, []
                ends.append((i, length))
    audits = []
    for lead, j in ends:
        trail = []
        i = 0
        if lead is not None:
            trail.append("D" * lead + "K")
            i = lead + 1
        while i < n:
            mark = edits[i, j - (n - i) + below]
            if mark & D:
                trail.append("D")
                i += 1
            elif mark & I:
                trail.append("I")
                j -= 1
            else:
                trail.append("K" if mark & K else "R")
                i, j = i + 1, j - 1
        audits.append("".join(trail) + "I" * j)
    return best, min(audits)


def apply_audit(turns: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired turns; the audit and the grammar say which role is due where."""
    out: list[tuple[str, str]] = []
    at, due = 0, "u"
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = turns[at]
        else:
            role, text = NAMES[due], "" if edit == "I" else turns[at][1]
        at += edit != "I"
        out.append((role, text))
        due = "u" if edit == "K" and role[:1] == "s" else "a" if due == "u" else "u"
    return out


def gaps(numbers: list[int | None]) -> int:
    known = {x for x in numbers if x is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def repair(turns: list[tuple[int | None, str, str]]) -> dict:
    """All outputs for the ordered (turn, role, text) of one conversation."""
    said = [t[1:] for t in turns]
    kinds = faults(said)
    initials = "".join(role[:1] or " " for role, _ in said)
    cost, audit = align(initials, [k in ("blank", "duplicate") for k in kinds], [TRUNCATED * (k == "truncated") for k in kinds])
    return {
        "gaps": gaps([t[0] for t in turns]),
        **{kind: kinds.count(kind) for kind in ("blank", "duplicate", "truncated")},
        "illegal": sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1)),
        "cost": cost,
        "audit": audit,
        "repaired": apply_audit(said, audit),
    }


def repair_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    again_col: str | None = None,
    present_col: str | None = None,
) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) per conversation,
    ``repaired`` as an array of (role, text). ``again_col`` orders equal turns; a row whose
    ``present_col`` is false is no turn and only makes its conversation known."""
    source = pick(
        turns,
        conv_id=conv_col,
        turn=turn_col,
        role=role_col,
        text=text_col,
        again=again_col or turn_col,
        present=present_col or conv_col,
    )
    source = source.withColumn("turn", F.col("turn").cast("long"))
    source = source.withColumn("present", F.coalesce("present", F.lit(False)) if present_col else F.lit(True))
    for c in ("role", "text"):
        source = source.withColumn(c, F.coalesce(c, F.lit("")))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    said = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(ids: list, found: list[dict], kind: pa.DataType) -> pa.RecordBatch:
            columns = [pa.array(ids, kind)] + [pa.array([f[c] for f in found], pa.int64()) for c in counts]
            columns.append(pa.array([f["audit"] for f in found], pa.string()))
            columns.append(pa.array([[{"role": r, "text": t} for r, t in f["repaired"]] for f in found], said))
            return pa.RecordBatch.from_arrays(columns, ["conv_id", *counts, "audit", "repaired"])

        current, held, begun, kind = None, [], False, None
        for batch in batches:
            kind = batch.column(0).type
            done: list = []
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)))
            for conv, turn, role, text, present in rows:
                if begun and conv != current:
                    done.append((current, repair(held)))
                    held = []
                current, begun = conv, True
                if present:
                    held.append((turn, role, text))
            if done:
                yield rows_of([d[0] for d in done], [d[1] for d in done], kind)
        if begun:
            yield rows_of([current], [repair(held)], kind)

    kind = source.schema["conv_id"].dataType.simpleString()
    dealt = source.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "again")
    return dealt.select("conv_id", "turn", "role", "text", "present").mapInArrow(
        run, f"conv_id {kind}, {', '.join(f'{c} bigint' for c in counts)}, audit string, repaired array<struct<role:string,text:string>>"
    )
