import hashlib
import os
import random
import zlib
from functools import cache

import pytest

from deskloom.llm.turn_repair import align, apply_audit, faults, repair_conversations

SF = "/root/testdata/sf0.001"


def brute(initials, gone, extra):
    """Least (cost, audit) by walking the grammar's states: before, then user or assistant due."""

    @cache
    def best(i, state, inserts):
        options = []
        if i == len(initials) and state in ("before", "user"):
            options.append((0, ""))

        def then(cost, letter, i, state, inserts):
            found = best(i, state, inserts)
            if found:
                options.append((cost + found[0], letter + found[1]))

        due = {"before": ("u", "assistant"), "first": ("u", "assistant"), "user": ("u", "assistant"), "assistant": ("a", "user")}[state]
        if inserts:
            then(3, "I", i, due[1], inserts - 1)
        if i < len(initials):
            then(4, "D", i + 1, state, 3)
            if not gone[i]:
                if initials[i] == "s" and state == "before":
                    then(extra[i], "K", i + 1, "first", 3)
                if initials[i] == due[0]:
                    then(extra[i], "K", i + 1, due[1], 3)
                then(3 + extra[i], "R", i + 1, due[1], 3)
        return min(options) if options else None

    for i in range(len(initials), 0, -1):  # from the end, so that the recursion stays flat
        for state in ("before", "first", "user", "assistant"):
            best(i, state, 3)
    return best(0, "before", 3)


@pytest.mark.parametrize("seed", range(6))
def test_least_cost_and_least_audit(seed):
    rng = random.Random(seed)
    for _ in range(400):
        n = rng.randint(0, 9)
        initials = "".join(rng.choice("uuaassx" if seed % 2 else "uaua s") for _ in range(n))
        gone = [rng.random() < 0.15 for _ in range(n)]
        extra = [0 if g or rng.random() < 0.7 else 3 for g in gone]
        assert align(initials, gone, extra) == brute(initials, gone, extra), (initials, gone, extra)


def test_long_conversations():
    rng = random.Random(9)
    for n in (60, 150):
        initials = "s" + "ua" * n
        initials = "".join(c for c in initials if rng.random() > 0.1)
        gone = [rng.random() < 0.05 for _ in initials]
        extra = [0] * len(initials)
        assert align(initials, gone, extra) == brute(initials, gone, extra)
    cost, audit = align("ua" * 2000 + "u", [False] * 4001, [0] * 4001)
    assert (cost, audit) == (3, "K" * 4001 + "I")


def test_audits_make_the_grammar():
    assert align("su", [False] * 2, [0, 0]) == (3, "KKI")
    assert align("s", [False], [0]) == (4, "D")
    assert align("", [], []) == (0, "")
    turns = [("system", "x"), ("user", "a."), ("user", "b."), ("assistant", "c.")]
    cost, audit = align("suua", [False] * 4, [0] * 4)
    assert (cost, audit) == (3, "KKIKK")
    assert [r for r, _ in apply_audit(turns, audit)] == ["system", "user", "assistant", "user", "assistant"]


def test_first_fault_counts():
    turns = [("user", " \t\n"), ("user", "hi"), ("user", "hi"), ("assistant", "hi"), ("user", "ok! \x0b"), ("user", "\xa0")]
    assert faults(turns) == ["blank", "truncated", "duplicate", "truncated", "", "truncated"]


def plain(turns):
    """The contract for the ordered turns of one conversation, without bands or shared tables."""
    seen, kinds = set(), []
    for _, role, text in turns:
        visible = [c for c in text if c not in " \t\n\x0b\x0c\r"]
        kinds.append("blank" if not visible else "duplicate" if (role, text) in seen else "" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = "".join(r[:1] or " " for _, r, _ in turns)
    cost, audit = brute(initials, [k in ("blank", "duplicate") for k in kinds], [3 * (k == "truncated") for k in kinds])
    numbers = {t for t, _, _ in turns if t is not None}
    out = [max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0]
    out += [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    out.append(sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])))
    said, at, due = [], 0, "user"
    for edit in audit:
        if edit == "I":
            said.append(f"{due}:")
        elif edit == "D":
            at += 1
            continue
        else:
            _, role, text = turns[at]
            at += 1
            said.append(f"{role if edit == 'K' else due}:{text}")
            if edit == "K" and role.startswith("s"):
                continue
        due = "assistant" if due == "user" else "user"
    return (*out, cost, audit, "\n".join(said))


def test_odd_rows(spark):
    schema = "conv_id bigint, turn int, role string, text string, again string, gaps string"
    rows = [
        (1, 0, "system", "rules."), (1, 1, "user", "x" * 300_000), (1, 2, "assistant", "yes."), (1, 9, "user", "?"),
        (2, 0, None, None), (2, None, "user", "first."), (2, 0, "", "y."),
        (None, 0, "user", "a."), (None, 1, "assistant", "b."),
        (3, 0, "user", "tie."), (3, 0, "assistant", "tie."), (3, 0, "user", "tie."),
        (4, 5, "tool", "z"),
    ]
    df = spark.createDataFrame([(*r, "q", "w") for r in rows], schema).repartition(3)
    got = {r["conv_id"]: r for r in repair_conversations(df).collect()}
    groups = {}
    for c, t, r, x in rows:
        groups.setdefault(c, []).append((t, r or "", x or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        row = got[c]
        said = "\n".join(f"{t['role']}:{t['text']}" for t in row["repaired"])
        assert (*row[1:8], said) == plain(turns), c
    assert repair_conversations(df.limit(0)).count() == 0


def test_rows_that_only_make_a_conversation_known(spark):
    df = spark.createDataFrame([(1, 0, "user", "a.", False), (2, 0, "user", "a.", True), (2, 1, "user", "b.", None)], "conv_id int, turn int, role string, text string, here boolean")
    got = {r["conv_id"]: r for r in repair_conversations(df, present_col="here").collect()}
    assert tuple(got[1])[1:] == (0, 0, 0, 0, 0, 0, "", []) and got[2]["audit"] == "KI"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_query_equals_brute_force(spark):
    from deskloom.llm.queries import op13_turn_repair

    groups = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        role, text = (" " if x is None else x for x in (r["role"], r["text"]))
        own = groups.setdefault(r["conv_id"], [])
        fault = zlib.crc32(f"{' ' if r['conv_id'] is None else r['conv_id']}:{' ' if r['turn'] is None else r['turn']}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fault == 4:
            role = "user"
        own += [(r["turn"], role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    got = {r["conv_id"]: tuple(r)[1:] for r in op13_turn_repair(spark, SF).collect()}
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        *numbers, said = plain(turns)
        assert got[c] == (*numbers, hashlib.sha256(said.encode()).hexdigest()), c
