from deskloom.llm.preference import conversations, preference_pairs

SHAPE = "id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt_ string"


def show(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def brute(chosen, rejected):
    chosen, rejected = ([(r or "", t or "") for r, t in x or []] for x in (chosen, rejected))
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    if n == len(chosen) == len(rejected):
        places = [i for i, (r, _) in enumerate(chosen) if r == "assistant"]
        n = places[-1] if places else n
    out = [n, show(chosen[:n])]
    spans = []
    for turns in (chosen[n:], rejected[n:]):
        out.append(show(turns))
        at, found = len(out[1]), []
        for r, t in turns:
            begin = at + len(f"<|{r}|>\n")
            at = begin + len(t + "<|end|>\n")
            if r == "assistant":
                found.append((begin, at))
        spans.append(found)
    return (*out, *spans)


def test_pairs_equal_brute_force(spark):
    u, a, b = ("user", "hé 😀"), ("assistant", "one"), ("assistant", "two" * 20_000)
    cases = [
        ([u, a], [u, b]), ([u, a, u, a], [u, a, u, b]), ([u, a], [u, a]), ([u], [u]), ([a], [b]), (None, [u, a]), ([], None),
        ([u, a, u], [u, a]), ([("user", None), a], [("user", ""), b]), ([(None, "x"), a], [("user", "x"), a]), ([u, a, u], [u, a, u]),
    ]
    frame = spark.createDataFrame([(i, c, r, "kept") for i, (c, r) in enumerate(cases)], SHAPE)
    rows = preference_pairs(frame).collect()
    names = ["n_common", "prompt", "chosen_text", "rejected_text", "chosen_spans", "rejected_spans"]
    for row in rows:
        got = [row[n] for n in names[:4]] + [[tuple(s) for s in row[n]] for n in names[4:]]
        want = brute(*([None if x is None else [(r or "", t or "") for r, t in x] for x in cases[row["id"]]]))
        assert tuple(got) == want, row["id"]
        assert row["prompt_"] == "kept"
    assert len(rows) == len(cases)


def test_turns_are_gathered_in_order(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, 0, "user", "x"), (2, None, None, None)]
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()}
    assert got == {1: [("user", "a"), ("assistant", "b"), ("assistant", "b")], 2: [("", "")]}
    empty = spark.createDataFrame([], SHAPE)
    assert preference_pairs(empty).count() == 0
