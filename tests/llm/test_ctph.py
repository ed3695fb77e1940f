import hashlib
import random

import numpy as np

from deskloom.llm import ctph


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distances_equal_brute_force():
    random.seed(5)
    draw = lambda: "".join(random.choices("abcd", k=random.choice([0, 1, 5, 30, 63, 64])))
    a, b = [draw() for _ in range(200)], [draw() for _ in range(200)]
    assert ctph.edit_distances(a, b).tolist() == [levenshtein(x, y) for x, y in zip(a, b)]


def test_chunks_depend_on_content_only():
    random.seed(6)
    text = " ".join("".join(random.choices("abcdefgh", k=6)) for _ in range(3000))
    one, moved = ctph.fingerprint(text), ctph.fingerprint("Some words in front. " + text)
    assert ctph.likeness([one], [moved])[0] > 0.9
    assert all(len(s) <= ctph.MOST for s in one.split(":")[1:])
    other = " ".join("".join(random.choices("abcdefgh", k=6)) for _ in range(3000))
    assert ctph.likeness([one], [ctph.fingerprint(other)])[0] < 0.3


def plain_fingerprint(text):
    """Byte by byte, for texts of any length by the one rule: the smallest level with at most 63
    boundaries inside the text."""
    data, whole = text.encode(), (1 << 64) - 1
    if not data:
        return "0::"

    def mixed(x):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & whole
        return x ^ (x >> 32)

    zeros = []
    for i in range(len(data)):
        rolled = mixed(sum(int(ctph._VALUE[data[i - k]]) * int(ctph._ROLL[k]) for k in range(ctph.WINDOW) if i >= k) & whole)
        zeros.append((rolled & -rolled).bit_length() - 1 if rolled else ctph.LEVELS)
    level = next(k for k in range(ctph.LEVELS) if sum(z >= k for z in zeros[:-1]) < ctph.MOST)

    def signature(k):
        out, chunk, power = "", 0, 1
        for i, byte in enumerate(data):
            chunk, power = (chunk + int(ctph._VALUE[byte]) * power) & whole, power * ctph._BASE & whole
            if zeros[i] >= k or i == len(data) - 1:
                out += chr(ctph.LETTERS[mixed(chunk) >> 58])
                chunk, power = 0, 1
        return out

    return f"{level}:{signature(level)}:{signature(level + 1)}"


def test_one_rule_for_all_lengths():
    random.seed(8)
    texts = ["", "a", "abc " * 127, "abc " * 129, "abc " * 4000, "ab" * 256, "z" * 511, "z" * 512, "z" * 5000]
    texts += ["".join(random.choices("abcdé ", k=n)) for n in (3, 60, 64, 65, 400, 511, 512, 513, 3000)]
    texts += ["".join(random.choices("abcdef", k=64)) * 30]
    assert [ctph.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert {ctph.fingerprint("abc " * n).split(":")[0] for n in (127, 129)} == {"2"}


def test_strips_do_not_show(monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(5000))
    want = ctph.fingerprint(text)
    monkeypatch.setattr(ctph, "STRIP", 700)
    monkeypatch.setattr(ctph, "_POWERS", ctph._powers(ctph._BASE, 700))
    monkeypatch.setattr(ctph, "_INVERSES", ctph._powers(ctph._INVERSE, 700))
    assert ctph.fingerprint(text) == want


def test_neighbours_equal_brute_force(make):
    random.seed(7)
    rows = [(i, "".join(random.choices("abc é", k=random.choice([0, 1, 40, 900])))) for i in range(40)]
    rows += [(50, None), (None, "first"), (12, "tie"), (12, "tie"), (60, "z" * 300_000)]
    ordered = sorted(((-1 if i is None else i, t or "", t is not None) for i, t in rows), key=lambda r: (r[0], hashlib.md5(r[1].encode()).digest()))
    want = []
    for (i, t, _), (_, n, _) in zip(ordered, ordered[1:] + ordered[:1]):
        new = ctph.edited(t, n)
        prints = [ctph.fingerprint(x) for x in (t, new, n)]
        near = ctph.likeness([prints[0]] * 2, prints[1:])
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), prints[0], prints[1], *np.round(near, 9)))
    got = [
        (-1 if r["doc_id"] is None else r["doc_id"], *list(r)[1:5], round(r["near_edited"], 9), round(r["near_next"], 9))
        for r in ctph.neighbour_fingerprints(make(rows)).collect()
    ]
    assert sorted(got) == sorted(want)


def test_one_row_and_none(make):
    [row] = ctph.neighbour_fingerprints(make([(1, "abcd")])).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1
    assert ctph.neighbour_fingerprints(make([])).count() == 0
    assert [r["fingerprint"] for r in ctph.fingerprints(make([(1, None)])).collect()] == ["0::"]
