import random
import re

import numpy as np
import pyarrow as pa
import pytest

from deskloom.llm import ngram_join
from deskloom.llm.components import connected_components, spanning
from deskloom.llm.ngram_join import drop_near, most_overlap, ngram_components, sketch
from deskloom.llm.shingles import shingle_sets


def sets_of(rows):
    out = {}
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        out[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                one, two = sorted((root(a), root(b)))
                parent[two] = one
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus():
    random.seed(11)
    word = lambda: random.choice("ka lo mi ne pu ra si to".split()) + random.choice("ba de fi go hu".split())
    passage = [word() for _ in range(25)]
    base = [word() for _ in range(60)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "ONE two"), (5, "one  TWO"), (6, "one two three")]
    for i in range(30):  # near copies with a varying number of edits
        words = list(base)
        for _ in range(i % 9):
            words[random.randrange(60)] = word()
        rows.append((100 + i, " ".join(words)))
    for i in range(20):  # a shared passage in unlike texts
        rows.append((200 + i, " ".join([word() for _ in range(random.choice([5, 30]))] + passage)))
    rows += [(300 + i, "the same text over and over again") for i in range(12)]
    rows += [(400, "x " * 60_000), (401, "x " * 50_000), (402, " ".join(map(str, range(20_000))))]
    return rows


@pytest.mark.parametrize("small", [2, 8])
def test_components_equal_brute_force(make, monkeypatch, small):
    monkeypatch.setattr(ngram_join, "SMALL_COLUMN", small)
    rows = corpus()
    got = ngram_components(make(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)


def test_repeated_and_null_ids_and_no_rows(make):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, "other")]
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in ngram_components(make(rows)).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 3)]
    kept = drop_near(make(rows))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 1, 3] and kept.columns[3] == "__row"
    assert ngram_components(make([])).count() == 0


def brute_rows(rows):
    """As ``brute``, for ids with several texts: an id links by any of its rows."""
    sets = [(i, next(iter(sets_of([(i, t)]).values()))) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            both = len(a & b)
            if both and 100 * both >= 75 * len(a | b):
                one, two = sorted((root(i), root(j)))
                parent[two] = one
    return sorted((i, len(a), root(i)) for i, a in sets)


@pytest.mark.parametrize("size", [5, 8, 9, 30])
def test_ids_with_several_texts_in_groups_of_any_size(make, size):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "x y z u v w")
    rows = [(i, a) for i in range(1, size + 1)] + [(size, b), (40, b), (41, c), (40, c)]
    rows += [(60 + i, "a second large group of equal texts") for i in range(size)] + [(60 + size // 2, c), (200, a), (200, "")]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_components(make(rows)).collect())
    assert got == brute_rows(rows) and {x[2] for x in got} == {1}


def test_sketches_never_bound_too_low():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (5, 40), (300, 260), (900, 900)):
        a, b = (np.unique(rng.integers(0, 2**63, k).astype(np.uint64)) for k in (n, m))
        b = np.unique(np.concatenate([b, a[: n // 2]]))
        assert most_overlap(sketch(a), sketch(b), len(a)) >= len(np.intersect1d(a, b))


def test_sets_do_not_depend_on_the_batch():
    texts = ["A b c d e f g", None, "a B c d e f G", "b c d e f g", ""]
    whole = list(shingle_sets(pa.array(texts)))
    single = [next(iter(shingle_sets(pa.array([t], pa.string())))) for t in texts]
    assert all((x == y).all() for x, y in zip(whole, single))
    assert [len(x) for x in whole] == [3, 0, 3, 2, 0] and (whole[0] == whole[2]).all()


def test_connected_components(spark):
    random.seed(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(9)] + [(None, 3), (7, 7)]
    random.shuffle(links)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(9)}
    assert list(spanning([(1, 2), (2, 3), (1, 3)])) == [(1, 2), (2, 3)]
