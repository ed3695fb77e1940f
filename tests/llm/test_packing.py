import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from deskloom.llm.packing import linear_groups, pack_documents, plan
from deskloom.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def held(runs):
    counts = {}
    for run in runs:
        for length in run.lengths:
            counts[length] = counts.get(length, 0) + run.count
    return counts


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 128), st.integers(1, 40), max_size=30))
def test_a_plan_holds_every_piece_once_and_no_sequence_overflows(counts):
    runs = plan(counts, capacity=128, groups=8)
    assert held(runs) == counts
    assert all(sum(r.lengths) <= 128 and r.count > 0 for r in runs)


def test_few_sequences_are_used():
    random.seed(1)
    counts = {}
    for _ in range(20_000):
        size = min(2048, int(random.lognormvariate(6.3, 1)) + 1)
        counts[size] = counts.get(size, 0) + 1
    need = -(-sum(k * v for k, v in counts.items()) // 2048)
    assert sum(r.count for r in plan(counts)) <= need * 1.002 + 2


def test_groups_have_equal_cardinality_and_round_up():
    groups = linear_groups({10: 5, 9: 5, 3: 10}, 4)
    assert [(size, sum(m.values())) for size, m in groups] == [(10, 5), (9, 5), (3, 10)]


def test_ids_equal_the_tokenizers_library():
    encoder, exact = Encoder(PATH), Tokenizer.from_file(PATH)
    texts = ["", "Plain text, 12 34.  \n\n x's", "été straße ß Łódź", "日本 текст 😀", "a<|endoftext|>b", "x" * 5000, "\u2028 \u00a0 \u0085 '’s"]
    for text in texts:
        assert encoder.ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_pieces_and_places(make):
    exact = Tokenizer.from_file(PATH)
    texts = {1: None, 2: "", 3: "some words here", 4: "many words " * 400, 5: "x y z " * 30}
    rows = [*texts.items(), (6, "again"), (6, "again")]
    got = pack_documents(make(rows), PATH, capacity=64).collect()
    for doc, text in texts.items():
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted((r for r in got if r["doc_id"] == doc), key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces))) and all(r["length"] == 64 for r in pieces[1:])
        at = 0
        for r in pieces:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    assert sum(r["doc_id"] == 6 for r in got) == 2
    assert pack_documents(make([]), PATH).count() == 0
