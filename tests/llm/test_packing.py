"""Packing: every id in its place, no sequence over its capacity, and no more sequences than best fit needs."""

import random
import zlib

import numpy as np
import pytest

from deskflow.llm.packing import packed, packing_plan, sequences, token_pieces
from tests.llm import cases

tokenizers = pytest.importorskip("tokenizers")
PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")

ODD = [
    (100, "don't we'll <|endoftext|> \x01 a\x01b Ǆ ﬁ İ \x1c\x1f  x y é ́z 가 ᆨ"), (101, "\x01"), (102, "'s 're\n\n\x0b\x0c42 3.14"),
]


def ids_of(text):
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps[gaps.index(fit)] = fit - n
    return len(gaps)


def placed(steps, capacity):
    """Checks the steps by filling sequences with them; how many sequences there are."""
    used = {}
    for length, n, each, first, offset in steps:
        for i in range(n):
            used.setdefault(first + i // each, []).append((offset + i % each * length, length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(used) == list(range(len(used)))
    return len(used)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_as_good_as_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([30, 100, 2048])
    lengths = [min(capacity, max(1, int(rng.expovariate(1 / (capacity * rng.choice([0.05, 0.2, 0.5])))))) for _ in range(1500)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    steps = packing_plan(counts, capacity)
    assert {n: sum(s[1] for s in steps if s[0] == n) for n in counts} == counts
    made = placed(steps, capacity)
    assert -(-sum(lengths) // capacity) <= made <= best_fit(lengths, capacity) + 1


def test_large_items_meet_in_pairs():
    steps = packing_plan({60: 2, 50: 1, 40: 3, 35: 1}, 100)
    assert placed(steps, 100) == 4  # 60 + 40 twice, 50 + 40, 35 alone: three above a third never share
    assert packing_plan({}, 100) == []
    assert placed(packing_plan({1: 250}, 100), 100) == 3


def test_steps_do_not_grow_with_the_corpus():
    counts = {n: 1 + n * 7919 % 13 for n in range(1, 2049)}
    few, many = (len(packing_plan({n: k * c for n, c in counts.items()})) for k in (1, 10**9))
    assert many < 20_000 and few < 20_000


def test_every_id_in_its_place(spark):
    rows = cases.rows() + ODD
    out = packed(cases.docs(spark, rows), PATH, keep_ids=True).persist()
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    found = out.collect()
    whole = {r["sequence_id"]: r["ids"] for r in sequences(out).collect()}
    texts = {}
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(r["ids"]) and r["start"] == 2048 * r["piece"]
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == ids
    assert sum(map(len, whole.values())) == sum(r["length"] for r in found) and max(map(len, whole.values())) <= 2048
    for r in found:
        texts.setdefault(r["doc_id"], []).append((r["piece"], r["ids"]))
    want = {}
    for doc_id, text in rows:
        ids = ids_of(text)
        for i in range(0, len(ids), 2048):
            want.setdefault(doc_id, []).append((i // 2048, np.array(ids[i : i + 2048], "<u4").tobytes()))
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}
    assert len(whole) <= best_fit([r["length"] for r in found], 2048)
    out.unpersist()


def test_empty_and_small_capacity(spark):
    assert packed(cases.empty(spark), PATH).collect() == []
    out = packed(cases.docs(spark, [(1, "a b c d e"), (2, None)]), PATH, 4).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in out) == [(1, 0, 4), (1, 1, 2), (2, 0, 1)]
    assert len({r["sequence_id"] for r in out}) == 2


def test_long_texts_are_read_in_stretches(spark, monkeypatch):
    from deskflow.llm import packing

    text = cases.prose(4, 3000) + "\n" + "é" * 500
    model = open(PATH, encoding="utf-8").read()
    monkeypatch.setattr(packing, "TEXT_BYTES", 1000)
    monkeypatch.setattr(packing, "KNOWN", 50)
    ids = [np.frombuffer(x, "<u4").tolist() for x in packing.text_ids(model, [b"a b", text.encode(), b""])]
    assert [x + [0] for x in ids] == [ids_of("a b"), ids_of(text), [0]]
    assert token_pieces(cases.docs(spark, [(1, text)]), PATH).count() == -(-(len(ids[1]) + 1) // 2048)
