"""Importance resampling against plain loops, and the quickselect against a sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from deskflow.llm.importance import importance_sample, kth_key
from deskflow.llm.common import stored
from tests.llm import cases


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, share=5, least=20, buckets=10_000):
    s, t = (Counter(zlib.crc32(g.encode()) % buckets for x in side for g in features(x)[1]) for side in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets))))
    rows = []
    for doc_id, text in docs:
        words, grams = features(text)
        weight = sum(gain(zlib.crc32(g.encode()) % buckets) for g in grams)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[: share * len(able) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is None, x or 0) for x in r])


TARGET = [cases.prose(2, 60), None, "", "Étude é 日本"]


def test_against_plain_loops(spark):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    for share in (5, 40, 100):
        out = importance_sample(cases.docs(spark), target, share)
        assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert ordered(out.collect()) == ordered(plain(cases.rows(), TARGET, share))


def test_ties_and_repeated_rows(spark):
    text = cases.prose(1, 40)
    rows = [(7, text)] * 50 + [(None, text)] * 30 + [(i, text) for i in range(10)]
    out = importance_sample(cases.docs(spark, rows), spark.createDataFrame([(text,)], "text string"), 50).collect()
    assert ordered(out) == ordered(plain(rows, [text], 50))
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 46))


def test_empty_sides(spark):
    none = spark.createDataFrame([], "text string")
    assert importance_sample(cases.empty(spark), none).collect() == []
    assert ordered(importance_sample(cases.docs(spark), none).collect()) == ordered(plain(cases.rows(), []))


def test_quickselect_finds_every_rank(spark):
    rng = random.Random(5)
    keys = sorted({(rng.randrange(20), rng.randrange(40)) for _ in range(600)})
    rows = stored(spark.createDataFrame(rng.sample(keys, len(keys)), "a long, b long").repartition(4), "keys")
    for k in (1, 2, len(keys) // 3, len(keys) - 1, len(keys)):
        assert kth_key(rows, ["a", "b"], k) == keys[k - 1]
