"""The prefix trie against a plain one, with components cut small so that every level of the decomposition is taken."""

import hashlib
import random
import re
import zlib

import pytest

from deskflow.llm import trie
from deskflow.llm.trie import decomposed, prefix_trie, rebuilt_trie

KIND = "conv_id long, turn long, role string, text string"


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).digest(), text or ""))
    convs = {c: [(role, text) for *_, role, _, text in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, inside in members.items():
        under = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in under if not any(y[:-1] == x for y in under if y)]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1] if x else "")) for x in under)
        ends = ",".join(str(c) for c in sorted(inside) if len(rebuilt[c]) == len(node))
        children = sum(len(x) == len(node) + 1 for x in under)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(inside), len(node), parent, len(inside), children, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(seed):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"words {rng.randrange(2)}") for c in range(90) for t in range(rng.randrange(7))]
    rows += [(200, t, "user", f"long {t}") for t in range(70)] + [(201, t, "user", f"long {t}") for t in range(75)]
    rows += [(20 * k, t, "user", "same start" if t < 2 else f"{k}") for k in range(20, 60) for t in range(4)]
    rows += [(33, None, None, "first"), (33, 2, "user", None), (33, 2, "user", None), (None, 1, "user", "nobody"), (61, 3, "", ""), (1 << 40, 0, "user", "far")]
    return rows


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("small", [3, 40, 1024])
def test_against_plain_trie(spark, small, monkeypatch):
    rows = conversations(small)
    df = spark.createDataFrame(rows, KIND).repartition(3)
    for name in ("d", "label", "c", "n", "parent", "seq", "digest"):
        df = df.withColumn(name, trie.F.lit("clash"))
    monkeypatch.setattr(trie, "CUT", 16)
    monkeypatch.setattr(trie.prefix_trie, "__defaults__", (small,))
    out = rebuilt_trie(df)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert ordered(out.collect()) == ordered(plain(rows))


def test_conversations_without_turns(spark):
    # 5 has fewer turns than its head takes away, and no group head: only the root is left
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    assert ordered(rebuilt_trie(spark.createDataFrame(rows, KIND)).collect()) == ordered(plain(rows))


def test_empty_table(spark):
    assert rebuilt_trie(spark.createDataFrame([], KIND)).collect() == []


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """A conversation of 3,000 turns is decomposed by halving, not turn by turn."""
    rounds = []
    found = trie.centroids
    monkeypatch.setattr(trie, "centroids", lambda *a: rounds.append(1) or found(*a))
    turns = spark.range(1, 3001).select(
        trie.F.lit(7).cast("long").alias("c"), trie.F.col("id").alias("d"), trie.F.lit("user").alias("role"),
        trie.F.unhex(trie.F.sha2(trie.F.col("id").cast("string"), 256)).alias("digest"), trie.F.lit(2).cast("long").alias("words"),
    )
    out = prefix_trie(spark.createDataFrame([(7, 3000)], "c long, size long"), turns, 500).collect()
    assert len(out) == 3001 and all(r["n_leaves"] == 1 and r["saved_tokens"] == 0 for r in out)
    assert len(rounds) == 3


def test_decomposed_equals_bottom_up():
    rng = random.Random(3)
    for n in (1, 2, 3, 50, 400):
        parent = [-1] + [rng.randrange(max(0, i - rng.choice([1, 5, 400])), i) for i in range(1, n)]
        values = [(rng.randrange(9), 1) for _ in range(n)]
        want = [list(v) for v in values]
        for v in range(n - 1, 0, -1):
            want[parent[v]] = [a + b for a, b in zip(want[parent[v]], want[v])]
        assert decomposed(parent, values) == want
