"""The operators that compare texts and vectors, against brute force."""

import hashlib
import math
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskflow.llm.blocks import frequent_bits, has_bit
from deskflow.llm import common, signatures, subspaces
from deskflow.llm.decontaminate import find_items
from deskflow.llm.factors import remove_earlier_passages
from deskflow.llm.signatures import Tree, shingle_components
from deskflow.llm.subspaces import near_vectors
from deskflow.llm.suffixes import remove_repeated_strings

from .cases import docs, empty, prose, roots, rows


def words(text):
    return (text or "").encode().split()


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def linked(data, size, num, den):
    sets = [shingles(t, size) for _, t in data]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * len(a | sets[j]):
                links.append((i, j))
    return sets, links


def expected_components(data, size, num, den):
    sets, links = linked(data, size, num, den)
    root = roots(range(len(data)), links)
    low = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            low[root[i]] = min(low.get(root[i], d), d)
    return sorted(((d, len(s), low.get(root[i]) if s else d) for i, ((d, _), s) in enumerate(zip(data, sets))), key=str)


def test_components_of_odd_rows(spark):
    got = shingle_components(docs(spark), 4, 85, 100).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected_components(rows(), 4, 85, 100)


def near_copies(n):
    """A group whose members are near copies of some others, but not of all."""
    rng = random.Random(5)
    chain = prose(11, 200).split()
    out = []
    for i in range(n):
        chain = list(chain)
        chain[rng.randrange(200)] = f"edit{i}"
        out.append((i, " ".join(chain)))
    return out + [(n + i, prose(100 + i, 60)) for i in range(10)]


def test_components_of_a_chain_of_copies(spark, monkeypatch):
    monkeypatch.setattr("deskflow.llm.signatures.BLOCK", 16)  # trees over several blocks
    data = near_copies(70)
    got = shingle_components(docs(spark, data), 5, 80, 100).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected_components(data, 5, 80, 100)


def test_components_of_a_web_of_copies_without_all_its_pairs(spark, monkeypatch):
    # copies of a text that is not there: each is linked with some of the others, and no one with most
    rng, data = random.Random(9), []
    for i in range(360):
        copy = prose(12, 160).split()
        for k in rng.sample(range(8, 152, 9), 2):  # two copies are similar if they share a place
            copy[k] = f"edit{i}x{k}"
        data.append((i, " ".join(copy)))
    compared = []

    def counted(pairs, *args):
        pairs = signatures.stored(pairs, "counted")
        compared.append(pairs.count())
        return verified(pairs, *args)

    verified = signatures.verified
    monkeypatch.setattr(signatures, "verified", counted)
    got = shingle_components(docs(spark, data), 4, 85, 100).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected_components(data, 4, 85, 100)
    assert len(linked(data, 4, 85, 100)[1]) > 25 * len(data) > sum(compared)


def test_components_of_a_web_take_one_table(spark, monkeypatch):
    rng, written = random.Random(3), []
    links = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(1500)] + [(900, 901), (5, 5)]
    write = common.stored
    monkeypatch.setattr(common, "stored", lambda df, name: written.append(name) or write(df, name))
    got = common.components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()
    assert sorted(map(tuple, got)) == sorted(roots({n for a, b in links if a != b for n in (a, b)}, links).items())
    assert written == ["edges"]


@pytest.mark.parametrize("held", [1, 6, 1 << 19])
def test_components_of_chains_and_stars(spark, monkeypatch, held):
    monkeypatch.setattr(common, "HELD_EDGES", held)
    order = random.Random(4).sample(range(-300, 300), 600)
    links = [*zip(order[:200], order[1:200]), *((order[200], n) for n in order[201:400]), *zip(order[400:500], order[500:])]
    got = common.components(spark.createDataFrame(links + links[:50], "a long, b long").repartition(4)).collect()
    assert sorted(map(tuple, got)) == sorted(roots(set(order), links).items())
    none = spark.createDataFrame([(1, 1)], "a long, b long")
    assert common.components(none).count() == 0


def test_no_rows(spark):
    none = empty(spark)
    assert shingle_components(none).count() == 0
    assert remove_earlier_passages(none).count() == 0
    assert remove_repeated_strings(none).count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_tree_gives_up_no_similar_pair():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    sets = []
    for _ in range(150):
        if sets and rng.random() < 0.6:
            base = set(sets[rng.integers(len(sets))])
            for x in rng.choice(pool, 3):
                base ^= {x}
        else:
            base = set(rng.choice(pool, rng.integers(5, 60), replace=False).tolist())
        sets.append(base or {pool[0]})
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    bits = np.zeros((len(sets), 16), np.uint64)
    for i, s in enumerate(sets):
        for h in s:
            bits[i, (int(h) >> 6) % 16] |= np.uint64(1 << (int(h) & 63))
    i, j = Tree(n, bits, np.arange(len(sets))).pairs(85, 100)
    found = set(zip(i.tolist(), j.tolist()))
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert want and want <= found and len(found) < len(sets) * len(sets) / 4


def test_tree_of_two_blocks_takes_little_memory():
    rng = np.random.default_rng(4)
    n = np.full(1024, 400)
    bits = rng.integers(0, 1 << 62, (1024, 32)).astype(np.uint64)
    tracemalloc.start()
    i, j = Tree(n, bits, np.arange(1024)).pairs(85, 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(i) == len(j) and peak < 150e6


def test_bit_maps_come_to_the_driver_as_columns(spark, folder, monkeypatch):
    def as_objects(self):
        raise AssertionError("every word of the map is a Python object")

    left = spark.range(40).selectExpr("id AS key", "concat('word', id, ' and some more of it') AS text", "id AS doc_id")
    spark.range(0, 40, 4).selectExpr("id AS key", "id * 2 AS v").write.parquet(f"{folder}/right")
    items = left.selectExpr("doc_id AS item_id", "text").where("doc_id = 7")
    monkeypatch.setattr(type(left), "toPandas", as_objects)
    got = common.join_few(left, spark.read.parquet(f"{folder}/right"), "key").select("key", "v").collect()
    assert sorted(map(tuple, got)) == [(k, None if k % 4 else 2 * k) for k in range(40)]
    slots = spark.range(0, 3000, 7).selectExpr("id AS s").unionByName(spark.range(5).selectExpr("63L AS s"))
    at = np.unpackbits(common.bit_map(slots, "s", 4096).view(np.uint8), bitorder="little")
    assert np.flatnonzero(at).tolist() == sorted({*range(0, 3000, 7), 63})
    assert (7, 0) in {(r["doc_id"], r["distance"]) for r in find_items(left, items).collect()}


def expected_factors(data, size=13):
    # rows of one doc_id are one document: what is found in one is applied at the same words of the others
    first, starts = {}, {}
    for d, t in data:
        w = words(t)
        for i in range(len(w) - size + 1):
            if d is not None:
                g = tuple(w[i : i + size])
                first[g] = min(first.get(g, d), d)
    for d, t in data:
        w = words(t)
        for i in range(len(w) - size + 1):
            if d is not None and first[tuple(w[i : i + size])] < d:
                starts.setdefault(d, set()).add(i)
    out = []
    for d, t in data:
        w = words(t)
        gone = {i + k for i in starts.get(d, ()) if i + size <= len(w) for k in range(size)}
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def test_factors_of_odd_rows(spark):
    got = remove_earlier_passages(docs(spark))
    assert sorted((tuple(r) for r in got.drop("factors").collect()), key=str) == expected_factors(rows())
    spans = got.select("n_removed", F.aggregate("factors", F.lit(0), lambda s, f: s + f["end"] - f["start"]).alias("n"))
    assert spans.where("n <> n_removed").count() == 0


def expected_strings(data, length):
    texts = [(d, (t or "").encode()) for d, t in data]
    seen = {}
    for _, t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for d, t in texts:
        gone = bytearray(len(t) + 1)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone[: len(t)]), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [400, 57])
def test_strings_of_odd_rows(spark, length):
    got = remove_repeated_strings(docs(spark), length).drop("spans").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_strings(rows(), length)


def vectors():
    rng = np.random.default_rng(9)
    out = []
    for i in range(60):
        v = rng.standard_normal(20)
        out.append((i, v.tolist(), i % 3))
        for k in range(i % 4):
            out.append((100 + 10 * i + k, (v + rng.standard_normal(20) * 0.12 * k).tolist(), i % 3))
    same = rng.standard_normal(20).tolist()
    out += [(2000 + k, same, 1) for k in range(30)] + [(2100, same, None), (2101, same, 2), (2102, [2.0 * x for x in same], 1)]
    out += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 20, 1), (3003, [float("nan")] + [1.0] * 19, 1), (3004, [float("inf")] * 20, 1), (3005, [None] + [1.0] * 19, 1)]
    out += [(4000, [1.0], 1), (4001, [3.0], 1), (4002, [-3.0], 1), (4003, [1e-200, 0.0], 1), (4004, [1e200, 0.0], 1), (5000, same, 1), (5000, same, 1), (None, same, 1)]
    return out


def cosine(a, b):
    p, q = max(map(abs, a)), max(map(abs, b))
    a, b = [x / p for x in a], [x / q for x in b]
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


@pytest.mark.parametrize("part", [subspaces.PART_ROWS, 3])
def test_vectors_of_odd_rows(spark, monkeypatch, part):
    monkeypatch.setattr(subspaces, "PART_ROWS", part)
    data = vectors()
    good = [i for i, (_, v, c) in enumerate(data) if c is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    links = [(i, j) for i in good for j in good if j < i and data[i][2] == data[j][2] and len(data[i][1]) == len(data[j][1])
             and (data[i][1] == data[j][1] or cosine(data[i][1], data[j][1]) >= 0.98)]
    root = roots(range(len(data)), links)
    degree = [sum(i in x for x in links) for i in range(len(data))]
    low = {}
    for i, (d, _, _) in enumerate(data):
        if d is not None:
            low[root[i]] = min(low.get(root[i], d), d)
    want = [(d, degree[i], low.get(root[i], d), d is not None and low.get(root[i], d) == d) for i, (d, _, _) in enumerate(data)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit("clash")).repartition(3)
    got = near_vectors(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_crowded_cells_are_cut(spark, monkeypatch):
    monkeypatch.setattr(subspaces, "PART_ROWS", 50)
    rng = np.random.default_rng(2)
    base = rng.standard_normal(16)
    data = [(i, (base + rng.standard_normal(16) * 0.05).tolist(), 1) for i in range(400)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(3)
    x = np.array([v for _, v, _ in data])
    x /= np.linalg.norm(x, axis=1)[:, None]
    degree = ((x @ x.T) >= 0.98).sum(1) - 1
    assert {r["vec_id"]: r["n_links"] for r in near_vectors(df).collect()} == dict(enumerate(degree.tolist()))

    units = spark.createDataFrame([(i, 1, 16, v.tolist()) for i, v in enumerate(x)], "rep long, label int, dims int, unit array<double>")
    placed = subspaces.cells(units, 0.04)
    crowded = subspaces.cells(units, 0.04, coords=False).groupBy(subspaces.CELL).count().where("count > 50")
    assert crowded.count() > 0 and crowded.agg(F.max("count")).first()[0] > 300
    parts = subspaces.in_parts(placed, crowded.selectExpr(*subspaces.CELL, "cast(ceil(count / 50) as int) as parts"))
    assert parts.groupBy(*subspaces.CELL, "i", "j").count().agg(F.max("count")).first()[0] < 200


def test_map_of_frequent_hashes(spark):
    def hashes(batch):
        yield batch.column("x").flatten().to_numpy().view(np.uint64)

    df = spark.range(1000).selectExpr("array(xxhash64(id % 300), xxhash64(id + 100000)) as x").repartition(5)
    values = lambda e, n: spark.range(n).selectExpr(e).toPandas().iloc[:, 0].to_numpy(np.int64).view(np.uint64)
    for blocks in (1, 7):
        bits = frequent_bits(df, hashes, 3, 1 << 20, blocks)
        assert has_bit(bits, values("xxhash64(id)", 300)).all()
        assert has_bit(bits, values("xxhash64(id + 100000)", 1000)).sum() < 20
        assert not frequent_bits(df.limit(0), hashes, 3, 1 << 20, blocks).any()
