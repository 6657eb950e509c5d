"""Small tables that hold the odd cases: nulls, empty and long texts, repeated rows and ids, ties, clashing columns."""

import random

from pyspark.sql import functions as F

WORDS = "amber birch cedar dune ember fjord grove harbor inlet juniper kelp lagoon meadow north orchard pine quarry river stone tide".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ly", "ing"]) + str(rng.randrange(40)) for _ in range(n))


def rows():
    base = prose(1, 120)
    edited = base.split()
    edited[60] = "changed"
    shared = prose(2, 90)
    out = [
        (1, None), (2, ""), (3, " \t\n "), (4, "One"), (5, "one"), (6, "a b c"), (7, "A B C"),
        (10, base), (11, base), (12, " ".join(edited)), (13, base.upper()),
        (20, prose(3, 50) + "\n" + shared + " " + prose(4, 30)), (21, shared + "\n\n" + prose(5, 80)), (22, prose(6, 40) + " " + shared),
        (30, "x" * 1000), (31, "x" * 900 + "y" * 450), (32, "ab" * 700), (33, prose(7, 12000)), (34, prose(7, 12000)[3000:60000]),
        (40, "é" * 500 + " " + "日本" * 300), (41, "日本" * 400), (50, prose(8, 13)), (51, prose(8, 12)), (52, "tail " + prose(8, 13)),
        (60, base), (60, base), (61, shared), (61, prose(9, 70)), (None, base), (None, None), (None, prose(10, 60)),
    ]
    return out


def docs(spark, data=None, extra=True):
    df = spark.createDataFrame(rows() if data is None else data, "doc_id long, text string")
    if extra:  # names that operators use inside
        for name in ("key", "n", "cls", "hash", "block", "starts", "runs", "size", "row", "spans", "places", "__rows"):
            df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def empty(spark):
    return docs(spark, []).limit(0)


def roots(nodes, links):
    """Each node's smallest partner over links."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
