"""Postings, names in text, sketches, document files and thread states against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from deskflow.operators.memory import thread_latest, thread_states
from deskflow.operators.names import find_names
from deskflow.operators.postings import Postings
from deskflow.operators.sketches import ERROR, merged, sketch_cells
from deskflow.sources.tables import read_document_files, write_document_files
from deskflow.streaming.changes import KeyedTable, run_apply


def said(seed=1, n=300):
    rng = random.Random(seed)
    words = ["The", "the", "cash", "Book", "at,", "3pm.", "of", "é", "x"]
    rows = [(0 if rng.random() < 0.5 else rng.randrange(6), i, " ".join(rng.choice(words) for _ in range(rng.randrange(12)))) for i in range(n)]
    return [*rows, (9, 0, None), (9, 1, ""), (9, 2, "the the the the")]


@pytest.mark.parametrize("phrase", ["the", "The cash", "book AT 3pm", "the the", "x é of the", "absent words"])
def test_phrases(spark, folder, phrase):
    rows = said()
    index = Postings(spark, folder, 8)
    half = spark.createDataFrame(rows[:150], "thread_id long, version long, text string")
    index.write(half, 0)
    index.write(spark.createDataFrame(rows[150:], half.schema), 1)
    index.write(half, 0)  # once more
    want = phrase.lower().split()
    expected = []
    for thread, version, text in rows:
        t = re.findall(r"[^\x09-\x0D\x20.,;:!?]+", (text or "").lower())
        n = sum(t[i : i + len(want)] == want for i in range(len(t)))
        if n:
            expected.append((thread, version, n))
    assert sorted(map(tuple, index.phrase(phrase).collect())) == sorted(expected)


def test_a_search_reads_the_parts_of_its_words(spark, folder):
    index = Postings(spark, folder, 64)
    index.write(spark.createDataFrame(said(), "thread_id long, version long, text string"))
    plan = index.of(["the", "cash"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan.replace("#", "").replace("isnotnull(part", "part") or re.search(r"PartitionFilters: \[[^\]]*part", plan)
    read = index.of(["the", "cash"]).select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search(r"part=(\d+)", r["f"])[1] for r in read} == {
        str(r[0]) for r in spark.createDataFrame([("the",), ("cash",)], "t string").select(F.pmod(F.xxhash64("t"), F.lit(64))).collect()
    }
    with pytest.raises(ValueError):
        index.phrase(" ., ")


# --- names ------------------------------------------------------------------


def plain_names(texts, aliases):
    token = lambda s: re.findall(r"[^\x09-\x0D\x20.,;:!?()\"]+", (s or "").lower())
    known = {}
    for alias, aid in aliases:
        if token(alias):
            gram = tuple(token(alias))
            known[gram] = min(aid, known.get(gram, aid))
    out = []
    for key, text in texts:
        t, i = token(text), 0
        while i < len(t):
            n = next((n for n in range(len(t) - i, 0, -1) if tuple(t[i : i + n]) in known), 0)
            if n:
                out.append((key, i, n, known[tuple(t[i : i + n])]))
            i += n or 1
    return sorted(out)


def test_names_against_plain_loops(spark):
    rng = random.Random(2)
    words = ["Bank", "of", "North", "Royal", "gas", "X"]
    aliases = [("Royal Bank", "CL-1"), ("royal bank of north", "CL-2"), ("BANK", "CL-3"), ("bank of", "CL-4"), ("gas", "CL-5"), ("Gas", "CL-0"), ("of North gas", "CL-6"), (" ., ", "CL-7"), (None, "CL-8")]
    texts = [(i, " ".join(rng.choice(words) + rng.choice(["", "", ",", "!"]) for _ in range(rng.randrange(15)))) for i in range(200)]
    texts += [(500, None), (501, ""), (502, "(Royal Bank) of\nnorth."), (503, "gas " * 3000)]
    df = spark.createDataFrame(texts, "id long, said string").repartition(3)
    known = spark.createDataFrame(aliases, "alias string, alias_id string")
    found = find_names(df, known, "id", "said")
    assert found.columns == ["id", "position", "n_tokens", "alias_id"]
    assert sorted(map(tuple, found.collect())) == plain_names(texts, aliases)
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()
    assert find_names(df, known.limit(0), "id", "said").collect() == []


# --- sketches ---------------------------------------------------------------


def test_sketches_of_any_range(spark, folder):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.xxhash64("id") % 9000).alias("client"), (F.col("id") % 4).alias("book"))
    sketch_cells(rows, ["day", "book"], "client").write.parquet(folder + "/cells")
    cells = spark.read.parquet(folder + "/cells")
    for low, high in ((0, 0), (3, 9), (0, 29), (29, 40)):
        span = F.col("day").between(low, high)
        got = {r["book"]: r for r in merged(cells, ["book"], span).collect()}
        want = rows.where(span).groupBy("book").agg(F.countDistinct("client").alias("n"), F.count("*").alias("rows")).collect()
        assert len(got) == len(want)
        for r in want:
            assert got[r["book"]]["n_rows"] == r["rows"] and abs(got[r["book"]]["n_distinct"] - r["n"]) <= 3 * ERROR * r["n"] + 1
    assert cells.count() == 60 and cells.agg(F.max(F.length("sketch"))).first()[0] < 1 << 13


# --- document files ---------------------------------------------------------


def test_document_files(spark, folder):
    rows = [(i, None if i == 3 else "" if i == 4 else f"line\n{i}\té   \"q\"", "de" if i % 3 else "fr") for i in range(50)] + [(50, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    write_document_files(docs, folder + "/files", ["lang"], 7)
    found = read_document_files(spark, folder + "/files", "doc_id long, text string", "lang string")
    assert sorted(map(tuple, found.select("doc_id", "text", "lang").collect())) == sorted(rows)
    german = found.where("lang = 'de'")
    assert {r[0] for r in german.select("lang").distinct().collect()} == {"de"} and german.count() == 33
    scan = next(line for line in german._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan binaryFile" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*lang", scan)
    assert found.select("file").distinct().count() >= 51 / 7


# --- thread states ----------------------------------------------------------


def test_thread_states_in_any_order(spark, folder):
    rows = [(t, v, "user" if v % 2 == 0 else "assistant", "x" * (v + t)) for t in range(5) for v in range(12)] + [(9, 0, None, None)]
    kind = "thread_id long, version long, role string, text string"
    whole = spark.createDataFrame(rows, kind)
    rng = random.Random(3)
    mixed = rng.sample(rows, len(rows))
    table = None
    for part in (mixed[:20], mixed[20:45], mixed[:30], mixed[45:], mixed[40:]):  # two arrivals hold rows that were there
        turns = spark.createDataFrame(part, kind).withColumn("said_at", F.timestamp_seconds(F.col("version") * 60 + 1_700_000_000))
        turns.coalesce(1).write.mode("append").parquet(f"{folder}/turns")
        stream = thread_states(spark.readStream.schema(turns.schema).parquet(f"{folder}/turns"), "1 day")
        table = table or KeyedTable(spark, f"{folder}/states", stream.schema, ["thread_id"])
        run_apply(stream, table.write, f"{folder}/checkpoint", mode="update")
    got = table.current().withColumnRenamed("n", "n_messages")
    want = thread_latest(whole).fillna(0, ["state_chars"])
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
