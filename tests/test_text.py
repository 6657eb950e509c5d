import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskflow.functions import text as tx
from deskflow.functions.vectors import cosine, term_counts, unit
from deskflow.sources.tables import read_documents
from deskflow.plans import QUERIES
from deskflow.operators.search import embed_with, nearest, nearest_approx, recall

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
TEXTS = st.lists(st.text(alphabet="ab cé\n\t 😀-@,", max_size=120), min_size=1, max_size=8)


def column(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def windows(text, size, overlap):
    flat, step = " ".join(text.split()), size - overlap
    return [flat[i : i + size] for i in range(0, len(flat), step) if flat[i : i + size].strip()]


@pytest.mark.parametrize("length, n", [(0, 0), (1, 1), (580, 1), (581, 2), (700, 2), (1160, 2), (1161, 3)])
def test_chunk_counts(spark, length, n):
    assert len(column(spark, ["x" * length], tx.chunks)[0]) == n


@SLOW
@given(TEXTS, st.sampled_from([(10, 3), (9, 8), (5, 0), (700, 120)]))
def test_chunks(spark, texts, shape):
    size, overlap = shape
    found = column(spark, texts, lambda t: tx.chunks(t, size, overlap))
    assert found == [windows(t, size, overlap) for t in texts]


def test_overlap_must_be_smaller():
    with pytest.raises(ValueError):
        tx.chunks(None, 10, 10)


@SLOW
@given(TEXTS, st.sampled_from([4, 12, 95]))
def test_wrap_is_greedy_and_loses_nothing(spark, texts, width):
    lines = [t.replace("\n", " ") for t in texts]
    for line, parts in zip(lines, column(spark, lines, lambda t: tx.wrap_line(t, width))):
        words = line.split()
        assert [w for part in parts for w in part.split(" ") if w] == words
        for part in parts:
            assert len(part) <= width or " " not in part
        for part, following in zip(parts, parts[1:]):
            assert len(part) + 1 + len(following.split(" ")[0]) > width


def test_wrap_known_answers(spark):
    lines = ["one two three", "", "   ", "a verylongword b", "abc d"]
    assert column(spark, lines, lambda t: tx.wrap_line(t, 8)) == [
        ["one two", "three"], [""], [], ["a", "verylongword", "b"], ["abc d"],
    ]


def test_small_helpers(spark):
    assert column(spark, ["Jane.Doe+x@a.b", "--A  b--"], tx.slug) == ["jane-doe-x", "a-b"]
    assert column(spark, ["a, b  c,,", "", None], tx.split_clean) == [["a", "b", "c"], [], []]
    assert column(spark, ["x" * 300, "x" * 301], tx.snippet) == ["x" * 300, "x" * 300 + " ..."]
    assert column(spark, ["/a/b/c.pdf", "c.pdf"], tx.base_name) == ["c.pdf", "c.pdf"]
    assert column(spark, ["<p>a<!-- b --><script>x</script> c</p>"], tx.visible_text) == ["a c"]


def test_term_counts(spark):
    import hashlib

    texts = ["a b a", "", "Ab  aBé"]
    expected = []
    for t in texts:
        counts = [0.0] * 64
        for word in filter(None, t.lower().split(" ")):
            counts[int(hashlib.md5(word.encode()).hexdigest()[:6], 16) % 64] += 1
        expected.append(counts)
    assert column(spark, texts, term_counts) == expected
    counted = spark.createDataFrame([("",)], "t string").select(term_counts(F.col("t")).alias("c"))
    assert counted.select(unit(F.col("c"))).first()[0] == [0.0] * 64
    assert column(spark, [None], term_counts) == [None]


def vectors(spark, n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).round(3).tolist()) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5)


def brute(rows, asked, k):
    out = {}
    for query_id, q in asked:
        scored = []
        for i, v in rows:
            length = np.linalg.norm(v) * np.linalg.norm(q)
            if length > 0:
                scored.append((-round(np.dot(v, q) / length, 12), i))
        out[query_id] = [(i, float(np.floor(-s * 1e6 + 0.5) / 1e6)) for s, i in sorted(scored)[:k]]
    return out


def hits(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    return out


@pytest.mark.parametrize("block", [100, 5])
def test_nearest(spark, block):
    rows, stored = vectors(spark, 200)
    asked = [(100 + i, v) for i, v in rows[:12]]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    found = nearest(stored, queries, ["id"], 4, block=block)
    assert hits(found) == brute(rows, asked, 4)
    assert all(found_rows[0][1] == 1.0 for found_rows in hits(found).values())


def test_many_queries_meet_parts_of_the_rows(spark):
    rows, stored = vectors(spark, 300)
    asked = [(i + 1000, v) for i, v in rows[:70]] + [(5000, [0.0] * 8)]
    queries = spark.createDataFrame([*asked, (5001, None)], "query_id long, embedding array<double>")
    for part in (1 << 14, 40, 1):
        assert hits(nearest(stored, queries, ["id"], 5, block=16, part=part)) == brute(rows, asked[:-1], 5)
    empty = stored.limit(0)
    assert nearest(empty, queries, ["id"], 5, block=16).count() == 0


def test_close_scores_are_ranked_by_the_whole_score(spark):
    rows = [(1, [1.0, 2e-4]), (2, [1.0, 1e-4]), (3, [1.0, 3e-4])]  # cosines differ by less than a millionth
    stored = spark.createDataFrame(rows, "id long, embedding array<double>")
    queries = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert [i for i, _ in hits(nearest(stored, queries, ["id"], 3))[0]] == [2, 1, 3]


def test_nearest_with_copies_and_zero_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(50)] + [(99, [0.0, 0.0]), (100, [2.0, 1.0])]
    stored = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(4)
    queries = spark.createDataFrame([(0, [1.0, 2.0])], "query_id long, embedding array<double>")
    assert [i for i, _ in hits(nearest(stored, queries, ["id"], 3))[0]] == [0, 1, 2]
    assert nearest(stored, queries.limit(0), ["id"], 3).count() == 0


def test_buckets_recall(spark):
    rows, stored = vectors(spark, 400, dim=16)
    queries = spark.createDataFrame(rows[:40] + [(999, [0.0] * 16)], "query_id long, embedding array<double>")
    exact, approx = nearest(stored, queries, ["id"], 5), nearest_approx(stored, queries, ["id"], 5)
    n, found = recall(exact, approx, ["id"]).first()
    assert n == 200 and found >= 0.9 * n
    scores = {(q, i): s for q, found in hits(exact).items() for i, s in found}
    assert all(scores.get((q, i), s) == s for q, found in hits(approx).items() for i, s in found)


def test_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a b.txt").write_text("one\ntwo\n")
    (tmp_path / "c.txt").write_text("three")
    rows = {r["source"]: r["text"] for r in read_documents(spark, str(tmp_path)).collect()}
    assert set(rows.values()) == {"one\ntwo\n", "three"} and "c.txt" in rows


def test_embed_with_batches(spark):
    def model(texts):
        assert len(texts) <= 16
        return np.array([[len(t), 1.0] for t in texts])

    df = spark.range(100).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("t")).coalesce(2)
    rows = embed_with(df, "t", model).collect()
    assert len(rows) == 100 and all(r["embedding"] == [float(len(r["t"])), 1.0] for r in rows)


def test_query_ranks_the_right_text_first(spark):
    texts = {
        "airline": "jet fuel is our largest cost and we hedge jet fuel prices against a rise in crude",
        "telecom": "wireless net additions were solid and the fibre build matures with a covered dividend",
        "producer": "upstream production reached record levels and refining utilization was strong",
    }
    df = spark.createDataFrame(list(texts.items()), "name string, t string")
    asked = F.lit("exposure to jet fuel prices")
    counted = df.select("name", term_counts(F.col("t")).alias("a"), term_counts(asked).alias("b"))
    assert counted.orderBy(F.desc(cosine(F.col("a"), F.col("b")))).first()["name"] == "airline"


def test_neighbours_by_buckets_over_the_table(spark, base):
    vectors = spark.read.parquet(f"{base}/embeddings.parquet")
    rows = {r["vec_id"]: np.asarray(r["embedding"], float) for r in vectors.collect()}
    found, exact = {}, {}
    for r in QUERIES["vector_neighbours"](spark, base).collect():
        a, b = rows[r["query_id"]], rows[r["vec_id"]]
        assert abs(r["score"] - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-6
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    for r in QUERIES["vector_search_batch"](spark, base).collect():
        exact.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(exact) == {i for i in rows if i % 20 == 0}
    met = sum(len(found.get(q, set()) & e) for q, e in exact.items())
    assert met >= 0.9 * sum(map(len, exact.values()))


def test_cells_hold_the_hits_whatever_their_number(spark):
    # queries about one crowded group of copies and others; small cells and parts, so that all of them are cut
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(900)] + [(i, [1.0] * 8) for i in range(900, 1500)]
    stored = spark.createDataFrame(rows, "id long, embedding array<double>")
    queries = spark.createDataFrame(rows[::15], "query_id long, embedding array<double>")
    exact = nearest(stored, queries, ["id"], 4)
    approx = nearest_approx(stored, queries, ["id"], 4, cell_rows=60, part=100)
    n, found = recall(exact, approx, ["id"]).first()
    assert n == 400 and found >= 0.9 * n
    assert [i for i, _ in hits(approx)[900]] == [900, 901, 902, 903]


def test_rows_and_queries_of_the_approximate_search_are_not_paired_in_a_join(spark):
    rows, stored = vectors(spark, 300)
    queries = spark.createDataFrame(rows[:30], "query_id long, embedding array<double>")
    found = nearest_approx(stored, queries, ["id"], 4, cell_rows=30)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and found.count() == 120
