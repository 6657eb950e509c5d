"""The stages of the corpus pipeline against plain versions of what each decides."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from deskflow.llm.common import stored
from deskflow.llm.decontaminate import nearest
from deskflow.llm.identifiers import known_spans
from deskflow.llm.registry import table

from . import cases
from .cases import rows
from .test_duplicates import expected_components


@pytest.fixture(scope="module")
def steps(spark, base):
    """What goes into each stage and comes out of it, over the documents of the smallest tables and the odd rows."""
    docs = table(spark, base, "documents")
    odd = spark.createDataFrame([(None if d is None else d + 1_000_000, t) for d, t in rows()], "doc_id long, text string")
    odd = odd.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs = docs.unionByName(odd).withColumn("__extra", F.lit("kept")).withColumn("key", F.lit(5))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], base), "step"))
    return [(df.columns, [r.asDict() for r in df.collect()]) for df in out]


def pairs(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=str)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "PII", "mixing sources to target weights",
    ]


def test_columns_are_those_of_documents(steps):
    first = steps[0][0]
    assert all(columns == first for columns, _ in steps[1:5])
    assert all(r["__extra"] == "kept" and r["key"] == 5 for _, rows in steps[:5] for r in rows)


def test_quality_keeps_the_good(spark, base, steps):
    kept = pairs(steps[1][1])
    assert set(kept) <= set(pairs(steps[0][1]))
    quality = {r["doc_id"]: r["quality"] for r in table(spark, base, "labels").collect()}
    ids = {r["doc_id"] for r in steps[1][1]}
    known = [r["doc_id"] for r in steps[0][1] if r["doc_id"] in quality]
    assert sum((d in ids) == bool(quality[d]) for d in known) >= 0.97 * len(known)


def test_one_of_each_group_stays(steps):
    before, after = pairs(steps[1][1]), pairs(steps[2][1])
    expected = expected_components(before, 5, 80, 100)
    own = sorted({(d, c) for d, n, c in expected if n and d != c}, key=str)
    assert not {d for d, _ in after if d is not None} & ({d for d, c in own} - {d for d, n, c in expected if d == c})
    groups = {c for d, n, c in expected if n and c is not None}
    assert groups <= {d for d, _ in after}
    empty = lambda rows: sorted((x for x in rows if not (x[1] or "").split()), key=str)
    assert empty(after) == empty(before)
    with_words = [(d, t) for d, t in after if (t or "").split()]
    assert len(with_words) == len(set(with_words))


def test_leaks_go_and_nothing_else(spark, base, steps):
    plain = lambda t: " ".join((t or "").lower().split()).encode()
    items = [plain(r["text"]) for r in table(spark, base, "benchmark").collect()]
    before, after = steps[2][1], set(pairs(steps[3][1]))
    for r in before:
        text = plain(r["text"])
        gone = (r["doc_id"], r["text"]) not in after
        if any(i in text for i in items):
            assert gone
        elif gone:
            assert any(nearest(i, text)[0] <= len(i) // 10 for i in items)


def test_identifiers_are_masked(steps):
    before, after = steps[3][1], steps[4][1]
    assert len(before) == len(after)
    ids = [r["doc_id"] for r in before]
    texts = {r["doc_id"]: r["text"] for r in before if ids.count(r["doc_id"]) == 1}
    for r in (r for r in after if r["doc_id"] in texts):
        assert not known_spans(r["text"] or "")
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"])) or r["text"] == texts[r["doc_id"]]
        if not known_spans(texts[r["doc_id"]] or ""):
            assert r["text"] == texts[r["doc_id"]]
    assert any(r["doc_id"] in texts and texts[r["doc_id"]] != r["text"] for r in after)


def test_mix_takes_near_the_targets(steps):
    docs, (columns, mixed) = steps[4][1], steps[5]
    assert len(mixed) == len(docs) and {"doc_id", "size", "source_size", "target", "taken"} <= set(columns)
    total = sum(r["size"] for r in mixed)
    assert all(r["taken"] <= 2 * r["size"] for r in mixed)
    assert abs(sum(r["taken"] for r in mixed) - 1.5 * total) <= 0.01 * total


def test_stages_of_no_rows(spark, base):
    docs = table(spark, base, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, base), "none")
        assert docs.count() == 0


def test_one_of_each_group_stays_where_ids_repeat_or_are_null(spark, base):
    one = cases.prose(71, 150).split()
    two = [*one[:70], "other", *one[71:]]
    three = [*one[:30], "another", *one[31:]]
    far = cases.prose(72, 150)
    texts = [" ".join(x) for x in (one, two, three)]
    rows = [(1, texts[0]), (1, texts[1]), (5, texts[2]), (5, far), (5, far)]
    kept = corpus_pipeline.drop_copies(spark, cases.docs(spark, rows), base).select("doc_id", "text").collect()
    assert len(kept) == 2 and sorted(r["doc_id"] for r in kept) == [1, 5] and far in {r["text"] for r in kept}
    nameless = [(None, t) for t in texts] + [(None, far), (None, None), (None, " ")]
    kept = corpus_pipeline.drop_copies(spark, cases.docs(spark, nameless), base).select("text").collect()
    kept = [r["text"] for r in kept]
    assert len(kept) == 4 and sum(t in texts for t in kept) == 1 and far in kept and None in kept
