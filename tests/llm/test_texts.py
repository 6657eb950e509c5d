"""Classifiers, identifiers, decontamination, mixing and chat formatting."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deskflow.llm import language, mixing, quality
from deskflow.llm.chat import best_paths, format_conversations, linear_tree, read_back
from deskflow.llm.common import text_bytes
from deskflow.llm.decontaminate import RECALL, can_be_near, find_items, may_be_near, nearest, nearest_many, walk
from deskflow.llm.identifiers import LONG, WORD, _LOOSE, find_identifiers, known_spans, loose_spans, luhn, masked, mentions_of, patterns_around, windows_of
from deskflow.llm.mixing import mix_sources, schedule, source_targets
from deskflow.llm.queries import QUERIES
from deskflow.llm.registry import table

from .cases import docs, empty, prose, rows

# ---- language ----

SYLLABLES = {"xx": "ka mo ri ta su ne".split(), "yy": "sch ung eit ver ber".split(), "zz": "ção lhe nha qua".split()}


def said(lang, seed, n=30):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def test_language(spark):
    learn = [(said(x, i), x) for i in range(40) for x in SYLLABLES] + [(None, "xx"), ("text", None), ("", "yy")]
    model = language.fit(spark.createDataFrame(learn, "text string, lang string"))
    data = [(i, said(x, 1000 + i)) for i, x in enumerate(["xx", "yy", "zz"] * 5)]
    odd = [(100, None), (101, ""), (102, "123 !?"), (103, "ka " * 70000), (104, "日本語のテキスト"), (None, "ka mo"), (0, data[0][1])]
    got = language.predict(docs(spark, data + odd), model).collect()
    assert len(got) == len(data) + len(odd)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i, _ in data] == ["xx", "yy", "zz"] * 5
    assert [by[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and by[100]["score"] == 0 and by[102]["rejected"]
    assert by[103]["lang_pred"] == "xx" and by[104]["rejected"] and by[104]["lang_pred"] in SYLLABLES
    assert all(0 <= r["score"] <= 1 for r in got)
    assert language.predict(empty(spark), model).count() == 0
    nothing = language.fit(spark.createDataFrame([], "text string, lang string"))
    assert {r["lang_pred"] for r in language.predict(docs(spark), nothing).collect()} == {"und"}


def test_no_language_is_lost_to_copies(spark):
    learn = [(said("xx", i), "xx") for i in range(40)] + [(f"{said('zz', i % 3)}", "zz") for i in range(6000)]
    model = language.fit(spark.createDataFrame(learn, "text string, lang string"))
    assert sorted(set(model["names"])) == ["xx", "zz"] and model["names"].count("zz") <= 3
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs(spark, [(i, said(x, 900)) for i, x in enumerate(["xx", "zz"])]), model).collect()}
    assert got == {0: "xx", 1: "zz"}


def test_more_languages_than_the_sample_has_texts(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 5)
    learn = [(f"{chr(97 + i)}{chr(98 + i)} " * 9, f"l{i}") for i in range(12) for _ in range(2)]
    assert sorted(language.fit(spark.createDataFrame(learn, "text string, lang string"))["names"]) == sorted(f"l{i}" for i in range(12))


def test_language_vectors_are_those_of_plain_loops(spark):
    texts = [said("xx", 1), "A b", "", "12", "Ça va? ça VA", "ab-ab ab"]

    def grams(text):
        raw = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()]
        x, out = [32, *raw, 32], np.zeros(language.DIMS)
        for n, first, slots, factor in ((2, 0, language.TWO, 2654435761), (3, language.TWO, language.THREE, 2246822519)):
            for i in range(len(x) - n + 1):
                gram = x[i : i + n]
                # a gram of two gaps side by side says nothing
                if any(gram[k : k + 2] == [32, 32] for k in range(n - 1)):
                    continue
                number = sum(b << 8 * k for k, b in enumerate(gram))
                out[first + (number * factor % 2**32) * slots // 2**32] += 1
        return out

    data, at = text_bytes(pa.array(texts, pa.large_string()))
    want = np.stack([grams(t) for t in texts])
    assert (language.gram_counts(data, at) == want).all()
    model = language.fit(spark.createDataFrame([(t, "xx" if i % 2 else "yy") for i, t in enumerate(texts)], "text string, lang string"))
    idf = [math.log((1 + len(texts)) / (1 + sum(w[k] > 0 for w in want))) + 0.05 for k in range(language.DIMS)]
    assert np.allclose(model["idf"], idf, atol=1e-5)
    for r in language.predict(docs(spark, list(enumerate(texts))), model).collect():
        x = np.log1p(want[r["doc_id"]]) * idf
        norm = math.sqrt(sum(v * v for v in x))
        cosines = [sum(v * c for v, c in zip(x, center)) / norm for center in model["centers"]] if norm else [0]
        assert abs(r["score"] - max(cosines)) < 1e-5 and (not norm or r["lang_pred"] == model["names"][int(np.argmax(cosines))])


def test_language_held_out(spark, base):
    real = QUERIES["op3_language"](spark, base).join(table(spark, base, "documents").select("doc_id", "lang"), "doc_id")
    right = real.where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.9


# ---- quality ----


def test_quality_scores_the_whole_text():
    model = quality.train([b"good words here " * 8, b"*** *** bad &&& " * 8] * 60, np.array([1, 0] * 60, np.float32))
    texts = ["good words here " * 30, "bad &&& *** " * 30, "", "go", None]
    import pyarrow as pa

    data, at = text_bytes(pa.array(texts))
    scores = quality.probability(model, data, at)
    assert scores[0] > 0.9 and scores[1] < 0.1 and ((0 <= scores) & (scores <= 1)).all() and scores[2] == scores[4]
    long = ("good words here " * 4000 + "*** bad &&& " * 40).encode()
    whole = quality.probability(model, np.frombuffer(long, np.uint8), np.array([0, len(long)]))[0]
    head = quality.probability(model, np.frombuffer(long[:60000], np.uint8), np.array([0, 60000]))[0]
    assert whole < head


def test_responses_cover_every_byte():
    weights = np.zeros((quality.WIDTH, 256, quality.FILTERS), np.float32)
    weights[:, 7, 0] = 1
    for n in (1, 3, 4, 252, 255, 256, 257, 600):
        for at in {0, n // 2, n - 1}:
            data = np.zeros(n, np.uint8)
            data[at] = 7
            laid, first = quality.laid_out(data, np.array([0, n]))
            assert quality.responses(weights, laid, first)[..., 0].max() == 1


def test_quality_of_odd_rows(spark):
    texts = spark.createDataFrame([(1, "plain words"), (2, None), (3, "### $$$ %%%"), (4, "odd"), (5, "x"), (None, "y"), (1, "again")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (4, 7), (5, None), (None, 1), (99, 1)], "doc_id long, quality int")
    model = quality.fit(texts, labels)
    got = quality.scored(docs(spark), model).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert quality.scored(empty(spark), model).count() == 0
    flat = quality.fit(texts, labels.where("quality = 1"))
    assert {r["score"] for r in quality.scored(docs(spark), flat).collect()} == {0.5}


def test_quality_held_out(spark, base):
    base = base.replace("sf0.001", "sf0.01")
    real = QUERIES["op8_quality"](spark, base).join(table(spark, base, "labels"), "doc_id")
    right = real.where("held_out").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert right >= 0.95


def test_labels_of_one_document_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 20000)
    seen = {}

    def train(texts, truth):
        seen["texts"] = texts
        return None

    monkeypatch.setattr(quality, "train", train)
    data = [(1, prose(i % 400, 60)) for i in range(1200)] + [(i, prose(i, 60)) for i in range(1000, 1010)]
    labels = spark.createDataFrame([(1, 0)] * 500 + [(i, 1) for i in range(1000, 1010)], "doc_id long, quality int")
    quality.fit(docs(spark, data), labels)
    hot = [t for t in seen["texts"] if t.decode() in {prose(i, 60) for i in range(400)}]
    assert len(hot) == len(set(hot)) and 0.5 * 20000 <= sum(map(len, hot)) <= 1.5 * 20000 and len(seen["texts"]) - len(hot) == 10


# ---- identifiers ----

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_form(text):
    out = []
    for k, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((k, m.start(), m.end()))
    return out


def test_known_spans_are_those_of_the_forms():
    rng = random.Random(1)
    parts = ["a@b.c", "x_y", "@", ".", "1.2.3.4", "300.1.1.1", "00012.0255.1.1", "4111 1111-1111 1111", "4111111111111112", "+1 (555) 123-4567", "+", "9", " ", "-", "é", "\n", "0.0.0.0.1.2.3.4", "a@b", "%"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 9)))
        assert known_spans(text) == by_form(text), text
    assert known_spans("a" * 200000) == [] and known_spans("1" * 200000) == [] and known_spans("1." * 100000) != []


def test_luhn():
    assert luhn("4111111111111111") and luhn("79927398713") and not luhn("4111111111111112")


def test_identifiers_learn_patterns(spark):
    rng = random.Random(2)
    data = [(i, f"{prose(i, 9)} please call me at +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} today {prose(i + 50, 5)}") for i in range(12)]
    data += [(50, "please call me at 202-555-0143 today"), (51, "the score was 202-555-0143 in a game"), (52, "order number 20 15 33 44 and 7")]
    data += [(60, None), (61, ""), (62, "word " * 50000 + "me@x.org"), (63, "me@x.org"), (63, "me@x.org"), (None, "me@x.org"), (64, "write me (at) x.org")]
    got = find_identifiers(docs(spark, data)).collect()
    assert len(got) == len(data)
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in got}
    assert spans[50] == [("phone", 18, 30)] and spans[51] == [] and spans[52] == []
    assert spans[60] == spans[61] == [] and spans[62] == [("email", 250000, 250008)] and spans[63] == spans[None] == [("email", 0, 8)]
    for r in got:
        assert {tuple(s) for s in r["known"]} <= {tuple(s) for s in r["spans"]}
    assert find_identifiers(empty(spark)).count() == 0


def test_looser_forms_are_those_of_the_whole_text():
    found = lambda text: loose_spans(text, windows_of(text))
    whole = lambda text: [(k, m.start(), m.end()) for k, form in _LOOSE.items() for m in form.finditer(text)]
    filler = "ab cde fghi jklm nop " * 12
    for form in ("030 123 456 78", "4111 1111 1111 1112", "10 . 20 . 30 . 40", "me (at) x (dot) org", "me @ some-name . x . org", f"me@{'a' * 60}.{'b' * 60} . org"):
        for n in range(200):
            text = "7 " + filler[:n] + " phone " + form + " " + filler[:n] + "8"
            at = text.index(form)
            got = [(a, b) for _, a, b, seed, _ in (m[1:] for m in mentions_of(text, [])) if not seed]
            assert (at, at + len(form)) in got, text
            assert found(text) == whole(text), text
    rng = random.Random(3)
    parts = ["12", "345", " ", " ", ".", "-", "(", ")", "@", "(at)", "[at]", "x", "yz", " word " * 8, " word " * 15, "w" * 70, "\n", "é", " . "]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 30)))
        assert found(text) == whole(text), text
    found("a" * 200000 + "@" + "1" * 200000)


def test_patterns_are_whole_words():
    def plain_patterns(text, start, end):
        left, right = text[:start].split(), text[end:].split()
        left = [LONG if len(w) > WORD else w.lower() for w in left]
        if left and left[-1] == LONG:
            left = [LONG, LONG]
        right = [LONG if len(w) > WORD else w.lower() for w in right]
        return ([f"{left[-2]} {left[-1]} _"] if len(left) > 1 else []) + ([f"{left[-1]} _ {right[0]}"] if left and right else [])

    rng = random.Random(8)
    parts = ["Word ", "x" * 63, "y" * 64, "z" * 65, " ", "\n", " " * 150, " " * 900, "é", "end. ", "w" * 300, "call me at "]
    for _ in range(4000):
        left, right = ("".join(rng.choices(parts, k=rng.randrange(0, 8))) for _ in range(2))
        text = left + "9" + right
        assert patterns_around(text, len(left), len(left) + 1) == plain_patterns(text, len(left), len(left) + 1), text
    mentions_of("a@b.c," * 100000, [])


def test_long_tokens_are_different_values():
    a, b = "9" * 80 + "x", "9" * 80 + "y"
    values = [m[1] for m in mentions_of(f"{a} {b} {a} 7", []) if m[0] == ""]
    assert values[0] == values[2] != values[1] and values[3] == "7" and max(map(len, values)) <= 64


def test_masked():
    spans = [{"kind": "email", "start": 3, "end": 11}, {"kind": "phone", "start": 8, "end": 14}]
    assert masked("to me@x.org12345 end", spans) == "to [email]45 end" and masked(None, spans) is None and masked("a", []) == "a"


# ---- decontamination ----


def edit_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_nearest_is_the_edit_distance():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(1, n))).encode() for n in (14, 30))
        assert nearest(a, b)[0] == edit_distance(a, b)


def test_many_alignments_at_once_are_those_one_by_one():
    rng = random.Random(5)
    patterns, texts = [], []
    for n in [1, 2, 63, 64, 65, 127, 128, 129, 200, 300, 500, 1024, 1025, 1500] * 12:
        pattern = "".join(rng.choices("abcd\0é", k=n)).encode()[:n]
        patterns.append(pattern)
        near = bytearray(pattern)
        for _ in range(rng.randrange(0, n // 8 + 2)):
            at = rng.randrange(len(near) + 1)
            near[at : at + rng.randrange(2)] = b"x" * rng.randrange(2)
        before, after = (bytes(rng.choices(b"abcd\0", k=rng.randrange(0, n + 3))) for _ in range(2))
        texts.append(rng.choice([before + bytes(near) + after, bytes(near), bytes(near[: n // 2]), before, b""]))
    got = nearest_many(patterns, texts)
    assert got.tolist() == [nearest(p, t)[0] for p, t in zip(patterns, texts)] and len(nearest_many([], [])) == 0


def test_items_are_found(spark):
    items = [(i, prose(500 + i, n)) for i, n in enumerate([3, 6, 12, 25, 50, 100])] + [(90, None), (91, "  "), (92, "z"), (0, prose(700, 20))]
    data, want = [], set()
    for i, text in items:
        if text and text.strip():
            d = 1000 + len(data)
            data.append((d, prose(d, 40) + "\n" + text.upper().replace(" ", "\n  ") + " " + prose(d + 1, 40)))
            want.add((d, i))
    for k in range(30):
        i, text = items[5 - k % 3]
        chars = list(text)
        for at in random.Random(k).sample(range(len(chars)), len(chars) // 40):
            chars[at] = "#"
        data.append((2000 + k, prose(3000 + k, 30) + " " + "".join(chars) + " " + prose(4000 + k, 30)))
        want.add((2000 + k, i))
    clean = [(5000 + k, prose(6000 + k, 200)) for k in range(20)] + [(6000, None), (6001, ""), (6002, items[5][1][:300])]
    benchmark = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, size string")
    got = {(r["doc_id"], r["item_id"]) for r in find_items(docs(spark, data + clean), benchmark).collect()}
    plain = lambda t: " ".join(t.lower().split()).encode()
    real = {(d, i) for d, t in data + clean if t for i, x in items if x and x.strip() and plain(t).strip() and nearest(plain(x), plain(t))[0] * 10 <= len(plain(x))}
    assert got <= real and want <= real
    assert len(got & want) >= 0.9 * len(want) and {w for w in want if w[0] < 2000} <= got
    assert find_items(empty(spark), benchmark).count() == 0 and find_items(docs(spark), benchmark.limit(0)).count() == 0


def edited(text, k, rng):
    """The text after k random substitutions, insertions and deletions of a character."""
    chars = list(text)
    for _ in range(k):
        at, c = rng.randrange(len(chars)), rng.choice("abcdefghijklmnopqrstuvwxyz0123456789")
        chars[at : at + rng.randrange(2)] = [c] * rng.randrange(2)
    return "".join(chars)


def recall_of(spark, lengths, share, trials):
    """Share of items found by length: each stands in one document with the given share of its length in edits."""
    rng, items, data = random.Random(11), [], []
    for n in lengths:
        for _ in range(trials):
            i = len(items)
            item = prose(10000 + i, n)[:n].strip()
            items.append((i, item.ljust(n, "x")))
            data.append((i, prose(30000 + i, rng.randrange(5, 15)) + " " + edited(items[i][1], int(n * share), rng) + " " + prose(50000 + i, 10)))
    real = {i for (i, x), (_, t) in zip(items, data) if nearest(x.encode(), t.encode())[0] <= len(x) // 10}
    got = find_items(docs(spark, data), spark.createDataFrame(items, "item_id long, text string")).where("doc_id = item_id").collect()
    got = {r["item_id"] for r in got}
    assert got <= real
    parts = {n: {i for i in real if len(items[i][1]) == n} for n in lengths}
    return {n: len(part & got) / len(part) for n, part in parts.items()}


def test_items_at_the_limit_of_edits(spark):
    found = recall_of(spark, [16, 30, 40, 60, 80, 110, 200, 300], 0.1, 100)
    assert min(found.values()) >= RECALL, found


# ---- mixing ----


def filled(sizes, weights, share, most):
    total, full = sum(sizes) * share, set()
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        level = (total - sum(most * sizes[i] for i in full)) / sum(weights[i] for i in free)
        over = {i for i in free if weights[i] * level > most * sizes[i]}
        if not over:
            return [most * sizes[i] if i in full else weights[i] * level for i in range(len(sizes))]
        full |= over


def test_mixing(spark):
    rng = random.Random(6)
    sources = ["b", "a", None, "ä", "z", ""]
    data = [(i, prose(i, rng.randrange(0, 60)), sources[min(i % 9, 5)]) for i in range(200)] + [(500, None, "a"), (501, "", "empty"), (7, "w", "a"), (7, "w", "a"), (None, "v v", "a")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("key", F.lit(1)).repartition(3)
    got = [tuple(r) for r in mix_sources(df).collect()]
    assert len(got) == len(data) and sorted(got, key=str) == sorted((tuple(r) for r in mix_sources(df.repartition(5)).collect()), key=str)
    size = {}
    for _, t, s in data:
        size[s] = size.get(s, 0) + len((t or "").split())
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    target = dict(zip(names, filled([size[s] for s in names], [(5.0, 2.0, 1.0)[i % 3] for i in range(len(names))], 1.5, 2)))
    rows_by = {(d, n): None for d, n, *_ in got}
    assert len(rows_by) >= len({d for d, *_ in data})
    taken = {}
    for d, n, whole, goal, took in got:
        assert 0 <= took <= 2 * n
        taken.setdefault((whole, round(goal, 6)), []).append(took)
    for s in names:
        assert any(whole == size[s] and abs(goal - target[s]) < 1e-6 and abs(sum(t) - target[s]) <= max(4, 0.02 * target[s]) for (whole, goal), t in taken.items()), s
    assert mix_sources(df.limit(0)).count() == 0
    assert {r["taken"] for r in mix_sources(spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")).collect()} == {0}


def test_small_sources_of_a_large_corpus(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", 64)  # as if the corpus were so much larger
    data = [(i, prose(i, 100), "large") for i in range(200)] + [(1000 + 3 * s + i, prose(s, 5 + s % 7), f"s{s}") for s in range(30) for i in range(3)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mix_sources(df).join(df.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(got) == 31 and all(abs(r["taken"] - r["target"]) <= max(4, 0.02 * r["target"]) for r in got), got


def test_slots_follow_the_number_of_sources(spark):
    targets = [(0, 4_000_000_000, 6_000_000_000.0), (1, 3, 6.0), (2, 900, 1000.0)] + [(3 + i, 50, 100.0) for i in range(50)]
    df = spark.createDataFrame(targets, "sid long, source_size long, target double")
    slots = schedule(df, 4_000_000_000 // mixing.BLOCKS).groupBy("sid").agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.max("rank").alias("last"))
    got = {r["sid"]: r for r in slots.collect()}
    assert sum(r["n"] for r in got.values()) <= 1.5 * mixing.BLOCKS + 1000 + 2 * mixing.LEAST * len(targets)
    for sid, _, target in targets:
        assert got[sid]["n"] == got[sid]["last"] and abs(got[sid]["words"] - target) <= max(4, 0.02 * target), (sid, got[sid])


def test_what_is_taken_is_what_the_slots_say(spark):
    rng = random.Random(16)
    data = [(i, prose(i, rng.randrange(0, 300)), "abc"[i % 7 % 3]) for i in range(300)] + [(900, prose(900, 9), "tiny")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    sizes = sorted((r.asDict() for r in mixing.sized(df).collect()), key=lambda r: (r["h"], r["h2"]))
    targets = source_targets(mixing.sized(df))
    names = {r["sid"]: r["key"] for r in targets.collect()}
    total = sum(r["size"] for r in sizes)
    want = dict.fromkeys((r["doc_id"] for r in sizes), 0)
    # the streams of the sources, word by word
    streams = {sid: [r["doc_id"] for r in sizes if r["key"] == key for _ in range(r["size"])] for sid, key in names.items()}
    for slot in schedule(targets, max(1, -(-total // mixing.BLOCKS))).collect():
        stream = streams[slot["sid"]]
        first = (slot["rank"] - 1) * slot["words"]
        for at in range(first, min(first + slot["words"], 2 * len(stream))):
            want[stream[at % len(stream)]] += 1
        assert (slot["epoch"], slot["block"]) == (first // len(stream), first % len(stream) // slot["words"])
    assert {r["doc_id"]: r["taken"] for r in mix_sources(df).collect()} == want


def test_parts_of_documents_are_not_broadcast(spark):
    df = spark.createDataFrame([(i, prose(i, 100), "ab"[i % 2]) for i in range(50)], "doc_id long, text string, source string")
    joins = re.findall(r"(\w+Join) \[sid#\d+L, nth#\d+L\]", mix_sources(df)._jdf.queryExecution().executedPlan().toString())
    assert joins and set(joins) == {"SortMergeJoin"}


def test_schedule_mixes_every_stretch(spark):
    targets = spark.createDataFrame([(0, 1000, 1500.0), (1, 3000, 3000.0), (2, 500, 500.0)], "sid long, source_size long, target double")
    slots = schedule(targets, 1).orderBy("slot").collect()
    assert len(slots) == 5000 and [r["slot"] for r in slots] == list(range(5000))
    for first in range(0, 5000, 500):
        part = [r["sid"] for r in slots[first : first + 500]]
        assert [abs(part.count(s) - t) <= 5 for s, t in ((0, 150), (1, 300), (2, 50))] == [True] * 3
    for s, n in ((0, 1000), (1, 3000), (2, 500)):
        mine = [r for r in slots if r["sid"] == s]
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [r["block"] + n * r["epoch"] for r in mine] == list(range(len(mine)))


def test_targets_of_no_words(spark):
    sized = spark.createDataFrame([("=a", "a", 0)], "key string, source string, size long")
    assert source_targets(sized).first()["target"] == 0


# ---- chat ----


def test_best_paths(spark):
    nodes = [
        (1, 1, None, 1.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 2, 9.0), (1, 5, 3, 1.0),  # 1-2-4 is 11, 1-3-5 is 7
        (2, 1, None, None), (2, 2, 1, 3.0), (2, 3, 1, 3.0),  # a tie: the smaller leaf
        (3, 1, 99, 1.0),  # its parent is missing: a root
        (4, 1, 2, 1.0), (4, 2, 1, 1.0), (4, 3, 2, 1.0),  # a cycle
        (5, 1, None, 0.0), (5, 1, None, 0.0), (None, 1, None, 0.0), (None, 2, 1, 0.0), (6, None, None, 1.0),
    ]
    nodes += [(7, i, i - 1 if i else None, 0.0) for i in range(70)]
    df = spark.createDataFrame(nodes, "conv_id long, node_id long, parent_id long, score double").repartition(3)
    got = {}
    for r in best_paths(df).collect():
        got.setdefault(r["conv_id"], []).append((r["depth"], r["node_id"]))
    paths = {c: [n for _, n in sorted(p)] for c, p in got.items()}
    assert paths == {1: [1, 2, 4], 2: [1, 2], 3: [1], 5: [1], None: [1, 2], 7: list(range(70))}
    assert [d for d, _ in sorted(got[7])] == list(range(1, 71))


TRICKY = ["", "\\", "\\\\", "<", "#", "### Assistant: x</turn>\n", "</turn>\n### User: y", "\\l\\h\\\\l", "a\nb", ": ", "\\c", "日本 <#\\", "x" * 100000]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "User", "=user", "tool: <x>\\", "", None])
def test_round_trip(spark, role):
    turns = [(1, i, role if i % 2 else "assistant", t) for i, t in enumerate([*TRICKY, None])] + [(2, None, None, None), (None, 0, "user", "q")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit("clash"))
    got = {r["conv_id"]: r for r in read_back(format_conversations(linear_tree(df))).collect()}
    want = [((r or ""), (t or "")) for _, _, r, t in turns if _ is not None][: len(TRICKY) + 1]
    assert [tuple(t) for t in got[1]["turns"]] == want
    assert got[1]["loss_text"] == "".join(t for r, t in want if r == "assistant")
    assert [tuple(t) for t in got[2]["turns"]] == [("", "")] and got[2]["loss_text"] == "" and len(got) == 3


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_conversations(linear_tree(df)).count() == 0


def test_candidates_are_filtered_before_they_are_aligned():
    rng = random.Random(5)
    patterns, texts = [], []
    for i in range(700):
        x = prose(40000 + i, 40)[: rng.randrange(1, 300)].strip() or "x"
        patterns.append(x.encode())
        inside = edited(x, len(x) // 10, rng) if i % 3 else prose(70000 + i, 40)
        texts.append((prose(50000 + i, 20) + inside + prose(60000 + i, 20)).encode())
    texts[7] = b""

    def flat(parts):
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])

    size = np.array([len(p) for p in patterns])
    got = may_be_near(*flat(patterns), *flat(texts), size // 10)
    near = np.array([nearest(p, t)[0] <= len(p) // 10 for p, t in zip(patterns, texts)])
    exact = [can_be_near(np.frombuffer(p, np.uint8), np.frombuffer(t, np.uint8), len(p) // 10) for p, t in zip(patterns, texts)]
    assert (got >= near).all() and (got >= np.array(exact)).all()
    far = ~near & (size > 100)
    assert far.sum() > 50 and got[far].mean() < 0.7


def test_windows_walk_alike_wherever_they_stand():
    rng = np.random.default_rng(2)
    for width in (1, 4, 32):
        x = rng.integers(97, 123, 50_000).astype(np.uint8)
        start = np.arange(0, len(x) - width + 1)
        whole = walk(width).samples(x, start)
        alone = np.concatenate([walk(width).samples(x[i : i + width], np.zeros(1, np.int64)) for i in (0, 17, 20_000, len(x) - width)])
        assert (whole[[0, 17, 20_000, len(x) - width]] == alone).all()
