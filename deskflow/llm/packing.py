"""Packs tokenised documents into sequences of fixed capacity by large-item matching.

Texts become token ids inside tasks; what is longer than the capacity is cut. The lengths of pieces are whole numbers
up to the capacity, so how many pieces there are of each length says all that a packing needs to know, however large
the corpus. From these counts the plan is made: pieces above a third of the capacity go at most two to a sequence, each
length, the longest first, matched with the longest that fits beside it; then shorter pieces, the longest first, go where
the gap is the smallest that takes them, and into new sequences when none does. Equal lengths move in whole stretches,
so the plan has some ten thousand steps at most, for any number of pieces. Every piece then finds its place from its
number among the pieces of its length, which ranges count.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import number_rows
from ..session import work_dir
from .common import row_key, stored

CAPACITY = 2048
KNOWN = 1 << 19  # words whose ids a Python worker keeps, twice
TOGETHER = 64  # new words that are encoded as one text
TEXT_BYTES = 1 << 20  # of texts that are split into words at once
ROWS = 1 << 9  # texts whose ids a Python worker holds
END = 0  # the id that closes a document
_BREAK = "\x01"  # a sign of its own id, put between words that are encoded together

_BLANK = re.compile(rb"[\x20\x09-\x0D]")

_WORKER: dict[str, object] = {}


def word_ids(model: str, words: set[bytes]) -> dict[bytes, bytes]:
    """Of each word and others the ids, as little-endian 32-bit numbers; `model` is the tokenizer's file as text.

    The tokenizer drops white space and merges nothing across it, so a text's ids are those of its words in order. A
    worker keeps two generations of words: what is asked for again moves to the younger one, and the older one goes.
    """
    if _WORKER.get("model") != model:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(model)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        apart = tokenizer.encode(_BREAK, add_special_tokens=False).ids
        plain = tokenizer.encode("tokens", add_special_tokens=False).ids == [t.id for t in tokenizer.model.tokenize("tokens")]
        _WORKER.update(model=model, tokenizer=tokenizer, plain=plain, apart=apart[0] if len(apart) == 1 else None, known={}, older={})
    if len(_WORKER["known"]) > KNOWN:
        _WORKER.update(known={}, older=_WORKER["known"])
    known, older, encode, apart = (_WORKER[k] for k in ("known", "older", "tokenizer", "apart"))
    encode, merge, plain = encode.encode_batch_fast, encode.model.tokenize, _WORKER["plain"]
    alone, joined = [], []
    for word in [w for w in words if w not in known]:
        ids = older.get(word)
        if ids is not None:
            known[word] = ids
        elif plain and word.isalpha():  # a-z: one run of letters that nothing is done to before the merges
            ids = [t.id for t in merge(word.decode())]
            known[word] = struct.pack(f"<{len(ids)}I", *ids)
        elif apart is None or _BREAK.encode() in word:
            alone.append(word)
        else:
            joined.append(word)
    for word, found in zip(alone, encode([w.decode() for w in alone], add_special_tokens=False)):
        known[word] = np.array(found.ids, "<u4").tobytes()
    runs = [joined[i : i + TOGETHER] for i in range(0, len(joined), TOGETHER)]
    texts = [b" \x01 ".join(run).decode() for run in runs]
    for run, found in zip(runs, encode(texts, add_special_tokens=False)):
        ids = np.array(found.ids, "<u4")
        data, ends = ids.tobytes(), (4 * np.append(np.flatnonzero(ids == apart), len(ids))).tolist()
        known.update((w, data[b:e]) for w, b, e in zip(run, [0, *[e + 4 for e in ends]], ends))
    return known


def text_ids(model: str, texts: list[bytes]) -> list[bytes]:
    """The ids of each text; about a megabyte is in work at a time, of many texts or of one."""
    parts: list[list[bytes]] = [[] for _ in texts]
    held: list[tuple[int, list[bytes]]] = []
    size = 0

    def read():
        known = word_ids(model, set().union(*[words for _, words in held]))
        for i, words in held:
            parts[i].append(b"".join(map(known.__getitem__, words)))
        held.clear()

    for i, text in enumerate(texts):
        begin = 0
        while begin < len(text):
            blank = _BLANK.search(text, begin + TEXT_BYTES)
            end = blank.start() if blank else len(text)
            # A-Z only are lowered here, which the tokenizer does too; words are cut at [\x20\x09-\x0D]
            held.append((i, text[begin:end].lower().split()))
            size += end - begin
            begin = end
            if size >= TEXT_BYTES:
                read()
                size = 0
    read()
    return [b"".join(p) for p in parts]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, tie (tells rows apart), piece, start, length and ids_crc32 of the pieces of each text, and their ids if asked for."""
    with open(tokenizer, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary: some megabytes

    def cut(batches):
        for batch in batches:
            for b in range(0, batch.num_rows, ROWS):
                part, rows = batch.slice(b, ROWS), []
                texts = [(text or "").encode() for text in part.column("text").to_pylist()]
                for at, ids in enumerate(text_ids(sent.value, texts)):
                    ids += np.array([END], "<u4").tobytes()
                    for piece, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        some = ids[begin : begin + 4 * capacity]
                        rows.append((at, piece, begin // 4, len(some) // 4, zlib.crc32(some), some if keep_ids else None))
                if rows:
                    yield made(part, rows)

    def made(batch, rows):
        at, piece, start, length, crc, ids = zip(*rows)
        at = pa.array(at, pa.int32())
        columns = [batch.column("doc_id").take(at), batch.column("tie").take(at), pa.array(piece, pa.int32())]
        columns += [pa.array(x, pa.int64()) for x in (start, length, crc)] + ([pa.array(ids, pa.binary())] if keep_ids else [])
        return pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "tie", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    kind = "doc_id long, tie long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return docs.select("doc_id", row_key().alias("tie"), "text").mapInArrow(cut, kind)


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, pieces, pieces to a sequence, first sequence, offset) that place all pieces of the lengths counted."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] = n
    steps, third, made = [], capacity // 3, 0
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # stretches (first sequence, how many) by gap

    for a in range(capacity, third, -1):
        while left[a]:
            pair = next((b for b in range(min(a, capacity - a), third, -1) if left[b] > (a == b)), 0)
            n = min(left[a], left[pair]) if pair != a else left[a] // 2
            n = n if pair else left[a]
            steps.append((a, n, 1, made, 0))
            left[a] -= n
            if pair:
                steps.append((pair, n, 1, made, a))
                left[pair] -= n
            gaps[capacity - a - pair].append((made, n))
            made += n
    for size in range(third, 0, -1):
        while left[size]:
            gap = next((g for g in range(size, capacity) if gaps[g]), 0)
            if gap:
                first, n = gaps[gap].pop()
            else:
                gap, first = capacity, made
                n = -(-left[size] // (capacity // size))
                made += n
            each = gap // size
            placed = min(left[size], n * each)
            steps.append((size, placed, each, first, capacity - gap))
            left[size] -= placed
            full, rest = divmod(placed, each)
            if full:
                gaps[gap - each * size].append((first, full))
            if rest:
                gaps[gap - rest * size].append((first + full, 1))
            full += rest > 0
            if full < n:
                gaps[gap].append((first + full, n - full))
    return steps


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of `docs` (doc_id, text).

    A document is its ids and a closing 0, so a null or empty text is one piece of length 1. Only documents longer
    than `capacity` are cut. Equal rows and rows that repeat a doc_id are packed each for itself; a null doc_id stays
    null. No rows give no rows; other columns are ignored. With `keep_ids` the ids of each piece come along.
    """
    spark = docs.sparkSession
    pieces = token_pieces(docs, tokenizer, capacity, keep_ids).withColumn("row", F.monotonically_increasing_id())
    pieces = stored(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row for each length
    before, seq = {}, 0
    for length in sorted(counts):
        before[length], seq = seq, seq + counts[length]
    steps = []
    for length, n, each, first, offset in packing_plan(counts, capacity):
        steps.append((before[length], length, each, first, offset))
        before[length] += n
    table = np.array(sorted(steps), np.int64).reshape(-1, 5)
    sent = spark.sparkContext.broadcast(table)  # some ten thousand rows at most

    def place(batches):
        for batch in batches:
            nth = batch.column("seq").to_numpy()
            begin, length, each, first, offset = sent.value[np.searchsorted(sent.value[:, 0], nth, side="right") - 1].T
            nth = nth - begin
            columns = [batch.column(c) for c in names] + [pa.array(first + nth // each), pa.array(offset + nth % each * length)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    numbered = number_rows(pieces, ["length", "tie", "row"], "seq", work_dir(spark, "by-length"), 0)
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return numbered.select(*names, "seq").mapInArrow(place, f"{kind}, sequence_id long, offset long")


def sequences(places: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence of `places` (packed with keep_ids); one holds `capacity` ids at most."""
    parts = places.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    def read(batches):
        for batch in batches:
            ids = [np.frombuffer(b"".join(p["ids"] for p in row), "<u4").astype(np.int64).tolist() for row in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int64()))], ["sequence_id", "ids"])

    return parts.mapInArrow(read, "sequence_id long, ids array<long>")
