"""Hashes of very many places, sent in packed rows to blocks that are cut by hash, and what is found there sent back.

A packed row holds all hashes that a run of texts sends to one block, with the steps between their places, so a
place costs about ten bytes of shuffle. A block is one task's work: equal hashes meet there however often they
occur, as sorted numbers. What a block finds goes to the owner of the place in packed rows again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import lists, mix, trimmed

PACKED = "block int, docs binary, counts binary, hashes binary, steps binary, wide boolean"


def packed_row(values: list, names: list[str]) -> pa.RecordBatch:
    kinds = {bool: pa.bool_(), int: pa.int32(), bytes: pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[type(v)]) for v in values], names)


def dealt(group: np.ndarray, groups: int):
    """Each group that occurs, with the places where it does, in order."""
    order = np.argsort(group.astype(np.uint16 if groups < 1 << 16 else np.uint32), kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=groups)).tolist()
    for g, (first, end) in enumerate(zip([0, *ends], ends)):
        if end > first:
            yield g, order[first:end]


def pack(ids: np.ndarray, counts: np.ndarray, hashes: np.ndarray, blocks: int):
    """Packed rows of places: text `ids[i]` has `counts[i]` of them, in order."""
    used = np.flatnonzero(counts)
    if not len(used):
        return
    docs, each = ids[used].astype(np.int64).tobytes(), counts[used].astype(np.int32).tobytes()
    for block, mine in dealt(((hashes >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64), blocks):
        steps = np.diff(mine, prepend=0)
        wide = bool(steps.max() > 0xFFFF)
        steps = steps.astype(np.uint32 if wide else np.uint16).tobytes()
        yield packed_row([block, docs, each, hashes[mine].tobytes(), steps, wide], ["block", "docs", "counts", "hashes", "steps", "wide"])


def by_group(work):
    """Rows that come sorted by their first column, handed to `work` a group at a time, without that column."""

    def run(batches):
        held, rows = None, []
        for batch in batches:
            for group, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if group != held and rows:
                    yield from work(rows)
                    rows = []
                held = group
                rows.append(row)
        if rows:
            yield from work(rows)

    return trimmed(run)


def matched(packed: DataFrame, blocks: int, wanted) -> DataFrame:
    """(id, places): the places of each text that `wanted` says, numbered within the text as they were packed.

    `wanted` gets the texts' ids, sorted by hash, and where each hash begins; it returns a mask.
    """

    def look_up(rows):
        ids, places, hashes = [], [], []
        for docs, counts, h, steps, wide in rows:
            docs, counts = np.frombuffer(docs, np.int64), np.frombuffer(counts, np.int32)
            place = np.cumsum(np.frombuffer(steps, np.uint32 if wide else np.uint16), dtype=np.int64)
            begin = np.cumsum(counts, dtype=np.int64) - counts
            text = np.searchsorted(begin, place, side="right") - 1
            ids.append(docs[text])
            places.append((place - begin[text]).astype(np.int32))
            hashes.append(np.frombuffer(h, np.uint64))
        h = np.concatenate(hashes)
        order = np.argsort(h)
        h = h[order]
        new = np.empty(len(h), bool)
        new[0] = True
        np.not_equal(h[1:], h[:-1], out=new[1:])
        doc = np.concatenate(ids)[order]
        hit = np.flatnonzero(wanted(doc, np.flatnonzero(new)))
        doc, place = doc[hit], np.concatenate(places)[order[hit]]
        for owner, mine in dealt((mix(doc.view(np.uint64)) % np.uint64(blocks)).astype(np.int64), blocks):
            yield packed_row([owner, doc[mine].tobytes(), place[mine].tobytes()], ["owner", "docs", "places"])

    def gather(rows):
        doc = np.concatenate([np.frombuffer(d, np.int64) for d, _ in rows])
        place = np.concatenate([np.frombuffer(p, np.int32) for _, p in rows])
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order]
        begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        yield pa.RecordBatch.from_arrays([pa.array(doc[begin]), lists(place, np.diff(begin, append=len(doc)), pa.int32())], ["id", "places"])

    found = packed.repartitionById(blocks, "block").sortWithinPartitions("block").mapInArrow(by_group(look_up), "owner int, docs binary, places binary")
    found = found.repartitionById(blocks, "owner").sortWithinPartitions("owner")
    return found.mapInArrow(by_group(gather), "id long, places array<int>")


def frequent_bits(rows: DataFrame, hashes, least: int, bits: int, blocks: int) -> np.ndarray:
    """A bit map, at hash modulo `bits`, of the hashes that occur `least` times or more.

    `hashes` gets an Arrow batch and yields arrays of hashes; all are counted. The map has a fixed size: once it is
    full it says yes too often.
    """

    words = bits // 64

    def word_of(h):
        return ((h & np.uint64(bits - 1)) >> np.uint64(6)).astype(np.int64)

    def send(batches):
        for batch in batches:
            for h in hashes(batch):
                for block, mine in dealt(word_of(h) * blocks // words, blocks):
                    yield packed_row([block, h[mine].tobytes()], ["block", "hashes"])

    def count(rows):
        h, n = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for (x,) in rows]), return_counts=True)
        block = int(word_of(h[:1])[0]) * blocks // words
        first, end = -(-block * words // blocks), -(-(block + 1) * words // blocks)
        h = h[n >= least]
        part = np.zeros(end - first, np.uint64)
        np.bitwise_or.at(part, word_of(h) - first, np.uint64(1) << (h & np.uint64(63)))
        yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([part.tobytes()], pa.binary())], ["first", "part"])

    # a block owns a stretch of the map and sends it whole, so the driver gets the map's bytes and no more
    packed = rows.mapInArrow(trimmed(send), "block int, hashes binary").repartitionById(blocks, "block").sortWithinPartitions("block")
    out = np.zeros(words, np.uint64)
    for first, part in packed.mapInArrow(by_group(count), "first long, part binary").collect():
        part = np.frombuffer(part, np.uint64)
        out[first : first + len(part)] = part
    return out


def has_bit(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
