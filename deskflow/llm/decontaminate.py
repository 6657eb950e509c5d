"""Finds benchmark items in documents, edits included, by CGK walks and bit-sampling LSH.

A random walk through a string writes, at each step, the character it stands on, and then moves on or stays as a
random bit for that step and character says. Two strings that are a few edits apart fall into step again after each
edit, so their edit distance becomes a Hamming distance of what is written. Each table samples a few steps of one
stretch of the walk, the stretches of all tables covering it; windows that agree at all steps of one table are
candidates, so long windows may hold many edits as long as one stretch has none.

Documents give windows of W bytes at every W / 4 bytes, items give theirs at every byte, so wherever an item stands in
a document several of the document's windows lie inside it, each at some byte of the item. W is small beside the item:
short windows hold few edits, and a long item has many of them. It is bounded below by windows that meet by chance and
above by the target, a RECALL of 0.95 for items at the limit of edits: WIDTHS has for each W the least item length at
which TABLES tables of SAMPLED steps reach it, found by random edits of random items. Exact copies are always found.

A bit map of fixed size says which samples occur in the items at all; only those windows are sent to the join. Each
candidate is then aligned with the whole item, many candidates side by side (those of long items one by one, if enough
runs of four bytes are in common), and counts if the edit distance to the closest part of the document is at most a
given share of the item's length. Case and runs of blanks do not count as edits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BLANK, _LOWER, _seeded, bit_map, join_few, mix, moved, pieces, row_key, stored, text_bytes, trimmed

TABLES, SAMPLED = 12, 14
WIDTHS = {1: 0, 2: 3, 4: 6, 8: 16, 16: 40, 32: 80}  # width of windows: bytes of the shortest item that has it
RECALL = 0.95  # least share of items found at the limit of edits, at any length
STRETCH = 64  # steps of the walk that one table's samples lie in
MAP_BITS = 1 << 26
EDITS = 0.1  # of an item's length
LANES_BYTES = 1024  # longest pattern that is aligned side by side with others
LANES = 8192  # words of 64 bits that are aligned at once
RUN = 1 << 14  # windows that walk side by side
GRAM_SLOTS = 1 << 12  # of a map of the runs of four bytes of one text


def plain_bytes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A-Z in lower case, runs of blanks as one, none at the ends of a text."""
    blank = _BLANK[data]
    keep = ~blank
    opens = blank.copy()
    opens[1:] &= ~blank[:-1]
    begin = at[:-1][np.diff(at) > 0]
    opens[begin] = False  # a blank at the start of a text goes
    keep |= opens
    out = np.where(blank, np.uint8(0x20), _LOWER[data])
    where = np.concatenate([[0], np.cumsum(keep)])
    at2 = where[at]
    out = out[keep]
    ends = at2[1:][np.diff(at2) > 0] - 1  # and one at its end
    drop = ends[out[ends] == 0x20]
    if len(drop):
        gone = np.zeros(len(out) + 1, np.int64)
        gone[drop + 1] = 1
        at2 = at2 - np.cumsum(gone)[at2]
        out = np.delete(out, drop)
    return out, at2


class Walk:
    """Walks of windows of one length, and the steps that each table samples."""

    def __init__(self, width: int):
        self.width, self.steps, self.stride = width, 2 * width, max(1, width // 4)
        rng = np.random.default_rng(1000 + width)
        moves = rng.integers(0, 2, (self.steps, 256), dtype=np.int64)
        stretch = min(STRETCH, self.steps)
        begin = np.linspace(0, self.steps - stretch, TABLES).astype(int)
        sampled = begin[:, None] + np.stack([rng.choice(stretch, min(SAMPLED, stretch), replace=False) for _ in range(TABLES)])
        self.at_step: dict[int, list[int]] = {}
        for t in range(TABLES):
            for s in sampled[t].tolist():
                self.at_step.setdefault(s, []).append(t)
        self.last = int(sampled.max()) + 1
        # what each byte writes at a step, its last bit the move; 256 and more is beyond the window's end, where a walk stays
        salt = _seeded(self.steps * 257, width).reshape(self.steps, 257) & ~np.uint64(1)
        salt[:, :256] |= moves.view(np.uint64)
        self.salt = np.concatenate([salt[:, :256], np.repeat(salt[:, 256:], 256, axis=1)], axis=1)

    def samples(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """(windows, tables): a hash of what the walk through each window writes at the sampled steps."""
        out = np.empty((TABLES, len(start)), np.uint64)
        data = np.append(data, np.uint8(0))
        for i in range(0, len(start), RUN):
            self._run(data, start[i : i + RUN], out[:, i : i + RUN])
        return out.T

    def _run(self, data: np.ndarray, start: np.ndarray, out: np.ndarray) -> None:
        sums = np.zeros(out.shape, np.uint64)
        place, end = start.copy(), start + self.width
        for step in range(self.last):
            char = data[place].astype(np.int64)
            if step >= self.width:  # before, no walk is at its window's end
                char |= (place >= end).astype(np.int64) << 8
            seen = self.salt[step].take(char)
            for t in self.at_step.get(step, ()):
                sums[t] += seen
            seen &= np.uint64(1)
            place += seen.view(np.int64)
        sums += (np.arange(TABLES, dtype=np.uint64) + np.uint64(self.width << 8))[:, None]
        for t in range(TABLES):
            out[t] = mix(sums[t])


_WALKS: dict[int, Walk] = {}


def walk(width: int) -> Walk:
    if width not in _WALKS:
        _WALKS[width] = Walk(width)
    return _WALKS[width]


def window_width(n: np.ndarray) -> np.ndarray:
    """The width of WIDTHS for items of n bytes."""
    return np.array(list(WIDTHS))[np.searchsorted(list(WIDTHS.values()), n, side="right") - 1]


def item_samples(items: DataFrame) -> DataFrame:
    """item_id, size, width, offset and sample of every window of every item, and the item in plain form."""

    def rows(batches):
        for batch in batches:
            data, at = plain_bytes(*text_bytes(batch.column("text")))
            for i in np.flatnonzero(np.diff(at)).tolist():
                x = data[at[i] : at[i + 1]]
                width = int(window_width(np.array(len(x))))
                start = np.arange(len(x) - width + 1)
                sample = walk(width).samples(x, start)
                n = len(start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n * TABLES, batch.column("item_id")[i].as_py())), pa.array(np.full(n * TABLES, len(x), np.int32)),
                        pa.array(np.full(n * TABLES, width, np.int32)), pa.array(np.repeat(start, TABLES).astype(np.int32)), pa.array(sample.ravel().view(np.int64)),
                    ],
                    ["item_id", "size", "width", "offset", "sample"],
                )

    return items.mapInArrow(rows, "item_id long, size int, width int, offset int, sample long")


def document_samples(docs: DataFrame, widths: list[int], known: np.ndarray) -> DataFrame:
    """key, start and sample of the documents' windows whose samples the map knows."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def rows(batches):
        bits = np.uint64(len(sent.value) * 64)
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            key = batch.column("key").to_numpy()
            for i, j in pieces(at, 1 << 19):
                x, begin = plain_bytes(data[at[i] : at[j]], at[i : j + 1] - at[i])
                for width in widths:
                    step = walk(width).stride
                    count = np.maximum((np.diff(begin) - width) // step + 1, 0)
                    text = np.repeat(np.arange(j - i), count)
                    start = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * step
                    if not len(start):
                        continue
                    sample = walk(width).samples(x, start + begin[text])
                    hit = []
                    for of in sample.T:
                        slot = of & (bits - np.uint64(1))  # a power of two
                        hit.append((sent.value.take((slot >> np.uint64(6)).view(np.int64)) >> (slot & np.uint64(63))) & np.uint64(1) != 0)
                    t, w = np.nonzero(np.stack(hit))
                    if len(w):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key[i + text[w]]), pa.array(start[w].astype(np.int32)), pa.array(sample[w, t].view(np.int64))],
                            ["key", "start", "sample"],
                        )

    return docs.mapInArrow(trimmed(rows), "key long, start int, sample long")


def nearest(pattern: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the text, and where the first such part ends (bit-parallel)."""
    found = text.find(pattern)
    if found >= 0:
        return 0, found + len(pattern)
    m = len(pattern)
    whole, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[int, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    up, down, score = whole, 0, m
    best, end = m, 0
    for i, c in enumerate(text):
        eq = at.get(c, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & whole
        rise, fall = down | (~(diagonal | up) & whole), diagonal & up
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = rise << 1 & whole, fall << 1 & whole
        up, down = fall | (~(diagonal | rise) & whole), rise & diagonal
        if score < best:
            best, end = score, i + 1
    return best, end


def _bits(patterns: list[bytes], words: int) -> np.ndarray:
    """(words, 257 * patterns): the places of each byte in each pattern, 64 to a word; byte 256 is none."""
    out = np.zeros((words, 257 * len(patterns)), np.uint64)
    for i, pattern in enumerate(patterns):
        place = np.arange(len(pattern))
        slot = 257 * i + np.frombuffer(pattern, np.uint8).astype(np.int64)
        np.bitwise_or.at(out, (place >> 6, slot), np.uint64(1) << (place & 63).astype(np.uint64))
    return out


def nearest_many(patterns: list[bytes], texts: list[bytes]) -> np.ndarray:
    """Least edit distance of each pattern to any part of its text, as `nearest`; none of the patterns is empty.

    Patterns of up to LANES_BYTES bytes are aligned side by side, a step along all texts at a time; longer ones, for
    which one number of so many bits is quick, are aligned alone.
    """
    out = np.zeros(len(patterns), np.int64)
    size, length = (np.array([len(x) for x in xs], np.int64) for xs in (patterns, texts))
    words = (size + 63) >> 6
    left = np.array([i for i in range(len(patterns)) if patterns[i] not in texts[i]], np.int64)
    for i in left[size[left] > LANES_BYTES].tolist():
        out[i] = nearest(patterns[i], texts[i])[0]
    left = left[size[left] <= LANES_BYTES]
    left = left[np.lexsort((length[left], words[left]))]
    while len(left):
        n = int(words[left[0]])
        lanes = left[: LANES // n]
        lanes = lanes[words[lanes] == n]
        left = left[len(lanes) :]
        names: dict[bytes, int] = {}
        which = np.array([names.setdefault(patterns[i], len(names)) for i in lanes.tolist()], np.int64) * 257
        bits = _bits(list(names), n)
        steps = np.full((int(length[lanes].max()), len(lanes)), 256, np.int64)
        for k, i in enumerate(lanes.tolist()):
            steps[: length[i], k] = np.frombuffer(texts[i], np.uint8)
        steps += which
        # a step is the same as in `nearest`, on numbers of n words; beyond a text's end nothing matches any more,
        # which never lowers the least distance
        one, high = np.uint64(1), np.uint64(63)
        up, down = np.full((n, len(lanes)), ~np.uint64(0)), np.zeros((n, len(lanes)), np.uint64)
        score, top = size[lanes].copy(), ((size[lanes] - 1) & 63).astype(np.uint64)
        best = score.copy()
        for step in steps:
            eq = bits.take(step, 1)
            part = eq & up
            total = part + up
            over = total < up
            for w in range(1, n):
                total[w] += over[w - 1]
                over[w] |= over[w - 1] & (total[w] == 0)
            diagonal = (total ^ up) | eq | down
            rise, fall = down | ~(diagonal | up), diagonal & up
            score += (rise[-1] >> top & one).astype(np.int64)
            score -= (fall[-1] >> top & one).astype(np.int64)
            np.minimum(best, score, out=best)
            carry_rise, carry_fall = rise[:-1] >> high, fall[:-1] >> high
            rise, fall = rise << one, fall << one
            rise[1:] |= carry_rise
            fall[1:] |= carry_fall
            up, down = fall | ~(diagonal | rise), rise & diagonal
        out[lanes] = best
    return out


def grams(x: np.ndarray) -> np.ndarray:
    """The runs of four bytes, as numbers."""
    x = x.astype(np.uint32)
    return x[:-3] | x[1:-2] << 8 | x[2:-1] << 16 | x[3:] << 24


def can_be_near(pattern: np.ndarray, text: np.ndarray, edits: int) -> bool:
    """Whether enough runs of four bytes of the pattern are in the text; each edit breaks at most four."""
    least = len(pattern) - 3 - 4 * edits
    return least <= 0 or len(text) >= 4 and int(np.isin(grams(pattern), grams(text)).sum()) >= least


def _all_grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A slot for each run of four bytes of each string, and which string it is of."""
    of = np.repeat(np.arange(len(at) - 1), np.maximum(np.diff(at) - 3, 0))
    if not len(of):
        return np.empty(0, np.int64), of
    first = np.concatenate([[0], np.cumsum(np.maximum(np.diff(at) - 3, 0))])[:-1]
    place = np.arange(len(of)) - first[of] + at[of]
    runs = grams(data)[place]
    return ((runs * np.uint32(2654435761)) >> np.uint32(32 - 12)).astype(np.int64), of


def may_be_near(patterns: np.ndarray, pattern_at: np.ndarray, texts: np.ndarray, text_at: np.ndarray, edits: np.ndarray) -> np.ndarray:
    """For many patterns and texts what `can_be_near` says of each, or True: runs of four bytes stand for their slots."""
    out = np.zeros(len(edits), bool)
    least = np.diff(pattern_at) - 3 - 4 * edits
    for i in range(0, len(edits), 256):
        j = min(i + 256, len(edits))
        seen = np.zeros((j - i) * GRAM_SLOTS, bool)
        slot, of = _all_grams(texts[text_at[i] : text_at[j]], text_at[i : j + 1] - text_at[i])
        seen[of * GRAM_SLOTS + slot] = True
        slot, of = _all_grams(patterns[pattern_at[i] : pattern_at[j]], pattern_at[i : j + 1] - pattern_at[i])
        met = np.bincount(of, weights=seen[of * GRAM_SLOTS + slot], minlength=j - i)
        out[i:j] = met >= least[i:j]
    return out


def find_items(docs: DataFrame, items: DataFrame, edits: float = EDITS) -> DataFrame:
    """(key, doc_id, item_id, distance, size) for each item of `items` (item_id, text) that stands in a row of `docs` (doc_id, text).

    An item stands in a text when the edit distance of the whole item to some part of the text is at most `edits` of
    the item's length, both in plain form: A-Z in lower case, runs of blanks as one. Distance 0 is always found;
    others are found by sampling, with a chance of RECALL at least if `edits` is EDITS or less. Null, empty and blank texts hold nothing and null or blank items stand nowhere.
    Equal rows give one answer for each item that stands in them (key: see row_key), and rows that repeat an
    item_id are one item with several texts. No rows give no rows; other columns are ignored.
    """
    docs = docs.where("text is not null").select("doc_id", "text", row_key().alias("key"))
    items = items.where("text is not null and item_id is not null").select("item_id", "text").distinct()
    samples = stored(item_samples(items), "item-samples")
    slot = F.pmod(F.col("sample"), F.lit(MAP_BITS))
    known = bit_map(samples.select(slot.alias("s")), "s", MAP_BITS)
    widths = sorted(r[0] for r in samples.select("width").distinct().collect())
    met = document_samples(docs.select("key", "text"), widths, known.view(np.uint64)).join(moved(samples), "sample")
    # one candidate for each half of the item's length
    at = F.floor((F.col("start") - F.col("offset")) / F.greatest(F.lit(1), F.floor(F.col("size") / 2)))
    spots = met.groupBy("key", "item_id", "size", at.alias("at")).agg(F.min(F.col("start") - F.col("offset")).alias("start"))
    spots = stored(spots.groupBy("key").agg(F.collect_list(F.struct("item_id", "size", "start")).alias("spots")), "spots")

    def parts(batches):
        for batch in batches:
            texts, ends = text_bytes(batch.column("text"))
            listed = batch.column("spots")
            runs = ((b, plain_bytes(texts[ends[b] : ends[e]], ends[b : e + 1] - ends[b])) for b, e in pieces(ends, 1 << 19))
            for i, x in ((b + i, data[at[i] : at[i + 1]]) for b, (data, at) in runs for i in range(len(at) - 1)):
                spots = listed[i].as_py()
                item, part = [], []
                for s in spots:
                    slack = s["size"] // 2 + 2 * int(edits * s["size"]) + 1  # other spots of the same half begin later
                    item.append(s["item_id"])
                    part.append(x[max(0, s["start"] - slack) : s["start"] + s["size"] + slack].tobytes())
                n = len(item)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("key")[i].as_py()] * n, pa.int64()), pa.array([batch.column("doc_id")[i].as_py()] * n, pa.int64()), pa.array(item, pa.int64()), pa.array(part, pa.binary())], ["key", "doc_id", "item_id", "part"]
                )

    found = join_few(docs, spots, "key").where("spots is not null").select("key", "doc_id", "text", "spots").mapInArrow(trimmed(parts), "key long, doc_id long, item_id long, part binary")

    def align(batches):
        for batch in batches:
            data, at = plain_bytes(*text_bytes(batch.column("text")))
            size = np.diff(at)
            distance = size.copy()
            limit = (size * edits).astype(np.int64)
            near = np.zeros(len(size), bool)
            for i in range(0, len(size), 1024):
                j = min(i + 1024, len(size))
                some = text_bytes(batch.column("part")[i:j].cast(pa.large_binary()).view(pa.large_string()))
                near[i:j] = may_be_near(data[at[i] : at[j]], at[i : j + 1] - at[i], *some, limit[i:j])
            ask = np.flatnonzero(near & (size > 0)).tolist()
            patterns, texts = {i: data[at[i] : at[i + 1]] for i in ask}, {i: batch.column("part")[i].as_py() for i in ask}
            # counting all runs of four bytes exactly is worth its time before a long item only
            ask = [i for i in ask if size[i] <= LANES_BYTES or can_be_near(patterns[i], np.frombuffer(texts[i], np.uint8), int(limit[i]))]
            distance[ask] = nearest_many([patterns[i].tobytes() for i in ask], [texts[i] for i in ask])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), batch.column("item_id"), pa.array(distance, pa.int64()), pa.array(size, pa.int64())], ["key", "doc_id", "item_id", "distance", "size"]
            )

    checked = found.join(moved(items), "item_id").select("key", "doc_id", "item_id", "part", "text").mapInArrow(trimmed(align), "key long, doc_id long, item_id long, distance long, size long")
    near = checked.where((F.col("size") > 0) & (F.col("distance") <= F.floor(F.col("size") * edits)))
    return near.groupBy("key", "doc_id", "item_id").agg(F.min(F.struct("distance", "size")).alias("best")).select("key", "doc_id", "item_id", "best.distance", "best.size")
