"""N-gram Jaccard join with signature trees.

Documents with one set of shingles form a class; one of them stands for it. Classes that can be similar share
a shingle among the first few of their sets, in any order that is common to all (here: those that many texts share
last). Each such shingle is the root of a signature tree over its classes. A node holds the OR of its token
bitmaps, its range of set sizes, the most tokens that collide in one of its bitmaps, and its component, if it
has but one. Two nodes are traversed together, and a pair is given up when its greatest possible overlap is
too small for the sizes, or when all its members are linked already. A pair that is left comes out of every tree
that holds both; as these are all the shingles that the first few of both sets share, their number bounds the
whole overlap. What can still be similar then is checked on the sets.

Trees of one and the same classes are walked once and counted as often as there are of them.

So that a group of near copies is not written out as all its pairs, each class is first compared with one
class of each of its trees, the one whose shingles most other classes have too, as the text that others were copied
from has. Copies of a text that is like none of them are linked in a web without a center: next, each class is
compared with the first few that its two largest trees allow, in one block of each. The number of such pairs grows
with the classes, and they join most of a web. What that links needs no further comparison, and the trees look for links between
components only. The links found give the same components as all links. Trees that have one such class in common go
to one task, which adds up what they say of a pair before it sends the pair on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import frequent_bits, has_bit
from .common import components, gram_hashes, join_few, lists, mix, moved, pieces, row_key, shuffle_partitions, stored, text_bytes, trimmed, word_hashes

SIGNATURE_WORDS = 32  # longs of 64 bits in a bitmap
LEAF, FANOUT = 16, 8
BLOCK = 512  # classes of one tree in a task; a larger tree is cut into blocks of so many, and tasks take two blocks
SHARED = 8  # texts that a shingle leads in before it is ordered last
WEB_TREES, WEB_PAIRS = 2, 4  # trees of a class in the round of few pairs, and pairs that it leads in each
ALL_TREES = 1 << 40  # said of a pair whose trees were not counted
HELD_PAIRS = 1 << 20  # that a task adds up
BITMAP_PAIRS = 1 << 14  # whose bitmaps are laid side by side at once
MAP_BITS = 1 << 26
RUN_BYTES = 1 << 22  # of text whose shingles are packed together


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int):
    """Shingle and text number, once each; a text with fewer words than `size` has its whole sequence as one."""
    words, first = word_hashes(data, at, lower=True)
    h, text = gram_hashes(words, first, size)
    counts = np.diff(first)
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            places = (first[short][:, None] + np.arange(n)).ravel()
            g, _ = gram_hashes(words[places], np.arange(len(short) + 1) * n, n)
            h, text = np.concatenate([h, g]), np.concatenate([text, short])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[keep], text[keep]


def prefixes(h: np.ndarray, text: np.ndarray, n: np.ndarray, late: np.ndarray, num: int, den: int):
    """The leading shingles of each set, shared ones last, and how many each set has: a similar set has one of them."""
    order = np.lexsort((h, has_bit(late, h), text))
    need = n - (num * n + den - 1) // den + (n > 0)
    nth = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    return h[order][nth < np.repeat(need, n)], need


def shared_shingles(docs: DataFrame, size: int, num: int, den: int, blocks: int) -> np.ndarray:
    """A bit map of the shingles that lead in many texts while they are ordered by their hash alone.

    Ordered last, shingles of common passages lead in few sets, so trees hold few classes that are not similar. The
    order never changes what is found.
    """

    def leading(batch):
        data, at = text_bytes(batch.column("text"))
        for i, j in pieces(at, RUN_BYTES):
            found = []
            for a, b in pieces(at[i : j + 1] - at[i]):
                h, text = shingle_sets(data[at[i + a] : at[i + b]], at[i + a : i + b + 1] - at[i + a], size)
                found.append(prefixes(h, text, np.bincount(text, minlength=b - a), np.zeros(1, np.uint64), num, den)[0])
            yield np.concatenate(found)

    return frequent_bits(docs.select("text"), leading, SHARED, MAP_BITS, blocks)


def class_rows(docs: DataFrame, size: int, num: int, den: int, late: np.ndarray) -> DataFrame:
    """key, doc_id, n (set size), cls (hash of the set), prefix (the shingles that a similar set must share one of), signature."""
    sent = docs.sparkSession.sparkContext.broadcast(late)

    def rows(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            for i, j in pieces(at):
                h, text = shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i], size)
                n = np.bincount(text, minlength=j - i)
                head, need = prefixes(h, text, n, sent.value, num, den)
                bits = np.zeros((j - i, SIGNATURE_WORDS), np.uint64)
                np.bitwise_or.at(bits, (text, (h >> np.uint64(6)).astype(np.int64) % SIGNATURE_WORDS), np.uint64(1) << (h & np.uint64(63)))
                sums = np.zeros(j - i, np.uint64)
                np.add.at(sums, text, mix(h + np.uint64(1)))
                cls = mix(sums ^ (n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key")[i:j],
                        batch.column("doc_id")[i:j],
                        pa.array(n.astype(np.int64)),
                        pa.array(cls.view(np.int64)),
                        lists(head.view(np.int64), need, pa.int64()),
                        lists(bits.ravel().view(np.int64), np.full(j - i, SIGNATURE_WORDS), pa.int64()),
                    ],
                    ["key", "doc_id", "n", "cls", "prefix", "signature"],
                )

    return docs.mapInArrow(trimmed(rows), "key long, doc_id long, n long, cls long, prefix array<long>, signature array<long>")


def shared_tokens(classes: DataFrame, blocks: int) -> DataFrame:
    """(cls, token) of the prefixes, without most tokens that only one class has."""

    def lists_of(batch):
        yield batch.column("prefix").flatten().to_numpy().view(np.uint64)

    known = frequent_bits(classes.select("prefix"), lists_of, 2, MAP_BITS, blocks)
    sent = classes.sparkSession.sparkContext.broadcast(known)

    def rows(batches):
        for batch in batches:
            prefix = batch.column("prefix")
            h = prefix.flatten().to_numpy()
            owner = np.repeat(batch.column("cls").to_numpy(), np.diff(prefix.offsets.to_numpy()))
            keep = has_bit(sent.value, h.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(owner[keep]), pa.array(h[keep])], ["cls", "token"])

    return classes.select("cls", "prefix").mapInArrow(trimmed(rows), "cls long, token long")


def token_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, tokens) of the classes in `wanted` (key, cls)."""

    def rows(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            cls = batch.column("cls").to_numpy(zero_copy_only=False)
            for i, j in pieces(at):
                h, text = shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i], size)
                n = np.bincount(text, minlength=j - i)
                sums = np.zeros(j - i, np.uint64)
                np.add.at(sums, text, mix(h + np.uint64(1)))
                same = mix(sums ^ (n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64) == cls[i:j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls[i:j][same]), lists(h[same[text]].view(np.int64), n[same], pa.int64())], ["cls", "tokens"]
                )

    # the join leaves rows of one key together, so equal rows go without a shuffle
    found = join_few(docs.select("key", "text"), wanted, "key").where("cls is not null").dropDuplicates(["key"])
    return found.select("text", "cls").mapInArrow(trimmed(rows), "cls long, tokens array<long>")


def enough(shared: str, na: str, nb: str, num: int, den: int) -> str:
    return f"{den} * ({shared}) >= {num} * ({na} + {nb} - ({shared}))"


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b, trees) of classes that are similar: by the number of trees that hold both, then by their sets.

    Both sets being in one order, all that they share up to the end of one of the prefixes is in both prefixes; the
    rest of that set is all they can share beyond.
    """
    rest = f"ceil({num} * n / {den}) - 1"
    side = classes.select("cls", "n", F.expr(rest).alias("rest"))
    near = (
        pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
        .where(f"{den} * least(na, nb) >= {num} * greatest(na, nb)")
        .where(enough("least(trees + greatest(ra, rb), na, nb)", "na", "nb", num, den))
        .select("a", "b")
    )
    near = stored(near, "pairs")
    ids = near.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = stored(classes.select("cls", "key").join(ids, "cls").select("key", "cls"), "wanted")
    sets = stored(token_sets(docs, wanted, size), "sets")
    both = near.join(sets.toDF("a", "ta"), "a").join(sets.toDF("b", "tb"), "b")
    both = both.select("a", "b", F.size("ta").alias("na"), F.size("tb").alias("nb"), F.size(F.array_intersect("ta", "tb")).alias("shared"))
    return both.where(enough("shared", "na", "nb", num, den)).select("a", "b")


def common_bits(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many bits the bitmaps of each pair have in common; a block's pairs are many, and each would be two bitmaps long."""
    out = np.empty(len(i), np.int64)
    for k in range(0, len(i), BITMAP_PAIRS):
        some = slice(k, k + BITMAP_PAIRS)
        out[some] = np.bitwise_count(bits[i[some]] & bits[j[some]]).sum(1)
    return out


class Tree:
    """Levels of nodes over the classes of one group, leaves first; the classes are sorted by size and bitmap."""

    def __init__(self, n, signature, component):
        excess = n - np.bitwise_count(signature).sum(1).astype(np.int64)
        level = (n, n, signature, excess, component)
        self.levels, width = [level], LEAF
        while len(level[0]) > 1:
            cut = np.arange(0, len(level[0]), width)
            low, high, bits, extra, comp = level
            one = np.minimum.reduceat(comp, cut) == np.maximum.reduceat(comp, cut)
            one &= np.minimum.reduceat(comp, cut) >= 0
            level = (
                np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.bitwise_or.reduceat(bits, cut, axis=0),
                np.maximum.reduceat(extra, cut), np.where(one, comp[cut], -1),
            )
            self.levels.append(level)
            width = FANOUT

    def pairs(self, num: int, den: int):
        """Pairs i < j of classes whose nodes all allow enough overlap."""
        i = j = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            low, high, bits, extra, comp = self.levels[depth]
            ok = (comp[i] < 0) | (comp[i] != comp[j])
            ok &= (den * high[i] >= num * low[j]) & (den * high[j] >= num * low[i])
            i, j = i[ok], j[ok]
            most = common_bits(bits, i, j) + np.minimum(extra[i], extra[j])
            ok = (num + den) * most >= num * (low[i] + low[j])
            i, j = i[ok], j[ok]
            if not depth:
                return i, j
            width = LEAF if depth == 1 else FANOUT
            step = np.arange(width)
            a = (i[:, None, None] * width + step[None, :, None] + 0 * step[None, None, :]).ravel()
            b = (j[:, None, None] * width + 0 * step[None, :, None] + step[None, None, :]).ravel()
            last = len(self.levels[depth - 1][0])
            ok = (a < last) & (b < last) & ((a < b) if depth == 1 else (a <= b))
            i, j = a[ok], b[ok]
        return i, j


def tree_pairs(rows: DataFrame, num: int, den: int, partitions: int, most: int | None = None) -> DataFrame:
    """Pairs (a, b) and the number of trees that they come from; each class leads `most` of them in a group at most, if given.

    Rows have token, weight (how many trees it stands for), center, part, cls, n, component, signature, and say where
    they stand: band, upper, mine, low, high. Of the groups of one tree that hold a pair, the one of its larger band
    and its two blocks gives it.
    """

    def added_up(pairs):
        a, b, trees = (np.concatenate([x[k] for x in pairs]) for k in range(3))
        order = np.lexsort((b, a))
        a, b, trees = a[order], b[order], trees[order]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.empty(0, np.int64)
        return a[new], b[new], np.add.reduceat(trees, new) if len(new) else trees

    def sent(pairs):
        for i in range(0, len(pairs[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in pairs], ["a", "b", "trees"])

    def small(begin, count, n, signature, component):
        """All pairs inside groups of one leaf, over many groups at once."""
        held = np.bitwise_count(signature).sum(1).astype(np.int64)
        for size in range(2, LEAF + 1):
            mine = begin[count == size]
            if not len(mine):
                continue
            p, q = np.triu_indices(size, 1)
            a, b = (mine[:, None] + p).ravel(), (mine[:, None] + q).ravel()
            ok = (component[a] != component[b]) & (den * n[a] >= num * n[b]) & (den * n[b] >= num * n[a])
            a, b = a[ok], b[ok]
            most = n[a] - held[a] + common_bits(signature, a, b)
            ok = (num + den) * most >= num * (n[a] + n[b])
            yield a[ok], b[ok]

    def work(table):
        n = table.column("n").to_numpy()
        order = np.lexsort((n, table.column("part").to_numpy(), table.column("token").to_numpy()))
        token, part, cls, n, component = (table.column(c).to_numpy()[order] for c in ("token", "part", "cls", "n", "component"))
        band, upper, mine, low, high, weight = (table.column(c).to_numpy()[order] for c in ("band", "upper", "mine", "low", "high", "weight"))
        signature = table.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, SIGNATURE_WORDS).view(np.uint64)[order]
        component = np.unique(component, return_inverse=True)[1].astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (part[1:] != part[:-1])]))
        count = np.diff(begin, append=len(token))
        found = list(small(begin, count, n, signature, component))
        for b, c in zip(begin[count > LEAF].tolist(), count[count > LEAF].tolist()):
            one = slice(b, b + c)
            i, j = Tree(n[one], signature[one], component[one]).pairs(num, den)
            found.append((i + b, j + b))
        if found:
            a, b = (np.concatenate([x[k] for x in found]) for k in (0, 1))
            ok = np.maximum(band[a], band[b]) == upper[a]
            ok &= (np.minimum(mine[a], mine[b]) == low[a]) & (np.maximum(mine[a], mine[b]) == high[a])
            a, b = a[ok], b[ok]
            if most is not None:
                order = np.lexsort((b, a))
                a, b = a[order], b[order]
                nth = np.arange(len(a)) - np.searchsorted(a, a)
                a, b = a[nth < most], b[nth < most]
            trees, a, b = weight[a], cls[a], cls[b]
            yield np.minimum(a, b), np.maximum(a, b), trees

    def whole_trees(batches):
        """The rows come sorted by group; whole groups at a time."""
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            token, part = table.column("token").to_numpy(), table.column("part").to_numpy()
            last = np.flatnonzero((token != token[-1]) | (part != part[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield held

    def traverse(batches):
        held, n = [], 0
        for table in whole_trees(batches):
            for pairs in work(table):
                held.append(pairs)
                n += len(pairs[0])
                if n > HELD_PAIRS:
                    held = [added_up(held)]
                    n = len(held[0][0])
                    if n > HELD_PAIRS // 2:
                        yield from sent(held[0])
                        held, n = [], 0
        if held:
            yield from sent(added_up(held))

    return (
        rows.repartition(partitions, "center", "part").sortWithinPartitions("center", "part", "token")
        .mapInArrow(trimmed(traverse), "a long, b long, trees long").groupBy("a", "b").agg(F.sum("trees").alias("trees"))
    )


def tree_members(tokens: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(cls, token, weight, score) of the trees that hold two classes or more, one tree for all that hold the same ones.

    weight is how many trees it stands for; score is a class's members of trees for each of its leading shingles.
    """
    one, two = F.bit_xor(F.xxhash64("cls")), F.bit_xor(F.xxhash64("cls", F.lit(1)))
    trees = tokens.groupBy("token").agg(F.count("*").alias("members"), one.alias("x1"), two.alias("x2")).where("members > 1")
    trees = trees.groupBy("members", "x1", "x2").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    trees = stored(trees.select("token", "members", "weight"), "trees")
    members = stored(join_few(tokens, trees, "token").where("members is not null"), "placed")
    score = members.groupBy("cls").agg(F.sum(F.col("members") * F.col("weight")).alias("met"))
    score = score.join(classes.select("cls", "n"), "cls").select("cls", (F.col("met") / F.expr(f"n - ceil({num} * n / {den}) + 1")).alias("score"))
    return members.join(moved(score), "cls").select("cls", "token", "weight", "score")


def star_pairs(rows: DataFrame) -> DataFrame:
    """(a, b, trees): every class of `rows` with the highest score of each of its trees, unless they are in one component."""
    best = F.max_by(F.struct("cls", "component"), F.struct("score", "cls"))
    centers = rows.groupBy("token").agg(best.alias("c"), F.min("component").alias("low"), F.max("component").alias("high"))
    centers = centers.where("low <> high").select("token", F.col("c.cls").alias("center"), F.col("c.component").alias("its"))
    met = rows.join(moved(centers), "token").where("component <> its")
    pairs = met.select(F.least("cls", "center").alias("a"), F.greatest("cls", "center").alias("b"), "weight")
    return pairs.groupBy("a", "b").agg(F.sum("weight").alias("trees"))


def with_component(members: DataFrame, known: DataFrame) -> DataFrame:
    return members.join(moved(known), "cls", "left").withColumn("component", F.coalesce("component", "cls"))


def open_trees(rows: DataFrame) -> DataFrame:
    """token, members and center (the class with the highest score) of the trees that hold two components or more."""
    best = F.max_by("cls", F.struct("score", "cls"))
    trees = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"), best.alias("center"))
    return trees.where("low <> high").select("token", "members", "center")


def banded(rows: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The places with n, signature, band and upper: a similar set is in the same band of sizes or in the next."""
    rows = rows.join(classes.select("cls", "n", "signature"), "cls")
    rows = rows.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num))).cast("int"))
    return rows.withColumn("upper", F.explode(F.array("band", F.col("band") + 1)))


def web_pairs(rows: DataFrame, classes: DataFrame, num: int, den: int, partitions: int) -> DataFrame:
    """(a, b, trees): few pairs of each class of `rows`, from one block of each of its largest trees and between components."""
    trees = stored(open_trees(rows), "open")
    rows = join_few(rows.drop("score"), trees, "token").where("members is not null")
    largest = F.expr(f"slice(sort_array(collect_list(struct(members, token, component)), false), 1, {WEB_TREES})")
    rows = rows.groupBy("cls").agg(F.explode(largest).alias("t")).select("cls", "t.*")
    mine = F.pmod(F.xxhash64("cls", "token"), F.ceil(F.col("members") / BLOCK)).cast("int")
    rows = banded(rows.withColumns({"mine": mine, "weight": F.lit(1).cast("long"), "center": F.col("token")}).drop("members"), classes, num, den)
    rows = rows.withColumns({"low": F.col("mine"), "high": F.col("mine"), "part": F.xxhash64("upper", "mine")})
    return tree_pairs(rows, num, den, partitions, WEB_PAIRS).withColumn("trees", F.lit(ALL_TREES))


def shingle_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """key (see row_key), doc_id, n_shingles, component_id and component of each row of `docs` (doc_id, text).

    component tells components apart where ids are null or repeated; it is null for an empty set. Two rows are linked when den * |A and B| >= num * |A or B| for their sets of `size`-word shingles, words being
    runs of other bytes than blanks, A-Z in lower case; component_id is the smallest doc_id that links lead to.
    Null texts and texts without words have empty sets and are linked with nothing; equal non-empty sets are
    always linked. Rows that repeat a doc_id are rows of their own; a null doc_id is left out when the smallest
    is sought, and is the result where there is no other. No rows give no rows; other columns are ignored.
    """
    docs = docs.select(row_key().alias("key"), "doc_id", "text")
    partitions = shuffle_partitions(docs.sparkSession)
    late = shared_shingles(docs, size, num, den, partitions)
    base = stored(class_rows(docs, size, num, den, late), "classes")
    classes = stored(
        base.where("n > 0").groupBy("cls", "n").agg(
            F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.any_value("prefix").alias("prefix"), F.any_value("signature").alias("signature")
        ),
        "representatives",
    )
    tokens = stored(shared_tokens(classes, partitions), "tokens")
    members = stored(tree_members(tokens, classes, num, den), "members")
    edges, labelled = None, members.withColumn("component", F.col("cls"))
    for few in (star_pairs, lambda rows: web_pairs(rows, classes, num, den, partitions)):
        found = stored(verified(few(labelled), classes, docs, size, num, den), "links")
        edges = found if edges is None else edges.unionByName(found)
        known = stored(components(edges).toDF("cls", "component"), "known")
        labelled = stored(with_component(members, known), "labelled")
    left = stored(open_trees(labelled), "open")
    rows = banded(join_few(labelled.drop("score"), left, "token").where("members is not null"), classes, num, den)
    rows = rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    rows = rows.drop("other", "members", "blocks").withColumn("part", F.xxhash64("upper", "low", "high"))
    more = verified(tree_pairs(rows, num, den, partitions), classes, docs, size, num, den)
    final = components(edges.unionByName(more))

    joined = classes.select("cls", "doc_id").join(moved(final.toDF("cls", "component")), "cls", "left")
    joined = joined.withColumn("component", F.coalesce("component", "cls"))
    lowest = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = joined.join(moved(lowest), "component").select("cls", "component", "component_id")
    return base.join(moved(named), "cls", "left").select(
        "key", "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"), "component",
    )
