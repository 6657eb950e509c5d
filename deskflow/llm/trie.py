"""The prefix trie of conversations, with totals of whole subtrees by centroid decomposition.

A node is a distinct sequence of leading turns, told by its length and a 128-bit hash that is built up along each
conversation; its name is (depth, smallest member). Because a member's own turns name all nodes above it, one table of
(member, depth, node, node above) answers every question about paths and ancestors with one equality join, and no
pointers are followed.

Totals of subtrees do not walk the trie level by level, which would take as many rounds as the longest conversation
has turns. The parent-edge forest is decomposed instead: each component gives up its centroid, the deepest node with
at least half of it below, which is found for all components together by a search over depths; what lies below the
centroid within the component is summed, and the sum is added to every node on the path from the centroid to the
component's top. What is left falls into components of at most half the size, so the number of rounds grows with the
logarithm of the trie. Any node and any node below it are parted at one centroid only, which lies between them, so
every total counts everything once. Components of at most `SMALL` nodes finish inside one task, in the same way.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import number_rows
from ..session import work_dir
from .common import moved, stored

SMALL = 1024  # nodes of a component that one task decomposes
CUT = 1024  # turns of a conversation that one window row-by-row passes over

WORD = r"[^\x20\x09-\x0D]+"


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), last (turns of it), role, digest (of the text) and words of each row.

    Ordered by turn, null first; rows of one turn by role and digest. Conversations are cut by ranges, so a long one
    is spread over tasks.
    """
    text = F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    numbered = number_rows(rows, ["conv_id", "turn", "role", "digest"], "seq", work_dir(conversations.sparkSession, "turns"))
    numbered = stored(numbered.drop("turn"), "numbered")
    sizes = numbered.groupBy("conv_id").agg(F.min("seq").alias("first"), F.count("*").alias("last"))
    met = numbered.join(moved(sizes), "conv_id")
    return met.select("conv_id", (F.col("seq") - F.col("first") + 1).alias("position"), "last", "role", "digest", "words")


def with_shared_heads(turns: DataFrame, group: int = 20, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """Every conversation c rebuilt: members (c, size) and their turns (c, d from 1, role, digest, words).

    The first h turns are those of conversation c - c % group (all if it has fewer, none if it is absent), h being
    crc32(c) % longest; c's own turns after its first h follow. `turns` is stored and comes from placed_turns.
    """
    convs = turns.where("position = 1").select(F.col("conv_id").alias("c"), F.col("last").alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % longest)
    convs = convs.withColumn("base", F.col("c") - F.col("c") % group)
    others = convs.select(F.col("c").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(moved(others), "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(convs.select("c", "base", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "rebuilt")
    part = ["role", "digest", "words"]
    own = turns.join(moved(convs.select(F.col("c").alias("conv_id"), "h", "m")), "conv_id").where("position > h")
    own = own.select(F.col("conv_id").alias("c"), (F.col("position") - F.col("h") + F.col("m")).alias("d"), *part)
    heads = turns.where(F.col("position") < longest).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.where("h > 0").select("base", "c", "h"), "base").where("position <= h").select("c", F.col("position").alias("d"), *part)
    return convs.select("c", "size"), own.unionByName(heads)


def with_prefixes(turns: DataFrame) -> DataFrame:
    """Adds p1, p2, which tell the turns so far, and q1, q2, the same without the last; long conversations are cut."""
    turns = turns.withColumns({
        "t1": F.xxhash64("d", "role", "digest"), "t2": F.xxhash64("digest", "role", F.lit(1), "d"), "cut": F.floor(F.col("d") / CUT),
    })
    cuts = turns.groupBy("c", "cut").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    before = Window.partitionBy("c").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    cuts = cuts.select("c", "cut", F.bit_xor("x1").over(before).alias("x1"), F.bit_xor("x2").over(before).alias("x2"))
    inner = Window.partitionBy("c", "cut").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = turns.withColumns({"y1": F.bit_xor("t1").over(inner), "y2": F.bit_xor("t2").over(inner)}).join(cuts, ["c", "cut"])
    for k in "12":
        so_far = F.col(f"y{k}").bitwiseXOR(F.coalesce(f"x{k}", F.lit(0)))
        out = out.withColumn(f"p{k}", so_far).withColumn(f"q{k}", F.col(f"p{k}").bitwiseXOR(F.col(f"t{k}")))
    return out.select("c", "d", "words", "p1", "p2", "q1", "q2")


def trie_nodes(members: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (d, label, parent, n_convs, words) and paths (c, d, label, above), both stored.

    label is a node's smallest member, parent that of the node above; a path row says in which node a member is at a depth.
    """
    turns = stored(with_prefixes(turns), "prefixes")
    key = ["d", "p1", "p2"]
    nodes = turns.groupBy(*key).agg(
        F.min("c").alias("label"), F.count("*").alias("n_convs"), F.first("words").alias("words"), F.min("q1").alias("q1"), F.min("q2").alias("q2")
    )
    root = members.agg(F.min("c").alias("label"), F.count("*").alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(zero.alias("d"), zero.alias("p1"), zero.alias("p2"), "label", "n_convs", zero.alias("words"), zero.alias("q1"), zero.alias("q2"))
    nodes = stored(nodes.withColumn("d", F.col("d").cast("long")).unionByName(root), "bare-nodes")
    above = nodes.select((F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("label").alias("parent"))
    nodes = stored(nodes.where("d > 0").join(moved(above), ["d", "q1", "q2"]).unionByName(nodes.where("d = 0"), allowMissingColumns=True), "nodes")
    named = nodes.where("d > 0").select(*key, "label", F.col("parent").alias("above"))
    paths = stored(turns.select("c", *key).join(moved(named), key).select("c", "d", "label", "above"), "paths")
    return nodes.select("d", "label", "parent", "n_convs", "words"), paths


# ---- totals of subtrees ----


def decomposed(parent: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Totals of the subtrees of one component, by centroids; parents stand before their children, the top's is -1."""
    n = len(parent)
    home, size = [0] * n, [0] * n
    totals = [[0] * len(values[0]) for _ in range(n)]
    todo, made = [(0, list(range(n)))], 0
    while todo:
        comp, nodes = todo.pop()
        for v in nodes:
            size[v] = 1
        for v in reversed(nodes):
            if parent[v] >= 0 and home[parent[v]] == comp:
                size[parent[v]] += size[v]
        center = max(v for v in nodes if 2 * size[v] >= len(nodes))  # they form a path, so the last is the deepest
        upper, below, parts = [], {}, {}
        for v in nodes:
            p = parent[v]
            if v == center:
                continue
            if p == center:
                made += 1
                below[v], parts[made] = made, [v]
            elif p in below:
                below[v] = below[p]
                parts[below[v]].append(v)
            else:
                upper.append(v)
        here = [sum(x) for x in zip(values[center], *(values[v] for v in below))]
        u = center
        while u >= 0 and home[u] == comp:
            totals[u] = [a + b for a, b in zip(totals[u], here)]
            u = parent[u]
        home[center] = -1
        for v, part in below.items():
            home[v] = part
        todo.extend(parts.items())
        if upper:
            todo.append((comp, upper))
    return totals


def small_totals(rows: DataFrame, names: list[str]) -> DataFrame:
    """(d, label, totals) within each component of `rows`, a component at a time."""

    def groups(batches):
        held = None
        for batch in batches:
            table = pa.table(batch) if held is None else pa.concat_tables([held, pa.table(batch)])
            top = np.stack([table.column(c).to_numpy() for c in ("top_d", "top")])
            last = np.flatnonzero((top != top[:, -1:]).any(0))
            cut = int(last[-1]) + 1 if len(last) else 0
            ends = np.flatnonzero((top[:, 1 : cut + 1] != top[:, :cut]).any(0)) + 1
            for b, e in zip([0, *ends[:-1]], ends):
                yield table.slice(b, e - b)
            held = table.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield held

    def work(batches):
        out = []
        for group in groups(batches):
            d, label, up, *values = (group.column(c).to_pylist() for c in ("d", "label", "parent", *names))
            place = {k: i for i, k in enumerate(zip(d, label))}
            parent = [place.get((x - 1, y), -1) for x, y in zip(d, up)]
            out.extend((x, y, *t) for x, y, t in zip(d, label, decomposed(parent, list(zip(*values)))))
            if len(out) >= 1 << 14:
                yield as_rows(out)
                out = []
        yield as_rows(out)

    def as_rows(out):
        columns = list(zip(*out)) if out else [()] * (2 + len(names))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["d", "label", *names])

    kind = ", ".join(f"{c} long" for c in ("d", "label", *names))
    columns = rows.select("top_d", "top", "d", "label", "parent", *names)
    return columns.repartition("top_d", "top").sortWithinPartitions("top_d", "top", "d", "label").mapInArrow(work, kind)


def centroids(rows: DataFrame, big: DataFrame, paths: DataFrame) -> DataFrame:
    """big (top_d, top, n, deepest) with the centroid (z_d, z) of each component; each round asks about three depths."""
    state = stored(big.select("top_d", "top", "n", F.col("top_d").alias("z_d"), F.col("top").alias("z"), F.col("deepest").alias("high")), "centroids")
    asked = paths.select(F.col("c").alias("label"), F.col("d").alias("probe"), F.col("label").alias("found"))
    while state.where("z_d < high").limit(1).count():
        span = F.col("high") - F.col("z_d")
        probes = F.when(span > 0, F.array_distinct(F.array(F.col("z_d") + 1, *[F.col("z_d") + F.ceil(span / F.lit(k)) for k in (4, 2)])))
        going = state.withColumn("probes", F.coalesce(probes, F.array().cast("array<long>")))
        ask = going.select("top_d", "top", "n", F.explode("probes").alias("probe"))
        met = rows.select("top_d", "top", "d", "label").join(moved(ask), ["top_d", "top"]).where("d >= probe")
        counts = met.join(moved(asked), ["label", "probe"]).groupBy("top_d", "top", "n", "probe", "found").agg(F.count("*").alias("below"))
        heavy = counts.where("2 * below >= n").groupBy("top_d", "top").agg(F.max(F.struct("probe", "found")).alias("best"))
        low = F.coalesce("best.probe", "z_d")
        failed = F.array_min(F.filter("probes", lambda x: x > low))
        state = stored(
            going.join(moved(heavy), ["top_d", "top"], "left").select(
                "top_d", "top", "n", low.alias("z_d"), F.coalesce("best.found", "z").alias("z"), F.coalesce(failed - 1, "high").alias("high")
            ),
            "centroids",
        )
    return state


def subtree_totals(nodes: DataFrame, paths: DataFrame, names: list[str], small: int = SMALL) -> DataFrame:
    """(d, label) with the sums of `names` over each node's subtree, the node included; see the module's text."""
    root = nodes.where("d = 0").select(F.col("d").alias("top_d"), F.col("label").alias("top"))
    here = nodes.select("d", "label", "parent", *names)
    rows = stored(here.crossJoin(F.broadcast(root)), "components")  # the root is one row
    added, done = [], []
    sums = [F.sum(c).alias(c) for c in names]
    while True:
        sizes = rows.groupBy("top_d", "top").agg(F.count("*").alias("n"), F.max("d").alias("deepest"))
        big = stored(sizes.where(F.col("n") > small), "big")
        if not big.limit(1).count():
            done.append(rows)
            break
        marked = stored(rows.join(moved(big.select("top_d", "top", "n")), ["top_d", "top"], "left"), "marked")
        done.append(marked.where("n is null").drop("n"))
        rows = marked.where("n is not null").drop("n")
        center = centroids(rows, big, paths)
        under = F.col("above").eqNullSafe(F.col("z")) & (F.col("d") > F.col("z_d"))
        center_itself = (F.col("d") == F.col("z_d")) & (F.col("label") == F.col("z"))
        below = paths.select(F.col("c").alias("label"), (F.col("d") - 1).alias("z_d"), F.col("label").alias("child"), "above")
        met = rows.join(moved(center.select("top_d", "top", "z_d", "z")), ["top_d", "top"]).join(moved(below), ["label", "z_d"], "left")
        met = stored(met.withColumns({"under": under, "center": center_itself}), "split")
        totals = stored(met.where("under or center").groupBy("top_d", "top", "z_d", "z").agg(*sums), "totals")
        on_path = paths.join(moved(totals.withColumnRenamed("z", "c")), "c").where("d between top_d and z_d").select("d", "label", *names)
        added += [on_path, totals.where("top_d = 0").select(F.col("top_d").alias("d"), F.col("top").alias("label"), *names)]
        rows = met.where("not center").select(
            "d", "label", "parent", *names,
            F.when(F.col("under"), F.col("z_d") + 1).otherwise(F.col("top_d")).alias("top_d"),
            F.when(F.col("under"), F.col("child")).otherwise(F.col("top")).alias("top"),
        )
        rows = stored(rows, "components")
    left = done[0]
    for more in done[1:]:
        left = left.unionByName(more)
    out = small_totals(left, names)
    for more in added:
        out = out.unionByName(more)
    return out.groupBy("d", "label").agg(*sums)


def end_digests(ends: DataFrame) -> DataFrame:
    """(d, label, ends_sha256) of the members `ends` (d, label, c): their numbers in order, joined by commas, hashed.

    Ranges of (node, member) are written as stretches of text by many tasks; a node's stretches, few as they are, pass
    through one task, which holds one at a time.
    """

    def runs(batch):
        d, label = batch.column("d").to_numpy(), batch.column("label").to_numpy()
        cuts = np.flatnonzero((d[1:] != d[:-1]) | (label[1:] != label[:-1])) + 1
        return zip([0, *cuts], [*cuts, len(d)]) if len(d) else ()

    def joined(batches):
        for batch in batches:
            c = batch.column("c").to_pylist()
            begins = [(b, ",".join(map(str, c[b:e]))) for b, e in runs(batch)]
            at = pa.array([b for b, _ in begins], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).take(at) for n in ("d", "label", "c")] + [pa.array([t for _, t in begins], pa.string())], ["d", "label", "c", "ids"]
            )

    def hashed(batches):
        node = sha = None
        for batch in batches:
            out = []
            for d, label, ids in zip(*(batch.column(n).to_pylist() for n in ("d", "label", "ids"))):
                if (d, label) == node:
                    sha.update(b",")
                else:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (d, label), hashlib.sha256()
                sha.update(ids.encode())
            yield as_rows(out)
        if node:
            yield as_rows([(*node, sha.hexdigest())])

    def as_rows(out):
        d, label, sha = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(label, pa.int64()), pa.array(sha, pa.string())], ["d", "label", "ends_sha256"])

    order = ["d", "label", "c"]
    text = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "d long, label long, c long, ids string")
    return text.repartition("d", "label").sortWithinPartitions(*order).mapInArrow(hashed, "d long, label long, ends_sha256 string")


def prefix_trie(members: DataFrame, turns: DataFrame, small: int = SMALL) -> DataFrame:
    """The trie of `turns` (c, d from 1 without gaps, role, digest, words) of the `members` (c, size; stored).

    One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256,
    and is the root for depth 0, which all members share, also those without turns. No members give no rows.
    """
    nodes, paths = trie_nodes(members, turns)
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("parent").alias("label")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(moved(children), ["d", "label"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    leaf = (F.col("n_children") == 0).cast("long")
    nodes = stored(nodes.withColumns({"n_leaves": leaf, "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}), "nodes")
    totals = subtree_totals(nodes, paths, ["n_leaves", "saved_tokens"], small)
    ends = members.select("c", F.col("size").alias("d")).where("d > 0").join(moved(paths.select("c", "d", "label")), ["c", "d"])
    top = nodes.where("d = 0").select("d", "label")
    ends = ends.unionByName(members.where("size = 0").select("c").crossJoin(F.broadcast(top)))  # the root is one row
    out = nodes.drop("n_leaves", "saved_tokens").join(moved(totals), ["d", "label"]).join(moved(end_digests(ends)), ["d", "label"], "left")
    return out.select(
        F.col("label").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all `conversations` (conv_id, turn, role, text), each rebuilt with the head of its group of 20.

    Null roles and texts count as empty, a null turn comes first, and rows with a null conv_id belong to no conversation
    and are left out. Rows that repeat a turn are turns of their own. Other columns are ignored.
    """
    turns = stored(placed_turns(conversations), "placed")
    members, rebuilt = with_shared_heads(turns)
    return prefix_trie(members, rebuilt)
