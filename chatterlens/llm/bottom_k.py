"""Near-duplicate documents by bottom-k sketches of their word shingles, confirmed by exact Jaccard similarity.

One hash function orders all shingles. A document keeps its ``k`` smallest values; inverted lists of kept values give
candidates, the sketch of a pair's union filters them, and their full shingle sets decide.

Which values are listed. Of two sets of similarity t the k smallest values of their union are shared with chance t
each, so both sketches share at least ``least_shared(k, t)`` values but for a chance below 1e-9. By the prefix
principle they then share one of the first k + 1 - least_shared values in any order common to all; the order taken
is rarest first, so passages that many documents quote do not bring their documents together. Sets of at most k
shingles are kept whole, and for them this is exact.

Large lists. Equal sets are one node from the start. The nodes of all lists with the same pivot (the member with the
most common values) form one group. Groups of up to ``PAIRED`` nodes are compared pair by pair. In a larger one every
node is compared with the pivot and with a few central members; only nodes that are then not connected with the pivot
are compared with others, and of those only with the ones that share a rare shingle early enough: the exact prefix and
position bounds over the whole sets of all members of large groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterlens.llm.hashing import BLANK_SEPARATED, Words, as_long, mixed, slices, words_of
from chatterlens.llm.steps import connected_components, lasting, stored, temporary

K = 32
PAIRED = 32
CENTRAL = 8
MISS = 1e-9
BROADCAST_ROWS = 1_000_000
_SECOND = np.uint64(0x5851F42D4C957F2D)
_SIGN = np.uint64(1 << 63)  # flipped, so that longs have the order of the unsigned hashes


def least_shared(k: int, percent: int) -> int:
    """Largest c such that fewer than c of k independent values are shared with a chance of at most ``MISS``."""
    t, below = percent / 100, 0.0
    for c in range(k + 1):
        below += math.comb(k, c) * t**c * (1 - t) ** (k - c)
        if below > MISS:
            return max(1, c)
    return k


def shingle_set(words: Words, hashes: np.ndarray, row: int, length: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; all its words as one if they are fewer than a shingle."""
    first, end = int(words.first[row]), int(words.first[row + 1])
    if end - first >= length:
        return np.unique(hashes[first : end - length + 1])
    return np.array([words.whole(row)], np.uint64) if end > first else np.zeros(0, np.uint64)


def node_of(values: np.ndarray) -> bytes | None:
    """Name of a set: its size and two independent sums over its members; equal sets have equal names."""
    if not len(values):
        return None
    sums = values.sum(dtype=np.uint64), mixed(values ^ _SECOND).sum(dtype=np.uint64)
    return len(values).to_bytes(4, "big") + b"".join(int(s).to_bytes(8, "big") for s in sums)


def _sets(text: str, length: int, k: int | None):
    """Arrow function: the text column becomes n, node and the k smallest (or all) values of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words = words_of(batch.column(text), BLANK_SEPARATED)
            hashes, _ = words.windows(length)
            sets = [shingle_set(words, hashes, row, length) for row in range(batch.num_rows)]
            kept = [as_long((s[:k] if k else s) ^ _SIGN) for s in sets]
            offsets = np.cumsum([0, *map(len, kept)])
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            columns = {name: batch.column(name) for name in batch.schema.names if name != text} | {
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array([node_of(s) for s in sets], pa.binary()),
                "values": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def sketches(docs: DataFrame, text: str, length: int, k: int) -> DataFrame:
    """(id columns, n, node, values) of every row, written away."""
    kept = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n long", "node binary", "values array<long>"])
    return docs.mapInArrow(_sets(text, length, k), schema)


def similar(shared: Column, n: Column, m: Column, percent: int) -> Column:
    """100 * intersection >= percent * union, in whole numbers."""
    return 100 * shared >= percent * (n + m - shared)


def share_of(n: Column, percent: int) -> Column:
    """Least whole number of at least that share of n."""
    return F.floor((n * percent + 99) / 100)


def postings(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """(value, node, rare) of the listed values: the rarest of each sketch, without those of one node only.

    ``rare`` counts the node's values that no other sketch has.
    """
    least = least_shared(k, percent)
    entries = nodes.select("node", "n", F.explode("values").alias("value"))
    spread = entries.groupBy("value").agg(F.count("*").alias("spread")).where("spread > 1")
    shared = entries.join(spread, "value")
    held = F.least("n", F.lit(k))
    needed = F.least(F.lit(least).cast("long"), share_of(F.col("n"), percent))
    per_node = shared.groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("spread", "value"))).alias("common"))
    rare = held - F.size("common")
    listed = per_node.withColumn("rare", rare).withColumn("listed", F.greatest(F.lit(0), held - needed + 1 - F.col("rare")))
    listed = listed.where("listed > 0")
    return listed.select("node", "rare", F.explode(F.slice("common", F.lit(1), F.col("listed"))).alias("entry")).select(
        "node", "rare", F.col("entry.value").alias("value")
    )


def groups(listed: DataFrame) -> DataFrame:
    """(pivot, node) without repeats: all members of the lists that have the same pivot, but the pivot itself."""
    pivots = listed.groupBy("value").agg(F.min(F.struct("rare", "node")).alias("first"))
    pivots = pivots.select("value", F.col("first.node").alias("pivot"))
    return listed.join(pivots, "value").where("node != pivot").select("pivot", "node").distinct()


def candidates(members: DataFrame) -> DataFrame:
    """Pairs (a, b) to compare: with the pivot always, with each other in groups of up to ``PAIRED`` nodes."""
    sizes = members.groupBy("pivot").agg(F.count("*").alias("size"))
    star = members.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    small = members.join(sizes.where(F.col("size") < PAIRED), "pivot").select("pivot", "node")
    paired = small.groupBy("pivot").agg(F.array_sort(F.collect_list("node")).alias("nodes"))
    first = paired.select(F.posexplode("nodes").alias("at", "a"), "nodes")
    each = first.select("a", F.explode(F.expr("slice(nodes, at + 2, size(nodes))")).alias("b"))
    return _ordered(star.union(each)).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def likely(pairs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Drop pairs whose sizes or union sketch exclude the similarity (the sketch but for a chance below 1e-9)."""
    one, two = (nodes.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "values")]) for s in "ab")
    both = pairs.join(one, F.col("a") == F.col("node_a")).where("a is not null").join(two, F.col("b") == F.col("node_b"))
    both = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    union = F.slice(F.array_sort(F.array_union("values_a", "values_b")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("values_a", "values_b")))
    needed = F.when(F.size(union) < k, share_of(F.size(union), percent)).otherwise(least_shared(k, percent))
    return both.where(shared >= needed).select("a", "b", "n_a", "n_b")


def full_sets(docs: DataFrame, key: str, text: str, length: int, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, values) with the whole sets of the wanted nodes, from one text of each.

    Up to ``BROADCAST_ROWS`` chosen rows (a few ten bytes each) are broadcast, so that no text is shuffled; more are
    joined by a shuffle.
    """
    chosen = nodes.join(wanted, "node", "left_semi").select(F.col("first.key").alias("k"), F.col("first.id").alias("i"))
    chosen = F.broadcast(chosen) if wanted.count() <= BROADCAST_ROWS else chosen
    rows = docs.select(F.col(key).alias("id"), text_key(text).alias("key"), F.col(text).alias("text"))
    rows = rows.join(chosen, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")), "left_semi").select("text")
    return rows.mapInArrow(_sets("text", length, None), "n long, node binary, values array<long>").dropDuplicates(["node"])


def text_key(text: str) -> Column:
    return F.xxhash64(F.col(text))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose whole sets are similar enough."""
    one, two = (sets.select(F.col("node").alias(f"node_{s}"), F.col("values").alias(f"values_{s}")) for s in "ab")
    both = pairs.join(two, F.col("b") == F.col("node_b")).join(one, F.col("a") == F.col("node_a"))
    shared = F.size(F.array_intersect("values_a", "values_b")).cast("long")
    return both.where(similar(shared, F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def ranked_sets(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, alone, prefix) of all members of large groups, their shingles ordered rarest first.

    Similar sets share a shingle of their prefixes. ``alone`` counts shingles that no other member has.
    """
    everyone = members.select("node").union(members.select("pivot")).distinct()
    own = sets.join(everyone, "node", "left_semi").select("node", F.explode("values").alias("value"))
    spread = own.groupBy("value").agg(F.count("*").alias("spread"))
    ranked = own.join(spread, "value").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("spread", "value"))).alias("order"))
    n = F.size("order").cast("long")
    alone = F.size(F.filter("order", lambda x: x["spread"] == 1)).cast("long")
    return ranked.select("node", n.alias("n"), alone.alias("alone"), F.slice("order", F.lit(1), (n - share_of(n, percent) + 1).cast("int")).alias("prefix"))


def with_component(nodes: DataFrame, components: DataFrame) -> DataFrame:
    joined = nodes.drop("component").join(components, "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def central_pairs(members: DataFrame, ranked: DataFrame) -> DataFrame:
    """Pairs (a, b) of the ``CENTRAL`` members of each large group that have the fewest shingles of their own with
    all its members in other components."""
    group = members.join(ranked.select("node", "n", "alone", "component"), "node")
    central = Window.partitionBy("pivot").orderBy("alone", F.desc("n"), "node")
    chosen = group.withColumn("rank", F.row_number().over(central)).where(F.col("rank") <= CENTRAL)
    chosen = chosen.select("pivot", F.col("node").alias("a"), F.col("component").alias("component_a"))
    return chosen.join(group, "pivot").where("component != component_a").select("a", F.col("node").alias("b"))


def outside_pairs(members: DataFrame, ranked: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of large groups that may still connect components.

    One of any such pair is not connected with the pivot of its group. The pair shares a shingle of both prefixes; if
    that is the first they share, they share no more than what follows it in either order.
    """
    named = ranked.select("node", "component")
    pivots = named.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_component"))
    outside = members.join(named, "node").join(pivots, "pivot").where("component != pivot_component").select("node").distinct()
    entries = ranked.select("node", "n", "component", F.posexplode("prefix").alias("before", "entry"))
    left = (F.col("n") - F.col("before")).alias("left")
    entries = entries.where("entry.spread > 1").select("node", "n", "component", F.col("entry.value").alias("value"), left)
    columns = ("node", "n", "component", "value", "left")
    one, two = (rows.select(*[F.col(c).alias(f"{c}_{s}") for c in columns]) for rows, s in ((entries.join(outside, "node", "left_semi"), "a"), (entries, "b")))
    possible = similar(F.least("left_a", "left_b"), F.col("n_a"), F.col("n_b"), percent)
    both = one.join(two, (F.col("value_a") == F.col("value_b")) & (F.col("component_a") != F.col("component_b")) & possible)
    return both.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 5, percent: int = 80, k: int = K
) -> DataFrame:
    """(id, key, n_shingles, component, component_id) of every row.

    Rows are linked if the sets of ``length``-word shingles of their whole texts (A-Z lower-cased, words parted by
    ASCII blanks) have a Jaccard similarity of at least ``percent`` / 100; a text of fewer words has one shingle, all
    of it. ``component`` names the connected component (the smallest set name), ``component_id`` is its smallest id,
    ``key`` a hash of the text. Null texts and texts without words have no set, are linked with nothing and are their
    own component. Rows with equal texts are linked whatever their ids; a null id never becomes a component's id
    unless all are null. Other columns are not read.
    """
    with temporary(docs.sparkSession):
        rows = docs.select(F.col(key).alias("id"), text_key(text).alias("key"), F.col(text).alias("text"))
        rows = stored(sketches(rows, "text", length, k), "sketches")
        nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
            F.first("n").alias("n"), F.first("values").alias("values"), F.min(F.struct("key", "id")).alias("first")
        )
        nodes = stored(nodes, "nodes")
        members = stored(groups(postings(nodes, k, percent)), "groups")
        pairs = stored(likely(candidates(members), nodes, k, percent), "pairs")
        sizes = members.groupBy("pivot").agg(F.count("*").alias("size")).where(F.col("size") >= PAIRED)
        large = stored(members.join(sizes, "pivot").select("pivot", "node"), "large-groups")
        wanted = [pairs.select(F.col(c).alias("node")) for c in "ab"] + [large.select(F.col(c).alias("node")) for c in ("pivot", "node")]
        wanted = wanted[0].union(wanted[1]).union(wanted[2]).union(wanted[3]).distinct()
        sets = stored(full_sets(docs, key, text, length, nodes, wanted), "sets")
        components = connected_components(confirmed(pairs, sets, percent))
        if not large.isEmpty():
            ranked = stored(ranked_sets(large, sets, percent), "ranked-sets")
            for step in (central_pairs, lambda *group: outside_pairs(*group, percent)):
                more = step(large, with_component(ranked, components))
                more = likely(_ordered(more).distinct(), nodes, k, percent)
                components = connected_components(confirmed(more, sets, percent), components)
        linked = rows.select("id", "key", F.col("n").alias("n_shingles"), "node").join(components, "node", "left")
        linked = linked.withColumn("component", F.coalesce("component", "node")).drop("node")
        first = linked.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("component_id"))
        found = linked.join(first, "component", "left").select(
            "id", "key", "n_shingles", "component", F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
        )
        return lasting(found, "near-duplicates")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near-duplicates: of every component the row of the smallest id stays, unchanged.

    Ties in the id are decided by the text's hash; of rows that repeat id and text one stays. Null texts and texts
    without words stay, all of them, but for such repeats of null texts with the same id, which stay too.
    """
    found = near_duplicates(docs, key, text, length, percent).where("component IS NOT NULL")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"), F.count("*").alias("rows"))
    first = first.where("rows > 1")
    lost = found.join(first, "component").where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))))
    lost = lost.select(F.col("id").alias("__id"), F.col("key").alias("__key")).distinct()
    repeated = found.groupBy(F.col("id").alias("__id"), F.col("key").alias("__key")).agg(F.count("*").alias("rows")).where("rows > 1").drop("rows")
    same = F.col(key).eqNullSafe(F.col("__id")) & (text_key(text) == F.col("__key"))
    docs_left = docs.join(_checked(lost), same, "left_anti")
    if repeated.isEmpty():
        return docs_left
    repeated = _checked(repeated)
    again = docs_left.join(repeated, same, "left_semi").withColumn("__text", text_key(text)).dropDuplicates([key, "__text"]).drop("__text")
    return docs_left.join(repeated, same, "left_anti").union(again)


def _checked(rows: DataFrame) -> DataFrame:
    """Broadcast up to ``BROADCAST_ROWS`` pairs of id and hash; more are joined by a shuffle."""
    rows = stored(rows, "row-keys")
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
