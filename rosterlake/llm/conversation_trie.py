"""Prefix trie of conversations by hashing blocks of turns.

A turn is named by the md5 of its role and text, so texts are read once and only
digests travel. Conversations are first grouped by the digests of successive blocks of
``BLOCK`` turns: one row per conversation and block instead of one per turn. Only blocks
that have siblings, that is another block after the same prefix, are refined to single
turns, each different block once; a block without siblings is a chain whose turns all
have the members of the block.

A key names the prefix that ends at a turn: the exclusive or of the digests of its blocks
(each with its number), two times 64 bits. Every node is named by its smallest member
and its depth as well: members of different nodes of one depth are disjoint.

Sums over a subtree need no walk along the depth. A conversation owns the nodes whose
smallest member it is, the last ones of its path. What it owns counts for every node on
its path, so a sum over the members of a node has everything below the node, and what
the smallest member owns above the node is taken off again.

Hot groups: turns are numbered on a range partitioning that may cut a conversation, and
running figures add up pieces of ``PIECE`` rows, so a conversation with a third of all
turns is spread over many tasks; members are counted before the shuffle; children find a
parent with many of them in a broadcast of less than ``2 * CROWDED`` rows; the
conversations that end at a node meet as lists of up to ``CHUNK`` ids.

Cases: turns come in the order of ``turn``, null first, ties by the digest of role and
text; repeated rows are turns of their own; a null role or text is an empty one; rows
without a conversation id are left out; an empty table has no node, not even a root;
other columns are not read; texts of any length cost their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import Scratch

BLOCK = 4
PIECE = 1024
CROWDED = 10_000
CHUNK = 50_000
NAME = ["depth", "k1", "k2"]
EARLIER = (Window.unboundedPreceding, -1)


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, digest, bytes)``: what the trie needs of a turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(named)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def numbered(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns with their ``place`` in the conversation, from 1, and ``(conv_id, n)``.

    The rows are laid out by a range partitioning and stored, so their numbers stay.
    """
    ordered = scratch.save(rows, "turns").orderBy("conv_id", "turn", "digest")
    laid = scratch.save(ordered.withColumn("at", F.monotonically_increasing_id()), "laid")
    laid = laid.withColumn("part", F.shiftright("at", 33))
    pieces = laid.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    earlier = F.sum("rows").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(*EARLIER))
    starts = scratch.save(pieces.withColumn("before", F.coalesce(earlier, F.lit(0))), "starts")
    placed = laid.join(starts, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("place"), "digest", "bytes"
    )
    return placed, starts.groupBy("conv_id").agg(F.sum("rows").alias("n"))


def whole(placed: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation as it is: its turns by ``depth``, and ``(conv_id, length)``."""
    lengths = sizes.select("conv_id", F.col("n").alias("length"))
    return placed.withColumnRenamed("place", "depth").join(lengths, "conv_id"), lengths


def forked(
    placed: DataFrame, sizes: DataFrame, family: int = 5, heads: int = 9
) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt as branches: the first h turns of the first conversation of
    the family, then the own turns after the first h; h is drawn from the id."""
    drawn = F.crc32(F.col("conv_id").cast("string")) % heads
    known = sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    family_of = F.col("conv_id") - F.col("conv_id") % family
    plan = (
        sizes.select("conv_id", "n", drawn.alias("h"), family_of.alias("first"))
        .join(known, "first", "left")
        .withColumn("head", F.least("h", F.coalesce("n_first", F.lit(0))))
        .withColumn("length", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    own = placed.join(plan.select("conv_id", "h", "head", "length"), "conv_id").where("place > h")
    own = own.withColumn("depth", F.col("place") - F.col("h") + F.col("head"))
    # At most heads - 1 turns of a conversation, and the members of a family are few.
    begun = placed.where((F.col("conv_id") % family == 0) & (F.col("place") < heads))
    begun = begun.withColumnRenamed("conv_id", "first").join(plan.where("head > 0"), "first").where("place <= head")
    columns = ["conv_id", "depth", "digest", "bytes", "length"]
    rebuilt = own.select(*columns).union(begun.withColumnRenamed("place", "depth").select(*columns))
    return rebuilt, plan.select("conv_id", "length")


def running(
    rows: DataFrame,
    key: str,
    at: str,
    figures: Mapping[str, tuple[Callable, Callable]],
) -> DataFrame:
    """``rows`` with every figure ``f`` over the rows of the key before this one as ``before_f``.

    ``figures`` maps a column to its aggregate and the way two aggregates are joined.
    Pieces of ``PIECE`` places are summed on their own, then the pieces of a key.
    """
    cut = rows.withColumn("piece", F.floor(F.col(at) / PIECE)).repartition(key, "piece")
    inside = Window.partitionBy(key, "piece").orderBy(at).rowsBetween(*EARLIER)
    pieces = cut.groupBy(key, "piece").agg(*[agg(c).alias(c) for c, (agg, _) in figures.items()])
    outside = Window.partitionBy(key).orderBy("piece").rowsBetween(*EARLIER)
    zero = F.lit(0).cast("long")
    bases = pieces.select(
        key, "piece", *[F.coalesce(agg(c).over(outside), zero).alias(f"_{c}") for c, (agg, _) in figures.items()]
    )
    within = cut.withColumns(
        {f"before_{c}": F.coalesce(agg(c).over(inside), zero) for c, (agg, _) in figures.items()}
    )
    added = {f"before_{c}": join(F.col(f"before_{c}"), F.col(f"_{c}")) for c, (_, join) in figures.items()}
    return within.join(bases, [key, "piece"]).withColumns(added).drop("piece", *[f"_{c}" for c in figures])


def block_digest(lane: int, number: Column, digests: Column) -> Column:
    return F.xxhash64(F.lit(lane), number, digests)


def blocks(path: DataFrame, size: int) -> DataFrame:
    """One row per conversation and block, with the keys before and after the block."""
    number = F.floor((F.col("depth") - 1) / size)
    turn = F.struct("depth", "digest", "bytes")
    grouped = path.groupBy("conv_id", number.alias("block"), "length").agg(
        F.array_sort(F.collect_list(turn)).alias("turns")  # at most ``size`` of them
    )
    digests = F.transform("turns", lambda t: t["digest"])
    named = grouped.withColumns({f"x{i}": block_digest(i, F.col("block"), digests) for i in (1, 2)})
    xor = (F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    chained = running(named, "conv_id", "block", {"x1": xor, "x2": xor})
    keys = {f"k{i}": F.col(f"before_x{i}").bitwiseXOR(F.col(f"x{i}")) for i in (1, 2)}
    return chained.withColumns(keys).select(
        "conv_id", "length", "block", "turns", *[F.col(f"before_x{i}").alias(f"p{i}") for i in (1, 2)], "k1", "k2"
    )


def different_blocks(each: DataFrame) -> DataFrame:
    """Every different block after the same prefix once: members, the smallest, its turns."""
    return each.groupBy("block", "k1", "k2", "p1", "p2").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("rep"), F.min_by("turns", "conv_id").alias("turns")
    )


def block_turns(distinct: DataFrame, size: int) -> DataFrame:
    """The turns of the different blocks: key of the turn and of the one before it, the
    block, and whether the block is the only one after its prefix."""
    parents = distinct.groupBy("block", "p1", "p2").agg(
        F.count("*").alias("children"), F.min("k1").alias("k1"), F.min("k2").alias("k2")
    )
    lone = parents.where("children = 1").select("block", "k1", "k2", F.lit(True).alias("alone"))
    digests = F.transform("turns", lambda t: t["digest"])

    def prefix(j: Column) -> Column:
        def lane(i):
            part = block_digest(i, F.col("block"), F.slice(F.col("digests"), F.lit(1), j))
            return F.col(f"p{i}").bitwiseXOR(part).alias(f"k{i}")

        return F.struct(lane(1), lane(2))

    marked = distinct.join(lone, ["block", "k1", "k2"], "left").withColumn("digests", digests)
    first = F.array(F.struct(F.col("p1").alias("k1"), F.col("p2").alias("k2")))
    keyed = marked.withColumn(
        "keys", F.concat(first, F.transform(F.sequence(F.lit(1), F.size("turns")), prefix))
    )
    each = keyed.select("*", F.posexplode("turns").alias("j", "t"))
    return each.select(
        F.col("block"),
        F.col("k1").alias("block_k1"),
        F.col("k2").alias("block_k2"),
        (F.col("block") * size + F.col("j") + 1).alias("depth"),
        *[F.col("keys")[F.col("j") + 1][f"k{i}"].alias(f"k{i}") for i in (1, 2)],
        *[F.col("keys")[F.col("j")][f"k{i}"].alias(f"p{i}") for i in (1, 2)],
        F.col("t.digest").alias("digest"),
        F.col("t.bytes").alias("bytes"),
        "n",
        "rep",
        F.coalesce("alone", F.lit(False)).alias("alone"),
    )


def _nodes(expanded: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node, the root among them."""
    kept = [*NAME, "p1", "p2", "digest", "bytes", "n", "rep"]
    shared = expanded.where("NOT alone").groupBy(*NAME).agg(
        *[F.min(c).alias(c) for c in ("p1", "p2", "bytes", "rep")],
        F.sum("n").alias("n"),
        F.first("digest").alias("digest"),  # the same in all rows of a key
    )
    zero, none = F.lit(0).cast("long"), F.lit(None)
    root = lengths.agg(F.count("*").alias("n"), F.min("conv_id").alias("rep")).where("n > 0")
    root = root.select(
        *[zero.alias(c) for c in NAME], none.cast("long").alias("p1"), none.cast("long").alias("p2"),
        none.cast("binary").alias("digest"), zero.alias("bytes"), "n", "rep",
    )
    alone = expanded.where("alone").select(*kept)
    return alone.unionByName(shared.select(*kept)).unionByName(root)


def _with_parents(nodes: DataFrame, total: int) -> DataFrame:
    """``parent_conv_id``: the smallest member of the node before.

    Parents with more than a ``CROWDED``-th of all nodes as children are broadcast: of
    those there are fewer than ``2 * CROWDED``.
    """
    up = ["depth", "p1", "p2"]
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("rep").alias("parent_conv_id"), "n_children",
    )
    many = F.col("n_children") > max(1, total // CROWDED)
    crowded = F.broadcast(parents.where(many).drop("n_children"))
    others = nodes.join(crowded.select(*up), up, "left_anti")
    found = others.join(parents.where(~many).drop("n_children"), up, "left")
    return nodes.join(crowded, up).unionByName(found)


def prefix_trie(
    path: DataFrame, lengths: DataFrame, scratch: Scratch, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie, and ``(depth, k1, k2, conv_id)``: where conversations end.

    ``path`` has the turns of every conversation by ``depth``. A node has its key, the
    digest of its last turn, ``conv_id``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens``.
    """
    lengths = scratch.save(lengths, "lengths")
    each = scratch.save(blocks(path, block), "blocks")
    expanded = scratch.save(block_turns(scratch.save(different_blocks(each), "distinct"), block), "expanded")
    bare = scratch.save(_nodes(expanded, lengths), "bare")
    total = bare.count()

    below = bare.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("n_children"))
    weighed = (
        bare.join(below, NAME, "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("leaf", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n") - 1) * F.col("bytes"))
    )
    add = (F.sum, lambda a, b: a + b)
    counted = scratch.save(running(weighed, "rep", "depth", {"leaf": add, "saved": add}), "counted")

    # What a conversation owns counts for all its prefixes, first block by block.
    figures = [F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")]
    owned = scratch.save(counted.groupBy(F.col("rep").alias("conv_id")).agg(*figures), "owned")
    key = ["block", "block_k1", "block_k2"]
    passing = each.select(
        "conv_id", "block", F.col("k1").alias("block_k1"), F.col("k2").alias("block_k2")
    ).join(owned, "conv_id")
    by_block = passing.groupBy(*key).agg(*figures)
    by_turn = expanded.select(*key, *NAME).join(by_block, key).groupBy(*NAME).agg(*figures)
    zero = F.lit(0).cast("long")
    by_turn = by_turn.unionByName(owned.agg(*figures).select(*[zero.alias(c) for c in NAME], "leaf", "saved"))
    through = by_turn.select(*NAME, F.col("leaf").alias("all_leaf"), F.col("saved").alias("all_saved"))

    nodes = _with_parents(counted, total).join(through, NAME).select(
        *NAME,
        "digest",
        F.col("rep").alias("conv_id"),
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        (F.col("all_leaf") - F.col("before_leaf")).alias("n_leaves"),
        (F.col("all_saved") - F.col("before_saved")).alias("saved_tokens"),
    )
    last = F.col("block") == F.floor((F.col("length") - 1) / block)
    ends = each.where(last).select(F.col("length").alias("depth"), "k1", "k2", "conv_id")
    bare_ends = lengths.where("length = 0").select(*[zero.alias(c) for c in NAME], "conv_id")
    return scratch.save(nodes, "nodes"), ends.unionByName(bare_ends)


def with_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes with the ``role`` and ``text`` of their last turn, null at the root."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    spoken = conversations.where("conv_id IS NOT NULL").select(
        F.unhex(F.md5(named)).alias("digest"), role.alias("role"), text.alias("text")
    )
    return nodes.join(spoken.dropDuplicates(["digest"]), "digest", "left")


CHUNKS = "depth bigint, k1 bigint, k2 bigint, first bigint, ids string"
HASHES = "depth bigint, k1 bigint, k2 bigint, ends_sha256 string"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _out(rows: Sequence[tuple], kinds: Sequence[pa.DataType], names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def ends_sha256(ends: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends_sha256)``: the hash of the ascending ids that end at a node.

    A hash is made in one go, yet its task holds no group: a range partitioning spreads
    the ids of a node over tasks, which join up to ``CHUNK`` of them, and the hash is fed
    one such list after the other.
    """
    long, text = pa.int64(), pa.string()

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, name, ids = [], None, []

        def close():
            if ids:
                done.append((*name, ids[0], ",".join(map(str, ids))))

        for *key, conv_id in _rows(batches):
            if key != name or len(ids) == CHUNK:
                close()
                name, ids = key, []
            ids.append(conv_id)
            if len(done) >= 1000 or (done and len(done[-1][-1]) > 1 << 18):
                yield _out(done, [long] * 4 + [text], ["depth", "k1", "k2", "first", "ids"])
                done.clear()
        close()
        if done:
            yield _out(done, [long] * 4 + [text], ["depth", "k1", "k2", "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, name, digest = [], None, None
        for *key, _, ids in _rows(batches):
            if key == name:
                digest.update(b"," + ids.encode())
                continue
            if name is not None:
                done.append((*name, digest.hexdigest()))
            name, digest = key, hashlib.sha256(ids.encode())
            if len(done) >= 1000:
                yield _out(done, [long] * 3 + [text], [*NAME, "ends_sha256"])
                done.clear()
        if name is not None:
            done.append((*name, digest.hexdigest()))
            yield _out(done, [long] * 3 + [text], [*NAME, "ends_sha256"])

    spread = ends.select(*NAME, "conv_id").orderBy(*NAME, "conv_id").mapInArrow(lists, CHUNKS)
    return spread.repartition(*NAME).sortWithinPartitions(*NAME, "first").mapInArrow(hashes, HASHES)


NO_ENDS = hashlib.sha256(b"").hexdigest()


def described(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """The digest columns of every node, one row each."""
    return nodes.join(ends_sha256(ends), NAME, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
