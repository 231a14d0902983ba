"""Prefix trie of conversations, by ROLLUP over positional turn columns.

A turn is a 120-bit digest of its place, role and text, so the exclusive or of the digests of
a conversation's first turns names its prefix. Conversations are cut into blocks of
``BLOCK`` turns: a row has the name of the prefix before the block (its node) and one column for each
turn of it. One GROUP BY over the node and ROLLUP of the turn columns then aggregates the
prefixes of all depths together, long conversations block by block.

A node is named by its smallest member. A conversation that is the smallest member of a node is so in
all nodes after it on its way, so the nodes split into chains, one for each such
conversation. Sums over a node's subtree are sums over its members' whole chains, less what its own chain has
before it: a second ROLLUP.

Nulls, ties, repeats, empty tables: rows without a conversation id take no part; a null role or text is empty;
turns are taken in the order of the given columns; repeated turns and repeated conversations count; without conversations there
is no node, not even the root. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from firmweave.operators.relational import lookup
from firmweave.storage import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 8  # turn columns of a block
IDS = 4096  # conversation ids, at most, that are joined to one string before they are hashed in order
WORDS = r"[^\x20\x09-\x0D]+"
_TURNS = [f"t{i}" for i in range(1, BLOCK + 1)]


def _digest(*parts: Column) -> Column:
    """(a, b): two halves of 60 bits."""
    hexed = F.md5(F.concat(*parts))
    half = lambda at: F.conv(F.substring(hexed, at, 15), 16, 10).cast("bigint")
    return F.struct(half(1).alias("a"), half(17).alias("b"))


def _xor(paths: list[Column]) -> Column:
    """Names of prefixes and turns, one after the other; a missing one changes nothing."""
    part = lambda name: reduce(lambda x, y: x.bitwiseXOR(y), [F.coalesce(p[name], F.lit(0).cast("bigint")) for p in paths])
    return F.struct(part("a").alias("a"), part("b").alias("b"))


def turn_blocks(turns: DataFrame, conversations: DataFrame, order: Sequence[str]) -> DataFrame:
    """(conv_id, block, node, t1..t8): blocks of each conversation; one without turns has a first block without any.

    ``turns`` has conv_id, role, text and the columns of ``order``; ``conversations`` has every conv_id once.
    """
    own = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", F.lit(1).alias("real"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    roots = conversations.filter("conv_id IS NOT NULL").select("conv_id", F.lit(0).alias("real"))
    by = Window.partitionBy("conv_id").orderBy("real", *[F.asc_nulls_first(f"o{i}") for i in range(len(order))])
    at = own.unionByName(roots, allowMissingColumns=True).withColumn("at", F.row_number().over(by) - 1)
    size = F.octet_length("role").cast("string")
    turn = F.when(F.col("real") == 1, _digest(F.col("at").cast("string"), F.lit(":"), size, F.lit(":"), F.col("role"), F.col("text")))
    steps = at.select(
        "conv_id", "at", turn.alias("turn"), F.when(F.col("real") == 1, F.regexp_count("text", F.lit(WORDS))).cast("bigint").alias("words")
    )
    run = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda name: F.coalesce(F.expr(f"bit_xor(turn.{name})").over(run), F.lit(0).cast("bigint"))
    placed = steps.withColumn("before", F.struct(before("a").alias("a"), before("b").alias("b")))
    block = F.expr(f"greatest(at - 1, 0) div {BLOCK}")
    column = lambda i: F.max(F.when(F.expr(f"at > 0 AND (at - 1) % {BLOCK} = {i}"), F.struct("turn.a", "turn.b", "words"))).alias(_TURNS[i])
    first = F.min(F.when(F.expr(f"greatest(at - 1, 0) % {BLOCK} = 0"), F.col("before"))).alias("node")
    return placed.groupBy("conv_id", block.alias("block")).agg(first, *[column(i) for i in range(BLOCK)])


def _rolled(blocks: DataFrame, measures: str) -> DataFrame:
    """(path, up, depth, words, measures): every node of every depth, from one ROLLUP."""
    turns = ", ".join(_TURNS)
    grouped = blocks.sparkSession.sql(
        f"SELECT block, node, {turns}, {BLOCK} - bit_count(grouping_id()) AS level, {measures} FROM {{blocks}} GROUP BY block, node, ROLLUP({turns})",
        blocks=blocks,
    )
    last = F.get(F.array(*_TURNS), F.col("level") - 1)
    found = grouped.withColumn("last", last).filter("last IS NOT NULL OR (level = 0 AND block = 0)")
    # columns below the level are null in the group
    names = grouped.columns[grouped.columns.index("level") + 1 :]
    return found.withColumn("path", _xor([F.col("node"), *map(F.col, _TURNS)])).select(
        "path", _xor([F.col("path"), F.col("last")]).alias("up"), (F.col("block") * BLOCK + F.col("level")).alias("depth"),
        F.coalesce("last.words", F.lit(0).cast("bigint")).alias("words"), *names,
    )


def _digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each path's strings, which come in order; one state is held, whatever the group's size."""
    schema = pa.schema([("path", pa.struct([("a", pa.int64()), ("b", pa.int64())])), ("ends_sha256", pa.string())])
    now, state = None, None
    done: list[tuple] = []
    for batch in batches:
        for path, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
            if path != now:
                if now:
                    done.append((now, state.hexdigest()))
                now, state = path, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_pylist([{"path": p, "ends_sha256": h} for p, h in done], schema)
            done = []
    if now:
        yield pa.RecordBatch.from_pylist([{"path": now, "ends_sha256": state.hexdigest()}], schema)


def end_digests(blocks: DataFrame) -> DataFrame:
    """(path, ends_sha256): of the ids of the conversations that end at a node, ascending, joined by commas.

    Ids are joined by ranges first, so what follows one another in a node's task is short strings, not all its ids.
    """
    ends = blocks.groupBy("conv_id").agg(F.max(F.struct("block", _xor([F.col("node"), *map(F.col, _TURNS)]).alias("path"))).alias("end"))
    ranges = ends.groupBy(F.col("end.path").alias("path"), F.floor(F.col("conv_id") / IDS).alias("range")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return ranges.repartition("path").sortWithinPartitions("path", "range").select("path", "ids").mapInArrow(
        _digest_ids, "path struct<a: bigint, b: bigint>, ends_sha256 string")


def prefix_nodes(turns: DataFrame, conversations: DataFrame, order: Sequence[str] = ("turn",)) -> DataFrame:
    """One row for each distinct beginning of conversations, the empty one (depth 0) included.

    conv_id, the smallest member; depth; parent_conv_id (null for the root); n_convs, members; n_children; n_leaves,
    childless nodes in the subtree; saved_tokens, over the subtree, (n_convs - 1) times the words of the last text;
    ends_sha256, of the members that end there.
    """
    blocks = cut_lineage(turn_blocks(turns, conversations, order))
    nodes = cut_lineage(_rolled(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs"))
    children = nodes.filter("depth > 0").groupBy(F.col("up").alias("path")).agg(F.count(F.lit(1)).alias("n_children"))
    chain = Window.partitionBy("conv_id").orderBy("depth")
    nodes = cut_lineage(
        nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
        .withColumn("start", F.lag("depth").over(chain).isNull())
        .withColumn("before", F.coalesce(F.sum("saved").over(chain.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    )
    chains = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    shares = blocks.join(chains, "conv_id", "left").fillna(0, ["saved", "leaves"])
    sums = _rolled(shares, "sum(saved) AS saved_all, sum(leaves) AS n_leaves").select("path", "saved_all", "n_leaves")
    # a chain's first node hangs on another chain; a common beginning can be the parent of a large part of them
    starts = cut_lineage(nodes.filter("start AND depth > 0").select(F.col("path").alias("child"), F.col("up").alias("path")))
    parents = lookup(starts, nodes.select("path", F.col("conv_id").alias("parent")), "path").select(F.col("child").alias("path"), "parent")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(sums, "path").join(parents, "path", "left").join(end_digests(blocks), "path", "left").select(
            "conv_id", F.col("depth").cast("bigint").alias("depth"),
            F.when(F.col("depth") == 0, None).when(F.col("start"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", (F.col("saved_all") - F.col("before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
