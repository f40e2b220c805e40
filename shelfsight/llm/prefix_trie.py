"""The prefix trie of conversations, from digests of fixed blocks of turns.

Conversations are cut into blocks of four turns. A block's node is named by the digest of the node before it and of
its turns, so conversations that agree up to a block have the same name there, and one aggregation groups them all, at
every depth. Only where a node has more than one block after it are the turns inside those blocks named and grouped
one by one; a block without siblings is a plain run of turns. Names are SHA-256, cut to 128 bits.

What a node sums over its subtree is found without walking the tree. Every node belongs to its smallest member, and the
nodes that belong to one conversation are the lower end of its path. So a sum over a subtree is the sum over the node's
members of all that belongs to them, less what the smallest member owns above the node.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.operators.ordering import number_rows
from shelfsight.staging import stage

BLOCK = 4
#: Blocks whose names one row of a conversation chains; longer conversations are chained from rows of rows.
CHAIN = 64
#: A piece of an id list covers 2 to this power neighbouring ids.
_ID_BITS = 9
_ROOT = b""
_TURN = "struct<digest:binary,bytes:int>"


def _name(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def _joined(before: Column, turns: Column) -> Column:
    """``before`` and the digests of some turns, one after the other."""
    return F.aggregate(turns, before, lambda done, turn: F.concat(done, turn["digest"]))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Stored ``conv_id``, ``pos`` (from 1), ``digest`` and ``bytes`` of every turn; the texts stay behind.

    Turns are ordered by ``turn``, null first; equal ones by the digest of role and text, so any two runs agree. A null
    role or text counts as empty. Rows without a ``conv_id`` belong to no conversation. Other columns are not read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = _name(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", digest.alias("digest"), F.octet_length(text).alias("bytes")
    )
    rows = number_rows(stage(rows, "trie-turns"), ["conv_id", "turn", "digest"], "place")
    first = rows.groupBy("conv_id").agg(F.min("place").alias("first"))
    placed = rows.join(first, "conv_id").withColumn("pos", F.col("place") - F.col("first") + 1)
    return stage(placed.select("conv_id", "pos", "digest", "bytes"), "trie-ordered")


def rebuilt(turns: DataFrame, lead_of: Column, lead: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of another one.

    The first ``lead`` turns (at most ``most``) are those of the conversation ``lead_of``, fewer if it has fewer, none if
    there is none such; the conversation's own turns after its first ``lead`` follow. Both are expressions over
    ``conv_id``. Returns the turns, and ``conv_id`` and ``length`` of every conversation, also of empty ones.
    """
    heads = turns.where(F.col("pos") <= most).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("head")
    )
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    known = sizes.withColumns({"lead": lead.cast("long"), "lead_of": lead_of})
    found = known.join(heads.withColumnRenamed("conv_id", "lead_of"), "lead_of", "left")
    taken = F.coalesce(F.slice("head", F.lit(1), F.col("lead").cast("int")), F.array().cast("array<struct<pos:bigint,digest:binary,bytes:int>>"))
    convs = found.withColumn("taken", taken).select(
        "conv_id", "taken", (F.size("taken") - F.col("lead")).alias("shift"), "lead",
        (F.size("taken") + F.greatest(F.col("own") - F.col("lead"), F.lit(0))).alias("length"),
    )
    convs = stage(convs, "trie-leads")
    rest = turns.join(convs.select("conv_id", "lead", "shift"), "conv_id").where("pos > lead")
    all_turns = convs.select("conv_id", F.inline("taken")).union(
        rest.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "digest", "bytes")
    )
    return stage(all_turns, "trie-rebuilt"), convs.select("conv_id", "length")


def _chained(rows: DataFrame, links: str) -> Column:
    """For each of a row's links, its struct with ``before``, the name of all that comes before it."""
    kind = dict(rows.dtypes)[links]
    inner = kind.removeprefix("array<struct<").removesuffix(">>")
    out = F.array().cast(f"array<struct<{inner},before:binary>>")
    start = F.struct(F.col("before").alias("at"), out.alias("out"))
    return F.aggregate(links, start, lambda done, link: F.struct(
        _name(done["at"], link["digests"]).alias("at"),
        F.concat(done["out"], F.array(link.withField("before", done["at"]))).alias("out"),
    ))["out"]


def _around(rows: DataFrame, longest: int) -> DataFrame:
    """``(conv_id, row, before, after)``: the names up to each row's start and end. ``rows`` has ``digests``, a row's own."""
    if longest <= 1:
        return rows.select("conv_id", "row", F.lit(_ROOT).alias("before"), _name(F.lit(_ROOT), F.col("digests")).alias("after"))
    parts = rows.groupBy("conv_id", F.expr(f"row div {CHAIN}").alias("upper")).agg(
        F.array_sort(F.collect_list(F.struct("row", "digests"))).alias("links")
    )
    above = _around(parts.select("conv_id", F.col("upper").alias("row"), _row_digest().alias("digests")), -(-longest // CHAIN))
    joined = parts.join(above.withColumnRenamed("row", "upper"), ["conv_id", "upper"])
    listed = joined.select("conv_id", F.col("after").alias("end"), F.inline(_chained(joined, "links")))
    after = F.when(F.col("row") % CHAIN == CHAIN - 1, F.col("end")).otherwise(_name(F.col("before"), F.col("digests")))
    return listed.select("conv_id", "row", "before", after.alias("after"))


def _row_digest() -> Column:
    """The digest of all links of a row together."""
    return F.unhex(F.sha2(F.aggregate("links", F.lit(_ROOT), lambda done, x: F.concat(done, x["digests"])), 256))


def _blocks(turns: DataFrame) -> DataFrame:
    """Stored blocks: ``conv_id``, ``depth`` (turns before), ``before`` and ``node`` (names) and ``turns``."""
    longest = turns.agg(F.max("pos")).first()[0] or 0
    span = BLOCK * CHAIN
    rows = turns.groupBy("conv_id", F.expr(f"(pos - 1) div {span}").alias("row")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "digest", "bytes"))),
            lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes")),
        ).alias("all")
    )
    def block(i: Column) -> Column:
        part = F.slice("all", BLOCK * i + 1, F.lit(BLOCK))
        return F.struct(
            (F.col("row") * span + BLOCK * i).alias("depth"), part.alias("turns"), _joined(F.lit(_ROOT), part).alias("digests")
        )
    starts = F.sequence(F.lit(0), F.expr(f"(size(all) - 1) div {BLOCK}"))
    rows = rows.select("conv_id", "row", F.transform(starts, block).alias("links"))
    node = _name(F.col("before"), F.col("digests"))
    if longest > span:
        rows = stage(rows, "trie-rows")
        around = _around(rows.select("conv_id", "row", _row_digest().alias("digests")), -(-longest // span))
        rows = rows.join(around, ["conv_id", "row"])
        # The node at a full row's end has the name that the next row starts from.
        at_end = F.col("depth") + F.size("turns") == (F.col("row") + 1) * span
        node = F.when(at_end, F.col("after")).otherwise(node)
    else:
        rows = rows.withColumns({"before": F.lit(_ROOT), "after": F.lit(None).cast("binary")})
    listed = rows.select("conv_id", "row", "after", F.inline(_chained(rows, "links")))
    return stage(listed.select("conv_id", "depth", "before", "turns", node.alias("node")), "trie-blocks")


def _cover(blocks: DataFrame) -> DataFrame:
    """Stored rows: each node that some block passes, with its parent and what the block's members add to it."""
    groups = stage(blocks.groupBy("node", "before", "depth", "turns").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), F.sum("last").alias("ends")
    ), "trie-groups")
    forks = groups.groupBy("before").agg((F.count("*") > 1).alias("forks"))
    joined = groups.join(forks, "before")
    size = F.size("turns")

    def named(t: Column) -> Column:
        """The node after ``t`` turns of the block; without siblings its place in the block is name enough."""
        told = _name(_joined(F.col("before"), F.slice("turns", F.lit(1), t)))
        plain = F.concat("node", F.encode(t.cast("string"), "utf-8"))
        return F.when(t == 0, F.col("before")).when(t == size, F.col("node")).when(F.col("forks"), told).otherwise(plain)

    def step(t: Column) -> Column:
        return F.struct(
            named(t).alias("id"), named(t - 1).alias("parent"), (F.col("depth") + t).alias("at"),
            F.element_at("turns", t)["bytes"].alias("bytes"), F.when(t == size, F.col("ends")).otherwise(0).alias("ends"),
        )
    listed = joined.select("node", "n", "first", F.explode(F.transform(F.sequence(F.lit(1), size), step)).alias("x"))
    return stage(listed.select(F.col("node").alias("block"), "n", "first", "x.*"), "trie-cover")


def _owned(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``above``, what their smallest member owns above them, found in runs so that no path is one task's."""
    value = (F.col("n") - 1) * F.col("bytes")
    run = F.expr("depth div 256")
    runs = nodes.groupBy("first", run.alias("run")).agg(F.sum(value).alias("owned"))
    earlier = runs.select("first", "run", F.expr("sum(owned) OVER (PARTITION BY first ORDER BY run) - owned").alias("earlier"))
    within = F.expr("sum(value) OVER (PARTITION BY first, run ORDER BY depth) - value")
    placed = nodes.withColumns({"value": value, "run": run}).withColumn("within", within)
    return placed.join(earlier, ["first", "run"]).withColumn("above", F.col("within") + F.col("earlier")).drop(
        "value", "run", "within", "earlier"
    )


def _id_digests(ends: DataFrame) -> DataFrame:
    """``(id, ends_sha256)``: the digest of the ascending ids of each node, comma-joined, fed to it piece by piece."""
    pieces = ends.groupBy("id", F.shiftright("conv_id", _ID_BITS).alias("piece")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids")
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        at, state = None, None

        def result(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())],
                ["id", "ends_sha256"],
            )
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node != at:
                    if state is not None:
                        done.append((at, state.hexdigest()))
                    at, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield result(done)
        if state is not None:
            yield result([(at, state.hexdigest())])

    sorted_pieces = pieces.repartition("id").sortWithinPartitions("id", "piece").select("id", "ids")
    return sorted_pieces.mapInArrow(digests, "id binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each distinct beginning of the conversations, the root (no turn) included.

    ``turns`` has ``conv_id``, ``pos`` (from 1, without gaps), ``digest`` and ``bytes``; ``convs`` has ``conv_id`` and
    ``length`` of every conversation and may list empty ones. Both must be stored tables. Gives ``conv_id`` (the smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    Equal conversations are members of the same nodes. No conversations, no rows.
    """
    blocks = _blocks(turns).join(convs, "conv_id")
    blocks = blocks.withColumn("last", (F.col("depth") + F.size("turns") == F.col("length")).cast("int")).drop("length")
    blocks = stage(blocks, "trie-members")
    cover = _cover(blocks)
    nodes = cover.groupBy("id", "parent", F.col("at").alias("depth"), "bytes").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("ends").alias("ends")
    )
    root = convs.agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), F.count_if(F.col("length") == 0).alias("ends")
    ).where("n > 0").select(
        F.lit(_ROOT).alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).alias("bytes"), "n", "first", "ends",
    )
    nodes = stage(nodes.union(root), "trie-nodes")

    owned = stage(nodes.groupBy("first").agg(
        F.sum((F.col("n") - 1) * F.col("bytes")).alias("owned"), F.count_if(F.col("n") == F.col("ends")).alias("leaves")
    ).withColumnRenamed("first", "conv_id"), "trie-owned")
    # A conversation that owns no node adds nothing to those it is a member of.
    passed = blocks.select("conv_id", "node").join(owned, "conv_id").groupBy("node").agg(
        F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves")
    ).withColumnRenamed("node", "block")
    sums = cover.select("id", "block").join(passed, "block").groupBy("id").agg(
        F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves")
    )
    whole = owned.agg(F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves"))
    sums = sums.union(whole.where("leaves IS NOT NULL").select(F.lit(_ROOT).alias("id"), "owned", "leaves"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("children"))
    ends = blocks.where("last = 1").select(F.col("node").alias("id"), "conv_id").union(
        convs.where("length = 0").select(F.lit(_ROOT).alias("id"), "conv_id")
    )
    parents = nodes.select(F.col("id").alias("parent"), F.col("first").alias("parent_conv_id"))
    found = (
        _owned(nodes).join(sums, "id").join(children, "id", "left").join(_id_digests(ends), "id", "left")
    )
    return found.join(parents, "parent", "left").select(
        F.col("first").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        F.coalesce("children", F.lit(0)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("owned") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
