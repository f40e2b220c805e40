"""A Merkle manifest of a dataset: every row's digest, the trees over them, proofs, and their verification.

Leaves are ordered by key within their group; two consecutive nodes at a time become their parent until one, the
subroot of the group, is left. The subroots, ordered by group, form the tree below the root.

Every node is labelled with the interval of leaf ranks that it covers. A tree is built in strata of eight levels: one
shuffle brings up to 256 neighbours together, which is a bounded row. A row's ancestors are the nodes whose interval
holds the row's; at one level the intervals are all of one width, so containment is looked up by level and bucket of
that width. What is left of the parent's interval without the row's own branch is the sibling that a proof needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.common import join_counted, key_text
from shelfsight.operators.ordering import number_rows
from shelfsight.staging import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one shuffle builds; a row then holds up to 2 to this power nodes.
STRATUM = 8
_STEP = "struct<level:int,left:boolean,digest:binary>"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ``group``, ``lo``, ``key``, ``leaf``, ``claim``, ``path``, ``subroot`` of every row; ``root`` is null if there is none.

    Digests are binary in ``leaves``, and take part in others as lowercase hex; ``root`` is hex.
    """

    leaves: DataFrame
    root: str | None


def hex_of(digest: Column) -> Column:
    """The lowercase hex of a digest."""
    return F.lower(F.hex(digest))


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def digest_of(values: Sequence[Column]) -> Column:
    """SHA-256 over the values' texts, each as its length in bytes, a colon and the text, or ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return _hash(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]))


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1)))


def _ranked(rows: DataFrame, group: Column, order: Sequence[str]) -> DataFrame:
    """Stored rows with their ``tree`` (the text of ``group``), rank ``lo`` in it, ``hi`` and the tree's size ``n``."""
    numbered = number_rows(rows.withColumn("tree", key_text(group)), ["tree", *order], "place")
    sizes = stage(
        numbered.groupBy("tree").agg(F.min("place").alias("first"), F.count("*").alias("n")), "merkle-sizes"
    )
    placed = join_counted(numbered, sizes, "tree", F.col("place"), "inner")
    low = F.col("place") - F.col("first")
    return stage(placed.withColumns({"lo": low, "hi": low + 1}).drop("place", "first"), "merkle-ranked")


def _parents(kids: Column) -> Column:
    """The next level over an array of nodes: two consecutive ones, or a last one alone, under each parent."""
    def parent(i: Column) -> Column:
        pair = F.transform(
            F.slice(kids, 2 * i + 1, F.lit(2)),
            lambda k: F.struct(k["lo"].alias("lo"), k["hi"].alias("hi"), k["digest"].alias("digest")),
        )
        return F.struct(
            F.element_at(pair, 1)["lo"].alias("lo"), F.element_at(pair, -1)["hi"].alias("hi"),
            _hash(F.array_join(F.transform(pair, lambda k: hex_of(k["digest"])), "")).alias("digest"),
            pair.alias("kids"),
        )
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(kids) - 1, 1)), parent)


def _stratum(base: DataFrame, start: int) -> DataFrame:
    """All nodes of the levels ``start + 1`` to ``start + STRATUM``, each with its interval and its children."""
    rows = (
        base.where(F.col("n") > (1 << start))
        .groupBy("tree", "n", F.shiftright("lo", start + STRATUM).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("level0"))
    )
    for k in range(1, STRATUM + 1):
        rows = rows.withColumn(f"level{k}", _parents(F.col(f"level{k - 1}")))
    def labelled(k: int) -> Column:
        nodes = F.transform(f"level{k}", lambda x: F.struct(
            F.lit(start + k).alias("level"), x["lo"].alias("lo"), x["hi"].alias("hi"),
            x["digest"].alias("digest"), x["kids"].alias("kids"),
        ))
        return F.when(_height(F.col("n")) >= start + k, nodes)

    listed = [labelled(k) for k in range(1, STRATUM + 1)]
    return rows.select("tree", "n", F.inline(F.flatten(F.array_compact(F.array(*listed)))))


def _steps(entries: DataFrame, nodes: DataFrame, start: int) -> DataFrame:
    """For each entry (a node of level ``start``) the siblings on its way up through one stratum, as ``path``."""
    top = F.least(F.lit(start + STRATUM), _height(F.col("n")))
    rungs = entries.where(F.col("n") > (1 << start)).select(
        "tree", "lo", "hi", F.explode(F.sequence(F.lit(start + 1), top)).alias("level")
    ).withColumn("bucket", F.expr("shiftright(lo, level)"))
    parents = nodes.select(
        "tree", "level", F.expr("shiftright(lo, level)").alias("bucket"),
        F.col("lo").alias("from_rank"), F.col("hi").alias("to_rank"), "kids",
    )
    inside = (F.col("from_rank") <= F.col("lo")) & (F.col("hi") <= F.col("to_rank"))
    rest = F.get(F.filter("kids", lambda k: (k["hi"] <= F.col("lo")) | (k["lo"] >= F.col("hi"))), F.lit(0))
    step = F.struct(
        "level", F.coalesce(rest["lo"] < F.col("lo"), F.lit(False)).alias("left"), rest["digest"].alias("digest")
    )
    return (
        rungs.join(parents, ["tree", "level", "bucket"]).where(inside)
        .groupBy("tree", "lo").agg(F.array_sort(F.collect_list(step)).alias("path"))
    )


def _climb(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(tree, lo, path)`` of every stored leaf and ``(tree, top)`` of every tree.

    A path lists one step for each level: the sibling and its side, or a null digest where a node has none.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    base = leaves.select("tree", "n", "lo", "hi", "digest")
    strata: list[tuple[int, DataFrame, DataFrame]] = []
    for start in range(0, max(largest - 1, 0).bit_length(), STRATUM):
        nodes = stage(_stratum(base, start), "merkle-nodes")
        strata.append((start, base, nodes))
        base = nodes.where(F.col("level") == start + STRATUM).select("tree", "n", "lo", "hi", "digest")
    tops = leaves.where(F.col("n") == 1).select("tree", F.col("digest").alias("top"))
    for _, _, nodes in strata:
        whole = (F.col("level") == _height(F.col("n")))
        tops = tops.union(nodes.where(whole).select("tree", F.col("digest").alias("top")))

    none = F.array().cast(f"array<{_STEP}>")
    above = None
    for start, entries, nodes in reversed(strata):
        path = _steps(entries, nodes, start)
        if above is not None:
            path = path.withColumn("block", F.shiftright("lo", start + STRATUM)).join(above, ["tree", "block"], "left")
            path = path.select("tree", "lo", F.concat("path", F.coalesce("rest", none)).alias("path"))
        above = path.select("tree", F.shiftright("lo", start).alias("block"), F.col("path").alias("rest"))
    if above is None:
        return leaves.select("tree", "lo", none.alias("path")), tops
    return above.select("tree", F.col("block").alias("lo"), F.col("rest").alias("path")), tops


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang",
    changed: Mapping[str, Column] | None = None, changed_where: Column | None = None,
) -> Manifest:
    """The leaf, the proof path and the subroot of every row, and the root over all.

    ``changed`` gives other values of some fields for the rows where ``changed_where`` holds; ``claim`` is the leaf of
    such a row with them, for ``verified``, and null for other rows.

    Only the named columns are read; others may have any name. Rows are ordered by ``key``, nulls first; rows of one
    key (or none) by their leaf, so repeated rows are leaves of their own that can change places. A null group comes
    first. An empty table gives no rows and no root. A text may be as long as Spark holds.
    """
    values = [F.col(f) for f in fields]
    claim = F.lit(None).cast("binary")
    if changed:
        other = digest_of([changed.get(f, F.col(f)) for f in fields])
        claim = F.when(changed_where if changed_where is not None else F.lit(True), other)
    rows = docs.select(
        F.col(group).alias("group"), F.col(key).alias("key"), digest_of(values).alias("digest"), claim.alias("claim")
    )
    leaves = _ranked(stage(rows, "merkle-leaves"), F.col("group"), ["key", "digest"])
    none = F.array().cast(f"array<{_STEP}>")

    paths, tops = _climb(leaves)
    subroots = stage(tops.select("tree", F.col("top").alias("digest")), "merkle-subroots")
    forest = _ranked(subroots.withColumnRenamed("tree", "name"), F.lit(None), ["name"])
    upper, roots = _climb(forest)
    top = roots.first()
    proofs = forest.join(upper, ["tree", "lo"], "left").select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.coalesce("path", none).alias("upper")
    )
    rows = leaves.join(paths, ["tree", "lo"], "left").withColumn("path", F.coalesce("path", none))
    joined = join_counted(rows, stage(proofs, "merkle-proofs"), "tree", F.col("lo"), "inner")
    return Manifest(joined.select(
        "group", "lo", "key", F.col("digest").alias("leaf"), "claim", F.concat("path", "upper").alias("path"), "subroot"
    ), bytes(top["top"]).hex() if top else None)


def proof_digest(path: Column) -> Column:
    """SHA-256 over the siblings of a path, from the leaf up."""
    named = F.filter(path, lambda s: s["digest"].isNotNull())
    return F.sha2(F.array_join(F.transform(named, lambda s: hex_of(s["digest"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root, in hex, that a leaf and the siblings of its path lead to."""
    def up(below: Column, step: Column) -> Column:
        sibling = F.coalesce(hex_of(step["digest"]), F.lit(""))
        return F.sha2(F.when(step["left"], F.concat(sibling, below)).otherwise(F.concat(below, sibling)), 256)
    return F.aggregate(path, hex_of(leaf), up)


def verified(tree: Manifest) -> DataFrame:
    """Each row's ``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    The claimed leaf, if there is one, or the leaf itself is folded with the siblings of its path.
    """
    root = F.lit(tree.root).cast("string")
    reached = folded(F.coalesce("claim", "leaf"), F.col("path"))
    return tree.leaves.select(
        "key", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"), root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        reached.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
