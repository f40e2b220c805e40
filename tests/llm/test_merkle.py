"""The Merkle manifest against a plain construction of all trees."""

import zlib

from pyspark.sql import functions as F

from shelfsight.llm import merkle
from tests.llm.helpers import empty, hostile, sha

FIELDS = merkle.FIELDS


def _leaf(row):
    return sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def _tree(digests):
    """The top, and for each leaf its steps up: lists of (is left, digest)."""
    paths, owners = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, grown = [], []
        for at in range(0, len(digests), 2):
            run = digests[at:at + 2]
            for k in range(len(run)):
                for i in owners[at + k]:
                    paths[i].append([(o < k, run[o]) for o in range(len(run)) if o != k])
            above.append(sha("".join(run)))
            grown.append(sum(owners[at:at + 2], []))
        digests, owners = above, grown
    return digests[0], paths


def brute_force(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    trees = []
    for lang in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        listed = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
        trees.append((listed, *_tree([_leaf(r) for r in listed])))
    root, upper = _tree([t[1] for t in trees])
    out = []
    for (listed, subroot, paths), above in zip(trees, upper, strict=True):
        for row, path in zip(listed, paths, strict=True):
            steps, claim, leaf = path + above, dict(row), _leaf(row)
            if row["doc_id"] is not None and row["n_chars"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0:
                claim["n_chars"] += 1
            at = _leaf(claim)
            for step in steps:
                at = sha("".join([d for left, d in step if left] + [at] + [d for left, d in step if not left]))
            proof = sha("".join(d for step in steps for _, d in step))
            out.append((row["doc_id"], leaf, subroot, root, proof, at, at == root))
    return sorted(out, key=repr)


def proofs(docs):
    tree = merkle.manifest(
        docs, changed={"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1},
        changed_where=F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
    )
    return merkle.verified(tree)


def check(docs):
    got = sorted((tuple(r) for r in proofs(docs).collect()), key=repr)
    want = brute_force([r.asDict() for r in docs.select(*FIELDS).collect()])
    assert got == want
    return want


def test_trees_of_all_sizes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STRATUM", 2)
    rows = [
        (i, f"text {i}", f"lang{size:02d}" if size else None, None if i % 5 else "web", i if i % 3 else None)
        for size in range(35) for i in range(100 * size, 100 * size + max(size, 1))
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = check(docs.repartition(5))
    assert {r[-1] for r in want} == {True, False}


def test_more_than_one_stratum(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text é "), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") > 5, "en").when(F.col("id") > 2, "de").alias("lang"), F.lit("web").alias("source"),
        F.when(F.col("id") > 9, F.lit(9223372036854775807)).alias("n_chars"),
    )
    check(docs)


def test_hostile_rows(spark):
    check(hostile(spark).withColumn("n_chars", F.length("text").cast("long")))
    own = ("tree", "lo", "hi", "n", "key", "leaf", "path", "root", "place", "first", "level", "digest", "group")
    clash = hostile(spark).withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit("x") for c in own})
    check(clash)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "t", "en", "a", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    (row,) = check(one)
    assert row[1] == row[2] == row[3] and row[4] == sha("")
    tree = merkle.manifest(empty(spark).withColumn("n_chars", F.lit(1)))
    assert tree.root is None and tree.leaves.count() == 0 and merkle.verified(tree).count() == 0
