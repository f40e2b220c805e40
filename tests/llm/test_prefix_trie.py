"""The prefix trie against one built turn by turn."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from shelfsight.llm import prefix_trie as trie
from tests.llm.helpers import sha

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_force(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns, key=lambda x: x[0])] for c, turns in own.items()}
    built = {}
    for c in own:
        lead = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:lead] + own[c][lead:]
    members, children, leaves, saved = {}, {}, {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[k] for k in below) or 1
        saved[path] = sum(saved[k] for k in below)
        if path:
            saved[path] += (len(members[path]) - 1) * len(path[-1][1].encode())
    return sorted((
        (
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children.get(path, [])),
            leaves[path], saved[path], sha(",".join(str(c) for c in sorted(convs) if len(built[c]) == len(path))),
        ) for path, convs in members.items()
    ), key=repr)


def nodes(df):
    conv = F.col("conv_id")
    turns = trie.ordered_turns(df)
    found = trie.prefix_trie(*trie.rebuilt(turns, conv - conv % 5, F.crc32(conv.cast("string")) % 9, 8))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def conversations(seed, convs, longest, words):
    """Conversations that repeat each other's turns often, so that they part at every depth."""
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(("user", None)) if t % 3 == 0 else "assistant", f"turn {t} {'é' * rng.randrange(words)}" if t % 4 else None)
        for c in range(convs) if c % 11 for t in range(rng.randrange(1, longest))
    ]


@pytest.mark.parametrize(("seed", "convs", "longest", "words"), [(1, 80, 12, 2), (2, 60, 30, 1), (3, 40, 6, 3)])
def test_equals_brute_force(spark, seed, convs, longest, words):
    rows = conversations(seed, convs, longest, words)
    random.Random(seed).shuffle(rows)
    assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows)


def test_long_conversations_are_chained_in_rows_of_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHAIN", 4)
    rows = conversations(4, 25, 9, 2)
    for c, length in ((50, 300), (51, 300), (52, 256), (53, 257), (54, 16)):
        rows += [(c, t, "user", f"long {t}" if t != 200 or c != 51 else "other") for t in range(length)]
    assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows)


def test_many_equal_conversations(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(1500) for t in range(3)]
    found = nodes(spark.createDataFrame(rows, SCHEMA))
    assert found == brute_force(rows)


def test_null_turns_extra_columns_and_empty_tables(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (2, 5, "user", "a" * 100_000), (None, 0, "user", "lost"), (-7, 1, "user", "b"), (10, 0, "u", "x")]
    own = ("pos", "digest", "bytes", "place", "first", "node", "depth", "n", "id", "parent", "length", "lead")
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in own})
    # Python's remainder of a negative number differs, so the whole is built by hand and the others by brute force.
    assert [r[:5] for r in nodes(df)] == [(-7, 0, None, 4, 1), (10, 1, -7, 1, 0)]
    positive = [r for r in rows if r[0] is None or r[0] >= 0]
    assert nodes(spark.createDataFrame(positive, SCHEMA)) == brute_force(positive)
    assert nodes(spark.createDataFrame([], SCHEMA)) == []


def test_ties_in_turn_have_one_order(spark):
    rows = [(5, 1, "user", "a"), (5, 1, "user", "b"), (5, 1, "user", "b"), (6, 1, "user", "a")]
    one = nodes(spark.createDataFrame(rows, SCHEMA))
    assert one == nodes(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3))
