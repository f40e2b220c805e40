"""The parallel scan of JSON arrays against a parser that reads them whole."""

import json
import random

import pytest

from shelfsight.sources import json_scan as J
from shelfsight.sources import snapshot as S


@pytest.fixture
def small_splits(spark):
    """Files of a few kilobytes have tens of splits."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "97")
    spark.conf.set(names[1], "0")
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def value(rng, depth=0):
    """Something with brackets, quotes and backslashes wherever JSON lets them be."""
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind < 3:
        return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "é", "日", "\n", " ", "a", '\\"', "}}", "\\\\"]) for _ in range(rng.randrange(25)))
    if kind == 3:
        return rng.choice([None, True, -1.5, 10 ** 12])
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {value_key(rng): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def value_key(rng):
    return rng.choice(["a", "b{", "c}", 'd"', "e\\", "f]", ""])


def records(path, spark):
    return [json.loads(r["raw"]) for r in S.scan_snapshot(spark, str(path), "array").orderBy("file", "seq").collect()]


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_parser(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    expected = []
    for name in ("a", "b", "c"):
        data = [value(rng) if rng.random() < 0.3 else {"k": value(rng), "n": i} for i in range(rng.randrange(60))]
        text = json.dumps(data, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"{name}.json").write_text(rng.choice(["", "\n ", "﻿"]) + text + rng.choice(["", "\n", "  "]))
        expected += [x for x in data if isinstance(x, dict)]
    assert records(tmp_path, spark) == expected


def test_records_over_many_splits(spark, tmp_path, small_splits):
    data = [{"long": "x}{\\\"" * 500, "list": [{"deep": i}] * 40} for i in range(5)]
    (tmp_path / "a.json").write_text(json.dumps(data))
    assert records(tmp_path, spark) == data
    parts = J._pieces(spark, str(tmp_path)).rdd.getNumPartitions()
    assert parts > 50


def test_objects_without_an_array_and_broken_ends(spark, tmp_path, small_splits):
    data = [{"a": {"b": [1, {"c": "}"}]}, "n": i} for i in range(30)]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, data)))
    (tmp_path / "b.json").write_text(json.dumps(data)[:-200])
    whole = json.dumps(data)[:-200].count('"n"')
    found = records(tmp_path, spark)
    assert found[:30] == data and found[30:] == data[:len(found) - 30] and whole - 1 <= len(found) - 30 <= whole
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text("[]")
    (tmp_path / "e.json").write_text('[1, "x}", [{"no": 1}], {"bad": }, {"good": 1}, {"open": "')
    assert records(tmp_path, spark)[len(found):] == [{"good": 1}]


def test_the_same_as_whole_documents(spark, tmp_path):
    data = [{"asin": f"a{i}", "title": 'say "hi" \\ {' * 20, "tags": ["]", "}"]} for i in range(500)]
    (tmp_path / "a.json").write_text(json.dumps(data, indent=2))
    both = [
        [r["raw"] for r in S.scan_snapshot(spark, str(tmp_path), layout).orderBy("seq", "pos").collect()]
        for layout in ("document", "array")
    ]
    assert both[0] == both[1] and len(both[0]) == 500


@pytest.mark.parametrize("text", [b'a"b\\"c{', b'\\', b'"', b'{"a":"\\\\', b'x"y"z["', b""])
@pytest.mark.parametrize("cut", range(8))
def test_states_compose(text, cut):
    """Passing a text at once or in two parts is the same, from every state."""
    for state in (J.OUTSIDE, J.INSIDE, J.ESCAPED):
        middle, one = J._passed(text[:cut], state)
        end, two = J._passed(text[cut:], middle)
        assert (end, one + two) == J._passed(text, state)
