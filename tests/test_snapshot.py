import json

import pytest
from pyspark.sql import types as T

from shelfsight.schema import RAW_PRODUCT
from shelfsight.sources import snapshot as S

A, B, ERR = {"asin": "A", "rating": 4.5}, {"asin": "B", "categories": ["x"]}, {"error": None, "asin": "E"}


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.json").write_text(text)
    return str(folder)


def raws(df):
    return [json.loads(r["raw"]) for r in df.orderBy("file", "seq", "pos").collect()]


def test_documents_and_lines_mixed(spark, tmp_path):
    path = write(
        tmp_path / "s",
        a=json.dumps([A, ERR], indent=2),
        b="\n".join([json.dumps(A), "not json", "", "   ", json.dumps(B) + ",", json.dumps(B)]),
        c=json.dumps(B),
        d="\n" + json.dumps([A]) + "\n",
        e="[]",
        f="[" + json.dumps(A),
    )
    records = S.scan_snapshot(spark, path)
    assert raws(records) == [A, ERR, A, B, B, A]
    assert raws(S.split_errors(records)) == [A, A, B, B, A]
    assert tuple(S.error_counts(records).first()) == (6, 5, 1)


def test_both_layouts_give_the_same_records_of_lines(spark, tmp_path):
    lines = [json.dumps({"asin": str(i)}) for i in range(2000)]
    lines[10], lines[20], lines[30] = "bad", json.dumps([A, B]), "[bad"
    path = write(tmp_path / "l", big="\n".join(lines))
    whole, split = (raws(S.scan_snapshot(spark, path, layout)) for layout in S.LAYOUTS)
    assert whole == split and len(whole) == 2000 - 3 + 2
    with pytest.raises(ValueError, match="layout"):
        S.scan_snapshot(spark, path, "guess")


@pytest.mark.parametrize("filler", [1, 40_000])
def test_the_size_of_a_file_does_not_matter(spark, tmp_path, filler):
    records = [{"asin": f"a{i}", "title": "x" * filler} for i in range(20)]
    path = write(
        tmp_path / "s", a=json.dumps(records, indent=1), b=json.dumps(records[0], indent=1),
        c="\n".join([*map(json.dumps, records), "[bad", ""]), d="[" + ",\n".join(map(json.dumps, records)) + "]",
    )
    assert raws(S.scan_snapshot(spark, path)) == [*records, records[0], *records, *records]


def test_an_error_value_is_not_an_error_key(spark, tmp_path):
    rows = [{"title": "error"}, {"a": {"error": 1}}, {"error": 1}, {"a": "\"error\": x"}]
    path = write(tmp_path / "v", a="\n".join(map(json.dumps, rows)) + '\n{"\\u0065rror": 1}')
    assert raws(S.split_errors(S.scan_snapshot(spark, path))) == [rows[0], rows[1], rows[3]]


def test_columns(spark, tmp_path):
    record = {**A, "initial_price": 19.99, "final_price": "16.99", "discovery_input": {"keyword": "k"}, "new_field": 7}
    path = write(tmp_path / "c", a=json.dumps([record, B]))
    records = S.scan_snapshot(spark, path)
    df = S.to_columns(records, RAW_PRODUCT, extra=True)
    assert S.record_fields(records) == sorted({*record, *B})
    first, second = df.orderBy("pos").collect()
    assert (first["initial_price"], first["final_price"], first["rating"]) == ("19.99", "16.99", "4.5")
    assert first["discovery_input"]["keyword"] == "k" and first["new_field"] == "7"
    assert second["categories"] == ["x"] and second["new_field"] is None
    narrow = S.to_columns(records, T.StructType([T.StructField("asin", T.StringType())]))
    assert narrow.columns == ["file", "seq", "pos", "asin"]


def test_empty_folder_listing_is_empty(spark, tmp_path):
    path = write(tmp_path / "z", a="")
    assert S.scan_snapshot(spark, path).count() == 0
