"""Archives written, read back, damaged and filled with lines that look like records."""

import hashlib
import random
from pathlib import Path

from pyspark.sql import functions as F

from shelfsight.llm.warc import page_records, read_warc, write_warc

SCHEMA = "page_id bigint, url string, html string"
#: A whole record in little; several in a row are whole pieces of their own.
INNER = "WARC/1.0\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def expected(rows):
    holder, copies = {}, {}
    for page, _, html in rows:
        payload = (html or "").encode()
        copies[payload] = copies.get(payload, 0) + 1
        if page is not None:
            holder[payload] = max(holder.get(payload, page), page)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        held = holder.get(payload)
        again = len(payload) >= 1000 and held is not None and (page is None or page < held)
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", held if again else None, True))
    return sorted(out, key=repr)


def round_trip(spark, rows, path, parts=3):
    write_warc(spark.createDataFrame(rows, SCHEMA).repartition(parts), str(path))
    return sorted((tuple(r) for r in page_records(read_warc(spark, str(path))).collect()), key=repr)


def pages(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        base = "x" * rng.randrange(1500)
        html = rng.choice((
            None, "", base, "é日" * rng.randrange(700), "copied " * 200, base + INNER + base, INNER * 3, INNER + "kept " * 300,
            "WARC/1.WARC/1.0\r\n" + base + "WARC/1.0\r\nContent-Length: 99999999999999999999\r\n\r\n", "\r\n\r\n", "WARC/1.0\r\n",
        ))
        rows.append((None if i % 20 == 0 else i, f"http://a/ b\r\n{i}" if i % 7 else None, html))
    return rows


def test_round_trip(spark, tmp_path):
    rows = pages(1, 150)
    rows += rows[-3:]
    assert round_trip(spark, rows, tmp_path / "whole") == expected(rows)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert round_trip(spark, rows, tmp_path / "split", 1) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_no_rows_extra_columns_and_a_long_page(spark, tmp_path):
    assert round_trip(spark, [], tmp_path / "none") == []
    rows = [(1, "u", "long " * 400_000), (2, "u", "long " * 400_000), (3, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("value", "file", "_same_", "size", "kind")})
    write_warc(df, str(tmp_path / "long"))
    found = page_records(read_warc(spark, str(tmp_path / "long")))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_files_are_what_the_format_asks_for(spark, tmp_path):
    rows = pages(2, 30)
    write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "w"))
    (file,) = Path(tmp_path / "w").glob("part-*")
    data, at, kinds = file.read_bytes(), 0, []
    while at < len(data):
        assert data.startswith(b"WARC/1.0\r\n", at)
        end = data.index(b"\r\n\r\n", at)
        fields = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(fields)
        kinds.append(fields["WARC-Type"])
        at = end + 4 + int(fields["Content-Length"])
        assert data[at:at + 4] == b"\r\n\r\n"
        at += 4
    assert kinds.count("response") + kinds.count("revisit") == len(rows)


def test_damaged_archives(spark, tmp_path):
    write_warc(spark.createDataFrame([(i, None, f"page {i}") for i in range(6)], SCHEMA).coalesce(1), str(tmp_path / "w"))
    (file,) = Path(tmp_path / "w").glob("part-*")
    data = file.read_bytes()
    for folder, content in (("cut", data[:-40]), ("shifted", b"junk" + data), ("plain", b"no record here"), ("nothing", b"")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.warc").write_bytes(content)
    cut = read_warc(spark, str(tmp_path / "cut")).orderBy("at").collect()
    assert [r["complete"] for r in cut] == [True] * 5 + [False]
    for folder in ("shifted", "plain", "nothing"):
        assert read_warc(spark, str(tmp_path / folder)).count() == 0
