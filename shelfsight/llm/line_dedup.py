"""Line dedup by the spread over distinct sites.

A line that occurs on many sites is boilerplate and goes wherever it stands. Each site of a line enters a
HyperLogLog sketch, and the sketches of a line are merged by aggregation, in the map tasks first. Where the
estimate is too near to the threshold to be sure, the distinct sites of the line are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.common import SPACES, stage_rows
from shelfsight.staging import stage

#: Sites from which on a line is boilerplate.
SITES = 10
#: Sketches have 2**12 registers: a relative error of 1.6 %; five times that is "near".
_LOG_REGISTERS, _BAND = 12, 0.08


def text_lines(text: str) -> Column:
    """The lines of a text; null and empty texts have none."""
    return F.when(F.length(text) > 0, F.split(F.col(text), "\n")).otherwise(F.array().cast("array<string>"))


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def line_places(rows: DataFrame, text: str, site: str) -> DataFrame:
    """Stored ``_row, place, line, again, site``, one row for each line that is not blank; 128 bits name a line."""
    exploded = rows.select("_row", F.col(site).cast("string").alias("site"), F.posexplode(text_lines(text)).alias("place", "line"))
    bare = exploded.withColumn("line", _bare(F.col("line"))).where(F.col("line") != "")
    return stage(
        bare.select("_row", "place", F.xxhash64("line").alias("line"), F.xxhash64(F.lit(1), "line").alias("again"), "site"), "lines"
    )


def asked_lines(lines: DataFrame) -> DataFrame:
    """Stored ``_run, line, again`` with the rows and extremes of the site: each line once for each input partition.

    Whatever is asked about a line is asked by these rows, so a line in a third of all rows is not dealt to one task.
    """
    dealt = lines.withColumn("_run", F.shiftright("_row", 33))
    return stage(dealt.groupBy("_run", "line", "again").agg(
        F.count("site").alias("n"), F.min("site").alias("low"), F.max("site").alias("high")
    ), "asked-lines")


def boilerplate(lines: DataFrame, asked: DataFrame, sites: int = SITES) -> DataFrame:
    """Stored ``line, again`` of the lines on at least ``sites`` distinct sites.

    Lines of fewer occurrences than that, or all on one site, need no sketch.
    """
    name = ["line", "again"]
    often = asked.groupBy(*name).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    often = stage(often.where((F.col("n") >= sites) & ((F.col("low") != F.col("high")) | (sites <= 1))).select(*name), "frequent-lines")
    known = lines.where(F.col("site").isNotNull()).withColumn("_run", F.shiftright("_row", 33))

    def those(named: DataFrame) -> DataFrame:
        """The rows of some lines, found by input partition, so that the aggregation has a shuffle of its own."""
        return known.join(asked.select("_run", *name).join(named, name, "left_semi"), ["_run", *name], "left_semi")

    sketched = those(often).groupBy(*name).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(_LOG_REGISTERS))).alias("spread"))
    sketched = stage(sketched, "line-spread")
    near = F.abs(F.col("spread") - sites) <= F.ceil(F.lit(sites * _BAND))
    exact = those(sketched.where(near).select(*name)).groupBy(*name, "site").agg(F.lit(1).alias("one"))
    counted = exact.groupBy(*name).agg(F.count("one").alias("spread"))
    sure = sketched.where(~near).select(*name, "spread").unionByName(counted)
    return stage(sure.where(F.col("spread") >= sites).select(*name), "boilerplate")


def line_dedup(df: DataFrame, text: str = "text", site: str = "source", sites: int = SITES) -> DataFrame:
    """Replace ``text`` by its lines that are no boilerplate and add ``n_lines, n_removed``.

    Lines are cut at line feeds and compared without white space at their ends; blank lines always stay. A line
    counts once for each distinct site, null sites not at all, but it goes from every row. Null and empty texts
    stay as they are, with 0 lines. Repeated rows are treated alike. An empty table gives no rows; input columns
    called like a result column are replaced, names that begin with an underscore are reserved.
    """
    rows = stage_rows(df, "line-rows")
    lines = line_places(rows, text, site)
    asked = asked_lines(lines)
    found = boilerplate(lines, asked, sites)
    answered = asked.select("_run", "line", "again").join(found, ["line", "again"])
    dealt = lines.withColumn("_run", F.shiftright("_row", 33))
    gone = dealt.join(answered, ["_run", "line", "again"]).groupBy("_row").agg(F.collect_list("place").alias("_places"))
    joined = rows.join(gone, "_row", "left")
    all_lines = text_lines(text)
    every = F.when(F.size(all_lines) > 0, F.sequence(F.lit(0), F.size(all_lines) - 1)).otherwise(F.array().cast("array<int>"))
    stays = F.transform(F.array_except(every, F.col("_places")), lambda i: F.get("_all", i))
    return (
        joined.withColumn("_all", all_lines)
        .withColumns({
            "n_lines": F.size("_all").cast("long"),
            "n_removed": F.coalesce(F.size("_places"), F.lit(0)).cast("long"),
            text: F.when(F.col("_places").isNull(), F.col(text)).otherwise(F.array_join(stays, "\n")),
        })
        .drop("_row", "_all", "_places")
    )
