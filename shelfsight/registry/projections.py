"""Product, review and response tables projected from the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(1998, 6, 1, 12)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def review_order() -> list[Column]:
    """Newest first; the other columns tell apart the rows of one day, at every scale."""
    ties = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return [F.desc("scraped_at"), *[F.col(c) for c in ties]]


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per part, with prices, rating and review count as text as in a feed."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "concat('P', lpad(cast(p_partkey as string), 9, '0')) as asin",
        "p_name as title",
        "p_brand as brand",
        "case when p_partkey % 41 != 0 then"
        " concat('https://example.com/dp/P', lpad(cast(p_partkey as string), 9, '0')) end as url",
        "case when p_partkey % 97 = 0 then '0'"
        " else cast((p_retailprice - 899) * p_size / 10 as string) end as initial_price",
        "case when p_partkey % 10 = 3 then null when p_partkey % 10 = 7 then 'N/A'"
        " else cast((p_retailprice - 899) * p_size / 10 * (1 - (p_size % 5) * 0.1D) as string)"
        " end as final_price",
        "case when p_partkey % 53 = 0 then 'n/a'"
        " else cast((p_partkey % 51) / 10.0D as string) end as rating",
        "case when p_partkey % 29 != 0 then cast((p_partkey * 37) % 7000 as string) end as reviews_count",
        "case p_partkey % 4 when 0 then 'In Stock' when 1 then 'in stock soon'"
        " when 2 then 'Out of Stock' end as availability",
        "case when p_partkey % 11 = 0 then cast(array() as array<string>)"
        " else array(p_type, split(p_name, ' ')[1]) end as categories",
        "named_struct('keyword', split(p_name, ' ')[1]) as discovery_input",
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per line item, with list columns as text in several notations."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "concat('P', lpad(cast(l_partkey as string), 9, '0')) as asin",
        "concat('https://example.com/dp/P', lpad(cast(l_partkey as string), 9, '0')) as url",
        "case when l_linenumber != 7 then 1 + floor((l_quantity - 1) / 10) end as rating",
        "l_shipdate as date",
        "l_returnflag = 'N' as verified_purchase",
        "case l_linenumber when 7 then null when 6 then 'not json' when 5 then '[]'"
        " when 4 then concat('[', chr(39), lower(l_returnflag), chr(39), ', ', chr(39), lower(l_linestatus), chr(39), ']')"
        " else concat('[\"', lower(l_returnflag), '\",\"', lower(l_linestatus), '\"]') end as themes",
        "case l_linenumber when 7 then null when 6 then 'not json' when 5 then '[]'"
        " when 4 then concat('[', chr(39), 'size ', cast(l_suppkey % 17 as string), chr(39), ']')"
        " else concat('[\"flag ', lower(l_returnflag), '\",\"size ', cast(l_suppkey % 17 as string), '\"]') end as issues",
        "case l_linenumber when 7 then null when 6 then ''"
        " else concat(l_returnflag, l_linestatus, ' line ', cast(l_linenumber as string)) end as ai_summary",
        "cast(l_shipdate as timestamp) as scraped_at",
    )


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per document, rated by its labels where it has any."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rating = F.when(F.col("toxic") == 1, 1.0).when(F.col("quality") == 0, 2.0).when(F.col("quality") == 1, 5.0)
    return documents.join(labels, "doc_id", "left").select(
        "doc_id", F.col("source").alias("asin"), F.col("text").alias("review_text"), rating.alias("rating")
    )


def responses(batched: DataFrame) -> DataFrame:
    """An answer text for every batch, with missing, out-of-range and repeated indexes.

    Some batches answer in reverse order, some in a code fence, some with no usable text.
    """
    index = (
        F.when(F.col("doc_id") % 7 == 1, F.lit(99))
        .when(F.col("doc_id") % 7 == 2, F.lit(1))
        .otherwise(F.col("pos") + 1)
    )
    word = F.element_at(
        F.array(F.lit("Positive"), F.lit("Neutral"), F.lit("Negative")), (F.col("doc_id") % 3 + 1).cast("int")
    )
    answer = F.to_json(F.struct(
        index.alias("index"), word.alias("sentiment"),
        F.array(F.concat(F.lit("issue "), (F.col("doc_id") % 5).cast("string"))).alias("issues"),
        F.array(F.concat(F.lit("theme "), (F.col("doc_id") % 4).cast("string"))).alias("themes"),
        F.concat(F.lit("about "), F.col("doc_id").cast("string")).alias("summary"),
    ))
    place = F.when(F.col("batch_id") % 2 == 1, -F.col("pos")).otherwise(F.col("pos"))
    listed = F.array_sort(F.collect_list(F.struct(place.alias("place"), answer.alias("answer"))))
    body = F.concat(F.lit("["), F.array_join(F.transform("_answers", lambda a: a["answer"]), ","), F.lit("]"))
    text = (
        F.when(F.col("batch_id") % 9 == 0, "")
        .when(F.col("batch_id") % 9 == 2, "not json")
        .when(F.col("batch_id") % 9 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```\nDone.")))
        .otherwise(body)
    )
    return (
        batched.where(F.col("doc_id") % 7 != 0)
        .groupBy("batch_id").agg(listed.alias("_answers"))
        .select("batch_id", text.alias("response"))
    )
