"""Post-shaped views of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMUNITIES = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_posts(events: DataFrame) -> DataFrame:
    """Each event as a post: about 4 rows per id and 11 per title, `event_id` being the arrival order."""
    return events.selectExpr(
        "event_id",
        "CAST(event_id DIV 4 AS STRING) AS id",
        "event_type AS subreddit",
        "CONCAT('Post ', CAST(event_id DIV 11 AS STRING)) AS title",
        "CAST(user_id AS STRING) AS author",
        "CAST(FLOOR(value) AS INT) AS score",
        "CAST(from_json(props, 'k int').k AS INT) AS num_comments",
        "ts AS created_utc",
        "CONCAT('https://', event_type, '.example.org/', CAST(event_id AS STRING)) AS url",
        "props AS selftext",
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return event_posts(table(spark, folder, "events"))


def epoch_posts(events: DataFrame) -> DataFrame:
    """Posts as the API delivers them: whole epoch seconds, some fields unset, some columns absent."""
    rows = event_posts(events).withColumn("created_utc", F.unix_seconds(F.col("created_utc").cast("timestamp")))
    return rows.withColumns(
        {
            "created_utc": F.col("created_utc").cast("double"),
            "created": F.col("created_utc").cast("double"),
            "approved_at_utc": F.lit(None).cast("double"),
        }
    )


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    return epoch_posts(table(spark, folder, "events"))


def document_rows(documents: DataFrame) -> DataFrame:
    """Each document as a post whose title is the whole text."""
    return documents.selectExpr(
        "doc_id AS event_id",
        "CAST(doc_id AS STRING) AS id",
        "lang AS subreddit",
        "text AS title",
        "source AS author",
        "CAST(n_chars AS INT) AS score",
    )


def document_posts(spark: SparkSession, folder: str) -> DataFrame:
    return document_rows(table(spark, folder, "documents"))


def page_posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").selectExpr("CAST(page_id AS STRING) AS id", "url", "html AS selftext")


def conversation_posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").selectExpr(
        "CONCAT(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS id", "role AS author", "text AS title"
    )


def community_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Four tables with different columns, the way separately collected communities differ."""
    return {
        "events": posts(spark, folder).drop("event_id", "subreddit"),
        "documents": document_posts(spark, folder).drop("event_id", "subreddit"),
        "pages": page_posts(spark, folder),
        "conversations": conversation_posts(spark, folder),
    }


def payload(rows: DataFrame, *kept: str) -> DataFrame:
    """Each raw post as a JSON message with nested, unknown and dropped fields."""
    fields = F.struct(
        "id",
        "subreddit",
        "title",
        "author",
        "score",
        "num_comments",
        "created_utc",
        "url",
        "selftext",
        F.struct(F.col("num_comments").alias("k"), F.array("subreddit").alias("tags")).alias("media"),
        F.struct(F.lit(True).alias("enabled")).alias("preview"),
        F.lit(1).alias("unlisted_field"),
    )
    return rows.select(*kept, F.to_json(fields).alias("value"))


def post_messages(spark: SparkSession, folder: str) -> DataFrame:
    return payload(raw_posts(spark, folder), "event_id")


def mixed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Post messages among texts that are not JSON."""
    texts = table(spark, folder, "documents").select(F.col("text").alias("value"))
    return post_messages(spark, folder).select("value").unionAll(texts)


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Listing documents with one post each; those of error events have no children."""
    rows = payload(raw_posts(spark, folder), "event_id", "subreddit")
    return rows.select(
        F.when(F.col("subreddit") == "error", F.lit('{"data":{"after":null,"children":[]}}'))
        .otherwise(
            F.concat(
                F.lit('{"data":{"after":"t3_'),
                F.col("event_id").cast("string"),
                F.lit('","children":[{"data":'),
                F.col("value"),
                F.lit("}]}}"),
            )
        )
        .alias("value")
    )


def streamed_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a file stream, be it one file or a folder of files.

    The path is a pattern, since a stream takes a plain path to be a folder, and a filter by name would look at the files inside.
    """
    return spark.readStream.schema(table(spark, folder, name).schema).parquet(f"{folder}/{{{name}.parquet}}")


def streamed_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a file stream."""
    return streamed_table(spark, folder, "events")
