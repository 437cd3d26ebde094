"""JSON messages to typed posts. All functions work on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from postlake.schema import NESTED_KEYS, POST_SCHEMA, payload_fields

CORRUPT = "_corrupt_record"
ID_ONLY = StructType().add("id", StringType())

# Fixed value: the part of a listing document that is read; each post stays JSON text.
LISTING = "data struct<after string, children array<struct<data string>>>"


def parse_messages(messages: DataFrame, schema: StructType = POST_SCHEMA, value: str = "value") -> DataFrame:
    """Parse `value` (text or bytes) against the schema and keep the text of anything that did not fit.

    Missing fields are null, unknown fields are dropped, nested values in a text field stay JSON text.
    Other columns of the message, such as topic or arrival, are kept. The fields come out of a generator, so
    that a later filter on one of them does not make Spark parse the text a second time.
    """
    checked = StructType([*schema.fields]).add(CORRUPT, StringType())
    payload = F.from_json(F.col(value).cast("string"), checked, {"columnNameOfCorruptRecord": CORRUPT})
    kept = [F.col(name) for name in messages.columns if name != value and name not in checked.names]
    return messages.select(*kept, F.col(value).cast("string").alias("_message"), F.inline(F.array(payload)))


def good_posts(parsed: DataFrame) -> DataFrame:
    """Posts with an id, `is_partial` marking those where some field did not fit its type."""
    return (
        parsed.filter(F.col("id").isNotNull())
        .withColumn("is_partial", F.col(CORRUPT).isNotNull())
        .drop(CORRUPT, "_message")
    )


def quarantined(parsed: DataFrame) -> DataFrame:
    """Messages without an id: not JSON, not an object, empty, null, or a post that lacks the field."""
    return parsed.filter(F.col("id").isNull()).select(F.col("_message").alias("message"))


def malformed(messages: DataFrame, value: str = "value") -> DataFrame:
    """What `quarantined` returns, read from the messages by looking for the id only."""
    return quarantined(parse_messages(messages, ID_ONLY, value))


def parse_posts(messages: DataFrame, schema: StructType = POST_SCHEMA, value: str = "value") -> DataFrame:
    """Typed posts only, malformed messages left out."""
    return good_posts(parse_messages(messages, schema, value)).drop("is_partial")


def parse_fields(messages: DataFrame, *names: str) -> DataFrame:
    """Typed posts with some of the payload's fields; the others are not parsed. Other columns are kept."""
    extra = [name for name in messages.columns if name != "value"]
    return parse_posts(messages, payload_fields(*dict.fromkeys(["id", *names]))).select(*extra, *names)


def drop_nested_keys(value: Column) -> Column:
    """The payload's top-level fields as a text map without the nested ones."""
    fields = F.from_json(value.cast("string"), "map<string,string>")
    return F.map_filter(fields, lambda key, _: ~key.isin(*NESTED_KEYS))


def unwrap_listing(documents: DataFrame, value: str = "value") -> DataFrame:
    """First post and cursor of each listing document; listings without children are dropped."""
    listing = documents.select(F.from_json(F.col(value).cast("string"), LISTING).alias("listing"))
    first = F.explode(F.slice("listing.data.children", 1, 1)).alias("child")
    return listing.select(F.col("listing.data.after").alias("after"), first).select(
        F.col("child.data").alias("value"), "after"
    )


def edited_flag(edited: Column) -> Column:
    """`edited` as a flag: false when unset or false, true for `true` and for an edit epoch."""
    return F.coalesce(F.lower(edited) != "false", F.lit(False))
