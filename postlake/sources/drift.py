"""Schema drift: fields of messages that no schema knows, and known fields that change their type.

Messages become VARIANT values, whose top-level fields are listed with the type of each value. Counts per field and type are
aggregated before the shuffle, so a field that every message has costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType, StructType

from postlake.schema import POST_SCHEMA

NESTED = ("OBJECT", "ARRAY")


def kind_of(kind: DataType) -> str:
    """The class of JSON values that a declared type takes."""
    if isinstance(kind, BooleanType):
        return "boolean"
    if isinstance(kind, NumericType):
        return "number"
    return "text" if isinstance(kind, StringType) else "nested"


def field_types(messages: DataFrame, batch: str | None = None, value: str = "value") -> DataFrame:
    """field, type, messages and first_batch for every top-level field and type of value; nulls and broken messages add none.

    `batch` names a column that orders batches; without it first_batch is null.
    """
    number = F.col(batch).cast("long") if batch else F.lit(None).cast("long")
    parsed = messages.select(number.alias("batch"), F.try_parse_json(F.col(value)).alias("message")).filter("message IS NOT NULL")
    fields = parsed.lateralJoin(messages.sparkSession.tvf.variant_explode(F.col("message").outer()))
    named = fields.filter("key IS NOT NULL").select("batch", F.col("key").alias("field"), F.schema_of_variant("value").alias("type"))
    return (
        named.filter("type <> 'VOID'")
        .withColumn("type", F.regexp_extract("type", "^[A-Z]+", 0))
        .groupBy("field", "type")
        .agg(F.count(F.lit(1)).alias("messages"), F.min("batch").alias("first_batch"))
    )


def value_kind(type_name: str):
    name = F.col(type_name)
    return (
        F.when(name.isin("BIGINT", "INT", "DOUBLE", "DECIMAL"), "number")
        .when(name == "BOOLEAN", "boolean")
        .when(name.isin(*NESTED), "nested")
        .otherwise("text")
    )


def drift(
    messages: DataFrame, schema: StructType = POST_SCHEMA, batch: str | None = None, value: str = "value"
) -> DataFrame:
    """What the messages hold beyond `schema`: status is `new field` or `new type`.

    A declared text field takes every kind of value, since it is kept as text.
    """
    known = messages.sparkSession.createDataFrame(
        [(field.name, kind_of(field.dataType)) for field in schema], "field string, kind string"
    )  # one row per declared field
    found = field_types(messages, batch, value).join(F.broadcast(known), "field", "left")
    status = F.when(F.col("kind").isNull(), "new field").when((F.col("kind") != "text") & (F.col("kind") != value_kind("type")), "new type")
    return found.withColumn("status", status).filter("status IS NOT NULL").select("field", "type", "status", "messages", "first_batch")
