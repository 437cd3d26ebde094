import datetime as dt

from pyspark.sql import functions as F

from postlake.schema import NESTED_KEYS, POST_SCHEMA
from postlake.sources import messages


def parsed(spark, *texts):
    rows = [(text,) for text in texts]
    return messages.parse_messages(spark.createDataFrame(rows, "value string"))


def test_schema_has_every_declared_field():
    kinds = [field.dataType.simpleString() for field in POST_SCHEMA]
    assert len(POST_SCHEMA) == len(set(POST_SCHEMA.names)) == 99
    assert (kinds.count("int"), kinds.count("double")) == (15, 5)
    assert kinds.count("string") == 49 and kinds.count("boolean") == 30  # `edited` is text here


def test_good_payload(spark):
    text = '{"id":"a","score":5,"media":{"a": 1, "b":[1,2]},"created_utc":1700000001.0,"zz":1}'
    post = messages.good_posts(parsed(spark, text))
    row = post.select("*", F.timestamp_seconds("created_utc").cast("timestamp_ntz").alias("created_at")).first()
    assert row.media == '{"a":1,"b":[1,2]}'
    assert row.created_at == dt.datetime(2023, 11, 14, 22, 13, 21)
    assert "zz" not in post.columns and not row.is_partial and row.title is None
    assert post.columns == [*POST_SCHEMA.names, "is_partial"]


def test_bytes_are_parsed(spark):
    raw = spark.createDataFrame([(bytearray(b'{"id":"a","title":"t"}'),)], "value binary")
    assert messages.parse_posts(raw).select("id", "title").collect() == [("a", "t")]


def test_edited_may_be_a_number(spark):
    texts = ['{"id":"a","edited":1699999999.0}', '{"id":"b","edited":false}', '{"id":"c","edited":true}', '{"id":"d"}']
    posts = messages.parse_posts(parsed(spark, *texts).select(F.col("_message").alias("value")))
    flags = {row.id: row.flag for row in posts.select("id", messages.edited_flag(F.col("edited")).alias("flag")).collect()}
    assert flags == {"a": True, "b": False, "c": True, "d": False}


def test_malformed_messages_are_quarantined(spark):
    bad = ["not json", "[1,2]", '[{"id":"b"}]', '{"id":"c"', "", None, "{}"]
    frame = parsed(spark, '{"id":"a"}', *bad)
    assert sorted(messages.quarantined(frame).collect(), key=str) == sorted([(text,) for text in bad], key=str)
    assert messages.good_posts(frame).count() == 1
    again = messages.malformed(frame.select(F.col("_message").alias("value")))
    assert sorted(again.collect(), key=str) == sorted([(text,) for text in bad], key=str)


def test_wrong_field_type_keeps_the_row(spark):
    rows = messages.good_posts(parsed(spark, '{"id":"b","score":"x","title":"t"}', '{"id":"c","score":5.0}')).collect()
    assert [(r.id, r.score, r.title, r.is_partial) for r in rows] == [("b", None, "t", True), ("c", None, None, True)]


def test_other_message_columns_are_kept(spark):
    raw = spark.createDataFrame([('{"id":"a"}', "reddit_news", 7)], "value string, topic string, offset long")
    row = messages.parse_posts(raw).first()
    assert (row.topic, row.offset, row.id) == ("reddit_news", 7, "a")


def test_nested_keys_are_dropped(spark):
    text = '{"id":"a","preview":{"x":1},"mod_reports":[],"title":"t"}'
    frame = spark.createDataFrame([(text,)], "value string")
    assert frame.select(messages.drop_nested_keys(F.col("value"))).first()[0] == {"id": "a", "title": "t"}
    assert len(NESTED_KEYS) == 11


def test_listings(spark):
    texts = [
        '{"data":{"after":"t3_z","children":[{"data":{"id":"a","score":3}},{"data":{"id":"b"}}]}}',
        '{"data":{"after":null,"children":[]}}',
        '{"data":{}}',
        "{}",
        "nothing",
    ]
    rows = messages.unwrap_listing(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert [(r.value, r.after) for r in rows] == [('{"id":"a","score":3}', "t3_z")]


def test_text_is_parsed_once(spark):
    plan = messages.good_posts(parsed(spark, "{}")).select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_encoded_rows_keep_nulls(spark):
    from postlake.functions.columns import encode_json

    frame = spark.createDataFrame([("a", None)], "id string, score int")
    assert bytes(frame.select(encode_json(["id", "score"])).first()[0]) == b'{"id":"a","score":null}'
