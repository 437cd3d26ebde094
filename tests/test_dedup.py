import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postlake.operators import dedup, matching

POSTS = "seq int, post_id string, score int, created_utc timestamp"


def kept(frame, column="seq"):
    return sorted(row[column] for row in frame.collect())


def best(spark, rows, strategy="highest_score"):
    return kept(dedup.dedup_posts(spark.createDataFrame(rows, POSTS), strategy, arrival="seq"))


def test_first_arrival_wins_a_tie(spark):
    assert best(spark, [(2, "x", 5, None), (1, "x", 5, None)]) == [1]


def test_null_score_counts_as_zero(spark):
    assert best(spark, [(1, "x", None, None), (2, "x", 0, None)]) == [1]
    assert best(spark, [(1, "x", None, None), (2, "x", 1, None)]) == [2]
    assert best(spark, [(1, "x", -1, None), (2, "x", None, None)]) == [2]


def test_empty_keys_are_dropped(spark):
    assert best(spark, [(1, None, 5, None), (2, "", 5, None), (3, "x", 1, None)]) == [3]


def test_missing_time_loses(spark):
    import datetime as dt

    assert best(spark, [(1, "x", 1, None), (2, "x", 1, dt.datetime(2024, 1, 1))], "most_recent") == [2]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        best(spark, [], "best_looking")


def test_null_titles_are_one_group(spark):
    frame = spark.createDataFrame(
        [(str(at), None, float(at)) for at in range(3)], "id string, title string, created_utc double"
    )
    assert kept(dedup.dedup_title(frame), "id") == ["0"]


def test_latest_without_time_keeps_the_first(spark):
    frame = spark.createDataFrame([(2, "a"), (1, "a"), (3, "b")], "seq int, id string")
    assert kept(dedup.dedup_latest(frame, "seq")) == [1, 3]


def test_without_arrival_the_choice_is_stable(spark):
    rows = [(f"t{at}", "k", 1) for at in range(50)]
    shuffled = random.Random(7).sample(rows, len(rows))
    picks = {
        dedup.dedup_posts(spark.createDataFrame(order, "title string, post_id string, score int").repartition(parts))
        .first()
        .title
        for order, parts in ((rows, 1), (shuffled, 7))
    }
    assert len(picks) == 1


def test_empty_input(spark):
    frame = dedup.dedup_posts(spark.createDataFrame([], POSTS), arrival="seq")
    assert frame.count() == 0 and frame.columns == ["seq", "post_id", "score", "created_utc"]


def brute_force(rows):
    chosen = {}
    for row in sorted(rows):
        _, key, score = row
        if key and (key not in chosen or (score or 0) > (chosen[key][2] or 0)):
            chosen[key] = row
    return sorted(row[0] for row in chosen.values())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "", None]), st.none() | st.integers(-3, 3)), max_size=30))
def test_highest_score_matches_brute_force(spark, pairs):
    rows = [(at, key, score) for at, (key, score) in enumerate(pairs)]
    frame = spark.createDataFrame(rows, "seq int, post_id string, score int").repartition(3)
    assert kept(dedup.dedup_posts(frame, arrival="seq")) == brute_force(rows)


def test_stats(spark):
    rows = [("a", "1"), ("a", "1"), ("a", None), ("a", None), ("b", "1")]
    stats = dedup.dedup_stats(spark.createDataFrame(rows, "subreddit string, id string"))
    by_table = {r.subreddit: (r.before_count, r.after_count, r.duplicates_removed, r.percent_removed) for r in stats.collect()}
    assert by_table == {"a": (4, 2, 2, 50.0), "b": (1, 1, 0, 0.0), "TOTAL": (5, 3, 2, 40.0)}


def test_stats_agree_with_dedup(spark):
    rows = [(str(at % 7) if at % 5 else None, "s") for at in range(100)]
    frame = spark.createDataFrame(rows, "id string, subreddit string")
    after = dedup.dedup_stats(frame).filter("subreddit = 's'").first().after_count
    assert dedup.keep_best(frame, ["id"], dedup.tie_break(frame)).count() == after


def test_one_row_per_task_reaches_the_shuffle(spark):
    frame = spark.createDataFrame([], POSTS)
    plan = dedup.dedup_posts(frame, arrival="seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert plan.count("Exchange") == 1


def test_frequent_key_is_cut_before_the_shuffle(spark):
    """Half of 200,000 rows share a key; each of the 8 input tasks may ship one of them."""
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "CAST(id AS INT) AS seq", "IF(id % 2 = 0, 'hot', CAST(id AS STRING)) AS post_id", "CAST(id % 1000 AS INT) AS score"
    )
    best = dedup.dedup_posts(rows, arrival="seq")
    assert best.filter("post_id = 'hot'").select("seq", "score").collect() == [(998, 998)]
    plan = best._jdf.queryExecution().executedPlan()
    assert best.count() == 100_001 and "WindowGroupLimit" in plan.toString()


def test_skip_and_keep_existing(spark):
    new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "post_id string, seq int")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "post_id string")
    assert kept(matching.skip_existing(new, known)) == [3]
    assert kept(matching.keep_existing(new, known, "post_id")) == [1, 2]
    nothing = spark.createDataFrame([], "post_id string")
    assert kept(matching.skip_existing(new, nothing)) == [1, 2, 3]


def test_frequent_key_join_is_split(spark):
    """One key holds half of the rows on both sides; adaptive execution has to split its partition."""
    settings_for_small_data = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings_for_small_data}
    for name, value in settings_for_small_data.items():
        spark.conf.set(name, value)
    try:
        key = "IF(id % 2 = 0, 'hot', CAST(id AS STRING)) AS post_id"
        new = spark.range(0, 200_000, 1, 8).selectExpr(key, "uuid() AS body")
        known = spark.range(100_000, 300_000, 1, 8).selectExpr(key)
        joined = matching.keep_existing(new, known, "post_id").selectExpr("count(*) AS n", "max(body) AS b")
        assert joined.collect()[0].n == 100_000 + 50_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
