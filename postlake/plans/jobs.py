"""Command line for spark-submit: `ingest`, `replay`, `deduplicate`, `curate` and `feed` over a lake folder.

A lake holds `<community>` (raw) and `<community>_clean` tables. Serving tables are a folder per community, or
JDBC tables when `--jdbc-url` is given; user and password come from the JDBC URL or the session's settings.
"""

from __future__ import annotations

import argparse

from postlake.functions.columns import table_name_of
from postlake.operators import feed
from postlake.operators.publish import MODES, ServingTable, column_types
from postlake.plans.curation import arrival_of, curate_community, metrics_frame
from postlake.plans.raw_tables import deduplicate_tables, with_total
from postlake.schema import BATCH_COLUMN, RUN_COLUMN
from postlake.session import build_session
from postlake.sources.tables import jdbc_options, load_union, read_if_present
from postlake.streaming.queries import batch_writer, start_ingest
from postlake.streaming.sources import kafka_options, open_messages, with_arrival


def arguments(words=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="postlake")
    parser.add_argument("--lake", required=True, help="folder of the raw and clean tables")
    parser.add_argument("--format", default="parquet", help="table format, such as parquet or delta")
    parser.add_argument("--arrival", help="column that records the order of arrival")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="read topics until stopped")
    ingest.add_argument("--servers", required=True)
    ingest.add_argument("--starting", default="latest", choices=["latest", "earliest"])

    deduplicate = jobs.add_parser("deduplicate", help="rewrite raw tables with one row per id")
    deduplicate.add_argument("--dry-run", action="store_true")

    curate = jobs.add_parser("curate", help="raw to clean to serving tables")
    curate.add_argument("--serving", help="folder of the serving tables, or schema name with --jdbc-url")
    curate.add_argument("--jdbc-url")
    curate.add_argument("--jdbc-driver")
    curate.add_argument("--handle-duplicates", default="skip", choices=MODES)
    curate.add_argument("--new-table", action="store_true", help="the serving table in the database is still to be created")
    curate.add_argument("--partition-by", nargs="*", default=[], help="conditions that split the reading of a database table")
    curate.add_argument("--incremental", action="store_true", help="only raw batches that are new")

    replay = jobs.add_parser("replay", help="ingest the messages of the dead-letter folders again")

    page = jobs.add_parser("feed", help="show one page of the clean or raw tables")
    page.add_argument("--source", default="postgres", choices=feed.SOURCES)
    page.add_argument("--limit", type=int, default=feed.DEFAULT_LIMIT)
    page.add_argument("--offset", type=int, default=0)
    page.add_argument("--subreddit")
    page.add_argument("--search")
    page.add_argument("--sort", default=feed.DEFAULT_SORT)
    page.add_argument("--order", default="desc")

    for job in (ingest, replay, deduplicate, curate, page):
        job.add_argument("communities", nargs="+")
    return parser.parse_args(words)


def serving_table(chosen: argparse.Namespace, name: str) -> ServingTable | None:
    if not chosen.serving:
        return None
    if chosen.jdbc_url:
        table = f"{chosen.serving}.{table_name_of(name)}"
        options = jdbc_options(chosen.jdbc_url, chosen.jdbc_driver, dbtable=table)
        if chosen.new_table:
            options["createTableColumnTypes"] = column_types()
        return ServingTable("jdbc", None, options, not chosen.new_table, tuple(chosen.partition_by))
    return ServingTable(chosen.format, f"{chosen.serving}/{table_name_of(name)}")


def raw_path(chosen: argparse.Namespace, name: str) -> str:
    return f"{chosen.lake}/{name}"


def clean_path(chosen: argparse.Namespace, name: str) -> str:
    return f"{chosen.lake}/{name}_clean"


def ingest(spark, chosen):
    """One query per community: each has its own raw table and position."""
    for name in chosen.communities:
        messages = open_messages(spark, "kafka", **kafka_options(chosen.servers, [name], chosen.starting))
        start_ingest(with_arrival(messages), writer_of(chosen, name), f"{aside(chosen, name)}/checkpoint", name)
    spark.streams.awaitAnyTermination()


def aside(chosen, name: str) -> str:
    return f"{chosen.lake}/_aside/{name}"


def writer_of(chosen, name: str, dead: str = "dead"):
    return batch_writer(
        raw_path(chosen, name), f"{aside(chosen, name)}/quarantine", f"{aside(chosen, name)}/{dead}", chosen.format
    )


def replay(spark, chosen):
    """What lies in the dead-letter folders, as a stream of its own; messages that fail again go to a second folder."""
    for name in chosen.communities:
        dead = f"{aside(chosen, name)}/dead"
        kept = read_if_present(spark, dead)
        if kept is not None:
            messages = spark.readStream.schema(kept.schema).parquet(dead).drop(RUN_COLUMN, BATCH_COLUMN)
            query = start_ingest(
                messages, writer_of(chosen, name, "dead_again"), f"{aside(chosen, name)}/replay", name, {"availableNow": True}
            )
            query.awaitTermination()


def deduplicate(spark, chosen):
    paths = {name: raw_path(chosen, name) for name in chosen.communities}
    return with_total(deduplicate_tables(spark, paths, chosen.format, chosen.dry_run, chosen.arrival))


def curate(spark, chosen):
    runs = [
        curate_community(
            spark,
            name,
            raw_path(chosen, name),
            clean_path(chosen, name),
            serving_table(chosen, name),
            mode=chosen.handle_duplicates,
            fmt=chosen.format,
            arrival=chosen.arrival,
            incremental=chosen.incremental,
        )
        for name in chosen.communities
    ]
    return metrics_frame(spark, runs)


def show_feed(spark, chosen):
    path_of = raw_path if chosen.source == "trino" else clean_path
    posts = load_union(spark, {name: path_of(chosen, name) for name in chosen.communities}, chosen.format)
    shown = {name: getattr(chosen, name) for name in ("source", "limit", "offset", "subreddit", "search")}
    feed.feed_summary(posts, chosen.communities, **shown).show(truncate=False)
    arrival = arrival_of(posts, chosen.arrival)
    return feed.feed_page(posts, chosen.communities, **shown, sort=chosen.sort, order=chosen.order, arrival=arrival)


JOBS = {"ingest": ingest, "replay": replay, "deduplicate": deduplicate, "curate": curate, "feed": show_feed}


def main(words=None) -> None:
    chosen = arguments(words)
    result = JOBS[chosen.job](build_session(f"postlake-{chosen.job}"), chosen)
    if result is not None:
        result.show(feed.MAX_LIMIT, truncate=40)


if __name__ == "__main__":
    main()
