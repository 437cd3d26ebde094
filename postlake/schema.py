"""The declared post payload and the column sets derived from it."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DateType, IntegerType, StructType, TimestampType

# The payload fields in their declared order. Epoch fields are doubles because a 32-bit
# float steps by 128 seconds at present-day epochs. `edited` is either a flag or an epoch, so it stays text.
POST_FIELDS = """
    approved_at_utc double, subreddit string, selftext string, author_fullname string, saved boolean,
    mod_reason_title string, gilded integer, clicked boolean, title string, subreddit_name_prefixed string,
    hidden boolean, pwls integer, link_flair_css_class string, downs integer, thumbnail_height integer,
    top_awarded_type string, hide_score boolean, name string, quarantine boolean, link_flair_text_color string,
    upvote_ratio double, author_flair_background_color string, ups integer, total_awards_received integer,
    thumbnail_width integer, author_flair_template_id string, is_original_content boolean, secure_media string,
    is_reddit_media_domain boolean, is_meta boolean, category string, link_flair_text string,
    can_mod_post boolean, score integer, approved_by string, is_created_from_ads_ui boolean,
    author_premium boolean, thumbnail string, edited string, author_flair_css_class string, post_hint string,
    content_categories string, is_self boolean, subreddit_type string, created double, link_flair_type string,
    wls integer, removed_by_category string, banned_by string, author_flair_type string, domain string,
    allow_live_comments boolean, selftext_html string, likes integer, suggested_sort string,
    banned_at_utc double, url_overridden_by_dest string, view_count integer, archived boolean,
    no_follow boolean, is_crosspostable boolean, pinned boolean, over_18 boolean, media_only boolean,
    link_flair_template_id string, can_gild boolean, spoiler boolean, locked boolean, author_flair_text string,
    visited boolean, removed_by string, mod_note string, distinguished string, subreddit_id string,
    author_is_blocked boolean, mod_reason_by string, num_reports integer, removal_reason string,
    link_flair_background_color string, id string, is_robot_indexable boolean, report_reasons string,
    author string, discussion_type string, num_comments integer, send_replies boolean, whitelist_status string,
    contest_mode boolean, author_patreon_flair boolean, author_flair_text_color string, permalink string,
    parent_whitelist_status string, stickied boolean, url string, subreddit_subscribers integer,
    created_utc double, num_crossposts integer, media string, is_video boolean
"""
POST_SCHEMA = StructType()
for field in POST_FIELDS.split(","):
    POST_SCHEMA = POST_SCHEMA.add(*field.split())


def payload_fields(*names: str) -> StructType:
    """The declared types of some fields, for readers that need no others: parsing costs by the field."""
    return StructType([POST_SCHEMA[name] for name in names])


# Nested payload keys that are dropped before the payload is parsed.
NESTED_KEYS = [
    "preview",
    "link_flair_richtext",
    "media_embed",
    "user_reports",
    "secure_media_embed",
    "author_flair_richtext",
    "gildings",
    "all_awardings",
    "awarders",
    "treatment_tags",
    "mod_reports",
]

# Columns holding epoch seconds, and the serving columns before `id` is renamed.
EPOCH_COLUMNS = ["approved_at_utc", "banned_at_utc", "created_utc", "created"]
SERVING_COLUMNS = ["id", "title", "author", "score", "num_comments", "created_utc", "url", "selftext"]
FEED_COLUMNS = ["post_id", *SERVING_COLUMNS[1:], "subreddit"]
PARTITION_COLUMNS = ["year", "month", "day"]

# Raw tables written per micro-batch have one folder per batch; its number is the order of arrival.
BATCH_COLUMN = "batch_id"
# The stream that wrote them: its id lives in the checkpoint, so a new checkpoint writes to folders of its own.
RUN_COLUMN = "run"
# Where the source records it: when a message arrived, in which partition and at which place in it.
ARRIVAL_COLUMN = "arrival"

# The clean table: the payload with its epochs as timestamps and `edited` as a flag, the date and the partition columns.
CLEAN_SCHEMA = StructType()
for field in POST_SCHEMA:
    changed = {"edited": BooleanType()} | dict.fromkeys(EPOCH_COLUMNS, TimestampType())
    CLEAN_SCHEMA = CLEAN_SCHEMA.add(field.name, changed.get(field.name, field.dataType))
CLEAN_SCHEMA = CLEAN_SCHEMA.add("date", DateType())
for name in PARTITION_COLUMNS:
    CLEAN_SCHEMA = CLEAN_SCHEMA.add(name, IntegerType())

# Column types of the serving table in a database, `post_id` being its key.
SERVING_TYPES = {
    "post_id": "VARCHAR(50)",
    "title": "TEXT",
    "author": "VARCHAR(255)",
    "score": "INT",
    "num_comments": "INT",
    "created_utc": "TIMESTAMP",
    "url": "TEXT",
    "selftext": "TEXT",
}

# Topic naming and the site whose own links do not count as outbound.
TOPIC_PREFIX = "reddit_"
HOME_SITE = "reddit.com"
