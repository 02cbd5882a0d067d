"""Schemas of landed files and clean tables, as DDL text (usable before a session exists)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_ENTITIES = (
    "struct<hashtags:array<struct<text:string>>,"
    "user_mentions:array<struct<id:bigint,screen_name:string>>>"
)
_EMBEDDED = (
    "struct<id:bigint,created_at:string,full_text:string,favorite_count:bigint,"
    f"user:struct<id:bigint,screen_name:string>,entities:{_ENTITIES}>"
)

RAW_POST = (
    "id bigint, id_str string, created_at string, full_text string, lang string, "
    "favorite_count bigint, possibly_sensitive boolean, is_quote_status boolean, "
    "user struct<id:bigint,id_str:string,screen_name:string>, "
    f"entities {_ENTITIES}, retweeted_status {_EMBEDDED}, quoted_status {_EMBEDDED}, "
    "in_reply_to_status_id bigint, in_reply_to_user_id bigint, in_reply_to_screen_name string"
)

RAW_ACCOUNT = (
    "id bigint, user_id bigint, id_str string, user_id_str string, name string, screen_name string, "
    "location string, profile_location string, derived string, url string, description string, "
    "protected boolean, verified boolean, followers_count bigint, friends_count bigint, "
    "listed_count bigint, favourites_count bigint, statuses_count bigint, created_at string, "
    "profile_banner_url string, profile_image_url_https string, default_profile boolean, "
    "default_profile_image boolean, withheld_in_countries array<string>, withheld_scope string"
)

FOLLOW_LISTS = (
    "map<string,struct<friends_count:int,followers_count:int,"
    "friends:array<bigint>,followers:array<bigint>>>"
)

CLEAN_POST = (
    "id bigint, folder_name string, user_id bigint, user_id_str string, screen_name string, "
    "full_text string, lang string, possibly_sensitive boolean, "
    "tags array<string>, mentions array<string>, mention_ids array<bigint>, "
    "created_at timestamp, year int, quarter int, quarter_name string, month int, month_name string, "
    "week int, week_name string, day int, day_name string, hour int, minute int, second int, "
    "original_tags array<string>, repost_tags array<string>, quote_tags array<string>, "
    "original_mentions array<string>, repost_mentions array<string>, quote_mentions array<string>, "
    "is_original boolean, original_favourite_cnt bigint, "
    "is_repost boolean, repost_favourite_cnt bigint, in_repost_cnt bigint, in_repost_delay_sec double, "
    "repost_created_at timestamp, repost_of_user_id bigint, repost_of_screen_name string, "
    "repost_of_id bigint, repost_delay_sec bigint, "
    "is_quote boolean, quote_favourite_cnt bigint, in_quote_cnt bigint, in_quote_delay_sec double, "
    "quote_created_at timestamp, quote_of_user_id bigint, quote_of_screen_name string, "
    "quote_of_id bigint, quote_delay_sec bigint, "
    "is_reply boolean, in_reply_cnt bigint, reply_to_user_id bigint, reply_to_id bigint, "
    "reply_to_screen_name string"
)

CLEAN_ACCOUNT = (
    "user_id bigint, user_id_str string, name string, screen_name string, location string, "
    "description string, protected boolean, verified boolean, followers_count bigint, "
    "friends_count bigint, listed_count bigint, favourites_count bigint, statuses_count bigint, "
    "created_at string, is_local boolean, clean_location string"
)


def conformed(ddl: str) -> list[Column]:
    """Casts to a flat schema's columns, in its order."""
    fields = [part.split() for part in ddl.split(", ")]
    return [F.col(name).cast(kind).alias(name) for name, kind in fields]
