"""Account table: flattening, the local-place rule, clean locations and the quality filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import squeeze_spaces, title_case
from ..sources.schemas import CLEAN_ACCOUNT, conformed
from .posts import first_per_key

# Stems that mark a location as local, and names that stand for the country.
LOCAL_STEMS = ("croa", "hrvat")
COUNTRY_NAMES = (
    "republic of croatia", "republika hrvatska", "hrvatska", "croatia", "croacia", "croatie",
)
COUNTRY = "Hrvatska"
COUNTRY_FLAG = "\U0001F1ED\U0001F1F7"
CITY_SHORTHAND = {"zg": "zagreb"}


def flatten_account(raw: DataFrame) -> DataFrame:
    """``id`` falls back to ``user_id``; absent optional profile fields become null."""
    def field(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    plain = [
        "name", "screen_name", "location", "profile_location", "derived", "url", "description", "protected",
        "verified", "followers_count", "friends_count", "listed_count", "favourites_count", "statuses_count",
        "created_at", "profile_banner_url", "profile_image_url_https", "default_profile",
        "default_profile_image", "withheld_in_countries", "withheld_scope",
    ]
    return raw.select(
        F.coalesce(field("id").cast("bigint"), field("user_id").cast("bigint")).alias("user_id"),
        F.coalesce(field("id_str"), field("user_id_str")).alias("user_id_str"),
        *[field(c).alias(c) for c in plain],
    )


def flag_local(accounts: DataFrame, places: Sequence[str] | DataFrame) -> DataFrame:
    """Add ``is_local``.  ``places`` is a literal list or a one-column DataFrame of place names."""
    low = F.lower("location")
    stem = F.lit(False)
    for s in LOCAL_STEMS:
        stem = stem | low.contains(s)
    if isinstance(places, DataFrame):
        listed = places.select(F.lower(places[places.columns[0]]).alias("_place")).distinct()
        joined = accounts.join(listed, low == F.col("_place"), "left")
        flagged = joined.withColumn("is_local", F.col("_place").isNotNull() | stem).drop("_place")
    else:
        flagged = accounts.withColumn("is_local", low.isin(*[p.lower() for p in places]) | stem)
    return flagged.withColumn("is_local", F.col("is_local") & (F.col("location") != ""))


def clean_location(location: Column) -> Column:
    low = F.lower(squeeze_spaces(location))
    names_country = F.lit(False)
    for name in COUNTRY_NAMES:
        names_country = names_country | F.lower(location).contains(name)
    result = F.when(location == "", location).when(
        names_country | low.isin("", COUNTRY_FLAG), F.lit(COUNTRY)
    )
    for short, city in CITY_SHORTHAND.items():
        result = result.when(low == short, title_case(F.lit(city)))
    return result.otherwise(title_case(low))


def clean_accounts(raw: DataFrame, places: Sequence[str] | DataFrame) -> DataFrame:
    flat = flatten_account(raw).withColumn("location", squeeze_spaces(F.coalesce("location", F.lit(""))))
    flat = flag_local(flat, places)
    flat = flat.withColumn("clean_location", F.when(F.col("is_local"), clean_location(F.col("location"))))
    return flat.select(*conformed(CLEAN_ACCOUNT))


def quality_filter(accounts: DataFrame, preset: str = "production") -> DataFrame:
    """Open local accounts worth following, most followed first."""
    keep = ~F.col("protected") & F.col("is_local")
    if preset == "production":
        for c in ("statuses_count", "friends_count", "followers_count"):
            keep = keep & (F.col(c) > 10)
    elif preset == "debug":
        keep = keep & (F.col("followers_count") < 5000)
    else:
        raise ValueError(f"unknown preset {preset!r}")
    return accounts.filter(keep).orderBy(F.desc("followers_count"), "user_id")


def latest_per_account(account_days: DataFrame, day: str = "folder_name") -> DataFrame:
    """One row per account: its latest cleaned day."""
    return first_per_key(account_days, ["user_id"], [F.desc(day)])


def follower_band(followers: Column, bands: Sequence[tuple[int, int, int]] = ((0, 60_000, 20_000), (60_000, 350_000, 60_000))) -> Column:
    """Label 'lo-hi' with strict bounds; values on an edge belong to no band."""
    label = F.lit(None).cast("string")
    for lo, hi, step in reversed(bands):
        low = (F.floor((followers - lo) / step) * step + lo).cast("bigint")
        high = low + step
        inside = (followers > lo) & (low < hi) & (followers != low)
        label = F.when(inside, F.concat_ws("-", low.cast("string"), high.cast("string"))).otherwise(label)
    return label
