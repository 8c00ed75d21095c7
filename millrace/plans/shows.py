"""Show records: nested JSON to an all-text table, list columns exploded, keyed upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.keyed import replace_by_key, upsert
from millrace.operators.reshape import FanOut, align, all_strings, cast_strings, flatten, observed_lists
from millrace.sources.records import scan_json_gated
from millrace.sources.sinks import current, publish, replace_stage_if

# The table's columns and its key.
COLUMNS = (
    "score", "show_id", "show_url", "show_name", "show_type", "show_language", "show_genres",
    "show_status", "show_runtime", "show_average_runtime", "show_premiered", "show_ended",
    "show_official_site", "show_schedule_time", "show_schedule_days", "show_rating_average",
    "show_weight", "show_network_id", "show_network_name", "show_network_country_name",
    "show_network_country_code", "show_network_country_timezone", "show_network_official_site",
    "show_web_channel", "show_dvd_country", "show_externals_tvrage", "show_externals_thetvdb",
    "show_externals_imdb", "show_image_medium", "show_image_original", "show_summary",
    "show_updated", "show_links_self_href", "show_links_prev_episode_href",
    "show_links_next_episode_href", "show_network_id_fk", "show_web_channel_id_fk",
    "show_web_channel_name", "show_web_channel_country_name", "show_web_channel_country_code",
    "show_web_channel_country_timezone", "show_web_channel_official_site", "show_averageruntime",
    "show_officialsite", "show_network_officialsite", "show_webchannel", "show_dvdcountry",
    "show__links_self_href", "show__links_previousepisode_href",
    "show__links_nextepisode_href", "show_network", "show_webchannel_id", "show_webchannel_name",
    "show_webchannel_country_name", "show_webchannel_country_code",
    "show_webchannel_country_timezone", "show_webchannel_officialsite",
)
KEYS = ("score", "show_id", "show_genres", "show_schedule_days")

_STATION = (
    "struct<id:bigint,name:string,"
    "country:struct<name:string,code:string,timezone:string>,officialSite:string>"
)
RECORD = (
    "score double, show struct<id:bigint,url:string,name:string,type:string,language:string,"
    "genres:array<string>,status:string,runtime:bigint,averageRuntime:bigint,premiered:string,"
    "ended:string,officialSite:string,schedule:struct<time:string,days:array<string>>,"
    f"rating:struct<average:double>,weight:bigint,network:{_STATION},webChannel:{_STATION},"
    "dvdCountry:string,externals:struct<tvrage:bigint,thetvdb:bigint,imdb:string>,"
    "image:struct<medium:string,original:string>,summary:string,updated:bigint,"
    "_links:struct<self:struct<href:string>,previousepisode:struct<href:string>,"
    "nextepisode:struct<href:string>>>"
)


def stage_shows(records: DataFrame) -> tuple[DataFrame, Callable[[], FanOut]]:
    """Records as rows of the table: one per genre and schedule day, all text. With `observed_lists`' counts."""
    exploded, counts = observed_lists(flatten(records), "show_genres", "show_schedule_days")
    return align(cast_strings(exploded), all_strings(COLUMNS)), counts


@dataclass(frozen=True)
class Loaded:
    """``version``: what was published, None if nothing was. ``counts``: records read, rows staged, and the most
    rows that one record became. ``quarantined``: unreadable records, None if they were not asked for."""

    version: str | None
    counts: FanOut
    quarantined: int | None


def load_shows(
    spark: SparkSession,
    landing: str,
    table: str,
    tiebreak: Sequence[Column] = (),
    null_safe: bool = False,
    unique_target: bool = False,
    quarantine: str | None = None,
    folder: str | None = None,
) -> str | None:
    """Read landed records, stage them, upsert and publish ``table``.

    Returns the version published. None if no record could be read: then neither the stage
    nor the table changes. Unreadable records are appended to ``quarantine``. ``unique_target``
    states that the table has one row per key, which holds if only this load writes it.
    """
    return load_shows_counted(spark, landing, table, tiebreak, null_safe, unique_target, quarantine, folder).version


def load_shows_counted(
    spark: SparkSession,
    landing: str,
    table: str,
    tiebreak: Sequence[Column] = (),
    null_safe: bool = False,
    unique_target: bool = False,
    quarantine: str | None = None,
    folder: str | None = None,
) -> Loaded:
    """As `load_shows`, with the rows of each step, counted while the stage is written."""
    good, bad = scan_json_gated(spark, landing, RECORD)
    quarantined = None
    if quarantine is not None:
        put_aside = Observation()
        bad.observe(put_aside, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(quarantine)
        quarantined = put_aside.get["n"]
    stage = f"{table}_stage"
    staged, counts = stage_shows(good)
    if not replace_stage_if(staged, stage, lambda: counts().rows_out > 0, folder):
        return Loaded(None, counts(), quarantined)
    base = current(spark, table)
    if base is None:
        base = publish(spark.createDataFrame([], all_strings(COLUMNS)), table, folder=folder, base=None)
    merge = replace_by_key if unique_target else upsert
    merged = merge(spark.table(base), spark.table(stage), KEYS, tiebreak, null_safe, counts().rows_out)
    return Loaded(publish(merged, table, folder=folder, base=base), counts(), quarantined)
