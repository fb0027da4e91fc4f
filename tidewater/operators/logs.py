"""Click-log operators: parse and route raw records, repair the new-visitor flag, fan out
(P1-P6, P17-P20, T2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import schemas
from tidewater.functions.sequence import first_per_group, join_per_group
from tidewater.functions.text import parse_once
from tidewater.functions.time import DATE_FMT, ms_to_date

CORRUPT = "_corrupt_record"


def parse_json(raw: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Add ``rec`` (parsed struct) and ``is_dirty``.

    A record is dirty when it is blank, is not a JSON object, or does not parse.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    v = F.col(value_col)
    out = parse_once(raw, value_col, with_corrupt, "_rec",
                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    dirty = (v.isNull() | ~F.ltrim(v).startswith("{") | F.col("_rec").isNull()
             | F.col(f"_rec.{CORRUPT}").isNotNull())
    return out.withColumn("is_dirty", dirty)


def split_dirty(raw: DataFrame, schema: T.StructType = schemas.CLICK_LOG,
                value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(clean parsed records, dirty raw records) - P1. One parse feeds both sides."""
    parsed = parse_json(raw, schema, value_col)
    keep = [c for c in raw.columns if c != value_col]
    clean = (parsed.where(~F.col("is_dirty"))
             .select(*[F.col(f"_rec.{f.name}").alias(f.name) for f in schema.fields], *keep))
    dirty = parsed.where(F.col("is_dirty")).select(value_col, *keep)
    return clean, dirty


def parse_or_skip(raw: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Parse, silently dropping bad records."""
    return split_dirty(raw, schema, value_col)[0]


def drop_tombstones(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Drop the empty records left by upsert deletes."""
    return raw.where(F.col(value_col).isNotNull() & (F.col(value_col) != ""))


def fix_new_flag(log: DataFrame, order_cols: Sequence[str] = ("ts", "offset")) -> DataFrame:
    """Repair ``common.is_new`` per device.

    The first record of a ``mid`` fixes an anchor day: its own day when it claims to be
    new, else the day before. Later records claiming ``is_new='1'`` on another day become
    '0'. The anchor is a per-device aggregate, joined back in parts of a device's rows.
    """
    order_cols = list(order_cols)
    day = ms_to_date(F.col("ts"))
    firsts = first_per_group(
        log.select(F.col("common.mid").alias("_mid"), F.col("common.is_new").alias("_isn"),
                   *[F.col(c) for c in order_cols]),
        ["_mid"], order_cols)
    anchor = firsts.select(
        F.col("_mid"),
        F.when(F.col("_isn") == "1", ms_to_date(F.col("ts")))
        .otherwise(F.date_format(F.date_sub(F.to_date(ms_to_date(F.col("ts"))), 1), DATE_FMT))
        .alias("_anchor"))
    # Only rows that claim to be new can change; the others pass.
    claims = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    checked = join_per_group(log.where(claims).withColumn("_mid", F.col("common.mid")), anchor,
                             ["_mid"], order_cols)
    fixed = F.when(day != F.col("_anchor"), F.lit("0")).otherwise(F.col("common.is_new"))
    checked = checked.withColumn("common", F.col("common").withField("is_new", fixed))
    return checked.select(*log.columns).unionByName(log.where(~claims))


def fan_out_log(log: DataFrame) -> dict[str, DataFrame]:
    """Route click records (P4-P6): error objects of any record; start records; page
    records without displays/actions; one row per display / action of a page record."""
    extra = [c for c in log.columns if c not in {f.name for f in schemas.CLICK_LOG.fields}]
    error = log.where(F.col("err").isNotNull()).select("common", "err", "ts", *extra)
    start = log.where(F.col("start").isNotNull()).select("common", "start", "err", "ts", *extra)
    pages = log.where(F.col("start").isNull())
    page = pages.drop("displays", "actions", "start")
    display = explode_displays(pages)
    action = explode_actions(pages)
    return {"page": page, "start": start, "error": error, "display": display,
            "action": action}


def explode_displays(pages: DataFrame) -> DataFrame:
    """One row per display with page_id, ts and common added (P5); inner explode."""
    return (pages.select("common", F.col("page.page_id").alias("page_id"), "ts",
                         F.explode("displays").alias("d"))
            .select("common", "page_id", "ts", "d.*"))


def explode_actions(pages: DataFrame) -> DataFrame:
    """One row per action; the page ts replaces the action's own ts."""
    return (pages.select("common", F.col("page.page_id").alias("page_id"), "ts",
                         F.explode("actions").alias("a"))
            .select("common", "page_id", "ts", "a.action_id", "a.item", "a.item_type"))


def session_starts(page: DataFrame) -> DataFrame:
    """Page rows with no previous page."""
    return page.where(F.col("page.last_page_id").isNull())


def home_or_detail(page: DataFrame) -> DataFrame:
    """Home and product-detail pages."""
    return page.where(F.col("page.page_id").isin("home", "good_detail"))


def login_rows(page: DataFrame) -> DataFrame:
    """Session starts of signed-in users."""
    return page.where(F.col("common.uid").isNotNull() & F.col("page.last_page_id").isNull())


def search_keywords(page: DataFrame) -> DataFrame:
    """Pages reached from search with a keyword item (P20)."""
    return page.where(F.col("page.item").isNotNull()
                      & (F.col("page.last_page_id") == "search")
                      & (F.col("page.item_type") == "keyword"))
