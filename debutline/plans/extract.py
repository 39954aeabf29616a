"""From landed tables to the stored offerings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutline.functions import dates, text
from debutline.functions.gain import gain_bucket, listing_gain
from debutline.functions.series import sort_pairs
from debutline.operators.match import attach, listing_prices, refresh_filter
from debutline.operators.merge import last_per_key
from debutline.operators.project import conform, drop_value, existing, rename
from debutline.operators.reshape import (
    columns_from_trimmed,
    fits_columns,
    squeeze_subscriptions,
    subscription_days,
    trim_zeros,
)
from debutline.schema import DETAIL_KEYS, OFFERING_TYPES, SUBSCRIPTION_NAMES, TARGET_COLUMN
from debutline.sources.markup import (
    detail_rows,
    first_external_link,
    listed_companies,
    parse_pages,
    pick_links,
    price_series,
    profile_fields,
    review_rows,
    split_errors,
    subscription_series,
    unreadable_days,
)
from debutline.session import cut_lineage
from debutline.sources.store import Store

# --- fixed values -----------------------------------------------------------------------------
REVIEW_NAMES = [
    "Broker Apply",
    "Broker May Apply",
    "Broker Neutral",
    "Broker Avoid",
    "Member Apply",
    "Member May Apply",
    "Member Neutral",
    "Member Avoid",
]
# --- end of fixed values ----------------------------------------------------------------------

PAGE_KINDS = ("lists", "offers", "reviews", "subscriptions", "prices")
SERIES = "gmp_series"
LATEST = ("IPO_list_date", "IPO_open_date", "IPO_close_date")


@dataclass(frozen=True)
class Landing:
    """Landed input tables. The page tables hold url and html; `profiles` also name and links."""

    lists: DataFrame
    offers: DataFrame
    reviews: DataFrame
    subscriptions: DataFrame
    prices: DataFrame
    searches: DataFrame
    profiles: DataFrame
    exchange_texts: DataFrame
    instruments: DataFrame
    candles: DataFrame


def offer_details(parsed: DataFrame) -> DataFrame:
    """Cleaned offer terms, one row per offer page."""
    raw = detail_rows(parsed, DETAIL_KEYS)
    span = dates.range_dates("IPO Date")
    band = text.last_number("Price Band")
    day = lambda name: dates.parse_date(text.null_sentinels(name))
    return raw.select(
        F.col("detail_url"),
        F.coalesce(day("IPO Open Date"), span["open"]).alias("IPO_open_date"),
        F.coalesce(day("IPO Close Date"), span["close"]).alias("IPO_close_date"),
        F.coalesce(day("Listed on"), day("Listing Date"), day("Tentative Listing Date")).alias("IPO_list_date"),
        F.floor(text.first_number("Face Value")).cast("double").alias("IPO_face_value"),
        F.coalesce(text.first_integer(text.null_sentinels("Issue Price")).cast("double"), F.floor(band).cast("double")).alias(
            "IPO_issue_price"
        ),
        F.floor(text.first_number("Lot Size")).cast("double").alias("IPO_lot_size"),
        text.issue_size("Total Issue Size").alias("IPO_issue_size"),
    )


def offer_reviews(parsed: DataFrame) -> DataFrame:
    """Broker and member votes, one row per review page."""
    raw = review_rows(parsed, REVIEW_NAMES)
    number = {name: text.to_number(f"`{name}`") for name in REVIEW_NAMES}
    return raw.select(
        "review_url",
        text.add_strict(number["Broker Apply"], number["Broker May Apply"]).alias("IPO_Broker_apply"),
        number["Broker Neutral"].alias("IPO_Broker_neutral"),
        number["Broker Avoid"].alias("IPO_Broker_avoid"),
        text.add_strict(number["Member Apply"], number["Member May Apply"]).alias("IPO_Member_apply"),
        F.coalesce(number["Member Neutral"], F.lit(0.0)).alias("IPO_Member_neutral"),
        number["Member Avoid"].alias("IPO_Member_avoid"),
    )


def offer_subscriptions(parsed: DataFrame) -> DataFrame:
    """Subscription multiples of any number of days as three day columns each, one row per subscription page."""
    return subscription_days(subscription_series(parsed, list(SUBSCRIPTION_NAMES)))


def offer_prices(parsed: DataFrame) -> DataFrame:
    """Grey-market prices of all days as one series in date order, one row per price page."""

    def read(date: Column, price: Column) -> Column:
        # the date has the shape of its format already
        return F.struct(F.try_to_date(date, dates.PRICE_DAY_FORMAT).alias("date"), text.rupees(price).alias("price"))

    return price_series(parsed, read).select("grmkpt_url", sort_pairs("series").alias(SERIES))


def _attach_once(df: DataFrame, details: DataFrame, link: str, detail_link: str) -> DataFrame:
    """Join details by link; a page landed twice counts once."""
    return attach(df, details.withColumn("_order", F.lit(0)), link, detail_link, ["_order"])


def parsed_pages(landing: Landing) -> dict[str, DataFrame]:
    """The parsed pages of each kind, those that could not be read included."""
    return {kind: parse_pages(getattr(landing, kind).select("url", "html")) for kind in PAGE_KINDS}


def quarantine(parsed: Mapping[str, DataFrame]) -> DataFrame:
    """(kind, url, error) of the pages that could not be read, or not in full."""
    found = [split_errors(pages)[1].select(F.lit(kind).alias("kind"), "url", "error") for kind, pages in parsed.items()]
    found.append(unreadable_days(split_errors(parsed["subscriptions"])[0]).select(F.lit("subscriptions").alias("kind"), "url", "error"))
    return reduce(DataFrame.unionByName, found)


def extract(landing: Landing, store: DataFrame, parsed: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Landed pages and tables to one row per new or unfinished offer; `quarantine` has the pages that are missing here."""
    pages = {kind: split_errors(held)[0] for kind, held in (parsed or parsed_pages(landing)).items()}
    listed = refresh_filter(listed_companies(pages["lists"]), store)
    links = pick_links(landing.offers.select("url", "html"))
    offers = _attach_once(listed, links, "Company_info_url", "url")
    offers = _attach_once(offers, offer_details(pages["offers"]), "Company_info_url", "detail_url")
    offers = _attach_once(offers, offer_reviews(pages["reviews"]), "review_link", "review_url")
    offers = _attach_once(offers, offer_subscriptions(pages["subscriptions"]), "subsc_link", "sbscrp_url")
    offers = _attach_once(offers, offer_prices(pages["prices"]), "gmp_link", "grmkpt_url")
    offers = offers.drop("review_link", "subsc_link").withColumnsRenamed({"rhp_link": "IPO_RHP_doc", "gmp_link": "IPO_gmp_link"})
    return listing_prices(with_profiles(offers, landing), landing.instruments, landing.candles)


def with_profiles(offers: DataFrame, landing: Landing) -> DataFrame:
    """Add company profile and exchange symbols, found through the search pages."""
    searches = first_external_link(landing.searches.select("url", "html")).select(
        text.searched_name("url").alias("_searched"), "screener_link"
    )
    named = offers.withColumn("_search", F.replace(F.col("Company_name"), F.lit("&"), F.lit("and")))
    out = _attach_once(named, searches.filter(F.col("screener_link").isNotNull()), "_search", "_searched").drop("_search")
    profiles = landing.profiles.select(F.col("url").alias("_profile"), *profile_fields(F.col("links"), F.col("name")))
    out = _attach_once(out, profiles.filter(F.col("company_long_name").isNotNull()), "screener_link", "_profile")
    symbols = landing.exchange_texts.select(F.col("url").alias("_bse"), text.bracket_symbol("text").alias("_symbol"))
    out = _attach_once(out, symbols, "bse_link", "_bse")
    return out.withColumn("bse_symbol", F.col("_symbol")).drop("_symbol")


def transform(extracted: DataFrame, drop_sme: bool = True) -> DataFrame:
    """Extracted offers to the stored schema.

    A series is taken from the column `SERIES`, or from day columns. Offers whose series is longer than the stored columns, its leading
    zeros aside, are left to `too_long`.
    """
    out = squeeze_subscriptions(extracted)
    if SERIES in out.columns:
        out = columns_from_trimmed(out.filter(fits_columns(SERIES)), SERIES)
    out = out.withColumn("gmp_company_name", existing(out, "company_long_name"))
    out = out.withColumn(
        "IPO_listing_gain_percentage",
        listing_gain(existing(out, "IPO_listing_price", "double"), existing(out, "IPO_issue_price", "double")),
    )
    out = out.withColumn(TARGET_COLUMN, gain_bucket("IPO_listing_gain_percentage"))
    out = trim_zeros(conform(rename(out), OFFERING_TYPES))
    return drop_value(out, "Security_type", "SME") if drop_sme else out


def too_long(extracted: DataFrame) -> DataFrame:
    """Extracted offers whose price series does not fit the stored columns."""
    return extracted.filter(~fits_columns(SERIES))


def load(store: Store, transformed: DataFrame) -> str:
    """Upsert by company name. Of several offers with one name that with the latest dates counts."""
    return store.upsert(last_per_key(transformed, store.keys, LATEST))


def refresh(landing: Landing, store: Store, extract_path: str, transform_path: str, quarantine_path: str | None = None) -> str:
    """The whole chain; each stage is written once, and the next one starts from the written table.

    Pages that could not be read and offers that do not fit the store are written below `quarantine_path`, `pages` and `offers`.
    """
    spark = store.spark
    quarantine_path = quarantine_path or f"{extract_path.rstrip('/')}-quarantine"
    parsed = {kind: cut_lineage(pages, f"parsed-{kind}") for kind, pages in parsed_pages(landing).items()}
    quarantine(parsed).write.mode("overwrite").parquet(f"{quarantine_path}/pages")
    extract(landing, store.read(), parsed).write.mode("overwrite").parquet(extract_path)
    too_long(spark.read.parquet(extract_path)).write.mode("overwrite").parquet(f"{quarantine_path}/offers")
    transform(spark.read.parquet(extract_path)).write.mode("overwrite").parquet(transform_path)
    return load(store, spark.read.parquet(transform_path))
