"""The offering schema: names, types and lookup values that every job shares."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------
KEY_COLUMN = "IPO_company_name"
TARGET_COLUMN = "IPO_listing_gain_category"
PREDICTION_COLUMN = "Predicted_IPO_listing_gain_category"
SERIES_DAYS = 33
SUBSCRIPTION_DAYS = 3
SUBSCRIPTION_METRICS = ["qib", "nii", "rtl"]
SPLIT_SEED = 787
TRAIN_SHARE = 0.7
TEST_SHARE = 0.5
DRIFT_THRESHOLD = 0.05
IMPUTE_NEIGHBOURS = 5
RETRY_LIMIT = 10
PAGE_ROWS = 20
ARCHIVE_START = "2025-09-01"
SENTINELS = ["na", "nan", "null", "None", "", "error", "[.]"]

GAIN_BANDS = [
    ("Cat_1", -100, -20),
    ("Cat_2", -20, 0),
    ("Cat_3", 0, 10),
    ("Cat_4", 10, 20),
    ("Cat_5", 20, 40),
    ("Cat_6", 40, 100),
]

FEATURE_COLUMNS = [
    "IPO_face_value",
    "IPO_issue_price",
    "IPO_lot_size",
    "IPO_issue_size",
    "IPO_Broker_apply",
    "IPO_Member_apply",
    "IPO_day2_qib",
    "IPO_day2_nii",
    "gmp_sum_roc",
    "gmp_pu_day",
]

RENAMES = {
    "Company_name": "IPO_company_name",
    "Company_info_url": "Chittorgarh_link",
    "IPO_category": "Security_type",
    "IPO_gmp_link": "gmp_website_link",
}

DISPLAY_NAMES = {
    "IPO_company_name": "Company",
    "IPO_open_date": "Open Date",
    "IPO_close_date": "Close Date",
    "IPO_list_date": "Listing Date",
    "IPO_issue_price": "Issue Price",
    "IPO_lot_size": "Lot size",
    "IPO_day3_qib": "QIB",
    "IPO_day3_nii": "NII",
    "IPO_day3_rtl": "Retail",
    "latest_gmp_price": "GMP",
    "IPO_listing_price": "Listing Price",
    "IPO_listing_gain_percentage": "Listing gain (%)",
    "Predicted_IPO_listing_gain_category": "Predicted Listing gain (%)",
}

LINK_KINDS = {
    "Reviews": ("review_link", "internal"),
    "Subscription": ("subsc_link", "internal"),
    "DRHP": ("rhp_link", "external"),
    "GMP": ("gmp_link", "external"),
}

TABLE_IDENTIFIERS = {
    "detail": ["IPO Date", "Total Issue Size"],
    "review": ["Not Rated"],
    "sbscrp": ["Date"],
    "grmkpt": ["GMP Date"],
}

DETAIL_KEYS = [
    "IPO Open Date",
    "IPO Close Date",
    "IPO Date",
    "Listed on",
    "Listing Date",
    "Tentative Listing Date",
    "Face Value",
    "Issue Price",
    "Price Band",
    "Lot Size",
    "Total Issue Size",
]

SUBSCRIPTION_NAMES = {
    "QIB": "qib",
    "QIB (Ex Anchor)": "qib",
    "NII": "nii",
    "NII*": "nii",
    "Retail": "rtl",
    "Individual Investors": "rtl",
}

IDENTITY_COLUMNS = ["IPO_company_name", "Chittorgarh_link", "Security_type"]
DATE_COLUMNS = ["IPO_open_date", "IPO_close_date", "IPO_list_date"]
TERM_COLUMNS = ["IPO_face_value", "IPO_issue_price", "IPO_lot_size", "IPO_issue_size"]
REVIEW_COLUMNS = [
    "IPO_Broker_apply",
    "IPO_Broker_neutral",
    "IPO_Broker_avoid",
    "IPO_Member_apply",
    "IPO_Member_neutral",
    "IPO_Member_avoid",
]
PROFILE_COLUMNS = [
    "IPO_RHP_doc",
    "company_long_name",
    "company_website",
    "bse_link",
    "bse_symbol",
    "nse_link",
    "nse_symbol",
    "screener_link",
    "gmp_company_name",
    "gmp_website_link",
]
RESULT_COLUMNS = ["IPO_listing_price", "IPO_listing_gain_percentage"]
# --- end of fixed values ----------------------------------------------------------------------

SUBSCRIPTION_COLUMNS = [
    f"IPO_day{day}_{metric}" for day in range(1, SUBSCRIPTION_DAYS + 1) for metric in SUBSCRIPTION_METRICS
]
SERIES_DATE_COLUMNS = [f"day{day}_date" for day in range(1, SERIES_DAYS + 1)]
SERIES_PRICE_COLUMNS = [f"day{day}_price" for day in range(1, SERIES_DAYS + 1)]
NUMERIC_COLUMNS = (
    TERM_COLUMNS + REVIEW_COLUMNS + SUBSCRIPTION_COLUMNS + SERIES_PRICE_COLUMNS + RESULT_COLUMNS
)


def _column_types() -> dict[str, T.DataType]:
    out: dict[str, T.DataType] = {}
    out.update((name, T.StringType()) for name in IDENTITY_COLUMNS)
    out.update((name, T.DateType()) for name in DATE_COLUMNS)
    out.update((name, T.DoubleType()) for name in TERM_COLUMNS + REVIEW_COLUMNS + SUBSCRIPTION_COLUMNS)
    out.update((name, T.StringType()) for name in PROFILE_COLUMNS)
    for date_name, price_name in zip(SERIES_DATE_COLUMNS, SERIES_PRICE_COLUMNS):
        out[date_name] = T.DateType()
        out[price_name] = T.DoubleType()
    out.update((name, T.DoubleType()) for name in RESULT_COLUMNS)
    out[TARGET_COLUMN] = T.StringType()
    return out


OFFERING_TYPES = _column_types()
OFFERING_COLUMNS = list(OFFERING_TYPES)
OFFERING_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in OFFERING_TYPES.items()])
ARCHIVE_SCHEMA = T.StructType(OFFERING_SCHEMA.fields + [T.StructField(PREDICTION_COLUMN, T.StringType())])
PAIR_TYPE = T.StructType([T.StructField("date", T.DateType()), T.StructField("price", T.DoubleType())])

INSTRUMENT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("symbol", "token", "exch_seg")]
)
CANDLE_SCHEMA = T.StructType(
    [
        T.StructField("exchange", T.StringType()),
        T.StructField("token", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("open", T.DoubleType()),
    ]
)
