"""Schemas and fixed values of the notice data model."""

from __future__ import annotations

# --- Fixed values: results depend on these being exactly as given --------------------------

NOTICE_HOST = "https://eprocure.gov.in"
PRIMARY_SOURCE = "eprocure"
CENTRAL_SOURCE = "cppp"
MISSING_KEY = "UNKNOWN"
NULL_WORDS = ["NA", "N/A", "-", "&nbsp;"]
SCRIPT_MARKS = ["function", "window.open"]
MAX_VALUE_CHARS = 600
MAX_EMBED_CHARS = 30000
EMBED_DIM = 1536
EMBED_BATCH = 100
CHALLENGE_ERROR = "CAPTCHA solving failed"
DEFAULT_PAGE_CAP = 200
FREE_PAGE_CAP = 100
HEADER_SCAN_ROWS = 5
MIN_ROW_CHARS = 20
MIN_ROW_CELLS = 5
CALL_BUDGET = 6
CALL_WINDOW_SECONDS = 60
JOB_TIMEOUT_SECONDS = 300

HEADER_ROW_WORDS = [
    "s.no", "serial", "published", "closing", "opening", "title", "ref.no", "tender id",
    "organisation chain",
]
TITLE_REJECT_WORDS = [
    "search", "|", "eprocurement system", "s.no", "serial", "government of india", "tender id",
    "ref.no", "organisation chain", "closing date", "opening date", "published date",
    "e-published date", "bid closing", "bid opening",
]
TITLE_KEYWORDS = [
    "supply", "procurement", "tender", "contract", "services", "work", "construction",
    "equipment", "purchase", "hiring", "repair", "maintenance", "installation", "consultancy",
]
HEADER_FIELD_VALUES = {
    "closing_date": ["closing date", "close date", "bid closing", "deadline"],
    "opening_date": ["opening date", "open date", "bid opening"],
    "published_date": ["published date", "e-published date", "publication"],
    "organisation": ["organisation chain", "organization", "department", "ministry"],
}
SESSION_PHRASES = [
    "session has expired", "session expired", "invalid session", "your session",
    "please login again",
]
DONE_STATUSES = ["complete", "completed"]
FAILED_STATUSES = [
    "failed", "error", "cancelled_due_to_timeout", "cancelled_due_to_limits", "cancelled_by_user",
]
CAPTIONS = {
    "tender_id": "Tender ID",
    "tender_type": "Tender Type",
    "tender_category": "Tender Category",
    "contract_type": "Form Of Contract",
    "work_description": "Work Description",
    "tender_value": "Tender Value in",
    "product_category": "Product Category",
    "sub_category": "Sub category",
    "bid_validity_days": "Bid Validity",
    "period_of_work_days": "Period Of Work",
    "location": "Location",
    "pincode": "Pincode",
    "pre_bid_meeting_date": "Pre Bid Meeting Date",
    "emd_amount": "EMD Amount in",
    "inviting_authority_name": "Name",
    "inviting_authority_address": "Address",
}
NOTICE_TEXT_PARTS = [
    ("title", ""),
    ("organisation", "Organisation: "),
    ("product_category", "Category: "),
    ("work_description", "Description: "),
    ("location", "Location: "),
    ("tender_type", "Type: "),
    ("tender_category", "Tender Category: "),
]
PREFERENCE_TEXT_PARTS = [
    ("user_goal", "Goal: "),
    ("keywords", "Keywords: "),
    ("categories", "Categories: "),
    ("regions", "Regions: "),
    ("roles", "Roles: "),
    ("primary_industry", "Industry: "),
    ("secondary_industries", "Also works in: "),
    ("business_type", "Business type: "),
]
LIST_PREFERENCES = ["keywords", "categories", "regions", "roles", "secondary_industries"]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# --- Column groups -------------------------------------------------------------------------

LISTING_FIELDS = [
    "title", "ref_no", "closing_date", "opening_date", "published_date", "organisation", "url",
]
DETAIL_FIELDS = [
    "tender_id", "tender_type", "tender_category", "contract_type", "work_description",
    "product_category", "sub_category", "location", "pincode", "tender_value", "emd_amount",
    "period_of_work_days", "bid_validity_days", "pre_bid_meeting_date",
    "inviting_authority_name", "inviting_authority_address",
]
AMOUNT_FIELDS = ["tender_value", "emd_amount"]
DAY_FIELDS = ["period_of_work_days", "bid_validity_days"]
# Kept inside raw_data instead of a column of their own.
PACKED_FIELDS = ["pre_bid_meeting_date", "inviting_authority_name", "inviting_authority_address"]
STORED_DETAIL_FIELDS = [f for f in DETAIL_FIELDS if f not in PACKED_FIELDS]
DATE_FIELDS = ["published_date", "closing_date", "opening_date"]
NOTICE_KEY = ["ref_no", "source"]
# Never null in an incoming row, so an upsert always overwrites them.
ALWAYS_WRITTEN = ["title", "url", "is_active", "detail_scraped", "raw_data"]


def detail_type(name: str) -> str:
    if name in AMOUNT_FIELDS:
        return "double"
    return "bigint" if name in DAY_FIELDS else "string"


# --- Schemas (DDL) -------------------------------------------------------------------------------


# The order of rows: source, crawl time (if known), job, page, stored page, row. No two rows share one.
ORDER_TYPE = (
    "struct<source_rank:int,seen_at:timestamp_ntz,run:string,page_no:bigint,page_id:bigint,row_ord:int>"
)

PAGE_SCHEMA = ("page_id BIGINT, source STRING, url STRING, page_no BIGINT, html STRING")

# Crawl jobs whose records hold their JSON as text, and as they are read from stored results: each
# record parsed once and whole. Lines that are no JSON are kept in the column ``corrupt``.
CRAWL_JOB_SCHEMA = (
    "job_id STRING, status STRING, total INT, "
    "records ARRAY<STRUCT<url: STRING, status: STRING, json: STRING, html: STRING>>"
)
CRAWL_RESULT_SCHEMA = CRAWL_JOB_SCHEMA.replace("json: STRING", "json: VARIANT") + ", corrupt STRING"

LISTING_JSON_FIELDS = [
    "serial_no", "published_date", "closing_date", "opening_date", "tender_id", "title",
    "organisation", "detail_path", "corrigendum",
]

DETAIL_JSON_FIELDS = [f for f in DETAIL_FIELDS if f != "pre_bid_meeting_date"]

STORED_SCHEMA = (
    "ref_no STRING, source STRING, title STRING, organisation STRING, url STRING, "
    "published_date TIMESTAMP_NTZ, closing_date TIMESTAMP_NTZ, opening_date TIMESTAMP_NTZ, "
    "is_active BOOLEAN, "
    + ", ".join(f"{f} {detail_type(f)}" for f in STORED_DETAIL_FIELDS)
    + ", detail_scraped BOOLEAN, raw_data MAP<STRING, STRING>, updated_at TIMESTAMP_NTZ"
)
JOB_SCHEMA = (
    "job_id STRING, segment STRING, status STRING, status_us BIGINT, status_seq BIGINT, "
    "first_us BIGINT, last_us BIGINT, polls BIGINT"
)
VECTOR_SCHEMA = "ref_no STRING, source STRING, embedding ARRAY<FLOAT>"

PREFERENCE_SCHEMA = (
    "user_id STRING, user_goal STRING, keywords ARRAY<STRING>, categories ARRAY<STRING>, "
    "regions ARRAY<STRING>, roles ARRAY<STRING>, primary_industry STRING, "
    "secondary_industries ARRAY<STRING>, business_type STRING"
)
