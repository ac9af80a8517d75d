"""Fixed schemas of the stored tables and the wider extraction row."""
from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _L, _B, _TS = (T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType(),
                           T.TimestampType())


def _schema(required: set[str], **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields.items()])


LISTINGS = _schema(
    {"id", "listing_url", "scraped_at"},
    id=_L, listing_url=_S, title=_S, price=_D, revenue=_D, cash_flow=_D, multiple=_D, location=_S, industry=_S,
    description=_S, seller_financing=_B, established_year=_I, employees=_I, ebitda=_D, inventory_value=_D,
    ffe_value=_D, reason_for_selling=_S, website=_S, monthly_traffic=_S, is_amazon_fba=_B,
    amazon_business_type=_S, scraped_at=_TS, updated_at=_TS, enhanced_at=_TS,
    source_site=_S,  # partition column, last
)

RUN_LOG = _schema(
    {"run_id", "site_name", "start_time"},
    run_id=_S, site_name=_S, start_time=_TS, end_time=_TS, duration_seconds=_D, total_listings_found=_L,
    existing_listings=_L, new_listings=_L, successful_scrapes=_L, failed_scrapes=_L, error_count=_L, status=_S,
    error_message=_S, api_calls_made=_L, api_credits_saved=_L,
)

# what an ingestion could not store, and why
REJECTS = _schema({"reject_reason", "run"}, source_site=_S, listing_url=_S, scraped_at=_TS, reject_reason=_S, run=_S)

# what a listing page can yield, before ids, tags and timestamps
EXTRACTED = _schema(
    set(),
    title=_S, price=_D, revenue=_D, cash_flow=_D, multiple=_D, location=_S, industry=_S, description=_S,
    seller_financing=_B, established_year=_I, employees=_I, ebitda=_D, inventory_value=_D, reason_for_selling=_S,
    asking_price=_D, asking_price_raw=_S, asking_price_numeric=_D, cash_flow_raw=_S, cash_flow_numeric=_D,
    profit=_D, profit_raw=_S, profit_numeric=_D, revenue_raw=_S, revenue_numeric=_D, location_raw=_S, city=_S,
    state=_S, category=_S, business_type=_S, real_estate_included=_B, financing_available=_B, training_provided=_B,
)

CARDS = _schema(
    set(),
    source=_S, listing_url=_S, scraped_at=_TS, title=_S, asking_price=_D, asking_price_raw=_S, cash_flow=_D,
    cash_flow_raw=_S, profit=_D, profit_raw=_S, revenue=_D, revenue_raw=_S, location=_S, city=_S, state=_S,
    category=_S, business_type=_S,
)
