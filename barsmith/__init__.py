"""barsmith: market price history on Spark."""

from barsmith.functions.columns import row_id
from barsmith.operators.joins import subset
from barsmith.plans.coverage import latest_intraday, latest_option_date
from barsmith.plans.daily import recent_window, run_daily, run_daily_from_hourly, run_daily_reload
from barsmith.plans.intraday import run_intraday, run_intraday_reload_for_flagged, window_requests
from barsmith.plans.options import pending_pairs, run_options
from barsmith.plans.reference import run_instrument_master, run_market_cap, run_price_files
from barsmith.session import configure
from barsmith.settings import Settings
from barsmith.sources.landed_files import scrip_mapping
from barsmith.sources.responses import daily_candles, read_responses

__all__ = [
    "Settings", "configure", "daily_candles", "latest_intraday", "latest_option_date", "pending_pairs",
    "read_responses", "recent_window", "row_id", "run_daily", "run_daily_from_hourly", "run_daily_reload",
    "run_instrument_master", "run_intraday", "run_intraday_reload_for_flagged", "run_market_cap",
    "run_options", "run_price_files", "scrip_mapping", "subset", "window_requests",
]
