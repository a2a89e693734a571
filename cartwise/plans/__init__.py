from .job import build_reports, run_job, run_reports
from .prepare import prepare, prepare_all
from .views import cart_enriched, cart_item_summary, cart_items

__all__ = ["build_reports", "run_job", "run_reports", "prepare", "prepare_all", "cart_enriched",
           "cart_item_summary", "cart_items"]
