from .dedup import dedup_by_key
from .hierarchy import HierarchyTooDeep, nearest_ancestor
from .merge import insert_if_absent, load_batches
from .metrics import load_metrics, table_counts
from .pairs import basket_products, pair_counts, top_pairs
from .ranking import league_points, topk_sum_at_least

__all__ = [
    "dedup_by_key", "HierarchyTooDeep", "nearest_ancestor", "insert_if_absent",
    "load_batches", "load_metrics", "table_counts", "basket_products", "pair_counts",
    "top_pairs", "league_points", "topk_sum_at_least",
]
