"""Layer jobs."""

from strata.plans.bronze import BronzeResult, bronze_uniqueness, ingest_bronze, to_bronze
from strata.plans.gold import run_gold
from strata.plans.incremental import refresh_customers
from strata.plans.layout import Lake
from strata.plans.pipeline import RunResult, run_pipeline
from strata.plans.silver import SilverResult, run_silver

__all__ = [
    "BronzeResult",
    "bronze_uniqueness",
    "Lake",
    "RunResult",
    "SilverResult",
    "ingest_bronze",
    "refresh_customers",
    "run_gold",
    "run_pipeline",
    "run_silver",
    "to_bronze",
]
