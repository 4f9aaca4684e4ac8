"""Fixed lineage values used by registered queries, so results are
reproducible and comparable with the SQL oracle."""

RUN_TS = "2000-01-01T00:00:00.000000Z"
BRONZE_TAG = "lake/bronze/raw_sales"
SILVER_TAG = "lake/silver/sales"
GOLD_SALES_TAG = "lake/gold/sales"
GOLD_CUSTOMER_TAG = "lake/gold/customer"

# Where the job's tables stand below their lake's root.
BRONZE_ROOT = "bronze/raw_sales"
SILVER_ROOT = "silver/sales"
GOLD_SALES_ROOT = "gold/sales"
GOLD_CUSTOMER_ROOT = "gold/customer"
