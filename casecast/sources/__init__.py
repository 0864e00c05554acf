"""Where case tables come from."""

from casecast.sources.cases import read_cases, read_cases_csv, read_cases_parquet
from casecast.sources.orders import cases_from_orders, orders_as_cases_sql

__all__ = ["read_cases", "read_cases_csv", "read_cases_parquet", "cases_from_orders", "orders_as_cases_sql"]
