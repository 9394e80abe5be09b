from .tables import TABLES, load_csv, read_table, register_tables
from .fixtures import customer_wide, scored, wide

__all__ = ["TABLES", "load_csv", "read_table", "register_tables", "wide",
           "customer_wide", "scored"]
