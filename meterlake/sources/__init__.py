"""Tables and SQL texts."""

from meterlake.sources.sql import drop, read_sql, register, run_sql
from meterlake.sources.tables import Tables, load_jdbc

__all__ = ["Tables", "drop", "load_jdbc", "read_sql", "register", "run_sql"]
