"""relkit: everyday relational queries -- selections, joins, grouped
analytics, views and parameterised procedures -- written as Spark
DataFrame / Spark SQL plans so Catalyst and adaptive execution pick the
physical strategy at any data size.

Layout:
  session.py  session settings for scale; checkpoint and shared folders
  catalog.py  the registered queries with their DuckDB oracle SQL
  __main__.py command line: list, run, explain, sql
  sources/    reading the input tables, writing summary tables
  functions/  column expressions shared by the queries
  operators/  the queries: select, joins, analytics, distributed scans
  plans/      join strategies, hot-key detection, views, procedures
"""

from relkit.session import build_session, output_dir
from relkit.sources.tables import Tables

__all__ = ["build_session", "output_dir", "Tables"]
