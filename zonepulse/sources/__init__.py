from .tables import TABLES, VIEWS, load_view, read_table, view_sql, with_views  # noqa: F401
