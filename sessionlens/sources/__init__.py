from sessionlens.sources.files import (escape_breaks, quarantine, read_sessions_checked, read_sessions_csv,
                                       unescape_breaks, write_csv, write_parquet)
from sessionlens.sources.tables import TABLES, read_table, session_view

__all__ = ["escape_breaks", "unescape_breaks", "read_sessions_csv", "read_sessions_checked", "quarantine", "write_csv", "write_parquet", "TABLES",
           "read_table", "session_view"]
