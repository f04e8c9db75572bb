from careline.sources.tables import (
    all_but,
    columns,
    exists,
    from_rows,
    read_reports,
    read_returns,
    register_view,
)

__all__ = ["all_but", "columns", "exists", "from_rows", "read_reports", "read_returns",
           "register_view"]
