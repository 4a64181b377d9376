"""Import every query module so its queries register."""

from reportlake.plans import (  # noqa: F401
    archive_queries,
    catalog_queries,
    lake_queries,
    load_queries,
    table_queries,
    value_queries,
)
