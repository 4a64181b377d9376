"""reportlake: land periodic report files and make them queryable, as Spark jobs.

The file inventory is a DataFrame (one row per file), file contents are
partitioned DataFrames, and every operator is DataFrame-in, DataFrame-out.

Typical flow::

    import reportlake as rl
    specs = rl.specs_from_toml(open("sources.toml").read())
    catalog = rl.build_catalog(rl.list_files(spark, landing_dir), specs)
    rl.upload(spark, catalog, lake_root)
    rl.publish_missing(spark, lake_root)          # external tables + typed views
    spark.sql("SELECT report_date, count(*) FROM ledger_v1_1 GROUP BY 1")
"""

from reportlake.operators.catalog import (
    accepted,
    build_catalog,
    compare_files,
    duplicate_files,
    folder_summary,
    list_files,
    match_stored,
    mixed_versions,
    new_files,
    rejected,
)
from reportlake.operators.infer import infer_lake_schema, profile, read_typed
from reportlake.operators.load import committed, land, read_committed, reconcile, upload, upload_archives, verify
from reportlake.operators.tables import create_table, drop_tables, list_tables, publish_missing, republish
from reportlake.session import get_session, shared_dir
from reportlake.sources.specs import SourceSpec, specs_from_toml
from reportlake.streaming.ingest import run_uploads

__all__ = [
    "SourceSpec", "accepted", "build_catalog", "committed", "compare_files", "create_table", "drop_tables", "duplicate_files",
    "folder_summary", "get_session", "infer_lake_schema", "land", "list_files", "list_tables", "match_stored",
    "mixed_versions", "new_files", "profile", "publish_missing", "read_committed", "read_typed", "reconcile", "rejected",
    "republish", "run_uploads", "shared_dir", "specs_from_toml", "upload", "upload_archives", "verify",
]
__version__ = "0.1.0"
