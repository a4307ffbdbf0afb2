"""medallion: layered (bronze / silver / gold) table pipelines on plain Spark.

Operators replace one partition of a table, upsert rows by key, keep a type-2
slowly changing dimension, attach its surrogate keys to facts, aggregate marts,
serve the newest partition as a view, gate every publish on declared data
checks and record runs. Everything is DataFrame / SQL over Parquet tables in
the session catalog.
"""

from medallion.model import Dataset, Publish
from medallion.session import build_session, shared_dir

__all__ = ["Dataset", "Publish", "build_session", "shared_dir"]
