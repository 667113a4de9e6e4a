"""Writers for the two write tasks (recreate a table; append rows).

Both go through Spark's file committer: each task writes its own files and
the job commit publishes them, so a lost executor only re-runs its tasks. A
failed append leaves the table unchanged. An overwrite deletes the previous
table first, so a frame that reads the folder it would replace is refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: Sequence[str] | None = None) -> str:
    """DROP IF EXISTS + CREATE + INSERT: replace whatever is at ``path`` with ``df``."""
    own = urlsplit(path).path.rstrip("/")
    if any(unquote(urlsplit(f).path).startswith(own + "/") for f in df.inputFiles()):
        raise ValueError(f"{path} is read by the frame that would replace it; write it elsewhere first")
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """INSERT INTO: add ``df``'s rows as new files next to the existing ones."""
    df.write.mode("append").format(fmt).save(path)
    return path
