"""Lineage columns: where a row came from and when it was ingested."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed pattern: the partition folder that carries the event date.
EVENT_DATE_FOLDER = "eventDate=([0-9]{4}-[0-9]{2}-[0-9]{2})"


def event_date_of(path: Column) -> Column:
    """Event date from a file path; null (not an error) where the folder is missing or no date."""
    return F.try_to_date(F.regexp_extract(path, EVENT_DATE_FOLDER, 1), "yyyy-MM-dd")


def with_lineage(df: DataFrame, ingested_date: str | None = None) -> DataFrame:
    """Add the four bronze lineage columns to a file-backed frame, batch or stream.

    A frame that is no plain scan any more has its file in a column `_file`, which is dropped.
    ``ingested_date`` is one literal per run; tests and replays inject it.
    """
    file = F.col("_file" if "_file" in df.columns else "_metadata.file_path")
    day = ingested_date or datetime.now(timezone.utc).date().isoformat()
    return df.withColumns(
        {
            "eventDate": event_date_of(file),
            "_ingested_at": F.current_timestamp(),
            "_source_file": file,
            "_ingested_date": F.lit(day),
        }
    ).drop("_file")
