"""Record-level column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsarc.functions.common import col_of

# Markers in the archiver's output text.
ERROR_MARK = "Error"
SERVER_ERROR_MARK = "Server Error"


def archive_outcome(output) -> Column:
    """Archiver output -> struct(status, retryable, archive_url).

    ``Error`` anywhere -> failed (``Server Error`` is the retry class);
    NULL or empty output -> failed; else the text is the archived URL.
    """
    o = F.trim(col_of(output))
    failed = o.isNull() | (o == "") | o.contains(ERROR_MARK)
    status = F.when(failed, F.lit("failed")).otherwise(F.lit("archived"))
    retryable = F.coalesce(o.contains(SERVER_ERROR_MARK), F.lit(False))
    return F.struct(status.alias("status"), retryable.alias("retryable"),
                    F.when(~failed, o).alias("archive_url"))


def status_class(code) -> Column:
    """NULL (no answer) / '2xx' / 'other'."""
    c = col_of(code)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c.between(200, 299), F.lit("2xx")).otherwise(F.lit("other")))


def log_field(details, name: str) -> Column:
    """One field of a crawl log ``details`` JSON text (page, url, loadState...)."""
    return F.get_json_object(col_of(details), f"$.{name}")


def site_record(outlet_cols: list[str]) -> Column:
    """Wrap the outlet columns as the nested ``publication_metadata`` struct."""
    return F.struct(*[F.col(c) for c in outlet_cols])
