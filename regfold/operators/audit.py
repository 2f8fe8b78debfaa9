"""Failure notices as rows of an audit table, one per failure.

The source mails a notice with a code per failing step and often sends two for one failure (the
inner one and the one of its exception handler). Here a failure is a row and its notice is a
projection of that row; the notice text is ours. The message broker is not built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notice codes of the source: 01 source access, 02 no new data, 03 transfer (fixed values);
# 04 is ours: the source never parsed XML itself, so it had no code for a damaged record.
NOTICE_CODES = (
    ("01", "source access check failed"),
    ("02", "new files or data not found"),
    ("03", "file transfer failed"),
    ("04", "record could not be parsed"),
)
SUBJECT_PREFIX = "REGLOAD_FILECOPY_"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def notice_message(code) -> Column:
    out = None
    for k, text in NOTICE_CODES:
        out = F.when(_c(code) == k, F.lit(text)) if out is None else out.when(_c(code) == k, F.lit(text))
    return out.otherwise(F.lit("unknown failure"))


def failure_notices(failures: DataFrame, code, file=None, directory=None, run_date=None,
                    keep: tuple[str, ...] = (), offset=None) -> DataFrame:
    """(keep..., code, subject, message, file, dir, run_date) for every failed row."""
    named = [F.when(_c(c).isNotNull(), F.concat(F.lit(f"{label}: "), _c(c).cast("string"))) if c is not None else F.lit(None)
             for label, c in (("file", file), ("byte", offset), ("dir", directory))]
    msg = F.concat_ws("; ", notice_message(code), *named)
    return failures.select(
        *keep,
        _c(code).alias("code"),
        F.concat(F.lit(SUBJECT_PREFIX), _c(code)).alias("subject"),
        msg.alias("message"),
        (_c(file) if file is not None else F.lit(None).cast("string")).alias("file"),
        (_c(directory) if directory is not None else F.lit(None).cast("string")).alias("dir"),
        (_c(run_date) if run_date is not None else F.current_date()).alias("run_date"),
    )
