"""Removal of local addresses, user folders and embedded code from free text.

Written as chained built-in expressions over whole text columns, so that it runs
as one map stage over a text table of any size.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# What is removed, and what stands in its place.
# ---------------------------------------------------------------------------
LOCAL_URL = (
    r"(?i)https?://(?:localhost|127\.0\.0\.1|10\.\d{1,3}\.\d{1,3}\.\d{1,3}"
    r"|172\.(?:1[6-9]|2\d|3[01])\.\d{1,3}\.\d{1,3}|192\.168\.\d{1,3}\.\d{1,3})"
    r"(?::\d+)?[^\s)]*"
)
LOCAL_IP = (
    r"\b(?:127\.0\.0\.1|10\.\d{1,3}\.\d{1,3}\.\d{1,3}"
    r"|172\.(?:1[6-9]|2\d|3[01])\.\d{1,3}\.\d{1,3}|192\.168\.\d{1,3}\.\d{1,3})\b"
)
USER_FOLDER = r"(?i)\b[A-Z]:\\Users\\[^\\\s]+"
CODE_FENCE = r"(?s)```.*?```"
SQL_STATEMENT = r"(?is)(^|[\r\n;])\s*(SELECT|WITH|INSERT|UPDATE|DELETE)\b.*"
SQL_ASSIGNMENT = r"(?is)\b(sql|query)\s*[:=]\s*(SELECT|WITH|INSERT|UPDATE|DELETE)\b.*"
ELLIPSIS = "..."

# Name, pattern, replacement, and texts one of which any match must contain.
RULES = (
    ("local_urls", LOCAL_URL, "[local-url]", ("://",)),
    ("local_ips", LOCAL_IP, "[local-ip]", ("127.0.0.1", "10.", "172.", "192.168.")),
    ("user_folders", USER_FOLDER, "[user-dir]", (":\\",)),
    ("code_fences", CODE_FENCE, " ", ("```",)),
    ("sql_statements", SQL_STATEMENT, "$1 SQL omitted.", ()),
    ("sql_assignments", SQL_ASSIGNMENT, "$1 omitted.", (":", "=")),
)
# ---------------------------------------------------------------------------


def shortened(value: Column, limit: int) -> Column:
    cut = F.concat(F.rtrim(F.substring(value, 1, limit)), F.lit(ELLIPSIS))
    return F.when(F.length(value) <= limit, value).otherwise(cut)


def redacted(frame: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Add ``redacted`` (and ``preview`` when a limit is given) and hits per rule.

    Each rule sees the text as the rules before it left it, in a projection of its
    own, so no rule is evaluated twice.  A plain search decides whether a pattern has
    to be tried at all.  The whole text is processed; a limit only adds a short copy.
    """
    current = frame.withColumn("redacted", F.coalesce(F.col(column), F.lit("")))
    whole = F.col("redacted")
    for name, pattern, replacement, needles in RULES:
        found = reduce(or_, [whole.contains(text) for text in needles], F.lit(not needles))
        hits = F.regexp_count(whole, F.lit(pattern)).cast("long")
        current = current.withColumn(name, F.when(found, hits).otherwise(F.lit(0).cast("long")))
        replaced = F.regexp_replace(whole, pattern, replacement)
        current = current.withColumn(
            "redacted", F.when(F.col(name) > 0, replaced).otherwise(whole)
        )
    out = current.withColumn("redacted", F.trim(F.regexp_replace(whole, r"\s+", " ")))
    return out if limit is None else out.withColumn("preview", shortened(whole, limit))
