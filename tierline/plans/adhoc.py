"""Read-only SQL text over the catalog."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Accepted first words, and words no accepted text may contain.
FIRST_WORDS = ("SELECT", "WITH")
FORBIDDEN_WORDS = (
    "INSERT",
    "UPDATE",
    "DELETE",
    "DROP",
    "ALTER",
    "TRUNCATE",
    "CREATE",
    "GRANT",
    "REVOKE",
    "COPY",
)
# Functions that call methods of the JVM.
CALLS = ("REFLECT", "TRY_REFLECT", "JAVA_METHOD")


# A script (TRANSFORM, MAP or REDUCE) has USING before a text; that of a join has columns in parentheses.
_SCRIPT = re.compile(r"\bUSING\b(?!\s*\()", re.IGNORECASE)
RUN_ON_FILES = "spark.sql.runSQLOnFiles"


def is_read_only(sql: str) -> bool:
    """Whether the text starts like a query, has none of the forbidden words, also in literals, and no script."""
    words = re.findall(r"\w+", sql.upper())
    starts = sql.strip().upper().startswith(FIRST_WORDS)
    return starts and not set(words) & {*FORBIDDEN_WORDS, *CALLS} and not _SCRIPT.search(sql)


def _analyzed(spark: SparkSession, sql: str) -> DataFrame:
    """The query, in which a path is no table: its relations are registered tables and views, or Spark refuses it.

    Registered views keep the paths in their own texts.
    """
    before = spark.conf.get(RUN_ON_FILES)
    spark.conf.set(RUN_ON_FILES, "false")
    try:
        return spark.sql(sql)
    except AnalysisException as e:
        if e.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
            raise ValueError(f"not a registered table or view: {e.getMessage()}") from e
        raise
    finally:
        spark.conf.set(RUN_ON_FILES, before)


def query(spark: SparkSession, sql: str, max_rows: int | None = None) -> DataFrame:
    """Run a read-only query over registered tables and views; all rows, or the first ``max_rows``.

    ``truncated`` tells whether a bound would cut the result.
    """
    text = clean(sql)
    if not is_read_only(text):
        raise ValueError("only read-only SELECT statements are allowed")
    rows = _analyzed(spark, text)
    return rows if max_rows is None else rows.limit(max_rows)


def truncated(spark: SparkSession, sql: str, max_rows: int) -> bool:
    """Whether the query has more rows than the bound."""
    return len(query(spark, sql, max_rows + 1).take(max_rows + 1)) > max_rows


def clean(sql: str) -> str:
    """The text without a code fence and closing semicolons around it."""
    text = sql.strip()
    if text.startswith("```"):
        text = text.removeprefix("```").removesuffix("```").strip().removeprefix("sql\n")
    return text.rstrip("; \t\r\n").lstrip()
