"""RFC 5424 lines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# "-" or one or more bracketed blocks; a backslash escapes the next character.
_STRUCTURED = r"(?:-|(?:\[[^\]\\]*(?:\\.[^\]\\]*)*\])+)"
# Priority and version, then five words: time, host, application, process, message id.
_LINE = rf"(?s)^<\d{{1,3}}>\d+(?:\s+\S+){{5}}\s+{_STRUCTURED}"

PARTS = "_parts"


def with_parts(df: DataFrame, line: str) -> DataFrame:
    """Add the line cut at its first six blanks, NULL when it is not RFC 5424.

    The array comes out of a generator on purpose: filters on fields read from it then stay
    above it.  Pushed below, each would run the patterns again for every field it mentions.
    """
    parts = F.when(F.col(line).rlike(_LINE), F.split(F.col(line), r"\s+", 7))
    return df.select("*", F.inline(F.array(F.struct(parts.alias(PARTS)))))


def syslog_fields() -> dict[str, Column]:
    """Field name to expression over the parts; NULL for lines that are not RFC 5424."""
    def part(i: int) -> Column:
        return F.get(PARTS, F.lit(i))

    head, rest = part(0), part(6)
    structured = F.regexp_extract(rest, rf"(?s)^({_STRUCTURED})", 1)
    return {
        "priority": F.substr(F.substring_index(head, ">", 1), F.lit(2)).try_cast("int"),
        "version": F.substring_index(head, ">", -1).try_cast("int"),
        "log_timestamp": part(1),
        "hostname": part(2),
        "app_name": part(3),
        "proc_id": part(4),
        "msg_id": part(5),
        "structured_data": structured,
        "message": F.ltrim(F.substr(rest, F.length(structured) + 1)),
    }


def syslog_param(structured: Column, name: str) -> Column:
    """Value of one structured-data parameter, NULL when absent."""
    return F.nullif(F.regexp_extract(structured, rf'{name}="((?:[^"\\]|\\.)+)"', 1), F.lit(""))
