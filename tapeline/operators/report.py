"""Text reports of scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.scalars import flatten_text
from tapeline.operators.scan import pattern_summary

MOST_SIGNALS, MOST_FAILURES = 30, 20


def signal_lines(found: DataFrame) -> DataFrame:
    """line: one text for each signal, in order of symbol and pattern."""
    text = F.format_string("- %s | %s | %s | score %.2f | %s", "symbol", "pattern_id", F.date_format("signal_date", "yyyy-MM-dd"), "score", flatten_text(F.col("explanation")))
    return found.orderBy("symbol", "pattern_id").select(text.alias("line"))


def _first(lines: DataFrame, most: int) -> list[str]:
    """The first lines, and how many there are more; only those lines come to the driver."""
    shown = [r["line"] for r in lines.limit(most).collect()]
    more = lines.count() - most if len(shown) == most else 0
    return (shown or ["- None"]) + ([f"- ... and {more} more"] if more > 0 else [])


def report(title: str, found: DataFrame, failed: DataFrame) -> list[str]:
    counts = [f"- {r['pattern_id']}: {r['hits']}" for r in pattern_summary(found).orderBy("pattern_id").collect()]
    errors = failed.orderBy("symbol").select(F.format_string("- %s | %s", "symbol", flatten_text(F.col("error"))).alias("line"))
    return [title, "", "Pattern Summary:", *(counts or ["- None"]), "", "Signals:", *_first(signal_lines(found), MOST_SIGNALS), "", "Failed Symbols:", *_first(errors, MOST_FAILURES)]


def notify(lines: list[str], send: Callable[[dict], int] | None) -> bool:
    """Hand title and lines to a webhook's sender; nothing to do without one. A status outside 200 to 299 is an error."""
    if send is None:
        return False
    status = send({"title": lines[0] if lines else "", "content": [[{"tag": "text", "text": x}] for x in lines[1:]]})
    if not 200 <= status < 300:
        raise RuntimeError(f"the webhook answered {status}")
    return True
