"""Scalar Column helpers: symbols, dates and times, numbers, text."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code prefixes of A-shares by exchange.
A_SHARE_PREFIXES = {"SH": ["600", "601", "603", "605", "688", "689"], "SZ": ["000", "001", "002", "003", "300", "301"]}
MARKETS = ["SH", "SZ", "BJ"]
#: Session bounds that a minute fetch asks for.
SESSION_OPEN, SESSION_CLOSE = "09:15:00", "15:00:00"
#: Exchange-local time is a fixed offset.
LOCAL_OFFSET = "+08:00"


class Period(Enum):
    """Bar periods by their text."""

    TICK, M1, M5, M15, M30, H1 = "tick", "1m", "5m", "15m", "30m", "1h"
    D1, W1, MON1, Q1, HY1, Y1 = "1d", "1w", "1mon", "1q", "1hy", "1y"

    @classmethod
    def parse(cls, text: str) -> Period:
        text = text.strip().lower()
        return cls("1mon" if text == "1mo" else text)

    @property
    def daily(self) -> bool:
        """Whether bars of this period carry a date instead of a time."""
        return self in (Period.D1, Period.W1, Period.MON1, Period.Q1, Period.HY1, Period.Y1)


class Adjust(Enum):
    """Price adjustments by their text; qfq and hfq are aliases."""

    NONE, FRONT, BACK, FRONT_RATIO, BACK_RATIO = "none", "front", "back", "front_ratio", "back_ratio"

    @classmethod
    def parse(cls, text: str) -> Adjust:
        text = text.strip().lower()
        return cls({"qfq": "front", "hfq": "back", "": "none"}.get(text, text))


def exchange_of(symbol: Column) -> Column:
    """The part behind the first dot; null without one."""
    return F.get(F.split(symbol, "\\."), F.lit(1))


def date_from_text(raw: Column) -> Column:
    """YYYY-MM-DD of a text that begins so or with eight digits; else null."""
    return F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(raw, 1, 10)).when(
        raw.rlike(r"^\d{8}"), F.concat_ws("-", F.substring(raw, 1, 4), F.substring(raw, 5, 2), F.substring(raw, 7, 2))
    )


def parse_date(raw: Column) -> Column:
    """A date from YYYY-MM-DD or YYYYMMDD; null if neither is valid."""
    raw = F.trim(raw)
    return F.coalesce(
        F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(raw, "yyyy-MM-dd")), F.when(raw.rlike(r"^\d{8}$"), F.try_to_date(raw, "yyyyMMdd"))
    )


def compact_date(raw: Column) -> Column:
    return F.date_format(parse_date(raw), "yyyyMMdd")


def dashed_date(raw: Column) -> Column:
    return F.date_format(parse_date(raw), "yyyy-MM-dd")


def parse_datetime(raw: Column) -> Column:
    """A timestamp without zone from YYYY-MM-DD HH:MM:SS, HH:MM, YYYYMMDDHHMMSS, or a bare date."""
    raw = F.trim(raw)
    forms = [(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"), (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$", "yyyy-MM-dd HH:mm"), (r"^\d{14}$", "yyyyMMddHHmmss")]
    found = [F.when(raw.rlike(p), F.try_to_timestamp(raw, F.lit(f))) for p, f in forms]
    return F.coalesce(*found, parse_date(raw).cast("timestamp"))


def datetime_parts(ts: Column) -> Column:
    return F.struct(F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour"), F.minute(ts).alias("minute"))


def compact_datetime(raw: Column) -> Column:
    return F.date_format(parse_datetime(raw), "yyyyMMddHHmmss")


def wall_millis(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp's own clock, whatever the session's zone."""
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    return (day * 86_400 + seconds) * 1000 + F.floor(F.extract(F.lit("SECOND"), ts) * 1000)


def time_from_millis(ms: Column, period: Period) -> Column:
    """Exchange-local text of epoch milliseconds: a date for periods of a day or more, else a time."""
    local = F.floor(ms / 1000) + 8 * 3600  # the fixed offset of LOCAL_OFFSET
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(local / 86_400).cast("int")), "yyyy-MM-dd")
    if period.daily:
        return day
    s = F.pmod(local, F.lit(86_400)).cast("int")
    return F.concat(day, F.format_string(" %02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60))


def session_bounds(date: Column) -> tuple[Column, Column]:
    day = dashed_date(date)
    return F.concat(day, F.lit(f" {SESSION_OPEN}")), F.concat(day, F.lit(f" {SESSION_CLOSE}"))


def trade_date_of(time: Column) -> Column:
    return F.substring(time.cast("string"), 1, 10)


def number_from_text(raw: Column) -> Column:
    """A finite double from trimmed text; null if empty, malformed or not finite."""
    x = F.nullif(F.trim(raw), F.lit("")).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def split_symbol(symbol: Column) -> Column:
    """struct(code, market) of CODE.MARKET or MARKET.CODE in any case; null for anything else."""
    s = F.trim(symbol)
    head, tail = F.trim(F.regexp_extract(s, r"^([^.]*)\.(.*)$", 1)), F.trim(F.regexp_extract(s, r"^([^.]*)\.(.*)$", 2))
    market, code = (lambda x: F.upper(x).isin(MARKETS)), (lambda x: x.rlike(r"^[0-9]+$"))
    pair = lambda c, m: F.struct(c.alias("code"), F.upper(m).alias("market"))
    return F.when(market(head) & code(tail), pair(tail, head)).when(code(head) & market(tail), pair(head, tail))


def normalize_symbol(symbol: Column) -> Column:
    """Upper-case NNNNNN.SH, .SZ or .BJ; null for anything else."""
    s = F.upper(F.trim(symbol))
    return F.when(s.rlike(r"^[0-9]{6}\.(SH|SZ|BJ)$"), s)


def is_a_share(symbol: Column) -> Column:
    """Whether the first six digits of the code have an A-share prefix of the exchange (of either, without one)."""
    parts = F.split(F.upper(F.trim(symbol)), "\\.")
    digits = F.substring(F.regexp_replace(F.get(parts, F.lit(0)), "[^0-9]", ""), 1, 6)
    prefix, exchange = F.substring(digits, 1, 3), F.get(parts, F.lit(1))
    of = {x: prefix.isin(p) for x, p in A_SHARE_PREFIXES.items()}
    known = F.when(exchange.isNull(), of["SH"] | of["SZ"]).when(exchange == "SH", of["SH"]).when(exchange == "SZ", of["SZ"]).otherwise(F.lit(False))
    return (F.length(digits) == 6) & known


def is_symbol_key(text: Column) -> Column:
    """Whether an object key looks like X.Y of letters, digits and underscores."""
    return text.rlike(r"^[A-Za-z0-9_]+\.[A-Za-z0-9_]+$")


def is_valid_bar(o: Column, h: Column, low: Column, c: Column, v: Column) -> Column:
    """Whether prices and volume are there, finite and the volume not negative."""
    ok = F.lit(True)
    for x in (o, h, low, c, v):
        ok = ok & F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    return ok & (v >= 0)


def output_id(path: Column, number: Column) -> Column:
    """A file name for source number `number` from its path in the input folder, without the file's extension:
    src-00007-a_b; all but ASCII letters, digits, dash and underscore becomes one underscore each."""
    bare = F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", "")
    return F.concat(F.lit("src-"), F.lpad(number.cast("string"), 5, "0"), F.lit("-"), F.regexp_replace(bare, r"[^A-Za-z0-9_\-]", "_"))


def flatten_text(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def format_seconds(seconds: Column) -> Column:
    """HH:MM:SS, or MM:SS under an hour."""
    s = seconds.cast("long")
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    return F.when(h > 0, F.format_string("%02d:%02d:%02d", h, m, r)).otherwise(F.format_string("%02d:%02d", m, r))


def normalize_base_url(raw: str) -> str:
    raw = raw.strip()
    return raw if raw.startswith(("http://", "https://")) else f"http://{raw}"


def normalize_sector(name: str | None, default: str) -> str:
    return (name or "").strip() or default
