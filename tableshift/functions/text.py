"""Column expressions that read names, addresses and error texts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that separates words in Unicode text.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

# Texts that mark an error as worth retrying, as denied, or as pointing at something absent.
TEMPORARY_MARKERS = ("INTERNAL_ERROR", "TEMPORARILY_UNAVAILABLE", "try again later", "timed out")
PERMISSION_MARKERS = ("PERMISSION_DENIED",)
MISSING_MARKERS = ("NO_SUCH_CATALOG", "CATALOG_NOT_FOUND")
STACK_TRACE_MARKER = "JVM stacktrace"


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def contains_any(text: Column, markers: Sequence[str]) -> Column:
    return any_of([F.contains(text, F.lit(m)) for m in markers])


def starts_with_any(text: Column, prefixes: Sequence[str]) -> Column:
    return any_of([F.startswith(text, F.lit(p)) for p in prefixes])


def ends_with_any(text: Column, suffixes: Sequence[str]) -> Column:
    return any_of([F.endswith(text, F.lit(s)) for s in suffixes])


def single_line(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def slug(address: Column, limit: int = 16, default: str = "user") -> Column:
    """The part of an address before ``@`` as lower-case words joined by ``-``, at most ``limit`` long."""
    local = F.lower(F.substring_index(address, "@", 1))
    words = F.regexp_replace(F.regexp_replace(local, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    short = F.regexp_replace(F.left(words, F.lit(limit)), "-+$", "")
    return F.coalesce(F.nullif(short, F.lit("")), F.lit(default))


def error_brief(text: Column, limit: int = 200) -> Column:
    """One short line of an error: no stack trace, no leading class name in brackets."""
    head = single_line(F.substring_index(text, STACK_TRACE_MARKER, 1))
    return F.left(F.regexp_replace(head, r"^\([\w.$]+\)\s*", ""), F.lit(limit))


def error_class(text: Column) -> Column:
    """temporary, permission, missing or other, by the markers anywhere in the text."""
    return (F.when(contains_any(text, TEMPORARY_MARKERS), "temporary")
            .when(contains_any(text, PERMISSION_MARKERS), "permission")
            .when(contains_any(text, MISSING_MARKERS), "missing")
            .otherwise("other"))


def name_age_seconds(name: Column, now_seconds: float) -> Column:
    """Age of a name that ends in a 13-digit millisecond stamp; NULL for other names."""
    stamp = F.nullif(F.regexp_extract(name, r"(\d{13})$", 1), F.lit(""))
    return F.lit(float(now_seconds)) - stamp.cast("bigint") / 1000.0


def is_stale(name: Column, now_seconds: float, older_than: int = 1800) -> Column:
    return F.coalesce(name_age_seconds(name, now_seconds) > older_than, F.lit(False))


def url_parts(url: Column) -> dict[str, Column]:
    """Scheme, user, password, host and port of an address; a missing scheme means https."""
    full = F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("https://"), url))
    scheme = F.lower(F.regexp_extract(full, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    authority = F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    credentials = F.regexp_extract(authority, r"^(.*)@", 1)
    place = F.regexp_replace(authority, r"^.*@", "")
    return {
        "scheme": scheme,
        "user": F.substring_index(credentials, ":", 1),
        "password": F.regexp_extract(credentials, r"^[^:]*:(.*)$", 1),
        "host": F.lower(F.regexp_extract(place, r"^([^:]*)", 1)),
        "port": F.regexp_extract(place, r"^[^:]*:(.*)$", 1),
    }


def url_problem(url: Column, suffixes: Sequence[str], blocked_prefix: str = "accounts.") -> Column:
    """Why an address is not an acceptable workspace address, or ``ok``."""
    p = url_parts(url)
    return (F.when(p["scheme"] != "https", "scheme")
            .when(p["user"] != "", "user")
            .when(p["password"] != "", "password")
            .when(~p["port"].rlike("^0*$"), "port")
            .when(F.startswith(p["host"], F.lit(blocked_prefix)), "blocked host")
            .when(~ends_with_any(p["host"], suffixes), "foreign host")
            .otherwise("ok"))


def url_clean(url: Column) -> Column:
    p = url_parts(url)
    return F.concat(F.lit("https://"), p["host"])


def resource_path(**parts: Column) -> Column:
    """``projects/x/branches/y``: each part that is not NULL, under its plural name."""
    pieces = [F.concat(F.lit(f"{name}/"), value) for name, value in parts.items()]
    return F.concat_ws("/", *pieces)
