"""Signed-URL rewrites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

_ORIGIN = r"(?is)^(https?)://([^/?#]+)"
_URL = _ORIGIN + r"([^?#]*)(\?[^#]*)?(#.*)?\z"
_HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:@]*)"
# Hosts that are reached directly when no list is given.
DIRECT_HOSTS = ("localhost", "127.0.0.1", "minio")


def _part(text: Column, pattern: str, index: int) -> Column:
    return F.regexp_extract(text, pattern, index)


def _origin(text: Column) -> Column:
    """scheme://authority of an absolute http(s) URL, NULL for anything else."""
    return F.when(
        text.rlike(_ORIGIN),
        F.concat(F.lower(_part(text, _ORIGIN, 1)), F.lit("://"), _part(text, _ORIGIN, 2)),
    )


def resolve_url(base: Column, url: Column) -> Column:
    """Absolute form of ``url``; NULL where a relative URL meets a base that is not absolute."""
    text = strip(F.coalesce(url, F.lit("")))
    return F.when(
        text.startswith("/"), F.concat(_origin(strip(base)), text)
    ).otherwise(text)


def resolve_url_error(base: Column, url: Column) -> Column:
    return F.when(resolve_url(base, url).isNull(), "relative URL needs a base with scheme and host")


def rewrite_origin(url: Column, origin: Column) -> Column:
    """Struct of ``url`` with its origin replaced, the ``host`` header that keeps the old
    authority, and ``error``. A blank origin changes nothing."""
    new = F.regexp_replace(strip(F.coalesce(origin, F.lit(""))), r"/+\z", "")
    keep = new == ""
    absolute = url.rlike(_ORIGIN)
    query = _part(url, _URL, 4)
    fragment = _part(url, _URL, 5)
    moved = F.concat(
        _origin(new),
        _part(url, _URL, 3),
        F.when(F.length(query) > 1, query).otherwise(""),
        F.when(F.length(fragment) > 1, fragment).otherwise(""),
    )
    error = (
        F.when(keep, None)
        .when(~absolute, "URL is not absolute")
        .when(_origin(new).isNull(), "origin is not absolute http(s)")
    )
    return F.struct(
        F.when(keep, url).when(error.isNull(), moved).alias("url"),
        F.when(~keep & error.isNull(), _part(url, _ORIGIN, 2)).alias("host"),
        error.alias("error"),
    )


def upload_request(base: Column, url: Column, origin: Column) -> Column:
    """Resolve a signed URL against the service, then move it to another origin."""
    resolved = resolve_url(base, url)
    moved = rewrite_origin(resolved, origin)
    return F.struct(
        moved["url"].alias("url"),
        moved["host"].alias("host"),
        F.coalesce(resolve_url_error(base, url), moved["error"]).alias("error"),
    )


def host_in_domains(url: Column, domains: Sequence[str] = ()) -> Column:
    """True when the host is one of ``domains`` or below one of them."""
    host = F.lower(_part(url, _HOST, 1))
    names = [d.strip().lower() for d in domains if d.strip()] or list(DIRECT_HOSTS)
    found = host.isin(*names)
    for name in names:
        found = found | host.endswith(f".{name}")
    return (host != "") & found
