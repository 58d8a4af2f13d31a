"""Import states, HTTP results and retry delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

# Import status words. The terminal set is the narrower one on purpose:
# "ready" and "done" end a wait but do not release a local state.
SUCCESS_STATUSES = ("succeeded", "success", "completed", "complete", "ready", "done")
FAILED_STATUSES = ("failed", "error", "cancelled", "canceled")
TERMINAL_STATUSES = (
    "succeeded",
    "success",
    "completed",
    "complete",
    "failed",
    "error",
    "cancelled",
    "canceled",
)
# HTTP codes worth another attempt, and those that mean a rejected identity.
TRANSIENT_CODES = (408, 429, 500, 502, 503, 504)
AUTH_CODES = (401, 403)
AUTH_RETURN_CODES = (22, 401, 403)
AUTH_TEXTS = ("token_expired", "unauthorized", "returned error: 401")


def import_status_class(status: Column) -> Column:
    """``success``, ``failed`` or ``pending``."""
    word = F.lower(strip(status))
    return (
        F.when(word.isin(*SUCCESS_STATUSES), "success")
        .when(word.isin(*FAILED_STATUSES), "failed")
        .otherwise("pending")
    )


def is_terminal(status: Column) -> Column:
    return F.coalesce(F.lower(status).isin(*TERMINAL_STATUSES), F.lit(False))


def is_transient_status(code: Column) -> Column:
    return code.isin(*TRANSIENT_CODES)


def retry_delay(policy: str, attempt: Column, base: Column | float = 0.25) -> Column:
    """Seconds to wait after a failed attempt, without jitter.

    ``json`` and ``batch_complete`` count attempts from 0, ``put`` from 1.
    """
    if policy == "json":
        return F.least(F.lit(15.0), 0.8 * F.pow(F.lit(2.0), attempt))
    if policy == "batch_complete":
        return F.least(F.lit(30.0), 2.0 * (attempt + 1))
    if policy == "put":
        start = F.lit(base) if isinstance(base, (int, float)) else base
        return F.least(
            F.lit(30.0), F.greatest(F.lit(0.1), start) * F.pow(F.lit(2.0), attempt - 1)
        )
    raise ValueError(f"unknown retry policy: {policy}")


def is_auth_failure(code: Column, text: Column) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    found = F.coalesce(code.isin(*AUTH_CODES), F.lit(False))
    for part in AUTH_TEXTS:
        found = found | lowered.contains(part)
    return found


def is_auth_result(return_code: Column, text: Column) -> Column:
    """The same test for a finished command, which counts only with certain return codes.

    The return code opens the gate; it is not itself an HTTP code, so the text decides.
    """
    gate = F.coalesce(return_code.isin(*AUTH_RETURN_CODES), F.lit(False))
    return gate & is_auth_failure(F.lit(None).cast("int"), text)


def error_message(detail: Column, reason: Column, status: Column, url: Column) -> Column:
    """One line describing a failed call."""
    raw = strip(F.coalesce(detail, F.lit("")))
    parsed = F.try_parse_json(raw)

    def field(name: str) -> Column:
        found = strip(F.try_variant_get(parsed, f"$.error.{name}", "string"))
        return F.nullif(found, F.lit(""))

    message = F.coalesce(field("message"), F.nullif(raw, F.lit("")), reason)
    return F.concat_ws(
        " | ",
        F.concat(F.lit("Error: "), message),
        F.concat(F.lit("HTTP "), status.cast("string"), F.lit(" "), reason),
        F.concat(F.lit("correlation_id="), field("correlation_id")),
        url,
    )
