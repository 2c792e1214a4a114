"""Classification of enrichment API calls from a table of raw responses.

Input columns: ``error_kind`` ('timeout', 'other' or NULL when the request
completed), ``http_status``, ``reason`` (status text or client error) and
``body`` (JSON text).  The order of the branches matters: a client failure
wins over any status, 429 over the 5xx test, and only a 200 body is read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, truncate

# Outcome labels and messages.
FOUND = "found"
NOT_FOUND = "not_found"
ERR_5XX = "error_5xx"
ERR_429 = "error_429"
ERR_TIMEOUT = "error_timeout"
ERR_OTHER = "error_other"
OUTCOMES = (FOUND, NOT_FOUND, ERR_5XX, ERR_429, ERR_TIMEOUT, ERR_OTHER)
MSG_TIMEOUT = "request timed out"
MSG_RATE_LIMIT = "rate limit"
MSG_BAD_SHAPE = "unexpected response shape"
CLIENT_ERROR_CHARS = 200
SINK_ERROR_CHARS = 500


def _response_flag(body: Column) -> Column:
    return F.get_json_object(body, "$.Response")


def classify(error_kind="error_kind", http_status="http_status",
             reason="reason", body="body") -> tuple[Column, Column, Column]:
    """(outcome, http_status, error_message) columns of one API call."""
    ek, hs, rs, bd = (col_of(error_kind), col_of(http_status), col_of(reason), col_of(body))
    flag = _response_flag(bd)
    outcome = (F.when(ek == "timeout", F.lit(ERR_TIMEOUT))
               .when(ek.isNotNull(), F.lit(ERR_OTHER))
               .when(hs == 429, F.lit(ERR_429))
               .when(hs >= 500, F.lit(ERR_5XX))
               .when(hs != 200, F.lit(ERR_OTHER))
               .when(flag == "True", F.lit(FOUND))
               .when(flag == "False", F.lit(NOT_FOUND))
               .otherwise(F.lit(ERR_OTHER)))
    status = F.when(ek.isNotNull(), F.lit(None).cast("int")).otherwise(hs.cast("int"))
    message = (F.when(ek == "timeout", F.lit(MSG_TIMEOUT))
               .when(ek.isNotNull(), truncate(rs, CLIENT_ERROR_CHARS))
               .when(hs == 429, F.lit(MSG_RATE_LIMIT))
               .when(hs != 200, rs)
               .when(flag == "True", F.lit(None).cast("string"))
               .when(flag == "False", F.get_json_object(bd, "$.Error"))
               .otherwise(F.lit(MSG_BAD_SHAPE)))
    return outcome, status, message


def remap_failed_write(outcome: Column | str, message: Column | str,
                       write_ok: Column | str, write_error: Column | str) -> tuple[Column, Column]:
    """A found / not_found document whose write failed is logged as error_other."""
    o, m, ok, we = col_of(outcome), col_of(message), col_of(write_ok), col_of(write_error)
    failed = o.isin(FOUND, NOT_FOUND) & (ok == F.lit(False))
    new_outcome = F.when(failed, F.lit(ERR_OTHER)).otherwise(o)
    new_message = F.when(
        failed,
        truncate(F.concat(F.lit("write failed (orig outcome="), o, F.lit("): "),
                          F.coalesce(we, F.lit(""))), SINK_ERROR_CHARS)).otherwise(m)
    return new_outcome, new_message
