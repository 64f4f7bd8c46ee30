"""Classification of API error logs by rule."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline import fixed

THROTTLED = "ThrottlingException"


class Rule(NamedTuple):
    """``error`` is an error type, or an error code where ``by_code``; ``policy`` None is any."""

    api: str
    error: str
    by_code: bool
    policy: str | None
    target: str | None
    action: str


# How each API's errors are reported to a consumer. The first match counts.
RULES = (
    Rule("DescribeStream", "InternalServerError", False, None, "ServiceError", "translate"),
    Rule("DescribeStream", "ResourceNotFound", False, None, "ResourceNotFound", "translate"),
    Rule("DescribeStream", THROTTLED, True, None, "LimitExceeded", "translate"),
    Rule("GetRecords", "ExpiredIterator", False, None, "ExpiredIterator", "translate"),
    Rule("GetRecords", "InternalServerError", False, None, "ServiceError", "translate"),
    Rule("GetRecords", "LimitExceeded", False, None, "ProvisionedThroughputExceeded", "translate"),
    Rule("GetRecords", "ResourceNotFound", False, None, "ResourceNotFound", "translate"),
    Rule("GetRecords", THROTTLED, True, None, "ProvisionedThroughputExceeded", "translate"),
    Rule("GetRecords", "TrimmedDataAccess", False, "skip", "ExpiredIterator", "translate"),
    Rule("GetRecords", "TrimmedDataAccess", False, "retry", "UnableToReadMoreRecords", "stop"),
    Rule("GetShardIterator", "InternalServerError", False, None, "ServiceError", "translate"),
    Rule("GetShardIterator", "ResourceNotFound", False, "skip", "ResourceNotFound", "translate"),
    Rule("GetShardIterator", "ResourceNotFound", False, "retry", "UnableToReadMoreRecords", "stop"),
    Rule("GetShardIterator", THROTTLED, True, None, "ProvisionedThroughputExceeded", "translate"),
    Rule("GetShardIterator", "TrimmedDataAccess", False, "skip", None, "reread_from_trim_horizon"),
    Rule("GetShardIterator", "TrimmedDataAccess", False, "retry", "UnableToReadMoreRecords", "stop"),
    Rule("ListStreams", "InternalServerError", False, None, "ServiceError", "translate"),
    Rule("ListStreams", "ResourceNotFound", False, None, "ServiceError", "translate"),
    Rule("ListStreams", THROTTLED, True, None, "LimitExceeded", "translate"),
)


def classify_api_errors(errors: DataFrame, skip_policy: str = "skip") -> DataFrame:
    """Adds ``target_error`` and ``action`` to rows of api, error_type, error_code, message, ...

    Rules are one conditional expression, evaluated in the scan's stage. Unmatched rows pass
    through. A missing message becomes empty text. With an ``iterator_type`` column, trimmed data
    met while already reading from TRIM_HORIZON is not read again but reported as not found.
    """
    if skip_policy not in ("skip", "retry"):
        raise ValueError("skip_policy must be 'skip' or 'retry'")
    target, action = F.col("error_type"), F.lit("pass_through")
    for rule in reversed(RULES):
        if rule.policy not in (None, skip_policy):
            continue
        found = F.col("error_code" if rule.by_code else "error_type") == rule.error
        match = (F.col("api") == rule.api) & found
        hit_target, hit_action = F.lit(rule.target).cast("string"), F.lit(rule.action)
        if rule.action == "reread_from_trim_horizon" and "iterator_type" in errors.columns:
            again = F.coalesce(F.col("iterator_type") == fixed.TRIM_HORIZON, F.lit(False))
            hit_target = F.when(again, "ResourceNotFound")
            hit_action = F.when(again, "translate").otherwise(rule.action)
        target = F.when(match, hit_target).otherwise(target)
        action = F.when(match, hit_action).otherwise(action)
    return errors.withColumns(
        {
            "message": F.coalesce("message", F.lit("")),
            "target_error": target,
            "action": action,
        }
    )
