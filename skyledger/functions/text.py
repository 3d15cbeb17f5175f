"""URL helpers used by triage, error messages and logs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def url_param(url: Column, name: str, missing: str = "unknown") -> Column:
    """Text after the first ``name=`` up to the next ``&``."""
    tail = F.get(F.split(url, rf"\Q{name}=\E", 3), F.lit(1))
    has_value = ~tail.rlike("^&*$")
    return F.coalesce(F.when(has_value, F.substring_index(tail, "&", 1)), F.lit(missing))


def redact_param(url: Column, name: str, mask: str = "***") -> Column:
    """Replace the value of every ``name=`` parameter."""
    return F.regexp_replace(url, rf"\Q{name}=\E[^&]*", f"{name}={mask}")
