"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import ENVIRONMENT_DEFAULT, PROJECT_DEFAULT


def full_name(first: Column | str = "first_name", last: Column | str = "last_name") -> Column:
    """``concat_ws`` skips nulls; both null gives ''."""
    return F.concat_ws(" ", first, last)


def email_domain(email: Column | str = "email") -> Column:
    """Text after the first '@'; '' when there is none, null for a null email."""
    return F.regexp_extract(F.col(email) if isinstance(email, str) else email, "@(.+)", 1)


def job_full_name(
    job: Column | str, project: str = PROJECT_DEFAULT, environment: str = ENVIRONMENT_DEFAULT
) -> Column:
    j = F.col(job) if isinstance(job, str) else job
    return F.format_string("%s-%s-%s", F.lit(project), j, F.lit(environment))


def nested_or(c: Column | str, default: str = "") -> Column:
    """A nested field with a default when the path is missing or null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(default))
