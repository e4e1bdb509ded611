"""Filling text templates from columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill(template: str, **values: Column) -> Column:
    """Put columns in the place of ``{name}`` marks; a NULL reads ``None``.

    Braces around anything but a given name are plain text.
    """
    marks = re.compile("\\{(" + "|".join(values) + ")\\}")
    parts = marks.split(template)
    return F.concat(
        *[
            F.coalesce(values[part].cast("string"), F.lit("None")) if i % 2 else F.lit(part)
            for i, part in enumerate(parts)
            if i % 2 or part
        ]
    )


def messages(system: Column, user: Column) -> Column:
    """A two-message chat as ``array<struct<role, content>>``."""
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )
