"""Column, table and file names. All of it runs while a plan is built, never per row."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the columns that are part of the stored table format.
SYSTEM_PREFIX = "$_"
HASH_COLUMN = "$_ref"
OPERATION = "$_operation"
TIMESTAMP = "$_timestamp"
LAST_UPDATED = "$_last_updated"
HISTORY_TIME = "$_sync_detected_at"
TAG_COLUMNS = ("$_operation", "$_timestamp", "$_last_updated")
CHANGELOG_COLUMNS = (
    "$_changelog_operation",
    "$_changelog_timestamp",
    "$_changelog_job_id",
    "$_changelog_row_type",
)
# End of fixed values.


def quote(name: str) -> str:
    """``name`` as an identifier in Spark SQL text."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The column called ``name``, whatever characters are in it."""
    return F.col(quote(name))


def data_columns(columns: list[str]) -> list[str]:
    """``columns`` without the system columns."""
    return [c for c in columns if not c.startswith(SYSTEM_PREFIX)]


def is_internal_column(name: str, drop_numbered: bool = True) -> bool:
    """Leading underscore, or (``drop_numbered``) the numbered twin that a join leaves behind."""
    return name.startswith("_") or (drop_numbered and re.search(r"_[0-9]+$", name) is not None)


def sanitize_name(name: str) -> str:
    """A model name as a table name."""
    return re.sub(r"[^A-Za-z0-9_]", "_", name).lower()


def unique_names(names: list[str]) -> list[str]:
    """``names`` with repeats numbered: a second ``v`` becomes ``v_1``, a third ``v_2``."""
    taken = {n.lower() for n in names}
    seen: set[str] = set()
    out = []
    for name in names:
        candidate, number = name, 0
        while candidate.lower() in seen or (number and candidate.lower() in taken):
            number += 1
            candidate = f"{name}_{number}"
        seen.add(candidate.lower())
        out.append(candidate)
    return out


def wildcard_to_regex(pattern: str) -> str:
    """A file wildcard as a regular expression that may match anywhere in the name."""
    translated = {".": r"\.", "*": ".*", "?": "."}
    return "".join(translated.get(ch, ch) for ch in pattern)


def expand_file_name(template: str, now: dt.datetime, model_name: str = "export") -> str:
    """Fill ``{date}``, ``{timestamp}`` (epoch milliseconds) and ``{model_name}`` in a file name."""
    moment = now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)
    values = {
        "{date}": moment.date().isoformat(),
        "{timestamp}": str(int(moment.timestamp() * 1000)),
        "{model_name}": model_name,
    }
    for placeholder, value in values.items():
        template = template.replace(placeholder, value)
    return template
