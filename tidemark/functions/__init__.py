from .casts import is_date_type, safe_cast, spark_type, zero_date_to_null
from .names import (
    CHANGELOG_COLUMNS,
    HASH_COLUMN,
    HISTORY_TIME,
    LAST_UPDATED,
    OPERATION,
    TAG_COLUMNS,
    TIMESTAMP,
    col,
    data_columns,
    expand_file_name,
    is_internal_column,
    quote,
    sanitize_name,
    unique_names,
    wildcard_to_regex,
)
from .numbers import number_key, number_key_column, value_key, value_key_column
from .text import row_hash, text_form
from .times import as_timestamp

__all__ = [name for name in dir() if not name.startswith("_")]
