"""Explicit schemas (DDL), so that no read spends a pass on inference."""

# One repository per JSON line; the second form carries an id instead of a name.
REPO_JSON = (
    "full_name STRING, pushed_at STRING, stargazers_count BIGINT, "
    "description ARRAY<STRING>, language STRING"
)
REPO_JSON_WITH_ID = (
    "id BIGINT, pushed_at STRING, stargazers_count BIGINT, "
    "description ARRAY<STRING>, language STRING"
)

# A search response: many repositories under one key.
ENVELOPE = (
    "items ARRAY<STRUCT<id BIGINT, full_name STRING, pushed_at STRING, "
    "stargazers_count BIGINT, description STRING, language STRING>>"
)

# Positions of the fields in the tab-separated and captured text forms.
TEXT_FIELDS = ("full_name", "pushed_at", "stargazers_count", "description", "language")

AB_TABLE = "A INT, B INT"
