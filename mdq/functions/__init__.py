"""Column-level helpers shared by the rules (all JVM-side built-ins)."""

from mdq.functions.checks import (  # noqa: F401
    RESULT_COLUMNS, any_date, as_of_col, dates_of, first_match, is_blank, is_missing, ok_only_if, per_date, result,
)
from mdq.functions.scope import active_pir, contains_scope, kinaxis, prefix_scope  # noqa: F401
