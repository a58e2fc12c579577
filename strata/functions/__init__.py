"""Column expressions shared by the operators (all built-in functions)."""

from strata.functions.columns import is_blank, not_blank, status_category
from strata.functions.rules import (
    PARSE_EMPTY,
    PARSE_INVALID_JSON,
    PARSE_NULL,
    RULES,
    Rule,
    parse_failure,
    rule_errors,
)

__all__ = [
    "PARSE_EMPTY", "PARSE_INVALID_JSON", "PARSE_NULL", "RULES", "Rule", "is_blank",
    "not_blank", "parse_failure", "rule_errors", "status_category",
]
