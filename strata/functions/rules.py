"""The envelope validation rules, declared once.

One ordered list drives every form of the check:

* ``validation_reason`` -- the first failing rule (batch Bronze, F3);
* ``rule_errors`` -- every failing rule, in the same order (F4); its first
  entry (``first_error``) equals ``validation_reason``;
* the outcome text of ``strata.operators.bronze.message_outcome`` (F7).

Accepted and quarantined rows are split on ``validation_reason`` being null,
so the two sinks are complementary by construction: every predicate here is
null-safe and returns true or false, never null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.columns import is_blank

# Parse-failure reasons.
PARSE_INVALID_JSON = "JSON deserialization failure"
PARSE_EMPTY = "Envelope parse failure"
PARSE_NULL = "Envelope deserialized to null"


@dataclass(frozen=True)
class Rule:
    field: str
    kind: str  # "required" (not blank) or "positive" (integer > 0)
    message: str

    def fails(self, envelope: Column) -> Column:
        value = envelope[self.field]
        if self.kind == "required":
            return is_blank(value)
        if self.kind == "positive":
            return value.isNull() | (value <= 0)
        raise ValueError(f"unknown rule kind {self.kind!r}")


# Rule order and messages.
RULES: tuple[Rule, ...] = (
    Rule("SchemaVersion", "required", "SchemaVersion is required"),
    Rule("Source", "required", "Source is required"),
    Rule("EntityType", "required", "EntityType is required"),
    Rule("LeagueId", "positive", "LeagueId must be greater than zero"),
    Rule("Season", "positive", "Season must be greater than zero"),
    Rule("CorrelationId", "required", "CorrelationId is required"),
    Rule("Endpoint", "required", "Endpoint is required"),
    Rule("RequestKey", "required", "RequestKey is required"),
    Rule("SourceEntityId", "required", "SourceEntityId is required"),
    Rule("PayloadJson", "required", "PayloadJson is required"),
)


def parse_failure(raw: Column, envelope: Column, corrupt_field: str = "_corrupt_record") -> Column:
    """Why the message text could not be read as an envelope, or null.

    ``from_json`` yields a null struct only for null, empty or blank text;
    anything else that is not a well-typed object (garbage, a truncated
    object, JSON ``null``, an array, a wrong-typed field) yields a struct
    whose corrupt-record field holds the text.
    """
    corrupt = envelope[corrupt_field]
    return (
        F.when(envelope.isNull(), F.lit(PARSE_EMPTY))
        .when(corrupt.isNotNull() & (F.trim(corrupt) == "null"), F.lit(PARSE_NULL))
        .when(corrupt.isNotNull(), F.lit(PARSE_INVALID_JSON))
    )


def first_error(errors: Column) -> Column:
    """The first entry of an error list built by ``rule_errors``: equal to
    ``validation_reason`` (null for an empty list)."""
    return F.get(errors, 0)


def rule_errors(parse_reason: Column, envelope: Column, rules=RULES) -> Column:
    """Every failing check as an array (empty when the envelope is valid).

    A parse failure stands alone, since no field can be judged then.  Built
    as a ``concat`` of one-element arrays rather than ``filter`` with a
    lambda: higher-order functions drop the projection out of generated
    code."""
    empty = F.array().cast("array<string>")
    each = [F.when(r.fails(envelope), F.array(F.lit(r.message))).otherwise(empty) for r in rules]
    return F.when(parse_reason.isNotNull(), F.array(parse_reason)).otherwise(F.concat(*each))
