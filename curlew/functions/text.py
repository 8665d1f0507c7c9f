"""Column expressions over entity keys: validation rules and standardisation.

Everything here returns a Catalyst ``Column`` so it stays inside whole-stage
codegen; nothing is evaluated row by row in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace class collapsed by text standardisation
# (tab, newline, vertical tab, form feed, carriage return, space). Written as
# an explicit class so Java regex and RE2 (the SQL oracle) agree.
WHITESPACE_CLASS = r"[\t\n\x0B\f\r ]+"

# Control characters that make a text entity invalid.
CONTROL_CLASS = r"[\x00-\x08\x0E-\x1F]"

# Characters allowed in a line-notation (SMILES-like) key.
LINE_NOTATION_CHARSET = r"^[A-Za-z0-9@+\-\[\]\(\)=#$%/\\.:*~]+$"


def collapse_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, WHITESPACE_CLASS, " "))


def text_key(c: Column) -> Column:
    """Canonical text key: whitespace runs -> one space, trimmed, lower-case.
    Null in, null out; a blank text gives null (standardisation failure)."""
    k = F.lower(collapse_ws(c))
    return F.when(F.length(k) > 0, k)


def fragment_key(c: Column, sep: str = ".") -> Column:
    """Keep the largest fragment of a dot-separated key (the parent after a
    salt strip); ties go to the lexicographically smallest fragment."""
    frags = F.filter(F.split(F.trim(c), "[" + sep + "]"), lambda f: F.length(f) > 0)
    ranked = F.array_sort(F.transform(frags, lambda f: F.struct(
        (-F.length(f)).alias("neg_len"), f.alias("frag"))))
    return F.when(F.size(frags) > 0, F.element_at(ranked, 1).getField("frag"))


def count_char(c: Column, ch: str) -> Column:
    """Occurrences of one literal character (length difference after removal)."""
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def text_rules(min_chars: int = 20, min_letter_share: float = 0.5) -> list[tuple[str, Column]]:
    """Rule table for free-text entities: (reason, violated-when predicate) on
    column ``__e``. Each predicate is null-safe (coalesced to False)."""
    e = F.col("__e")
    letters = F.length(F.regexp_replace(e, r"[^\p{L}]", ""))
    non_ws = F.length(F.regexp_replace(e, WHITESPACE_CLASS, ""))
    return [
        ("null", e.isNull()),
        ("blank", F.length(collapse_ws(e)) == 0),
        ("too_short", F.length(collapse_ws(e)) < min_chars),
        ("control_chars", e.rlike(CONTROL_CLASS)),
        ("low_letter_share", letters < F.lit(min_letter_share) * non_ws),
    ]


def line_notation_rules() -> list[tuple[str, Column]]:
    """Rule table for SMILES-like keys: charset and balanced brackets."""
    e = F.col("__e")
    return [
        ("null", e.isNull()),
        ("blank", F.length(F.trim(e)) == 0),
        ("charset", ~e.rlike(LINE_NOTATION_CHARSET)),
        ("unbalanced_parens", count_char(e, "(") != count_char(e, ")")),
        ("unbalanced_brackets", count_char(e, "[") != count_char(e, "]")),
    ]


def reject_reasons(entity: Column, rules: list[tuple[str, Column]]) -> Column:
    """array<string> of the names of violated rules; empty = valid. Rules are
    written against the column ``__e``, which the caller sets to the entity."""
    flags = [F.when(F.coalesce(pred, F.lit(False)), F.lit(name)) for name, pred in rules]
    # array_except keeps rule order and stays in generated code (a lambda
    # filter would be interpreted, losing common-subexpression elimination)
    return F.array_except(F.array(*flags), F.array(F.lit(None).cast("string")))
