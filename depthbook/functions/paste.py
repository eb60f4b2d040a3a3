"""Reading pasted inventory lines with one regular expression inside Spark."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from depthbook.functions.constants import (
    PASTE_RULES,
    PASTE_RULES_WITHOUT_COMMAS,
    PASTE_SKIP,
    PASTE_TRIM,
)

# (?d): only \n ends a line, so a dot also matches \r and the like.
_LINES = "(?d)"
_SEPARATOR = "\x01"


def clean_line(line: Column) -> Column:
    """Lower case, without separators between digits, trimmed."""
    text = F.regexp_replace(line, r"(\d),(\d)", "$1$2")
    text = F.regexp_replace(text, r"(\d)\.(\d)", "$1$2")
    return F.trim(F.lower(text), F.lit(PASTE_TRIM))


def is_skipped(line: Column) -> Column:
    return F.lower(line).contains(PASTE_SKIP)


def rule_number(clean: Column) -> Column:
    """Number (from 1) of the first rule that matches."""
    return F.coalesce(
        *[
            F.when(clean.rlike(_LINES + pattern), F.lit(number))
            for number, (pattern, _, _) in enumerate(PASTE_RULES, start=1)
        ]
    )


def _all_rules() -> tuple[str, str]:
    """One pattern that tries the rules in order, and a replacement text.

    Groups of rules that did not match are empty, so the replacement lists the
    groups of all rules: quantities, quantities that lose their commas, names.
    """
    alternatives, plain, with_commas, names = [], "", "", ""
    groups_before = 0
    for number, (pattern, name, quantity) in enumerate(PASTE_RULES, start=1):
        alternatives.append(f"{pattern}.*")
        names += f"${groups_before + name}"
        if quantity is not None:
            reference = f"${groups_before + quantity}"
            if number in PASTE_RULES_WITHOUT_COMMAS:
                with_commas += reference
            else:
                plain += reference
        groups_before += re.compile(pattern).groups
    return _LINES + "|".join(alternatives), _SEPARATOR.join([plain, with_commas, names])


def read_line(clean: Column) -> Column:
    """[quantity text, quantity text with commas, name] of a cleaned line."""
    pattern, fields = _all_rules()
    return F.split(F.regexp_replace(clean, pattern, fields), _SEPARATOR, 3)


def quantity_text(fields: Column) -> Column:
    plain, with_commas = F.get(fields, F.lit(0)), F.get(fields, F.lit(1))
    return (
        F.when(plain != "", plain)
        .when(with_commas != "", F.replace(with_commas, F.lit(","), F.lit("")))
        .otherwise("1")
    )


def item_name(fields: Column) -> Column:
    # Never NULL, so a join on the name needs no NULL test that would read the line again.
    return F.coalesce(F.get(fields, F.lit(2)), F.lit(""))


def leading_number(text: Column) -> Column:
    """The number a text starts with, 0 if it starts with none."""
    digits = F.regexp_extract(text, r"^([0-9]+\.?[0-9]*|\.[0-9]+)", 1)
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))
