"""Ordered (condition, code) rules rendered as one array<string> column."""

import re
from collections.abc import Sequence
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


RULES_PER_LIST = 5


class Rule(NamedTuple):
    code: str
    condition: Column


def tag(rules: Sequence[Rule]) -> Column:
    """Codes of all rules whose condition is true, in rule order.

    A NULL condition yields no code.  No rules, or none firing, gives ``[]``.  The
    conditions only set bits of a number, and the number picks one of the possible code
    lists, which are literals.  No array is built per record, and the generated code
    stays small: past 8000 bytes a method is no longer compiled by the JVM, and a stage
    that carries two dozen rules and projections gets there when arrays are assembled in
    place.  Lists are kept to a few rules each, since their number doubles with each."""
    parts = [
        _pick(rules[start : start + RULES_PER_LIST])
        for start in range(0, len(rules), RULES_PER_LIST)
    ]
    if not parts:
        return F.array().cast("array<string>")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _pick(rules: Sequence[Rule]) -> Column:
    lists = [
        [rule.code for bit, rule in enumerate(rules) if fired >> bit & 1]
        for fired in range(1 << len(rules))
    ]
    # As one piece of SQL text, since each Column call would cross to the JVM.
    literals = ", ".join(f"array({', '.join(map(_quoted, codes))})" for codes in lists)
    fired = reduce(
        add, [F.when(rule.condition, 1 << bit).otherwise(0) for bit, rule in enumerate(rules)]
    )
    return F.get(F.expr(f"cast(array({literals}) AS array<array<string>>)"), fired)


def _quoted(code: str) -> str:
    if not re.fullmatch("[A-Za-z0-9_]+", code):
        raise ValueError(f"not a plain rule code: {code!r}")
    return f"'{code}'"
