"""First-match-wins rules as data.

A rule list is an ordered tuple of (SQL predicate, label). It compiles to one
CASE expression, so it stays inside whole-stage codegen and can be replaced by
a caller without touching an operator. A predicate that is NULL does not match.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    cases: tuple[tuple[str, Any], ...]
    otherwise: Any

    def column(self) -> Column:
        (first, label), *rest = self.cases
        out = F.when(F.expr(first), F.lit(label))
        for predicate, label in rest:
            out = out.when(F.expr(predicate), F.lit(label))
        return out.otherwise(F.lit(self.otherwise))


def below(column: str, limits: Iterable[tuple[float, str]], otherwise: str) -> Rules:
    """Rules for 'smaller than the first limit that fits'."""
    return Rules(tuple((f"{column} < {limit}", label) for limit, label in limits), otherwise)


def at_least(column: str, limits: Iterable[tuple[float, str]], otherwise: str) -> Rules:
    """Rules for 'reaches the first limit that fits', limits from high to low."""
    return Rules(tuple((f"{column} >= {limit}", label) for limit, label in limits), otherwise)


def above(column: str, limits: Iterable[tuple[float, str]], otherwise: str) -> Rules:
    """Rules for 'exceeds the first limit that fits', limits from high to low."""
    return Rules(tuple((f"{column} > {limit}", label) for limit, label in limits), otherwise)


def flag(predicate: str) -> Rules:
    """True where the predicate holds; false where it does not or is NULL."""
    return Rules(((predicate, True),), False)
