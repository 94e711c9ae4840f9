"""Ordered rules and value mappings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.config.rules import BRANCH_DIVISIONS, NO_DIVISION, SERVICE_LINES

Rule = tuple[str, Sequence[str], str]


def matches(col: Column, kind: str, values: Sequence[str]) -> Column:
    """Whether a value meets a rule: ``in`` is one of the ids, ``like`` any of the patterns."""
    return col.isin(*values) if kind == "in" else reduce(Column.__or__, [col.like(v) for v in values])


def first_match(col: Column, rules: Sequence[Rule], default: str) -> Column:
    """CASE over the rules in order; null and unmatched values give the default."""
    if not rules:
        return F.lit(default)
    (kind, values, result), *rest = rules
    case = F.when(matches(col, kind, values), result)
    case = reduce(lambda acc, rule: acc.when(matches(col, rule[0], rule[1]), rule[2]), rest, case)
    return case.otherwise(default)


def classify(df: DataFrame, col: str, rules: Sequence[Rule], out: str, default: str = NO_DIVISION) -> DataFrame:
    return df.withColumn(out, first_match(F.col(col), rules, default))


def map_with_fallback(col: Column, groups: Mapping[str, str], fallback: Column) -> Column:
    """What a value is mapped to, compared without regard to case; else the fallback."""
    lowered = F.lower(col)
    result = fallback
    for group in sorted(set(groups.values())):
        members = [m.lower() for m, g in groups.items() if g == group]
        result = F.when(lowered.isin(*members), F.lit(group)).otherwise(result)
    return result


def with_group_count(df: DataFrame, keys: Sequence[str], out: str = "frequency") -> DataFrame:
    """Distinct keys with their row count; counts are combined before the shuffle.

    As in a correlated count of the key itself, a null key keeps a null count.
    """
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return counted.withColumn(out, F.when(known, F.col(out)))


def branch_lines(claims: DataFrame, branch: str, rules=BRANCH_DIVISIONS, lines=SERVICE_LINES) -> DataFrame:
    """Distinct branches with division, service line and number of claims.

    The rules run on the distinct branches after the count, not on every claim.
    """
    counted = with_group_count(claims.select(branch), [branch])
    divided = classify(counted, branch, rules, "division")
    own_name = F.when(F.col("division") == NO_DIVISION, F.col(branch)).otherwise(F.col("division"))
    return divided.withColumn("service_line", map_with_fallback(F.col("division"), lines, own_name)).select(
        branch, "division", "service_line", "frequency"
    )
