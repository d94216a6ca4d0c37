"""Named data-quality rules, each a SQL expression over one row."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _holds(expression: str) -> Column:
    # A rule over NULL is NULL, and NOT NULL is NULL too: without this the row would fall out
    # of both sides of the split.
    return F.coalesce(F.expr(expression), F.lit(False))


def all_pass(rules: Mapping[str, str]) -> Column:
    """True when every rule holds, else false; never NULL."""
    return reduce(Column.__and__, (_holds(rule) for rule in rules.values()))


def failed_rules(rules: Mapping[str, str]) -> Column:
    """Ids of the broken rules, comma separated; empty when none is broken."""
    return F.concat_ws(",", *(F.when(~_holds(rule), F.lit(name)) for name, rule in rules.items()))
