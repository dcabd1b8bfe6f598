"""Data contracts: declare rules, evaluate them in one pass over each table.

Rules without keys are counted in one aggregate. With uniqueness rules the aggregate has two levels: rows are
grouped by key with the failures of all row rules summed on the way, and the groups are summed to totals. Several
keys are grouping sets of that one pass. Only results (one row per rule) ever leave the executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ("table_name", "column_name", "rule", "failing_rows", "status")


class ContractViolation(AssertionError):
    """Raised by ``enforce`` when any rule failed."""


@dataclass(frozen=True)
class Rule:
    """A named rule. ``failing`` marks bad rows; ``unique_over`` asks for distinct keys."""

    column: str
    name: str
    failing: Column | None = field(default=None, compare=False)
    unique_over: tuple[str, ...] = ()


def not_null(col: str) -> Rule:
    return Rule(col, "not_null", F.col(col).isNull())


def unique(cols: str | Sequence[str]) -> Rule:
    keys = (cols,) if isinstance(cols, str) else tuple(cols)
    return Rule(",".join(keys), "unique", unique_over=keys)


def accepted_range(col: str, lo=None, hi=None, inclusive: bool = True) -> Rule:
    """Values below ``lo`` or above ``hi`` fail (also equal ones if not inclusive); NULL passes."""
    c, bad = F.col(col), F.lit(False)
    if lo is not None:
        bad = bad | ((c < lo) if inclusive else (c <= lo))
    if hi is not None:
        bad = bad | ((c > hi) if inclusive else (c >= hi))
    return Rule(col, "accepted_range", bad)


def accepted_values(col: str, values: Sequence) -> Rule:
    return Rule(col, "accepted_values", ~F.col(col).isin(*values))


def _status(failing: Column) -> Column:
    return F.when(failing == 0, "PASS").otherwise("FAIL")


def check(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Evaluate ``rules`` and return ``(table_name, column_name, rule, failing_rows, status)``.

    For ``unique``, ``failing_rows`` is the number of keys that occur more than once
    (keys with a NULL part are ignored).
    """
    keyed = [r for r in rules if r.unique_over]
    counted = _counted_by_key(df, rules, keyed) if keyed else df.agg(*[F.count_if(r.failing).alias(f"r{i}") for i, r in enumerate(rules)])
    results = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.name).alias("rule"),
            F.col(f"r{i}").alias("failing_rows"),
            _status(F.col(f"r{i}")).alias("status"),
        )
        for i, r in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*results))).select(*RESULT_COLUMNS)


def _counted_by_key(df: DataFrame, rules: Sequence[Rule], keyed: Sequence[Rule]) -> DataFrame:
    """One row: failures of rule ``i`` as ``r{i}``. Each row meets one group for each key, its flags the first of them only."""
    flags = {i: F.coalesce(r.failing, F.lit(False)).cast("bigint").alias(f"f{i}") for i, r in enumerate(rules) if not r.unique_over}
    keys = []
    for j, r in enumerate(keyed):
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in r.unique_over])
        keys.append(F.when(whole, F.struct(*[F.col(c) for c in r.unique_over])).alias(f"k{j}"))
    names = [f"k{j}" for j in range(len(keyed))]
    rows = df.select(*keys, *flags.values())
    grouped = rows.groupBy(*names) if len(names) == 1 else rows.groupingSets([[n] for n in names], *names)
    which = F.lit(0) if len(names) == 1 else reduce(lambda acc, j: F.when(F.grouping(names[j]) == 0, F.lit(j)).otherwise(acc), range(len(names)), F.lit(-1))
    groups = grouped.agg(which.alias("_set"), F.count(F.lit(1)).alias("_size"), *[F.sum(f"f{i}").alias(f"f{i}") for i in flags])
    total = lambda c: F.coalesce(F.sum(F.when(F.col("_set") == 0, F.col(c))), F.lit(0))
    repeated = lambda j: F.count_if((F.col("_set") == j) & F.col(f"k{j}").isNotNull() & (F.col("_size") > 1))
    places = {id(r): j for j, r in enumerate(keyed)}
    return groups.agg(*[(repeated(places[id(r)]) if r.unique_over else total(f"f{i}")).alias(f"r{i}") for i, r in enumerate(rules)])


def expectations(df: DataFrame, table: str, rows: int | None = None, nulls: Mapping[str, int] | None = None) -> DataFrame:
    """Known numbers against a table, all in one pass.

    ``rows`` is the exact row count; ``nulls`` gives known null counts per column, so that
    an expected drift passes and any change of it fails. Returns
    ``(table_name, check_name, expected, actual, mismatch, status)``.
    """
    wanted = [] if rows is None else [("row_count", rows, F.count(F.lit(1)))]
    wanted += [(f"{c}_nulls", n, F.count_if(F.col(c).isNull())) for c, n in (nulls or {}).items()]
    counted = df.agg(*[measure.alias(f"c{i}") for i, (_, _, measure) in enumerate(wanted)])
    results = []
    for i, (name, number, _) in enumerate(wanted):
        expected, actual = F.lit(number).cast("bigint"), F.col(f"c{i}")
        results.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("check_name"),
                expected.alias("expected"),
                actual.alias("actual"),
                (actual - expected).alias("mismatch"),
                F.when(actual == expected, "PASS").otherwise("FAIL").alias("status"),
            )
        )
    return counted.select(F.inline(F.array(*results)))


def expect_count(df: DataFrame, n: int, table: str) -> DataFrame:
    """Exact row-count check with the signed mismatch."""
    return expectations(df, table, rows=n)


def expect_null_count(df: DataFrame, col: str, n: int, table: str) -> DataFrame:
    """Expected-drift check: the null count of a column equals a known number."""
    return expectations(df, table, nulls={col: n})


def null_report(df: DataFrame, cols: Sequence[str], table: str) -> DataFrame:
    """Null count and percentage per column, expected to be zero; one pass."""
    total = F.count(F.lit(1)).alias("total_rows")
    counted = df.agg(total, *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    results = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col(f"c{i}").alias("null_rows"),
            F.coalesce(F.try_divide(F.col(f"c{i}") * 100.0, "total_rows"), F.lit(0.0)).alias("null_pct"),
            _status(F.col(f"c{i}")).alias("status"),
        )
        for i, c in enumerate(cols)
    ]
    return counted.select(F.inline(F.array(*results)))


def range_check(df: DataFrame, col: str, lo, hi, table: str) -> DataFrame:
    """Minimum and maximum of a column, and whether both lie in ``[lo, hi]``."""
    inside = (F.col("min_value") >= lo) & (F.col("max_value") <= hi)
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value")).select(
        F.lit(table).alias("table_name"),
        F.lit(col).alias("column_name"),
        "min_value",
        "max_value",
        F.when(F.coalesce(inside, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
    )


def verdict(results: DataFrame) -> DataFrame:
    """Overall status across checks; an empty result set passes."""
    failed = F.count_if(F.col("status") != "PASS")
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        failed.alias("failed_checks"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("overall_status"),
    )


def enforce(results: DataFrame) -> None:
    """Raise ``ContractViolation`` naming every failed check, if there are any (one row a rule)."""
    failed = results.filter(F.col("status") != "PASS").collect()
    if failed:
        raise ContractViolation("; ".join(str(row.asDict()) for row in failed))


def row_count_audit(targets: Sequence[tuple[str, DataFrame, int]]) -> DataFrame:
    """``expect_count`` over many tables: ``(name, frame, expected rows)``."""
    return reduce(DataFrame.unionByName, [expect_count(df, n, name) for name, df, n in targets])
