"""Valid / reject split, keep-latest deduplication and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.columns import as_column

VALID_FLAG = "_is_valid"


def flag_valid(df: DataFrame, cond: Column) -> DataFrame:
    """Add ``_is_valid``; a rule that evaluates to NULL counts as not valid."""
    return df.withColumn(VALID_FLAG, F.coalesce(cond, F.lit(False)))


def split_valid(df: DataFrame, cond: Column, null_policy: str = "reject") -> tuple[DataFrame, DataFrame]:
    """Split into ``(valid, rejected)``.

    ``null_policy="reject"`` sends rows whose rule is NULL to ``rejected``, so the two
    outputs together are the input. ``null_policy="drop"`` keeps plain SQL filter
    semantics, under which such rows appear in neither output.
    """
    if null_policy == "reject":
        settled = F.coalesce(cond, F.lit(False))
    elif null_policy == "drop":
        settled = cond
    else:
        raise ValueError(f"null_policy must be 'reject' or 'drop', not {null_policy!r}")
    return df.filter(settled), df.filter(~settled)


def keep_latest(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column], row: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first under ``order_by``; ties go to the smaller hash of the whole row.

    The hash makes the winner the same in every run, whatever the order of the input.
    Catalyst turns ``row_number() <= 1`` into a group limit on both sides of the
    shuffle, so each task sends at most one row per key and a key that holds a large
    share of the table never gathers in one task. ``row`` names the columns of the hash, by default all.
    """
    if not order_by:
        raise ValueError("keep_latest needs an ordering")
    named = df.columns if row is None else row
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name in named and "map<" not in f.dataType.simpleString()]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by, F.xxhash64(*hashed)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def settle(flagged: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    """The newest valid row of each key and all rejected rows, with their flag, in one pass over the input.

    Each rejected row is a group of its own in the window that ranks valid rows, so all of them pass and the group
    limit before the shuffle holds for the others as in ``keep_latest``.
    """
    valid = F.col(VALID_FLAG)
    groups = [f"_key{i}" for i in range(len(keys))]
    own = {g: F.when(valid, as_column(k)) for g, k in zip(groups, keys, strict=True)} | {"_own": F.when(~valid, F.monotonically_increasing_id())}
    row = [c for c in flagged.columns if c != VALID_FLAG]
    return keep_latest(flagged.withColumns(own), [VALID_FLAG, *groups, "_own"], order_by, row).drop(*groups, "_own")


def reconcile(flagged: DataFrame, deduped: DataFrame) -> DataFrame:
    """One row: input = valid + rejected, and how many valid rows deduplication removed."""
    zero = F.lit(0).cast("bigint")
    before = flagged.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(VALID_FLAG).alias("valid_rows"),
        F.count_if(~F.col(VALID_FLAG)).alias("rejected_rows"),
    ).withColumn("kept_rows", zero)
    after = deduped.agg(F.count(F.lit(1)).alias("kept_rows")).withColumns(
        {c: zero for c in ("input_rows", "valid_rows", "rejected_rows")}
    )
    totals = before.unionByName(after).agg(*[F.sum(c).alias(c) for c in before.columns])
    return _reconciled(totals)


def reconcile_keys(flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``reconcile`` for a deduplication on ``keys``, without running the deduplication.

    Rows are combined per key before the shuffle; rejected rows collapse to one group,
    whatever their keys.
    """
    valid = F.col(VALID_FLAG)
    grouping = [F.when(valid, F.col(k)).alias(k) for k in keys]
    groups = flagged.groupBy(valid.alias(VALID_FLAG), *grouping).agg(F.count(F.lit(1)).alias("_rows"))
    rows = F.col("_rows")
    totals = groups.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(F.when(valid, rows)), F.lit(0)).alias("valid_rows"),
        F.coalesce(F.sum(F.when(~valid, rows)), F.lit(0)).alias("rejected_rows"),
        F.count_if(valid).alias("kept_rows"),
    )
    return _reconciled(totals)


def _reconciled(totals: DataFrame) -> DataFrame:
    return totals.select(
        "input_rows",
        "valid_rows",
        "rejected_rows",
        "kept_rows",
        (F.col("valid_rows") - F.col("kept_rows")).alias("removed_rows"),
        (F.try_divide("rejected_rows", "input_rows") * 100).alias("reject_rate_pct"),
    )
