"""Order-aware columns that do not put a whole group into one task.

Sheets and files are ordered, and one of them may hold a large share of all
rows. A plain window over ``(source, sheet)`` would sort such a group in a
single task. ``over_blocks`` therefore works in two levels:

1. rows are cut into blocks of ``block_rows`` consecutive order values and the
   window runs inside ``(keys, block)``;
2. every block is reduced to one summary row (partial aggregation, so only
   summaries are shuffled), the summaries are scanned per key, and the result
   is joined back on ``(keys, block)``, the partitioning the rows already have.

The order column must be an integer, unique per key and roughly dense (a line
number, a row index, a surrogate key). Key columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

DEFAULT_BLOCK_ROWS = 1 << 16
BLOCK_ROWS_SETTING = "spark.gridloom.blockRows"

_BLOCK = "__block"


def block_rows(spark: SparkSession) -> int:
    """Rows per block, from the session setting ``spark.gridloom.blockRows``."""
    return int(spark.conf.get(BLOCK_ROWS_SETTING, str(DEFAULT_BLOCK_ROWS)))


@dataclass(frozen=True)
class Ways:
    """One window in both directions."""

    up: WindowSpec
    down: WindowSpec

    @classmethod
    def of(cls, keys: Sequence[str], order: str) -> Ways:
        group = Window.partitionBy(*keys)
        return cls(group.orderBy(order), group.orderBy(F.col(order).desc()))


@dataclass(frozen=True)
class Seen:
    """Nearest non-NULL value before (or after) a row."""

    value: Column
    inclusive: bool
    forward: bool

    def local(self, inside: Ways, order: str) -> Column:
        # Looking ahead is looking back in descending order: a frame that ends
        # at the last row would be worked out anew for every row.
        end = Window.currentRow if self.inclusive else -1
        window = inside.up if self.forward else inside.down
        return F.last(self.value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, end))

    def summary(self, order: str) -> Column:
        at = F.when(self.value.isNotNull(), F.col(order))
        return (F.max_by if self.forward else F.min_by)(self.value, at)

    def carry(self, summary: str, across: Ways) -> Column:
        window = across.up if self.forward else across.down
        return F.last(summary, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def result(self, local: Column, carried: Column) -> Column:
        return F.coalesce(local, carried)


@dataclass(frozen=True)
class Total:
    """Sum of the values up to a row; NULL counts as 0."""

    value: Column
    inclusive: bool

    def local(self, inside: Ways, order: str) -> Column:
        end = Window.currentRow if self.inclusive else -1
        return F.sum(self.value).over(inside.up.rowsBetween(Window.unboundedPreceding, end))

    def summary(self, order: str) -> Column:
        return F.sum(self.value)

    def carry(self, summary: str, across: Ways) -> Column:
        return F.sum(summary).over(across.up.rowsBetween(Window.unboundedPreceding, -1))

    def result(self, local: Column, carried: Column) -> Column:
        return F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0))


@dataclass(frozen=True)
class Whole:
    """One aggregate over all rows of the key; ``merge`` combines block results."""

    aggregate: Column
    merge: str

    def local(self, inside: Ways, order: str) -> None:
        return None

    def summary(self, order: str) -> Column:
        return self.aggregate

    def carry(self, summary: str, across: Ways) -> Column:
        everything = across.up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        if self.merge == "first":
            return F.first(summary, ignorenulls=True).over(everything)
        if self.merge == "last":
            return F.last(summary, ignorenulls=True).over(everything)
        return getattr(F, self.merge)(summary).over(everything)

    def result(self, local: None, carried: Column) -> Column:
        return carried


@dataclass(frozen=True)
class Neighbour:
    """The value of the row right before (or after), NULL values included."""

    value: Column
    forward: bool

    def local(self, inside: Ways, order: str) -> Column:
        # A struct tells a neighbour without a value from no neighbour in the block.
        shift = F.lag if self.forward else F.lead
        return shift(F.struct(self.value.alias("v"))).over(inside.up)

    def summary(self, order: str) -> Column:
        return (F.max_by if self.forward else F.min_by)(self.value, order)

    def carry(self, summary: str, across: Ways) -> Column:
        # Every block has a row, so the adjacent block holds the neighbour.
        return (F.lag if self.forward else F.lead)(summary).over(across.up)

    def result(self, local: Column, carried: Column) -> Column:
        return F.when(local.isNotNull(), local["v"]).otherwise(carried)


def last_seen(value: Column, inclusive: bool = True) -> Seen:
    return Seen(value, inclusive, forward=True)


def next_seen(value: Column, inclusive: bool = True) -> Seen:
    return Seen(value, inclusive, forward=False)


def previous(value: Column) -> Neighbour:
    return Neighbour(value, forward=True)


def following(value: Column) -> Neighbour:
    return Neighbour(value, forward=False)


def running_total(value: Column, inclusive: bool = True) -> Total:
    return Total(value, inclusive)


def whole_min(value: Column) -> Whole:
    return Whole(F.min(value), "min")


def whole_max(value: Column) -> Whole:
    return Whole(F.max(value), "max")


def whole_sum(value: Column) -> Whole:
    return Whole(F.sum(value), "sum")


def whole_first(value: Column, order: str) -> Whole:
    """Value of the first row where it is not NULL."""
    return Whole(F.min_by(value, F.when(value.isNotNull(), F.col(order))), "first")


def whole_last(value: Column, order: str) -> Whole:
    """Value of the last row where it is not NULL."""
    return Whole(F.max_by(value, F.when(value.isNotNull(), F.col(order))), "last")


def with_blocks(df: DataFrame, order: str, rows_per_block: int | None = None) -> DataFrame:
    """Add the block column, so that several calls share one shuffle.

    ``over_blocks`` keeps a block column it finds; drop it with ``no_blocks``.
    """
    if _BLOCK in df.columns:
        return df
    size = rows_per_block or block_rows(df.sparkSession)
    return df.withColumn(_BLOCK, F.floor(F.col(order) / F.lit(size)).cast("long"))


def no_blocks(df: DataFrame) -> DataFrame:
    return df.drop(_BLOCK)


def join_facts(blocked: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts per key beside every row, joined on ``(keys, block)``.

    A join on the keys alone would send all rows of a large key to one task.
    The facts are first spread over the blocks of their key, of which there
    are few, and then meet rows that are partitioned by block already.
    """
    blocks = blocked.select(*keys, _BLOCK).distinct()
    return blocked.join(blocks.join(facts, list(keys)), [*keys, _BLOCK])


def join_by_row(rows: DataFrame, decided: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two tables that both grow with the rows of the sheets.

    Spark takes a written table to be as large as its files. Columns of repeated texts shrink a hundredfold there, so that
    it would broadcast millions of rows. Here both sides are sorted and merged, in memory that can spill.
    """
    return rows.join(decided.hint("merge"), list(keys), how)


def over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    outputs: Mapping[str, Seen | Total | Whole | Neighbour],
    rows_per_block: int | None = None,
) -> DataFrame:
    """Add one column per entry of ``outputs``; see the module text."""
    group = [*keys, _BLOCK]
    blocked = with_blocks(df, order, rows_per_block)
    inside, across = Ways.of(group, order), Ways.of(keys, _BLOCK)

    specs = list(outputs.items())
    local = {i: column for i, (_, spec) in enumerate(specs) if (column := spec.local(inside, order)) is not None}
    summaries = blocked.groupBy(*group).agg(*[spec.summary(order).alias(f"__s{i}") for i, (_, spec) in enumerate(specs)])
    carried = summaries.select(*group, *[spec.carry(f"__s{i}", across).alias(f"__c{i}") for i, (_, spec) in enumerate(specs)])
    rows = blocked.withColumns({f"__l{i}": column for i, column in local.items()}) if local else blocked
    results = [
        spec.result(F.col(f"__l{i}") if i in local else None, F.col(f"__c{i}")).alias(name)
        for i, (name, spec) in enumerate(specs)
    ]
    kept = [c for c in df.columns if c not in outputs]
    return rows.join(carried, group, "left").select(*kept, *results)


def dense_position(df: DataFrame, keys: Sequence[str], order: str, name: str = "position") -> DataFrame:
    """0-based position of each row in its key, without gaps."""
    return over_blocks(df, keys, order, {name: running_total(F.lit(1).cast("long"), inclusive=False)})
