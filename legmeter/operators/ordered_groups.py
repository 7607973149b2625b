"""Previous row, next value and row number inside ordered groups of any size.

A plain window sorts each group in one task. A group can be huge here: orders without a courier all
share one group, and so do those of a warehouse that dwarfs the others. Groups above a row limit are
therefore cut into pieces along their order. Each piece is its own window partition, and a small
summary per piece (its last row, its row count) carries the state to the next one. All other groups
stay whole, and without any large group the plan is the plain window's.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legmeter.config import SplitPolicy
from legmeter.session import materialise


class OrderedGroups:
    """Groups of ``keys`` rows in ascending ``order`` (nulls last).

    The last entry of ``order`` makes it total. ``day``, if given, is a never-null number that grows
    with ``order``. It leads the sort without changing it, so numbering within a day needs neither a
    second shuffle nor a second sort. ``count_by`` may name fewer keys that are cheaper to count by.
    """

    def __init__(
        self,
        keys: list[str],
        order: list[str],
        day: str | None = None,
        policy: SplitPolicy = SplitPolicy(),
        name: str = "piece",
        count_by: list[str] | None = None,
    ):
        self.keys, self.order, self.day, self.policy = keys, order, day, policy
        self.count_by = count_by or keys
        self.piece = f"_{name}"
        self.is_split = False

    def mark(self, df: DataFrame) -> DataFrame:
        return mark_groups(df, self)

    def cut(self, df: DataFrame) -> DataFrame:
        """Add the piece number: 0 for ordinary groups, 1, 2, … along the order in large ones.

        Spark's range partitioning samples the order and so balances the pieces whatever the rows look
        like, ties included. Its bounds differ from one execution to the next; therefore the rows of
        large groups are written once with their piece, and everything after reads the same pieces.
        """
        large = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > self.policy.rows)
        total = large.agg(F.sum("_rows")).first()[0]
        if not total:
            return df.withColumn(self.piece, F.lit(0))
        self.is_split = True
        pieces = math.ceil(total / self.policy.rows)
        flagged = self._attach(df, large, self.keys)
        split = (
            flagged.filter(F.col("_rows").isNotNull())
            .drop("_rows")
            .repartitionByRange(pieces, *self.keys, *self._ascending())
            .withColumn(self.piece, F.spark_partition_id() + 1)
        )
        whole = flagged.filter(F.col("_rows").isNull()).drop("_rows").withColumn(self.piece, F.lit(0))
        return whole.unionByName(materialise(split, "pieces"))

    def previous(self, df: DataFrame, marked: DataFrame, values: dict[str, str]) -> DataFrame:
        """Add for each ``new: column`` the value of the row before. ``marked`` is ``mark``'s output."""
        window = self._window()
        out = self._placed(df, marked).withColumns({new: F.lag(column, 1).over(window) for new, column in values.items()})
        if not self.is_split:
            return out
        out = out.withColumn("_first", F.row_number().over(window) == 1)
        carried = F.max_by(
            F.struct(*[F.col(column).alias(new) for new, column in values.items()]),
            self._rank(),
        ).alias("_last")
        along = Window.partitionBy(*self.keys).orderBy(self.piece)
        carry = self._summary(marked, [], carried).select(
            *self.keys, self.piece, F.lag("_last", 1).over(along).alias("_carry")
        )
        out = self._attach(out, carry, [*self.keys, self.piece])
        for new in values:
            out = out.withColumn(
                new, F.when(F.col("_first") & F.col("_carry").isNotNull(), F.col(f"_carry.{new}")).otherwise(F.col(new))
            )
        return out.drop("_first", "_carry")

    def number(self, df: DataFrame, marked: DataFrame, new: str) -> DataFrame:
        """Add the row number within the group, or within the group's day if ``day`` is set."""
        inner = [self.day] if self.day else []
        window = Window.partitionBy(*self.keys, self.piece, *inner).orderBy(*self._ascending())
        out = self._placed(df, marked).withColumn(new, F.row_number().over(window))
        if not self.is_split:
            return out
        along = (
            Window.partitionBy(*self.keys, *inner)
            .orderBy(self.piece)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = self._summary(marked, inner, F.count(F.lit(1)).alias("_count")).select(
            *self.keys, *inner, self.piece, F.sum("_count").over(along).alias("_before")
        )
        out = self._attach(out, carry, [*self.keys, *inner, self.piece])
        return out.withColumn(new, (F.col(new) + F.coalesce(F.col("_before"), F.lit(0))).cast("int")).drop("_before")

    def next_value(self, df: DataFrame, marked: DataFrame, new: str, column: str) -> DataFrame:
        """Add the first non-null ``column`` of the later rows."""
        backwards = (
            Window.partitionBy(*self.keys, self.piece)
            .orderBy(*[F.col(name).desc_nulls_first() for name in self.order])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        out = self._placed(df, marked).withColumn(new, F.last(column, ignorenulls=True).over(backwards))
        if not self.is_split:
            return out
        first = F.min_by(F.col(column), F.when(F.col(column).isNotNull(), self._rank())).alias("_firstvalue")
        along = (
            Window.partitionBy(*self.keys)
            .orderBy(F.col(self.piece).desc())
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = self._summary(marked, [], first).select(
            *self.keys, self.piece, F.last("_firstvalue", ignorenulls=True).over(along).alias("_later")
        )
        out = self._attach(out, carry, [*self.keys, self.piece])
        return out.withColumn(new, F.coalesce(F.col(new), F.col("_later"))).drop("_later")

    def _placed(self, df: DataFrame, marked: DataFrame) -> DataFrame:
        """Ask for the window's own partitioning. An earlier join may have left the rows partitioned by
        fewer keys, say the warehouse alone; Spark would keep that and put a whole warehouse in one task.
        """
        if df is not marked:
            return df
        # Without a split the piece is a constant, which Spark drops from the window's keys.
        return df.repartition(*self.keys, *([self.piece] if self.is_split else []))

    def _ascending(self) -> list[Column]:
        return [F.col(name).asc_nulls_last() for name in self.order]

    def _rank(self) -> Column:
        """The order as one comparable value; a struct alone would put nulls first."""
        return F.struct(
            *[part.alias(f"{kind}{i}")
                for i, name in enumerate(self.order)
                for kind, part in (("null", F.col(name).isNull()), ("value", F.col(name)))]
        )

    def _window(self):
        lead = [F.col(self.day).asc()] if self.day else []
        return Window.partitionBy(*self.keys, self.piece).orderBy(*lead, *self._ascending())

    def _summary(self, marked: DataFrame, inner: list[str], *aggregates: Column) -> DataFrame:
        return marked.filter(F.col(self.piece) > 0).groupBy(*self.keys, *inner, self.piece).agg(*aggregates)

    @staticmethod
    def _attach(df: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
        """Left join on keys that may be null. Spark broadcasts ``side`` only while it is small."""
        side = side.withColumnsRenamed({name: f"_on_{name}" for name in on})
        condition = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_on_{name}")) for name in on])
        return df.join(side, condition, "left").drop(*[f"_on_{name}" for name in on])


def mark_groups(df: DataFrame, *groupings: OrderedGroups) -> DataFrame:
    """Add the piece number of every grouping.

    One pass over the key columns counts the groups of all of them. As a rule none is large; then
    nothing else is added to the plan.
    """
    sets = [[F.col(name) for name in grouping.count_by] for grouping in groupings]
    names = dict.fromkeys(name for grouping in groupings for name in grouping.count_by)
    limit = min(grouping.policy.rows for grouping in groupings)
    counts = df.groupingSets(sets, *[F.col(name) for name in names]).agg(F.count(F.lit(1)).alias("_rows"))
    none_large = counts.filter(F.col("_rows") > limit).select("_rows").isEmpty()
    for grouping in groupings:
        df = df.withColumn(grouping.piece, F.lit(0)) if none_large else grouping.cut(df)
    return df
