"""Joins, aggregations, ordering, top-k and distinct.

Join strategy is left to Catalyst and AQE: sort-merge for large sides,
broadcast when the optimizer's size estimate is under
``spark.sql.autoBroadcastJoinThreshold``, skewed partitions split at run
time. The helpers here add what the optimizer cannot know:

* the rewrite of a disjunctive (OR) equi-join into one equi-join per
  disjunct, which avoids the nested-loop join Spark would plan for it;
* the rewrite of right and full outer joins into an inner join plus anti
  joins on distinct keys, whose skewed partitions AQE can split;
* optional pre-aggregation of the many side of a many-to-many join, so a
  join key shared by many rows on both sides does not emit every pair.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

JOIN_TYPES = {
    "inner": "inner",
    "left": "left",
    "right": "right",
    "full": "full",
    "semi": "left_semi",
    "anti": "left_anti",
}

# --------------------------------------------------------------------------- joins

def join_aliased(left: DataFrame, right: DataFrame, *, left_alias: str, right_alias: str,
                 on: Sequence[tuple[str, str]], how: str = "inner",
                 select: Mapping[str, str] | None = None) -> DataFrame:
    """Join two aliased frames on pairs of columns; resolve clashes by alias.

    ``select`` maps output names to qualified inputs, e.g.
    ``{"people_gender": "p.gender", "names_gender": "n.gender"}``.
    """
    l, r = left.alias(left_alias), right.alias(right_alias)
    cond = None
    for lc, rc in on:
        term = F.col(f"{left_alias}.{lc}") == F.col(f"{right_alias}.{rc}")
        cond = term if cond is None else cond & term
    out = l.join(r, cond, JOIN_TYPES.get(how, how))
    if select:
        out = out.select(*[F.col(src).alias(dst) for dst, src in select.items()])
    return out


def join_on_names(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  how: str = "inner") -> DataFrame:
    """Equi-join on same-named key columns; each key appears once in the
    output (for outer joins it holds the non-null side's value)."""
    return left.join(right, on=list(keys), how=JOIN_TYPES.get(how, how))


def join_on(left: DataFrame, right: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    """Join on an arbitrary condition; equalities inside it become hash keys."""
    return left.join(right, condition, JOIN_TYPES.get(how, how))


def join_any_of(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner join on ``l1 = r1 OR l2 = r2 OR ...`` without a nested loop.

    Spark plans a disjunctive condition as a (broadcast) nested-loop join,
    which compares every pair of rows. ``pairs`` are (left column, right
    column) names; the two frames must not share column names.

    * All disjuncts against the same right column (``l1 = r OR l2 = r``):
      each left row is expanded into one probe row per non-null key, the
      probes are joined once on ``r``, and a pair is kept only for the
      first disjunct that matches it. One scan of each side, one join.
    * Otherwise: one equi-join per disjunct, where branch ``i`` keeps only
      pairs no earlier branch matched (``NOT coalesce(l_j = r_j, false)``),
      combined with a union.

    Either way each matching pair appears exactly once, as in the OR join.
    """
    def earlier_match(i: int, lcol, rcol) -> Column:
        hit = F.lit(False)
        for lj, rj in pairs[:i]:
            hit = hit | F.coalesce(lcol(lj) == rcol(rj), F.lit(False))
        return hit

    right_keys = {rc for _, rc in pairs}
    if len(right_keys) == 1:
        (rk,) = right_keys
        probes = F.array(*[F.struct(F.lit(i).alias("b"), F.col(lk).alias("k"))
                           for i, (lk, _) in enumerate(pairs)])
        expanded = (left.select(*[F.col(c) for c in left.columns], F.explode(probes).alias("_p"))
                        .where(F.col("_p.k").isNotNull()))
        joined = expanded.join(right, expanded["_p.k"] == right[rk], "inner")
        keep = F.lit(True)
        for i in range(1, len(pairs)):
            keep = F.when(F.col("_p.b") == i, ~earlier_match(i, F.col, F.col)).otherwise(keep)
        return joined.where(keep).drop("_p")
    branches = []
    for i, (lk, rk) in enumerate(pairs):
        cond = (left[lk] == right[rk]) & ~earlier_match(i, lambda c: left[c], lambda c: right[c])
        branches.append(left.join(right, cond, "inner"))
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out


def outer_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "full") -> DataFrame:
    """Equi RIGHT or FULL OUTER JOIN as an inner join plus the unmatched rows.

    AQE splits a skewed partition only on the side whose rows an outer join
    does not have to preserve, and never in a full outer join. It splits
    both sides of an inner join and the left side of an anti join, so the
    join is written as those: ``L JOIN R``, ``R ANTI JOIN keys(L)`` and, for
    ``full``, ``L ANTI JOIN keys(R)``, the missing side's columns null. The
    anti joins need only the *distinct* keys; these are checkpointed, since
    AQE leaves a side alone that comes straight from an aggregate. The cost
    is one more read of each input per part. Null keys never match.
    """
    if how not in ("right", "full"):
        raise ValueError("how must be 'right' or 'full'")
    ensure_checkpoint_dir(left.sparkSession)

    def unmatched(side: DataFrame, own: list[str], other: DataFrame, keys: list[str]) -> DataFrame:
        distinct = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct().checkpoint()
        cond = reduce(and_, [side[c] == distinct[f"_k{i}"] for i, c in enumerate(own)])
        return side.join(distinct, cond, "left_anti")

    def nulls(df: DataFrame) -> list[Column]:
        return [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]

    lkeys, rkeys = [lc for lc, _ in pairs], [rc for _, rc in pairs]
    out = left.join(right, reduce(and_, [left[lc] == right[rc] for lc, rc in pairs]), "inner")
    out = out.unionByName(unmatched(right, rkeys, left, lkeys).select(*nulls(left), *right.columns))
    if how == "full":
        out = out.unionByName(unmatched(left, lkeys, right, rkeys).select(*left.columns, *nulls(right)))
    return out


def pre_aggregate(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Collapse the many side of a many-to-many join to one row per key.

    The result is checkpointed: a join with it gets its own shuffle of this
    side, which AQE needs to split a hot key of the other side."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.groupBy(*keys).agg(*aggs).checkpoint()


# --------------------------------------------------------------------------- aggregates

def count_rows(df: DataFrame, name: str = "row_count") -> DataFrame:
    """The row count as a one-row frame (an operator, not a driver action)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows (nulls form one group)."""
    return (df.select(*cols) if cols else df).distinct()


# --------------------------------------------------------------------------- ordering

def top_k(df: DataFrame, order: Sequence[Column], k: int, rank_col: str | None = "rank") -> DataFrame:
    """The first ``k`` rows in ``order`` (planned as TakeOrderedAndProject).

    ``order`` must be a total order (add a unique tie-breaker), otherwise
    which of several tied rows is kept is arbitrary. With ``rank_col`` the
    position 1..k is added; the window runs over the k kept rows only.
    """
    head = df.orderBy(*order).limit(k)
    if rank_col is None:
        return head
    return head.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def first_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """A deterministic preview: ``limit`` always comes with an order key."""
    if not order:
        raise ValueError("first_n needs an order key; limit without order is arbitrary")
    return df.orderBy(*order).limit(n)


def with_global_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add the 1-based position of every row in a total ``order``.

    A window without PARTITION BY would move every row into one task. This
    instead range-partitions and sorts (``orderBy``), checkpoints the sorted
    rows so partition boundaries are fixed even if tasks are re-run, counts
    the rows of each partition (one small row per partition), turns the
    counts into offsets and adds the row's index inside its partition.
    """
    ordered = (df.orderBy(*order)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = ordered.checkpoint(eager=True)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"))
    # One row per partition: bounded by the partition count, safe to broadcast.
    out = ordered.join(F.broadcast(offsets), "_pid")
    local_index = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (out.withColumn(name, F.coalesce(F.col("_offset"), F.lit(0)) + local_index + 1)
               .drop("_pid", "_mid", "_offset"))
