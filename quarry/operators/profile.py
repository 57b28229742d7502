"""Table profiling: null/range checks, moments, quartiles, distinct counts.

``DataFrame.describe()``/``summary()`` launch one job per statistic group
and return every value as a string. Here every statistic of every column
is one expression inside a single ``agg`` (one scan, partial aggregation
on each task), and the one result row is unpivoted with ``stack`` into a
typed long table: one row per column, numeric and text statistics in
separate fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType

from quarry.functions.scalar import fixed_round

def _lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _ref(name: str | None, sql_type: str) -> str:
    return f"cast({_ident(name)} as {sql_type})" if name else f"cast(null as {sql_type})"


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """count, nulls, mean, stddev, min and max of every column, one scan.

    Output: column_name, ordinal, non_null, nulls, mean, stddev, min_num,
    max_num, min_text, max_text (numeric columns fill the ``*_num`` and
    moment fields, other columns the ``*_text`` fields). Min and max are
    taken in the column's own type; ``digits`` rounds mean and stddev.
    """
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    aggs, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, f in enumerate(fields):
        c, p = F.col(_ident(f.name)), f"_{i}_"
        aggs.append(F.count(c).alias(p + "nn"))
        if isinstance(f.dataType, NumericType):
            aggs += [fixed_round(F.avg(c), digits).alias(p + "mean"),
                     fixed_round(F.stddev_samp(c), digits).alias(p + "sd"),
                     F.min(c).cast("double").alias(p + "min"),
                     F.max(c).cast("double").alias(p + "max")]
            stats = [p + "mean", p + "sd", p + "min", p + "max", None, None]
        else:
            aggs += [F.min(c).cast("string").alias(p + "tmin"), F.max(c).cast("string").alias(p + "tmax")]
            stats = [None, None, None, None, p + "tmin", p + "tmax"]
        mean, sd, mn, mx, tmin, tmax = stats
        rows.append(", ".join([
            _lit(f.name), f"cast({i + 1} as int)", _ref(p + "nn", "bigint"),
            f"cast(`_rows` - `{p}nn` as bigint)", _ref(mean, "double"), _ref(sd, "double"),
            _ref(mn, "double"), _ref(mx, "double"), _ref(tmin, "string"), _ref(tmax, "string")]))
    # the single result row is unpivoted into one row per column
    return df.agg(*aggs).selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) as (column_name, ordinal, non_null, nulls, "
        "mean, stddev, min_num, max_num, min_text, max_text)")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], *,
                    accuracy: int = 10_000, buckets: int = 1024, final_rows: int = 4096) -> DataFrame:
    """Exact linear-interpolation quantiles (SQL ``quantile_cont``) by
    distributed selection. Returns (column_name, p_index, value).

    Spark's exact ``percentile`` keeps a map of every distinct value and
    merges it in one task, which does not hold for high-cardinality columns
    at scale. Here each target rank has an open interval of values that
    holds it, and every round narrows the interval until at most
    ``final_rows`` rows are inside; those are counted per distinct value
    and the rank is read off. Two ways to narrow, by type:

    * doubles and integers, by row count: one KLL sketch per column and
      interval gives edges just below and just above its ranks, and one scan
      counts the rows below, at and between them. A round leaves about 6 in
      1,000 rows whatever their spread, and always at least the edges
      themselves fewer; a rank that the edges miss is looked for beside them.
      Comparisons are native and integers stay integers, so infinities and NaN
      (the largest value) keep Spark's order and values beyond 2^53 are exact;
    * decimals, by value: the interval is cut into ``buckets`` parts of equal
      width in integer arithmetic, and the rounds end with the digits of the type.

    A value held by many rows is answered by its own count. What reaches the
    driver is bounded by targets x max(buckets, final_rows) rows a round.
    """
    spark = df.sparkSession
    kinds = [df.schema[c].dataType for c in cols]
    longs = [i for i, k in enumerate(kinds) if isinstance(k, IntegralType)]
    scales = [k.scale if isinstance(k, DecimalType) else 0 for k in kinds]
    raw = [F.col(_ident(c)) for c in cols]
    head = df.agg(*[agg for i, x in enumerate(raw) for agg in (
        F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
        F.count(x if isinstance(kinds[i], (IntegralType, DecimalType)) else F.when(~F.isnan(x), x)).alias(f"m{i}"))]).first()
    whole = [isinstance(k, DecimalType) for k in kinds]
    xs = []
    for i, x in enumerate(raw):
        if whole[i]:  # the unscaled number; a shift of the point, not a rounding
            x = (x * F.lit(Decimal(10) ** scales[i]) if scales[i] else x).cast("decimal(38,0)")
        xs.append(x if whole[i] else x.cast("long" if i in longs else "double"))

    def end(i: int, which: str) -> int | None:
        return int(Decimal(head[f"{which}{i}"]).scaleb(scales[i])) if whole[i] else None

    # a target (column index, rank) is known, or has an interval lo <(=) x <(=) hi
    # with the rows below it and inside it; ends are inclusive only at the start
    known: dict[tuple[int, int], object] = {}
    open_: dict[tuple[int, int], _Interval] = {}
    wanted, empty = [], []
    for i in range(len(cols)):
        n, m = int(head[f"n{i}"]), int(head[f"m{i}"])
        for j, p in enumerate(probs):
            if n == 0:
                empty.append((cols[i], j, None))
                continue
            h = (n - 1) * float(p)
            r_lo = int(h // 1)
            r_hi = min(r_lo + 1, n - 1) if h > r_lo else r_lo
            wanted.append((i, j, r_lo, r_hi, h - r_lo))
            for r in (r_lo, r_hi):
                if r >= m:
                    known[i, r] = float("nan")
                else:
                    open_[i, r] = _Interval(end(i, "lo"), end(i, "hi"), 0, m)

    def inside(i: int, at: _Interval) -> Column:
        x = xs[i]
        if whole[i]:
            return (x >= F.lit(Decimal(at.lo))) & (x <= F.lit(Decimal(at.hi)))
        cond = x.isNotNull() if i in longs else x.isNotNull() & ~F.isnan(x)
        if at.lo is not None:
            cond = cond & (x > F.lit(at.lo))
        return cond & (x < F.lit(at.hi)) if at.hi is not None else cond

    while True:
        for t in [t for t, at in open_.items() if at.lo is not None and at.lo == at.hi and whole[t[0]]]:
            known[t] = open_.pop(t).lo
        todo = {t: at for t, at in open_.items() if at.count > final_rows}
        if not todo:
            break
        before = dict(open_)
        _narrow_whole(df, xs, {t: at for t, at in todo.items() if whole[t[0]]}, open_, inside, buckets)
        _narrow_by_count(df, xs, {t: at for t, at in todo.items() if not whole[t[0]]}, open_, known, inside, longs, accuracy)
        if open_ == before:
            raise RuntimeError("the rows changed between two scans of the quantiles' input")

    if open_:
        groups = list(dict.fromkeys((t[0], at) for t, at in open_.items()))
        entries = F.array(*[F.when(inside(i, at), F.struct(F.lit(k).alias("t"), xs[i].cast("string").alias("v")))
                            for k, (i, at) in enumerate(groups)])
        rows = (df.select(F.explode(entries).alias("e")).where(F.col("e").isNotNull()).select("e.*")
                .groupBy("t", "v").agg(F.count(F.lit(1)).alias("c")).collect())
        read: dict[int, list] = {}
        for r in rows:
            i = groups[r["t"]][0]
            read.setdefault(r["t"], []).append((int(r["v"]) if whole[i] or i in longs else float(r["v"]), r["c"]))
        for t, at in open_.items():
            seen = at.below
            for v, c in sorted(read[groups.index((t[0], at))]):
                if seen + c > t[1]:
                    known[t] = v
                    break
                seen += c

    def value(i, r_lo, r_hi, frac):
        lo, hi = known[i, r_lo], known[i, r_hi]
        if lo == hi or frac == 0:
            return float(Decimal(lo).scaleb(-scales[i])) if whole[i] else float(lo)
        if whole[i]:
            lo, hi = (float(Decimal(v).scaleb(-scales[i])) for v in (lo, hi))
        return lo + frac * (hi - lo)

    out = [(cols[i], j, value(i, r_lo, r_hi, frac)) for i, j, r_lo, r_hi, frac in wanted] + empty
    return spark.createDataFrame(out, "column_name string, p_index int, value double")


@dataclass(frozen=True)
class _Interval:
    """Values between lo and hi (both outside for doubles, both inside for whole numbers)."""
    lo: float | int | None
    hi: float | int | None
    below: int
    count: int


def _narrow_whole(df, xs, todo, open_, inside, buckets: int) -> None:
    """One round for whole numbers: counts per equal-width bucket of each interval."""
    if not todo:
        return
    groups = list(dict.fromkeys((t[0], at) for t, at in todo.items()))
    widths = [-(-(at.hi - at.lo + 1) // buckets) for _, at in groups]
    def bucket(i, at, width):  # exact: the rest is taken off before the division
        over = (xs[i] - F.lit(Decimal(at.lo))).cast("decimal(38,0)")
        return ((over - over % F.lit(Decimal(width))) / F.lit(Decimal(width))).cast("int")

    entries = F.array(*[F.when(inside(i, at), F.struct(F.lit(k).alias("t"), bucket(i, at, widths[k]).alias("b")))
                        for k, (i, at) in enumerate(groups)])
    rows = (df.select(F.explode(entries).alias("e")).where(F.col("e").isNotNull()).select("e.*")
            .groupBy("t", "b").agg(F.count(F.lit(1)).alias("c")).collect())
    for t, at in todo.items():
        k = groups.index((t[0], at))
        seen = at.below
        for b, c in sorted((r["b"], r["c"]) for r in rows if r["t"] == k):
            if seen + c > t[1]:
                lo = at.lo + b * widths[k]
                open_[t] = _Interval(lo, min(lo + widths[k] - 1, at.hi), seen, c)
                break
            seen += c


def _narrow_by_count(df, xs, todo, open_, known, inside, longs, accuracy: int) -> None:
    """One round by row count: approximate edges around the ranks, then exact counts.
    Neighbouring ranks of one interval share their edges, and all ranks of one
    interval one sketch."""
    if not todo:
        return
    size = min(max(accuracy * 2 // 5, 200), 65535)
    slack = 2.4 * 2.296 / size ** 0.9021  # well beyond the sketch's error at 99 of 100
    clusters: dict[tuple, list[list]] = {}
    for t in sorted(todo):
        own = clusters.setdefault((t[0], todo[t]), [])
        if own and t[1] - own[-1][-1][1] <= todo[t].count * slack:
            own[-1].append(t)
        else:
            own.append([t])
    aggs, shares = [], []
    for k, ((i, at), own) in enumerate(clusters.items()):
        share = lambda t: (t[1] - at.below + 0.5) / at.count  # noqa: E731, B023
        ends = F.array(*[F.lit(min(1.0, max(0.0, s))) for c in own for s in (share(c[0]) - slack, share(c[-1]) + slack)])
        sketch, quantile = (F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint) if i in longs else \
            (F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double)
        aggs.append(sketch(F.when(inside(i, at), xs[i]), F.lit(size)).alias(f"s{k}"))
        shares.append(quantile(f"s{k}", ends).alias(f"e{k}"))
    edges = df.agg(*aggs).select(*shares).first()
    groups = [(i, at, c, edges[f"e{k}"][2 * j], edges[f"e{k}"][2 * j + 1]) for k, ((i, at), own) in enumerate(clusters.items()) for j, c in enumerate(own)]
    counts = []
    for k, (i, at, _, a, b) in enumerate(groups):
        x = xs[i] if at.lo is None and at.hi is None else F.when(inside(i, at), xs[i])
        counts += [F.count_if(cond).alias(f"{name}{k}") for name, cond in (
            ("below_a", x < F.lit(a)), ("upto_a", x <= F.lit(a)), ("below_b", x < F.lit(b)), ("upto_b", x <= F.lit(b)))]
    row = df.agg(*counts).first()
    for k, (i, at, cluster, a, b) in enumerate(groups):
        below_a, upto_a, below_b, upto_b = (row[f"{n}{k}"] for n in ("below_a", "upto_a", "below_b", "upto_b"))
        parts = [(at.lo, a, below_a), (a, a, upto_a - below_a), (a, b, max(below_b - upto_a, 0)), (b, b, upto_b - below_b if a != b else 0)]
        for t in cluster:
            seen = at.below
            for place, (lo, hi, c) in enumerate(parts):
                if seen + c > t[1]:
                    if place in (1, 3):
                        known[t] = lo
                        del open_[t]
                    else:
                        open_[t] = _Interval(lo, hi, seen, c)
                    break
                seen += c
            else:
                open_[t] = _Interval(b, at.hi, seen, at.count - (seen - at.below))


def column_quartiles(df: DataFrame, cols: Sequence[str], *, exact: bool = True,
                     accuracy: int = 10_000, digits: int | None = None) -> DataFrame:
    """25th, 50th and 75th percentile of numeric columns, long form.

    ``exact=True``: linear interpolation between closest ranks (equal to
    SQL ``quantile_cont`` and Spark's ``percentile``) by ``exact_quantiles``
    with bounded memory. ``exact=False``: ``percentile_approx`` only (one
    scan, rank error 1/accuracy; what ``DataFrame.summary()`` reports).
    """
    probs = [0.25, 0.5, 0.75]
    if exact:
        q = exact_quantiles(df, cols, probs)
        return (q.groupBy("column_name").agg(*[
            fixed_round(F.max(F.when(F.col("p_index") == j, F.col("value"))), digits).alias(name)
            for j, name in enumerate(["q1", "median", "q3"])]))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(_ident(c)).cast("double")
        for j, p in enumerate(probs):
            aggs.append(fixed_round(F.percentile_approx(x, F.lit(p), F.lit(accuracy)), digits)
                        .alias(f"_{i}_{j}"))
    one = df.agg(*aggs)
    parts = [", ".join([_lit(c)] + [f"`_{i}_{j}`" for j in range(3)]) for i, c in enumerate(cols)]
    return one.selectExpr(f"stack({len(cols)}, {', '.join(parts)}) as (column_name, q1, median, q3)")


def distinct_counts(frames: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Distinct count of one column per (label, frame, column), one row each.

    ``count(DISTINCT c)`` is planned as a two-level aggregate (distinct keys
    are de-duplicated per task before the shuffle). The per-frame rows are
    combined with a union, not a cross join.
    """
    out = None
    for label, frame, column in frames:
        part = frame.agg(F.countDistinct(F.col(_ident(column))).alias("distinct_count")) \
                    .select(F.lit(label).alias("source"), F.lit(column).alias("column_name"),
                            "distinct_count")
        out = part if out is None else out.unionByName(part)
    return out


def count_reconcile(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Row counts of a source and its copy, and whether they agree (one row)."""
    tagged = (source.select(F.lit("source").alias("_side"))
              .unionByName(copy.select(F.lit("copy").alias("_side"))))
    return (tagged.agg(F.sum((F.col("_side") == "source").cast("long")).alias("source_rows"),
                       F.sum((F.col("_side") == "copy").cast("long")).alias("copy_rows"))
                  .withColumn("counts_match", F.col("source_rows") == F.col("copy_rows")))


def schema_profile(df: DataFrame) -> DataFrame:
    """Column name, position, type and null count of every column (one scan)."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count(F.col(_ident(f.name))).alias(f"_{i}") for i, f in enumerate(df.schema.fields)]
    one = df.agg(*aggs)
    parts = [f"{_lit(f.name)}, cast({i + 1} as int), {_lit(f.dataType.simpleString())}, "
             f"cast(`_rows` - `_{i}` as bigint)" for i, f in enumerate(df.schema.fields)]
    return one.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as "
                          "(column_name, ordinal, data_type, nulls)")
