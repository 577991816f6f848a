"""Exact ranks, quantiles and running totals without a single-task sort.

All of them follow one idea. Cut points split the value range into buckets of similar size; counting
rows per bucket is one cheap aggregate, and only then are rows ordered, inside a bucket. Cut points may
be approximate: they decide where the buckets lie, never what the result is. They are fetched to the
driver (their number is a parameter, not a function of the data) so that every later pass, and every
recomputed task, sees the same borders.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.session import shared_path

ACCURACY = 10_000
# Size of a quantile sketch (rank error about 0.1 %), and reducers that merge those of the tasks.
SKETCH_SIZE = 4_096
SKETCH_GROUPS = 32
# A bucket at most this large is ordered as it is; a larger one is cut again.
ROWS_PER_BUCKET = 2_000_000
MAX_COMPARISONS = 32


def settled(df: DataFrame) -> DataFrame:
    """A derived table written to the shared folder and read back.

    It is computed once, and its size on disk lets Spark choose between sending it to all tasks and a shuffle join.
    """
    path = shared_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positions(df: DataFrame, group: str, order: str, name: str = "position") -> DataFrame:
    """``df`` with the place, from 0, of each row in its group by ``order``, for groups of any size.

    Rows are sorted by ranges of both columns; a place is the number of the group's rows in earlier ranges plus that
    before it in its own.
    """
    ranged = df.repartitionByRange(group, order).sortWithinPartitions(group, order)
    table = settled(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    bounds = table.groupBy(part, F.col(group).alias("_group")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bounds = bounds.select("_part", "_group", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = table.join(bounds, (F.shiftright("_at", 33) == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")))
    return placed.withColumn(name, F.col("_at") + F.col("_shift")).select(*df.columns, name)


def default_buckets(df: DataFrame) -> int:
    """A few buckets per shuffle task, within what one aggregate row can carry."""
    return max(32, min(16_384, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _finite(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def cut_points(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Cut points per column at approximate quantiles.

    Every task sketches its rows, ``SKETCH_GROUPS`` reducers merge the tasks' sketches, and one merge per column joins
    those: no reducer meets the sketches of all tasks.
    """
    if not columns or not probs:
        return {c: [] for c in columns}
    k = min(65_535, max(SKETCH_SIZE, 10 * len(probs)))
    finite = df.select((F.spark_partition_id() % SKETCH_GROUPS).alias("group"), *[
        _finite(c).alias(f"v{i}") for i, c in enumerate(columns)])
    grouped = finite.groupBy("group").agg(*[
        F.kll_sketch_agg_double(f"v{i}", F.lit(k)).alias(f"s{i}") for i in range(len(columns))])
    stacked = grouped.select(F.posexplode(F.array(*[f"s{i}" for i in range(len(columns))])).alias("i", "sketch"))
    merged = stacked.groupBy("i").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    ranks = F.array(*[F.lit(float(min(1.0, max(0.0, p)))) for p in probs])
    known = merged.where(F.kll_sketch_get_n_double("sketch") > 0)
    points = {r["i"]: r["points"] for r in known.select(
        "i", F.kll_sketch_get_quantile_double("sketch", ranks).alias("points")).collect()}
    return {c: sorted(_with_ties_apart(points.get(i, []))) for i, c in enumerate(columns)}


def _with_ties_apart(points: Sequence[float]) -> set[float]:
    """The points, plus the next larger number after each repeated one.

    A value that fills several quantiles thereby gets a bucket of its own, which needs no ordering.
    """
    repeated = {p for p, n in Counter(points).items() if n > 1}
    return set(points) | {math.nextafter(p, math.inf) for p in repeated}


def cuts_passed(column: str, cuts: Sequence[float]) -> Column:
    """Number of cut points ``<= column`` (repeats count each), as plain comparisons inside generated code."""
    if not cuts:
        return F.lit(0)
    return F.expr(" + ".join(f"int(double(`{column}`) >= double('{float(cut)!r}'))" for cut in cuts))


def add_buckets(df: DataFrame, cuts: dict[str, list[float]], suffix: str = "_bucket") -> DataFrame:
    """Add ``<column><suffix>`` = number of cut points ``<= value``, for each double column in ``cuts``.

    Few cut points are compared one by one; many are searched in log time by Spark ML's ``Bucketizer``.
    """
    inf = float("inf")
    many = {
        c: [p for p in points if -inf < p < inf] for c, points in cuts.items() if len(points) > MAX_COMPARISONS}
    if many:
        df = Bucketizer(
            splitsArray=[[-inf, *points, inf] for points in many.values()],
            inputCols=list(many), outputCols=[c + suffix for c in many], handleInvalid="keep",
        ).transform(df)
    return df.withColumns({
        c + suffix: F.col(c + suffix).cast("int") if c in many else cuts_passed(c, points)
        for c, points in cuts.items()
    })


def _stacked(df: DataFrame, columns: Sequence[str], cuts: dict[str, list[float]]) -> DataFrame:
    """Long form (feature, value, bucket) of the non-null values."""
    wide = add_buckets(df.select(*[_finite(c).alias(c) for c in columns]), cuts)
    items = [
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.col(f"{c}_bucket").alias("bucket"))
        for c in columns
    ]
    return wide.select(F.inline(F.array(*items))).filter("value IS NOT NULL")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles, one list per column.

    Like ``DataFrame.approxQuantile``, the few resulting numbers come back to the driver. Three passes over
    the selected columns: sketch, count per bucket, and the values of the buckets that hold a wanted rank.
    Only those last ones are shuffled by value, after a map-side count per distinct value.
    """
    columns, spark = list(columns), df.sparkSession
    near = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-0.001, 0.001)})
    cuts = cut_points(df, columns, near)
    while True:
        stacked = _stacked(df, columns, cuts)
        counts = {(r.feature, r.bucket): r.n for r in
                  stacked.groupBy("feature", "bucket").agg(F.count("*").alias("n")).collect()}
        wanted = _locate(columns, counts, probs)
        crowded = {
            (f, b) for f, b, _ in wanted if counts[f, b] > ROWS_PER_BUCKET and not _single_value(cuts[f], b)}
        finer = _refine(stacked, crowded, cuts) if crowded else cuts
        if finer == cuts:
            break
        cuts = finer
    if not wanted:
        return {c: [None] * len(probs) for c in columns}

    places = F.broadcast(spark.createDataFrame(sorted(wanted), "feature string, bucket int, place long"))
    targets = F.broadcast(spark.createDataFrame(sorted({(f, b) for f, b, _ in wanted}), "feature string, bucket int"))
    by_bucket = Window.partitionBy("feature", "bucket").orderBy("value")
    ordered = (
        stacked.join(targets, ["feature", "bucket"], "left_semi")
        .groupBy("feature", "bucket", "value").agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(by_bucket))
    )
    found = ordered.join(places, ["feature", "bucket"]).filter("place < upto AND place >= upto - n")
    values = {(r.feature, r.bucket, r.place): r.value for r in
              found.select("feature", "bucket", "place", "value").collect()}
    return {c: _interpolate(c, counts, probs, values) for c in columns}


def _totals(counts: dict, feature: str) -> tuple[list[int], list[int]]:
    """Bucket ids of a feature in order and the number of rows before each."""
    buckets = sorted(b for f, b in counts if f == feature)
    before, running = [], 0
    for b in buckets:
        before.append(running)
        running += counts[feature, b]
    return buckets, [*before, running]


def _place(buckets: list[int], before: list[int], rank: int) -> tuple[int, int]:
    i = bisect_right(before, rank) - 1
    return buckets[i], rank - before[i]


def _positions(n: int, prob: float) -> tuple[int, int, float]:
    position = prob * (n - 1)
    low = math.floor(position)
    return low, min(low + 1, n - 1), position - low


def _locate(columns, counts, probs) -> set[tuple[str, int, int]]:
    wanted = set()
    for feature in columns:
        buckets, before = _totals(counts, feature)
        if buckets:
            for p in probs:
                low, high, _ = _positions(before[-1], p)
                wanted |= {(feature, *_place(buckets, before, r)) for r in (low, high)}
    return wanted


def _interpolate(feature, counts, probs, values) -> list[float | None]:
    buckets, before = _totals(counts, feature)
    if not buckets:
        return [None] * len(probs)
    out = []
    for p in probs:
        low, high, share = _positions(before[-1], p)
        a = values[feature, *_place(buckets, before, low)]
        b = values[feature, *_place(buckets, before, high)]
        out.append(a if a == b else a + (b - a) * share)
    return out


def _single_value(cuts: list[float], bucket: int) -> bool:
    """Whether bucket number ``bucket`` lies between a value and the next larger one."""
    return 0 < bucket < len(cuts) and cuts[bucket] == math.nextafter(cuts[bucket - 1], math.inf)


def _refine(stacked: DataFrame, crowded: set, cuts: dict[str, list[float]], parts: int = 64) -> dict[str, list[float]]:
    """Cut every crowded bucket into about ``parts`` smaller ones, with frequent values apart."""
    only = F.broadcast(stacked.sparkSession.createDataFrame(sorted(crowded), "feature string, bucket int"))
    probs = [i / parts for i in range(parts + 1)]
    rows = (
        stacked.join(only, ["feature", "bucket"], "left_semi").groupBy("feature", "bucket")
        .agg(F.percentile_approx("value", probs, ACCURACY).alias("points")).collect()
    )
    finer = {c: set(points) for c, points in cuts.items()}
    for row in rows:
        finer[row.feature] |= _with_ties_apart(row.points)
    return {c: sorted(points) for c, points in finer.items()}


def running_totals(
    df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], descending: bool = True,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Exact running and overall sums along ``order`` within each group.

    ``df`` has one row per (``by``, ``order``). Adds ``cum_<sum>`` (this row included) and ``all_<sum>``.
    Rows are ordered inside (group, bucket) only, so a group that holds most of the data still spreads over
    all buckets; the per-bucket totals are a table of at most groups x buckets rows.
    """
    by = list(by)
    if cuts is None:
        n = default_buckets(df)
        cuts = cut_points(df, [order], [i / n for i in range(1, n)])[order]
    bucket = f"{order}_bucket"
    bucketed = add_buckets(df, {order: list(cuts)})
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    inside = Window.partitionBy(*by, bucket).orderBy(direction(order))
    earlier = Window.partitionBy(*by).orderBy(direction(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = (
        bucketed.groupBy(*by, bucket).agg(*[F.sum(s).alias(s) for s in sums])
        .select(
            *by, bucket,
            *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"off_{s}") for s in sums],
            *[F.sum(s).over(whole).alias(f"all_{s}") for s in sums],
        )
    )
    return (
        bucketed.withColumns({f"in_{s}": F.sum(s).over(inside) for s in sums})
        .join(offsets, [*by, bucket])
        .withColumns({f"cum_{s}": F.col(f"off_{s}") + F.col(f"in_{s}") for s in sums})
        .drop(bucket, *[f"in_{s}" for s in sums], *[f"off_{s}" for s in sums])
    )


def hash_order(keys: Sequence[str], seed: int | str) -> Column:
    """Reproducible random order of rows: an MD5 of the seed and the key values."""
    # A missing value is a value of its own: concat_ws would skip it and let (null, a) equal (a, null).
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys]))


def hash_thresholds(
    df: DataFrame, by: Sequence[str], hashed: str, ranks: Callable[[Column], Column], digits: int = 4
) -> DataFrame:
    """Per group, the hashes that stand at the wanted 1-based ranks: (``by``, ``thresholds`` array).

    ``ranks`` maps the group's row count to an array of ranks. No row is sorted globally: hashes are counted
    per leading hex digits, and only the few buckets a rank falls into are looked at again.
    """
    by = list(by)
    keyed = df.select(*by, F.substring(hashed, 1, digits).alias("prefix"), F.col(hashed).alias("h"))
    along, whole = Window.partitionBy(*by).orderBy("prefix"), Window.partitionBy(*by)
    places = (
        keyed.groupBy(*by, "prefix").agg(F.count("*").alias("n"))
        .withColumns({"upto": F.sum("n").over(along), "total": F.sum("n").over(whole)})
        .withColumn("rank", F.filter(
            ranks(F.col("total")), lambda r: (r <= F.col("upto")) & (r > F.col("upto") - F.col("n"))))
        .select(*by, "prefix", F.explode("rank").alias("rank"), (F.col("upto") - F.col("n")).alias("skip"))
    )
    places = settled(places)
    inside = Window.partitionBy(*by, "prefix").orderBy("h")
    ordered = (
        keyed.join(places.select(*by, "prefix"), [*by, "prefix"], "left_semi")
        .groupBy(*by, "prefix", "h").agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(inside))
    )
    return (
        ordered.join(places, [*by, "prefix"])
        .filter((F.col("rank") - F.col("skip") <= F.col("upto"))
                & (F.col("rank") - F.col("skip") > F.col("upto") - F.col("n")))
        .groupBy(*by).agg(F.sort_array(F.collect_list("h")).alias("thresholds"))
    )
