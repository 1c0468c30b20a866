"""Running totals and values at given ranks, over groups of any size, as lazy plans.

A window over one feature, label or request path would put that whole group into one task. Here the
order column is cut into chunks by a histogram in two levels: first into `BUCKETS` buckets for each power
of two, by an expression of the value alone, then each bucket into equal widths between its own smallest
and largest value, as many as its rows need. Counts and bounds are exact, so two evaluations always cut
alike: nothing has to be written in between. Each chunk is summed on its own, and the sum of the chunks
before it is added. Only one row per chunk is put in order across chunks.

Groups are few (features, classes, request paths), and doubles have some two thousand powers of two: the
histogram, one row per group and bucket in use, is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 64
CHUNK_ROWS = 100_000
_CHUNK = ["_g", "_bucket", "_part"]
_POWERS = 1100  # more than the powers of two of doubles, on either side of one


def _bucket_sql(buckets: int) -> str:
    """A bucket number that never falls as `_at` grows: NULL first, then negative numbers, zero, positive ones, NaN."""
    size = f"int(least({_POWERS}D * {buckets}, floor(log2(abs(_at)) * {buckets})) + {_POWERS} * {buckets} + 1)"
    last = 3 * _POWERS * buckets
    return (
        f"CASE WHEN _at IS NULL THEN -{last} WHEN isnan(_at) THEN {last} WHEN _at = 0 THEN 0 WHEN _at > 0 THEN {size} ELSE -{size} END"
    )


def _width_sql(low: str, high: str, n: str) -> str:
    """Which of n equal widths `_at` lies in; never falls as `_at` grows, whatever is infinite or overflows."""
    inside = f"least({high}, greatest({low}, _at))"
    share = f"coalesce(({inside} - {low}) / nullif({high} - {low}, 0D), 0D) * {n}"
    return f"int(floor(least({n} - 1D, greatest(0D, {share}))))"


def chunked(df: DataFrame, groups: list[str], position: str, buckets: int = BUCKETS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """`df` with `_g`, `_bucket` and `_part`, which sort as the number `position` does inside a group.

    A struct holds the group, so that a NULL group is a group and joins as one.
    """
    placed = df.withColumns({"_g": F.struct(*groups), "_at": F.expr(f"double({position})")})
    first = placed.withColumn("_bucket", F.expr(_bucket_sql(buckets)))
    finite = "CASE WHEN NOT isnan(_at) AND abs(_at) < double('Infinity') THEN _at END"
    fill = first.groupBy("_g", "_bucket").agg(
        F.expr(f"min({finite})").alias("_low"), F.expr(f"max({finite})").alias("_high"),
        F.expr(f"double(ceil(count(1) / {chunk_rows}))").alias("_parts"),
    )
    # the broadcast side has at most a row for each group and bucket
    second = first.join(F.broadcast(fill), ["_g", "_bucket"])
    part = F.expr(f"CASE WHEN _at IS NULL OR isnan(_at) THEN 0 ELSE {_width_sql('_low', '_high', '_parts')} END")
    return second.withColumn("_part", part).drop("_low", "_high", "_parts", "_at")


def running_totals(
    df: DataFrame,
    groups: list[str],
    order: str,
    running: dict[str, str],
    whole: dict[str, str] | None = None,
    position: str | None = None,
    only: str | None = None,
    buckets: int = BUCKETS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add running sums and group sums of measures, both given as measure -> name of the sum.

    A sum in `running` covers the rows of the group up to and including the row, one in `whole`
    all rows of the group. Every running sum also gets its group sum as `name_all`.

    Rows with equal groups and order must be merged beforehand. `position` is SQL for a number that
    never falls as `order` grows, by default the order column itself. `only` keeps the chunks
    where it holds; it may use the group sums, and for a measure m `_start_m` and `_in_m`, the sums of
    the chunks before and of the chunk.
    """
    whole = {m: f"{name}_all" for m, name in running.items()} | (whole or {})
    cut = chunked(df, groups, position or order, buckets, chunk_rows)
    sums = cut.groupBy(*_CHUNK).agg(*[F.sum(m).alias(f"_in_{m}") for m in whole])
    everything = Window.partitionBy("_g")
    earlier = everything.orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *_CHUNK,
        *[F.coalesce(F.sum(f"_in_{m}").over(earlier), F.lit(0)).alias(f"_start_{m}") for m in running],
        *[F.col(f"_in_{m}") for m in running],
        *[F.sum(f"_in_{m}").over(everything).alias(name) for m, name in whole.items()],
    )
    if only:
        starts = starts.where(only)
    inside = Window.partitionBy(*_CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return cut.join(starts, _CHUNK).select(
        *df.columns,
        *[(F.sum(m).over(inside) + F.col(f"_start_{m}")).alias(name) for m, name in running.items()],
        *whole.values(),
    )


def at_ranks(
    counts: DataFrame, groups: list[str], value: str, n: str, ranks: dict[str, str], position: str | None = None,
    buckets: int = BUCKETS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Per group, the values at given ranks, and `total`, the sum of `n`.

    `counts` has distinct values with their numbers of rows, `n`. Ranks count from zero and are SQL over
    `total`. Selection by refining the histogram: counting finds the chunk that holds a rank, and only
    the values of such chunks are put in order. A rank that no row has gives NULL.
    """
    held = {name: rank.replace("total", "total_all") for name, rank in ranks.items()}
    only = " OR ".join(f"(_start_{n} <= {r} AND {r} < _start_{n} + _in_{n})" for r in held.values())
    # the first chunk always stays, so that a group without any of the ranks keeps its row
    ranked = running_totals(
        counts, groups, value, {n: "total"}, position=position, only=f"_start_{n} = 0 OR {only}", buckets=buckets, chunk_rows=chunk_rows
    )
    picked = [
        F.expr(f"max(CASE WHEN total - {n} <= {r} AND {r} < total THEN {value} END)").alias(name) for name, r in held.items()
    ]
    return ranked.groupBy(*groups).agg(*picked, F.max("total_all").alias("total"))
