"""Event-time as-of join: for each left row the newest right version not after it.

Both sides go through one window per key, ordered by time with versions before the
rows of the same time; there is no range join. Keys too heavy for one task are cut
into slices of time, and the version in force at the start of a slice is carried
into it from the slices before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import ROWS_PER_TASK, heavy_key_slices, with_slice

# Place of a row among those of one key and time.
_CARRIED, _VERSION, _PROBE = 0, 1, 2


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    arrival: Sequence[str] = (),
    how: str = "inner",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Left columns and the right columns of the version in force.

    ``arrival`` orders right rows of one key and time, the last one wins. ``inner``
    drops left rows before the first version, ``left`` keeps them. Both sides carry
    the key under the same names; a NULL key matches nothing. One counting pass over
    keys and times runs at once to find keys above ``rows_per_task``; None says that
    there are none and leaves it out.
    """
    _check(left, right, keys, how)
    known = left.filter(_all_known(keys, left_time))
    points = known.select(*keys, _micros(left_time).alias("_us")).unionByName(
        right.filter(_all_known(keys, right_time)).select(
            *keys, _micros(right_time).alias("_us")
        )
    )
    slices = rows_per_task and heavy_key_slices(points, keys, "_us", rows_per_task)
    versions = with_slice(_versions(right, keys, right_time), slices, keys, "_us")
    if slices is None or slices.even:
        probes = with_slice(_whole_probes(known, keys, left_time), slices, keys, "_us")
        carried = slices and _carried(probes, versions, keys, arrival, slices.table)
        found = _unpacked(_in_force(probes, versions, keys, arrival, carried), how)
        return _with_unmatchable(found, left, keys, left_time, how)
    # Copies of one key and time stay together however thin the slice. So only the
    # distinct points and one version per point are resolved, and a plain join takes
    # the answers back to the rows; Spark splits that join where it is skewed.
    newest = F.max_by("_right", F.struct(*_arrival(arrival)))
    versions = versions.groupBy(*keys, "_us", "_slice").agg(newest.alias("_right"))
    distinct = known.select(*keys, F.col(left_time).alias("_time")).distinct()
    distinct = distinct.select(
        *keys, _micros("_time").alias("_us"), F.struct("_time").alias("_left")
    )
    probes = with_slice(distinct, slices, keys, "_us")
    carried = _carried(probes, versions, keys, arrival, slices.table)
    found = _in_force(probes, versions, keys, arrival, carried)
    found = found.filter(F.col("_right").isNotNull())
    answers = found.select(*keys, F.col("_left._time").alias(left_time), "_right")
    joined = known.join(answers, [*keys, left_time], how)
    joined = joined.select(*[F.col(f"`{c}`") for c in left.columns], "_right.*")
    return _with_unmatchable(joined, left, keys, left_time, how)


def asof_join_bucketed(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    bucket_seconds: int,
    arrival: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """:func:`asof_join` with the time line of every key cut at fixed steps.

    No counting pass; the caller picks a step whose rows of one key fit a task.
    """
    _check(left, right, keys, how)
    if bucket_seconds < 1:
        raise ValueError("bucket_seconds must be at least 1")
    step = F.lit(bucket_seconds * 1_000_000)
    place = F.floor(F.col("_us") / step).cast("bigint")
    versions = _versions(right, keys, right_time).withColumn("_slice", place)
    known = left.filter(_all_known(keys, left_time))
    probes = _whole_probes(known, keys, left_time).withColumn("_slice", place)
    carried = _carried(probes, versions, keys, arrival)
    found = _unpacked(_in_force(probes, versions, keys, arrival, carried), how)
    return _with_unmatchable(found, left, keys, left_time, how)


def _check(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> None:
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if not keys:
        raise ValueError("an as-of join needs at least one key")
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides, rename one: {sorted(shared)}")


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def _all_known(keys: Sequence[str], time: str) -> Column:
    known = F.col(time).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def _versions(right: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Right rows packed into ``_right`` without the key."""
    payload = F.struct(*[F.col(f"`{c}`") for c in right.columns if c not in keys])
    return right.filter(_all_known(keys, time)).select(
        *keys, _micros(time).alias("_us"), payload.alias("_right")
    )


def _arrival(arrival: Sequence[str]) -> list[Column]:
    """Order of versions of one time. The whole row at the end makes it total."""
    return [*[F.col(f"_right.`{name}`") for name in arrival], F.col("_right")]


def _whole_probes(left: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    return left.select(
        *keys,
        _micros(time).alias("_us"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"),
    )


def _carried(
    probes: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    heavy: DataFrame | None = None,
) -> DataFrame:
    """For each slice that has probes, the last version of the slices before it."""
    if heavy is not None:
        heavy = heavy.select(*keys)
        probes = probes.join(heavy, list(keys), "left_semi")
        versions = versions.join(heavy, list(keys), "left_semi")
    last = versions.groupBy(*keys, "_slice").agg(
        F.max_by("_right", F.struct("_us", *_arrival(arrival))).alias("_right"),
        F.lit(False).alias("_asks"),
    )
    asks = (
        probes.select(*keys, "_slice")
        .distinct()
        .withColumn("_right", F.lit(None).cast(versions.schema["_right"].dataType))
        .withColumn("_asks", F.lit(True))
    )
    # In a slice the question comes first, so that it sees earlier slices only.
    in_order = Window.partitionBy(*keys).orderBy("_slice", F.col("_asks").desc())
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        asks.unionByName(last)
        .withColumn("_right", F.last("_right", ignorenulls=True).over(so_far))
        .filter(F.col("_asks") & F.col("_right").isNotNull())
        .select(*keys, "_slice", "_right")
    )


def _in_force(
    probes: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    carried: DataFrame | None = None,
) -> DataFrame:
    """Probes with the version in force in ``_right``, NULL before the first one."""
    no_right = F.lit(None).cast(versions.schema["_right"].dataType)
    no_left = F.lit(None).cast(probes.schema["_left"].dataType)

    def rows(df: DataFrame, place: int, us: Column, own: Column, version: Column):
        return df.select(
            *keys,
            "_slice",
            us.alias("_us"),
            F.lit(place).alias("_place"),
            own.alias("_left"),
            version.alias("_right"),
        )

    line = rows(probes, _PROBE, F.col("_us"), F.col("_left"), no_right)
    line = line.unionByName(
        rows(versions, _VERSION, F.col("_us"), no_left, F.col("_right"))
    )
    if carried is not None:
        before_all = F.lit(None).cast("bigint")
        line = line.unionByName(
            rows(carried, _CARRIED, before_all, no_left, F.col("_right"))
        )
    in_order = Window.partitionBy(*keys, "_slice").orderBy(
        F.col("_us").asc_nulls_first(), "_place", *_arrival(arrival)
    )
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return line.withColumn(
        "_right", F.last("_right", ignorenulls=True).over(so_far)
    ).filter(F.col("_place") == _PROBE)


def _unpacked(found: DataFrame, how: str) -> DataFrame:
    if how == "inner":
        found = found.filter(F.col("_right").isNotNull())
    return found.select("_left.*", "_right.*")


def _with_unmatchable(
    found: DataFrame, left: DataFrame, keys: Sequence[str], time: str, how: str
) -> DataFrame:
    """For a left join, the rows without key or time; they skip the shuffle."""
    if how == "inner":
        return found
    rest = left.filter(~_all_known(keys, time))
    return found.unionByName(rest, allowMissingColumns=True)
