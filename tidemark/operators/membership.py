"""Users, classes and the links between them, each by its latest values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import epoch_ms_text
from tidemark.operators.latest import latest_by_key


def latest_membership(
    users: DataFrame,
    classes: DataFrame,
    links: DataFrame,
    order: Sequence[str],
) -> DataFrame:
    """Latest name, age, class name and type per ``(uid, cid)`` that all three know.

    Each input is reduced to its latest values before the joins. Joining first would
    pair every version of a user with every version of a class, with the same result.
    """
    return joined_membership(
        latest_by_key(users, ["uid"], ["name", "age"], order),
        latest_by_key(classes, ["cid"], ["cname"], order),
        latest_by_key(links, ["uid", "cid"], ["utype"], order),
    )


def joined_membership(user: DataFrame, clazz: DataFrame, link: DataFrame) -> DataFrame:
    """The join of latest values, a row a key each. Saved in the same buckets of ``uid``,
    links and users meet without a shuffle."""
    joined = link.join(user, "uid").join(clazz, "cid")
    return joined.select("uid", "cid", "name", "age", "cname", "utype")


def latest_membership_windowed(
    users: DataFrame,
    classes: DataFrame,
    links: DataFrame,
    order: Sequence[str],
    time: str = "c_time",
    size: str = "10 minutes",
) -> DataFrame:
    """:func:`latest_membership` per tumbling window of the link's time."""
    user = latest_by_key(users, ["uid"], ["name", "age"], order)
    clazz = latest_by_key(classes, ["cid"], ["cname"], order)
    placed = links.withColumn("_start", F.window(time, size)["start"])
    link = latest_by_key(placed, ["uid", "cid", "_start"], ["utype"], order)
    return (
        link.join(user, "uid")
        .join(clazz, "cid")
        .select(
            "uid",
            "cid",
            epoch_ms_text(F.col("_start")).alias("window_start"),
            "name",
            "age",
            "cname",
            "utype",
        )
    )
