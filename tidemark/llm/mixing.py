"""Mixing sources to target weights by capped water-filling (operator 3).

DataFrame functions only. The driver sees two numbers per round of filling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, shared_table

# Documents of a source are taken in buckets of about this many rows, each of which
# starts from the sum of those before it, so that no source is one task's work.
BUCKET_ROWS = 4096
EXACT = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Runs of characters other than space and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cyclic_weights(sources: DataFrame, source_col: str, cycle: int = 3) -> DataFrame:
    """``(source, weight)``: 1, 2, ... ``cycle``, repeating, by code point, null last.

    ``sources`` has one row per source. Rows are numbered among those with the same
    first character, and the few first characters among themselves.
    """
    lead = F.coalesce(F.substring(source_col, 1, 1), F.lit("")).alias("_lead")
    known = sources.select(source_col, F.col(source_col).isNull().alias("_none"), lead)
    within = Window.partitionBy("_none", "_lead").orderBy(source_col)
    leads = known.groupBy("_none", "_lead").agg(F.count("*").alias("_many"))
    ahead = Window.orderBy("_none", "_lead").rowsBetween(Window.unboundedPreceding, -1)
    leads = leads.withColumn("_before", F.coalesce(F.sum("_many").over(ahead), F.lit(0)))
    numbered = known.withColumn("_place", F.row_number().over(within))
    placed = numbered.join(leads.drop("_many"), ["_none", "_lead"])
    weight = F.pmod(F.col("_before") + F.col("_place") - 1, F.lit(cycle)) + 1
    return placed.select(source_col, weight.cast("bigint").alias("weight"))


def capped_targets(sources: DataFrame, total: int, max_epochs: int) -> DataFrame:
    """Add ``target``: shares of ``total`` by ``weight``, none above its cap.

    ``sources`` has source_size and weight. Sources at or above ``max_epochs`` times
    their size are clamped there and the rest is shared by weight among the others,
    again and again until none is above. A round is one aggregate over the sources.
    """
    cap = (F.col("source_size") * max_epochs).cast(EXACT)
    weight = F.col("weight").cast(EXACT)
    all_weight = sources.agg(F.sum("weight")).first()[0] or 0
    rest, rest_weight = int(total), int(all_weight)
    while True:
        full = cap * F.lit(rest_weight).cast(EXACT) <= weight * F.lit(rest).cast(EXACT)
        clamped, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        now = int(total) - int(clamped) * max_epochs, int(open_weight)
        if now[1] == 0 or now == (rest, rest_weight):
            break
        rest, rest_weight = now
    share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(rest_weight or 1))
    target = F.when(full, (F.col("source_size") * max_epochs).cast("double")).otherwise(share)
    return sources.withColumn("target", target)


def mix_sources(
    documents: DataFrame,
    weights: DataFrame | None = None,
    total: int | None = None,
    max_epochs: int = 3,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """How often each document is taken so that sources meet their target weights.

    Returns ``(id, source, size, source_size, target, repeats, taken)``, one row per row
    of ``documents``. Size is in words; ``weights`` has (source, weight), whole positive
    numbers, and default to 1, 2, 3 repeating by source name. ``total`` words are
    shared, by default as many as there are. Each document is taken as many whole
    times as its source fits into its target; what remains is met by taking
    documents once more in a seeded order until the next would pass the remainder by
    more than half its size. Thus a source is off its target by half a document at
    most, and no document is taken more than ``max_epochs`` times.

    A null source is a source. A source without a weight takes no part: target 0. Null
    texts have size 0. Ids may be null or repeat; rows that agree in id and size are
    interchangeable. Other columns are ignored. Reruns agree.
    """
    plain = documents.select(
        documents[id_col], documents[source_col], word_count(documents[text_col]).alias("size")
    )
    sized = shared_table(plain, "mixing-sizes")
    sources = sized.groupBy(source_col).agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows")
    )
    sources = shared_table(sources, "mixing-sources")
    if weights is None:
        weights = cyclic_weights(sources, source_col)
    weights = weights.select(F.col(source_col).alias("_source"), F.col("weight").cast("bigint"))
    weighted = sources.join(weights, F.col(source_col).eqNullSafe(F.col("_source")), "left")
    weighted = weighted.drop("_source").withColumn("weight", F.coalesce("weight", F.lit(0)))
    if total is None:
        total = sources.agg(F.sum("source_size")).first()[0] or 0
    targets = capped_targets(shared_table(weighted, "mixing-weights"), total, max_epochs)

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = targets.withColumn("_whole", F.coalesce(whole, F.lit(0)).cast("bigint"))
    rest = F.col("target") - F.col("_whole") * F.col("source_size")
    targets = targets.select(
        F.col(source_col).alias("_source"),
        *("source_size target _whole".split()),
        rest.alias("_rest"),
        F.ceil(F.col("_rows") / F.lit(BUCKET_ROWS)).alias("_buckets"),
    )
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    drawn = sized.withColumn("_draw", draw)
    drawn = drawn.join(targets, F.col(source_col).eqNullSafe(F.col("_source")))
    # 52 bits of the draw, as a number from 0 to 1 that has its order.
    place = F.conv(F.substring("_draw", 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    drawn = drawn.withColumn("_bucket", F.floor(place * F.col("_buckets")))
    in_source = Window.partitionBy("_source").orderBy("_bucket")
    sums = drawn.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words"))
    before = F.sum("_words").over(in_source.rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(
        F.col("_source").alias("_from"), F.col("_bucket").alias("_in"), before.alias("_before")
    )
    drawn = drawn.join(
        sums, F.col("_source").eqNullSafe(F.col("_from")) & (F.col("_bucket") == F.col("_in"))
    )
    in_bucket = Window.partitionBy("_source", "_bucket").orderBy("_draw", id_col, "size")
    ahead = F.sum("size").over(in_bucket.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.coalesce(F.col("_before"), F.lit(0)) + F.coalesce(ahead, F.lit(0))
    extra = (F.col("_rest") > 0) & (2 * ahead + F.col("size") <= 2 * F.col("_rest"))
    repeats = F.col("_whole") + extra.cast("bigint")
    return drawn.select(
        id_col,
        source_col,
        "size",
        "source_size",
        "target",
        repeats.alias("repeats"),
        (repeats * F.col("size")).alias("taken"),
    )


def mixed_documents(
    documents: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **settings
) -> DataFrame:
    """The rows of ``documents`` as often as ``mix_sources`` takes them.

    Takes its settings too. Rows of one id are told apart by source and size; where
    these agree as well, they are interchangeable.
    """
    mixed = mix_sources(documents, id_col=id_col, source_col=source_col, text_col=text_col, **settings)
    in_id = Window.partitionBy("_id").orderBy("_source", "_size")
    mixed = mixed.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col("size").alias("_size"), "repeats"
    )
    mixed = mixed.withColumn("_nth", F.row_number().over(in_id)).filter("repeats > 0")
    mixed = mixed.select(F.col("_id").alias("_mixed"), F.col("_nth").alias("_mixed_nth"), "repeats")
    rows = documents.select(
        F.struct(*[documents[name] for name in documents.columns]).alias("_row"),
        documents[id_col].alias("_id"),
        documents[source_col].alias("_source"),
        word_count(documents[text_col]).alias("_size"),
    )
    rows = rows.withColumn("_nth", F.row_number().over(in_id))
    same = F.col("_id").eqNullSafe(F.col("_mixed")) & (F.col("_nth") == F.col("_mixed_nth"))
    rows = rows.join(mixed, same).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "repeats")))
    return rows.select("_row.*")
