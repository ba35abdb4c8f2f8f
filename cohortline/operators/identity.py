"""Identity map: which users, e-mails and earlier ids an id has been seen with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

ATTRIBUTES = ("user_id", "email_address", "distinct_id_before_identity")


def seen_pairs(events: DataFrame, attribute: str) -> DataFrame:
    """Distinct (id, attribute) pairs without nulls."""
    return (
        events.where(F.col("distinct_id").isNotNull() & F.col(attribute).isNotNull())
        .select("distinct_id", attribute)
        .distinct()
    )


def identity_map(events: DataFrame) -> DataFrame:
    """Every combination of attributes seen with an id; ids without any keep one row of nulls.

    Each side is deduplicated before the joins, so what is joined grows with
    the identities, not with the events.
    """
    ids = events.select("distinct_id").distinct()
    for attribute in ATTRIBUTES:
        ids = ids.join(seen_pairs(events, attribute), "distinct_id", "left")
    return ids.select("distinct_id", *ATTRIBUTES)


def email_pairs(events: DataFrame) -> DataFrame:
    """The map cut down to (id, e-mail), straight from the events; ids without e-mail keep a null."""
    return events.select("distinct_id").distinct().join(
        seen_pairs(events, "email_address"), "distinct_id", "left"
    )


def email_weights(identity: DataFrame) -> DataFrame:
    """How many map rows each (id, e-mail) has, so a join fans out as a count instead of as rows."""
    return identity.groupBy("distinct_id", "email_address").agg(F.count("*").alias("weight"))


def identity_factors(events: DataFrame) -> DataFrame:
    """The map without its product: one row per id, attribute and value, and one with null attribute per id.

    One scan and one aggregate, dealt by id and value, so an id that is shared by
    very many e-mails and earlier ids is as many rows and no more, on many tasks.
    """
    own = F.struct(F.lit(None).cast("string").alias("attribute"), F.lit(None).cast("string").alias("value"))
    seen = [F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in ATTRIBUTES]
    rows = events.select("distinct_id", F.inline(F.array(own, *seen)))
    real = F.col("distinct_id").isNotNull() & F.col("value").isNotNull()
    return rows.where(F.col("attribute").isNull() | real).distinct()


def factor(factors: DataFrame, attribute: str) -> DataFrame:
    """Distinct (id, attribute) pairs without nulls, as :func:`seen_pairs`."""
    return factors.where(F.col("attribute") == attribute).select("distinct_id", F.col("value").alias(attribute))


def expand(factors: DataFrame, attributes: Sequence[str] = ATTRIBUTES, ids: DataFrame | None = None) -> DataFrame:
    """Map rows on demand: every combination of the attributes asked for, of all ids or of those in ``ids``."""
    rows = factors.where(F.col("attribute").isNull()).select("distinct_id")
    if ids is not None:
        rows = rows.join(ids.select("distinct_id").distinct(), "distinct_id", "left_semi")
    for attribute in attributes:
        rows = rows.join(factor(factors, attribute), "distinct_id", "left")
    return rows.select("distinct_id", *attributes)


def factor_weights(factors: DataFrame) -> DataFrame:
    """:func:`email_weights` of the ids with an e-mail: counts of the other attributes stand for their rows."""
    others = [a for a in ATTRIBUTES if a != "email_address"]
    counts = factors.where(F.col("attribute").isin(*others)).groupBy("distinct_id").agg(
        *[F.sum(F.when(F.col("attribute") == a, 1).otherwise(0)).alias(f"_{a}") for a in others])
    weight = F.lit(1).cast("long")
    for a in others:
        weight = weight * F.greatest(F.coalesce(f"_{a}", F.lit(1)), F.lit(1))
    return factor(factors, "email_address").join(counts, "distinct_id", "left").select(
        "distinct_id", "email_address", weight.alias("weight"))


def pair_weights(events: DataFrame) -> DataFrame:
    """:func:`email_weights` of the ids with an e-mail, straight from the events: the map's product is never built."""
    return factor_weights(identity_factors(events))
