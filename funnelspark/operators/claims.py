"""Claims on work: who has taken what, so that nothing is done twice, kept in a store of snapshots.

Two that claim at once can't both have a row: the one whose commit comes second is refused whole, sees the other's claims when it
tries again, and gets what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.sources.snapshots import Conflict, Snapshots


def live(store: Snapshots) -> DataFrame | None:
    """id, owner, claimed of the claims that aren't given back."""
    known = store.read("claims")
    return None if known is None else known.filter("released is null").drop("released")


def claim(store: Snapshots, wanted: DataFrame, owner: str, now: str, tries: int = 5) -> DataFrame:
    """Takes those of wanted(id) that nobody has; their ids."""
    for left in range(tries - 1, -1, -1):
        known = store.read("claims")
        free = wanted.select("id").distinct()
        if known is not None:
            free = free.join(known.filter("released is null").select("id"), "id", "left_anti")
        new = free.select("id", F.lit(owner).alias("owner"), F.to_timestamp(F.lit(now)).alias("claimed"), F.lit(None).cast("timestamp").alias("released"))
        try:
            version = store.commit({"claims": new if known is None else known.unionByName(new)})
        except Conflict:
            if not left:
                raise
            continue
        after = store.read("claims", version).filter((F.col("owner") == owner) & F.col("released").isNull())
        return after.select("id") if known is None else after.select("id").join(known.filter((F.col("owner") == owner) & F.col("released").isNull()).select("id"), "id", "left_anti")


def release(store: Snapshots, done: DataFrame, now: str) -> None:
    """Gives claims back, whoever holds them; what isn't claimed stays so."""
    known = store.read("claims")
    if known is not None:
        back = done.select(F.col("id").alias("_id")).distinct()
        both = known.join(back, F.col("id") == F.col("_id"), "left")
        ended = F.coalesce("released", F.when(F.col("_id").isNotNull(), F.to_timestamp(F.lit(now))))
        store.commit({"claims": both.select("id", "owner", "claimed", ended.alias("released"))})
