"""Mixing sources to target weights by the cube method.

A document of a source with target/size ratio r is taken floor(r) times for certain and once more
with probability r - floor(r). The cube method decides the fractional parts: its flight moves three
undecided documents at a time along the direction that changes neither the sum of words nor the sum
of documents, until one of them is decided. Groups of a source fly apart from each other in parallel
and hand their few undecided rows to the next, smaller level; the last dozen of a source are landed
by trying every combination.

Documents above a thousandth of their source (fewer than a thousand by arithmetic) are decided
first. What their landing leaves open is put right through the ratio of the other documents, so a few
huge documents don't spoil the balance.

Defined results: a null or blank text has size 0 and takes 0 words; a null source is a source of its
own, the last one; rows that agree in id, source and size are one unit and share the decision; an
empty table gives an empty mix. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import word_count
from parley.session import SEED, materialise

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2.0
#: Units of a group of the flight, groups that meet in one of the next level, units that are landed.
GROUP, FAN_IN, LANDING = 8192, 256, 12
#: A document above this share of its source is decided before the others.
HEAVY = 1e-3
NEAR = 1e-9
GOLDEN = (5**0.5 - 1) / 2


def source_targets(
    units: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """One row per source: its size, its units and the words to take from it.

    ``units`` has source and mass (words). Sources in code-point order, null
    last, get the weights in turn. Targets are level * weight, cut at ``most`` times the size, with the
    level at which they add up to ``share`` of all words. The windows run over one row per source.
    """
    sources = units.groupBy("source").agg(
        F.sum("mass").alias("source_size"), F.count("*").alias("units")
    )
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.select("*", F.get(weight, turn % len(weights)).alias("weight"))
    ranked = ranked.select("*", (most * F.col("source_size") / F.col("weight")).alias("full_at"))
    everything = Window.partitionBy()
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * share - F.coalesce(
        F.sum(most * F.col("source_size")).over(before), F.lit(0.0)
    )
    open_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    levels = ranked.select("*", (left / open_weight).alias("here"))
    level = F.min(F.when(F.col("here") <= F.col("full_at"), F.struct("full_at", "here"))).over(everything)
    cap = most * F.col("source_size")
    return levels.select("*", level["here"].alias("level")).select(
        "source",
        "source_size",
        "units",
        F.when(F.col("level").isNull(), cap)
        .otherwise(F.least(cap, F.col("level") * F.col("weight")))
        .cast("double")
        .alias("target"),
    )


def fly(mass: np.ndarray, count: np.ndarray, p: np.ndarray, draws: Iterator[float], stop: int) -> np.ndarray:
    """Move ``p`` until at most ``stop`` entries lie between 0 and 1.

    The sums of ``p * mass`` and ``p * count`` stay; each entry keeps its value on average.
    """
    p = p.tolist()
    mass, count = mass.tolist(), count.tolist()
    waiting = [i for i in range(len(p) - 1, -1, -1) if NEAR < p[i] < 1 - NEAR]
    # Sizes of all kinds come last; uneven steps give their sums more values.
    spread = {int(len(waiting) * (k * GOLDEN % 1)) for k in range(stop)}
    waiting = [waiting[i] for i in spread if i < len(waiting)] + [
        x for i, x in enumerate(waiting) if i not in spread
    ]
    hand: list[int] = []
    while True:
        while len(hand) < 3 and waiting:
            hand.append(waiting.pop())
        if len(hand) < 3 or len(hand) + len(waiting) <= stop:
            break
        i, j, k = hand
        way = (
            count[j] * mass[k] - count[k] * mass[j],
            count[k] * mass[i] - count[i] * mass[k],
            count[i] * mass[j] - count[j] * mass[i],
        )
        if not any(way):  # three alike: any two of them can trade
            way = (count[j], -count[i], 0.0)
        up = min((1 - p[x]) / w if w > 0 else p[x] / -w for x, w in zip(hand, way) if w)
        down = min(p[x] / w if w > 0 else (1 - p[x]) / -w for x, w in zip(hand, way) if w)
        step = up if next(draws) * (up + down) < down else -down
        for x, w in zip(hand, way):
            p[x] += step * w
            if p[x] < NEAR:
                p[x] = 0.0
            elif p[x] > 1 - NEAR:
                p[x] = 1.0
        hand = [x for x in hand if 0 < p[x] < 1]
    return np.array(p)


def land(mass: np.ndarray, count: np.ndarray, p: np.ndarray, weight: float = 1e-3) -> np.ndarray:
    """Decide the last entries by the combination that keeps the words, then the documents, best."""
    open_at = np.flatnonzero((p > 0) & (p < 1))
    if not len(open_at):
        return p
    m, c = mass[open_at], count[open_at]
    taken = (np.arange(1 << len(open_at))[:, None] >> np.arange(len(open_at))) & 1
    off = np.abs((taken - p[open_at]) @ m) + weight * np.abs((taken - p[open_at]) @ c)
    out = p.copy()
    out[open_at] = taken[int(off.argmin())]
    return out


UNIT = "doc_id long, source string, mass long, count long, base long, p double, key long, groups long, bucket long"


def _decide(stop: int = LANDING):
    """The flight of one group; a source's only group lands too."""

    def decide(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["mass", "key"], ascending=[False, True], ignore_index=True)
        mass, count = group["mass"].to_numpy(float), group["count"].to_numpy(float)
        seed = np.bitwise_xor.reduce(group["key"].to_numpy().view(np.uint64))
        draws = iter(np.random.default_rng([SEED, int(seed)]).random(len(group) + 1).tolist())
        p = fly(mass, count, group["p"].to_numpy(float), draws, stop)
        if group["groups"].iat[0] == 1:
            p = land(mass, count, p)
        return group.assign(p=p)

    return decide


def _decided(units: DataFrame, most_groups: int) -> DataFrame:
    """All ``units`` with p 0 or 1, by as many levels as the largest source needs."""
    done = []
    while True:
        level = materialise(
            units.groupBy("source", "bucket").applyInPandas(_decide(), UNIT)
        )
        done.append(level.where("p = 0 OR p = 1"))
        if most_groups <= 1:
            break
        units = level.where("p > 0 AND p < 1").withColumns(
            {
                "groups": F.ceil(F.col("groups") / FAN_IN),
                "bucket": F.floor(F.col("bucket") / FAN_IN),
            }
        )
        most_groups = -(-most_groups // FAN_IN)
    out = done[0]
    for level in done[1:]:
        out = out.unionByName(level)
    return out


def _at_ratio(units: DataFrame, ratio, most: float) -> DataFrame:
    """Split the ratio of a source into sure copies and the part left to chance."""
    ratio = F.least(F.greatest(ratio, F.lit(0.0)), F.lit(float(most)))
    base = F.least(F.floor(ratio + NEAR), F.lit(int(most)))
    p = F.greatest(ratio - base, F.lit(0.0))
    return units.withColumns({"base": base, "p": F.when(p > NEAR, p).otherwise(0.0)})


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Only ids, sources and sizes are shuffled; the flight runs in groups of about ``GROUP`` rows.
    """
    units = materialise(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
        )
        .groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("count"))
        .select("*", (F.col("size") * F.col("count")).alias("mass"))
    )
    targets = materialise(source_targets(units, weights, share, most))
    known = targets.withColumnRenamed("source", "of")
    all_units = units.join(known, units["source"].eqNullSafe(known["of"])).select(
        "doc_id", "source", "mass", "count", "source_size", "target",
        F.xxhash64("doc_id", "mass", F.lit(SEED)).alias("key"),
        F.greatest(F.ceil(F.col("units") / GROUP), F.lit(1)).alias("groups"),
        (F.col("mass") > F.col("source_size") * HEAVY).alias("heavy"),
    )
    heavy = _at_ratio(
        all_units.where("heavy").withColumns({"groups": F.lit(1), "bucket": F.lit(0)}),
        F.col("target") / F.col("source_size"),
        most,
    )
    heavy = _decided(heavy.select(*_names()), 1)
    settled = materialise(
        heavy.groupBy("source").agg(
            F.sum("mass").alias("heavy_mass"),
            F.sum(F.col("mass") * (F.col("base") + F.col("p"))).alias("heavy_taken"),
        )
    ).withColumnRenamed("source", "of")
    light = all_units.where("NOT heavy")
    light = light.join(settled, light["source"].eqNullSafe(settled["of"]), "left")
    rest = F.col("source_size") - F.coalesce("heavy_mass", F.lit(0))
    due = F.col("target") - F.coalesce("heavy_taken", F.lit(0.0))
    light = _at_ratio(
        light.withColumn("bucket", F.pmod("key", "groups")),
        F.when(rest > 0, due / rest).otherwise(0.0),
        most,
    )
    largest = targets.agg(F.max("units")).first()[0] or 0
    light = _decided(light.select(*_names()), -(-largest // GROUP))
    taken = heavy.unionByName(light)
    taken = taken.join(known, taken["source"].eqNullSafe(known["of"]))
    size = (F.col("mass") / F.col("count")).cast("long")
    copies = (F.col("base") + F.col("p")).cast("long")
    return taken.select(
        "doc_id", "source", size.alias("size"), "source_size", "target",
        copies.alias("copies"), (size * copies).alias("taken"),
        F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("row"),
    ).drop("row")


def take(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **parameters,
) -> DataFrame:
    """The documents with all their columns, each as often as the mix takes it."""
    taken = mix(docs, id_col, text_col, source_col, **parameters).where("copies > 0")
    taken = taken.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_of"), F.col("size").alias("_size"),
        F.col("copies").alias("_copies"),
    ).distinct()  # rows that agree in all share the decision
    same = (
        docs[id_col].cast("long").eqNullSafe(F.col("_id"))
        & docs[source_col].eqNullSafe(F.col("_of"))
        & (word_count(docs[text_col]) == F.col("_size"))
    )
    return (
        docs.join(taken, same)
        .select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
        .drop("_copy")
    )


def _names() -> list[str]:
    return [field.split()[0] for field in UNIT.split(", ")]
