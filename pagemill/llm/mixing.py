"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is how often each of its documents should be
taken: a whole number of copies for all, and a fraction that is a copy
probability. Rounding the probabilities one by one would scatter the words
taken. Here two documents at a time exchange expected words until one of them
has a probability of 0 or 1; which way is random, by a hash, so that every
document keeps its probability while the source keeps its sum. What is left
over in a group of documents, one at most, goes up a tree of groups; the last of a source
is rounded by a draw, so a source misses its target by less than one copy of a document.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm import store

WEIGHTS = (5.0, 2.0, 1.0)
VOLUME = 1.5  # words taken, as a share of all
MOST_COPIES = 2.0
GROUP_ROWS = 8192  # documents that one task rounds together
SEED = "mix"

_EDGE = 1e-9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """sizes: source, source_size. Adds target.

    Weights go over the sources in code-point order, null last. The level at
    which the words run out, `least(cap, level * weight)` for each, follows from
    the sources in the order in which they reach their cap. One row a source: their
    documents are summed before.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]),
        ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"),
    )
    rows = sizes.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * F.lit(MOST_COPIES)
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(VOLUME)
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    # the first source whose cap is not reached sets the level of it and all after it
    rows = rows.withColumn("level", level).withColumn(
        "open", F.col("level") * F.col("weight") <= F.col("cap")
    )
    final = F.min(F.when(F.col("open"), F.struct("n", "level"))).over(everything)
    rows = rows.withColumn("n", F.row_number().over(by_cap)).withColumn("final", final)
    target = F.when(
        F.col("final").isNotNull() & (F.col("n") >= F.col("final.n")),
        F.least(F.col("cap"), F.col("final.level") * F.col("weight")),
    ).otherwise(F.col("cap"))
    return rows.select("source", "source_size", target.alias("target"))


def _draw(a: int, b: int) -> float:
    """A number in [0, 1) from two keys."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) % (1 << 64)
    for _ in range(2):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 % (1 << 64)
    return ((x ^ x >> 32) >> 11) / (1 << 53)


def round_pairs(
    key: np.ndarray, size: np.ndarray, probability: np.ndarray
) -> tuple[np.ndarray, int | None]:
    """Probabilities after pairing, all 0 or 1 but for at most one, and that one's position.

    The sum of size * probability stays, and each probability is kept in expectation.
    """
    p = probability.astype(float).copy()
    p[p < _EDGE], p[p > 1 - _EDGE] = 0, 1
    left: int | None = None
    for i in np.flatnonzero((p > 0) & (p < 1)).tolist():
        if left is None:
            left = i
            continue
        a, b = size[left], size[i]
        # words that can move from i to left, and from left to i
        up = min(a * (1 - p[left]), b * p[i])
        down = min(a * p[left], b * (1 - p[i]))
        move = up if _draw(int(key[left]), int(key[i])) * (up + down) < down else -down
        p[left] += move / a
        p[i] -= move / b
        for j in (left, i):
            if p[j] < _EDGE:
                p[j] = 0
            elif p[j] > 1 - _EDGE:
                p[j] = 1
        open_ = [j for j in (left, i) if 0 < p[j] < 1]
        left = open_[0] if open_ else None
    return p, left


def _text_hash() -> Column:
    return F.xxhash64("text", F.col("text").isNull())


def mix(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, text_hash, size, source_size, target, copies, taken.

    Size is the number of words `[^\\x20\\x09-\\x0D]+`; a null text has none. Rows
    equal in doc_id, source and text are rounded as one: each gets the same
    copies. Documents without words take no
    part in the exchange and are copied by a draw with their source's
    probability. The result depends on ids, sources and texts alone. Other columns are not
    read; no documents make no rows.
    """
    plan = _plan(documents)
    return plan.withColumn("rows", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("rows")


def _plan(documents: DataFrame) -> DataFrame:
    """What mix() returns, a row for all rows that are equal, and their number."""
    units = store.written(
        documents.select(
            "doc_id",
            "source",
            _text_hash().alias("text_hash"),
            n_words(F.col("text")).alias("size"),
        )
        .groupBy("doc_id", "source", "text_hash", "size")
        .agg(F.count("*").alias("rows")),
        "mix-units",
    )
    sums = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"),
        F.count("*").alias("n_units"),
    )
    wanted = store.written(
        targets(sums.select("source", "source_size"))
        .withColumnRenamed("source", "s")
        .join(sums.select(F.col("source").alias("s2"), "n_units"), F.expr("s <=> s2"))
        .drop("s2"),
        "mix-targets",
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.xxhash64(F.lit(SEED), "doc_id", "source", "text_hash")
    planned = (
        units.join(wanted, F.expr("source <=> s"))
        .drop("s")
        .withColumn("whole", F.floor(ratio + F.lit(_EDGE)))
        .withColumn("p", F.greatest(ratio - F.col("whole"), F.lit(0.0)))
        .withColumn("key", key)
        .withColumn("mass", F.col("size") * F.col("rows"))
        # groups of a source by hash: a hot source is as many tasks as it needs
        .withColumn(
            "group",
            F.pmod("key", F.ceil(F.col("n_units") / F.lit(GROUP_ROWS))).cast("long"),
        )
    )
    columns = "doc_id, source, text_hash, size, rows, source_size, target, whole, key, mass, group"
    columns = [c.strip() for c in columns.split(",")]

    def rounded(_: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        # large documents first: what is left over in the end is then a small one
        order = np.lexsort((batch["key"], -batch["mass"]))
        batch = batch.iloc[order].reset_index(drop=True)
        p = batch["p"].to_numpy(float)
        mass = batch["mass"].to_numpy()
        draws = [_draw(k, 1) for k in batch["key"].tolist()]
        p = np.where(mass > 0, p, np.array(draws) < p)
        batch["p"], _ = round_pairs(batch["key"].to_numpy(), mass, p)
        return batch

    kinds = {c: t for c, t in planned.dtypes}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (*columns, "p"))
    n = units.groupBy().agg(F.max("size")).first()
    groups = wanted.agg(F.max(F.ceil(F.col("n_units") / F.lit(GROUP_ROWS)))).first()[0]
    if n[0] is None:
        groups = 0
    # null ids and hashes as text: pandas has no null integer
    level = planned.select(*columns, "p")
    done: DataFrame | None = None
    while True:
        text_keys = level.withColumn("doc_id", F.col("doc_id").cast("string"))
        text_schema = schema.replace(f"`doc_id` {kinds['doc_id']}", "`doc_id` string")
        out = store.written(
            text_keys.groupBy("source", "group").applyInPandas(rounded, text_schema).withColumn(
                "doc_id", F.col("doc_id").cast(kinds["doc_id"])
            ),
            "mix-level",
        )
        settled = out.where("p = 0 OR p = 1")
        rest = out.where("p > 0 AND p < 1")
        done = settled if done is None else done.unionByName(settled)
        if not groups or groups <= 1:
            # one left per source: a draw decides
            last = rest.withColumn(
                "p",
                F.when(
                    F.pmod(F.xxhash64(F.lit("last"), "key"), F.lit(1 << 40)) / float(1 << 40)
                    < F.col("p"),
                    1.0,
                ).otherwise(0.0),
            )
            done = done.unionByName(last)
            break
        # what is left of up to GROUP_ROWS groups meets in one
        groups = math.ceil(groups / GROUP_ROWS)
        level = rest.withColumn("group", F.floor(F.col("group") / GROUP_ROWS))
    copies = (F.col("whole") + F.col("p")).cast("long")
    return done.select(
        "doc_id",
        "source",
        "text_hash",
        "size",
        "rows",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The documents of the mix, with all their columns: each row as often as it is taken."""
    plan = _plan(documents)
    mine, copy = (store.free_name(documents, n) for n in ("text_hash", "copy"))
    spare = {c: store.free_name(documents, f"mix_{c}") for c in plan.columns}
    plan = plan.where("copies > 0").withColumnsRenamed(spare)
    keyed = documents.withColumn(mine, _text_hash())
    same = (
        F.col("doc_id").eqNullSafe(F.col(spare["doc_id"]))
        & F.col("source").eqNullSafe(F.col(spare["source"]))
        & (F.col(mine) == F.col(spare["text_hash"]))
    )
    return (
        keyed.join(plan, same)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(spare["copies"]))))
        .select(*[F.col(f"`{c}`") for c in documents.columns])
    )
