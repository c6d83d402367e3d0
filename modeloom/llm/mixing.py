"""Mixing sources to target weights by entropy balancing.

Word targets come from weights by water-filling under a repeat limit.  Each document then
gets a rate: among all rates that meet every source's word count, those closest in
relative entropy to 1 (each word counts the same).  The convex dual has one multiplier
per constraint; Newton steps solve it, and rates are the exponentials of the multipliers.
The sums that a step needs are per-constraint aggregates of the documents, so a step
moves one row per source, and the multipliers stay in a table.

Rates become whole copies by systematic rounding: along each source's documents in order
of size, the number of copies so far follows the sum of rates, so the words taken stray
by less than the longest document.  One document per source then takes part of a copy
more or less, which brings its source to its target.

Defined results: NULL text has size 0; documents of size 0 take nothing.  A NULL source is
a source of its own.  A source without words has target 0.  Rows that repeat an id are
documents of their own.  An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modeloom.llm.flow import running_total, unused
from modeloom.plans.staging import materialise

WORD = r"[^\x20\x09-\x0D]+"
REPEATS = 3
NEWTON_STEPS = 60
TOLERANCE = 1e-12


def sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """doc_id, a hash of the text, source and the number of words."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("body"),
        F.col(source).cast("string").alias("source"),
        words.alias("size"),
    )


def source_sizes(sizes: DataFrame) -> DataFrame:
    """source and source_size."""
    return sizes.groupBy("source").agg(F.sum("size").alias("source_size"))


def water_fill(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Add ``target``: all words shared by ``weight``, at most ``repeats`` times a source's size.

    Sources fill up in order of limit / weight, so the level is found from running sums
    over that order: the first source that stays below its limit fixes it.  Sums run over
    range partitions, not over one task.
    """
    limit = F.col("source_size") * F.lit(float(repeats))
    rows = materialise(
        sources.withColumn("limit", limit)
        .withColumn("order", F.col("limit") / F.col("weight"))
        .withColumn("weight", F.col("weight").cast("long"))
    )
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    filled, all_weight = running_total(rows, ["order", "source"], "weight", "weight_before")
    filled, _ = running_total(
        materialise(filled.withColumn("whole", F.col("source_size") * repeats)),
        ["order", "source"], "whole", "limit_before",
    )
    level = (F.lit(float(total)) - F.col("limit_before")) / (
        F.lit(float(all_weight)) - F.col("weight_before")
    )
    filled = materialise(filled.withColumn("level", level))
    found = filled.where("level < order").agg(F.min_by("level", F.struct("order", "source"))).first()
    height = found[0]
    share = F.col("limit") if height is None else F.least(
        F.col("limit"), F.col("weight") * F.lit(float(height))
    )
    return filled.withColumn("target", share)


def multipliers(constraints: DataFrame, sizes: DataFrame) -> DataFrame:
    """Newton steps on the dual: (source, multiplier) so that sum(size * exp(m)) = target.

    The dual is ``sum_s m_s * target_s - sum_i size_i * (exp(m_s(i)) - 1)``.  Its gradient
    and (diagonal) curvature need one sum of tilted words per source, which combine in
    each task.  Steps are limited to one unit upward, from where they converge from
    above without overshooting.
    """
    base = sizes.groupBy("source").agg(F.sum("size").cast("double").alias("mass"))
    state = materialise(
        constraints.join(base, constraints["source"].eqNullSafe(base["source"]))
        .select(constraints["source"], "target", "mass")
        .withColumn("multiplier", F.lit(0.0))
    )
    for _ in range(NEWTON_STEPS):
        tilted = F.col("mass") * F.exp("multiplier")
        step = F.when(
            (F.col("mass") > 0) & (F.col("target") > 0),
            F.least(F.lit(1.0), (F.col("target") - tilted) / tilted),
        ).otherwise(F.lit(0.0))
        state = materialise(
            state.withColumn("step", F.greatest(step, F.lit(-20.0)))
            .withColumn("multiplier", F.col("multiplier") + F.col("step"))
            .drop("step")
            .withColumn("gap", F.abs(F.col("target") - F.col("mass") * F.exp("multiplier")))
        )
        worst = state.where("mass > 0 and target > 0").agg(
            F.max(F.col("gap") / F.col("target"))
        ).first()[0]
        state = state.drop("gap")
        if worst is None or worst <= TOLERANCE:
            break
    return state


def rounded(docs: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Add ``copies`` and ``taken`` to rows of doc_id, source, size, rate and target."""
    rows = docs.withColumn("one", F.lit(1))
    order = ["source", "size", "doc_id"]
    ranked, _ = running_total(materialise(rows), order, "one", "rank")
    first = ranked.groupBy("source").agg(F.min("rank").alias("first"))
    at = (
        ranked.join(first.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("k", F.col("rank") - F.col("first"))
        .drop("_s", "first", "one")
    )
    before = F.floor(F.col("rate") * F.col("k") + 0.5)
    after = F.floor(F.col("rate") * (F.col("k") + 1) + 0.5)
    copies = F.least(after - before, F.lit(repeats))
    at = at.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("long"))
    at = materialise(at.withColumn("whole", F.col("copies") * F.col("size")))
    ends = at.groupBy("source").agg(
        F.round(F.max("target")).cast("long").alias("goal"),
        F.sum("whole").alias("sum_whole"),
        F.max("rank").alias("last"),
        # the largest document that can take a part of a copy more, or less
        F.max_by("rank", F.struct("size", "rank")).alias("largest"),
        F.max_by(
            F.when(F.col("copies") < repeats, F.col("rank")),
            F.struct((F.col("copies") < repeats).cast("int"), "size", "rank"),
        ).alias("more"),
        F.max_by(
            F.when(F.col("copies") > 0, F.col("rank")),
            F.struct((F.col("copies") > 0).cast("int"), "size", "rank"),
        ).alias("less"),
    )
    ends = ends.withColumn("rest", F.col("goal") - F.col("sum_whole")).withColumn(
        "at", F.when(F.col("rest") > 0, F.col("more")).otherwise(F.col("less"))
    )
    fix = ends.where("at is not null and rest <> 0").select("at", "rest")
    moved = F.col("whole") + F.coalesce("rest", F.lit(0))
    taken = F.greatest(F.lit(0), F.least(moved, F.col("size") * repeats)).cast("long")
    return at.join(fix, at["rank"] == fix["at"], "left").withColumn("taken", taken).drop(
        "at", "rest", "whole"
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    repeats: int = REPEATS,
) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken per document.

    ``weights`` holds (source, weight); without it sources, by code point and NULL last,
    weigh 5, 2, 1, repeating.
    """
    sizes = materialise(sized(docs, doc_id, text, source))
    sources = materialise(source_sizes(sizes))
    if weights is None:
        ranked = sources.withColumn("last", F.col("source").isNull().cast("int")).withColumn(
            "one", F.lit(1)
        )
        ranked, _ = running_total(materialise(ranked), ["last", "source"], "one", "nth")
        weight = F.element_at(F.array(F.lit(5), F.lit(2), F.lit(1)), (F.col("nth") % 3 + 1).cast("int"))
        weighted = ranked.select("source", "source_size", weight.alias("weight"))
    else:
        w = weights.select(F.col("source").alias("_s"), "weight")
        weighted = sources.join(w, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source", "source_size", F.coalesce("weight", F.lit(0)).alias("weight")
        )
    filled = water_fill(weighted.where("weight > 0"), repeats)
    filled = filled.select("source", "source_size", "target")
    solved = multipliers(filled, sizes).select(
        F.col("source").alias("_m"),
        F.when((F.col("mass") > 0) & (F.col("target") > 0), F.exp("multiplier"))
        .otherwise(0.0).alias("rate"),
    )
    table = filled.join(solved, F.col("source").eqNullSafe(F.col("_m")), "left").select(
        F.col("source").alias("_s"), "source_size", "target", "rate"
    )
    rated = sizes.join(table, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "doc_id",
        "body",
        "source",
        "size",
        F.coalesce("source_size", F.lit(0)).alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        F.coalesce("rate", F.lit(0.0)).alias("rate"),
    )
    return rounded(rated, repeats)


def _first_words(text: str, n: int) -> str:
    """``text`` up to the end of its n-th word."""
    end = next((m.end() for m in islice(re.finditer(WORD, text), n - 1, n)), len(text))
    return text[:end]


def take_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has whole copies, and where a
    part of a copy is taken, once more with the text up to that word.

    Rows that are equal in id, text and source take turns.  All columns are kept, whatever their
    names.
    """
    columns = docs.columns
    keys = ["id", "body", "from", "turn"]
    mine = unused(columns, *keys)
    theirs = unused([*columns, *mine], *(f"{k}_of" for k in keys), "size", "taken")
    size, taken = theirs[4:]

    def turns(names, order):
        return F.row_number().over(Window.partitionBy(*names[:3]).orderBy(order))

    found = mix(docs, doc_id=doc_id, text=text, source=source).select(
        F.col("doc_id").alias(theirs[0]), F.col("body").alias(theirs[1]),
        F.col("source").alias(theirs[2]), F.col("size").alias(size), F.col("taken").alias(taken),
    )
    found = found.withColumn(theirs[3], turns(theirs, taken)).where(F.col(taken) > 0)
    keyed = docs.select(
        *(F.col(f"`{c}`") for c in columns),
        F.col(doc_id).cast("long").alias(mine[0]),
        F.xxhash64(F.col(text)).alias(mine[1]),
        F.col(source).cast("string").alias(mine[2]),
    )
    keyed = keyed.withColumn(mine[3], turns(mine, F.lit(0)))
    same = reduce(
        lambda x, y: x & y, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(mine, theirs)]
    )
    rows = keyed.join(found, same).select(*(F.col(f"`{c}`") for c in columns), size, taken)
    size_name, taken_name = size, taken
    at = columns.index(text)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(size_name).to_pylist()
            taken = batch.column(taken_name).to_pylist()
            base = batch.select(range(len(columns)))
            rows = [i for i, (s, t) in enumerate(zip(size, taken, strict=True)) for _ in range(t // s)]
            yield base.take(pa.array(rows, pa.int64()))
            cut = [i for i, (s, t) in enumerate(zip(size, taken, strict=True)) if t % s]
            part = base.take(pa.array(cut, pa.int64()))
            texts = [
                _first_words(x, taken[i] % size[i])
                for i, x in zip(cut, part.column(at).to_pylist(), strict=True)
            ]
            field = part.schema.field(at)
            yield part.set_column(at, field, pa.array(texts, field.type))

    return rows.mapInArrow(spread, docs.schema)
