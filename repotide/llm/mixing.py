"""Mix sources to target weights by Pareto order sampling.

Sources share the words of the whole corpus by weight. A source's target stops at a multiple of
its size, and the excess goes to the others by weight (``source_targets``). A document is expected
``target / source size`` times, more or less if it has a weight of its own; the whole part of that
number are certain copies, the rest is an inclusion probability p. Documents are ranked by Pareto's
order, u / (1 - u) divided by p / (1 - p) with u a hash of the document, and taken from the front
until the words left over for the source are reached (``order_sample``). The sample has that size
to within one document, whatever the ranks.

Only numbers are shuffled, never texts. The cut is found on a histogram of ranks that is refined
where the cut falls, so no task sorts a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.llm.common import hinted, picked, read, stored, text_key

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Histogram cells per step and source, and steps; the last cell holds some 1 / 2**24 of a source.
CELLS = 4096
STEPS = 2

SIZE = r"[^\x20\x09-\x0D]+"


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SIZE)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) with ``target``: a share by weight, no more than ``most`` times the size.

    Sources rank by code point, null last, and take the weights in turn. A source is capped if its
    cap lies below its part of what sources with lower caps per weight leave over; that order makes
    one pass over the sources enough. Sources are far fewer than documents; they are ranked in one
    task, as a share depends on all of them.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("weight", turn).withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    so_far = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(so_far), F.lit(0))
    ranked = (
        ranked.withColumn("place", F.row_number().over(by_cap))
        .withColumn("level", left / F.sum("weight").over(rest))
        .withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    )
    # The first source that is not capped shares out what is left, and so do all after it.
    level = F.min_by("level", F.when(F.col("open"), F.col("place"))).over(everything)
    target = F.when(F.col("open"), level * F.col("weight")).otherwise(F.col("cap"))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def unit_interval(*columns: Column | str) -> Column:
    """A hash of the columns, strictly between 0 and 1."""
    digits = F.substring(F.md5(F.concat_ws("|", *columns).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**48))


def _cut(rows: DataFrame, steps: int) -> DataFrame:
    """Per source the histogram cell in which the sample ends, and the words that come before it.

    ``cell`` counts cells of width CELLS ** -steps; each step looks into the cell found before.
    """
    state = rows.groupBy("source").agg(F.first("rest").alias("rest"))
    zero = F.lit(0).cast("bigint")
    state = stored(state.withColumns({"cell": zero, "before": zero}), "cut")
    for step in range(1, steps + 1):
        fine = F.floor(F.col("place") * float(CELLS**step))
        inside = rows.select("source", "size", fine.alias("fine")).join(
            hinted(state.withColumnRenamed("source", "of")),
            F.col("source").eqNullSafe(F.col("of")) & (F.floor(F.col("fine") / CELLS) == F.col("cell")),
        )
        sums = inside.groupBy("source", "fine").agg(
            F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("before").alias("before")
        )
        earlier = Window.partitionBy("source").orderBy("fine").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        # The first cell counts even if nothing is left to take.
        last = F.max_by(F.struct("fine", "before"), F.when(F.col("before") < F.col("rest"), F.col("fine")))
        first = F.min_by(F.struct("fine", "before"), "fine")
        state = sums.groupBy("source").agg(
            F.first("rest").alias("rest"), F.coalesce(last, first).alias("found")
        )
        state = state.select("source", "rest", F.col("found.fine").alias("cell"), F.col("found.before"))
        state = stored(state, "cut")
    return state


def order_sample(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Rows (id, size, source, weight, target, source_size) with ``copies``.

    All of a source get the whole part of target / size copies; one more goes to the sample, drawn
    with a probability in proportion to ``weight``, until its words are nearest to what is left.
    Equal rows rank equally, which of them is taken makes no difference. No rows give no rows.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Whole numbers add up the same in any order, so reruns agree to the bit.
    mass = F.ceil(F.col("weight") * F.greatest("size", F.lit(1)) * 1024)
    masses = rows.groupBy("source").agg(F.sum(mass).alias("mass")).withColumnRenamed("source", "of")
    whole = F.floor("ratio")
    chance = (F.col("ratio") - whole) * F.col("weight") * F.col("source_size") * 1024 / F.col("mass")
    chance = F.least(F.greatest(chance, F.lit(1e-9)), F.lit(1 - 1e-9))
    u = unit_interval("id", "size")
    odds = (u / (1 - u)) / (F.col("chance") / (1 - F.col("chance")))
    rows = (
        rows.join(hinted(stored(masses, "masses")), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("ratio", ratio)
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("chance", chance)
        .withColumn("odds", odds)
        .withColumn("place", F.least(F.col("odds") / (1 + F.col("odds")), F.lit(1 - 1e-15)))
        .drop("of", "mass", "ratio", "chance", "odds")
    )
    rows = stored(rows, "ranked")
    cut = _cut(rows, steps).select(F.col("source").alias("of"), "cell", "before")
    cell = F.floor(F.col("place") * float(CELLS**steps))
    rows = rows.join(hinted(cut), F.col("source").eqNullSafe(F.col("of"))).withColumn("own", cell)
    order = Window.partitionBy("source").orderBy("place", "id", "size")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where("own = cell")
    edge = edge.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    edge = edge.withColumn("more", F.col("before") + F.col("size") / 2 < F.col("rest"))
    others = rows.where("own <> cell").withColumn("more", F.col("own") < F.col("cell"))
    decided = others.unionByName(edge)
    copies = F.col("whole") + F.col("more").cast("int")
    return decided.withColumn("copies", copies.cast("int")).drop(
        "of", "own", "cell", "before", "more", "whole", "rest", "place"
    )


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per document its size, its source's size and target, and the copies and words the mix takes.

    A null text has no words; a null source is a source of its own. Shorter documents are likelier
    to be sampled, by the root of their length, so that a mix of given words holds more of them.
    Repeated rows are separate documents; very long texts are counted whole, and may be most of what a
    source misses its target by; other columns are ignored. No rows give no rows.
    """
    rows = docs.select(
        "doc_id", "source", size_in_words(F.col("text")).alias("size"), text_key(docs).alias("text_id")
    )
    rows = stored(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, most), "targets")
    weight = 1 / F.sqrt(F.greatest("size", F.lit(1)).cast("double"))
    joined = rows.join(
        hinted(targets.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")
    taken = order_sample(joined.withColumnRenamed("doc_id", "id").withColumn("weight", weight))
    return taken.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
        "source",
        "copies",
        "text_id",
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it."""
    return picked(docs, mix(docs, weights, most).select("doc_id", "text_id", "copies"))


def op5_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).drop("source", "copies", "text_id")


SQL = """
WITH d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
c AS (
  SELECT *, 3 * source_size AS cap,
    row_number() OVER (ORDER BY 3 * source_size / weight, source IS NULL, source) AS place FROM s),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM c) - coalesce(sum(cap) OVER (
      ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
t AS (
  SELECT source, source_size,
    CASE WHEN level * weight < cap THEN (SELECT arg_min(level, place) FROM l WHERE level * weight < cap)
      * weight ELSE cap END::DOUBLE AS target
  FROM l),
m AS (
  SELECT source, sum(ceil(1 / sqrt(greatest(size, 1)::DOUBLE) * greatest(size, 1) * 1024)::BIGINT) AS mass
  FROM d GROUP BY source),
r AS (
  SELECT d.doc_id, d.size, t.*, m.mass, 1 / sqrt(greatest(size, 1)::DOUBLE) AS weight,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio,
    (('0x' || substr(md5(concat_ws('|', doc_id, size)), 1, 12))::BIGINT::DOUBLE + 0.5)
      / 281474976710656.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    JOIN m ON d.source IS NOT DISTINCT FROM m.source),
p AS (
  SELECT *, floor(ratio) AS whole, least(greatest(
    (ratio - floor(ratio)) * weight * source_size * 1024 / mass, 1e-9::DOUBLE), (1 - 1e-9)::DOUBLE) AS chance
  FROM r),
o AS (SELECT *, (u / (1 - u)) / (chance / (1 - chance)) AS odds FROM p),
b AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source
    ORDER BY least(odds / (1 + odds), (1 - 1e-15)::DOUBLE), doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM o)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (whole + CASE WHEN before + size / 2 < target - whole * source_size THEN 1 ELSE 0 END))::BIGINT
    AS taken
FROM b
"""
