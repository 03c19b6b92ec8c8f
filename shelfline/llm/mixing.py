"""Mixing sources to target weights by Pareto order sampling (operator 13).

A document's size is its number of words, runs of anything but ASCII white space. The mix holds `share` times all words.

1.  Targets. Sources in order of their names share the words of the mix by their weights. A target stops at `most`
    times its source's words; what is above is shared again by weight until no target is above. A round needs two sums
    over the sources and nothing else, so it runs on any number of them.
2.  Certain copies. As many whole copies of each document as the target holds whole sources.
3.  Inclusion. The rest of a target is less than the source. A document's expected part of it is as the power
    `exponent` of its size, one whole copy at most, and again what is above goes to the others. With 0.5, a rest goes over
    more documents than with 1 (equal probabilities), and one very long text doesn't decide it. Since the limit binds
    the short ones first, the solution comes from a histogram of sizes per source, at most one row per size.
4.  Pareto order. Documents of a source are ranked by the odds of a random number over the odds of their inclusion;
    those whose inclusion is certain come first. The sample is of a fixed size in words: the first documents of the order that
    fit into the rest. Then the document whose size comes nearest to what still lacks closes the gap, if it narrows it.

Random numbers are the MD5 of a seed and doc_id, so the mix is a function of the table: reruns agree, however it is split.
Word counts are summed as whole numbers. Running sums come from ranges of the order and the sums of the ranges before, so
a source with most documents is spread over all tasks; nothing but sums for the targets reaches the driver.

Null text: no words. A null source is one of its own, the last. Documents without words take no part (taken 0). Documents
that share a doc_id share its random number; ties go by doc_id (null first), then size, and rows that are equal in all of
these are interchangeable. A table without words has targets of 0. No rows: none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfline.llm.common import stored, table

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
EXPONENT = 0.5
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
_UNIT = 1 << 16  # parts of a weight are whole numbers, so that their sums don't depend on their order


def sized(documents: DataFrame) -> DataFrame:
    """(row, doc_id, source, size), stored: one row per document, `row` telling equal ones apart."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")


def with_sum_before(rows: DataFrame, group: str, order: Sequence[Column | str], value: str) -> DataFrame:
    """Add `before`: the sum of a column over the rows of a group that come earlier in an order without ties.

    Rows lie in ranges of (group, order), sums are formed inside a range, and the sums of a group's earlier ranges are added.
    """
    laid = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    laid = stored(laid.withColumn("_range", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy("_group").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    sums = laid.groupBy(F.col("_range").alias("_in"), F.col(group).alias("_group")).agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    inside = Window.partitionBy("_range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = laid.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = summed.join(sums, (F.col("_range") == F.col("_in")) & (F.col(group) == F.col("_group")))
    return joined.withColumn("before", F.col("_inside") + F.col("_offset")).select(*rows.columns, "before")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, of, source_size, target), stored: the words each source gives to the mix; `of` is its place."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumns({"one": F.lit(1).cast("bigint"), "all": F.lit(0)})
    placed = with_sum_before(sources, "all", [F.col("source").asc_nulls_last()], "one").withColumnRenamed("before", "of")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("of") % len(weights) + 1).cast("int"))
    placed = placed.withColumns({"weight": weight, "cap": F.lit(most) * F.col("source_size")})
    total, rest = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    spare, capped = share * total, -1
    while rest:
        above = F.lit(spare) * F.col("weight") > F.col("cap") * F.lit(rest)
        below = F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))
        found = placed.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)), below).first()
        if found[0] == capped:
            break
        capped, spare, rest = found[0], share * total - found[1], found[2]
    # Without a source below its limit (or any at all), the limits are the targets.
    cap = F.col("cap").cast("double")
    target = F.when(above, cap).otherwise(F.lit(spare) * F.col("weight") / F.lit(rest)) if rest else cap
    return stored(placed.select("source", "of", "source_size", target.alias("target")), "targets")


def tempered(size: Column, exponent: float) -> Column:
    """A size's weight, a whole number."""
    return F.floor(F.lit(float(_UNIT)) * (F.sqrt(size) if exponent == 0.5 else F.pow(size, F.lit(exponent)))).cast("bigint")


def inclusions(sizes: DataFrame, exponent: float = EXPONENT) -> DataFrame:
    """(of, size, inclusion): the probability of one more copy, by place of the source and size (input: of, rest, size).

    Sizes from the shortest on are certain while their part would be a whole copy or more.
    """
    by_size = Window.partitionBy("of").orderBy("size")
    shorter, longer = by_size.rowsBetween(Window.unboundedPreceding, -1), by_size.rowsBetween(0, Window.unboundedFollowing)
    counts = sizes.groupBy("of", "rest", "size").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("weight", tempered(F.col("size"), exponent))
    spare = F.col("rest") - F.coalesce(F.sum(F.col("n") * F.col("size")).over(shorter), F.lit(0))
    counts = counts.withColumns({"spare": spare, "weights": F.sum(F.col("n") * F.col("weight")).over(longer)})
    certain = F.col("spare") * F.col("weight") >= F.col("size") * F.col("weights")
    # The figures of the shortest size that isn't certain hold for all longer ones.
    level = F.struct("spare", "weights")
    counts = counts.withColumn("certain", certain)
    counts = counts.withColumn("level", F.first(F.when(~F.col("certain"), level), ignorenulls=True).over(by_size.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    part = F.col("level.spare") * F.col("weight") / (F.col("level.weights") * F.col("size"))
    return counts.select("of", "size", F.when(F.col("certain"), F.lit(1.0)).otherwise(part).alias("inclusion"))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number inside (0, 1) from 48 bits of the MD5 of the seed and the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def pareto_rank(u: Column, inclusion: Column) -> Column:
    """Random odds over the odds of inclusion; 0 where inclusion is certain, no rank where it is impossible."""
    odds = u * (1.0 - inclusion) / ((1.0 - u) * inclusion)
    return F.when(inclusion >= 1.0, F.lit(0.0)).when(inclusion > 0.0, odds)


def mixed(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    exponent: float = EXPONENT,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies): what the mix takes of every document."""
    sizes = sized(documents)
    aims = targets(sizes, weights, share, most)
    certain = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    aims = aims.withColumn("certain", certain).withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size"))
    rows = sizes.join(aims.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    asked = stored(rows, "asked")

    drawn = asked.filter("size > 0 AND rest > 0")
    chances = inclusions(drawn, exponent).withColumnsRenamed({"of": "_of", "size": "_size"})
    ranked = drawn.join(chances, (F.col("of") == F.col("_of")) & (F.col("size") == F.col("_size")))
    ranked = ranked.withColumn("pareto", pareto_rank(uniform(F.col("doc_id"), seed), F.col("inclusion")))
    ranked = ranked.filter("pareto IS NOT NULL").select("row", "doc_id", "of", "size", "rest", "pareto")
    order = ["pareto", "doc_id", "size", "row"]
    ranked = stored(with_sum_before(ranked, "of", order, "size"), "ranked")

    first = F.col("before") + F.col("size") <= F.col("rest")
    lacking = ranked.groupBy("of").agg((F.max("rest") - F.coalesce(F.sum(F.when(first, F.col("size"))), F.lit(0))).alias("gap"))
    left = ranked.filter(~first).join(lacking.withColumnRenamed("of", "_of"), F.col("of") == F.col("_of"))
    left = left.withColumn("off", F.abs(F.col("size") - F.col("gap"))).filter("off < gap")
    closing = left.groupBy("of").agg(F.min(F.struct("off", *order)).alias("best")).select("best.row")
    extra = ranked.filter(first).select("row").unionByName(closing).withColumnRenamed("row", "_row")
    taken = asked.join(extra, F.col("row") == F.col("_row"), "left")
    copies = F.col("certain") + F.when(F.col("_row").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("bigint")
    return taken.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mixture(documents: DataFrame, mix: DataFrame) -> DataFrame:
    """The mix itself: each row of the documents as often as the mix takes it, with the number of the copy.

    Rows that share a doc_id are each taken as often as the one that is taken most.
    """
    times = mix.groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_times")).filter("_times > 0")
    taken = documents.join(times, F.col("doc_id").eqNullSafe(F.col("_id")))
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).drop("_id", "_times")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


# The rounds of resharing as a recursion, running sums as windows over whole sources.
ORACLE = r"""
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
sources AS MATERIALIZED (
  SELECT source, source_size, 2 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
rounds AS (
  SELECT 0 AS round, CAST(1.5 AS DOUBLE) * sum(source_size) AS spare, CAST(sum(weight) AS BIGINT) AS rest FROM sources
  UNION ALL
  SELECT r.round + 1,
         (SELECT CAST(1.5 AS DOUBLE) * sum(source_size) - coalesce(sum(cap) FILTER (r.spare * weight > cap * r.rest), 0) FROM sources),
         (SELECT CAST(sum(weight) FILTER (r.spare * weight <= cap * r.rest) AS BIGINT) FROM sources)
  FROM rounds AS r WHERE r.round < (SELECT count(*) FROM sources)),
levels AS (SELECT spare, rest FROM rounds ORDER BY round DESC LIMIT 1),
aims AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS certain
  FROM (SELECT source, source_size, CASE WHEN spare * weight > cap * rest THEN CAST(cap AS DOUBLE) ELSE spare * weight / rest END AS target
        FROM sources, levels)),
docs AS MATERIALIZED (
  SELECT d.doc_id, d.size, a.*, a.target - a.certain * a.source_size AS lack
  FROM sized AS d JOIN aims AS a ON d.source IS NOT DISTINCT FROM a.source),
weighed AS (
  SELECT *, CAST(floor(65536 * sqrt(CAST(size AS DOUBLE))) AS BIGINT) AS part FROM docs WHERE size > 0 AND lack > 0),
shared AS (
  SELECT *, lack - coalesce(CAST(sum(size) OVER shorter AS BIGINT), 0) AS spare, CAST(sum(part) OVER longer AS BIGINT) AS parts
  FROM weighed WINDOW
    shorter AS (PARTITION BY source ORDER BY size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP),
    longer AS (PARTITION BY source ORDER BY size RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
levelled AS (
  SELECT *, spare * part >= size * parts AS sure,
         min_by({'spare': spare, 'parts': parts}, size) FILTER (spare * part < size * parts) OVER (PARTITION BY source) AS level
  FROM shared),
drawn AS (
  SELECT *, (CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656 AS u,
         CASE WHEN sure THEN 1.0::DOUBLE ELSE level.spare * part / CAST(level.parts * size AS DOUBLE) END AS p
  FROM levelled),
ranked AS MATERIALIZED (
  SELECT doc_id, source, size, lack, pareto, sum(size) OVER (PARTITION BY source ORDER BY pareto, doc_id NULLS FIRST, size) <= lack AS early
  FROM (SELECT *, CASE WHEN p >= 1 THEN 0.0::DOUBLE ELSE u * (1 - p) / ((1 - u) * p) END AS pareto FROM drawn)),
gaps AS (SELECT source, max(lack) - coalesce(sum(size) FILTER (early), 0) AS gap FROM ranked GROUP BY source),
closing AS (
  SELECT r.doc_id, r.source FROM ranked AS r JOIN gaps AS g ON r.source IS NOT DISTINCT FROM g.source
  WHERE NOT r.early AND abs(r.size - g.gap) < g.gap
  QUALIFY row_number() OVER (PARTITION BY r.source ORDER BY abs(r.size - g.gap), r.pareto, r.doc_id NULLS FIRST, r.size) = 1),
extra AS (SELECT doc_id, source FROM ranked WHERE early UNION ALL SELECT doc_id, source FROM closing)
SELECT d.doc_id, d.size, d.source_size, d.target,
       CASE WHEN e.doc_id IS NULL THEN d.certain ELSE d.certain + 1 END * d.size AS taken
FROM docs AS d LEFT JOIN extra AS e ON d.doc_id = e.doc_id AND d.source IS NOT DISTINCT FROM e.source"""
