"""Mixing sources to target weights, in DataFrame functions only.

Every row gets a hash-random key. The leading digits of the key cut each source into `16 ** RANGE_DIGITS` key ranges of
about equal weight, so that a source with a third of all rows is spread over as many tasks. Sums per (source, range)
give the offset at which a range begins; a window inside the range adds the rows before a row. The budget of a source
is cut at that running total: whole epochs first, then the rows of the last epoch up to the exact word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, own_names, renamed, without, written

RANGE_DIGITS = 3
ADDED = ("size", "source_size", "target", "taken")


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(_grp, source_size) per source to (_grp, source_size, target).

    Groups in byte order take the weights in turn. The total is shared by weight; a group whose share is above `cap`
    times its size stops there and the excess is shared again, until none is above. An empty total gives targets of 0.
    Ranks come from range partitions and their counts, so no task sees all sources; the driver sees three sums a round.
    """
    parts = written(sizes.repartitionByRange("_grp").withColumn("_part", F.spark_partition_id()), "mix-sources")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy("_grp")) - 1
    turn = F.array(*[F.lit(w) for w in weights])
    ranked = written(parts.join(before, "_part").select(
        "_grp", "source_size", (F.col("source_size") * cap).cast("double").alias("_cap"),
        F.element_at(turn, (rank % len(weights) + 1).cast("int")).cast("double").alias("_weight")), "mix-ranked")
    total, weight = ranked.agg(F.sum("source_size"), F.sum("_weight")).first()
    rest, stopped = float(total or 0), 0
    while True:
        share = F.lit(rest) * F.col("_weight") / F.lit(weight or 1.0)
        above = share > F.col("_cap")
        held, free, n = ranked.agg(F.sum(F.when(above, F.col("_cap"))), F.sum(F.when(~above, F.col("_weight"))),
                                   F.count(F.when(above, 1))).first()
        if n == stopped:
            return ranked.select("_grp", "source_size", F.when(above, F.col("_cap")).otherwise(share).alias("target"))
        rest, weight, stopped = float(total) - held, free, n


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: str = "mix") -> DataFrame:
    """All rows with size (words of the text), source_size, target and taken (words the mix takes, repeats counted).

    Null texts are empty and have size 0; a null source is a source of its own, last in order; null keys hash as ''.
    Rows of one key go by size and a hash of their text, so reruns agree. Repeated rows each count. Columns named like
    the added ones are replaced, other columns pass, whatever they are called. An empty table gives an empty table. The mix of a source is its
    whole rows times `taken // size` plus the first `taken % size` words of the one row that the budget cuts.
    """
    kept = without(docs, *ADDED)
    rows, called = renamed(kept)
    key_text, own_text = F.coalesce(F.col(called[key.lower()]).cast("string"), F.lit("")), called[text.lower()]
    sized = (rows.withColumn("size", word_count(own_text)).withColumn("_text", F.xxhash64(own_text))
             .withColumn("_grp", F.coalesce(F.concat(F.lit("s"), F.col(called[source.lower()]).cast("string")), F.lit("~")))
             .withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), key_text)))
             .withColumn("_range", F.substring("_hash", 1, RANGE_DIGITS)))
    sums = written(sized.groupBy("_grp", "_range").agg(F.sum("size").alias("_words")), "mix-ranges")
    targets = source_targets(sums.groupBy("_grp").agg(F.sum("_words").alias("source_size")), weights, cap)
    ordered = Window.partitionBy("_grp").orderBy("_range")
    offsets = (sums.withColumn("_offset", F.sum("_words").over(ordered) - F.col("_words"))
               .join(targets, "_grp").drop("_words"))
    inside = Window.partitionBy("_grp", "_range").orderBy("_hash", key_text, "size", "_text")
    before = F.col("_offset") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    last = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), last - F.col("_before")))
    return (sized.join(offsets, ["_grp", "_range"]).withColumn("_before", before)
            .withColumn("taken", taken.cast("long"))
            .select(*own_names(kept), *ADDED))


ORACLE_SQL = """WITH sized AS (SELECT doc_id, coalesce(length(regexp_replace(regexp_replace(text, '[^\\x20\\x09-\\x0D]+', 'w', 'g'), '[\\x20\\x09-\\x0D]+', '', 'g')), 0) AS size,
  coalesce('s' || source, '~') AS grp, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
src AS (SELECT grp, CAST(sum(size) AS BIGINT) AS source_size, [1, 2, 3][1 + (row_number() OVER (ORDER BY grp) - 1) % 3] AS w FROM sized GROUP BY grp),
line AS (SELECT *, sum(3 * source_size) OVER o AS held, sum(w) OVER o AS gone, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w
  FROM src WINDOW o AS (ORDER BY source_size / w, grp ROWS UNBOUNDED PRECEDING)),
level AS (SELECT * FROM (SELECT 0 AS held, 0 AS gone, min(source_size * 3.0 / w) AS next, any_value(total) AS total, any_value(all_w) AS all_w FROM line
  UNION ALL SELECT held, gone, lead(source_size * 3.0 / w) OVER (ORDER BY source_size / w, grp), total, all_w FROM line)
  WHERE gone < all_w AND next >= (total - held) / (all_w - gone) ORDER BY gone LIMIT 1),
tgt AS (SELECT src.grp, source_size, least(3.0 * source_size, (total - held)::DOUBLE * w / (all_w - gone))::DOUBLE AS target FROM src, level),
run AS (SELECT sized.*, source_size, target, sum(size) OVER (PARTITION BY grp ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM sized JOIN tgt USING (grp)),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS q FROM run)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(q * size + greatest(0, least(size, floor(target)::BIGINT - q * source_size - before)) AS BIGINT) AS taken FROM cut"""
