"""Mix sources to target weights along a time-varying curriculum. DataFrame operations only.

Every source has a weight schedule over training time 0 .. 1, piecewise linear with a mean of 1. Its integral times the
source's target is the cumulative demand; inverting it at a document's cumulative words gives the training position of
each pass over the document, and the mix is range-sorted by position. Documents of a source stand in the order of a hash of
their id. The running sums are taken in buckets of bounded size and linked by one row per bucket, so that a source of
any size is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from boxloom.llm.common import checkpointed, table
from boxloom.llm.registry import query
from boxloom.operators.scale import part_running_sum, range_parts

#: Weights of the sources in their order, repeating; words to take per word there is; passes over a document at most.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Schedules in the order of the sources, repeating: (time, multiple of the weight), from time 0 to 1, mean 1.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)))
BUCKET_DOCS = 5_000


def words(text: str = "text") -> Column:
    r"""Number of runs of anything but [\x20\x09-\x0D]; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """_source, _has, source_size, _index, target: the weighted shares of `share` times all words, none above `most` times its source.

    What a source cannot take is shared again by weight until none is above. With the sources ordered by most * size /
    weight, those up to some rank are full and the others get level * weight; the level is read off running sums.
    """
    totals = sized.groupBy("_has", "_source").agg(F.sum("size").alias("source_size"))
    order = [F.col("_has").desc(), F.col("_source").asc()]  # code point order, null last
    ranked = part_running_sum(range_parts(totals, [], order), [], order, {"_index": F.lit(1)}).withColumn("_index", F.col("_index") - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_index") % len(weights) + 1).cast("int")).cast("long")
    ranked = ranked.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * most)
    by_ratio = [(F.col("_cap") / F.col("_weight")).asc(), F.col("_index").asc()]
    sums = part_running_sum(range_parts(ranked, [], by_ratio), [], by_ratio, {"_caps": F.col("_cap"), "_weights": F.col("_weight")})
    sums = checkpointed(sums)
    whole = sums.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.coalesce(F.sum("_weight"), F.lit(0)).alias("weights")).first()
    budget = whole["words"] * share
    # full as long as the level that the sources from here on would get is above the own ratio
    level = (F.lit(budget) - (F.col("_caps") - F.col("_cap"))) / (F.lit(whole["weights"]) - (F.col("_weights") - F.col("_weight")))
    first = sums.filter(level * F.col("_weight") <= F.col("_cap")).select(level.alias("level"), "_caps", "_index").orderBy("_caps", "_index").limit(1).collect()
    target = F.least(F.lit(first[0]["level"]) * F.col("_weight"), F.col("_cap").cast("double")) if first else F.col("_cap").cast("double")
    return sums.select("_has", "_source", "source_size", "_index", target.alias("target"))


def position(done: Column, index: Column, schedules=SCHEDULES) -> Column:
    """The time at which a source's schedule has asked for the share `done` (0 to 1) of its target."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        area, found = 0.0, F.lit(1.0)
        pieces = []
        for (t0, a), (t1, b) in zip(knots, knots[1:]):
            slope, rest = (b - a) / (t1 - t0), F.greatest(done - area, F.lit(0.0))
            # a * x + slope / 2 * x^2 = rest, in the form that also holds for slope 0
            x = 2 * rest / (a + F.sqrt(F.greatest(F.lit(a * a) + 2 * slope * rest, F.lit(0.0))))
            area += (a + b) / 2 * (t1 - t0)
            pieces.append((area, F.lit(t0) + F.least(x, F.lit(t1 - t0))))
        for end, at in reversed(pieces):
            found = F.when(done <= end, at).otherwise(found)
        out = F.when(index % len(schedules) == k, found).otherwise(out)
    return F.least(out, F.lit(1.0))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, schedules=SCHEDULES) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, position, repeat_position, one row per document.

    `size` counts words; `taken` the words that the mix takes of the document, repeats counted: first pass, then second
    pass, each document in the order of the hash of its id, until the source's target (rounded down) is reached exactly;
    the last document of it is taken in part. `position` and `repeat_position` are the training times of the two passes,
    null where a pass takes nothing. At most two passes (`most` <= 2).

    Null texts have size 0 and are not taken; a null source is a source of its own, the last one; rows with equal ids
    stand next to each other, larger ones last, and each is counted. Other columns are not read; an empty table gives
    an empty one. Reruns give the same rows.
    """
    if most > 2:
        raise ValueError("at most two passes")
    sized = docs.select(
        "doc_id", F.col("source").isNotNull().alias("_has"), F.coalesce("source", F.lit("")).alias("_source"), words().alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_place"),
    )
    sized = checkpointed(sized)
    targets = source_targets(sized, weights, share, most)
    # equal shares of the hash range, as many as all documents ask for: known before anything is joined, so that rows
    # meet by source and bucket only, and a source of any size lies in many tasks
    buckets = max(1, -(-sized.count() // BUCKET_DOCS))
    # the first 32 bits of the hash, times the number of buckets
    bucket = F.floor(F.conv(F.substring("_place", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2**32))
    rows = sized.withColumn("_bucket", bucket)
    keys = ["_has", "_source", "_bucket"]
    before = W.partitionBy("_has", "_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = rows.groupBy(*keys).agg(F.sum("size").alias("_sum"))
    offsets = offsets.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    offsets = offsets.join(checkpointed(targets), ["_has", "_source"])
    inner = W.partitionBy(*keys).orderBy("_place", "size").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_end", F.sum("size").over(inner)).join(offsets, keys)
    start = F.col("_offset") + F.col("_end") - F.col("size")
    goal = F.floor("target")

    def part(begin: Column) -> Column:
        return F.greatest(F.least(goal - begin, F.col("size")), F.lit(0).cast("long"))

    again = start + F.col("source_size")
    source = F.when(F.col("_has"), F.col("_source")).alias("source")

    def at(begin: Column) -> Column:
        return F.when(part(begin) > 0, position(begin.cast("double") / goal, F.col("_index"), schedules))

    return rows.select(
        "doc_id", source, "size", "source_size", "target", (part(start) + part(again)).alias("taken"),
        at(start).alias("position"), at(again).alias("repeat_position"),
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per pass that takes words, with `pass` (1, 2), `words` and `position`, range-sorted by position."""
    passes = F.array(
        F.struct(F.lit(1).alias("pass"), F.least("taken", "size").alias("words"), F.col("position").alias("position")),
        F.struct(F.lit(2).alias("pass"), F.greatest(F.col("taken") - F.col("size"), F.lit(0).cast("long")).alias("words"), F.col("repeat_position").alias("position")),
    )
    kept = F.filter(passes, lambda p: p["words"] > 0)
    others = [c for c in mixed.columns if c not in ("position", "repeat_position", "pass", "words")]
    exploded = mixed.select(*others, F.explode(kept).alias("_p"))
    return exploded.select(*others, F.col("_p.pass").alias("pass"), F.col("_p.words").alias("words"), F.col("_p.position").alias("position")).orderBy("position", "doc_id", "pass")


@query(
    r"""
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS place,
    CAST(length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM sized GROUP BY source
), ranked AS (
  SELECT *, [3, 1, 2][CAST(i % 3 + 1 AS INT)] AS weight, source_size * 2 AS cap FROM sources
), sums AS (
  SELECT *, sum(cap) OVER (ORDER BY cap / weight, i) - cap AS caps_before, sum(weight) OVER (ORDER BY cap / weight, i) - weight AS weights_before,
    (SELECT sum(source_size) FROM ranked) * 1.5 AS budget, (SELECT sum(weight) FROM ranked) AS weights FROM ranked
), levels AS (
  SELECT *, (CAST(budget AS DOUBLE) - CAST(caps_before AS DOUBLE)) / CAST(weights - weights_before AS DOUBLE) AS level FROM sums
), one AS (
  SELECT level AS chosen FROM levels WHERE level * weight <= cap ORDER BY caps_before + cap, i LIMIT 1
), targets AS (
  SELECT source, source_size, i, least(coalesce(chosen, 1e300) * weight, CAST(cap AS DOUBLE)) AS target FROM levels LEFT JOIN one ON true
), placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.i, CAST(floor(t.target) AS BIGINT) AS goal,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.size ROWS UNBOUNDED PRECEDING) - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, greatest(least(goal - start, size), 0) AS one, greatest(least(goal - start - source_size, size), 0) AS two FROM placed
), passes AS (
  SELECT *, CASE WHEN one > 0 THEN start / goal END AS d1, CASE WHEN two > 0 THEN (start + source_size) / goal END AS d2 FROM taken
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(one + two AS BIGINT) AS taken, place_1 AS position, place_2 AS repeat_position
FROM (SELECT *,
  CASE i % 3 WHEN 0 THEN 2 * d1 / (1.5 + sqrt(greatest(2.25 - 2 * d1, 0)))
             WHEN 1 THEN 2 * d1 / (0.5 + sqrt(0.25 + 2 * d1))
             ELSE CASE WHEN d1 <= 0.5 THEN 2 * d1 / (0.5 + sqrt(0.25 + 4 * d1)) ELSE 0.5 + 2 * (d1 - 0.5) / (1.5 + sqrt(greatest(2.25 - 4 * (d1 - 0.5), 0))) END END AS place_1,
  CASE i % 3 WHEN 0 THEN 2 * d2 / (1.5 + sqrt(greatest(2.25 - 2 * d2, 0)))
             WHEN 1 THEN 2 * d2 / (0.5 + sqrt(0.25 + 2 * d2))
             ELSE CASE WHEN d2 <= 0.5 THEN 2 * d2 / (0.5 + sqrt(0.25 + 4 * d2)) ELSE 0.5 + 2 * (d2 - 0.5) / (1.5 + sqrt(greatest(2.25 - 4 * (d2 - 0.5), 0))) END END AS place_2
  FROM passes)
"""
)
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document and when, range-sorted by the training position."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.drop("source").orderBy(F.coalesce("position", F.lit(2.0)), "doc_id")
