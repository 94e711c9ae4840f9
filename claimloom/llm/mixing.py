"""Mixing sources to target weights by Sainte-Laguë apportionment, DataFrame operations only.

The mix is counted in blocks of equal word numbers, the same at every size of the tables; a block of one word
brings each source within a few words of its target, however small it is beside the others. Sources get
whole blocks by the highest quotients ``weight / (2 k + 1)``, and each source's blocks are dealt over its shards
the same way. The documents of a shard lie end to end in a seeded order, and the shard's quota is filled with
whole passes over that line and one seeded run of blocks.

Apportioning needs no list of all blocks: with N seats and m cells the last seat's quotient lies between
N/(2N+m) and N/(2N-m) of the mean, which fixes all seats but about 2m; only those are ranked.

Null texts have size 0, null sources are one source, the last. Sources without words get nothing. A
document with no words takes none. Rows that agree in all columns of the result are interchangeable.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import hex_number, n_words, row_key, running_start
from claimloom.session import stored


def apportion(cells: DataFrame, group: Sequence[str], key: Sequence[str], weight: str, seats: str, name: str) -> DataFrame:
    """Whole seats for the cells of each group, by highest quotients; ties go to the smaller key."""
    own = Window.partitionBy(*group)
    cells = cells.select(
        "*",
        F.sum(weight).over(own).alias("_all"),
        F.sum(F.when(F.col(weight) > 0, 1).otherwise(0)).over(own).alias("_cells"),
    )
    some = cells.where((F.col(weight) > 0) & (F.col(seats) > 0))
    mean = F.col(weight) / F.col("_all")
    # one seat of slack on either side for rounding of the quotients
    sure = F.floor((mean * F.greatest(F.lit(0), 2 * F.col(seats) - F.col("_cells")) + 1) / 2) - 1
    most = F.floor((mean * (2 * F.col(seats) + F.col("_cells")) + 1) / 2) + 1
    some = some.withColumn("_sure", F.greatest(F.lit(0), sure)).withColumn("_most", most)
    some = some.withColumn("_left", F.col(seats) - F.sum("_sure").over(own))
    asked = some.select("*", F.explode(F.sequence("_sure", "_most")).alias("_seat"))
    best = Window.partitionBy(*group).orderBy(F.desc(F.col(weight) / (2 * F.col("_seat") + 1)), *key, "_seat")
    won = asked.withColumn("_rank", F.row_number().over(best)).groupBy(*group, *key).agg(
        (F.first("_sure") + F.sum(F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0))).alias(name)
    )
    joined = cells.drop("_all", "_cells").join(won, [*group, *key], "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long"))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Target words of each source: shares by weight, cut at ``most`` times its size, the rest reshared.

    With the sources in the order of cap by weight, the level at which all uncut sources meet is the
    largest one that stays below its own source's cap. One row per source, so this is a small table.
    """
    by_name = Window.partitionBy("all").orderBy("src")
    everything = Window.partitionBy("all")
    by_ratio = Window.partitionBy("all").orderBy("ratio", "src").rowsBetween(Window.unboundedPreceding, -1)
    listed = F.array(*[F.lit(int(w)) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights)
    table = sizes.withColumn("all", F.lit(1)).select("*", F.element_at(listed, place + 1).alias("weight"))
    table = table.select("*", (F.col("source_size") * most).alias("cap"), (F.sum("source_size").over(everything) * share).alias("wanted"))
    table = table.withColumn("ratio", F.col("cap") / F.col("weight"))
    table = table.select(
        "*",
        F.coalesce(F.sum("cap").over(by_ratio), F.lit(0)).alias("cut"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))).alias("uncut"),
    )
    table = table.withColumn("level", (F.col("wanted") - F.col("cut")) / F.col("uncut"))
    table = table.withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return table.select("all", "src", "source_size", "wanted", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
    block: int = 1,
    keyed: bool = False,
) -> DataFrame:
    """Words that the mix takes from each document; ``keyed`` adds the ``row_key`` of id and text.

    ``block``: words of a block. A source's taken words differ from its target by less than a block for each of
    its 16 shards.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("src"),
        n_words(F.col("text")).alias("size"),
        digest.alias("digest"),
        *([row_key(F.col("doc_id"), F.col("text")).alias("key")] if keyed else []),
    ).select(
        "*",
        F.substring("digest", 1, 1).alias("shard"),
        F.substring("digest", 2, 3).alias("part"),
    )
    rows = stored(rows, "mix-rows")
    cells = rows.groupBy("src", "shard").agg(F.sum("size").alias("line"))
    sources = source_targets(cells.groupBy("src").agg(F.sum("line").alias("source_size")), weights, share, most)
    sources = sources.withColumn("block", F.lit(block).cast("long")).withColumn("seats", F.floor(F.col("wanted") / block + 0.5))
    sources = apportion(sources, ["all"], ["src"], "target", "seats", "quota").select("src", "source_size", "target", "block", "quota")
    cells = apportion(cells.join(sources, "src"), ["src"], ["shard"], "line", "quota", "taken")
    length = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("line") / F.col("block")))
    # quotients can give a cell a seat more than its share, no document is taken more than ``most`` times
    cells = cells.withColumn("length", length).withColumn("taken", F.least(F.col("taken"), F.col("length") * most))
    first = hex_number(F.md5(F.concat(F.lit(f"{seed}:"), "src", F.lit(":"), "shard").cast("binary")), 1, 8)
    cells = cells.select(
        "src", "shard", "source_size", "target", "line", "block", "length",
        F.floor(F.col("taken") / F.col("length")).alias("passes"),
        (F.col("taken") % F.col("length")).alias("run"),
        (first % F.col("length")).alias("first"),
    )
    laid = running_start(rows, ["src", "shard"], "part", ["digest", "size"], "size", "start")
    end = F.col("start") + F.col("size")

    def inside(low, high):
        return F.greatest(F.lit(0).cast("long"), F.least(end, high) - F.greatest(F.col("start"), low))

    last = F.col("first") + F.col("run")
    ahead = inside(F.col("first") * F.col("block"), F.least(last * F.col("block"), F.col("line")))
    around = inside(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), last - F.col("length")) * F.col("block"))
    taken = F.col("passes") * F.col("size") + ahead + around
    return laid.join(cells, ["src", "shard"]).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *(["key"] if keyed else [])
    )


#: The same mix in SQL, with the default parameters. The seats of a cell lie within half the number of cells of its
#: share, so only those are ranked.
MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, coalesce('0' || source, '1') AS src,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), sized AS (SELECT src, sum(size)::BIGINT AS source_size FROM rows GROUP BY src),
capped AS (
  SELECT *, ([3, 1, 2])[((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT] AS weight, source_size * 2 AS cap,
    sum(source_size) OVER ()::DOUBLE * 1.5 AS wanted
  FROM sized
), levels AS (
  SELECT *, (wanted - coalesce(sum(cap) OVER before, 0)::DOUBLE)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM capped
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT src, source_size, floor(wanted + 0.5)::BIGINT AS seats,
    least(cap::DOUBLE, max(CASE WHEN level <= cap::DOUBLE / weight THEN level END) OVER () * weight) AS target
  FROM levels
), source_shares AS (
  SELECT *, count(*) OVER () AS m, floor(target / sum(target) OVER () * seats)::BIGINT AS share FROM targets WHERE target > 0
), source_seats AS (SELECT *, greatest(0, share - m - 2) AS sure FROM source_shares),
source_rank AS (
  SELECT src, seats - sum_sure AS remaining, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, src, k) AS place
  FROM (SELECT *, unnest(range(sure, sure + 2 * m + 6)) AS k FROM (SELECT *, sum(sure) OVER () AS sum_sure FROM source_seats))
), quotas AS (
  SELECT t.*, coalesce(s.sure + w.won, 0) AS quota FROM targets t LEFT JOIN source_seats s USING (src)
  LEFT JOIN (SELECT src, count(*) FILTER (place <= remaining) AS won FROM source_rank GROUP BY src) w USING (src)
), cells AS (
  SELECT src, substr(digest, 1, 1) AS shard, sum(size)::BIGINT AS line FROM rows GROUP BY ALL
), cell_shares AS (
  SELECT c.*, quota, count(*) OVER (PARTITION BY src) AS m, floor(line::DOUBLE / source_size * quota)::BIGINT AS share
  FROM cells c JOIN quotas USING (src) WHERE line > 0 AND quota > 0
), cell_seats AS (SELECT *, greatest(0, share - m - 2) AS sure FROM cell_shares),
cell_rank AS (
  SELECT src, shard, quota - sum_sure AS remaining,
    row_number() OVER (PARTITION BY src ORDER BY line::DOUBLE / (2 * k + 1) DESC, shard, k) AS place
  FROM (SELECT *, unnest(range(sure, sure + 2 * m + 6)) AS k FROM (SELECT *, sum(sure) OVER (PARTITION BY src) AS sum_sure FROM cell_seats))
), filled AS (
  SELECT c.*, t.source_size, t.target, greatest(1, c.line) AS length, least(coalesce(s.sure + w.won, 0), 2 * greatest(1, c.line)) AS quota,
    ('0x' || substr(md5('mix:' || src || ':' || shard), 1, 8))::BIGINT AS seeded
  FROM cells c JOIN quotas t USING (src) LEFT JOIN cell_seats s USING (src, shard)
  LEFT JOIN (SELECT src, shard, count(*) FILTER (place <= remaining) AS won FROM cell_rank GROUP BY ALL) w USING (src, shard)
), laid AS (
  SELECT *, substr(digest, 1, 1) AS shard, coalesce(sum(size) OVER (PARTITION BY src, substr(digest, 1, 1)
    ORDER BY digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM rows
)
SELECT doc_id, size, source_size, target,
  (quota // length * size
   + greatest(0, least(start + size, least(seeded % length + quota % length, line)) - greatest(start, seeded % length))
   + greatest(0, least(start + size, greatest(0, seeded % length + quota % length - length)) - start))::BIGINT AS taken
FROM laid JOIN filled USING (src, shard)
"""
