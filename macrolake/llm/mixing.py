"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents, in a hashed order, form one stream of words that is
cut into blocks of equal size but for rounding: as few as have at most ``BLOCK``
words, but ``BLOCKS`` at least, or a block for each word where there are fewer. A source needs as many slots as blocks of its size make its target, to
the nearest whole number. Slot ``n`` of the mix has the
point ``frac(n * golden ratio)``, taken in whole numbers modulo 2^31, and goes
to the source whose stretch of the cumulative needs holds the point. The
slots of a source are ranked; rank ``r`` takes block ``r`` modulo the number of
its blocks, so all blocks are read once before any is read again. Points come
near the needs, not always up to them: ranks beyond a source's need are not
filled, and ranks that it still needs follow at the end. One rule holds for
sources of any size: one of 20 words gives its 20 blocks three times.

Ranks and word offsets are running sums over a whole source. A source may hold
a third of all rows, so both are made in two steps: sums of small segments,
then running sums within a segment. Only one row per source and, for offsets
of segments, one per segment meet in a task.

Rows: a null text has size 0, is in the result and takes nothing. Repeated
rows are rows of their own. A null source is a source, the last one. An empty
table gives no rows; if no text has a word, all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrolake.llm.common import stored

#: Words of a block at most, and blocks of a source at least, if it has as many words. More blocks follow the targets
#: more closely and make more rows.
BLOCK, BLOCKS = 64, 64
#: Passes over a source at most.
PASSES = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: The points: n * STEP modulo 2^31, STEP is 2^31 over the golden ratio, made odd.
MODULUS, STEP = 1 << 31, 1327217885
#: Cells of the lookup from points to sources.
CELLS = 4096
#: Fixed: a multiplier of good spectral quality, for the hashed order of documents.
SHUFFLE = 1597334677
#: Slots of a segment, and segments of the hashed order of a source.
SLOTS, SEGMENTS = 1 << 14, 4096


def words_in(text: str) -> Column:
    """Number of words, separated by ASCII white space."""
    return F.expr(f"CAST(regexp_count(coalesce({text}, ''), '[^\\\\x20\\\\x09-\\\\x0D]+') AS LONG)")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(row, doc_id, source, size, place): ``place`` is the hashed position of the document, ``row`` a key of the stored rows."""
    place = F.expr(f"pmod(coalesce({doc_id}, 0L) % {MODULUS} * {SHUFFLE}L + 12345L, {MODULUS}L)")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), words_in(text).alias("size"), place.alias("place"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, block: int = BLOCK) -> DataFrame:
    """(source, source_size, target, number, blocks, need) for sizes (source, source_size), one row each.

    A source at its limit gets ``passes`` times its size, the others share the
    rest by weight. In the order of limit over weight the limited sources come
    first, so one running sum finds them. One row per source meets in a task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    spots = ", ".join(map(str, weights))
    named = sizes.withColumn("number", F.row_number().over(by_name).cast("long")).withColumn(
        "weight", F.expr(f"element_at(array({spots}), CAST((number - 1) % {len(weights)} + 1 AS INT))")
    )
    filling = Window.orderBy(F.expr("source_size / weight"), "number")
    everything = Window.partitionBy(F.lit(0))
    limited = (
        named.withColumn("spent", F.coalesce(F.sum("source_size").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("limited", F.expr(f"{passes} * source_size * open_weight <= (total - {passes} * spent) * weight"))
    )
    rest = (
        limited.withColumn("limited_size", F.sum(F.expr("CASE WHEN limited THEN source_size ELSE 0 END")).over(everything))
        .withColumn("free_weight", F.sum(F.expr("CASE WHEN limited THEN 0 ELSE weight END")).over(everything))
    )
    dealt = rest.select(
        "source",
        "source_size",
        F.expr(f"CASE WHEN limited THEN CAST({passes} * source_size AS DOUBLE) ELSE CAST(weight * (total - {passes} * limited_size) AS DOUBLE) / free_weight END").alias("target"),
        "number",
    )
    blocks = dealt.withColumn("blocks", F.expr(f"least(source_size, greatest({BLOCKS}L, CAST(ceil(source_size / {block}) AS LONG)))"))
    return blocks.withColumn("need", F.expr("CASE WHEN source_size > 0 THEN CAST(floor(target * blocks / source_size + 0.5D) AS LONG) ELSE 0L END"))


def schedule(sources: DataFrame, n_slots: int) -> DataFrame:
    """(slot, number, rank): the source of each slot and the slot's rank among those of its source, from 0.

    As many slots as the sources (number, need) need together; each gets its need.
    """
    spark = sources.sparkSession
    running = Window.orderBy("number")
    bounds = (
        sources.withColumn("upto", F.sum("need").over(running))
        .withColumn("all", F.sum("need").over(Window.partitionBy(F.lit(0))))
        .withColumn("hi", F.expr(f"CAST(floor(CAST(upto AS DOUBLE) / all * {MODULUS}) AS LONG)"))
        .withColumn("hi", F.when(F.expr("number = max(number) OVER (PARTITION BY 0)"), F.lit(MODULUS)).otherwise(F.col("hi")))
        .withColumn("lo", F.coalesce(F.lag("hi").over(running), F.lit(0)))
        .filter("lo < hi")
    )
    width = MODULUS // CELLS
    guide = bounds.select("number", "lo", "hi", F.explode(F.expr(f"sequence(lo div {width}, (hi - 1) div {width})")).alias("cell"))
    points = spark.range(n_slots).select(F.col("id").alias("slot"), F.expr(f"id % {MODULUS}L * {STEP}L % {MODULUS}L").alias("point"))
    given = (
        points.withColumn("cell", F.expr(f"point div {width}"))
        .join(guide, "cell")
        .filter("lo <= point AND point < hi")
        .select("slot", "number", F.expr(f"slot div {SLOTS}").alias("segment"))
    )
    before = (
        given.groupBy("number", "segment")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.expr("sum(n) OVER (PARTITION BY number ORDER BY segment) - n"))
        .select("number", "segment", "before", "n")
    )
    ranked = given.join(before, ["number", "segment"]).select(
        "slot", "number", F.expr("before + row_number() OVER (PARTITION BY number, segment ORDER BY slot) - 1").alias("rank")
    )
    filled = ranked.join(sources.select("number", "need"), "number").filter("rank < need").select("slot", "number", "rank")
    got = before.join(sources.select("number", "need"), "number", "right").groupBy("number", "need").agg(F.coalesce(F.max(F.expr("before + n")), F.lit(0)).alias("got"))
    late = got.filter("got < need").select("number", F.explode(F.expr("sequence(got, need - 1)")).alias("rank"))
    return filled.union(late.select(F.lit(n_slots).cast("long").alias("slot"), "number", "rank"))


def offsets(rows: DataFrame) -> DataFrame:
    """The rows with the number of words before each in the stream of its source."""
    cut = rows.withColumn("segment", F.expr(f"place div {MODULUS // SEGMENTS}"))
    before = (
        cut.groupBy("number", "segment")
        .agg(F.sum("size").alias("n"))
        .withColumn("before", F.expr("sum(n) OVER (PARTITION BY number ORDER BY segment) - n"))
        .select("number", "segment", "before")
    )
    return cut.join(before, ["number", "segment"]).withColumn(
        "start", F.expr("before + sum(size) OVER (PARTITION BY number, segment ORDER BY place, doc_id, size, row) - size")
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row for each row of ``docs``."""
    rows = measured(docs, doc_id, text, source)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stored(targets(sizes, weights, passes, block))
    needed = sources.filter("need > 0")
    total = needed.agg(F.sum("need")).first()[0] or 0
    named = rows.join(sources.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    visits = (
        schedule(needed.select("number", "need"), total)
        .join(needed.select("number", "blocks"), "number")
        .groupBy("number", F.expr("rank % blocks").alias("block"))
        .agg(F.count("*").alias("visits"))
    )
    placed = offsets(named.filter("size > 0").select("row", "doc_id", "number", "size", "source_size", "blocks", "place"))
    # Block b of a source holds the words from floor(b * source_size / blocks) on.
    pieces = (
        placed.select(
            "row", "number", "start", F.expr("start + size AS stop"), "source_size", "blocks",
            F.explode(F.expr("sequence((start * blocks + blocks - 1) div source_size, ((start + size) * blocks - 1) div source_size)")).alias("block"),
        )
        .withColumn("words", F.expr("least(stop, (block + 1) * source_size div blocks) - greatest(start, block * source_size div blocks)"))
    )
    taken = (
        pieces.select("row", "number", "block", "words")
        .join(visits, ["number", "block"])
        .groupBy("row")
        .agg(F.sum(F.expr("words * visits")).alias("taken"))
    )
    return named.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def oracle_sql(block: int = BLOCK) -> str:
    """The same mix in one statement: a block of a source is visited as often as its ranks below the need fall on it."""
    return f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         (doc_id % {MODULUS} * {SHUFFLE} + 12345) % {MODULUS} AS place FROM documents),
s0 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM d GROUP BY source),
s1 AS (SELECT *, 1 + (number - 1) % 3 AS weight FROM s0),
s2 AS (
  SELECT *, coalesce(sum(source_size) OVER (ORDER BY source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(weight) OVER (ORDER BY source_size / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         sum(source_size) OVER () AS total FROM s1),
s3 AS (SELECT *, 3 * source_size * open_weight <= (total - 3 * spent) * weight AS limited FROM s2),
s4 AS (
  SELECT *, sum(CASE WHEN limited THEN source_size ELSE 0 END) OVER () AS limited_size,
         sum(CASE WHEN limited THEN 0 ELSE weight END) OVER () AS free_weight FROM s3),
s AS (
  SELECT source, source_size, number, least(source_size, greatest({BLOCKS}, CAST(ceil(source_size / {block}) AS BIGINT))) AS blocks, total,
         CASE WHEN limited THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(weight * (total - 3 * limited_size) AS DOUBLE) / free_weight END AS target FROM s4),
needs AS (SELECT number, blocks, CAST(floor(target * blocks / source_size + 0.5) AS BIGINT) AS need FROM s WHERE source_size > 0),
visits AS (
  SELECT number, block, need // blocks + CASE WHEN block < need % blocks THEN 1 ELSE 0 END AS visits
  FROM (SELECT *, unnest(range(blocks)) AS block FROM needs)),
placed AS (
  SELECT doc_id, s.number, size, source_size, blocks, CAST(sum(size) OVER (PARTITION BY s.number ORDER BY place, doc_id, size) - size AS BIGINT) AS start
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source WHERE size > 0),
edges AS (
  SELECT number, block, visits, block * source_size // s.blocks AS lo, (block + 1) * source_size // s.blocks AS hi FROM visits JOIN s USING (number)),
pieces AS (
  SELECT doc_id, number, start, start + size AS stop,
         unnest(range((start * blocks + blocks - 1) // source_size, ((start + size) * blocks - 1) // source_size + 1)) AS block FROM placed),
taken AS (
  SELECT doc_id, sum((least(stop, hi) - greatest(start, lo)) * visits) AS taken
  FROM pieces JOIN edges USING (number, block) GROUP BY doc_id)
SELECT d.doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN taken ON d.doc_id = taken.doc_id"""
