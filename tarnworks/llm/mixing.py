"""Mixing sources to target weights by a low-discrepancy schedule.

Each source is a stream of its documents in hashed order, cut into blocks of equally many
words. The mix is a sequence of slots, each of which reads a block. Slot j takes the golden-ratio
point frac((j + 1/2) * phi) and goes to the source whose part of the cumulative
targets (counted in blocks) holds the point, so any stretch of the schedule is close to the targets.
Slots are ranked within their source and joined to its blocks by rank, starting over after the last block. A
document is taken as often as the slots that are joined to its blocks read its words.

Blocks have one word as long as a source's target has at most ``SLOTS``; beyond that they grow with it.
What a source lacks then, by a few blocks, is scheduled by further points of the same sequence, and
the slot that reaches its target ends there, so targets are met at every size.

Defined results: null text has no words; a null source is a source of its own and
sorts last. Only doc_id, source and text are read. Rows of one doc_id and source
follow one another in the stream. An empty table, or one without words, gives
targets and takes of 0. Reruns agree: order comes from hashes of doc_id alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.llm.text import DOCUMENT, SPACES, document_columns, documents, word_count
from tarnworks.session import staged

QUERY = "op6_source_mixing"

#: Fixed value: the fractional part of the golden ratio.
PHI = 0.6180339887498949

#: Slots of a source at most, about; its blocks have its target over this, rounded up.
SLOTS = 1 << 17

#: Parts of the unit interval by which slots find their source with an equality join.
CELLS = 4096

#: Parts of a source by hash, so that no task orders a whole source.
RUNS = 1024


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """sizes: source, source_size. Adds ``target``: the share of all words by weight, at most ``epochs`` times the size.

    Sources in code-point order (null last) get the weights in turn. What a source
    cannot take is shared by weight among the others until none is above its limit:
    each target is min(limit, level * weight) for one level, which rises from round
    to round. A round brings two numbers to the driver; the order needs one row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    table = staged(sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(epochs)), "mix-sources")
    total, weight_all = table.agg(F.sum("source_size"), F.sum("weight")).first()
    total = float(total or 0)
    level = total / weight_all if weight_all else 0.0
    while total:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        held, open_weight = table.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not open_weight or (total - held) / open_weight <= level:
            break
        level = (total - held) / open_weight
    return table.withColumn("target", F.least("cap", F.lit(level) * F.col("weight")))


def _ordered(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, run and order: the place of a document in its source's stream."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), order.alias("order")).withColumn(
        "run", F.conv(F.substring("order", 1, 4), 16, 10).cast("int") % F.lit(RUNS)
    )


def _same_source(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def streams(docs: DataFrame) -> DataFrame:
    """docs with size, start (words before it in its source's stream): prefix sums over runs, then within each."""
    rows = staged(_ordered(docs), "mix-rows")
    runs = rows.groupBy("source", "run").agg(F.sum("size").alias("run_size"))
    before = F.sum("run_size").over(Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col("source").alias("r_source"), F.col("run").alias("r_run"), F.coalesce(before, F.lit(0)).alias("run_start"))
    inside = F.sum("size").over(Window.partitionBy("source", "run").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("inside", F.coalesce(inside, F.lit(0)))
    joined = placed.join(runs, _same_source(F.col("source"), F.col("r_source")) & (F.col("run") == F.col("r_run")))
    return staged(joined.select("doc_id", "source", "size", (F.col("run_start") + F.col("inside")).alias("start")), "mix-streams")


def schedule(targets: DataFrame, slot_words: int | Column, slots: int, first: int = 0) -> DataFrame:
    """slot, source, rank (of the slot in its source), block and pass it reads, from slot ``first`` on.

    targets: source, source_size, cap, target, in words; a source's blocks have ``slot_words``. Slots beyond what a source's limit allows are left out.
    """
    spark = targets.sparkSession
    long = slot_words if isinstance(slot_words, Column) else F.lit(slot_words)
    targets = targets.withColumns({"share": F.col("target") / long, "blocks": F.ceil(F.col("source_size") / long).cast("bigint")})
    below = F.coalesce(F.sum("share").over(Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = F.sum("share").over(Window.partitionBy(F.lit(0)))
    parts = targets.where("share > 0").withColumns({"low": below, "all": total})
    parts = parts.withColumns({"high": (F.col("low") + F.col("share")) / F.col("all"), "low": F.col("low") / F.col("all")})
    cells = F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))).alias("cell")
    parts = parts.select("source", "cap", "source_size", "blocks", "low", "high", cells)
    point = (F.col("id") + F.lit(0.5)) * F.lit(PHI)
    points = spark.range(first, first + slots).withColumn("point", point - F.floor(point)).withColumn("p_cell", F.floor(F.col("point") * CELLS))
    hit = points.join(parts, (F.col("p_cell") == F.col("cell")) & (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    # Ranks within a source: slots are counted by stretches first, so that no task ranks a whole source's.
    stretch = F.shiftright(F.col("id"), 12)
    hit = staged(hit.select(F.col("id").alias("slot"), "source", "cap", "source_size", "blocks", stretch.alias("stretch")), "mix-slots")
    counts = hit.groupBy("source", "stretch").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("source").alias("c_source"), F.col("stretch").alias("c_stretch"), F.coalesce(earlier, F.lit(0)).alias("earlier"))
    inside = hit.withColumn("inside", F.row_number().over(Window.partitionBy("source", "stretch").orderBy("slot")) - 1)
    ranked = inside.join(counts, _same_source(F.col("source"), F.col("c_source")) & (F.col("stretch") == F.col("c_stretch")))
    rank = (F.col("earlier") + F.col("inside")).alias("rank")
    ranked = ranked.select("slot", "source", rank, "blocks", (F.col("cap") / F.col("source_size")).alias("passes"))
    ranked = ranked.withColumns({"block": F.col("rank") % F.col("blocks"), "pass": F.floor(F.col("rank") / F.col("blocks"))})
    return ranked.where(F.col("pass") < F.col("passes")).select("slot", "source", "rank", "block", "pass")


def _planned(targets: DataFrame) -> DataFrame:
    """p_source, slot, block, pass, begin, words: what each slot reads of its source's stream; targets has long, blocks and need.

    need: the slots that a source of several words a block must have; null where blocks are single words.
    """
    slots = targets.agg(F.round(F.sum(F.col("target") / F.col("long"))).cast("bigint")).first()[0] or 0
    plan = staged(schedule(targets, F.col("long"), slots).select("slot", "source", "rank"), "mix-plan")
    parts, before = [plan], None
    while True:
        counts = reduce(DataFrame.unionByName, parts).groupBy(F.col("source").alias("n_source")).agg((F.max("rank") + 1).alias("n"))
        held = targets.join(counts, _same_source(F.col("source"), F.col("n_source")), "left").drop("n_source")
        short = held.withColumn("from", F.coalesce("n", F.lit(0))).withColumn("more", F.col("need") - F.col("from")).where("more > 0").drop("n")
        short = staged(short, "mix-short")
        more = short.agg(F.sum("more")).first()[0]
        if not more or more == before:
            break
        before = more
        # the sequence goes on, over the slots that are missing; their ranks follow those before
        own = short.select("source", F.lit(float("inf")).alias("cap"), "source_size", F.col("more").cast("double").alias("target"))
        start = short.select(F.col("source").alias("f_source"), "from")
        found = schedule(own, 1, more, slots).join(start, _same_source(F.col("source"), F.col("f_source")))
        found = staged(found.select("slot", "source", (F.col("rank") + F.col("from")).alias("rank")), "mix-plan")
        slots += more
        parts.append(found)
    whole = reduce(DataFrame.unionByName, parts)
    about = targets.select(F.col("source").alias("p_source"), "long", "blocks", "need", "source_size", "cap", F.round("target").cast("bigint").alias("goal"))
    whole = whole.join(about, _same_source(F.col("source"), F.col("p_source")))
    whole = whole.withColumns({"block": F.col("rank") % F.col("blocks"), "pass": F.floor(F.col("rank") / F.col("blocks")).cast("bigint")}).where(F.col("pass") * F.col("source_size") < F.col("cap"))
    whole = whole.withColumn("begin", F.col("block") * F.col("long"))
    # the last block of a stream has the words that are left, and a slot of a longer block ends where the target is met
    words = F.least(F.col("long"), F.col("source_size") - F.col("begin"))
    words = F.when(F.col("need").isNull(), words).otherwise(F.least(words, F.col("goal") - F.col("pass") * F.col("source_size") - F.col("begin")))
    return whole.withColumn("words", words).where("words > 0").select("p_source", "slot", "block", "pass", "begin", "words")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """A row for each row of ``docs``: doc_id, source, size, source_size, target, start, taken, slots.

    ``taken`` words of the document are in the mix: those that the slots of its source's blocks read. ``slots`` has, for each pass over
    the source, the slot that reads the document first, or null.
    """
    rows = streams(docs)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, epochs)
    targets = targets.withColumn("long", F.greatest(F.ceil(F.col("target") / SLOTS), F.lit(1)).cast("bigint"))
    goal, size = F.round("target").cast("bigint"), F.greatest("source_size", F.lit(1))
    blocks = F.ceil(F.col("source_size") / F.col("long")).cast("bigint")
    need = F.when(F.col("long") > 1, F.floor(goal / size) * blocks + F.ceil((goal % size) / F.col("long")))
    targets = staged(targets.withColumns({"blocks": blocks, "need": need.cast("bigint")}), "mix-targets")
    plan = staged(_planned(targets), "mix-reads")

    # The blocks that a document lies in, if any slot reads so far; then their slots.
    reached = plan.groupBy(F.col("p_source").alias("r_source")).agg(F.max("block").alias("r_block"))
    about = targets.select(F.col("source").alias("s_source"), F.col("source_size").cast("bigint").alias("source_size"), F.round("target", 6).alias("target"), "long")
    about = about.join(reached, _same_source(F.col("s_source"), F.col("r_source")), "left").select("s_source", "source_size", "target", "long", F.coalesce("r_block", F.lit(-1)).alias("reached"))
    # Written, so that one row a source is joined by its real size and rows are not dealt by source.
    about = staged(about, "mix-about")
    known = rows.join(about, _same_source(F.col("source"), F.col("s_source"))).drop("s_source")
    first = F.floor(F.col("start") / F.col("long"))
    last = F.least(F.floor((F.col("start") + F.col("size") - 1) / F.col("long")), F.col("reached"))
    pieces = known.where((F.col("size") > 0) & (first <= last)).select("source", "start", "size", F.explode(F.sequence(first, last)).alias("in_block"))
    read = pieces.join(plan, _same_source(F.col("source"), F.col("p_source")) & (F.col("in_block") == F.col("block")))
    overlap = F.least(F.col("start") + F.col("size"), F.col("begin") + F.col("words")) - F.greatest("start", "begin")
    read = read.withColumn("overlap", overlap).where("overlap > 0")
    slots = F.array(*[F.min(F.when(F.col("pass") == p, F.col("slot"))) for p in range(epochs)])
    sums = read.groupBy(F.col("source").alias("t_source"), F.col("start").alias("t_start")).agg(F.sum("overlap").alias("taken"), slots.alias("slots"))
    out = known.join(sums, _same_source(F.col("source"), F.col("t_source")) & (F.col("start") == F.col("t_start")) & (F.col("size") > 0), "left")
    return out.select("doc_id", "source", "size", "source_size", "target", "start", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "slots")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, order: bool = False) -> DataFrame:
    """The documents of the mix, with the columns of documents; with ``order`` also slot: that which reads the copy first, by which the mix is sorted.

    A document comes once for each whole pass; what remains of ``taken`` comes as
    a text of its first words. A source is read in order, so at most the document
    where it stops is cut. Where a doc_id stands on several rows, each goes by its own source and size;
    rows that share all three are dealt their takes in any order.
    """
    docs = document_columns(docs)
    takes = staged(mix(docs, weights, epochs), "mix-takes")
    same = F.col("doc_id").eqNullSafe(F.col("m_id"))
    if not takes.groupBy("doc_id").count().where("count > 1").isEmpty():
        takes = takes.withColumn("m_k", F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("start")))
        docs = docs.withColumn("_size", word_count(F.col("text")))
        docs = docs.withColumn("_k", F.row_number().over(Window.partitionBy("doc_id", "source", "_size").orderBy(F.xxhash64("text"))))
        same = same & F.col("source").eqNullSafe(F.col("m_source")) & (F.col("_size") == F.col("m_size")) & (F.col("_k") == F.col("m_k"))
    takes = takes.where("taken > 0").withColumnsRenamed({"doc_id": "m_id", "source": "m_source", "size": "m_size", "taken": "m_taken", "slots": "m_slots"})
    joined = docs.join(takes.drop("source_size", "target", "start"), same)
    whole, rest = F.floor(F.col("m_taken") / F.col("m_size")), F.col("m_taken") % F.col("m_size")
    words = F.when(rest > 0, rest).otherwise(0)
    parts = F.concat(F.array_repeat(F.lit(-1).cast("bigint"), whole.cast("int")), F.filter(F.array(words.cast("bigint")), lambda w: w > 0))
    rows = joined.select("*", F.posexplode(parts).alias("_pass", "_words"))
    first = F.concat_ws(" ", F.slice(F.split(F.trim(F.translate("text", SPACES, " " * len(SPACES))), " +"), F.lit(1), F.col("_words").cast("int")))
    text = F.when(F.col("_words") < 0, F.col("text")).otherwise(first)
    rows = rows.withColumn("text", text).withColumn("n_chars", F.when(F.col("_words") < 0, F.col("n_chars")).otherwise(F.length("text")))
    return rows.select(*DOCUMENT, *([F.element_at("m_slots", F.col("_pass") + 1).alias("slot")] if order else []))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS o
  FROM documents),
w AS (
  SELECT *, 3.0 * source_size AS cap, CASE (k - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source)),
v(i, level) AS (
  SELECT 0, (SELECT sum(source_size) / sum(weight) FROM w)
  UNION ALL
  SELECT i + 1, (SELECT (sum(source_size) - coalesce(sum(cap) FILTER (cap < v.level * weight), 0)) / nullif(sum(weight) FILTER (cap >= v.level * weight), 0) FROM w)
  FROM v WHERE i < 40 AND level IS NOT NULL),
t AS (SELECT source, source_size, cap, least(cap, (SELECT max(level) FROM v) * weight) AS target FROM w),
g AS (SELECT *, CAST(greatest(1, ceil(target / {SLOTS})) AS BIGINT) AS words FROM t),
b AS (
  SELECT source, source_size, words, coalesce(sum(target / words) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low, target / words AS share, sum(target / words) OVER () AS total
  FROM g WHERE target > 0),
p AS (SELECT j, (j + 0.5) * CAST({PHI} AS DOUBLE) AS u FROM (SELECT unnest(range((SELECT CAST(round(sum(target / words)) AS BIGINT) FROM g))) AS j)),
r AS (
  SELECT b.source, (source_size + words - 1) // words AS blocks, row_number() OVER (PARTITION BY b.source ORDER BY j) - 1 AS rank
  FROM p JOIN b ON u - floor(u) >= low / b.total AND u - floor(u) < (low + share) / b.total WHERE words = 1),
a AS (SELECT source, count(*) AS reads FROM r WHERE rank // blocks < 3 GROUP BY 1),
k AS (SELECT g.source, CASE WHEN words > 1 THEN CAST(round(target) AS BIGINT) ELSE coalesce(reads, 0) END AS n FROM g LEFT JOIN a ON a.source IS NOT DISTINCT FROM g.source),
s AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY CAST('0x' || substr(o, 1, 4) AS BIGINT) % {RUNS}, o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d),
f AS (
  SELECT s.source, s.start, n // greatest(source_size, 1) * size + greatest(0, least(size, n % greatest(source_size, 1) - start)) AS taken
  FROM s JOIN k ON s.source IS NOT DISTINCT FROM k.source JOIN t ON s.source IS NOT DISTINCT FROM t.source WHERE size > 0)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, t.source_size, round(t.target, 6) AS target, CAST(coalesce(f.taken, 0) AS BIGINT) AS taken
FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN f ON s.source IS NOT DISTINCT FROM f.source AND s.start = f.start AND s.size > 0
"""
