"""Chat formatting after collapsing cumulative snapshots, with DataFrame functions only.

A logged conversation that is the beginning of a longer one is a snapshot of it
and goes; of equal conversations the smallest conv_id stays. Each turn gets a hash
of its place, role and text; the running sums of these hashes over a conversation
are hashes of its prefixes. An anti-join of whole conversations against the proper
prefixes of all leaves the maximal ones, which are then rendered.

Conversations are handled in blocks of ``BLOCK`` turns: sums within a block, then
over the few rows of block sums. So neither a conversation with a third of all
turns nor a first turn that everyone shares lands in one task, and a rendered row
holds ``BLOCK`` turns at most.

Defined results: turns are ordered by turn, role and text, nulls first; repeated
rows are turns of their own. A null role is rendered as "unknown", a null text as
empty; both differ from the written-out values when conversations are compared.
Rows with a null conv_id are one conversation. A conversation of more than 2^23 turns
fails, as its hash sums would overflow. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.session import staged

QUERY = "op5_chat_formatting"

BLOCK = 256
LANES = ("h1", "h2", "h3")


def _before(rows: DataFrame, sums: list[str]) -> DataFrame:
    """``rows`` with ``before_<x>``: the sum of x over the earlier blocks of the conversation."""
    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("b_id"), F.col("block").alias("b_block"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums])
    return rows.join(blocks, F.col("conv_id").eqNullSafe(F.col("b_id")) & (F.col("block") == F.col("b_block"))).drop("b_id", "b_block")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text and the three lanes of the prefix hash up to the turn."""
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    rows = rows.withColumns({"block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))), "one": F.lit(1)})
    inside = Window.partitionBy("conv_id", "block").orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    rows = _before(rows.withColumn("inside", F.row_number().over(inside)), ["one"])
    rows = rows.withColumn("place", F.col("before_one") + F.col("inside"))
    said = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("null")) for c in ("role", "text")]
    rows = rows.withColumn("sha", F.sha2(F.concat_ws("/", F.col("place").cast("string"), *said), 256))
    # 40 bits each: sums over 2^23 turns stay below 2^63
    lanes = {h: F.conv(F.substring("sha", 10 * k + 1, 10), 16, 10).cast("bigint") for k, h in enumerate(LANES)}
    rows = staged(rows.withColumns(lanes).select("conv_id", "block", "place", "role", "text", *LANES), "chat-turns")
    sofar = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = _before(rows, list(LANES)).withColumns({f"upto_{h}": F.sum(h).over(sofar) + F.col(f"before_{h}") for h in LANES})
    return staged(rows.select("conv_id", "place", "role", "text", *[F.col(f"upto_{h}").alias(h) for h in LANES]), "chat-prefixes")


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id, total of the conversations that are no beginning of another, the smallest conv_id of equal ones."""
    last = F.max(F.struct("place", *LANES)).alias("last")
    whole = staged(prefixes.groupBy("conv_id").agg(last).select("conv_id", "last.*"), "chat-whole")
    distinct = whole.groupBy("place", *LANES).agg(F.min("conv_id").alias("conv_id"))
    lengths = whole.select(F.col("conv_id").alias("w_id"), F.col("place").alias("total"))
    proper = prefixes.join(lengths, F.col("conv_id").eqNullSafe(F.col("w_id"))).where(F.col("place") < F.col("total")).select("place", *LANES).distinct()
    return distinct.join(proper, ["place", *LANES], "left_anti").select("conv_id", F.col("place").alias("total"))


def chat_texts(conversations: DataFrame) -> DataFrame:
    """conv_id, part (of BLOCK turns, from 0), n_turns of the part, total_turns, text."""
    prefixes = turns(conversations)
    stay = staged(maximal(prefixes).withColumnRenamed("conv_id", "m_id"), "chat-maximal")
    rows = prefixes.join(stay, F.col("conv_id").eqNullSafe(F.col("m_id"))).withColumn("part", F.floor((F.col("place") - 1) / BLOCK))
    said = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))
    turn = F.struct("place", said.alias("said"))
    parts = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n_turns"), F.max("total").cast("bigint").alias("total_turns"), F.array_sort(F.collect_list(turn)).alias("turns"))
    return parts.select("conv_id", "part", "n_turns", "total_turns", F.array_join(F.transform("turns", lambda t: t["said"]), "").alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_texts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS r
  FROM conversations),
c AS (
  SELECT conv_id, count(*) AS n, list(struct_pack(role := role, text := text) ORDER BY r) AS l FROM t GROUP BY conv_id),
u AS (SELECT l, min(n) AS n, min(conv_id) AS conv_id FROM c GROUP BY l),
m AS (
  SELECT conv_id, n FROM u WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.l[1] IS NOT DISTINCT FROM u.l[1] AND c.n > u.n AND c.l[1:u.n] = u.l))
SELECT t.conv_id, (r - 1) // 256 AS part, count(*) AS n_turns, max(m.n) AS total_turns,
       string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY r) AS text
FROM t JOIN m ON t.conv_id = m.conv_id GROUP BY 1, 2
"""
