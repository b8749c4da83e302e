"""Exact dedup against a persistent index of digests, with DataFrame functions only.

The index is a table bucketed and sorted by digest. A load of new rows is reduced
to its best row for each digest, a sort-merge anti-join drops what the index
already holds as good or better, and the rest is appended; nothing is rewritten.

Defined results: null text counts as empty; texts are equal when they are after
deleting white space; of equal texts the row with most code points stays, then the
smallest doc_id (a null doc_id loses to any other). Repeated rows share their
verdict; :func:`deduplicate` keeps one of them. An empty table gives an empty
result. Only doc_id and text are read, so further columns do not matter.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.llm.text import SPACES, document_columns, documents
from tarnworks.session import fresh_path, staged

QUERY = "op1_exact_dedup"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_points (code points of the text), digest (SHA-256 of the text without white space)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(text).cast("bigint").alias("n_points"),
        F.unhex(F.sha2(F.translate(text, SPACES, ""), 256)).alias("digest"),
    )


class DigestIndex:
    """The index at ``path``: rows (digest, n_points, doc_id), some digests more than once.

    ``buckets`` is fixed when the index is made; give the same number each time. At
    32 bytes a digest, 100 TB of documents take a few thousand buckets.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "digest_index_" + hashlib.md5(path.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, n_points BIGINT, doc_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def ingest(self, load: DataFrame) -> None:
        """Append what ``load`` (from :func:`digests`) has beyond the index."""
        best = _best(load)
        known = self.rows().select(F.col("digest").alias("k_digest"), F.col("n_points").alias("k_points"), F.col("doc_id").alias("k_id"))
        as_good = (F.col("k_points") > F.col("n_points")) | (
            (F.col("k_points") == F.col("n_points"))
            & (F.col("doc_id").isNull() | F.coalesce(F.col("k_id") <= F.col("doc_id"), F.lit(False)))
        )
        fresh = best.join(known.hint("merge"), (F.col("digest") == F.col("k_digest")) & as_good, "left_anti")
        fresh = staged(fresh.select("digest", "n_points", "doc_id"), "digest-load")
        fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)

    def keepers(self) -> DataFrame:
        """One row for each digest: what stays of its texts."""
        return _best(self.rows())


def _best(rows: DataFrame) -> DataFrame:
    """The row of each digest that stays; partial aggregates keep a hot digest small before the shuffle."""
    order = F.struct(F.col("n_points").alias("n"), (-F.col("doc_id")).alias("id"))
    return rows.groupBy("digest").agg(F.max(order).alias("top")).select("digest", F.col("top.n").alias("n_points"), (-F.col("top.id")).alias("doc_id"))


def exact_dedup(docs: DataFrame, index_path: str | None = None, buckets: int | None = None, loads: int = 2) -> DataFrame:
    """A row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``docs`` goes into the index at ``index_path`` (a new one if not given) in
    ``loads`` loads that together hold every row, each against all before it.
    keep_id may be of a row that an earlier call put into the index; group_size
    counts rows of ``docs``.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = staged(digests(docs), "digests")
    index = DigestIndex(spark, index_path or fresh_path(spark, "digest-index"), buckets)
    load = F.pmod(F.xxhash64("doc_id"), F.lit(loads))
    for k in range(loads):
        index.ingest(rows.where(load == k))
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    keepers = index.keepers().select(F.col("digest").alias("k_digest"), F.col("doc_id").alias("keep_id"), F.col("n_points").alias("keep_points"))
    groups = staged(sizes.join(keepers, F.col("digest") == F.col("k_digest")).select("digest", "group_size", "keep_id", "keep_points"), "digest-groups")
    # Both sides are plain scans, so adaptive execution can split a digest that a third of the rows share.
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("bigint").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with the columns of documents."""
    docs = document_columns(docs)
    verdicts = exact_dedup(docs, **options)
    stay = verdicts.where("kept").select(F.col("doc_id").alias("s_id"), F.unhex("text_sha256").alias("s_digest")).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumn("_digest", F.unhex(F.sha2(F.translate(text, SPACES, ""), 256))).withColumn("_points", F.length(text))
    # A row passes by doc_id and digest; of several under one doc_id the longest is the keeper.
    passed = marked.join(stay, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("_digest") == F.col("s_digest")), "left_semi")
    top = F.max_by(F.struct(*docs.columns), "_points").alias("row")
    return passed.groupBy("doc_id", "_digest").agg(top).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


ORACLE = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS kept,
       h AS text_sha256
FROM d
"""
