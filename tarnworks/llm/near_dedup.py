"""Near-duplicate detection with bottom-k sketches from one hash function.

A text's set is its distinct word shingles. Texts with the same set form a class,
which goes on as one representative. Of each representative's set the ``K``
smallest hashes are its sketch, and inverted lists of the retained values yield
the candidates:

* Two sets of Jaccard similarity 0.8 or more share at least ``shared_least``
  values of their sketches (but for a chance below 1e-9). Values are ordered
  rarest first; a pair with that many in common must meet in the part of each
  sketch that leaves fewer than that many values. Values held by one set alone
  cannot match, so most documents drop out here, and passages that many
  documents share are not looked up unless they make up much of the document.
* First, each list's members are paired with one leader of the list, the member
  whose values are the most common ones, so that the middle of a large group of
  near copies leads it. The union's sketch (the K smallest of both) estimates the
  similarity of a pair; clearly lower ones go, and what remains is verified on the
  full sets. Verified links join the members into components. Lists that still hold
  several components are led once more, by the next best member that is not in
  its first leader's component.
* Lists that hold several components then are unsettled. Their members meet once
  more by their full sets, exactly: with shingles ordered rarest first, a pair of
  the wanted similarity shares one among the first few of each, at places that
  leave room for the overlap it needs. Pairs of one component are settled, so a
  group of near copies does not make all its pairs. Where they meet, two sets are
  compared by parity sketches: bit b says whether an odd number of the set's hashes
  end in b. Shared hashes cancel out, so two sets differ in at least as many shingles as
  their sketches in bits; a pair that differs in too many is not handed on. So variants of
  one text that are all just below the similarity make no pairs. What remains is verified as well.

Defined results: null and empty texts, and texts without words, have an empty set
and are linked with nothing; a text of fewer words than a shingle has its whole
sequence as one. A doc_id on several rows counts as one document, compared by its
text with the largest set (then the largest digest). Rows with a null doc_id are
kept and linked with nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.llm.components import components
from tarnworks.llm.text import WordHashes, digest16, document_columns, documents, shingle_hashes
from tarnworks.session import staged

QUERY = "op10_minhash_near_dedup"

K = 64
#: Least number of the K smallest values of a union that two sets of similarity 0.8 share: less has a binomial chance below 1e-9.
CERTAIN = 29
#: 64-bit words of a parity sketch; sets above PARITY_MOST shingles differ in too many for it to tell.
PARITY_WORDS = 16
PARITY_MOST = 2000
PARITY = [f"q{k}" for k in range(PARITY_WORDS)]
#: Rounds in which each unsettled list is led.
LEADS = 2


def _ordered(hashes: np.ndarray) -> np.ndarray:
    """The hashes as signed numbers in ascending order."""
    return np.sort(hashes.view(np.int64))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_digest, sketch for each row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sizes, digests, sketches = WordHashes(), [], [], []
            for text in batch.column(1):
                hashes = shingle_hashes(text.as_py(), words, width)
                sizes.append(len(hashes))
                digests.append(digest16(hashes))
                sketches.append(_ordered(hashes)[:K])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _lists(sketches)], names=["doc_id", "n_shingles", "set_digest", "sketch"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc_id bigint, n_shingles bigint, set_digest binary, sketch array<bigint>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, set_digest, members (the set's hashes in ascending order) and the set's parity sketch."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = WordHashes()
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [shingle_hashes(x.as_py(), words, width) for x in part.column(1)]
                parities = np.array([_parity(x) for x in found], np.int64).reshape(-1, PARITY_WORDS).T
                columns = [part.column(0), pa.array(map(digest16, found), pa.binary()), _lists([_ordered(x) for x in found]), *map(pa.array, parities)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "set_digest", "members", *PARITY])

    schema = "doc_id bigint, set_digest binary, members array<bigint>, " + ", ".join(f"{q} bigint" for q in PARITY)
    return docs.select("doc_id", "text").mapInArrow(sets, schema)


def _parity(hashes: np.ndarray) -> np.ndarray:
    bits = 64 * PARITY_WORDS
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)])))


def shared_least(n: Column) -> Column:
    """Values that the sketch of a set of n has in common with that of any set similar to it."""
    return F.least(F.lit(CERTAIN), F.ceil(F.col("n") * 0.8 - 1e-9)).cast("int")


def _sizes_fit(a: str, b: str) -> Column:
    return (100 * F.least(a, b)) >= (80 * F.greatest(a, b))


def postings(reps: DataFrame) -> DataFrame:
    """value, rep, n, weight: the values under which a representative is looked up, and how common its values are."""
    every = reps.select("rep", "n", F.explode("sketch").alias("value"))
    lists = every.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1").withColumnRenamed("value", "l_value")
    common = every.join(lists, F.col("value") == F.col("l_value")).select("rep", "n", "value", "df")
    own = Window.partitionBy("rep")
    ranked = common.withColumns({"have": F.count(F.lit(1)).over(own), "weight": F.sum("df").over(own), "place": F.row_number().over(own.orderBy("df", "value"))})
    return ranked.where(F.col("place") <= F.col("have") - shared_least(F.col("n")) + 1).select("value", "rep", "n", "weight")


def unsettled_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that may have the similarity, none left out; sets: rep, component, members, parity.

    Two sets have it when they differ in at most a ninth of both sizes. The smaller of two sets with 9 * overlap >= 4 * (both sizes) shares one of its
    first n - ceil(8n/9) + 1 shingles with the first n - ceil(8n/10) + 1 of the larger.
    """
    every = sets.select("rep", "component", F.size("members").cast("bigint").alias("n"), F.explode("members").alias("value"))
    sketches = sets.select(F.col("rep").alias("q_rep"), *PARITY)
    often = every.groupBy("value").agg(F.count(F.lit(1)).alias("df")).withColumnRenamed("value", "o_value")
    ranked = every.join(often, F.col("value") == F.col("o_value")).withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy("df", "value")).cast("bigint"))
    first = ranked.where((F.col("df") > 1) & (F.col("place") <= F.col("n") - F.ceil(F.col("n") * 8 / 10 - 1e-9) + 1))
    first = first.select("value", "rep", "n", "component", "place").join(sketches, F.col("rep") == F.col("q_rep")).drop("q_rep")
    first = staged(first, "near-first")
    small = first.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * 8 / 9 - 1e-9) + 1)
    small = small.select(*[F.col(c).alias(f"s_{c}") for c in first.columns])
    room = F.least(F.col("n") - F.col("place"), F.col("s_n") - F.col("s_place")) + 1
    apart = sum((F.bit_count(F.col(f"s_{q}").bitwiseXOR(F.col(q))) for q in PARITY), F.lit(0))
    met = small.join(
        first,
        (F.col("s_value") == F.col("value")) & (F.col("s_component") != F.col("component"))
        & ((F.col("s_n") < F.col("n")) | ((F.col("s_n") == F.col("n")) & (F.col("s_rep") < F.col("rep"))))
        & (100 * F.col("s_n") >= 80 * F.col("n")) & (9 * room >= 4 * (F.col("n") + F.col("s_n")))
        & ((F.col("n") > PARITY_MOST) | (9 * apart <= F.col("n") + F.col("s_n"))),
    )
    return met.select(F.least("s_rep", "rep").alias("a"), F.greatest("s_rep", "rep").alias("b")).distinct()


def _close_sketches(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose union's sketch does not rule out the similarity."""
    one = reps.select(F.col("rep").alias("a"), F.col("sketch").alias("a_sketch"), F.col("n").alias("a_n"))
    two = reps.select(F.col("rep").alias("b"), F.col("sketch").alias("b_sketch"), F.col("n").alias("b_n"))
    both = pairs.join(one, "a").join(two, "b").where(_sizes_fit("a_n", "b_n"))
    union = F.slice(F.array_sort(F.array_union("a_sketch", "b_sketch")), 1, K)
    common = F.size(F.array_intersect(F.array_intersect("a_sketch", "b_sketch"), union))
    # A union of fewer than K values is whole: the share is exact there.
    least = F.when(F.size(union) < K, F.ceil(F.size(union) * 0.8 - 1e-9)).otherwise(F.lit(CERTAIN))
    return both.where(common >= least).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with 100 * intersection >= 80 * union of the full sets."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, two = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(one, two, assume_unique=True))
                mask.append(100 * common >= 80 * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(mask, pa.bool_()))

    one = sets.select(F.col("rep").alias("a"), F.col("members").alias("a_members"))
    two = sets.select(F.col("rep").alias("b"), F.col("members").alias("b_members"))
    full = pairs.join(one, "a").join(two, "b").select("a", "b", "a_members", "b_members")
    return full.mapInArrow(confirm, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 4) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles, component_id, kept."""
    signed = staged(signatures(docs, width), "near-signatures")
    several = not signed.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()
    primary = signed
    if several:
        one = signed.groupBy("doc_id").agg(F.max(F.struct("n_shingles", "set_digest", "sketch")).alias("top"))
        primary = staged(one.select("doc_id", "top.*"), "near-primary")
    classes = primary.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_digest").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    reps = staged(classes, "near-classes")
    lists = staged(postings(reps), "near-postings")

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # one pass over the texts for all representatives that are looked up
    sets = _sets(texts, lists.select(F.col("rep").alias("w")).distinct(), reps, width)
    links, placed = None, lists.withColumn("component", F.col("rep"))
    for again in range(LEADS):
        led = _led(placed, again > 0)
        pairs = led.where(F.col("component") != F.col("l_component")).select(F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b")).distinct()
        found = staged(_verified(staged(_close_sketches(pairs, reps), "near-close"), sets), "near-links")
        links = found if links is None else links.unionByName(found)
        member = components(links).select(F.col("node").alias("g_node"), F.col("component").alias("g_component"))
        placed = placed.join(member, F.col("rep") == F.col("g_node"), "left").withColumn("component", F.coalesce("g_component", "rep")).select(*lists.columns, "component")
        mixed = placed.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select(F.col("value").alias("m_value"))
        placed = staged(placed.join(mixed, F.col("value") == F.col("m_value")).drop("m_value"), "near-placed")
    open_reps = staged(placed.select(F.col("rep").alias("w"), "component").distinct(), "near-open")
    rest = unsettled_pairs(sets.join(open_reps, F.col("rep") == F.col("w")))
    links = links.unionByName(_verified(staged(_close_sketches(rest, reps), "near-rest"), sets))
    groups = components(staged(links, "near-all-links"))

    member = groups.select(F.col("node").alias("g_node"), "component")
    labels = reps.join(member, F.col("rep") == F.col("g_node"), "left").select(F.col("set_digest").alias("c_digest"), F.coalesce("component", "rep").alias("component"))
    labels = staged(labels, "near-labels")
    # Both sides are plain scans, so adaptive execution can split a class that a third of the rows share.
    known = primary.select("doc_id", "n_shingles", "set_digest").join(labels, F.col("set_digest") == F.col("c_digest"), "left")
    known = known.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    if several:
        known = signed.select("doc_id", "n_shingles").join(known.select(F.col("doc_id").alias("k_id"), "component_id"), F.col("doc_id").eqNullSafe(F.col("k_id")), "left")
    return known.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _led(placed: DataFrame, again: bool) -> DataFrame:
    """Lists of several components with leader and l_component, the leader's: the top member, or the top of those not in that one's component."""
    top = F.max(F.struct("weight", (-F.col("rep")).alias("back"), "component")).alias("top")

    def with_leader(rows: DataFrame) -> DataFrame:
        leader = rows.groupBy("value").agg(top, F.count(F.lit(1)).alias("held"))
        leader = leader.where("held > 1") if rows is placed else leader
        return leader.select(F.col("value").alias("l_value"), (-F.col("top.back")).alias("leader"), F.col("top.component").alias("l_component"))

    leader = with_leader(placed)
    if again:
        rest = placed.join(leader, F.col("value") == F.col("l_value")).where(F.col("component") != F.col("l_component"))
        leader = with_leader(rest.select(*placed.columns))
    return placed.join(leader, F.col("value") == F.col("l_value"))


def _sets(texts: DataFrame, wanted: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """rep, members for the representatives in ``wanted`` (one column w)."""
    found = full_sets(texts.join(wanted, F.col("doc_id") == F.col("w"), "left_semi"), width)
    names = reps.join(wanted, F.col("rep") == F.col("w"), "left_semi").select(F.col("rep"), F.col("set_digest").alias("r_digest"))
    # a doc_id may stand on several rows; those with the representative's set are alike
    sets = found.join(names, (F.col("doc_id") == F.col("rep")) & (F.col("set_digest") == F.col("r_digest")))
    return staged(sets.groupBy("rep").agg(*[F.first(c).alias(c) for c in ("members", *PARITY)]), "near-sets")


def without_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """The rows of ``docs`` that are kept, one for each component, with the columns of documents.

    Sets are of five words here, as for near-duplicate stages in general; the query's contract wants four.
    """
    docs = document_columns(docs)
    dropped = near_duplicates(docs, width).where(~F.col("kept")).select(F.col("doc_id").alias("d_id")).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col("d_id"), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(t[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, t, unnest(range(1, greatest(1, len(t) - 3) + 1)) AS i FROM w WHERE len(t) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS u FROM documents UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.u)
SELECT d.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r.u) AS component_id, d.doc_id = min(r.u) AS kept
FROM documents d JOIN r ON r.v = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
