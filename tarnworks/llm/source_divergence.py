"""How far the sources of a language are from one another, by joint count histograms.

Each language keeps the terms that stand in at least ``LEAST_DOCS`` of its documents.
A group is a language and a source. Two groups are compared over all kept terms, but
their divergence depends on a term only through its two counts, so it is evaluated once
for each combination of counts and taken as often as that combination occurs:

* Tasks count terms and the documents that hold them; one shuffle by language and term
  brings the counts of a term together as its profile, one entry for each source that has it.
* Equal profiles are tallied before their pairs of sources are. So rare terms, of which
  there are most, cost little.
* The histogram of a pair gets its cells (c, d) from the profiles that hold both sources.
  Cells with a zero are implied: terms of count c in one source, less those that the other
  has as well; what is left of the language's terms is in neither.

The number of pairs is the square of a language's sources, as the result has a row for each.

Defined results: null text, lang and source count as empty; rows count as documents, whatever
their doc_id. A group without terms has all counts 0. A language without kept terms gives
divergences of 0. A source that is alone in its language is compared with nothing. An empty table gives an empty
result. Only text, lang and source are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.llm.text import documents
from tarnworks.session import staged

QUERY = "op12_source_divergence"

#: Documents of a language that must hold a term for it to be kept.
LEAST_DOCS = 3
#: Shares are counted in parts of this.
UNIT = 1_000_000_000
#: Terms that a group reports.
RANKS = 200

#: Entries that a task gathers before it hands them on, and bytes of a text that it splits at once.
GATHERED = 1 << 19
SLICE = 1 << 20

#: Letters are A-Z (lower-cased), a-z and all beyond ASCII; every other byte parts terms.
LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def _terms(text: str | None) -> Iterator[list[bytes]]:
    data = text.encode("utf-8", "surrogatepass").translate(LETTERS) if text else b""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + SLICE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of each term as each task met them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            for lang, source, text in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2)):
                group, distinct = (lang, source), set()
                for terms in _terms(text.as_py()):
                    found[group].update(terms)
                    distinct.update(terms)
                held[group].update(distinct)
                if sum(map(len, held.values())) > GATHERED:
                    yield from rows(found, held)
                    found.clear()
                    held.clear()
        yield from rows(found, held)

    def rows(found: dict, held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in found.items():
            terms, docs_of = pa.array(list(counts), pa.binary()).cast(pa.string()), held[lang, source]
            numbers = [pa.array(list(counts.values()), pa.int64()), pa.array([docs_of[t] for t in counts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(pa.array([x] * len(terms), pa.string()) for x in (lang, source)), terms, *numbers], names=["lang", "source", "term", "n", "docs"])

    return _named(docs).mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], F.col("text").cast("string").alias("text"))


def profiles(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, total, profile (source and n of the sources that have it, in order) for each kept term."""
    # tasks hand on one row for each group and term, so a common term has few rows however often it occurs
    dealt = term_counts(docs).repartition("lang", "term")
    counts = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    entries = F.sort_array(F.collect_list(F.struct("source", "n"))).alias("profile")
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), entries).where(F.col("docs") >= least_docs).drop("docs")


def _share(n: Column, words: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (words + terms)) in whole numbers."""
    scaled = F.lit(UNIT).cast("decimal(20,0)") * (n + 1)
    return F.call_function("div", scaled, F.greatest(words + terms, F.lit(1)).cast("decimal(20,0)")) + 1


def _far(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def pair_histograms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, one, two, c, d, times: of each two sources of a language, how many kept terms have counts c and d in them, zeros included.

    groups: lang, source, words, terms (kept ones of the language).
    """
    alike = kept.groupBy("lang", "profile").agg(F.count(F.lit(1)).alias("times"))
    alike = staged(alike, "divergence-profiles")
    two = F.expr("flatten(transform(profile, (x, i) -> transform(slice(profile, i + 2, size(profile)), y -> struct(x.source AS one, y.source AS two, x.n AS c, y.n AS d))))")
    both = alike.where(F.size("profile") > 1).select("lang", "times", F.explode(two).alias("p"))
    both = staged(both.groupBy("lang", "p.one", "p.two", "p.c", "p.d").agg(F.sum("times").alias("times")), "divergence-both")

    def cells(rows: DataFrame, *parts: tuple) -> DataFrame:
        """Each row adds ``times`` (or takes it away) at cells of its pair."""
        zero = lambda c: F.col(c) if isinstance(c, str) else F.lit(0).cast("bigint")
        cell = F.explode(F.array(*[F.struct(zero(c).alias("c"), zero(d).alias("d"), (F.col("times") * sign).alias("times")) for c, d, sign in parts])).alias("x")
        return rows.select("lang", "one", "two", cell).select("lang", "one", "two", "x.*")

    single = alike.select("lang", "times", F.explode("profile").alias("e")).groupBy("lang", "e.source", "e.n").agg(F.sum("times").alias("times"))
    single = staged(single.withColumnsRenamed({"lang": "s_lang", "n": "s_n"}), "divergence-single")
    left = groups.select("lang", F.col("source").alias("one"), F.col("terms").alias("times"))
    right = groups.select(F.col("lang").alias("r_lang"), F.col("source").alias("two"))
    pairs = staged(left.join(right, (F.col("lang") == F.col("r_lang")) & (F.col("one") < F.col("two"))).drop("r_lang"), "divergence-pairs")

    def alone(side: str) -> DataFrame:
        own = pairs.drop("times").join(single, (F.col("lang") == F.col("s_lang")) & (F.col(side) == F.col("source")))
        return cells(own, ("s_n", 0, 1) if side == "one" else (0, "s_n", 1), (0, 0, -1))

    found = cells(both, ("c", "d", 1), ("c", 0, -1), (0, "d", -1), (0, 0, 1))
    for more in (alone("one"), alone("two"), cells(pairs, (0, 0, 1))):
        found = found.unionByName(more)
    return found.groupBy("lang", "one", "two", "c", "d").agg(F.sum("times").alias("times"))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: each group against the other sources (``pair``), and its terms that stand out of its language (``term``)."""
    kept = staged(profiles(docs, least_docs), "divergence-terms")
    entries = kept.select("lang", "term", "total", F.explode("profile").alias("e")).select("lang", "term", "total", "e.source", "e.n")
    own = entries.groupBy(F.col("lang").alias("o_lang"), F.col("source").alias("o_source")).agg(F.sum("n").alias("words"))
    of_lang = kept.groupBy(F.col("lang").alias("l_lang")).agg(F.sum("total").alias("l_words"), F.count(F.lit(1)).alias("l_terms"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    groups = _named(docs).select("lang", "source").distinct()
    groups = groups.join(own, (F.col("lang") == F.col("o_lang")) & (F.col("source") == F.col("o_source")), "left").join(of_lang, F.col("lang") == F.col("l_lang"), "left")
    groups = staged(groups.select("lang", "source", none("words"), none("l_words"), none("l_terms").alias("terms")), "divergence-groups")

    cells = pair_histograms(kept, groups)
    for side in ("one", "two"):
        sizes = groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), F.col("words").alias(f"{side}_words"), F.col("terms").alias(f"{side}_terms"))
        cells = cells.join(sizes, (F.col("lang") == F.col("g_lang")) & (F.col(side) == F.col("g_source"))).drop("g_lang", "g_source")
    shares = cells.withColumns({"p": _share(F.col("c"), F.col("one_words"), F.col("one_terms")), "q": _share(F.col("d"), F.col("two_words"), F.col("two_terms"))})
    wide = lambda x: x.cast("decimal(38,0)") * F.col("times").cast("decimal(20,0)")
    sums = shares.groupBy("lang", "one", "two").agg(F.sum(wide(_far(F.col("p"), F.col("q")))).alias("there"), F.sum(wide(_far(F.col("q"), F.col("p")))).alias("back"))
    turned = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item"), F.col("there").alias("value")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"), F.col("back").alias("value"))))
    pairs = sums.select("lang", turned.alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", F.col("x.value").cast("bigint").alias("value"))

    own = groups.withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    seen = entries.join(own, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")))
    seen = seen.withColumns({"p": _share(F.col("n"), F.col("words"), F.col("terms")), "q": _share(F.col("total"), F.col("l_words"), F.col("terms"))}).where("p > q")
    terms = seen.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _far(F.col("p"), F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    # the filter on ranks reaches below the shuffle: each task hands on its first ones of a group only
    top = terms.withColumn("rank", rank).where(F.col("rank") <= ranks)
    return pairs.withColumn("rank", rank).unionByName(top)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS words FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
v AS (SELECT lang, count(*) AS terms, sum(total) AS l_words FROM k GROUP BY lang),
a AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + {UNIT}::HUGEINT * (coalesce(c.n, 0) + 1) // (words + terms) AS p,
         1 + {UNIT}::HUGEINT * (total + 1) // (l_words + terms) AS l
  FROM s JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
f AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM a x JOIN a y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
o AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - l) * (p - l) // l FROM a WHERE n > 0 AND p > l),
q AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM q WHERE part = 'pair' OR rank <= {RANKS}
"""
