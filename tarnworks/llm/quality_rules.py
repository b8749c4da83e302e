"""Quality rules: robust outliers among transformed text statistics, per language and source.

Every document gets a vector of four transformed statistics. For each group of
language and source a minimum-covariance-determinant estimate is found by
concentration steps over all its rows: distances under the present estimate are
counted in fine steps, the nearest half of the group are summed (of the step in
which the half ends only the needed part, so that tied copies do not enter all at
once), and the sums give the next estimate. Every group starts from four centres and
covariances (see :func:`starts`) and from ``SUBSETS`` subsets of five of its vectors (:func:`subset_starts`); all take two
steps, and from the ``BEST`` of the smallest determinants steps go on until the determinant stops
falling, ``STEPS`` at most; the estimate of the smallest determinant stays. It is taken again from
all rows within ``REWEIGHT`` of it. Rows are reduced to distinct vectors with their numbers once, and a step, for all starts at once, is one
aggregate over these, keyed by group, start and distance step, so a group with a third of the rows is pre-aggregated in every
task; only estimates (one row a group and start) reach numpy. A row is rejected when its
Mahalanobis distance is beyond ``CUTOFF``.

Groups of fewer than ``LEAST`` rows are pooled by language, and languages that
remain too small are pooled together; a last pool of fewer than ``LEAST`` rows
rejects nothing. Rows that fail the base rules are no part of an estimate. The
statistics are whole numbers, so sums do not depend on the order of rows.

Defined results: null or empty text has no words, all counts 0, and fails the base
rules; null language or source is a group of its own. Repeated rows are judged
alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.llm.text import SPACES, document_columns, documents
from tarnworks.session import staged

QUERY = "op8_quality_rules"

SYMBOLS = "#*$%&|<>"
#: The vector: log of the mean word length, root of symbols a word, share of repeated lines, share of repeated words;
#: with the least scale that each is taken to have, so that a statistic which is 0 nearly everywhere does not reject every other value.
#: ``CUTOFF`` times each scale is within what the base rules let pass, so each statistic can reject alone.
VECTOR = {"v_length": 0.07, "v_symbols": 0.06, "v_lines": 0.08, "v_repeats": 0.08}
UNIT = 1024  # a vector's whole numbers are 1/UNIT
#: Share of a group that an estimate rests on; the count is (n + dimensions + 1) / 2, so a group stands nearly half of bad rows.
SHARE = 0.5
STEPS = 12
#: Starts from subsets: their number, the vectors of one, the vectors of a group that they are drawn from, and how many estimates go on after two steps.
SUBSETS, SUBSET, POOL, BEST = 60, len(VECTOR) + 1, 300, 10
#: The log of a determinant has stopped falling when it falls by no more than this.
FALL = 1e-6
LEAST = 50
#: Mahalanobis distance beyond which a row is rejected: the root of the chi-square quantile 0.99999 of four degrees.
CUTOFF = 5.34
#: Mean of the squared distance over the nearest half of a Gaussian of four dimensions, by dimension: the estimate is divided by it.
CONSISTENCY = 0.4741
#: Squared distance up to which rows make the last estimate, the chi-square quantile 0.975 of four degrees, and its consistency factor.
REWEIGHT, REWEIGHT_CONSISTENCY = 11.143, 0.9394
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS`` of one whole text."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return (0,) * len(COUNTS)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often, end = Counter(windows), 0
        for k, w in enumerate(windows):
            if often[w] > 1:
                repeated += k + 3 - max(end, k)
                end = k + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``COUNTS``; the text stays if it is there."""
    keep = docs.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(keep.index("text"))
            rows = [text_counts(x.as_py()) for x in texts]
            columns = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns)], names=[*keep, *COUNTS])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"{c} bigint" for c in COUNTS)])
    return docs.mapInArrow(add, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_vector(counted: DataFrame) -> DataFrame:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    values = [
        F.log(F.greatest("word_chars", F.lit(1)) / words),
        F.sqrt(F.col("n_symbols") / words),
        F.col("n_dup_lines") / lines,
        F.col("n_repeat_words") / words,
    ]
    return counted.withColumns({c: F.round(v * UNIT).cast("bigint") for c, v in zip(VECTOR, values)})


def _key(*columns: str) -> Column:
    """A text for the values of columns in which null differs from every string."""
    return F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("null")) for c in columns])


def with_groups(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"g_full": _key("lang", "source"), "g_lang": _key("lang")})


def group_names(rows: DataFrame) -> DataFrame:
    """g_full, group: the group in which a language and source are estimated."""
    full = staged(rows.groupBy("g_full", "g_lang").agg(F.count(F.lit(1)).alias("n")), "quality-groups")
    small = F.when(F.col("n") < LEAST, F.col("n")).otherwise(0)
    pooled = full.groupBy("g_lang").agg(F.sum(small).alias("lang_n")).withColumnRenamed("g_lang", "l_lang")
    name = F.when(F.col("n") >= LEAST, F.col("g_full")).when(F.col("lang_n") >= LEAST, F.concat(F.lit("lang "), "g_lang")).otherwise(F.lit("all"))
    return full.join(pooled, F.col("g_lang") == F.col("l_lang")).select("g_full", name.alias("group"))


_PAIRS = [(a, b) for a in range(len(VECTOR)) for b in range(a, len(VECTOR))]
_ESTIMATE = "`group` string, start int, rows bigint, logdet double, " + ", ".join(f"m{k} double" for k in range(len(VECTOR))) + ", " + ", ".join(f"p{a}{b} double" for a, b in _PAIRS)


def _estimates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centres, inverse covariances and log determinants from sums: one row a group and start in and out.

    In units of the least scales, variances below 1 along the axes of the covariance are raised to 1; others stay.
    """
    scale = np.array(list(VECTOR.values())) * UNIT
    units = np.outer(scale, scale)
    for sums in frames:
        out = []
        for row in sums.itertuples(index=False):
            n = float(row.n)
            mean = np.array([float(getattr(row, f"s{k}")) for k in range(len(VECTOR))]) / n
            cov = np.zeros((len(VECTOR),) * 2)
            for a, b in _PAIRS:
                cov[a, b] = cov[b, a] = float(getattr(row, f"q{a}{b}")) / n - mean[a] * mean[b]
            variances, axes = np.linalg.eigh(cov / row.consistency / units)
            variances = np.maximum(variances, 1.0)
            inverse = (axes / variances) @ axes.T / units
            out.append((row.group, int(row.start), int(row.rows), float(np.log(variances).sum()), *mean, *(inverse[a, b] for a, b in _PAIRS)))
        yield pd.DataFrame(out, columns=[x.split()[0].strip("`") for x in _ESTIMATE.split(", ")])


def distance() -> Column:
    """Squared Mahalanobis distance of a row's vector from the estimate beside it."""
    parts = [F.col(c) - F.col(f"m{k}") for k, c in enumerate(VECTOR)]
    total = F.lit(0.0)
    for a, b in _PAIRS:
        total = total + parts[a] * parts[b] * F.col(f"p{a}{b}") * (1 if a == b else 2)
    return total


_CENTRE, _INVERSE = [f"m{k}" for k in range(len(VECTOR))], [f"p{a}{b}" for a, b in _PAIRS]
_SUMS = [f"s{k}" for k in range(len(VECTOR))] + [f"q{a}{b}" for a, b in _PAIRS]


def _sums(columns: list[str]) -> list[Column]:
    """Sums and sums of products of whole numbers, each row counted ``w`` times."""
    products = [F.sum((F.col(columns[a]) * F.col(columns[b])).cast("decimal(18,0)") * F.col("w").cast("decimal(18,0)")).alias(f"q{a}{b}") for a, b in _PAIRS]
    return [F.sum(F.col(c) * F.col("w")).alias(f"s{k}") for k, c in enumerate(columns)] + products


def reduced(rows: DataFrame) -> DataFrame:
    """group, the vector and w: distinct vectors with their numbers of rows."""
    return rows.groupBy("group", *VECTOR).agg(F.count(F.lit(1)).alias("w"))


def _with_estimate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    near = estimate.select(F.col("group").alias("e_group"), "start", *_CENTRE, *_INVERSE)
    return rows.join(near, F.col("group") == F.col("e_group")).drop("e_group")


def subset_starts(rows: DataFrame) -> DataFrame:
    """Estimates of ``SUBSETS`` subsets of each group, numbered behind the others; rows as of :func:`reduced`.

    A group's ``POOL`` vectors of the smallest hashes are what subsets are drawn from, each by hashes of its own, so reruns agree and a task
    that ranks a group holds a bounded number of rows. Groups of fewer than five vectors have none.
    """
    order = [F.xxhash64(F.lit("pool"), *VECTOR), *VECTOR]
    pool = rows.withColumn("place", F.row_number().over(Window.partitionBy("group").orderBy(*order))).where(F.col("place") <= POOL)
    drawn = pool.withColumn("start", F.explode(F.sequence(F.lit(4), F.lit(3 + SUBSETS))))
    order = [F.xxhash64("start", *VECTOR), *VECTOR]
    drawn = drawn.withColumn("place", F.row_number().over(Window.partitionBy("group", "start").orderBy(*order))).where(F.col("place") <= SUBSET).withColumn("w", F.lit(1).cast("bigint"))
    sums = drawn.groupBy("group", "start").agg(F.count(F.lit(1)).alias("n"), *_sums(list(VECTOR))).where(F.col("n") == SUBSET)
    return sums.withColumns({"rows": F.col("n"), "consistency": F.lit(1.0)}).mapInPandas(_estimates, _ESTIMATE)


def starts(rows: DataFrame) -> DataFrame:
    """Four first estimates of each group: 0, medians and the least scales; 1, means and covariances of all rows;
    2, medians and quartile ranges; 3, medians and the covariance of the directions from them. Only their order of distances counts.
    """
    scale = np.array(list(VECTOR.values())) * UNIT
    quartiles = [F.percentile(c, [0.25, 0.5, 0.75], F.col("w")).alias(f"r{k}") for k, c in enumerate(VECTOR)]
    known = staged(rows.groupBy("group").agg(F.sum("w").alias("rows"), *quartiles, *_sums(list(VECTOR))), "quality-starts")
    medians = known.select("group", "rows", F.lit(0.0).alias("logdet"), *[F.col(f"r{k}")[1].cast("double").alias(f"m{k}") for k in range(len(VECTOR))], *[f"r{k}" for k in range(len(VECTOR))])

    def diagonal(start: int, width) -> DataFrame:
        inverse = {f"p{a}{b}": F.pow(width(a), F.lit(-2.0)) if a == b else F.lit(0.0) for a, b in _PAIRS}
        return medians.withColumns({"start": F.lit(start), **inverse}).select("group", "start", "rows", "logdet", *_CENTRE, *_INVERSE)

    least = diagonal(0, lambda k: F.lit(float(scale[k])))
    ranged = diagonal(2, lambda k: F.greatest((F.col(f"r{k}")[2] - F.col(f"r{k}")[0]).cast("double"), F.lit(float(scale[k]))))
    classic = known.withColumns({"start": F.lit(1), "n": F.col("rows"), "consistency": F.lit(1.0)}).mapInPandas(_estimates, _ESTIMATE)
    # directions as whole numbers, in units that _estimates takes back
    away = [(F.col(c) - F.col(f"m{k}")) / float(scale[k]) for k, c in enumerate(VECTOR)]
    length = F.sqrt(sum((x * x for x in away), F.lit(0.0)))
    unit = [F.coalesce(F.round(x / F.nullif(length, F.lit(0.0)) * float(scale[k]) * 64), F.lit(0)).cast("bigint").alias(c) for k, (c, x) in enumerate(zip(VECTOR, away))]
    turned = _with_estimate(rows, least).select("group", "w", *unit).groupBy("group").agg(F.sum("w").alias("n"), *_sums(list(VECTOR)))
    turned = turned.withColumns({"start": F.lit(3), "rows": F.col("n"), "consistency": F.lit(1.0), **{f"s{k}": F.lit(0) for k in range(len(VECTOR))}}).mapInPandas(_estimates, _ESTIMATE)
    centres = medians.select(F.col("group").alias("c_group"), *[F.col(m).alias(f"c_{m}") for m in _CENTRE])
    turned = turned.join(centres, F.col("group") == F.col("c_group")).withColumns({m: F.col(f"c_{m}") for m in _CENTRE})
    return reduce(DataFrame.unionByName, [least, classic, ranged, turned.select("group", "start", "rows", "logdet", *_CENTRE, *_INVERSE)])


def _step(rows: DataFrame, estimate: DataFrame, last: bool) -> DataFrame:
    """The estimates from the nearest half of the rows of each group, or the last ones from all within REWEIGHT."""
    # log steps of a 32nd of an octave: a group has at most a few thousand
    step = F.floor(F.log2(1 + F.greatest(distance(), F.lit(0.0))) * 32).cast("int")
    steps = _with_estimate(rows, estimate).withColumn("step", F.when(distance() <= REWEIGHT, 0).otherwise(1) if last else step)
    steps = steps.groupBy("group", "start", "step").agg(F.sum("w").alias("n"), *_sums(list(VECTOR)))
    own = Window.partitionBy("group", "start")
    before = F.sum("n").over(own.orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
    steps = steps.withColumns({"before": F.coalesce(before, F.lit(0)), "rows": F.sum("n").over(own)})
    needed = F.floor(F.lit(SHARE) * (F.col("rows") + len(VECTOR) + 1)) - F.col("before")
    steps = steps.withColumn("take", F.when(F.col("step") == 0, F.col("n")).otherwise(0) if last else F.greatest(F.least("n", needed), F.lit(0)))
    # Whole numbers again after the share of the step is taken, so that the sums do not depend on order.
    part = {x: F.when(F.col("take") == F.col("n"), F.col(x).cast("decimal(30,0)")).otherwise(F.round(F.col(x).cast("double") * F.col("take") / F.col("n")).cast("decimal(30,0)")) for x in _SUMS}
    totals = steps.where("take > 0").withColumns(part).groupBy("group", "start").agg(F.max("rows").alias("rows"), F.sum("take").alias("n"), *[F.sum(x).alias(x) for x in _SUMS])
    return totals.withColumn("consistency", F.lit(REWEIGHT_CONSISTENCY if last else CONSISTENCY)).mapInPandas(_estimates, _ESTIMATE)


def concentrated(rows: DataFrame) -> DataFrame:
    """The estimate of the smallest determinant of each group; rows: group and the vector, as they are or :func:`reduced`."""
    rows = rows if "w" in rows.columns else reduced(rows)
    columns = ["rows", "logdet", *_CENTRE, *_INVERSE]
    begun = staged(starts(rows).unionByName(subset_starts(rows)), "quality-begun")
    twice = _step(rows, staged(_step(rows, begun, False), "quality-estimate"), False)
    # starts that have met go on once
    twice = twice.groupBy("group", *columns).agg(F.min("start").alias("start"))
    twice = twice.withColumn("place", F.row_number().over(Window.partitionBy("group").orderBy("logdet", "start"))).where(F.col("place") <= BEST)
    now, ended = staged(twice.select("group", "start", *columns), "quality-estimate"), []
    for _ in range(STEPS - 2):
        old = now.select(F.col("group").alias("o_group"), F.col("start").alias("o_start"), *[F.col(c).alias(f"o_{c}") for c in columns])
        both = _step(rows, now, False).join(old, (F.col("group") == F.col("o_group")) & (F.col("start") == F.col("o_start")))
        both = staged(both, "quality-estimate")
        falls = F.col("logdet") < F.col("o_logdet") - FALL
        ended.append(both.where(~falls).select("group", "start", *[F.col(f"o_{c}").alias(c) for c in columns]))
        now = both.where(falls).select("group", "start", *columns)
        if now.isEmpty():
            break
    every = reduce(DataFrame.unionByName, [now, *ended])
    best = every.groupBy("group").agg(F.min(F.struct("logdet", "start", *[c for c in columns if c != "logdet"])).alias("best"))
    return best.select("group", "best.*")


def fit(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Estimates and the groups' names from rows with counts, lang and source; both as written tables."""
    rows = with_groups(with_vector(rows).where(~base_failed()))
    names = staged(group_names(rows), "quality-names")
    rows = rows.join(names.withColumnRenamed("g_full", "n_full"), F.col("g_full") == F.col("n_full")).select("group", *VECTOR)
    rows = staged(reduced(rows), "quality-vectors")
    best = staged(concentrated(rows), "quality-best")
    return staged(_step(rows, best, True).drop("start", "logdet"), "quality-estimate"), names


def judged(counted: DataFrame, estimate: DataFrame, names: DataFrame) -> DataFrame:
    """``counted`` with base_failed, distance (null without an estimate) and kept.

    Estimates are one row a language and source, joined by their written size.
    """
    known = names.join(estimate, "group").withColumnRenamed("g_full", "k_full")
    rows = with_groups(with_vector(counted)).join(known, F.col("g_full") == F.col("k_full"), "left")
    rows = rows.withColumns({"base_failed": base_failed(), "distance": F.when(F.col("rows") >= LEAST, F.sqrt(F.greatest(distance(), F.lit(0.0))))})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF))


def quality(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, the counts, base_failed, distance, kept."""
    counted = with_counts(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source")).drop("text")
    counted = staged(counted, "quality-counts")
    return judged(counted, *fit(counted)).select("doc_id", *COUNTS, "base_failed", "distance", "kept")


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of documents.

    Texts are counted again where they stand and not joined by id.
    """
    docs = document_columns(docs)
    estimate, names = fit(staged(with_counts(docs.select("text", "lang", "source")).drop("text"), "quality-counts"))
    return judged(with_counts(docs), estimate, names).where("kept").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).select("doc_id", *COUNTS[:5], "base_failed", "kept", "distance")
