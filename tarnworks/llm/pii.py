"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Base rules find e-mail addresses, IP addresses, card and phone numbers. Looser
patterns find mentions: numbers of seven digits or more, and words around an "@".
A mention that overlaps a base match is a seed of that match's kind. Seeds induce
lexical patterns, the one or two words before a mention or the word after it, and
patterns and values are scored in rounds on their graph: a pattern by the share of
its distinct values that are known to be of a kind, a value by its best pattern.
Values at or above ``CONFIDENT`` join the seeds of the next round. In the end the
mentions of such values that no base match overlaps are spans as well.

Defined results: null and empty texts have no spans. Positions are code points,
the end exclusive. Failing base matches are dropped without another try. Repeated
rows get the same spans each. An empty table gives an empty result. Context does
not reach over another mention, nor further than ``REACH`` code points; a word cut there is left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.llm.text import SPACES, documents
from tarnworks.session import staged

QUERY = "op3_personal_data"

#: The kinds in order, with their patterns. Possessive quantifiers and the start conditions
#: leave the matches as they are and keep long runs of letters or digits from being tried from every place.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MENTIONS = {
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().-]{0,2}+[0-9])++(?![0-9A-Za-z])",
    "at": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D@]*+@[^\x20\x09-\x0D]*+",
}
#: A character without which a pattern cannot match.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "at": "@"}
ROUNDS = 3
CONFIDENT = 0.8
SUPPORT = 3
#: Code points of context on either side of a mention.
REACH = 80


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.lower(text), SPACES, " " * len(SPACES)), " "), lambda w: w != "")


def _near(gap: Column, start: bool) -> Column:
    """The whole words in the first or last REACH code points of a gap."""
    part = (F.left if start else F.right)(gap, F.lit(REACH + 1))
    return F.when(F.length(gap) <= REACH, gap).otherwise(F.regexp_replace(part, r"[^\x20\x09-\x0D]+$" if start else r"^[^\x20\x09-\x0D]+", ""))


def _hits(text: Column, pattern: str, context: bool) -> Column:
    """The matches in order, each with the number of code points between it and the one before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def hit(pair: Column) -> Column:
        fields = [pair["m"].alias("value"), F.length(pair["gap"]).alias("gap")]
        if context:
            before, after = _words(_near(pair["gap"], False)), _words(_near(pair["next"], True))
            fields += [F.slice(F.concat(F.array(F.lit(""), F.lit("")), before), -2, 2).alias("before"), F.coalesce(F.get(after, F.lit(0)), F.lit("")).alias("after")]
        return F.struct(*fields)

    following = F.slice(gaps, 2, F.size(found))
    zipped = F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("gap"), following.alias("next"))
    return F.transform(zipped, hit)


def scan(docs: DataFrame) -> DataFrame:
    """uid, doc_id and an array of hits for each kind and each sort of mention, in one pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("t"))
    digits = F.col("t").rlike("[0-9]")
    columns = {}
    for name, pattern in {**KINDS, **MENTIONS}.items():
        wanted = (F.lit(True) if name == "at" else digits) if name not in NEEDS else F.contains("t", F.lit(NEEDS[name])) & (digits if name in ("ip", "phone") else F.lit(True))
        columns[name] = F.when(wanted, _hits(F.col("t"), pattern, name in MENTIONS))
    return rows.select("uid", "doc_id", *[c.alias(n) for n, c in columns.items()])


def _placed(scanned: DataFrame, name: str) -> DataFrame:
    """The hits of one column as rows with start and end."""
    rows = scanned.where(F.size(name) > 0).select("uid", F.posexplode(name).alias("i", "hit")).select("uid", "i", "hit.*")
    upto = Window.partitionBy("uid").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value")).drop("gap", "i").withColumn("kind", F.lit(name))


def _number(digits: Column) -> Column:
    return F.coalesce(F.try_cast(digits, "int") if hasattr(F, "try_cast") else digits.try_cast("int"), F.lit(0))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds(kind: str) -> Column:
    """Whether a match passes the rule of its kind."""
    value = F.col("value")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, _number(p) <= 255).otherwise(F.lit(False)))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(scanned: DataFrame) -> DataFrame:
    """uid, kind, start, end of the base matches that hold."""
    return reduce(DataFrame.unionByName, [_placed(scanned, k).where(_holds(k)).select("uid", "kind", "start", "end") for k in KINDS])


def mentions(scanned: DataFrame, base: DataFrame) -> DataFrame:
    """uid, start, end, value, patterns, seed (the kind of a base match that overlaps, or null)."""
    both = reduce(DataFrame.unionByName, [_placed(scanned, m) for m in MENTIONS])
    digits = F.regexp_replace("value", "[^0-9]", "")
    both = both.where((F.col("kind") == "at") | (F.length(digits) >= 7))
    value = F.when(F.col("kind") == "at", F.lower("value")).otherwise(digits)
    patterns = F.array(*[F.concat_ws(" ", *parts) for parts in (
        (F.lit("before1"), F.col("kind"), F.get("before", F.lit(1))),
        (F.lit("before2"), F.col("kind"), F.get("before", F.lit(0)), F.get("before", F.lit(1))),
        (F.lit("after1"), F.col("kind"), F.col("after")),
    )])
    both = both.select("uid", "start", "end", F.concat(F.col("kind"), F.lit(" "), value).alias("value"), patterns.alias("patterns"), F.lit(None).cast("string").alias("base"))
    marks = base.select("uid", "start", "end", F.lit(None).cast("string").alias("value"), F.lit(None).cast("array<string>").alias("patterns"), F.col("kind").alias("base"))
    order = Window.partitionBy("uid").orderBy("start", "end", F.col("base").asc_nulls_last())
    is_base = F.col("base").isNotNull()
    reach = F.max(F.when(is_base, F.struct("end", "base"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(is_base, F.struct("start", "base"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = both.unionByName(marks).withColumns({"reach": reach, "ahead": ahead})
    seed = F.when(F.col("reach.end") > F.col("start"), F.col("reach.base")).when(F.col("ahead.start") < F.col("end"), F.col("ahead.base"))
    return rows.where(F.col("base").isNull()).select("uid", "start", "end", "value", "patterns", seed.alias("seed"))


def bootstrap(found: DataFrame) -> DataFrame:
    """value, kind, score: what the rounds on the graph of patterns and values hold to be of a kind."""
    edges = staged(found.select("value", F.explode("patterns").alias("pattern")).distinct(), "pii-edges")
    values = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("all_values"))
    values = staged(values.where(F.col("all_values") >= SUPPORT).withColumnRenamed("pattern", "v_pattern"), "pii-patterns")
    known = staged(found.where("seed IS NOT NULL").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct(), "pii-seeds")
    for _ in range(ROUNDS):
        sure = known.select(F.col("value").alias("k_value"), "kind", "score")
        scored = edges.join(sure, F.col("value") == F.col("k_value")).groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.count(F.lit(1)).alias("support"))
        scored = scored.where(F.col("support") >= SUPPORT).join(values, F.col("pattern") == F.col("v_pattern"))
        scored = scored.select(F.col("pattern").alias("s_pattern"), "kind", (F.col("sum") / (F.col("all_values") + 1)).alias("score")).where(F.col("score") >= CONFIDENT)
        new = edges.join(scored, F.col("pattern") == F.col("s_pattern")).groupBy("value", "kind").agg(F.max("score").alias("score"))
        known = staged(known.unionByName(new.join(known.select("value").distinct(), "value", "left_anti")), "pii-known")
    return known


def personal_data(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base matches), base_sha256, spans."""
    scanned = staged(scan(docs), "pii-scan")
    base = staged(base_spans(scanned), "pii-base")
    found = staged(mentions(scanned, base), "pii-mentions")
    known = bootstrap(found).groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind")).withColumnRenamed("value", "k_value")
    more = found.where("seed IS NULL").join(known, F.col("value") == F.col("k_value")).select("uid", "kind", "start", "end", F.lit(False).alias("base"))
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    every = base.withColumn("base", F.lit(True)).unionByName(more)
    span = F.struct("start", place.alias("place"), "end", "base", F.concat_ws(":", "kind", "start", "end").alias("said"))
    lists = every.groupBy("uid").agg(F.array_sort(F.collect_list(span)).alias("all"), *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS])
    lists = lists.withColumnRenamed("uid", "l_uid")
    rows = scanned.select("uid", "doc_id").join(lists, F.col("uid") == F.col("l_uid"), "left")
    spans = F.coalesce("all", F.array().cast(lists.schema["all"].dataType))
    joined = lambda s: F.array_join(F.transform(s, lambda x: x["said"]), ",")
    return rows.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.filter(spans, lambda x: x["base"])), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))
