"""Language-model scoring by subword lattices.

A text is a sequence of words and one end. Every word, behind its word mark, is a
lattice of the pieces of an existing vocabulary; a character without a piece goes
by its byte pieces. A language's model gives a weight to each piece, each byte and the end,
which sum to 1. The probability of a text in a language is the sum over all segmentations of the
products of their weights: no piece crosses words, so it is the product over words of
the sums over each word's segmentations, found by a forward recursion in log space,
times the end's weight. The probability of a text is the sum over languages of
the language's share times the text's probability in it (``score``). Beside it stands ``word_score``,
in which a word that was seen in training has its discounted relative frequency
in all training documents, and the discounted mass is shared by the lattices.

The weights start from the vocabulary's own scores. For each language they are
re-estimated by expected counts over the words of its training documents, each
as often as it occurs: first part by part of the words, since that takes fewer
sweeps, and at last on all of them. The vocabulary's scores stay beside the counts
as ``PRIOR`` pieces. Languages are the values of ``lang`` in the training documents;
beyond the most frequent ``languages - 1`` (a parameter), all others together are
one. A text's own ``lang`` is not looked at when it is scored.

The recursions run on all words of a batch at once, one place of the words after
the other, on flat arrays of arcs.

Words are counted in blocks of documents: up to 2 ** ``BLOCK_BITS`` rows in a row of a task. The
block is written beside the text, in buckets by block, so it is the same whenever the texts
are read again. A block gives a row for each distinct word; these are summed to lists of a
word's blocks, of bounded length, and to the corpus counts, and each block gets back the counts and
log probabilities of its own words only, while the texts stay where they lie. So no table that
grows with the corpus is broadcast or collected; piece counts (a number for each
piece and language) are all that the driver sees.

Defined results: null text is empty, and has its end as the only token; a null
doc_id counts as the empty text for the choice of training documents; null ``lang`` is a language. Repeated
rows count and are scored one by one. With no training document, the vocabulary's
own weights are the model. An empty table gives an empty result. A word is held whole, at
about 100 bytes a code point.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.llm.text import documents
from tarnworks.llm.vocabulary import PIECES, Vocabulary, read_pieces
from tarnworks.session import staged, staged_by

QUERY = "op2_lm_scoring"

BLOCK_BITS = 12
#: The blocks of 2 ** LISTED_BITS tasks go into one list of a word.
LISTED_BITS = 8
#: Words that a task holds, by block and language, before it hands them on.
HELD = 1_000_000
#: Weights are re-estimated on each of PARTS parts of the words in turn, SWEEPS times over, and at last on all words.
SWEEPS = 2
PARTS = 4
#: Weight of the vocabulary's own scores beside the expected counts, in pieces.
PRIOR = 1000.0
#: Code points of words whose lattices are held at once.
POINTS = 60_000
#: The end's part of the first weights.
END = 0.01

#: Places of the byte pieces and the end behind the pieces in a list of weights.
BYTES, TAIL = 256, 257


class Lattice:
    """The pieces that can lie in a word, and what is found from a word's lattice under lists of natural log weights."""

    def __init__(self, vocabulary: Vocabulary):
        # the word mark stands at a word's start alone
        scores = {t: vocabulary.scores[i] for t, i in vocabulary.ids.items() if " " not in t[1:]}
        self.pieces = {t: k for k, t in enumerate(scores)}
        self.size = len(self.pieces) + TAIL
        prior = np.exp([*scores.values(), *[vocabulary.byte_score] * BYTES])
        self.prior = np.append((1 - END) * prior / prior.sum(), END)
        # every prefix of a piece is a node; a node and a character lead to the next by a hash table with open addresses
        nodes = {"": 0}
        for text in self.pieces:
            for k in range(1, len(text) + 1):
                nodes.setdefault(text[:k], len(nodes))
        self.bits = (4 * len(nodes)).bit_length()
        self.keys, self.child, self.piece = np.full((3, 1 << self.bits), -1)
        texts = [t for t in nodes if t]
        keys = np.array([nodes[t[:-1]] << 21 | ord(t[-1]) for t in texts])
        for text, key, at in zip(texts, keys, self._first(keys).tolist()):
            while self.keys[at] >= 0:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.child[at], self.piece[at] = key, nodes[text], self.pieces.get(text, -1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        """Where the search for each key begins."""
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each key in the table, and whether it is there."""
        place = self._first(keys)
        there = self.keys[place]
        other = np.flatnonzero((there != keys) & (there >= 0))
        while len(other):
            place[other] = (place[other] + 1) % len(self.keys)
            there[other] = self.keys[place[other]]
            other = other[(there[other] != keys[other]) & (there[other] >= 0)]
        return place, there == keys

    def weights(self, counts: np.ndarray | None = None) -> list[float]:
        """Logs of expected counts plus ``PRIOR`` times the weights from the vocabulary's scores."""
        seen = np.zeros(self.size) if counts is None else counts
        return np.log((seen + PRIOR * self.prior) / (seen.sum() + PRIOR)).tolist()

    def marginals(self, word: str, models: list[list[float]]) -> list[float]:
        """Log probability of the text of one word under each list of weights."""
        arcs = Arcs(self, [word])
        return [float(arcs.forward(np.array(w))[0][0]) + w[-1] for w in models]

    def expect(self, word: str, weights: list[float], counts: np.ndarray) -> None:
        """Add the expected count of each piece in the segmentations of the text of one word, and of its end."""
        arcs = Arcs(self, [word])
        counts += arcs.expected(arcs.forward(np.array(weights))[1], np.ones(1))
        counts[-1] += 1.0


class Arcs:
    """The lattices of words: arcs from a node to a later one of the same word, by the place in the word where they end."""

    def __init__(self, lattice: Lattice, words: list[str]):
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        codes = np.frombuffer("".join([" " + w for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum(lengths)
        number = np.repeat(np.arange(len(words)), lengths)
        until, alone = ends[number], np.zeros(len(codes), bool)
        starts, sizes, pieces = [], [], []
        at, node, k = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0
        while len(at):
            place, hit = lattice.find(node << 21 | codes[at + k])
            at, place = at[hit], place[hit]
            there = lattice.piece[place] >= 0
            starts.append(at[there])
            sizes.append(np.full(len(starts[-1]), k + 1))
            pieces.append(lattice.piece[place[there]])
            if k == 0:
                alone[starts[-1]] = True
            k += 1
            inside = at + k < until[at]
            at, node = at[inside], lattice.child[place[inside]]
        # characters that are no piece are spelled: pieces beyond the list of weights, each a list of bytes
        spelled = np.flatnonzero(~alone)
        kinds, kind = np.unique(codes[spelled], return_inverse=True)
        self.spelled = [np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64) + len(lattice.pieces) for c in kinds]
        starts, sizes = np.concatenate([*starts, spelled]), np.concatenate([*sizes, np.ones(len(spelled), np.int64)])
        pieces, word = np.concatenate([*pieces, lattice.size + kind]), number[starts]
        ending = starts + sizes - (ends - lengths)[word]
        order = _by(ending, _by(word, np.arange(len(word))))
        ending, word = ending[order], word[order]
        # a word has a node more than it has characters
        self.tail, self.piece, self.size = starts[order] + word, pieces[order], lattice.size
        first = np.flatnonzero(np.diff(ending, prepend=-1) | np.diff(word, prepend=-1))
        self.head, self.runs = (self.tail + sizes[order])[first], np.diff(first, append=len(order))
        self.open, self.last, self.nodes = ends - lengths + np.arange(len(words)), ends + np.arange(len(words)), len(codes) + len(words)
        places = np.arange(1, (lengths.max() if len(words) else 0) + 2)
        arcs, heads = np.searchsorted(ending, places), np.searchsorted(ending[first], places)
        #: For each place of words: its arcs a to b, and the heads s to t that they lead to, each with its first arc after a.
        self.levels = [(a, b, s, t, first[s:t] - a) for a, b, s, t in zip(arcs, arcs[1:], heads, heads[1:])]

    def forward(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log of the sum over all segmentations of each word, and each arc's share of the sum at the node it leads to."""
        weights = np.append(weights, [weights[b].sum() for b in self.spelled])[self.piece]
        score, share = np.zeros(self.nodes), np.empty(len(self.piece))
        for a, b, s, t, first in self.levels:
            new, runs = score[self.tail[a:b]] + weights[a:b], self.runs[s:t]
            top = np.maximum.reduceat(new, first)
            new = np.exp(new - np.repeat(top, runs))
            total = np.add.reduceat(new, first)
            score[self.head[s:t]] = top + np.log(total)
            share[a:b] = new / np.repeat(total, runs)
        return score[self.last], share

    def expected(self, share: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected counts of pieces when each word occurs so many times: what reaches a node is shared among the arcs that lead there."""
        flow, through = np.zeros(self.nodes), np.empty(len(share))
        flow[self.last] = times
        for a, b, s, t, _ in reversed(self.levels):
            part = through[a:b] = share[a:b] * np.repeat(flow[self.head[s:t]], self.runs[s:t])
            flow[self.tail[a:b]] += part  # of a word, one arc at most joins two places
        counts = np.bincount(self.piece, through, minlength=self.size + len(self.spelled))
        for k, spelling in enumerate(self.spelled):
            np.add.at(counts, spelling, counts[self.size + k])
        return counts[: self.size]


def _by(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The order, sorted by values and otherwise kept; numbers of 16 bits are sorted in linear time."""
    short = len(values) == 0 or values.max() < 1 << 16
    return order[np.argsort(values[order].astype(np.uint16) if short else values[order], kind="stable")]


def _portions(words: list[str]) -> Iterator[slice]:
    """Slices of the words of about ``POINTS`` code points."""
    start = held = 0
    for k, word in enumerate(words):
        held += len(word)
        if held >= POINTS or k + 1 == len(words):
            yield slice(start, k + 1)
            start, held = k + 1, 0


def in_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang, held_out, block; written, so that the blocks stay as they are."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "lang", (F.crc32(key) % 7 == 2).alias("held_out"))
    return staged_by(rows.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)), "block", "lm-texts")


def language_places(training: DataFrame, most: int) -> tuple[Column, list[int]]:
    """The place of a row's language among those of the model, and the training documents of each."""
    found = training.groupBy("lang").count().orderBy(F.desc("count"), F.asc_nulls_last("lang")).limit(most - 1).collect()
    named = [r["lang"] for r in found]
    place = F.lit(len(named))
    for k, lang in enumerate(named):
        place = F.when(F.col("lang").eqNullSafe(F.lit(lang)), k).otherwise(place)
    documents_of = [r["count"] for r in found]
    others = training.count() - sum(documents_of)
    return place.cast("int"), documents_of + [others] * (others > 0) or [0]


def _counts(languages: int) -> list[str]:
    return [f"c{k}" for k in range(languages)]


def block_words(rows: DataFrame, languages: int) -> DataFrame:
    """block, word, c0, c1, ...: the distinct words of a block in UTF-8, with counts in training documents by language.

    A word comes once for each task that reads a part of the block, and once more
    whenever a task has ``HELD`` words and hands them on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[set, list[Counter]]] = {}
        for batch in batches:
            for block, text, held_out, place in zip(*batch.columns):
                other, known = found.setdefault(block.as_py(), (set(), [Counter() for _ in range(languages)]))
                (other if held_out.as_py() else known[place.as_py()]).update(text.as_py().lower().split())
            if sum(len(other) + sum(map(len, known)) for other, known in found.values()) >= HELD:
                yield from handed_on(found)
        yield from handed_on(found)

    def handed_on(found: dict) -> Iterator[pa.RecordBatch]:
        while found:
            block, (other, known) = found.popitem()
            words = list(other.union(*known))
            for start in range(0, len(words), 100_000):
                part = words[start : start + 100_000]
                counts = [pa.array(np.fromiter((c.get(w, 0) for w in part), np.int64, len(part))) for c in known]
                blocks = pa.array(np.full(len(part), block, np.int64))
                yield pa.RecordBatch.from_arrays([blocks, pa.array(part, pa.binary()), *counts], names=["block", "word", *_counts(languages)])

    schema = "block bigint, word binary, " + ", ".join(f"{c} bigint" for c in _counts(languages))
    return rows.select("block", F.col("text").cast("binary").alias("text"), "held_out", "place").mapInArrow(count, schema)


def _text_of(words: pa.Array) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in words.to_pylist()]


def expected_counts(words: DataFrame, lattice: Lattice, models: list[list[float]]) -> list[np.ndarray]:
    """Expected counts of pieces over the training words of each language, each word as often as it occurs."""
    names = _counts(len(models))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(models), lattice.size))
        for batch in batches:
            every = np.array(_text_of(batch.column(0)), object)
            for k, model in enumerate(models):
                times = batch.column(1 + k).to_numpy()
                held, times = every[times > 0].tolist(), times[times > 0].astype(float)
                for part in _portions(held):
                    arcs = Arcs(lattice, held[part])
                    counts[k] += arcs.expected(arcs.forward(np.array(model))[1], times[part])
        model, piece = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(model), pa.array(piece), pa.array(counts[model, piece])], names=["model", "piece", "n"])

    sums = words.select("word", *names).mapInArrow(expect, "model bigint, piece bigint, n double").groupBy("model", "piece").agg(F.sum("n").alias("n"))
    out = [np.zeros(lattice.size) for _ in models]
    for r in sums.collect():  # a row for each piece and language at most
        out[r.model][r.piece] = r.n
    return out


def fit(seen: DataFrame, lattice: Lattice, ends: list[int]) -> list[list[float]]:
    """Log weights for each language, from the training words (word, c0, c1, ...) and the training documents of each.

    A word weighs in its part as in all words, so the ends do too.
    """
    models = [lattice.weights() for _ in ends]
    part = F.pmod(F.xxhash64("word"), F.lit(PARTS))
    for step in range(SWEEPS * PARTS + 1 if sum(ends) else 0):
        partial = step < SWEEPS * PARTS
        counts = expected_counts(seen.where(part == step % PARTS) if partial else seen, lattice, models)
        for count, n in zip(counts, ends):
            count[-1] = n / PARTS if partial else n
        models = [lattice.weights(c) for c in counts]
    return models


def lm_scores(docs: DataFrame, vocabulary_path: str = PIECES, languages: int = 12) -> DataFrame:
    """A row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, word_score."""
    lattice = Lattice(read_pieces(vocabulary_path))
    rows = in_blocks(docs)
    place, ends = language_places(rows.where(~F.col("held_out")), languages)
    n_ends, names = sum(ends), _counts(len(ends))
    in_block = block_words(rows.withColumn("place", place), len(ends))
    sums = [F.sum(c).alias(c) for c in names]
    # a list holds the blocks of so many tasks at most; a common word has several lists
    tasks = F.shiftright("block", 33 - BLOCK_BITS + LISTED_BITS).alias("tasks")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = in_block.repartition(partitions, "word").groupBy("word", tasks).agg(*sums, F.collect_list("block").alias("blocks"))
    lists = staged_by(lists, "word", "lm-lists")
    words = staged(lists.groupBy("word").agg(*sums), "lm-words")
    count = sum((F.col(c) for c in names), F.lit(0))
    n_all, n_distinct, ones, twos = words.agg(F.sum(count), F.count_if(count > 0), F.count_if(count == 1), F.count_if(count == 2)).first()
    n_all, n_distinct = (n_all or 0) + n_ends, (n_distinct or 0) + (n_ends > 0)
    base_all = n_all + n_distinct + 1
    discount = ones / (ones + 2 * twos) if ones and twos else 0.5
    spread = math.log10(discount * n_distinct / n_all) if n_all else 0.0
    models = fit(words.where(count > 0), lattice, ends)
    logs_of = [f"p{k}" for k in range(len(ends))]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = sum(c.to_numpy() for c in batch.columns[1:])
            texts, logs = _text_of(batch.column(0)), np.empty((len(models), batch.num_rows), np.float32)
            for part in _portions(texts):
                arcs = Arcs(lattice, texts[part])
                for k, model in enumerate(models):
                    logs[k, part] = arcs.forward(np.array(model))[0] / math.log(10)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), *map(pa.array, logs)], names=["word", "count", *logs_of])

    schema = "word binary, count bigint, " + ", ".join(f"{p} float" for p in logs_of)
    weighed = words.select("word", *names).mapInArrow(weigh, schema)
    back = lists.select("word", "blocks").join(weighed, "word").select(F.explode("blocks").alias("w_block"), "word", "count", *logs_of)
    prior, end = np.log10((np.array(ends) + 1) / (n_ends + len(ends))), np.array([m[-1] for m in models]) / math.log(10)

    def with_frequency(counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """Log probabilities of tokens by their discounted frequency and, for the discounted mass, their lattices."""
        with np.errstate(divide="ignore"):
            often = np.log(np.maximum(counts - discount, 0.0) / max(n_all, 1))
        return np.logaddexp(often, (spread + logs) * math.log(10)) / math.log(10)

    def mixed(by_language: np.ndarray) -> float:
        top = by_language.max()
        return float(top + np.log10((10.0 ** (by_language - top)).sum()))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        at_word = {w: k for k, w in enumerate(right.column("word").to_pylist())}
        counts = right.column("count").to_numpy()
        logs = np.array([right.column(p).to_numpy() for p in logs_of], float).reshape(len(logs_of), -1)
        base, worded, ended = np.log10((counts + 1) / base_all), with_frequency(counts, logs), with_frequency(np.array(n_ends), end)
        out = []
        for text in left.column("text"):
            tokens = text.as_py().lower().split()
            at = np.fromiter(map(at_word.__getitem__, tokens), np.int64, len(tokens))
            scores = mixed(prior + end + logs[:, at].sum(axis=1)), mixed(prior + ended + worded[:, at].sum(axis=1))
            out.append((len(tokens) + 1, int((counts[at] > 0).sum()) + (n_ends > 0), float(base[at].sum()) + math.log10((n_ends + 1) / base_all), *scores))
        columns = [np.array(c) for c in zip(*out)]
        whole = [pa.array(c.astype(np.int64)) for c in (*columns[:2], np.full(len(out), n_all))]
        return pa.table([left.column("doc_id"), left.column("held_out"), *whole, *map(pa.array, columns[2:])], _SCORES)

    # a block without a word has no rows on the right, and its tokens are ends alone
    none = pa.table([pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], pa.int64()), *[pa.array([], pa.float32())] * len(ends)], ["w_block", "word", "count", *logs_of])
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, word_score double"
    rows = rows.select("block", "doc_id", F.col("text").cast("binary").alias("text"), "held_out")
    return rows.groupBy("block").cogroup(back.groupBy("w_block")).applyInArrow(lambda a, b: score(a, b if b.num_rows else none), schema)


_SCORES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "word_score"]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))
