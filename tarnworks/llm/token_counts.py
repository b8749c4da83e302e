"""Edit-aware token counts: segment trees over the pre-tokens of a text.

A byte-level BPE tokenizer splits a text into pre-tokens and encodes each alone,
so a text's token count is the sum over its pre-tokens. :func:`trees` groups
``LEAF`` pre-tokens to a leaf and keeps, for each version of a text, the code points of the
leaves and a binary tree of token sums over them. :func:`apply_edits` splits anew
from the start of the leaf before an edit, until a boundary of an old leaf after
the edit comes up again; what lies outside keeps its counts. If the number of
leaves stays the same only the sums on the paths to the touched leaves change,
else the tree is rebuilt from leaf counts, still without encoding any other text.

A pre-token depends on no more than its own characters and the one after, so a
split that meets an old boundary goes on as before; and no pre-token that ends
before the leaf in front of the edit can change.

Defined results: null text counts as empty and has no token. A version is a doc_id
with a text, so repeated rows share theirs. An edit deletes ``removed`` code points
at ``start`` and puts ``added`` there; places beyond the text mean its end, nulls
mean 0 and nothing. Edits of one document are one row each and apply to the same
version. Empty tables give empty results.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.llm.text import documents
from tarnworks.llm.vocabulary import RANKS
from tarnworks.session import staged

QUERY = "op7_token_counts"

LEAF = 64
#: Fixed value: how the byte-level vocabulary splits texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens kept with their counts in a worker, twice: the newest, and those before them.
KEPT = 400_000


class Tokens(dict):
    """Token counts of pre-tokens, each counted once while it is kept."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex
        import tiktoken

        self.split = regex.compile(PATTERN)
        self.coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.older: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        n = self.older.get(piece) or len(self.coder.encode_ordinary(piece))
        if len(piece) <= 64:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[piece] = n
        return n

    def leaves(self, text: str) -> tuple[list[int], list[int]]:
        """Code points and tokens of the leaves of a text."""
        pieces = self.split.findall(text)
        counts = list(map(self.__getitem__, pieces))
        starts = range(0, len(pieces), LEAF)
        return [sum(map(len, pieces[k : k + LEAF])) for k in starts], [sum(counts[k : k + LEAF]) for k in starts]


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


#: Counters of this process by the path of their vocabulary: a worker keeps its pre-tokens from task to task.
_TOKENS: dict[str, Tokens] = {}


def tokens_of(path: str, ranks: dict[bytes, int]) -> Tokens:
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(ranks)
    return _TOKENS[path]


def tree_of(tokens: list[int]) -> list[int]:
    """Sums over leaves as a heap: node k has children 2k + 1 and 2k + 2; leaves come last, filled up with 0."""
    width = 1
    while width < len(tokens):
        width *= 2
    level = np.zeros(width, np.int64)
    level[: len(tokens)] = tokens
    levels = [level]
    while len(level) > 1:
        level = level.reshape(-1, 2).sum(axis=1)
        levels.append(level)
    return np.concatenate(levels[::-1]).tolist()


def set_leaf(tree: list[int], leaf: int, tokens: int) -> None:
    """Put a leaf's count and add the difference on its path to the root."""
    k = (len(tree) + 1) // 2 - 1 + leaf
    change = tokens - tree[k]
    while True:
        tree[k] += change
        if k == 0:
            return
        k = (k - 1) // 2


def edited(tokens: Tokens, text: str, points: list[int], tree: list[int], start: int, removed: int, added: str) -> tuple[list[int], list[int], int]:
    """Leaf sizes and tree after an edit, and the code points that were encoded again."""
    start = min(max(start, 0), len(text))
    end = min(start + max(removed, 0), len(text))
    if start == end and not added:
        return points, tree, 0
    first, at = 0, 0  # the leaf before the one that holds the start
    while first < len(points) and at + points[first] <= start:
        at += points[first]
        first += 1
    if first:
        first -= 1
        at -= points[first]
    shift = len(added) - (end - start)
    bounds, place = {}, at  # new places of old leaf boundaries after the edit
    for k in range(first, len(points)):
        if place >= end:
            bounds[place + shift] = k
        place += points[k]
    changed = text[:start] + added + text[end:]
    sizes, counts, inside, here, last = [], [], 0, at, len(points)
    for m in tokens.split.finditer(changed, at):
        if here >= start + len(added) and here in bounds:
            last = bounds[here]
            break
        if inside % LEAF == 0:
            sizes.append(0)
            counts.append(0)
        sizes[-1] += m.end() - m.start()
        counts[-1] += tokens[m.group()]
        inside, here = inside + 1, m.end()
    return _spliced(points, tree, first, last, sizes, counts, here - at)


def _spliced(points, tree, first, last, sizes, counts, again):
    """Put new leaves in place of the old ones from first to last."""
    new = points[:first] + sizes + points[last:]
    if len(sizes) == last - first:
        tree = list(tree)
        for k, n in enumerate(counts):
            set_leaf(tree, first + k, n)
        return new, tree, again
    base = (len(tree) + 1) // 2 - 1
    old = tree[base : base + len(points)]
    return new, tree_of(old[:first] + counts + old[last:]), again


def _versions(docs: DataFrame) -> DataFrame:
    """doc_id, text, version."""
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("version"))


def trees(docs: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """doc_id, version, n_tokens, points and tree for each version of a text."""
    ranks = read_ranks(ranks_path)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(ranks_path, ranks)
        for batch in batches:
            points, sums = [], []
            for text in batch.column(1):
                sizes, counts = tokens.leaves(text.as_py())
                points.append(sizes)
                sums.append(tree_of(counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([t[0] for t in sums], pa.int64()), pa.array(points, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.int32()))],
                names=["doc_id", "version", "n_tokens", "points", "tree"],
            )

    return _versions(docs).mapInArrow(build, "doc_id bigint, version bigint, n_tokens bigint, points array<int>, tree array<int>")


def apply_edits(docs: DataFrame, kept: DataFrame, edits: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """A row for each row of ``docs`` and edit of its version: doc_id, n_tokens, n_edited (tokens after it), n_points (encoded again), points, tree.

    kept: from :func:`trees`; edits: doc_id, version, start, removed, added.
    """
    ranks = read_ranks(ranks_path)
    kept = kept.dropDuplicates(["doc_id", "version"]).select(F.col("doc_id").alias("t_id"), F.col("version").alias("t_version"), "n_tokens", "points", "tree")
    both = edits.join(kept, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("version") == F.col("t_version")))
    both = both.select(F.col("doc_id").alias("e_id"), F.col("version").alias("e_version"), "start", "removed", "added", "n_tokens", "points", "tree")
    rows = _versions(docs).join(both, F.col("doc_id").eqNullSafe(F.col("e_id")) & (F.col("version") == F.col("e_version")))

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(ranks_path, ranks)
        for batch in batches:
            out = []
            for _, text, start, removed, added, _, points, tree in zip(*batch.columns):
                out.append(edited(tokens, text.as_py(), points.as_py(), tree.as_py(), start.as_py() or 0, removed.as_py() or 0, added.as_py() or ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(5), pa.array([t[0] for _, t, _ in out], pa.int64()), pa.array([n for *_, n in out], pa.int64()), pa.array([p for p, *_ in out], pa.list_(pa.int32())), pa.array([t for _, t, _ in out], pa.list_(pa.int32()))],
                names=["doc_id", "n_tokens", "n_edited", "n_points", "points", "tree"],
            )

    rows = rows.select("doc_id", "text", "start", "removed", "added", "n_tokens", "points", "tree")
    return rows.mapInArrow(change, "doc_id bigint, n_tokens bigint, n_edited bigint, n_points bigint, points array<int>, tree array<int>")


def sample_edits(docs: DataFrame) -> DataFrame:
    """An edit of every document, at a place that depends on its id: twelve code points give way to a note."""
    rows = _versions(docs)
    start = F.pmod(F.xxhash64("version"), (F.length("text") + 1).cast("bigint"))
    return rows.select("doc_id", "version", start.alias("start"), F.lit(12).cast("bigint").alias("removed"), F.concat(F.lit(" [rev "), F.pmod("version", F.lit(1000)).cast("string"), F.lit("] ")).alias("added")).distinct()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    kept = staged(trees(docs), "token-trees")
    return apply_edits(docs, kept, sample_edits(docs)).select("doc_id", "n_tokens", "n_edited", "n_points", F.size("points").cast("bigint").alias("n_leaves"))
