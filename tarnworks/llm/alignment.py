"""Aligning the tokens of two tokenizers, and how often their ids go together, by a cogroup of postings.

A text is encoded by A (byte-level, ids of a JSON vocabulary) and B (pieces with byte
fallback). Where tokens of both end at the same byte, a group of tokens ends, and its last
A token and last B token are linked. How good a link is shows only in the whole corpus: the
count of its pair of ids, and whether no other A id is linked more often with its B id.

* Tasks encode and align whole documents, in blocks of at most ``BLOCK_DOCS`` documents or
  ``BLOCK_TOKENS`` tokens. A block hands on one list of postings for each B id: its A ids, their links, and
  the documents with the number of links in each.
* The counts of pairs are summed from the lists' own sums, so documents take no part.
* Counts and lists are dealt by B id and sorted, counts first. A task reads this stream once:
  it holds the counts of one B id (at most A's vocabulary), finds their maximum, and turns each list to
  sums by document, of which it hands on one row for each block. A B id with more than a task's share of the links has its lists dealt over
  several tasks by their blocks, each with the counts of the id.
* The sums are added up by document, block by block.

Vocabularies have a fixed size and are read from files of public tokenizers, whose paths are parameters.

Defined results: null and empty texts, and texts that the tokens of A or B don't spell
exactly (such as those with U+2581, which B takes for a space), have no tokens: zeros and an empty digest. A
doc_id may be null or stand on several rows: each row is a document of its own. Only doc_id
and text are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.llm.text import documents
from tarnworks.llm.vocabulary import FOLDER, PIECES
from tarnworks.session import staged

QUERY = "op13_tokenizer_alignment"

BYTE_LEVEL = f"{FOLDER}/byte_bpe_50k.json"

#: Fixed value: the pattern by which byte-level vocabularies of this kind split a text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BLOCK_DOCS = 1024
BLOCK_TOKENS = 1 << 20
#: Documents have numbers of their own: task, then place in the task.
TASK_BITS = 40

DOC = {"row": "bigint", "doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string"}
LIST = {"b": "int", "block": "bigint", "a": "array<int>", "links": "array<bigint>", "held": "array<int>", "at": "array<int>", "times": "array<int>"}


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes stand for themselves, the others for characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Side:
    """One tokenizer: bytes and their number by id, and texts that a group's string is put together from."""

    def __init__(self, encode, texts: list[bytes]):
        self.encode, self.texts = encode, texts
        self.sizes = np.array([len(t) for t in texts], np.int64)

    def spells(self, ids: list[int], data: bytes) -> bool:
        return b"".join(map(self.texts.__getitem__, ids)) == data


@lru_cache(maxsize=2)
def byte_level(path: str = BYTE_LEVEL) -> Side:
    """The vocabulary of a JSON file. Its ids rise with the order of its merges, so they serve as ranks; special tokens are left out."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    alphabet, special = byte_alphabet(), {t["content"] for t in content["added_tokens"]}
    ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in content["model"]["vocab"].items() if t not in special}
    texts = [b""] * (max(ranks.values()) + 1)
    for text, i in ranks.items():
        texts[i] = text
    return Side(tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, texts)


@lru_cache(maxsize=2)
def pieces(path: str = PIECES) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    texts = [bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(names)]
    return Side(model.encode, texts)


class Aligner:
    """Encodes and aligns texts."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = byte_level(a_path), pieces(b_path)
        n_a, n_b = len(self.a.texts), len(self.b.texts)
        # what an id adds to the string of groups: A ids with a comma, or a bar at the end; B ids with a comma, or a semicolon
        self.marks = [f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)]
        self.shifts = (0, n_a, 2 * n_a, 2 * n_a + n_b)

    def __call__(self, text: str | None):
        """ids of A and B and the places in both at which groups end; None where there are no tokens."""
        if not text:
            return None
        data = b" " + text.encode("utf-8", "surrogatepass")
        a, b = self.a.encode(f" {text}"), self.b.encode(text)
        if not (a and b and self.a.spells(a, data) and self.b.spells(b, data)):
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        _, in_a, in_b = np.intersect1d(np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b]), assume_unique=True, return_indices=True)
        return a, b, in_a, in_b

    def digest(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> str:
        """Of the groups written as a1,a2|b1;a3|b2,b3: each id takes its place behind all of the groups before and, for B, its group's A ids."""
        codes = np.empty(len(a) + len(b), np.int64)
        sizes_a, sizes_b = np.diff(in_a, prepend=-1), np.diff(in_b, prepend=-1)
        a_codes, b_codes = a + self.shifts[0], b + self.shifts[2]
        a_codes[in_a] += self.shifts[1]
        b_codes[in_b] += self.shifts[3] - self.shifts[2]
        codes[np.arange(len(a)) + np.repeat(in_b + 1 - sizes_b, sizes_a)] = a_codes
        codes[np.arange(len(b)) + np.repeat(in_a + 1, sizes_b)] = b_codes
        return hashlib.sha256("".join(map(self.marks.__getitem__, codes.tolist()))[:-1].encode()).hexdigest()


def aligned(docs: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES) -> DataFrame:
    """Rows of documents (DOC) and of posting lists (LIST); b is null in the first, row in the second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, row, first = Aligner(a_path, b_path), TaskContext.get().partitionId() << TASK_BITS, None
        done, links, tokens = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                first = row if first is None else first
                found = align(text.as_py())
                if found is None:
                    done.append((row, doc_id, 0, 0, 0, 0, ""))
                else:
                    a, b, in_a, in_b = found
                    done.append((row, doc_id, len(a), len(b), len(in_a), len(in_a), align.digest(*found)))
                    pairs, times = np.unique((b[in_b] << 32) | a[in_a], return_counts=True)
                    links.append((pairs, np.full(len(pairs), row - first), times))
                    tokens += len(a) + len(b)
                row += 1
                if len(done) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                    yield from block(done, links, first)
                    done, links, tokens, first = [], [], 0, None
        yield from block(done, links, first)

    def block(done: list[tuple], links: list[tuple], first: int) -> Iterator[pa.RecordBatch]:
        if done:
            yield _record(done, _posted(links, first))

    schema = ", ".join(f"{c} {t}" for c, t in (DOC | LIST).items())
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _posted(links: list[tuple], first: int) -> list[pa.Array]:
    """The columns of LIST, a row for each B id, from (pairs, document, times) of documents."""
    pairs, at, times = (np.concatenate(x) for x in zip(*links)) if links else (np.empty(0, np.int64),) * 3
    order = np.argsort(pairs, kind="stable")
    pairs, at, times = pairs[order], at[order], times[order]
    starts = np.flatnonzero(np.diff(pairs, prepend=-1))
    distinct = pairs[starts]
    b_starts = np.flatnonzero(np.diff(distinct >> 32, prepend=-1))
    by_pair, by_posting = np.append(b_starts, len(distinct)), np.append(starts, len(pairs))[np.append(b_starts, len(starts))]

    def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values).cast(kind))

    sums = np.add.reduceat(times, starts) if len(starts) else times
    return [
        pa.array(distinct[b_starts] >> 32).cast(pa.int32()), pa.array(np.full(len(b_starts), first or 0), pa.int64()), lists(distinct & 0xFFFFFFFF, by_pair, pa.int32()), lists(sums, by_pair, pa.int64()),
        lists(np.diff(np.append(starts, len(pairs))), by_pair, pa.int32()), lists(at, by_posting, pa.int32()), lists(times, by_posting, pa.int32()),
    ]


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}


def _record(done: list[tuple], posted: list[pa.Array]) -> pa.RecordBatch:
    """Documents, then lists."""
    own = [pa.array(x, _ARROW[t]) for x, t in zip(zip(*done), DOC.values())]
    above = [pa.concat_arrays([x, pa.nulls(len(posted[0]), x.type)]) for x in own]
    below = [pa.concat_arrays([pa.nulls(len(done), _ARROW[t]), x.cast(_ARROW[t])]) for x, t in zip(posted, LIST.values())]
    return pa.RecordBatch.from_arrays([*above, *below], names=[*DOC, *LIST])


def link_sums(lists: DataFrame) -> DataFrame:
    """row, n_best, count_sum of each document with links; lists: rows of LIST."""
    each = lists.select("b", F.explode(F.arrays_zip("a", "links")).alias("x"))
    counts = staged(each.groupBy("b", "x.a").agg(F.sum("x.links").alias("links")), "align-counts")
    # How many tasks share an id: one row for each B id at most, a vocabulary's size.
    tasks = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("links")).first()[0] or 1
    shared = counts.groupBy(F.col("b").alias("w_b")).agg((F.sum("links") * tasks / F.lit(total) + 1).cast("int").alias("parts")).where("parts > 1")
    shared = F.broadcast(staged(shared, "align-shared"))
    none = lambda c: F.lit(None).cast(LIST[c]).alias(c)
    part = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    known = counts.join(shared, F.col("b") == F.col("w_b"), "left").select("b", part, F.lit(0).alias("kind"), none("block"), F.array("a").alias("a"), F.array("links").alias("links"), none("held"), none("at"), none("times"))
    part = F.pmod(F.hash("block"), F.coalesce("parts", F.lit(1))).alias("part")
    posted = lists.join(shared, F.col("b") == F.col("w_b"), "left").select("b", part, F.lit(1).alias("kind"), "block", "a", none("links"), "held", "at", "times")
    dealt = known.unionByName(posted).repartition("b", "part").sortWithinPartitions("b", "part", "kind")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count, most = None, {}, 0
        for batch in batches:
            found = defaultdict(list)
            b, part, kind, block = (batch.column(k).to_pylist() for k in range(4))
            a, links, held, at, times = (batch.column(k) for k in range(4, 9))
            for k in range(batch.num_rows):
                if (b[k], part[k]) != now:
                    now, count, most = (b[k], part[k]), {}, 0
                if not kind[k]:
                    count[a[k].values[0].as_py()] = n = links[k].values[0].as_py()
                    most = max(most, n)
                    continue
                own = np.fromiter(map(count.__getitem__, a[k].values.to_pylist()), np.int64, len(a[k]))
                often, n = np.repeat(own, held[k].values.to_numpy()), times[k].values.to_numpy().astype(np.int64)
                found[block[k]].append((at[k].values.to_numpy(), np.where(often == most, n, 0), often * n))
            if found:
                sums = [_added(*map(np.concatenate, zip(*x))) for x in found.values()]
                ends = pa.array(np.cumsum([0, *(len(x[0]) for x in sums)]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in zip(*sums)]
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), *lists], names=["block", "at", "best", "whole"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        at, best, whole = _added(*(table[c].combine_chunks().flatten().to_numpy() for c in ("at", "best", "whole")))
        return pa.table({"row": at + np.int64(key[0].as_py()), "n_best": best, "count_sum": whole})

    # a task hands on one row for each block that its lists are of; a block's lists fit a task, as they came from one
    parts = dealt.mapInArrow(sums, "block bigint, at array<int>, best array<bigint>, whole array<bigint>")
    return parts.groupBy("block").applyInArrow(add, "row bigint, n_best bigint, count_sum bigint")


def _added(at: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct places in order, and each one's sums."""
    order = np.argsort(at, kind="stable")
    starts = np.flatnonzero(np.diff(at[order], prepend=-1))
    return at[order][starts], *(np.add.reduceat(v[order], starts) for v in values)


def alignment(docs: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = staged(aligned(docs, a_path, b_path), "align-tokens")
    sums = link_sums(found.where("b IS NOT NULL").select(*LIST)).withColumnRenamed("row", "s_row")
    rows = found.where("row IS NOT NULL").select(*DOC).join(sums, F.col("row") == F.col("s_row"), "left")
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", none("n_best"), none("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(documents(spark, sf_dir))
