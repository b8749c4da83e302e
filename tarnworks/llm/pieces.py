"""SentencePiece encoding and decoding by a max-plus scan over chunks.

A text is encoded to the pieces of an existing vocabulary with the greatest sum of
scores. A giant document is cut into chunks of ``CHUNK`` code points. Pieces may
cross a cut, so the state at a cut is how far beyond it the first piece boundary
lies (less than the longest piece). A chunk yields the matrix of best scores from
each state at its start to each at its end; such matrices combine by the max-plus
product, which is associative, so runs of ``RUN`` chunks are combined apart, then
the few runs of a document, and the best states at all cuts follow. Then each
chunk is traced back by itself.

No piece but a run of spaces holds a space after its first character, so every
segmentation has a boundary before each run of spaces; between such boundaries
the best pieces of a word are found once and kept.

Encoding marks the start of the text with a space, as the vocabulary's own library
does. Characters without a piece are spelled in byte pieces; a literal word mark
(U+2581) is one of them, so that decoding always gives back the text. Of equally
good segmentations one is chosen, the same each time.

Defined results: null text counts as empty, and an empty text has no pieces. Only
doc_id and text are read. Repeated rows are encoded one by one. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.llm.text import documents
from tarnworks.llm.vocabulary import PIECES, Vocabulary, read_pieces
from tarnworks.session import staged

QUERY = "op9_sentencepiece"

CHUNK = 1 << 15
RUN = 256
#: Words kept with their pieces in a worker, twice: the newest, and those before them.
KEPT = 400_000
#: Words longer than this are not kept.
KEPT_POINTS = 64
_WORD = re.compile(r" +[^ ]*")
_WORD_OR_LINE = re.compile(r" +[^ \n]*|\n[^ \n]*")
_NEVER = -np.inf


class Encoder(dict):
    """Best pieces of words. A word is what follows a space: further spaces, then all up to the next space.

    Where no piece of the vocabulary holds a line feed, words end before it too,
    and a line feed with what follows it is a word without a space.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.ids, self.byte_ids, self.byte_score, self.step = vocabulary.ids, vocabulary.byte_ids, vocabulary.byte_score, vocabulary.step
        self.longest, self.texts, self.scores = vocabulary.longest, vocabulary.texts, np.array(vocabulary.scores)
        self.older: dict[str, tuple[int, ...]] = {}
        self.lines = not any("\n" in t for t in self.ids)

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            marked = word if self.lines and word[:1] == "\n" else " " + word
            ids = self.path(marked, 0, len(marked))
        if len(word) <= KEPT_POINTS:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def best(self, text: str, start: int, limit: int) -> tuple[list[float], list[int]]:
        """From ``start``: the best score of reaching each place, and from where. No piece starts at or after ``limit``.

        A character without a piece goes by its bytes.
        """
        n, step = len(text), self.step
        score, origin = [_NEVER] * (n + 1), [-1] * (n + 1)
        score[start] = 0.0
        for i in range(start, min(limit, n)):
            here, j = score[i], i + 1
            if here == _NEVER:
                continue
            if step.get(text[i]) is None and (s := here + self.byte_score * len(text[i].encode("utf-8", "surrogatepass"))) > score[j]:
                score[j], origin[j] = s, i
            while j <= n:
                s = step.get(text[i:j], 1.0)
                if s is not None:
                    if s > 0:  # no piece goes on like this
                        break
                    if here + s > score[j]:
                        score[j], origin[j] = here + s, i
                j += 1
        return score, origin

    def path(self, text: str, start: int, end: int, limit: int | None = None) -> tuple[int, ...]:
        """The best pieces from ``start`` to ``end``."""
        if start == end:
            return ()
        origin = self.best(text, start, end if limit is None else limit)[1]
        spans, j = [], end
        while j > start:
            spans.append((origin[j], j))
            j = origin[j]
        ids: list[int] = []
        for i, j in reversed(spans):
            piece = text[i:j]
            ids += [self.ids[piece]] if piece in self.ids else [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        return tuple(ids)

    def whole(self, text: str) -> list[int]:
        """Pieces of a marked text in one go."""
        if "  " in text or text[-1:] == " ":
            words = [w[1:] if w[0] == " " else w for w in (_WORD_OR_LINE if self.lines else _WORD).findall(text)]
        else:
            words = (text[1:].replace("\n", " \n") if self.lines else text[1:]).split(" ")
        return list(chain.from_iterable(map(self.__getitem__, words))) if text else []

    def score(self, ids: list[int]) -> float:
        return float(self.scores[np.array(array("i", ids))].sum()) if ids else 0.0

    def decode(self, ids) -> str:
        """The marked text of pieces."""
        return b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "surrogatepass")

    # a chunk: text from its start to the end of what its last piece can reach; size: code points up to the next cut

    def cuts(self, text: str, size: int) -> tuple[int, int] | None:
        """The first and last sure boundary that any path from any entry passes before the exit."""
        first = next((m.start() + 1 for m in re.compile("[^ ] ").finditer(text, self.longest - 1, size)), None)
        if first is None:
            return None
        last = first
        at = size - 1
        while at > first:
            if text[at] == " " and text[at - 1] != " ":
                last = at
                break
            at -= 1
        return first, last

    def matrix(self, text: str, size: int, ends: bool) -> np.ndarray:
        """Best scores from each entry state to each exit state; a last chunk has one exit, its end."""
        out = np.full((self.longest, self.longest), _NEVER)
        cuts = self.cuts(text, size)
        exits = [(0, len(text))] if ends else [(j, size + j) for j in range(self.longest) if size + j <= len(text)]
        if cuts is None:
            for i in range(min(self.longest, len(text) + 1)):
                score = self.best(text, i, size)[0]
                for j, place in exits:
                    out[i, j] = score[place]
            return out
        first, last = cuts
        middle = self.score(self.whole(text[first:last]))
        tail = self.best(text[last:], 0, size - last)[0]
        for i in range(self.longest):
            head = self.best(text[:first], i, first)[0][first]
            for j, place in exits:
                out[i, j] = head + middle + tail[place - last]
        return out

    def between(self, text: str, size: int, entry: int, place: int) -> list[int]:
        """Pieces from an entry state to a place at or beyond the next cut."""
        cuts = self.cuts(text, size)
        if cuts is None:
            return list(self.path(text, entry, place, size))
        first, last = cuts
        return [*self.path(text[:first], entry, first), *self.whole(text[first:last]), *self.path(text[last:], 0, place - last, size - last)]


#: Encoders of this process by the name of their vocabulary: a worker keeps its words from task to task.
_ENCODERS: dict[str, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    if vocabulary.name not in _ENCODERS:
        _ENCODERS[vocabulary.name] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.name]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """The states at all cuts of a best path through the matrices, from ``entry`` to ``leave``."""
    ahead = [np.where(np.arange(len(matrices[0])) == entry, 0.0, _NEVER)]
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).max(axis=0))
    path = [leave]
    for k in range(len(matrices) - 1, -1, -1):
        path.append(int(np.argmax(ahead[k] + matrices[k][:, path[-1]])))
    return path[::-1]


def chunks(rows: DataFrame, size: int, reach: int) -> DataFrame:
    """uid, doc_id, chunk, n_chunks, part: the marked text from a cut up to ``reach`` beyond the next."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, doc_id, text in zip(*batch.columns):
                marked = " " + text.as_py()
                count = -(-len(marked) // size)
                for start in range(0, count, 64):
                    part = range(start, min(start + 64, count))
                    texts = [marked[k * size : (k + 1) * size + reach] for k in part]
                    n = len(texts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid.as_py()] * n, pa.int64()), pa.array([doc_id.as_py()] * n, pa.int64()), pa.array(part, pa.int64()), pa.array([count] * n, pa.int64()), pa.array(texts, pa.string())],
                        names=["uid", "doc_id", "chunk", "n_chunks", "part"],
                    )

    return rows.mapInArrow(cut, "uid bigint, doc_id bigint, chunk bigint, n_chunks bigint, part string")


def _matrices_of(table: pa.Table, column: str) -> list[np.ndarray]:
    return [np.array(m.as_py()).reshape(int(len(m) ** 0.5), -1) for m in table.column(column)]


def _flat(matrices: list[np.ndarray]) -> pa.Array:
    return pa.array([m.ravel().tolist() for m in matrices], pa.list_(pa.float64()))


def cut_states(cut: DataFrame, vocabulary: Vocabulary, size: int) -> DataFrame:
    """uid, chunk, entry, leave: the states at a chunk's start and end on a best path."""

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch in batches:
            out = []
            for chunk, count, text in zip(batch.column(1), batch.column(2), batch.column(3)):
                ends = chunk.as_py() + 1 == count.as_py()
                out.append(encoder.matrix(text.as_py(), len(text.as_py()) if ends else size, ends))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _flat(out)], names=["uid", "chunk", "matrix"])

    def combine(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        first, *others = _matrices_of(table, "matrix")
        for m in others:
            first = product(first, m)
        return pa.table([table.column("uid")[:1], table.column("run")[:1], _flat([first])], ["uid", "run", "matrix"])

    def outer(table: pa.Table) -> pa.Table:
        table = table.sort_by("run")
        path = states(_matrices_of(table, "matrix"), 0, 0)
        return pa.table([table.column("uid"), table.column("run"), pa.array(path[:-1], pa.int64()), pa.array(path[1:], pa.int64())], ["uid", "run", "entry", "leave"])

    def inner(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        path = states(_matrices_of(table, "matrix"), table.column("entry")[0].as_py(), table.column("leave")[0].as_py())
        return pa.table([table.column("uid"), table.column("chunk"), pa.array(path[:-1], pa.int64()), pa.array(path[1:], pa.int64())], ["uid", "chunk", "entry", "leave"])

    matrices = cut.select("uid", "chunk", "n_chunks", "part").mapInArrow(transfer, "uid bigint, chunk bigint, matrix array<double>")
    matrices = staged(matrices.withColumn("run", F.floor(F.col("chunk") / RUN)), "pieces-matrices")
    runs = matrices.groupBy("uid", "run").applyInArrow(combine, "uid bigint, run bigint, matrix array<double>")
    bounds = runs.groupBy("uid").applyInArrow(outer, "uid bigint, run bigint, entry bigint, leave bigint")
    return matrices.join(bounds, ["uid", "run"]).groupBy("uid", "run").applyInArrow(inner, "uid bigint, chunk bigint, entry bigint, leave bigint")


_ENCODED = "doc_id bigint, chunk bigint, n_chunks bigint, ids array<int>, score double, round_trip boolean"


def _encoded(doc_ids, numbers, counts, found: list[list[int]], encoder: Encoder, same: list[bool]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(ids) for ids in found])]).astype(np.int32)
    values = np.array(array("i", chain.from_iterable(found)), np.int32)
    upto = np.concatenate([[0.0], np.cumsum(encoder.scores[values])])
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
    scores = pa.array(upto[offsets[1:]] - upto[offsets[:-1]])
    return pa.RecordBatch.from_arrays([doc_ids, numbers, counts, lists, scores, pa.array(same, pa.bool_())], names=["doc_id", "chunk", "n_chunks", "ids", "score", "round_trip"])


def encode(docs: DataFrame, vocabulary_path: str = PIECES, size: int = CHUNK) -> DataFrame:
    """doc_id, chunk, n_chunks, ids, score, round_trip: a row for each document, or for each chunk of a giant one.

    The ids of a document are those of its chunks in order. round_trip says that
    the decoded ids are the chunk's text.
    """
    vocabulary = read_pieces(vocabulary_path)
    if size <= vocabulary.longest:
        raise ValueError(f"a chunk must be longer than the longest piece ({vocabulary.longest})")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    giant = F.length("text") >= size

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [t.as_py() for t in part.column(1)]
                found = [encoder.whole(" " + t) if t else [] for t in texts]
                same = [encoder.decode(ids)[1:] == t for ids, t in zip(found, texts)]
                n = len(texts)
                yield _encoded(part.column(0), pa.array(np.zeros(n, np.int64)), pa.array(np.ones(n, np.int64)), found, encoder, same)

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch in batches:
            found, same = [], []
            for _, k, count, text, entry, leave in zip(*[c.to_pylist() for c in batch.columns]):
                ends = k + 1 == count
                length = len(text) if ends else size
                place = len(text) if ends else size + leave
                found.append(encoder.between(text, length, entry, place))
                same.append(encoder.decode(found[-1]) == text[entry:place])
            yield _encoded(batch.column(0), batch.column(1), batch.column(2), found, encoder, same)

    large = rows.where(giant).select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    cut = staged(chunks(large, size, vocabulary.longest - 1), "pieces-chunks")
    at = cut_states(cut, vocabulary, size).select(F.col("uid").alias("a_uid"), F.col("chunk").alias("a_chunk"), "entry", "leave")
    placed = cut.join(at, (F.col("uid") == F.col("a_uid")) & (F.col("chunk") == F.col("a_chunk"))).select("doc_id", "chunk", "n_chunks", "part", "entry", "leave")
    return rows.where(~giant).mapInArrow(small, _ENCODED).unionByName(placed.mapInArrow(traced, _ENCODED))


def decode(encoded: DataFrame, vocabulary_path: str = PIECES) -> DataFrame:
    """doc_id, chunk, text: the texts of encoded chunks; those of a document in order are its text."""
    vocabulary = read_pieces(vocabulary_path)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch in batches:
            out = [encoder.decode(ids.as_py())[1 if chunk.as_py() == 0 else 0 :] for chunk, ids in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["doc_id", "chunk", "text"])

    return encoded.select("doc_id", "chunk", "ids").mapInArrow(texts, "doc_id bigint, chunk bigint, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir)).withColumn("n_pieces", F.size("ids").cast("bigint"))
