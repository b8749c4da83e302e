"""Near-duplicate embeddings with a forest of random-projection trees.

Vectors of one label are compared when they meet in a leaf of one of ``TREES`` trees, and
linked when their cosine is high enough. Equal vectors of a label form a class, which goes through the trees once.

* A node splits at the median of its vectors' projections on a random direction, the best of a few.
  Vectors near the cut go to both sides: the overlap is a part of how far the projections of two
  vectors at the least cosine lie apart, so that few such pairs part at a level, and hardly any in every tree.
* Trees grow in rounds of ``DEPTH`` levels. In a round each node that is too large is fitted on
  a sample of at most about ``SAMPLE`` of its vectors (by hash, so reruns agree), and every vector is led down by the
  fitted planes. Directions come from the node's number, so only cuts are stored. All nodes of all trees grow at the same time.
* A node in which most vectors would go to both sides of any cut holds vectors that are all close to one
  another. It is a leaf, whatever its size. Leaves beyond ``BLOCK`` vectors are compared in blocks: each
  two blocks in a task of their own, so all their pairs are seen and no task holds a leaf.
* Pairs are never written. Each vector knows all its leaves; a pair counts in the first leaf
  that both share and in no other, so a leaf hands on a number of links for each vector and one edge to the first
  vector that it hangs together with there. Edges of all leaves make the components.

Links are exact (double precision, on the vectors themselves); what the trees may miss are pairs
that meet in no leaf. Measured recall against all pairs is in the README and the tests.

Defined results: vectors with a null label, null, empty, all zero, or with null or non-finite components link with
nothing, nor do rows with a null vec_id. Vectors of different lengths are never linked. Rows are vectors,
also where a vec_id stands on several: they count as links of each other when they are alike, and a component's
id is the smallest vec_id of its rows. Only vec_id, embedding and label are read. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.llm.components import components
from tarnworks.session import staged

QUERY = "op11_embedding_near_dedup"

COSINE = 0.93
TREES = 6
#: Half the overlap at a cut, as a part of the standard deviation of the difference of two projections at the least cosine.
OVERLAP = 0.75
#: Vectors below which a node is a leaf, and that are compared in one task.
LEAF = 384
BLOCK = 1024
#: Levels that grow in a round, vectors that a node is fitted on, directions that are tried for a plane.
DEPTH = 6
SAMPLE = 4096
TRIES = 3
#: A node is a leaf if more than this share of its vectors would go to both sides.
DENSE = 0.6
#: Vectors of the sample that a plane needs.
FITTED = 32

PLANES = (1 << DEPTH) - 1


def _unit(flat: pa.Array, rows: int) -> np.ndarray:
    """Vectors of one length, in double precision, scaled to length 1."""
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def keyed(rows: DataFrame) -> DataFrame:
    """vec_id, label, dim, key, vector: key is a digest of label and vector, null where the row links with nothing."""
    kind = rows.schema["embedding"].dataType.elementType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            keys, dims = [], []
            for vec_id, label, vector in zip(ids, labels, vectors):
                key = None
                if vec_id is not None and label is not None and vector.is_valid and not vector.values.null_count:
                    values = vector.values.to_numpy(zero_copy_only=False) + 0.0  # -0.0 is 0.0
                    if np.isfinite(values).all() and values.any():
                        key = hashlib.blake2b(repr(label).encode() + b"\0" + values.tobytes(), digest_size=16).digest()
                keys.append(key)
                dims.append(len(vector.values) if key else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), vectors], names=["vec_id", "label", "dim", "key", "vector"])

    some = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").alias("vector"))
    return some.mapInArrow(digest, f"vec_id bigint, label string, dim int, key binary, vector array<{kind}>")


def _planes(node: int, dim: int) -> np.ndarray:
    """TRIES random directions of length 1 for each plane of a node."""
    x = np.random.default_rng(node & (2**64 - 1)).standard_normal((PLANES * TRIES, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _half_overlap(dim: int, cosine: float) -> float:
    return OVERLAP * np.sqrt((2 - 2 * cosine) / dim) / 2


def _child(node: int, place: int) -> int:
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh3_64_intdigest(struct.pack("<qi", node, place))))[0]


def fitted(x: np.ndarray, node: int, size: int, cosine: float) -> tuple[list[int], list[float]]:
    """For each plane (children of plane p are 2p + 1 and 2p + 2) the direction taken and its cut, nan where the tree ends."""
    choice, cut, near = [0] * PLANES, [float("nan")] * PLANES, _half_overlap(x.shape[1], cosine)
    places = x @ _planes(node, x.shape[1]).T
    todo = [(0, np.arange(len(x)))]
    while todo:
        p, rows = todo.pop()
        if p >= PLANES or len(rows) < FITTED or size * len(rows) / len(x) <= LEAF:
            continue
        own = places[rows, p * TRIES : (p + 1) * TRIES]
        middle = np.median(own, axis=0)
        both = (np.abs(own - middle) <= near).mean(axis=0)
        best = int(both.argmin())
        if both[best] > DENSE:
            continue
        choice[p], cut[p] = p * TRIES + best, float(middle[best])
        todo += [(2 * p + 1, rows[own[:, best] <= cut[p] + near]), (2 * p + 2, rows[own[:, best] >= cut[p] - near])]
    return choice, cut


def led(x: np.ndarray, node: int, choice: np.ndarray, cut: np.ndarray, cosine: float) -> Iterator[tuple[int, bool, np.ndarray]]:
    """node, whether it is a leaf, and the rows of x that come there."""
    near, todo = _half_overlap(x.shape[1], cosine), [(0, np.arange(len(x)))]
    used = choice[~np.isnan(cut)]
    places = dict(zip(used.tolist(), (x @ _planes(node, x.shape[1])[used].T).T))
    while todo:
        p, rows = todo.pop()
        if not len(rows):
            continue
        if p >= PLANES or np.isnan(cut[p]):
            yield (_child(node, p) if p else node), p < PLANES, rows
            continue
        own = places[int(choice[p])][rows]
        todo += [(2 * p + 1, rows[own <= cut[p] + near]), (2 * p + 2, rows[own >= cut[p] - near])]


def leaves(classes: DataFrame, cosine: float = COSINE, trees: int = TREES) -> DataFrame:
    """key, node: the leaves of each class (key, label, dim, vector) in all trees."""
    roots = F.explode(F.array(*[F.xxhash64("label", "dim", F.lit(t)) for t in range(trees)])).alias("node")
    state, done = classes.select("key", "dim", "vector", roots), []
    vector = classes.schema["vector"].dataType

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        node, dim = (k.as_py() for k in key)
        x = _unit(table["vector"].combine_chunks().flatten(), table.num_rows)
        choice, cut = fitted(x, node, table["n"][0].as_py(), cosine)
        return pa.table({"node": [node], "dim": pa.array([dim], pa.int32()), "choice": pa.array([choice], pa.list_(pa.int32())), "cut": pa.array([cut], pa.list_(pa.float64()))})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            nodes, dims = table["node"].to_numpy(), table["dim"].to_numpy()
            order = np.lexsort((dims, nodes))
            starts = np.flatnonzero((np.diff(nodes[order], prepend=nodes[order][0] ^ 1) != 0) | (np.diff(dims[order], prepend=-1) != 0)) if len(order) else []
            for rows in np.split(order, starts[1:]) if len(order) else []:
                part = table.take(rows)
                choice, cut = part["choice"][0].values, part["cut"][0].values
                if choice is None:
                    yield _routed(part, int(nodes[rows[0]]), True)
                    continue
                x = _unit(part["vector"].combine_chunks().flatten(), len(rows))
                for node, ends, own in led(x, int(nodes[rows[0]]), choice.to_numpy(), cut.to_numpy(), cosine):
                    yield _routed(part.take(own), node, ends)

    def _routed(part: pa.Table, node: int, ends: bool) -> pa.RecordBatch:
        n, keys, dims, vectors = part.num_rows, *(part[c].combine_chunks() for c in ("key", "dim", "vector"))
        vectors = pa.nulls(n, vectors.type) if ends else vectors  # a leaf needs none
        return pa.RecordBatch.from_arrays([keys, dims, vectors, pa.array(np.full(n, node)), pa.array(np.full(n, ends))], names=["key", "dim", "vector", "node", "leaf"])

    while True:
        sizes = state.groupBy("node", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LEAF)
        sizes = staged(sizes.withColumnsRenamed({"node": "o_node", "dim": "o_dim"}), "forest-sizes")
        if sizes.isEmpty():
            break
        chosen = F.shiftrightunsigned(F.xxhash64("key", "node"), 11) / F.lit(float(1 << 53))
        sample = state.join(sizes, (F.col("node") == F.col("o_node")) & (F.col("dim") == F.col("o_dim"))).where(chosen * F.col("n") < SAMPLE)
        plans = sample.select("node", "dim", "n", "vector").groupBy("node", "dim").applyInArrow(fit, "node bigint, dim int, choice array<int>, cut array<double>")
        plans = staged(plans.withColumnsRenamed({"node": "p_node", "dim": "p_dim"}), "forest-plans")
        planned = state.join(plans, (F.col("node") == F.col("p_node")) & (F.col("dim") == F.col("p_dim")), "left").select("key", "dim", "vector", "node", "choice", "cut")
        schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("dim", T.IntegerType()), T.StructField("vector", vector), T.StructField("node", T.LongType()), T.StructField("leaf", T.BooleanType())])
        grown = staged(planned.mapInArrow(route, schema), "forest-level")
        done.append(grown.where("leaf").select("key", "node"))
        state = grown.where(~F.col("leaf")).drop("leaf")
    out = state.select("key", "node")
    for part in done:
        out = out.unionByName(part)
    return out


def links_in_leaves(classes: DataFrame, held: DataFrame, cosine: float = COSINE) -> DataFrame:
    """key, links, other: parts of a class's number of linked vectors, and a class that it is linked to over others.

    classes: key, label, dim, size, vector; held: key, node.
    """
    held = staged(held, "forest-leaves")
    sizes = held.groupBy(F.col("node").alias("s_node")).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("parts"))
    own = held.join(sizes, F.col("node") == F.col("s_node")).groupBy(F.col("key").alias("h_key")).agg(F.sort_array(F.collect_set(F.struct("node", "parts"))).alias("own"))
    members = staged(classes.join(own, F.col("key") == F.col("h_key")).select("key", "label", "dim", "size", "vector", "own"), "forest-members")
    rows = members.withColumn("leaf", F.explode("own")).select("key", "label", "dim", "size", "vector", F.col("own.node").alias("nodes"), F.col("leaf.node").alias("node"), F.col("leaf.parts").alias("parts"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumns({"low": F.least("block", "to"), "high": F.greatest("block", "to")}).drop("to", "parts")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        node, low, high = key[2].as_py(), key[3].as_py(), key[4].as_py()
        x = _unit(table["vector"].combine_chunks().flatten(), table.num_rows)
        size, block = table["size"].to_numpy(), table["block"].to_numpy()
        if low == high:
            one, two = np.nonzero(np.triu(x @ x.T >= cosine, 1))
        else:
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            one, two = np.nonzero(x[left] @ x[right].T >= cosine)
            one, two = left[one], right[two]
        if len(one):
            first = _first_meeting(table["nodes"].combine_chunks(), node, one, two)
            one, two = one[first], two[first]
        links = np.bincount(one, size[two], len(x)) + np.bincount(two, size[one], len(x))
        root, before = np.arange(len(x)), None
        while before is None or (root != before).any():
            before = root.copy()
            least = np.minimum(root[one], root[two])
            np.minimum.at(root, one, least)
            np.minimum.at(root, two, least)
        some = np.flatnonzero(links)
        keys = table["key"].combine_chunks()
        return pa.table({"key": keys.take(pa.array(some)), "links": pa.array(links[some].astype(np.int64)), "other": keys.take(pa.array(root[some]))})

    return rows.groupBy("label", "dim", "node", "low", "high").applyInArrow(compare, "key binary, links bigint, other binary")


def _first_meeting(nodes: pa.ListArray, node: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether each pair shares no node below this one; in steps, so that memory stays bounded."""
    offsets, flat = nodes.offsets.to_numpy(), nodes.values.to_numpy()
    lengths = np.diff(offsets)
    table = np.full((len(lengths), lengths.max()), np.iinfo(np.int64).max)
    table[np.arange(lengths.max()) < lengths[:, None]] = flat[offsets[0] : offsets[-1]]
    step, out = max(1, (1 << 22) // table.shape[1] ** 2), []
    for k in range(0, len(one), step):
        a, b = table[one[k : k + step]], table[two[k : k + step]]
        out.append(~((a[:, :, None] == b[:, None, :]) & (a < node)[:, :, None]).any(axis=(1, 2)))
    return np.concatenate(out)


def near_duplicate_vectors(rows: DataFrame, cosine: float = COSINE, trees: int = TREES) -> DataFrame:
    """A row for each row: vec_id, label, n_links, component_id, kept."""
    known = staged(keyed(rows), "vectors-keyed")
    classes = known.where("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("size"), *[F.first(c).alias(c) for c in ("label", "dim", "vector")])
    classes = staged(classes, "vectors-classes")
    found = staged(links_in_leaves(classes.drop("least_id"), leaves(classes.select("key", "label", "dim", "vector"), cosine, trees), cosine), "vectors-links")
    numbers = found.groupBy(F.col("key").alias("n_key")).agg(F.sum("links").alias("links"))
    member = components(found.select(F.col("key").alias("a"), F.col("other").alias("b")))
    member = member.join(classes.select("key", "least_id"), F.col("node") == F.col("key")).select("node", "component", "least_id")
    least = member.groupBy(F.col("component").alias("l_component")).agg(F.min("least_id").alias("l_id"))
    member = member.join(least, F.col("component") == F.col("l_component")).select("node", "l_id")
    about = classes.select("key", "size", "least_id").join(numbers, F.col("key") == F.col("n_key"), "left").join(member, F.col("key") == F.col("node"), "left")
    about = about.select(F.col("key").alias("c_key"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("c_links"), F.coalesce("l_id", "least_id").alias("c_id"))
    about = staged(about, "vectors-about")
    # both sides are plain scans, so adaptive execution can split a class that a third of the rows share
    out = known.select("vec_id", "label", "key").join(about, F.col("key") == F.col("c_key"), "left")
    component = F.coalesce("c_id", "vec_id")
    return out.select("vec_id", "label", F.coalesce("c_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("label")
