"""Embedding near-duplicates by a pivot-permutation index.

A vector is described by its ``LENGTH`` nearest of ``n_pivots`` reference vectors, in order of nearness.
Inverted lists hold, for each pivot, the vectors that have it in their description. Two vectors of a list
are candidates if their descriptions share at least ``MIN_SHARED`` pivots; they are verified by the cosine
in double precision, once, in the list of the first pivot that they share.

Equal vectors are collapsed first and count with their multiplicity. A list longer than a block is cut
into blocks by hash and each pair of blocks is a group of its own, so no task holds a list, however dense
its region. A group returns degrees and a spanning forest of its links, not the links.

The pivots are chosen from a bounded sample (``SAMPLED * n_pivots`` rows, fixed by a hash of their
values), the only thing that the driver holds. They lie apart: no two have a cosine of
``APART`` or more. Else a dense cluster would hold many of them, and its members, each near to others of
these, would share none. Every vector is indexed. Unless a number is given, there are ``PER_ROOT`` pivots for the
square root of the rows, ``MAX_PIVOTS`` at most: a list grows with the root, and so do the comparisons of a vector.

Vectors that all have a direction in common are near to the same few pivots. So nearness to pivots is measured after a
share of the mean is taken off: as much as leaves two vectors at the threshold a cosine of ``LEFT``. The mean
is taken over sampled vectors of which no two reach the threshold, so that a cluster counts once. Links are
verified on the vectors as they are.

Defined cases: vectors that are null, empty, all zero, or hold a null or a non-finite number, or whose
length differs from the pivots' have no links; their component is themselves. Rows with equal or null ids
are separate rows; a component's id is the smallest id in it, null if it has none. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscape.llm.common import salted_join
from termscape.llm.components import components
from termscape.session import Scratch, frozen

PER_ROOT = 8
MIN_PIVOTS, MAX_PIVOTS = 256, 8192
SAMPLED = 4
APART = 0.6
LEFT = 0.75
LENGTH = 10
MIN_SHARED = 2
MIN_COSINE = 0.9
BLOCK = 1024


def _usable(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors of a list column, and their unit vectors."""
    places, units = [], []
    for i, value in enumerate(column):
        if not value.is_valid:
            continue
        values = value.values
        if len(values) == 0 or values.null_count:
            continue
        vector = np.asarray(values.to_numpy(zero_copy_only=False), np.float64)
        if not np.isfinite(vector).all():
            continue
        top = np.abs(vector).max()
        if top == 0.0:
            continue
        vector = vector / top  # keeps squares of tiny and huge components in range
        places.append(i)
        units.append(vector / np.linalg.norm(vector))
    return np.array(places, np.int64), units


def pivots_for(rows: int) -> int:
    return min(MAX_PIVOTS, max(MIN_PIVOTS, int(PER_ROOT * rows**0.5)))


def _apart(units: np.ndarray, cosine: float, most: int) -> np.ndarray:
    """The first vectors, ``most`` at most, of which no two have a cosine of ``cosine`` or more."""
    chosen = np.zeros((min(most, len(units)), units.shape[1]))
    n = 0
    for unit in units:
        if n == len(chosen):
            break
        if (chosen[:n] @ unit < cosine).all():
            chosen[n] = unit
            n += 1
    return chosen[:n]


def _centre(units: np.ndarray, min_cosine: float) -> np.ndarray:
    """What is taken off the unit vectors before they are compared with pivots.

    With e the mean's squared length and t the share that is taken off, a typical vector keeps the squared length
    1 - e + (1 - t)^2 e, and two vectors at the threshold keep the cosine 1 - (1 - min_cosine) / that.
    """
    mean = _apart(units, min_cosine, len(units)).mean(axis=0)
    energy = float(mean @ mean)
    if energy == 0.0:
        return mean
    stays = min(energy, max(0.0, (1.0 - min_cosine) / (1.0 - LEFT) - 1.0 + energy))
    return mean * (1.0 - np.sqrt(stays / energy))


def centred(units: np.ndarray, centre: np.ndarray) -> np.ndarray:
    moved = units - centre
    return moved / np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)


def choose_pivots(
    vectors: DataFrame, vector_column: str, n_pivots: int, min_cosine: float = MIN_COSINE
) -> tuple[np.ndarray, np.ndarray]:
    """At most ``n_pivots`` centred vectors of the commonest length that lie apart, and the centre: the same whatever the partitioning."""
    whole = vectors.select(F.col(vector_column).cast("array<double>").alias("vector"))
    whole = whole.where("vector is not null and size(vector) > 0").withColumn("place", F.xxhash64("vector"))
    places = whole.select("place").distinct().orderBy("place").limit(SAMPLED * n_pivots)
    last = places.agg(F.max("place")).first()[0]
    nothing = np.zeros((0, 0)), np.zeros(0)
    if last is None:
        return nothing
    sample = whole.where(F.col("place") <= last).groupBy("place").agg(F.first("vector").alias("vector"))
    rows = sample.orderBy("place").select("vector").toArrow()["vector"].combine_chunks()
    _, units = _usable(rows)
    lengths: dict[int, int] = {}
    for unit in units:
        lengths[len(unit)] = lengths.get(len(unit), 0) + 1
    if not units:
        return nothing
    size = max(lengths, key=lambda n: (lengths[n], n))
    whole_size = np.stack([unit for unit in units if len(unit) == size])
    centre = _centre(whole_size, min_cosine)
    return _apart(centred(whole_size, centre), APART, n_pivots), centre


INDEX_SCHEMA = "vec_id bigint, key binary, vector binary, pivots array<int>"


def describe(
    vectors: DataFrame, pivots: np.ndarray, centre: np.ndarray, id_column: str, vector_column: str
) -> DataFrame:
    """vec_id, a key of the vector's value, the unit vector, its nearest pivots in order (null: not usable)."""
    size = pivots.shape[1]
    length = min(LENGTH, len(pivots))
    # at most MAX_PIVOTS vectors, unless the caller asks for more
    held = vectors.sparkSession.sparkContext.broadcast((pivots, centre))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list = [None] * batch.num_rows
            blobs: list = [None] * batch.num_rows
            near: list = [None] * batch.num_rows
            places, units = _usable(batch.column(1))
            fit = [(p, u) for p, u in zip(places, units, strict=True) if len(u) == size]
            if fit:
                matrix = np.stack([u for _, u in fit])
                pivots, centre = held.value
                cosines = centred(matrix, centre) @ pivots.T
                order = np.argsort(-cosines, axis=1, kind="stable")[:, :length]
                for (p, unit), row in zip(fit, order, strict=True):
                    blobs[p] = unit.tobytes()
                    keys[p] = hashlib.blake2b(blobs[p], digest_size=16).digest()
                    near[p] = row.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(blobs, pa.binary()), pa.array(near, pa.list_(pa.int32()))],
                names=["vec_id", "key", "vector", "pivots"],
            )

    plain = vectors.select(F.col(id_column), F.col(vector_column).cast("array<double>"))
    return plain.mapInArrow(run, INDEX_SCHEMA)


def shared_pivots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many pivots each row of ``left`` shares with each row of ``right``; -1 marks no pivot."""
    seen = np.unique(np.concatenate([left.ravel(), right.ravel()]))
    seen = seen[seen >= 0]

    def held(rows: np.ndarray) -> np.ndarray:
        table = np.zeros((len(rows), len(seen) + 1), np.float32)
        places = np.where(rows >= 0, np.searchsorted(seen, rows), len(seen))
        table[np.arange(len(rows))[:, None], places] = 1
        return table[:, :-1]

    return held(left) @ held(right).T


LINK_SCHEMA = "u binary, v binary, n bigint"


def _link_group(min_cosine: float, min_shared: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        pivot, first, second = (k.as_py() for k in key)
        names = group.column("key").to_pylist()
        vectors = np.stack([np.frombuffer(b) for b in group.column("vector").to_pylist()])
        near = np.stack(group.column("pivots").to_numpy(zero_copy_only=False))
        weight = group.column("n").to_numpy()
        block = group.column("block").to_numpy()
        a, b = np.flatnonzero(block == first), np.flatnonzero(block == second)
        links: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if len(a) and len(b):
            candidates = shared_pivots(near[a], near[b]) >= min_shared
            earlier = np.where(near < pivot, near, -1)
            candidates &= shared_pivots(earlier[a], earlier[b]) == 0
            if first == second:
                candidates &= np.triu(np.ones(candidates.shape, bool), 1)
            i, j = np.nonzero(candidates)
            if len(i):
                cosine = vectors[a] @ vectors[b].T
                good = cosine[i, j] >= min_cosine
                links = a[i[good]], b[j[good]]
        u, v = links
        degree = np.zeros(len(names), np.int64)
        np.add.at(degree, u, weight[v])
        np.add.at(degree, v, weight[u])
        label = np.arange(len(names))
        while len(u):  # each vertex takes the smallest label around it
            least = np.minimum(label[u], label[v])
            new = label.copy()
            np.minimum.at(new, u, least)
            np.minimum.at(new, v, least)
            if (new == label).all():
                break
            label = new
        linked = np.flatnonzero(degree)
        return pa.table(
            {
                "u": pa.array([names[x] for x in linked], pa.binary()),
                "v": pa.array([names[label[x]] for x in linked], pa.binary()),
                "n": pa.array(degree[linked], pa.int64()),
            }
        )

    return run


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    min_cosine: float = MIN_COSINE,
    n_pivots: int | None = None,
    min_shared: int = MIN_SHARED,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id, kept (the smallest id of its component)."""
    spark = vectors.sparkSession
    pivots, centre = choose_pivots(vectors, vector_column, n_pivots or pivots_for(vectors.count()), min_cosine)
    min_shared = min(min_shared, LENGTH, max(1, len(pivots)))
    with Scratch(spark) as scratch:
        index = scratch.table(describe(vectors, pivots, centre, id_column, vector_column), "pivot-index")
        classes = index.where("key is not null").groupBy("key").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("vec_id").alias("least"),
            F.first("vector").alias("vector"),
            F.first("pivots").alias("pivots"),
        )
        classes = scratch.table(classes, "vector-classes")
        # one row per pivot: at most n_pivots rows
        lists = classes.select(F.explode("pivots").alias("pivot")).groupBy("pivot").count()
        lists = lists.select("pivot", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
        postings = classes.select("key", "n", "vector", "pivots", F.explode("pivots").alias("pivot"))
        postings = postings.join(F.broadcast(lists), "pivot")
        postings = postings.withColumn("block", F.pmod(F.xxhash64("key", "pivot"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        postings = postings.withColumn("other", other)
        postings = postings.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
        groups = postings.select("pivot", "first", "second", "block", "key", "n", "vector", "pivots").groupBy("pivot", "first", "second")
        found = scratch.table(groups.applyInArrow(_link_group(min_cosine, min_shared), LINK_SCHEMA), "vector-links")

        degree = found.groupBy("u").agg(F.sum("n").alias("links"))
        member = components(found.select("u", "v"))
        joined = classes.select("key", "n", "least")
        joined = joined.join(degree, joined["key"] == degree["u"], "left").join(member, joined["key"] == member["vertex"], "left")
        joined = joined.withColumn("component", F.coalesce("component", "key"))
        smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
        # a component may hold most classes
        answer = salted_join(joined, smallest, "component", F.col("key")).select(
            "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
        )
        rows = salted_join(index.select("vec_id", "key"), answer, "key", F.col("vec_id"))
        usable = F.col("key").isNotNull()
        return frozen(
            rows.select(
                "vec_id",
                F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                F.when(usable, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
            ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))),
            "vector-duplicates",
        )
