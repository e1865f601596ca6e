"""N-gram Jaccard join: documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

Steps, each over all documents:

1. Shards count in how many documents each shingle occurs (``termscape.llm.shards``). A document's
   shingles are ordered rarest first, so that its prefix, the shortest one that any partner must
   share a shingle with, holds what is hardly anywhere else. Shingles of one document only cannot
   join and are left out. Positions in the order are kept.
2. Documents with equal sets are one class from here on; thousands of copies cost one row.
3. Classes meet on prefix shingles under the length filter and the positional filter (what can still be
   shared behind this place). A shingle that only one class has is dropped before the join. In the first
   round a class meets only the head of each of its lists, the class with the fewest rarer shingles before
   this one, hence the one with the fewest edits; what is found is joined into components. In the
   second round classes meet the others of their lists that are in other components. So a
   family of m variants costs about m meetings, not m * m, and no link between components is lost.
4. A pair is verified once: the suffix filter compares how many shingles each has in ranges of the order
   of hashes, whose smaller numbers bound the intersection; then the full sets are intersected.
5. All links lie within components, so ``linked_duplicates`` then counts them there: a component's classes
   are dealt by hash into blocks of about ``BLOCK``, and every pair of blocks intersects all its sets at once. A class
   is copied once per block of its component; only counts leave a task, weighted by the rows of the classes.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a text of fewer than five
words is one shingle of all of them; null, empty and blank texts have no shingle and no partner. Rows with
equal or null ids are separate rows; a component's id is the smallest id in it, null if none has one.
A text of any length is one row whose set is held by one task at a time. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscape.llm import shards
from termscape.llm.common import bounded_batches, salted_join
from termscape.llm.components import components
from termscape.session import Scratch, frozen, release_shuffles

SHINGLE = 5
#: 100 * intersection >= 80 * union, kept in whole numbers throughout.
PERCENT = 80
#: Classes in a block, pairs of which are compared at once; shingles that are compared in one product.
BLOCK, COLUMNS = 256, 4096
#: Ranges of the suffix filter, between which the sorted hashes are cut.
PIVOTS = (np.arange(1, 64, dtype=np.uint64) << np.uint64(58)).astype(np.uint64)
#: Shingles in a shard of text, for the number of counters.
SHINGLES_PER_SHARD = shards.SHARD_BYTES // 6


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text: owner index and hash, sorted by both."""
    lookup = _WordHash()
    flat: list[int] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        # bytes.lower changes A-Z alone; bytes.split parts at space, \t, \n, \v, \f, \r alone
        flat.extend(map(lookup.__getitem__, text.encode().lower().split()))
        ends[i + 1] = len(flat)
    words = np.array(flat, np.uint64)
    counts = np.diff(ends)
    factor = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size if len(rolled) else 0):
        rolled = rolled * factor + words[k : len(words) - size + 1 + k]
    owner = np.repeat(np.arange(len(texts)), counts)[: len(rolled)]
    inside = np.arange(len(rolled)) + size <= ends[1:][owner]
    owners, hashes = [owner[inside]], [_mixed(rolled[inside])]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        h = np.uint64(counts[i])
        for w in words[ends[i] : ends[i + 1]]:
            h = np.uint64((int(h) * int(factor) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        owners.append(np.array([i]))
        hashes.append(_mixed(np.array([h], np.uint64)))
    owner, found = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    return owner[first], found[first]


def _shard_hashes(table: pa.Table) -> np.ndarray:
    return shingle_sets(table.column("text").to_pylist())[1]


SIGNED_SCHEMA = "doc_id bigint, row_key bigint, n_shingles bigint, set_key binary, prefix array<bigint>, places array<int>, members binary"


def _sign(steps: tuple[int, ...]):
    """Per document: size and key of its set; its prefix, if it can have partners, and the set itself then."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = shards.in_order(docs)
        n_docs = docs.num_rows
        owner, hashes = shingle_sets(docs.column("text").to_pylist())
        held = shards.counts_of(hashes, steps, answers)
        sizes = np.bincount(owner, minlength=n_docs)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        rare_first = np.lexsort((hashes, held, owner))
        place = np.arange(len(owner)) - starts[owner]
        # n - ceil(0.8 n) + 1 shingles
        length = sizes - -(-PERCENT * sizes // 100) + 1
        chosen = (place < length[owner]) & (held[rare_first] > 1)
        columns: list[list] = [[None] * n_docs for _ in range(4)]
        keys, prefixes, places, members = columns
        chosen_at = np.flatnonzero(chosen)
        cut = np.searchsorted(chosen_at, np.append(starts, len(owner)))
        for i in range(n_docs):
            if not sizes[i]:
                continue
            blob = hashes[starts[i] : ends[i]].tobytes()
            keys[i] = hashlib.blake2b(blob, digest_size=16).digest()
            at = chosen_at[cut[i] : cut[i + 1]]
            if len(at):
                prefixes[i] = hashes[rare_first[at]].view(np.int64)
                places[i] = place[at].astype(np.int32)
                members[i] = blob
        return pa.table(
            {
                "doc_id": docs.column("doc_id").cast(pa.int64()),
                "row_key": docs.column("row_key"),
                "n_shingles": pa.array(sizes, pa.int64()),
                "set_key": pa.array(keys, pa.binary()),
                "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                "places": pa.array(places, pa.list_(pa.int32())),
                "members": pa.array(members, pa.binary()),
            }
        )

    return run


def sign_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    shard_docs, n_shards = shards.dealt(docs, id_column, text_column)
    steps = shards.counter_steps(n_shards, SHINGLES_PER_SHARD)
    answers = shards.shared_counts(shard_docs, _shard_hashes, steps)
    return shard_docs.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_sign(steps), SIGNED_SCHEMA)


def _needed(n_a: Column, n_b: Column) -> Column:
    """Smallest intersection that reaches the similarity: 180 * i >= 80 * (a + b)."""
    return F.floor(((n_a + n_b) * PERCENT + PERCENT + 99) / (PERCENT + 100))


def _may_reach(a: str, b: str) -> Column:
    """Length and positional filter for two entries of one list."""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.place"), F.col(f"{b}.n") - F.col(f"{b}.place"))
    return (small * 100 >= large * PERCENT) & (rest >= _needed(F.col(f"{a}.n"), F.col(f"{b}.n")))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets of hashes are; the suffix filter first."""
    bound = np.minimum(np.diff(np.searchsorted(a, PIVOTS), prepend=0, append=len(a)), np.diff(np.searchsorted(b, PIVOTS), prepend=0, append=len(b))).sum()
    if 100 * bound < PERCENT * (len(a) + len(b) - bound):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
        keep = [similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in pairs]
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs of classes that are similar. Fetches the sets of the classes in question only."""
    wanted = pairs.select("u").union(pairs.select("v")).distinct()
    sets = signed.select("set_key", "members").join(wanted, signed["set_key"] == wanted["u"], "left_semi")
    sets = sets.groupBy("set_key").agg(F.first("members").alias("members"))
    a = sets.select(F.col("set_key").alias("u"), F.col("members").alias("a"))
    b = sets.select(F.col("set_key").alias("v"), F.col("members").alias("b"))
    return pairs.join(a, "u").join(b, "v").mapInArrow(_verify, "u binary, v binary")


def class_links(signed: DataFrame, scratch: Scratch) -> DataFrame:
    """Links ``(u, v)`` between set keys that connect all similar classes."""
    bounded_batches(signed.sparkSession)
    classes = signed.where("prefix is not null").groupBy("set_key").agg(
        F.first("n_shingles").cast("int").alias("n"), F.first("prefix").alias("prefix"), F.first("places").alias("places")
    )
    postings = classes.select("set_key", "n", F.explode(F.arrays_zip("prefix", "places")).alias("e"))
    # ordered by place first, so that the smallest entry of a list is its head
    postings = postings.select(F.col("e.prefix").alias("h"), F.struct(F.col("e.places").alias("place"), "n", F.col("set_key").alias("key")).alias("x"))
    postings = scratch.table(postings, "ngram-postings")
    heads = postings.groupBy("h").agg(F.min("x").alias("head"), F.min("x.key").alias("lo"), F.max("x.key").alias("hi"))
    heads = heads.where("lo <> hi").select("h", "head")
    postings = scratch.table(postings.join(heads, "h"), "ngram-shared-postings")

    met = postings.where("x.key <> head.key").where(_may_reach("x", "head"))
    first = met.select(F.least("x.key", "head.key").alias("u"), F.greatest("x.key", "head.key").alias("v")).distinct()
    first = scratch.table(first, "ngram-pairs")
    first_links = scratch.table(_verified(first, signed), "ngram-links")

    member = components(first_links)
    placed = postings.join(member, F.col("x.key") == F.col("vertex"), "left")
    placed = placed.select("h", "x", F.coalesce("component", "x.key").alias("component"))
    mixed = placed.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("h")
    left = placed.join(mixed, "h", "left_semi")
    right = left.select(F.col("h").alias("h_r"), F.col("x").alias("y"), F.col("component").alias("component_r"))
    on = (left["h"] == right["h_r"]) & (F.col("x.key") < F.col("y.key")) & (F.col("component") != F.col("component_r"))
    on = on & _may_reach("x", "y")
    second = left.join(right, on).select(F.col("x.key").alias("u"), F.col("y.key").alias("v")).distinct()
    second = scratch.table(second.join(first, ["u", "v"], "left_anti"), "ngram-pairs")
    return first_links.union(_verified(second, signed))


def block_links(sets: list[np.ndarray], block: np.ndarray, i: int, j: int) -> np.ndarray:
    """Which sets are similar, between block ``i`` and block ``j``, as pairs of places in ``sets``; each pair once."""
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    sizes = np.array([len(x) for x in sets], np.int64)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, int(column[-1]) + 1, COLUMNS):
        at = slice(*np.searchsorted(column, [start, start + COLUMNS]))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[at], column[at] - start] = 1
        both += (held[left] @ held[right].T).astype(np.int64)
    linked = 100 * both >= PERCENT * (sizes[left][:, None] + sizes[right][None, :] - both)
    if i == j:
        linked = np.triu(linked, 1)
    a, b = np.nonzero(linked)
    return np.stack([left[a], right[b]], 1)


def _count_links(key: tuple, rows: pa.Table) -> pa.Table:
    """Rows of documents that each class of a pair of blocks is linked to within it."""
    _, i, j = (k.as_py() for k in key)
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("members").to_pylist()]
    pairs = block_links(sets, rows.column("block").to_numpy(), i, j)
    n_rows = rows.column("n_rows").to_numpy()
    found = np.zeros(len(sets), np.int64)
    np.add.at(found, pairs[:, 0], n_rows[pairs[:, 1]])
    np.add.at(found, pairs[:, 1], n_rows[pairs[:, 0]])
    return pa.table({"set_key": rows.column("set_key").cast(pa.binary()), "links": pa.array(found, pa.int64())}).filter(pa.array(found > 0))


def _class_link_counts(signed: DataFrame, member: DataFrame, block: int) -> DataFrame:
    """``(set_key, links)``: rows of the other classes that a class is similar to. Classes without any are absent."""
    sets = signed.where("members is not null").groupBy("set_key").agg(F.first("members").alias("members"), F.count(F.lit(1)).alias("n_rows"))
    sizes = member.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_blocks"))
    placed = salted_join(member, sizes, "component", F.xxhash64("vertex"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("vertex"), F.col("n_blocks")).cast("int"))
    placed = sets.join(placed, sets["set_key"] == placed["vertex"])
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    met = placed.select("set_key", "members", "n_rows", "block", "component", other.alias("other"))
    met = met.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")
    counted = met.groupBy("component", "i", "j").applyInArrow(_count_links, "set_key binary, links bigint")
    return counted.groupBy("set_key").agg(F.sum("links").alias("links"))


def _components_of_rows(docs: DataFrame, id_column: str, text_column: str, block: int | None = None) -> DataFrame:
    """doc_id, row_key, n_shingles, component (a key of the group; null without shingles), component_id of each row.

    With ``block`` also n_links, counted in blocks of so many classes.
    """
    with Scratch(docs.sparkSession) as scratch:
        signed = scratch.table(sign_documents(docs, id_column, text_column), "ngram-signed")
        release_shuffles(docs.sparkSession)  # the texts and hashes just exchanged
        member = components(class_links(signed, scratch))
        classes = signed.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_rows"))
        classes = classes.join(member, classes["set_key"] == member["vertex"], "left")
        classes = classes.select("set_key", "least", "n_rows", F.coalesce("component", "set_key").alias("component"))
        smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
        answer = classes.join(smallest, "component").select("set_key", "component", "component_id", "n_rows")
        counted = []
        if block:
            links = scratch.table(_class_link_counts(signed, member, block), "ngram-link-counts")
            answer = answer.join(links, "set_key", "left")
            answer = answer.withColumn("class_links", F.col("n_rows") - 1 + F.coalesce("links", F.lit(0))).drop("links")
            counted = [F.coalesce("class_links", F.lit(0)).cast("bigint").alias("n_links")]
        rows = salted_join(signed.select("doc_id", "row_key", "n_shingles", "set_key"), answer.drop("n_rows"), "set_key", F.col("row_key"))
        own = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return frozen(rows.select("doc_id", "row_key", "n_shingles", "component", own.alias("component_id"), *counted), "ngram-components")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) for each row."""
    found = _components_of_rows(docs, id_column, text_column)
    return found.select(F.col("doc_id").alias(id_column), "n_shingles", "component_id")


def linked_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block: int = BLOCK) -> DataFrame:
    """``near_duplicates`` with n_links, the number of other rows that are similar to a row, equal ones among them."""
    found = _components_of_rows(docs, id_column, text_column, block)
    return found.select(F.col("doc_id").alias(id_column), "n_shingles", "component_id", "n_links")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id.

    Rows without shingles all stay; of rows equal in id and text one stays.
    """
    found = _components_of_rows(docs, id_column, text_column)
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    chosen = found.where("component is not null").groupBy("component").agg(F.min(first).alias("x"))
    blank = found.where("component is null").select("doc_id", "row_key").distinct()
    keep = chosen.select("x.doc_id", "x.row_key").union(blank)
    # the texts are dealt once, by the row's hash, which serves the join and the equal rows alike
    keep = keep.groupBy("row_key").agg(F.collect_set(F.struct("doc_id")).alias("ids"))
    # the row travels in a struct, so no name of its columns meets one of these
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_column).alias("id"),
        F.xxhash64(F.col(id_column), F.coalesce(F.col(text_column), F.lit(""))).alias("row_key"),
    )
    kept = rows.join(keep, "row_key").where(F.exists("ids", lambda x: x["doc_id"].eqNullSafe(F.col("id"))))
    return kept.dropDuplicates(["row_key", "id"]).select("row.*")
