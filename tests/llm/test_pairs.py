"""N-gram join, suffix dedup and pivot index against comparing everything with everything."""

import random

import numpy as np
import pytest
from brute import near_duplicates, repeats, shingles

from termscape.llm import components, embedding_index, ngram_join, suffix_dedup

DOCS = "doc_id bigint, text string, source string, shard int, n_shingles string"


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "s", 1, "x") for i, t in rows], DOCS)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def families():
    rng = random.Random(4)
    rows = [(None, "Same old Text here"), (900, "same OLD text here"), (901, "same old text here x"), (902, ""), (903, None), (904, " \t\n"), (905, "ÄRGER ärger a b c d"), (906, "ärger ärger a b c d")]
    for family in range(6):
        base = [f"w{family}x{rng.randrange(400)}" for _ in range(rng.choice([6, 40, 150]))]
        for _ in range(rng.randrange(2, 12)):
            rows.append((len(rows), edited(rng, base, rng.randrange(0, 1 + len(base) // 12))))
        rows += [(len(rows), " ".join(base))] * 2 + [(len(rows) + 1, " ".join(base).upper())]
    common = " ".join(f"common{i}" for i in range(30))
    rows += [(2000 + i, common + " " + " ".join(f"own{i}_{k}" for k in range(i * 2))) for i in range(12)]
    rows.append((3000, " ".join(f"long{k % 5000}" for k in range(20000))))
    return rows


def test_ngram_join_equals_all_pairs(spark, families):
    found = ngram_join.near_duplicates(frame(spark, families))
    assert sorted(map(tuple, found.collect()), key=repr) == near_duplicates(families)


@pytest.mark.parametrize("block", [2, 256])
def test_ngram_join_counts_every_link(spark, families, block):
    sets = [shingles(t) for _, t in families]
    links = [sum(bool(a) and i != j and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    expected = sorted(((d, len(x), n) for (d, _), x, n in zip(families, sets, links, strict=True)), key=repr)
    found = ngram_join.linked_duplicates(frame(spark, families), block=block)
    assert sorted(((r["doc_id"], r["n_shingles"], r["n_links"]) for r in found.collect()), key=repr) == expected
    assert sorted(map(tuple, found.drop("n_links").collect()), key=repr) == near_duplicates(families)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0
    assert ngram_join.keep_one(frame(spark, [])).count() == 0


def test_keep_one_per_component(spark, families):
    docs = frame(spark, families)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    expected = near_duplicates(families)
    blank = sum(size == 0 for _, size, _ in expected)
    # the component without a numbered row is that of (None, ...), which 900 joins
    assert len(left) == blank + len({c for _, size, c in expected if size})
    assert len(set(left)) == len(left)


def test_needed_intersection(spark):
    from pyspark.sql import functions as F

    pairs = spark.createDataFrame([(a, b) for a in range(1, 40) for b in range(1, 40)], "a int, b int")
    for r in pairs.withColumn("o", ngram_join._needed(F.col("a"), F.col("b"))).collect():
        assert r["o"] == -(-80 * (r["a"] + r["b"]) // 180)


def test_suffix_filter_never_rejects_a_similar_pair():
    rng = np.random.RandomState(2)
    for _ in range(200):
        base = np.unique(rng.randint(0, 1 << 63, rng.randint(5, 300), dtype=np.uint64) * np.uint64(2))
        other = np.unique(np.concatenate([base[rng.rand(len(base)) > 0.1], rng.randint(0, 1 << 63, rng.randint(0, 40), dtype=np.uint64)]))
        both = len(np.intersect1d(base, other))
        assert ngram_join.similar(base, other) == (100 * both >= 80 * (len(base) + len(other) - both))


def passages(rng, alphabet):
    base = "".join(rng.choice(alphabet) for _ in range(3000))
    texts = []
    for _ in range(rng.randrange(2, 20)):
        pieces = []
        for _ in range(rng.randrange(0, 6)):
            start = rng.randrange(0, 2600)
            pieces.append(base[start : start + rng.choice([150, 190, 199, 200, 201, 210, 400])] if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(500))))
        texts.append("".join(pieces))
    return texts


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh é\n", "漢字かな 🙂"])
def test_suffix_dedup_equals_brute_force(spark, alphabet):
    rng = random.Random(len(alphabet))
    texts = [t for _ in range(6) for t in passages(rng, alphabet)]
    texts += [None, "", "x" * 199, "y" * 200, "z" * 201, texts[0], texts[0], "long tail " * 3000]
    rows = [(i % 40 if i % 9 else None, t) for i, t in enumerate(texts)]
    found = suffix_dedup.remove_repeats(frame(spark, rows))
    expected = [(i, *r) for (i, _), r in zip(rows, repeats(texts), strict=True)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_cut_repeats_keeps_columns(spark):
    passage = "".join(chr(97 + (i * i) % 26) for i in range(300)) + "é"
    rows = [(1, "own start " + passage), (2, passage), (3, None), (4, "clean text"), (None, "")]
    docs = frame(spark, rows)
    cut = suffix_dedup.cut_repeats(docs)
    assert cut.dtypes == docs.dtypes
    assert sorted(((r["doc_id"], r["text"]) for r in cut.collect()), key=repr) == [(1, "own start "), (3, None), (4, "clean text"), (None, "")]
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_merge_never_loses_order():
    rng = random.Random(9)
    for k in (1, 2, 3, 7, 16):
        runs = []
        for _ in range(k):
            strings = sorted("".join(rng.choice("ab") for _ in range(rng.randrange(0, 12))).encode() for _ in range(rng.randrange(0, 30)))
            shared = [0] + [suffix_dedup.common_prefix(a, b, 0) for a, b in zip(strings, strings[1:], strict=False)]
            runs.append((strings, shared[: len(strings)]))
        from_run, at, shared = suffix_dedup.merge_runs(runs)
        merged = [runs[r][0][i] for r, i in zip(from_run, at, strict=True)]
        assert merged == sorted(s for strings, _ in runs for s in strings)
        assert shared[1:] == [suffix_dedup.common_prefix(a, b, 0) for a, b in zip(merged, merged[1:], strict=False)]


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 9), (20, 21), (21, 22), (22, 20), (7, 7), (None, 1)] + [(100 + i, 101 + i) for i in range(50)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    assert found == {**{i: 3 for i in (3, 4, 5, 9)}, **{i: 20 for i in (20, 21, 22)}, **{i: 100 for i in range(100, 151)}}


def vectors(rng, n_groups):
    rows = []
    for _ in range(n_groups):
        centre = rng.normal(size=32)
        for _ in range(rng.randint(1, 9)):
            rows.append((centre + rng.normal(size=32) * 0.2 * rng.rand()).tolist())
    return rows


def test_pivot_index_recall_and_precision(spark):
    rng = np.random.RandomState(3)
    rows = vectors(rng, 150) + [[0.5] * 32] * 30
    odd = [None, [], [0.0] * 32, [1.0] * 31 + [None], [1.0] * 31 + [float("nan")], [float("inf")] * 32, [1.0] * 16]
    data = [(i, v, 3) for i, v in enumerate(rows)] + [(5000 + i, v, 3) for i, v in enumerate(odd)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, n int")
    # blocks smaller than the lists, so that pairs of blocks are tried
    found = {r["vec_id"]: r for r in embedding_index.near_duplicates(df, n_pivots=64, block=16).collect()}
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = np.array([found[i]["n_links"] for i in range(len(rows))])
    assert (links <= near.sum(1)).all()
    assert links.sum() >= 0.9 * near.sum()
    assert (links[-30:] >= 29).all()
    for i in range(len(odd)):
        r = found[5000 + i]
        assert (r["n_links"], r["component_id"], r["kept"]) == (0, 5000 + i, True)
    for i in range(len(rows)):
        assert found[i]["component_id"] <= i and found[i]["kept"] == (found[i]["component_id"] == i)


def test_pivot_index_in_a_dense_cluster(spark):
    """Most vectors lie in one cluster, which must not hold most of the pivots."""
    rng = np.random.RandomState(6)
    centre = rng.normal(size=64)
    rows = [(centre + rng.normal(size=64) * 0.3).tolist() for _ in range(400)] + rng.normal(size=(200, 64)).tolist()
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id bigint, embedding array<double>")
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    found = embedding_index.near_duplicates(df, block=100).agg({"n_links": "sum"}).first()[0]
    assert near.sum() > 10_000 and 0.9 * near.sum() <= found <= near.sum()
    only = spark.createDataFrame(list(enumerate(rows[:400])), "vec_id bigint, embedding array<double>")
    assert embedding_index.near_duplicates(only).agg({"n_links": "sum"}).first()[0] == near[:400, :400].sum()


def test_pivot_index_of_nothing(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert embedding_index.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    lone = spark.createDataFrame([(None, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])], schema)
    assert sorted(map(tuple, embedding_index.near_duplicates(lone).collect()), key=repr) == [(3, 2, 3, True), (3, 2, 3, True), (None, 2, 3, False)]


@pytest.mark.parametrize("shared", [0.0, 0.69])
def test_pivot_index_with_a_common_direction(spark, shared):
    """Recall, and candidates of a vector, at three sizes, also where any two vectors have a cosine of some 0.69."""
    rng = np.random.RandomState(8)
    per_vector = []
    for size in (750, 1500, 3000):
        base = rng.normal(size=(size, 64))
        base /= np.linalg.norm(base, axis=1, keepdims=True)
        near = base[: size // 2] + rng.normal(size=(size // 2, 64)) * rng.uniform(0.1, 1.2, (size // 2, 1)) / 8
        rest = np.vstack([base, near / np.linalg.norm(near, axis=1, keepdims=True)])
        rows = np.sqrt(1 - shared) * rest
        rows[:, 0] += np.sqrt(shared)
        unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        links = unit @ unit.T >= 0.9
        np.fill_diagonal(links, False)
        df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(rows)], "vec_id bigint, embedding array<double>")
        found = embedding_index.near_duplicates(df).agg({"n_links": "sum"}).first()[0]
        assert 0.9 * links.sum() <= found <= links.sum()
        pivots, centre = embedding_index.choose_pivots(df, "embedding", embedding_index.pivots_for(len(rows)))
        described = embedding_index.describe(df, pivots, centre, "vec_id", "embedding").toPandas()
        shares = embedding_index.shared_pivots(*[np.stack(described["pivots"])] * 2) >= embedding_index.MIN_SHARED
        per_vector.append((shares.sum() - len(rows)) / len(rows))
    # all pairs would be four times as many at four times the size
    assert per_vector[-1] < 2 * per_vector[0] and per_vector[-1] < 0.1 * len(rows), per_vector
