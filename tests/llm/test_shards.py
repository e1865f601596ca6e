"""The exchange of hashes and the merge of suffix runs over several steps."""

import functools
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from brute import near_duplicates, repeats
from tokenizers import Tokenizer

from termscape.llm import bpe, ngram_join, rolling, shards, suffix_dedup


def corpus(n: int, seed: int) -> list[tuple]:
    """Documents that share passages and words, among them copies, edited ones, nulls and empty ones."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(300)]
    passages = [" ".join(rng.choices(words, k=60)) for _ in range(4)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(20, 80)))
        if i % 3 == 0:
            text += " " + rng.choice(passages) + " " + " ".join(rng.choices(words, k=10))
        if i % 7 == 0 and rows:
            text = rng.choice(rows)[1] or ""
            text = text.replace(" ", "  ", 1) if i % 2 else text + " end"
        rows.append((i, text))
    return rows + [(n, None), (n + 1, ""), (n + 1, "")]


@pytest.fixture
def small_steps(monkeypatch):
    """Shards of a document or two, many counters, four ranges a step."""
    monkeypatch.setattr(shards, "dealt", functools.partial(shards.dealt, shard_bytes=600))
    monkeypatch.setattr(shards, "COUNTER_HASHES", 1 << 18)
    monkeypatch.setattr(shards, "FAN_BITS", 2)


def test_steps_are_few_and_even():
    assert [shards.steps_of(b) for b in (4, 8, 9, 13, 16, 23)] == [(4,), (8,), (5, 4), (7, 6), (8, 8), (8, 8, 7)]
    assert shards.counter_steps(1, 1) == (4,)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for high in (1 << 8, 1 << 32, 1 << 45):
        values = np.unique(rng.integers(0, high, 500, dtype=np.uint64))
        assert (shards.unpack(shards.pack(values)) == values).all()
    low = np.array([0, 7, (1 << 32) - 1], np.uint64)
    assert shards.unpack(shards.pack(low), np.uint32).tolist() == low.tolist()
    assert len(shards.unpack(shards.pack(np.zeros(0, np.uint64)))) == 0


def test_counts_over_steps_equal_plain_counts(spark, small_steps):
    rows = corpus(60, 3)
    docs, n = shards.dealt(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    steps = (2, 2, 1)

    def hasher(table):
        return np.array([xxhash.xxh3_64_intdigest(w.encode()) for t in table.column("text").to_pylist() for w in t.split()], np.uint64)

    answers = shards.shared_counts(docs, hasher, steps)

    def read(key, table, told):
        hashes = hasher(table)
        counts = shards.counts_of(hashes, steps, told) if len(hashes) else hashes
        return pa.table({"h": pa.array(hashes.astype(np.int64)), "n": pa.array(counts.astype(np.int64))})

    found = docs.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(read, "h long, n long")
    plain = {}
    for _, text in rows:
        for word in (text or "").split():
            h = int(np.uint64(xxhash.xxh3_64_intdigest(word.encode())).astype(np.int64))
            plain[h] = plain.get(h, 0) + 1
    got = found.collect()
    assert n > 20 and len(got) == sum(plain.values())
    assert {(r.h, r.n) for r in got} == set(plain.items())


def test_rows_of_the_exchange_grow_with_the_input(spark, small_steps, monkeypatch):
    """At a fixed shard size the rows sent per shard stay bounded in every step, whatever the input."""
    seen, asked_of, merged_of = [], shards.answered, suffix_dedup.merged_masks

    def counted(kind, plain):
        def run(rows, steps, *more):
            rows = rows.cache()  # computed once, not for every step that follows
            seen.append((kind, rows.count()))
            return plain(rows, steps, *more)

        return run

    monkeypatch.setattr(shards, "answered", counted("question", asked_of))
    monkeypatch.setattr(suffix_dedup, "merged_masks", counted("run", merged_of))
    rng = random.Random(5)
    passages = ["".join(rng.choices("abcdefgh ", k=500)) for _ in range(8)]
    most = {}
    for size in (15, 60, 240):
        seen.clear()
        rows = [(i, rng.choice(passages) + rng.choice(passages)) for i in range(size)]
        suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
        n_shards = -(-1000 * size // 600)
        most[size] = {kind: max(n for k, n in seen if k == kind) / n_shards for kind in ("question", "run")}
        # a step's last group of shards may be a partial one
        assert all(n <= (n_shards + 4) * 2**shards.FAN_BITS for _, n in seen)
    assert len([k for k, _ in seen if k == "run"]) >= 5
    for kind in ("question", "run"):
        assert 0.8 * most[15][kind] <= most[240][kind] <= 1.2 * most[15][kind]


def test_suffix_dedup_over_steps_equals_brute_force(spark, small_steps):
    rows = corpus(90, 7)
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = [(i, *r) for (i, _), r in zip(rows, repeats([t for _, t in rows]), strict=True)]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert sum(r.n_removed > 0 for r in found) > 20


def test_ngram_join_over_steps_equals_all_pairs(spark, small_steps):
    rows = corpus(70, 11)
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=repr) == near_duplicates(rows)


def test_bpe_over_steps_equals_the_tokenizers_library(spark, small_steps):
    rows = corpus(40, 13)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    found = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert sorted((r.doc_id, list(r.ids)) for r in found) == sorted(expected)


def test_hashes_of_rows_are_those_of_grams():
    data = np.random.default_rng(2).integers(0, 256, 400).astype(np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(data, 128)
    assert (rolling.row_hashes(rows) == rolling.gram_hashes(data, 128)).all()
