"""The pipeline stage by stage, each against a brute-force version on its own input."""

import random

import public_tokenizers
import pytest
from brute import base_rules, near_duplicates, repeats
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from termscape.llm import mixing
from termscape.session import frozen

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(docs before, result) of each stage."""
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        found[name] = docs, after
        docs = after
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_return_documents(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        before, after = stages[name]
        assert before.dtypes == after.dtypes and 0 < after.count()


def test_quality_stage(stages):
    before, after = map(texts, stages["quality rules"])
    assert set(after.items()) <= set(before.items()) and len(after) < len(before)
    assert not any(base_rules(t)[-1] for t in after.values())


def test_join_stage(stages):
    before, after = map(texts, stages["n-gram jaccard join"])
    expected = near_duplicates(list(before.items()))
    assert after == {i: before[i] for i, _, component in expected if i == component}


def test_suffix_stage(stages):
    before, after = stages["suffix-array dedup"]
    rows, left = texts(before), texts(after)
    for (i, text), (n_bytes, removed, _, _) in zip(rows.items(), repeats(list(rows.values())), strict=True):
        if removed == n_bytes:
            assert i not in left
        elif not removed:
            assert left[i] == text
        else:
            assert 0 <= n_bytes - removed - len(left.get(i, "").encode()) < 40
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    assert set(texts(before)) == set(texts(after)) and after.count() >= before.count()


def test_encoding_stage(stages):
    before, after = stages["bpe encoding"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    source = texts(before)
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows:
        assert r["round_trip"] and r["ids"] == library.encode(source[r["doc_id"]], add_special_tokens=False).ids


def test_run_is_the_stages(spark, stages):
    final = corpus_pipeline.run(spark, FOLDER)
    expected = stages["bpe encoding"][1]
    assert sorted(map(repr, final.collect())) == sorted(map(repr, expected.collect()))


#: Names that the stages use inside, or give to what they find.
INSIDE = (
    "row_key _row_key _times _copy _row _ids _own _id _text ratio n_words kept kept_text was_cut carried shard row ids id text_key "
    "component component_id block position epoch n_tokens x start order range odd.name"
).split()


def test_stages_carry_any_column_name_null_and_repeated_row(spark):
    rng = random.Random(5)
    base = [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(150)) for _ in range(12)]
    texts = [*base, base[0] + " and more", None, "", base[1], "too few words", "\x1fv" + base[2], "word " * 3000]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["a", "b", None]), 1) for i, t in enumerate(texts)]
    rows += [(1, base[1], "en", "a", 1)] * 5 + [(None, base[3] + " x", None, None, None)] * 2 + [(None, None, None, None, None)]
    names = ", ".join(f"`{n}` string" for n in INSIDE)
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {names}"
    # the value of a name tells the row it came with
    docs = spark.createDataFrame([(*r, *[f"{n} of {r[0]}" for n in INSIDE]) for r in rows], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = frozen(stage(spark, docs, FOLDER), "stage")
        assert after.dtypes == docs.dtypes, name
        found = after.collect()
        assert found and all(r[n] == f"{n} of {r['doc_id']}" for r in found for n in INSIDE), name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name
        docs = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == docs.count() and last.where("not round_trip").count() == 0


def test_mixing_writes_in_the_order_of_the_plan(spark):
    docs = spark.createDataFrame([(i, f"text of {i} " * (i % 7 + 1), "ab"[i % 3 == 0]) for i in range(300)], "doc_id bigint, text string, source string")
    plan = mixing.mix(docs, block_tokens=200, key_columns=docs.columns)
    read = [r["doc_id"] for r in frozen(mixing.apply_plan(docs, plan, docs.columns).coalesce(1), "read").collect()]
    assert read == [r["doc_id"] for r in plan.orderBy("block", "position").collect()] and len(read) > 300
    assert plan.agg({"block": "max"}).first()[0] > 3


def test_every_operator_has_a_query():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
