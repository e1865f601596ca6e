"""Quality rules, BPE, chat formatting, licence scan, URL filters, mixing and classifier."""

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import zstandard
from brute import base_rules, compression_verdict
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termscape.llm import bpe, chat, license_scan, mixing, quality_classifier, quality_rules, url_filters

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " \n\t", "one two", "a b c d e f g h i j k", "the cat sat on the mat " * 40, "x\x0by\x0cz\x85w\xa0v\n\nx\n x\nx", "#*$%&|<> " * 12, "é漢🙂 " * 30]


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_quality_rules_equal_brute_force(spark):
    rng = random.Random(1)
    texts = TEXTS + [prose(rng, n) for n in (12, 100, 2000, 40000)] + ["\n".join(rng.choice(["a b", "c d e", " ", ""]) for _ in range(60))]
    texts += [" ".join(rng.choice("abcd") for _ in range(n)) for n in (5, 6, 20, 60)]
    # about each edge of a band: prose, prose with a third and a half of it one line, letters at random
    texts += [prose(rng, 400)[:n] for n in (199, 200, 201, 999, 1000, 1001, 2047, 2048)]
    texts += [prose(rng, 1500)[:n] for n in (4000, 4001, 4096, 6144)]
    texts += [prose(rng, 900)[:4096] + "\n" + "x y z. " * n + prose(rng, 300) for n in (200, 300, 900)]
    texts += [" ".join("".join(chr(rng.randrange(0x100, 0x3000)) for _ in range(9)) for _ in range(n)) for n in (12, 60, 400)]
    rows = [(i, t, 7, "clash") for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, other int, n_words string")
    found = quality_rules.judge_quality(df).collect()
    assert len(found) == len(rows)
    compressor = zstandard.ZstdCompressor(level=3)
    for r in found:
        text = texts[r["doc_id"]]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == base_rules(text)
        raw = (text or "").encode()
        assert r["ratio"] == (len(raw) / len(compressor.compress(raw)) if raw else 0.0)
        assert (r["n_chunks"], r["n_odd_chunks"], r["kept"]) == compression_verdict(text) and r["other"] == 7
    assert len({(r["base_failed"], r["kept"]) for r in found}) == 3 and any(0 < r["n_odd_chunks"] < r["n_chunks"] for r in found)


def test_quality_rules_keep_prose_and_reject_patterns(spark):
    rng = random.Random(2)
    good = [prose(rng, n) for n in (30, 300, 5000)]
    pattern = " ".join(f"row {i // 40} of table {i % 40}" for i in range(3000))
    noise = " ".join("".join(chr(rng.randrange(0x100, 0x2000)) for _ in range(12)) for _ in range(2000))
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*good, pattern, noise])], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in quality_rules.keep_good(df).collect()) == [0, 1, 2]
    assert quality_rules.keep_good(df.limit(0)).count() == 0


def reference(text):
    return Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids


def test_bpe_equals_the_tokenizers_library(spark):
    rng = random.Random(3)
    shared = prose(rng, 900)
    texts = [t or "" for t in TEXTS] + [prose(rng, 300) + " " + shared + prose(rng, 50), shared, shared + "<|endoftext|>" + shared[:3000], "ab" * 9000 + shared, "ab" * 9000, " " * 5000 + "\r\n" * 300 + shared]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, None, "y"), (3, texts[3], "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    found = bpe.encode(df, VOCABULARY).collect()
    assert len(found) == len(rows) and all(r["round_trip"] for r in found)
    library = Tokenizer.from_file(VOCABULARY)
    for r in found:
        expected = reference(texts[r["doc_id"]]) if r["doc_id"] is not None else []
        assert r["ids"] == expected and r["n_tokens"] == len(expected)
    digests = {r["doc_id"]: r for r in bpe.encoding_digests(df.where("doc_id > 8"), VOCABULARY).collect()}
    for i, r in digests.items():
        ids = reference(texts[i])
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    back = bpe.decode(bpe.encode(df, VOCABULARY), VOCABULARY).where("doc_id is not null").collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == sorted((i, t) for i, t, _ in rows if i is not None)
    assert bpe.encode(df.limit(0), VOCABULARY).count() == 0


def test_bpe_joins_at_any_place():
    rng, own = random.Random(5), bpe.Codec(VOCABULARY)
    kinds = ["ab c", "abcdefgh  \n\n", "é ü 漢字 　 a", "a", "  \n\t 'rellsd", "<|endoftext|> x1", "12 3,. ' "]
    for _ in range(300):
        kind = rng.choice(kinds)
        text = "".join(rng.choice(kind) if rng.random() < 0.95 else rng.choice(["<|endoftext|>", "'re", "   "]) for _ in range(rng.randrange(300)))
        raw = text.encode()
        cuts = sorted({len(text[: rng.randrange(len(text) + 1)].encode()) for _ in range(rng.randrange(10))} | {len(raw)})
        pieces = [own.encode(c) for c in bpe._pieces(raw, [c for c in cuts if c])]
        assert bpe.stitch(raw, pieces, own).tolist() == reference(text)


def test_chunks_are_cut_by_content():
    rng = random.Random(6)
    shared = prose(rng, 3000).encode()
    ends = bpe.chunk_ends([prose(rng, 700).encode() + shared, shared, b"", b"a" * 30000, "é".encode() * 9000])
    first, second = (set(bpe._pieces(raw, e)) for raw, e in zip([prose(rng, 0).encode(), shared], [[], ends[1]], strict=True))
    assert not first and len(second) > 5
    assert ends[2] == [] and max(np.diff([0, *ends[3]])) <= bpe.MAX_CHUNK
    assert all(c % 2 == 0 for c in ends[4])


def test_chat_round_trip_with_parts(spark):
    nasty = r"\### Assistant: </turn> ok <turn user> \b\l\g <image 0> \\"
    text = lambda t: ("text", t, None, None, None, None, None)
    rows = [
        (1, 0, "user", [text(nasty), ("image", None, "a.png", 100, 57, None, None), text("tail")]),
        (1, 1, "assistant", [text("fine "), ("audio", None, "b.wav", None, None, 2.01, None), ("document", None, "c.pdf", None, None, None, 3), None, ("odd", None, "d", None, None, None, None)]),
        (2, None, None, None),
        (None, 5, "assistant", [text(None)]),
        (2, 3, "assistant", [text(nasty)]),
        (2, 3, "assistant", [text(nasty)]),
        (2, 3, "ass>istant", [text("x" * 50000)]),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], f"conv_id bigint, turn bigint, role string, parts array<{chat.PART_TYPE}>, segment string")
    formatted = chat.format_turns(df)
    by_turn = {(r["conv_id"], r["turn"]): r for r in formatted.collect()}
    first = by_turn[1, 0]
    assert [(a["place"], a["kind"], a["ref"], a["tokens"]) for a in first["attachments"]] == [(1, "image", "a.png", 12)]
    assert "<image 1>" in first["segment"] and first["loss_chars"] == 0
    second = by_turn[1, 1]
    assert second["expanded_tokens"] == 51 + 1800 and second["segment"].endswith("<audio 1><document 2><odd 3></turn>\n")
    back = chat.read_back(formatted).collect()
    assert sorted(r["text"] for r in back if r["conv_id"] == 2) == sorted(["", nasty, nasty, "x" * 50000])
    assert {r["role"] for r in back} == {"user", "assistant", "ass>istant", ""}
    digests = {r["conv_id"]: r for r in chat.conversation_digests(formatted).collect()}
    assert digests[2]["n_turns"] == 4 and digests[2]["loss_chars"] == 2 * len(nasty)
    assert digests[2]["loss_sha256"] == hashlib.sha256((nasty * 2).encode()).hexdigest()
    spoken = "\n\n" + "ass>istant\n" + "x" * 50000 + "\n" + f"assistant\n{nasty}\n" * 2
    assert digests[2]["turns_sha256"] == hashlib.sha256(spoken.encode()).hexdigest()
    assert digests[None]["n_turns"] == 1 and chat.conversation_digests(formatted.limit(0)).count() == 0


def test_license_inheritance(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "LICENSE", mit + "\n" + "unrelated words " * 50),
        (2, "a/b/notice.txt", apache),
        (3, "a/b/c/d.py", "code\ncode"),
        (4, "a/x.py", "code"),
        (5, "a/b/c/own.py", "intro words\n" + mit + "\nmore words " + "z " * 30000),
        (6, None, "code"),
        (7, None, mit),
        (8, "q/y.py", None),
        (8, "q/y.py", None),
        (None, "a/b/c/e.py", ""),
        (9, "ab/z.py", "The license of the general public work"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, path string, text string, file int")
    found = license_scan.scan(df).collect()
    assert len(found) == len(rows)
    got = {(r["doc_id"], r["path"]): (r["own_license"], r["inherited_license"], r["inherited_from"], r["license"]) for r in found}
    assert got[2, "a/b/notice.txt"] == ("Apache-2.0", None, None, "Apache-2.0")
    assert got[3, "a/b/c/d.py"] == (None, "Apache-2.0", "a/b", "Apache-2.0") == got[None, "a/b/c/e.py"]
    assert got[4, "a/x.py"] == (None, "MIT", "", "MIT") == got[8, "q/y.py"] == got[9, "ab/z.py"]
    assert got[5, "a/b/c/own.py"] == ("MIT", None, None, "MIT") == got[7, None]
    assert got[6, None] == (None, None, None, None)
    assert license_scan.scan(df.limit(0)).count() == 0


def test_license_headers_inline_statements_and_texts(spark):
    """None of these is a line of a template."""
    mit = license_scan._MIT.replace(". ", ".\n")
    bsd = [text for name, kind, text in license_scan.NOTICES if name == "BSD-3-Clause" and kind == license_scan.TEXT][0]
    gpl = "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version {} of the License, or\n * (at your option) any later version.\n */\nint main() {{}}"
    files = {
        "a/1.c": ("Copyright (c) 2015 Example Corp. All rights reserved.", "proprietary"),
        "a/2.c": ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
        "a/3.c": ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
        "a/4.c": ("# Licensed under the Apache\n# License, Version 2.0 (the \"License\");\n# you may not use this file", "Apache-2.0"),
        "a/5.c": (gpl.format(3) + " filler" * 3000, "GPL-3.0"),
        "a/6.c": (gpl.format(2), "GPL-2.0"),
        "a/7.c": ("The tool by Jo, first shown in May, is released under the MIT License, see the site for more.", "MIT"),
        "a/8.c": ("Copyright (c) 2020, Jo\nAll rights reserved.\n\n" + bsd[:900] + " code" * 3000, "BSD-3-Clause"),
        "a/9.c": ("This work is under a Creative Commons Attribution-ShareAlike 4.0 International license.", "CC-BY-SA-4.0"),
        "b/COPYRIGHT": ("MIT License\n\nCopyright (c) 2020 Jo Doe\n\n" + mit, "MIT"),
        "c/terms": ("Copyright (c) 2020, Jo\nAll rights reserved.\n\n" + bsd, "BSD-3-Clause"),
        "d/text": ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n" + " prose" * 5000, "GPL-3.0"),
        "e/MIT.c": ("MIT License", "MIT"),
        "f/1.c": ("The version of the license that the public works with is general, as any later software is.", None),
        "f/3.c": ("Er kam. Mit. MIT!! Ohne.\nMit\nmit", None),
        "f/2.c": ("SPDX-License-Identifier: LicenseRef-Own", None),
    }
    inherit = {"b/x/1.c": "MIT", "c/1.c": "BSD-3-Clause", "d/y/z/1.c": "GPL-3.0", "e/1.c": None, "a/plain.c": None}
    rows = [(i, path, text) for i, (path, (text, _)) in enumerate(files.items())] + [(100, path, "code") for path in inherit]
    rows += [(200, "z/other", f"prose {i}") for i in range(50)]
    found = {r["path"]: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, path string, text string")).collect()}
    assert {path: found[path]["own_license"] for path in files} == {path: name for path, (_, name) in files.items()}
    assert {path: found[path]["inherited_license"] for path in inherit} == inherit


def test_license_anchors_lose_nothing():
    rows, idf, other, anchors = license_scan.template_weights({"license": 50, "the": 900}, 1000, license_scan.TEMPLATES)
    for number in {r[1] for r in rows}:
        rest = sum(share * share for token, n, _, share in rows if n == number and token not in anchors)
        assert rest < license_scan.MIN_COSINE**2


def test_url_rules(spark):
    urls = {
        "http://Sub.Example.ORG/en/1x?q": ("sub.example.org", "/en/1x", "example.org/en/1", "block"),
        "http://example.org/es/": ("example.org", "/es/", "example.org/es/", "block"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://x.com/de/y": ("x.com", "/de/y", "com/de/", "block"),
        "http://com/fr/": ("com", "/fr/", "com/fr/", "allow"),
        "http://x.com/DE/": ("x.com", "/DE/", None, "allow"),
        "http://org": ("org", "", None, "allow"),
        "http://x.net/wp-admin/z": ("x.net", "/wp-admin/z", None, "block"),
        "http://x.org/WP-login.php": ("x.org", "/WP-login.php", "org/", "allow"),
        "http://x.net/login/a?redirect=b": ("x.net", "/login/a", None, "block"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "ftp://a\nb.org/é#x://": ("a\nb.org", "/é", "org/", "allow"),
        "http://x.net/" + "a" * 100000: ("x.net", "/" + "a" * 100000, None, "allow"),
    }
    rows = [(i, u, "h") for i, u in enumerate(urls)] * 2 + [(None, None, "h")]
    found = url_filters.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, host string"))
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()]
    expected = [(i, *v) for i, v in enumerate(urls.values())] * 2 + [(None, "", "", None, "allow")]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert found.limit(0).count() == 0 and url_filters.judge_urls(found.select("page_id", F.col("host").alias("url")).limit(0)).count() == 0


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(0, 60)), f"s{min(int(rng.expovariate(0.6)), 6)}", "p") for i in range(900)]
    rows += [(None, None, None, "p"), (900, "a b", None, "p"), (901, "", "empty", "p"), (5, rows[5][1], rows[5][2], "p")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, epoch string")


def test_mixing_realises_weights(spark, sources):
    target = mixing.Target(entropy=0.99, repeats=3.0)
    plan = mixing.mix(sources, target, block_tokens=2000)
    rows = plan.collect()
    times: dict = {}
    for r in rows:
        times[r["row_key"]] = times.get(r["row_key"], 0) + 1
    n_keys = sources.select("doc_id", "text").distinct().count()
    assert len(times) == n_keys  # nothing is left out
    held = {r["source"]: r["t"] for r in mixing.token_counts(sources, "doc_id", "text", "source", ["doc_id", "text"]).groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    read: dict = {}
    for r in rows:
        read[r["source"]] = read.get(r["source"], 0) + r["n_tokens"]
    ratios = {s: read[s] / held[s] for s in held if held[s]}
    assert min(ratios.values()) >= 1 and max(ratios.values()) <= 3.0 + 60 / min(t for t in held.values() if t)
    blocks: dict = {}
    for r in rows:
        blocks.setdefault(r["block"], []).append(r["position"])
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in blocks.values())
    budget = sum(read.values())
    assert abs(len(blocks) - budget / 2000) <= 2
    assert mixing.mix(sources.limit(0)).count() == 0


def test_mixing_exponent_meets_its_targets(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "source string, tokens bigint")
    a = mixing.exponent(totals, mixing.Target(entropy=0.0, repeats=4.0))
    assert a == pytest.approx(1.0)  # any entropy will do: as the sources come
    a = mixing.exponent(totals, mixing.Target(entropy=1.0, repeats=4.0))
    assert 100 ** (1 - a) == pytest.approx(4.0)
    a = mixing.exponent(totals, mixing.Target(entropy=0.9, repeats=1e9))
    p = np.array([1000, 100, 10]) ** a
    p /= p.sum()
    assert -(p * np.log(p)).sum() == pytest.approx(0.9 * np.log(3))


def test_apply_plan_repeats_rows(spark, sources):
    plan = mixing.mix(sources, mixing.Target(entropy=0.99, repeats=2.0), key_columns=sources.columns)
    read = mixing.apply_plan(sources, plan, sources.columns)
    assert read.dtypes == sources.dtypes and read.count() == plan.count()
    assert read.distinct().count() == sources.distinct().count()


def test_classifier_holds_out(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        words = prose(rng, rng.randrange(20, 80)).split()
        grade = rng.choice([0, 1, 2, 2, 2])
        if grade == 0:
            words = [w.upper() + "!!" for w in words]
        if grade == 1:
            words[3:3] = ["vileword"] * 2
        rows.append((i, " ".join(words), grade))
    docs = spark.createDataFrame([(i, t, 0) for i, t, _ in rows] + [(5000, None, 0), (5000, "", 0), (None, "x " * 30000, 0)], "doc_id bigint, text string, kept int")
    grades = spark.createDataFrame([(i, g) for i, _, g in rows[:600]] + [(3, None), (None, 2), (99999, 1), (4, 2)], "doc_id bigint, grade int")
    scored = {r["doc_id"]: r for r in quality_classifier.score(docs, quality_classifier.fit(docs, grades)).collect()}
    held_out = rows[600:]
    assert np.mean([scored[i]["kept"] == (g == 2) for i, _, g in held_out]) > 0.95
    means = [np.mean([scored[i]["expected_grade"] for i, _, g in held_out if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]
    for grade in (0, 2):
        same = quality_classifier.score(docs, quality_classifier.fit(docs, grades.where(f"grade = {grade}"))).collect()
        assert {(r["expected_grade"], r["p_best"], r["kept"]) for r in same} == {(float(grade), 1.0, True)} and len(same) == len(rows) + 3
    for no_docs, no_grades in ((docs, grades.limit(0)), (docs, grades.where("grade is null")), (docs.limit(0), grades)):
        unknown = quality_classifier.score(docs, quality_classifier.fit(no_docs, no_grades)).collect()
        assert {(r["expected_grade"], r["p_best"], r["kept"]) for r in unknown} == {(None, None, None)} and len(unknown) == len(rows) + 3
    assert quality_classifier.score(docs.limit(0), quality_classifier.fit(docs, grades, max_rows=200)).count() == 0


def penalised_loss(weights, thresholds, rows, grades):
    """Mean negative log likelihood of a cumulative-link model, term by term, and the penalty."""
    total = 0.0
    for row, grade in zip(rows, grades, strict=True):
        score = sum(weights[f] * x for f, x in row.items())
        below = [1 / (1 + math.exp(score - t)) for t in thresholds]
        total -= math.log(([*below, 1.0])[grade] - ([0.0, *below])[grade])
    return total / len(rows) + quality_classifier.PENALTY / 2 * sum(w * w for w in weights.values())


@pytest.mark.parametrize("n_grades", [2, 3, 5])
def test_ordinal_fit_is_the_likeliest(n_grades):
    """No step of any weight or threshold lowers a loss that is written down independently."""
    rng = random.Random(n_grades)
    rows = [{f: rng.uniform(0.2, 1.0) for f in rng.sample(range(6), rng.randrange(4))} for _ in range(300)]
    taste = {f: rng.uniform(-2, 2) for f in range(6)}
    hidden = [sum(taste[f] * x for f, x in row.items()) + rng.gauss(0, 1) for row in rows]
    cuts = sorted(hidden)[len(hidden) // n_grades :: len(hidden) // n_grades][: n_grades - 1]
    grades = [sum(h > c for c in cuts) for h in hidden]
    model = quality_classifier.fit_ordinal(
        np.array([f for row in rows for f in row], np.int32), np.array([x for row in rows for x in row.values()], np.float32),
        np.array([len(row) for row in rows]), np.array(grades), steps=4000,
    )
    weights = {f: float(model.weights[f]) for f in range(6)}
    thresholds = [float(t) for t in model.thresholds]
    assert thresholds == sorted(thresholds) and np.count_nonzero(model.weights) == 6
    least = penalised_loss(weights, thresholds, rows, grades)
    for step in (-0.02, 0.02):
        for f in weights:
            assert penalised_loss(weights | {f: weights[f] + step}, thresholds, rows, grades) > least
        for k in range(len(thresholds)):
            moved = [t + step * (i == k) for i, t in enumerate(thresholds)]
            assert penalised_loss(weights, moved, rows, grades) > least


def test_classifier_sample_is_fixed_by_the_data(spark):
    docs = [(1, "b"), (1, "a"), (1, None), (2, None), (3, "c"), (None, "d")]
    grades = [(1, 2), (1, 0), (2, 1), (None, 1), (4, 1)]
    for order in (1, -1):
        found = quality_classifier.training_rows(
            spark.createDataFrame(docs[::order], "doc_id bigint, text string"), spark.createDataFrame(grades[::order], "doc_id bigint, grade int")
        )
        assert sorted(map(tuple, found.select("doc_id", "text", "grade").collect())) == [(1, "a", 0), (2, None, 1)]


def test_classifier_features_do_not_depend_on_what_is_remembered(monkeypatch):
    texts = ["a b c a", "Long WORDS!! $x$ and-more", "d e f " * 50, "", None, "\u2003x\u00a0y 12,3"]
    expected = [quality_classifier.Hasher().features(t) for t in texts]
    monkeypatch.setattr(quality_classifier, "_MAX_CACHE", 2)
    small = quality_classifier.Hasher()
    for text, (buckets, values) in zip(texts * 2, expected * 2, strict=True):
        again = small.features(text)
        assert (again[0] == buckets).all() and np.allclose(again[1], values)
