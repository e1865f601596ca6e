"""Token frames, filter audit and spelling variants against plain versions and exact round trips."""

import io
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from termscape.llm import bpe, filter_audit, spelling, token_frames
from termscape.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CLASHING = "doc_id bigint, text string, lang string, text_key string, at string, mask string, n string, word string, name string, file string, place int, part string, rank int, ids string"
REST = ("k", "a", "m", "n", "w", "name", "f", 3, "part", 4, "ids")


def frame(spark, rows):
    """``(doc_id, text, lang)`` rows with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, *REST) for i, t, lang in rows], CLASHING)


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randrange(0, 400)), "en") for i in rng.sample(range(-50, 5000), 60)]
    rows += [(None, None, "de"), (None, "twice", "de"), (None, "twice", "de"), (7000, "", None), (7001, None, "fr"), (7002, "é漢🙂<|endoftext|> x", "fr")]
    return rows + [(7003, "same", "en")] * 25 + [(7003, "other", "en"), (7004, "word " * 60000, "en")]


def expected_ids(text, library=Tokenizer.from_file(VOCABULARY)):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("file_bytes", [2000, 1 << 25])
def test_token_frames_round_trip(spark, texts, file_bytes, monkeypatch):
    folder = scratch_path(spark, "frames")
    token_frames.write_tokens(frame(spark, texts), folder, VOCABULARY, file_bytes=file_bytes)
    found = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids"]) for r in token_frames.read_tokens(spark, folder).collect())
    assert len(found) == len(texts)
    assert sorted([(d, ids) for _, d, _, ids in found], key=repr) == sorted([(d, [*expected_ids(t), 2]) for d, t, _ in texts], key=repr)
    assert [s for s, *_ in found] == np.concatenate([[0], np.cumsum([n for _, _, n, _ in found])[:-1]]).tolist()
    order = [-(10**9) if d is None else d for _, d, *_ in found]
    assert order == sorted(order)
    sums = {r["start"]: r["ids_crc32"] for r in token_frames.read_checksums(spark, folder).collect()}
    assert sums == {s: zlib.crc32(np.array(ids, "<u4").tobytes()) for s, _, _, ids in found}
    wanted = spark.createDataFrame([(7003,), (7003,), (7004,), (None,), (123456,)], "doc_id bigint")
    some = token_frames.read_tokens(spark, folder, wanted).collect()
    assert sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids"]) for r in some) == [r for r in found if r[1] in (7003, 7004)]
    files = token_frames.read_index(spark, folder).select("file").distinct().count()
    assert files > 5 if file_bytes == 2000 else files == 1


def test_token_frames_starts_over_bundles_of_files(spark, texts, monkeypatch):
    folder = scratch_path(spark, "frames")
    token_frames.write_tokens(frame(spark, texts), folder, VOCABULARY, file_bytes=1000)
    whole = sorted(map(tuple, token_frames.file_starts(token_frames.read_index(spark, folder)).collect()))
    monkeypatch.setattr(token_frames, "FILES_PER_GROUP", 3)
    assert sorted(map(tuple, token_frames.file_starts(token_frames.read_index(spark, folder)).collect())) == whole and len(whole) > 9


def test_token_frames_of_nothing(spark, texts):
    folder = scratch_path(spark, "frames")
    token_frames.write_tokens(frame(spark, []), folder, VOCABULARY)
    assert token_frames.read_tokens(spark, folder).count() == 0
    with pytest.raises(Exception, match="exists"):
        token_frames.write_tokens(frame(spark, texts[:2]), folder, VOCABULARY)


class Sink(io.BytesIO):
    def close(self):
        """Keep the bytes."""

    def size(self):
        return len(self.getvalue())


class CountingSource(Sink):
    def read(self, size=-1):
        self.taken = getattr(self, "taken", 0) + max(size, 0)
        return super().read(size)


def test_a_file_reads_only_the_frames_asked_for(monkeypatch):
    monkeypatch.setattr(token_frames, "FRAME_IDS", 1000)
    rng, sink = np.random.default_rng(1), Sink()
    writer = token_frames.FrameWriter(sink, 2, 3)
    documents = [rng.integers(0, 50000, n).astype(np.uint32) for n in (3, 0, 2500, 1000, 40000)]
    for i, ids in enumerate(documents):
        writer.add(None if i == 1 else i, ids)
    writer.close()
    data = sink.getvalue()
    reader = token_frames.FrameReader(CountingSource(data))
    assert [reader.doc_id(i) for i in range(5)] == [0, None, 2, 3, 4] and reader.first_frame.tolist() == [0, 1, 1, 4, 5, 45]
    reader.source.taken = 0
    assert all(np.array_equal(reader.ids(i), documents[i]) for i in (2, 0)) and reader.source.taken < 6000
    assert np.array_equal(np.concatenate([reader.ids(i) for i in range(5)]), np.concatenate(documents))
    # any zstandard reader gets the ids, frame after frame, and passes over the two tables
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.array_equal(np.frombuffer(plain, "<u2"), np.concatenate(documents))
    # a damaged frame is found, and the other documents are still read
    at = int(reader.offsets[2]) + 40
    damaged = token_frames.FrameReader(CountingSource(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]))
    with pytest.raises(Exception):
        damaged.ids(2)
    assert np.array_equal(damaged.ids(4), documents[4])
    with pytest.raises(ValueError, match="seek table"):
        token_frames.FrameReader(CountingSource(data[:-1]))


def test_wide_ids_and_no_end_id(spark):
    sink = Sink()
    writer = token_frames.FrameWriter(sink, 4, 3)
    writer.add(5, np.array([1, 1 << 30], np.uint32))
    writer.close()
    assert token_frames.FrameReader(CountingSource(sink.getvalue())).ids(0).tolist() == [1, 1 << 30]
    folder = scratch_path(spark, "frames")
    token_frames.write_tokens(frame(spark, [(1, None, ""), (2, "a b", "")]), folder, VOCABULARY, end_id=None)
    assert [(r["doc_id"], r["start"], r["ids"]) for r in token_frames.read_tokens(spark, folder).orderBy("doc_id").collect()] == [(1, 0, []), (2, 0, expected_ids("a b"))]


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def failures(rows):
    """(part, set of failed filters, good, toxic) of each row of (doc_id, text, lang)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, t, lang in rows:
        text = t or ""
        words = WORDS.findall(text)
        found = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and i > least[text],
        }
        yield lang or "", {f for f, fails in found.items() if fails}


def expected_audit(rows, good, toxic, filters="ABCDE"):
    marked = [(part, fails, i in good, i in toxic) for (i, _, _), (part, fails) in zip(rows, failures(rows), strict=True)]
    report, shapley = [], Counter()
    for part in {m[0] for m in marked}:
        own = [m for m in marked if m[0] == part]
        for order in permutations(filters):
            left = own
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                before = [m for m in own if f in m[1] and m not in left]
                left = [m for m in left if f not in m[1]]
                shapley[part, f] += len(gone)
                alone = sum(m[1] == {f} for m in own)
                report.append((part, "".join(order), step, f, len(left), len(gone), sum(f in m[1] for m in own) - len(gone), alone, sum(m[2] for m in gone), sum(m[3] for m in gone)))
                assert len(before) <= report[-1][6]
    return sorted((*r, shapley[r[0], r[3]]) for r in report)


def test_filter_audit_equals_running_every_order(spark):
    rng = random.Random(12)
    pieces = ["plain words here ", "SHOUT ", "a $ sign ", "x ", "ümlaut Ärger "]
    rows = [(rng.randrange(-20, 300), "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 5, 60, 200]))), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    rows += [(i, prose(rng, 150), "en") for i in range(400, 420)] + [(500 + i, "the same", rng.choice(["en", "de"])) for i in range(30)]
    rows += [(None, "the same", "en"), (None, None, "de"), (3, "the same", "de"), (3, "the same", "de"), (4, prose(rng, 90000), "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i in range(0, 500, 3)] + [(None, 1, 1, "x"), (3, 1, 0, "x"), (3, 0, 0, "x")]
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, n string")
    good, toxic = {i for i, q, _, _ in labels if q == 1 and i is not None}, {i for i, _, t, _ in labels if t == 1 and i is not None}
    columns = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = filter_audit.audit_documents(frame(spark, rows), marks).select(columns)
    assert sorted(map(tuple, found.collect())) == expected_audit(rows, good, toxic)
    assert filter_audit.audit_documents(frame(spark, []), marks).count() == 0
    assert filter_audit.audit_documents(frame(spark, rows), marks.limit(0)).agg({"good_lost": "max"}).first()[0] == 0


def test_filter_audit_intervals_cover_each_order_once():
    for k in (1, 2, 3, 5):
        orders = list(permutations(range(k)))
        assert [filter_audit.lehmer_rank(o, k) for o in orders] == list(range(len(orders)))
        hit = Counter()
        for mask, step, last, first, past in filter_audit.removal_intervals(k):
            for rank in range(first, past):
                assert next(i for i, f in enumerate(orders[rank]) if mask >> f & 1) == step - 1 and orders[rank][step - 1] == last
                hit[mask, rank] += 1
        assert set(hit.values()) == {1} and len(hit) == len(orders) * (2**k - 1)


def test_filter_audit_of_other_filters(spark):
    counted = spark.createDataFrame([(None, 1, 4), ("", 2, 5), ("", 3, 6), ("", 3, 1), ("", 0, 2)], "part string, mask int, n int")
    rows = filter_audit.audit(counted, ["short, ", "long"]).orderBy("filter_order", "step").collect()
    assert [(r["filter_order"], r["filter"], r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in rows] == [
        ("longshort, ", "long", 6, 12, 0, 5, 17), ("longshort, ", "short, ", 2, 4, 7, 4, 15), ("short, long", "short, ", 7, 11, 0, 4, 15), ("short, long", "long", 2, 5, 7, 5, 17),
    ]
    with pytest.raises(ValueError, match="filters"):
        filter_audit.audit(counted, [])


LOWER = {c: c + 32 for c in range(65, 91)}


def expected_words(rows):
    counts = Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_groups(words):
    form, rows = {}, {}
    for w, n in words.items():
        near = [v for v in words if abs(len(v) - len(w)) < 2 and v != w and one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        rows[w] = (n, len(near))
    found = []
    for w, (n, near) in rows.items():
        root = w
        while form[root]:
            root = form[root]
        found.append((w, form[w], root, n, near, words.get(form[w])))
    return sorted(found, key=repr)


@pytest.mark.parametrize("cells", [40, 1 << 14])
def test_spelling_equals_comparing_all_words(spark, monkeypatch, cells):
    monkeypatch.setattr(spelling, "BLOCK_CELLS", cells)
    monkeypatch.setattr(spelling, "PAIR_CELLS", cells * 8)
    rng = random.Random(13)
    bases = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))) for _ in range(12)] + ["aaaaaa", "ababababab", "zzzzz" * 400, "zzzzz" * 400 + "z"]

    def varied(w):
        at = rng.randrange(len(w))
        return rng.choice([w, w, w[:at] + w[at + 1 :], w[:at] + rng.choice("abÉß÷") + w[at:], w[:at] + rng.choice("abEç×") + w[at + 1 :]])

    rows = [(i, " ".join(varied(rng.choice(bases)) for _ in range(rng.randrange(0, 60))), "en") for i in range(250)]
    rows += [(None, "Aaaaaa, aaaaab-AAAAAB aaaaab aaaaab", "x"), (None, None, "x"), (5, "", "x")] + [(999, "repeated rowss", "x")] * 40 + [(999, "repeated rows", "x")] * 5
    rows += [(1000 + k, " ".join(["qrstuvwxyzab"[: 5 + k]] * (3 * 2**k)), "x") for k in range(7)]  # a chain of forms
    found = spelling.group_variants(spelling.word_counts(frame(spark, rows)))
    got = sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect()), key=repr)
    words = expected_words(rows)
    assert got == expected_groups(words) and len(words) > 100 and any(g[1] and g[1] != g[2] for g in got)
    assert spelling.group_variants(spelling.word_counts(frame(spark, []))).count() == 0
