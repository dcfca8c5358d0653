"""Operators 7, 8 and 9, and the pipeline."""

import collections
import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from brute import base_spans, documents, edit_distance_within, holds_item, line_dedup, near_duplicates, sha, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from test_chat_tokens_packing import check_packing

import corpus_pipeline
from monthend.llm import decontam, langid, pii, queries
from monthend.llm.crf import Tagger
from monthend.llm.words import words_of

SF = "/root/testdata/sf0.001"
VOCAB = [f"w{i}" for i in range(3000)] + ["the"] * 400 + ["of"] * 300


def prose(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def with_edits(rng, text, n):
    out = text.split()
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[at:at + 1] = [[], ["changed"], [out[at], "more"]][kind]
    return " ".join(out)


# ---- 7


@given(st.lists(st.integers(1, 4), min_size=1, max_size=9), st.lists(st.integers(1, 4), max_size=12))
@settings(max_examples=150, deadline=None)
def test_edit_distance_to_any_part(item, text):
    got, end = decontam.nearest(np.array(item, np.uint64), np.array(text, np.uint64))
    assert got == edit_distance_within(item, text)
    assert got == min(edit_distance_within(item, text[max(0, end - k):end]) for k in range(len(text) + 1))


def benchmark(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_hits_against_brute_force(spark):
    rng = random.Random(8)
    items = [prose(rng, n) for n in (8, 9, 12, 20, 31, 45, 64, 7)] + ["", None]
    texts = [None, "", "short", items[3], items[7] + " below the least length", prose(rng, 20000)]
    for item in items[:7]:
        n = len(item.split())
        for edits in (0, n // 20, n // 10):
            texts.append(f"{prose(rng, 30)}.\n{with_edits(rng, item, edits).upper().replace(' ', ', ')}! {prose(rng, 30)}")
        texts.append(f"{prose(rng, 30)} {with_edits(rng, item, n // 2)} {prose(rng, 30)}")
    texts += [prose(rng, 120) for _ in range(30)]
    frame = with_clashes(documents(spark, texts), ["id", "item_id", "distance", "m", "words"])
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.contaminated(frame, benchmark(spark, items)).collect()}
    want = {(i, k) for i, t in enumerate(texts[:5] + texts[6:], 0) for k, x in enumerate(items)
            if holds_item(x, t)}
    want = {(i if i < 5 else i + 1, k) for i, k in want}
    assert set(got) == want
    left = decontam.without_contaminated(frame, benchmark(spark, items))
    assert left.columns == frame.columns
    assert {r.doc_id for r in left.select("doc_id").collect()} == set(range(len(texts))) - {i for i, _ in want}


def test_items_in_blocks_and_odd_ids(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 30)
    rng = random.Random(3)
    items = [prose(rng, 20) for _ in range(6)]
    frame = documents(spark, [items[0], items[1], items[1], items[5], "clean"], ids=[None, 3, 3, 4, 5])
    got = sorted((tuple(r) for r in decontam.contaminated(frame, benchmark(spark, items)).select("doc_id", "item_id").collect()), key=str)
    assert got == [(3, 1), (4, 5), (None, 0)]
    assert [r.doc_id for r in decontam.without_contaminated(frame, benchmark(spark, items)).collect()] == [5]
    none = benchmark(spark, items).limit(0)
    assert decontam.contaminated(frame, none).count() == 0
    assert decontam.without_contaminated(frame, none).count() == 5
    assert decontam.contaminated(documents(spark, []), benchmark(spark, items)).count() == 0


def test_short_items_and_items_without_an_id(spark, tmp_path):
    rng = random.Random(4)
    long = [prose(rng, 20), prose(rng, 20)]
    items = [(1, "Seven words make this item, not eight"), (2, "constantinople"), (None, long[0]), (4, "人工智能将改变世界的未来"),
             (5, "是的"), (None, "two Words"), (7, long[1]), (8, "GPT-4 は大規模言語モデル"), (9, "..."), (None, None)]
    texts = ["He said: seven words, make THIS item not eight!", "seven words make this item not nine eight", "in Constantinople.",
             "constantinoples", f"so {long[0]} it is", "有人说人工智能将改变世界的未来,是的", "人工智能将改变世界", "two\nwords", "two other words",
             long[1], None, "", "x gpt 4 は大規模言語モデルです", "xgpt 4 は大規模言語モデルです", "two", "words"]
    frame = documents(spark, texts)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.op7_decontamination(spark, str(tmp_path)).collect()}
    assert got == {(0, 1, 7, 0, 9), (2, 2, 1, 0, 2), (4, None, 20, 0, 21), (5, 4, 1, 0, 1), (7, None, 2, 0, 2), (9, 7, 20, 0, 20),
                   (12, 8, 3, 0, 4)}
    left = corpus_pipeline.decontamination(spark, frame, str(tmp_path))
    assert {r.doc_id for r in left.collect()} == set(range(len(texts))) - {0, 2, 4, 5, 7, 9, 12}


def test_recall_at_the_largest_distance():
    rng, words = np.random.default_rng(5), random.Random(5)
    texts = [prose(words, 12 + k % 50) for k in range(120)]
    w = words_of(pa.array(texts), lower=True, plain=True)
    items = [(i, w.hashes[a:b]) for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:], strict=True))]
    block = decontam.prepare(items, 0.2, 0.95, decontam.SAMPLED)
    found = 0
    for k, (_, item) in enumerate(block.items):
        copy = decontam.edited(rng, item, decontam.allowed(len(item), 0.2))
        noise = rng.integers(1, 1 << 63, 40, np.uint64)
        text = np.concatenate([noise[:20], copy, noise[20:]])
        found += any(h[1] == k for h in decontam.find_hits(text, np.array([0, len(text)]), block, 0.2))
    assert found / len(items) >= 0.9


@pytest.mark.parametrize(("n", "most"), [(8, 400), (15, 400), (60, 20)])
def test_recall_of_the_shortest_items_of_a_class_and_with_few_rounds(monkeypatch, n, most):
    monkeypatch.setattr(decontam, "MOST_ROUNDS", most, raising=False)
    rng = np.random.default_rng(2)
    block = decontam.prepare([(i, rng.integers(1, 1 << 63, n, np.uint64)) for i in range(60)], 0.2, 0.95, decontam.SAMPLED)
    assert len(block.classes[0].repetitions) <= most
    found = 0
    for k in range(300):
        copy = decontam.edited(rng, block.items[k % 60][1], decontam.allowed(n, 0.2))
        noise = rng.integers(1, 1 << 63, 4 * n, np.uint64)
        text = np.concatenate([noise[:2 * n], copy, noise[2 * n:]])
        found += any(h[1] == k % 60 for h in decontam.find_hits(text, np.array([0, len(text)]), block, 0.2))
    assert found / 300 >= 0.94


def test_decontamination_query_finds_every_passage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    got = queries.op7_decontamination(spark, SF).toPandas()
    whole = {(d.doc_id, b.item_id) for d in docs.itertuples() for b in items.itertuples() if b.text in d.text}
    assert whole and whole <= set(zip(got.doc_id, got.item_id, strict=True))
    for r in got.itertuples():
        assert holds_item(items.set_index("item_id").text[r.item_id], docs.set_index("doc_id").text[r.doc_id])


# ---- 8


@given(st.text(alphabet="ab.@-+_% 0123456789()\n", max_size=60))
@settings(max_examples=400, deadline=None)
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == base_spans(text)


def test_base_is_linear_in_long_runs():
    for text in ("a" * 300000, "1" * 300000, "1." * 150000, "@" * 300000, "+" * 300000, "a@" * 150000, "1" * 300000 + "@a.b"):
        pii.base_spans(text)


def test_windows_cover_every_character_once():
    for n in (0, 1, 63, 64, 65, 104, 105, 200, 1000):
        windows = pii.Windows(np.full(n, 55, np.int8))  # digits only
        starts = windows.starts[windows.due()]
        assert n == 0 or len(starts) == len(windows.starts)
        tags = np.arange(1, len(starts) + 1, dtype=np.int8)[:, None].repeat(pii.WIDTH, 1)
        assert (pii.stitch(n, starts, tags) > 0).all()


class WordTagger:
    """Tags every run of what is no space as an address, window by window."""

    def __init__(self):
        self.read = 0

    def decode(self, rows):
        self.read += len(rows)
        return np.where((rows == pii.classes_of(" ")[0]) | (rows == 0), 0, 2).astype(np.int8)


@given(st.lists(st.tuples(st.integers(0, 130), st.integers(1, 130), st.sampled_from(["a", "@b.co", "c@d.org", "1"])), max_size=6))
@settings(max_examples=60, deadline=None)
def test_spans_around_a_trigger_are_read_whole(parts):
    """Whatever the alignment, the spans are those found when all windows are read."""
    text = " ".join("w " * a + "x" * b + c for a, b, c in parts)
    lazy, every = WordTagger(), pii.Windows(pii.classes_of(text))
    every.wanted[:] = True
    every.take(every.due(), WordTagger().decode(every.rows(every.due())))
    want = [r for r in pii.tag_runs(every.stitched()) if pii.plausible("email", text[r[1]:r[2]])]
    assert pii.added_spans([text, "no trigger"], [[], []], lazy) == [want, []]


def test_an_address_that_starts_long_before_its_sign():
    text = "w" * 20 + " " * 10 + "l" * 40 + "@host.org and so on " + "plain words " * 400
    tagger = WordTagger()
    assert pii.added_spans([text], [[]], tagger) == [[("email", 30, 79)]]
    assert tagger.read < 10     # of 120 windows


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(0)
    allowed = np.ones((3, 3), bool)
    allowed[0, 2] = False
    tagger = Tagger.fresh(5, 3, allowed, 3, 4, 1)
    tagger.weights = {k: v.astype(np.float64) + rng.standard_normal(v.shape) * 0.1 for k, v in tagger.weights.items()}
    x, y = rng.integers(0, 5, (4, 6)), rng.integers(0, 2, (4, 6))
    _, grads = tagger.gradients(x, y)
    for name, w in tagger.weights.items():
        for _ in range(4):
            at = tuple(rng.integers(n) for n in w.shape)
            if name == "trans" and not allowed[at]:
                continue
            keep, w[at] = w[at], w[at] + 1e-5
            up = tagger.gradients(x, y)[0]
            w[at] = keep - 1e-5
            down = tagger.gradients(x, y)[0]
            w[at] = keep
            assert grads[name][at] == pytest.approx((up - down) / 2e-5, rel=2e-2, abs=2e-4), name


def test_personal_data_query_and_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_personal_data(spark, SF).collect()}
    for r in docs.collect():
        own = base_spans(r.text)
        counts = collections.Counter(k for k, _, _ in own)
        g = got[r.doc_id]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(counts[k] for k in pii.KINDS)
        assert g.base_sha256 == sha(pii.written(own))
        assert {f"{k}:{a}:{b}" for k, a, b in own} <= set(g.spans.split(","))
    # the tagger, learnt from one half of a table, finds the other half's spans
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tagger = pii.train(pii.labelled_sample(rows.where("doc_id % 2 = 0"), "text", pii.SAMPLE))
    texts = [r.text for r in rows.where("doc_id % 2 = 1").collect()]
    told = [set(x) for x in pii.added_spans(texts, [[] for _ in texts], tagger)]
    true = [set(base_spans(t)) for t in texts]
    right = sum(len(a & b) for a, b in zip(told, true, strict=True))
    assert right / max(1, sum(map(len, told))) > 0.9
    assert right / sum(map(len, true)) > 0.75


def test_personal_data_of_odd_tables(spark):
    texts = [None, "", "a@b.co " * 3000, "no data", "+1 (415) 555-0132 and 4111 1111 1111 1111", "10.0.0.300 10.0.0.3"] + ["x@y.org"] * 3
    frame = with_clashes(documents(spark, texts, ids=[None, 1, 2, 3, 4, 5, 6, 6, 7]), ["id", "spans", "n_email", "kind"])
    got = sorted((r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.find_personal_data(frame).collect())
    assert got == sorted([(0, 0, 0, 0)] * 3 + [(3000, 0, 0, 0), (0, 0, 1, 1), (0, 1, 0, 0)] + [(1, 0, 0, 0)] * 3)
    assert pii.find_personal_data(documents(spark, [])).count() == 0
    nothing = pii.find_personal_data(documents(spark, ["plain", None])).collect()
    assert [r.spans for r in nothing] == ["", ""]


# ---- 9


def test_language_query_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op9_language_id(spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    out = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in out} == {i for i, g in got.items() if g.held_out}
    assert sum(got[r.doc_id].lang_pred == r.lang for r in out) / len(out) > 0.98
    assert all(0 <= g.score <= 1 for g in got.values())


def plain_profile(letters, text):
    """The sum of the bound vectors of the n-grams around every letter."""
    def vector(c):
        return letters.letters[letters.index[ord(c)] if c.isalpha() else langid.BOUNDARY].astype(int)
    padded = f" {text.lower()} "
    grams = [padded[i - 1:i + 2] for i in range(1, len(padded) - 1) if padded[i].isalpha()]
    return sum((np.roll(vector(x), 2) * np.roll(vector(y), 1) * vector(z) for x, y, z in grams), np.zeros(64, int))


@pytest.mark.parametrize("limits", [{}, {"LARGEST_TABLE": 1}, {"LARGEST_COUNTS": 1}, {"PIECE": 3, "BLOCK": 2},
                                    {"LARGEST_TABLE": 1, "LARGEST_COUNTS": 1, "PIECE": 5, "BLOCK": 3}])
def test_profiles_against_plain_ngrams(monkeypatch, limits):
    """Whatever the sizes of pieces and tables, a profile is the sum over the text's n-grams."""
    for name, value in limits.items():
        monkeypatch.setattr(langid, name, value)
    letters = langid.Letters(64)
    texts = ["Ab c", "", "1!?", "ab-ab", "ß日", "abab" * 9, "日本語 — Ünïcode", "x"]
    got, known = letters.profiles(texts)
    assert known.tolist() == [any(c.isalpha() for c in t) for t in texts]
    assert (got == np.array([plain_profile(letters, t) for t in texts])).all()


def test_memory_does_not_grow_with_the_alphabet():
    """A megabyte of text in twenty thousand different letters."""
    rng = random.Random(4)
    alphabet = [chr(0x4E00 + i) for i in range(20000)]
    texts = ["".join(rng.choices(alphabet, k=341)) for _ in range(1024)]
    letters = langid.Letters(langid.DIMENSIONS)
    tracemalloc.start()
    letters.profiles(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6


def test_texts_in_scripts_not_learnt_are_rejected(spark):
    rng = random.Random(5)
    wordlist = ["".join(rng.choices("eetaoinshrdlucmfwypvbgkjqxz", k=rng.randrange(2, 9))) for _ in range(300)]
    learnt = [" ".join(rng.choices(wordlist, k=rng.choice([1, 2, 30]))) for _ in range(60)]
    scripts = [(0x4E00, 5000), (0x3B1, 24), (0x430, 32), (0x5D0, 26), (0x905, 50)]
    odd = ["".join(rng.choices([chr(lo + i) for i in range(n)] + [" "], k=rng.choice([12, 60, 300])))
           for lo, n in scripts for _ in range(40)]
    frame = documents(spark, [*learnt, "Avec.", "A.", *odd], langs=["en"] * 60 + [None] * 202)
    kept = {r.doc_id for r in langid.keep_identified(frame).select("doc_id").collect()}
    assert kept >= set(range(62))
    assert len(kept - set(range(62))) <= 0.01 * len(odd)


def test_languages_of_odd_tables(spark):
    texts = ["the cat and the hat"] * 8 + ["der hund und das haus"] * 8 + [None, "", "12 !?", "THE CAT", "x" * 200000]
    langs = ["en"] * 8 + ["de"] * 8 + ["en", None, "en", None, None]
    frame = with_clashes(documents(spark, texts, langs=langs), ["_held_out", "held_out", "lang_pred", "score", "_text", "profile"])
    got = {r.doc_id: r for r in langid.identify(frame).collect()}
    assert [got[i].lang_pred for i in (0, 8, 16, 17, 18, 19)] == ["en", "de", "und", "und", "und", "en"]
    kept = langid.keep_identified(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= set(range(16)) | {19}
    assert not {r.doc_id for r in kept.select("doc_id").collect()} & {16, 17, 18}
    nobody = langid.identify(documents(spark, ["a b"], langs=[None])).collect()
    assert [(r.lang_pred, r.score) for r in nobody] == [("und", 0.0)]
    assert langid.identify(documents(spark, [])).count() == 0


# ---- the pipeline


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = documents(spark, [None, "", "12 34", docs.first().text, docs.first().text], ids=[90001, 90002, 90003, 90004, 90004])
    docs = docs.unionByName(odd.select(*docs.columns))
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        seen[name] = (docs, spark.read.parquet(f"{tmp_path}/{k}"))
        docs = seen[name][1]
        assert name == "best_fit_packing" or docs.columns == seen["language_id"][0].columns
    rows = lambda df: sorted(tuple(r) for r in df.collect())

    before, after = seen["language_id"]
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == {90001, 90002, 90003}
    assert set(rows(after)) <= set(map(tuple, before.collect()))

    before, after = seen["line_dedup"]
    old = before.collect()
    want = line_dedup([(r.doc_id, r.text) for r in old])
    assert rows(after) == sorted((r.doc_id, k, r.lang, r.source, len(k)) for r, (_, _, k) in zip(old, want, strict=True))

    before, after = seen["near_dedup"]
    old = {r.doc_id: r for r in before.collect()}
    kept = {i for i, (_, c) in near_duplicates({i: r.text for i, r in old.items()}, 5).items() if i == c}
    assert rows(after) == sorted(tuple(old[i]) for i in kept)

    before, after = seen["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    short = [r for r in before.collect() if len(r.text) < 4000]
    left = {r.doc_id for r in after.collect()}
    for r in short[:40]:
        assert (r.doc_id in left) == (not any(holds_item(x, r.text) for x in items))
    assert not any(x in r.text for r in after.collect() for x in items)

    before, after = seen["best_fit_packing"]
    pieces = after.collect()
    n = check_packing(pieces, {r.doc_id: r.text for r in before.collect()})
    assert n <= -(-sum(p.length for p in pieces) // 2048) + 1


def test_pipeline_keeps_further_columns_and_empty_tables(spark):
    docs = with_clashes(documents(spark, ["a plain text here", None]), ["row", "kept", "_fp", "print", "_c0", "score", "id"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert corpus_pipeline.best_fit_packing(spark, docs.limit(0), SF).count() == 0


def test_pipeline_query_equals_its_stages(spark):
    got = pd.DataFrame([r.asDict() for r in corpus_pipeline.run(spark, SF).collect()])
    assert (got.groupby("sequence_id").length.sum() <= 2048).all()
    assert got.doc_id.nunique() > 100
