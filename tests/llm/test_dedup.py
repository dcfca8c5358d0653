"""Operators 3, 4, 5 and 10 against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import (components, cosine_links, documents, line_dedup, near_duplicates, sha, shingles, with_clashes,
                   without_repeats, words)
from hypothesis import given, settings
from hypothesis import strategies as st

from monthend.llm import embedding, linededup, minhash, queries, substring
from monthend.llm import words as W
from monthend.llm.components import connected_components

SF = "/root/testdata/sf0.001"
VOCAB = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def changed(rng, text, n):
    out = text.split()
    for _ in range(n):
        out[rng.randrange(len(out))] = rng.choice(VOCAB)
    return " ".join(out)


# ---- word arrays


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbBé \t\n\x0b.-Z1", max_size=30)), min_size=1, max_size=6),
       st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_words_and_shingles(texts, size):
    w = W.words_of(pa.array(texts, pa.string()), lower=True)
    assert w.counts.tolist() == [len(words(t, True)) for t in texts]
    flat = [x for t in texts for x in words(t, True)]
    assert len(set(flat)) == len(set(w.hashes.tolist()))
    sets, first = W.shingle_sets(w, size)
    assert np.diff(first).tolist() == [len(shingles(t, size)) for t in texts]
    same = {}
    for i, t in enumerate(texts):
        assert same.setdefault(shingles(t, size), sets[first[i]:first[i + 1]].tolist()) == sets[first[i]:first[i + 1]].tolist()


def test_slices_hold_every_row_of_a_sliced_column():
    batch = pa.RecordBatch.from_arrays([pa.array([None, "a b", "", "x" * (W.SLICE_BYTES + 5), "c"] * 3)], ["text"]).slice(1, 13)
    got = [t for part in W.text_slices(iter([batch]), "text") for t in part.column(0).to_pylist()]
    assert got == batch.column(0).to_pylist()


# ---- components


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    links += [(500, i) for i in range(501, 560)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [x for x in links if x[0] != x[1]]
    nodes = {x for p in links for x in p}
    assert got == components(nodes, links)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 3


def check_near(frame, texts, size):
    got = {r.doc_id: r for r in minhash.near_duplicates(frame, shingle_words=size).collect()}
    for i, (n, component) in near_duplicates(texts, size).items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (n, component, i == component)
    return got


def test_near_duplicates_of_groups_and_odd_texts(spark):
    rng = random.Random(3)
    texts = ["", None, "One", "one", " ONE\t", "two words", "\n", "é É"]
    base = prose(rng, 300)
    texts += [changed(rng, base, rng.randrange(12)) for _ in range(60)]         # a crowded group
    chain = prose(rng, 200)
    for _ in range(12):                                                         # links that only chain
        texts.append(chain)
        chain = changed(rng, chain, 9)
    texts += [prose(rng, rng.randrange(1, 60)) for _ in range(60)] + [base] * 3
    texts.append(prose(rng, 30000))
    hub = [f"b{i}" for i in range(120)]
    texts.append(" ".join(hub))
    for k in range(80):  # a star: every copy is linked with the hub alone, so one missed link splits the group
        own = list(hub)
        for j in rng.sample(range(0, 120, 3), 5):
            own[j] = f"n{k}x{j}"
        texts.append(" ".join(own))
    frame = with_clashes(documents(spark, texts), ["id", "n", "fp1", "a", "b", "hub", "rep", "component", "node", "agree", "kept"])
    check_near(frame, dict(enumerate(texts)), 2)


def class_rows(spark, values):
    """A table of classes with these signatures (rows of minhash values)."""
    rows = [(i, 100, bytearray(v.astype(">u4").tobytes())) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "rep long, n long, signature binary")


def crowd_of_signatures(n):
    """Unlike signatures that share three values in tree 0; the first two agree by 80 % but in no other prefix."""
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 32, (n, minhash.TREES, minhash.DEPTH), np.uint64)
    values[1] = values[0]
    values[1, 1:, 0] += np.uint64(1)
    values[1, 0, 3] += np.uint64(1)
    values[:, 0, :3] = 7
    return values.reshape(n, -1)


def test_a_large_region_is_compared_at_its_shortest_prefix(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CROWD", 4)
    classes = class_rows(spark, crowd_of_signatures(30))
    rows = minhash.crowded(classes, spark.createDataFrame([], "node long, component long"))
    assert {r.rep for r in minhash.in_regions(rows, 80).collect()} == {0, 1}


def template_family(rng, pairs, n=60):
    """Texts of one template, far from each other but for pairs near the threshold."""
    base = [f"t{i}" for i in range(n)]
    texts = []
    for k in range(pairs):
        own = list(base)
        for j in rng.sample(range(0, n, 2), 4):
            own[j] = f"o{k}x{j}"
        other = list(own)
        for j in rng.sample([j for j in range(0, n, 2) if own[j] == base[j]], 3):
            other[j] = f"p{k}x{j}"
        texts += [" ".join(own), " ".join(other)]
    rng.shuffle(texts)
    return texts


def test_a_component_that_shares_a_whole_label_is_dealt_to_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CROWD", 4)
    values = crowd_of_signatures(81)
    values[:, :minhash.DEPTH] = 7
    component = spark.createDataFrame([(i, 1) for i in range(1, 81)], "node long, component long")
    rows = minhash.crowded(class_rows(spark, values), component)
    held = rows.transform(minhash.cells).groupBy("region", "i", "j").count().collect()
    assert max(r["count"] for r in held) <= 4 * minhash.CROWD
    assert sum(r["count"] for r in held) <= 2 * 81  # the large component once for each part of the others
    assert {r.rep for r in minhash.in_regions(rows, 80).collect()} == {0, 1}


def test_regions_above_the_crowd_lose_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CROWD", 4)
    monkeypatch.setattr(minhash, "PARTNERS", 1)  # so that most pairs are left to the regions
    monkeypatch.setattr(minhash, "NEIGHBOURS", 1)
    texts = template_family(random.Random(6), 100)
    check_near(documents(spark, texts), dict(enumerate(texts)), 2)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    frame = documents(spark, ["a b c", "a b c", "a b c", "x y z", None], ids=[None, 4, 4, 9, None])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame, shingle_words=2).collect()),
                 key=str)
    assert got == sorted([(None, 2, None, True), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 9, True), (None, 0, None, True)], key=str)
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def by_id(rows, size, percent=80):
    """Like ``near_duplicates`` of brute.py, for (id, text) rows: an id's texts are all its own."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    links = [(i, j) for k, (i, x) in enumerate(sets) for j, y in sets[k + 1:]
             if i != j and x & y and 100 * len(x & y) >= percent * len(x | y)]
    named = components(sorted({i for i, _ in rows}), links)
    return sorted((i, len(x), named[i], named[i] == i) for i, x in sets)


def test_one_id_under_several_texts(spark):
    rng = random.Random(12)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(1, a), (1, b), (3, f"{b} more"), (5, c), (2, c), (2, f"{a} w"), (7, prose(rng, 50)), (7, None), (9, ""), (9, prose(rng, 9))]
    texts = template_family(rng, 20)
    rows += [(100 + rng.randrange(25), t) for t in texts]
    frame = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    got = minhash.near_duplicates(frame, shingle_words=2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == by_id(rows, 2)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3, 5)} == {1}


def test_minhash_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = near_duplicates({r.doc_id: r.text for r in rows}, 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_minhash_forest(spark, SF).collect()}
    assert got == want


# ---- 4


def test_cover_has_every_difference():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


def check_repeats(frame, texts, window=35):
    got = sorted((r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(frame, window=window).collect())
    assert got == sorted(without_repeats(texts, window))


@pytest.mark.parametrize("flush", [1 << 20, 50])
def test_repeats_against_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(substring, "FLUSH", flush)
    rng = random.Random(11)
    passages = [prose(rng, n) for n in (34, 35, 36, 50, 90)]
    texts = ["", None, " \n", passages[0], passages[1], "short text"]
    for _ in range(60):
        parts = [prose(rng, rng.randrange(0, 40))]
        for p in rng.sample(passages, 2):
            parts += [p, prose(rng, rng.randrange(0, 5))]
        texts.append("  ".join(parts))
    texts.append(" ".join([passages[4], "gap", passages[4]]))       # within one text
    texts.append("same " * 200)                                     # overlapping itself
    texts += [prose(rng, 20000)] * 2
    frame = with_clashes(documents(spark, texts).repartition(5), ["id", "fp", "of", "print", "cuts", "target", "flush", "kept"])
    check_repeats(frame, texts)


def test_repeats_with_null_and_repeated_ids(spark):
    rng = random.Random(2)
    text, other = prose(rng, 60), prose(rng, 50)
    texts = [text, text, other, None, text + " tail", prose(rng, 40)]
    check_repeats(documents(spark, texts, ids=[1, 1, 1, None, None, None]), texts)
    assert substring.remove_repeats(documents(spark, [])).count() == 0


def test_substring_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (n, x, sha(k)) for r, (n, x, k) in zip(rows, without_repeats([r.text for r in rows], 35), strict=True)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op4_substring_dedup(spark, SF).collect()} == want


# ---- 5


def check_vectors(got, rows, least=0.93):
    links = cosine_links(rows, least)
    named = components([r[0] for r in rows], links)
    for r in got:
        assert r.n_links == sum(r.vec_id in p for p in links)
        assert (r.component_id, r.kept) == (named[r.vec_id], named[r.vec_id] == r.vec_id)
    assert len(got) == len(rows)


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding, "CELL", 16)  # crowded buckets in several cells
    rng = np.random.default_rng(4)
    rows = []
    for k in range(40):
        base = rng.standard_normal(24)
        for _ in range(k % 9):
            rows.append((base + rng.standard_normal(24) * rng.uniform(0, 0.4)).tolist())
    near = rng.standard_normal(24)
    rows += [(near + rng.standard_normal(24) * 0.05).tolist() for _ in range(70)]
    rows += [near.tolist()] * 5 + [(near * 3).tolist(), [0.0] * 24, [], None, [1.0, None], [float("nan")] * 24,
                                   [float("inf")] * 24, [1.0], [2.0], [1e300, 1e300], [1e-300, 1e-300]]
    rows = [(i, v, i % 2 if i < 120 else 1) for i, v in enumerate(rows)]
    rows += [(len(rows) + i, near.tolist(), None) for i in range(2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = with_clashes(frame.repartition(3), ["id", "blob", "rep", "bucket", "tab", "h1", "copies", "n_links", "component", "node"])
    check_vectors(embedding.near_vectors(frame).collect(), [r for r in rows if r[0] != -1])


def test_vectors_of_null_or_repeated_ids_and_none(spark):
    kind = "vec_id long, embedding array<float>, label int"
    rows = [(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (5, [0.0, 1.0], 1)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding.near_vectors(spark.createDataFrame(rows, kind)).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (3, 1, 3, True), (3, 1, 3, True), (5, 0, 5, True)], key=str)
    assert embedding.near_vectors(spark.createDataFrame([], kind)).count() == 0


def test_recall_of_the_hashes():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal(x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    a, b = embedding.bucket_lists(x), embedding.bucket_lists(0.93 * x + np.sqrt(1 - 0.93 ** 2) * z)
    met = (a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)
    assert met.any(1).mean() > 0.999


def test_embedding_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    check_vectors(queries.op5_embedding_dedup(spark, SF).collect(), rows)


# ---- 10


def test_lines_of_odd_tables(spark):
    rows = [(i, f"Shared line \n own {i}\n\n\t SHARED LINE") for i in range(12)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "shared line"), (None, "shared line\nx"), (None, "y\r\nShared line"),
             (54, "nine"), (54, "nine"), (55, "É\né")] + [(60 + i, "nine") for i in range(8)]
    rows += [(70, "\n".join(f"l{i}" for i in range(20000)))]
    clashes = ["row", "id", "fp", "pos", "drop", "lines", "n_lines", "kept", "of", "print", "h1", "salt", "key"]
    frame = with_clashes(documents(spark, [t for _, t in rows], ids=[i for i, _ in rows]), clashes)
    out = linededup.dedup_lines(frame)
    assert out.select("row.*").columns == frame.columns
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.select("row.doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)
    assert got == sorted([(i, *x) for (i, _), x in zip(rows, line_dedup(rows), strict=True)], key=str)
    assert linededup.line_report(documents(spark, [])).count() == 0


def test_lines_without_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        rows = [(i, "shared\nown") for i in range(10)] + [(20, None), (21, "alone")]
        got = linededup.line_report(documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    want = {i: (n, d, sha(k)) for (i, _), (n, d, k) in zip(rows, line_dedup(rows), strict=True)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == want


def test_line_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, d, sha(k)) for (i, _), (n, d, k) in zip(rows, line_dedup(rows), strict=True)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op10_line_dedup(spark, SF).collect()} == want


def test_line_query_is_native(spark):
    plan = queries.op10_line_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "MapPartitions"))
