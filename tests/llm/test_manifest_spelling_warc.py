"""Operators 11, 12 and 13 against plain versions and their SQL."""

import base64
import collections
import gzip
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from brute import documents, sha, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monthend.llm import merkle, queries, spelling, warc
from monthend.session import scratch_path

SF = "/root/testdata/sf0.001"


def keyed(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def oracle(name, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cur = con.execute(queries.ORACLES[name])
    return [d[0] for d in cur.description], cur.fetchall()


@pytest.mark.parametrize(("name", "table"), [("op11_merkle_manifest", "documents"), ("op12_spelling_variants", "documents"),
                                             ("op13_warc_round_trip", "pages")])
def test_query_against_its_sql(spark, name, table):
    columns, want = oracle(name, table)
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert keyed(got.select(columns).collect()) == keyed(want)


# ---- 11


def plain_manifest(rows, fanout=16):
    """(id, leaf, subroot, root, proof, folded root) per row of (id, group, leaf, tampered leaf)."""
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + fanout])) for i in range(0, len(levels[-1]), fanout)])
        return levels

    def climb(levels, i, node, proof):
        for level in levels[:-1]:
            run = level[i - i % fanout:i - i % fanout + fanout]
            run[i % fanout] = node
            proof += "".join(run[:i % fanout] + run[i % fanout + 1:])
            node, i = sha("".join(run)), i // fanout
        return node, proof

    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[g] = tree([r[2] for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, (row_id, _, leaf, tampered) in enumerate(groups[g]):
            node, proof = climb(trees[g], i, tampered or leaf, "")
            node, proof = climb(top, at, node, proof)
            out.append((row_id, leaf, trees[g][-1][0], top[-1][0], sha(proof), node, node == top[-1][0]))
    return out


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


@pytest.mark.parametrize("height", [1, 2, 3])
def test_manifest_of_uneven_groups(spark, height):
    """Group sizes around powers of the fanout, null and clashing values, repeated rows and ids; any block height."""
    rng = random.Random(11)
    sizes = {None: 17, "": 1, "a": 16, "é": 33, "z": 257, "b": 300, "é2": 2}
    rows = [(rng.choice([i, i, None]) if n > 2 else i, rng.choice(["Text A", "lower", None, "ÀB\n", ""]),
             rng.choice(["en", None]), g, rng.choice([None, 3])) for g, n in sizes.items() for i in range(n)]
    rows += [rows[60]] * 5 + [(7, "x" * 300_000, "en", "é", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = with_clashes(spark.createDataFrame(rows, schema), ["g", "id", "at", "digest", "total", "leaf", "root", "tie", "block"])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.manifest(frame, tampered={"text": merkle.lower_ascii(F.col("text"))}, when=chosen, height=height)
    leaves = []
    for i, text, lang, source, n in rows:
        lowered = text and re.sub("[A-Z]", lambda m: m[0].lower(), text)
        hit = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        leaves.append((i, source, plain_leaf(i, source, lang, n, text), plain_leaf(i, source, lang, n, lowered) if hit else None))
    want = plain_manifest(leaves)
    assert not all(r[-1] for r in want)
    assert keyed(got.collect()) == keyed(want)


def test_manifest_of_one_row_and_of_none(spark):
    (row,) = merkle.tampered_manifest(documents(spark, ["a"], ids=[3])).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == sha("")
    assert merkle.tampered_manifest(documents(spark, [])).count() == 0


def test_versions_share_what_they_do_not_copy():
    digests = [sha(str(i)) for i in range(600)]
    block = merkle.Block(digests, True, merkle.LEVELS)
    before = [list(level) for level in block.levels]
    copies = block.version(sha("other"), block.path(70))
    other = merkle.Block(digests[:70] + [sha("other")] + digests[71:], True, merkle.LEVELS)
    assert block.levels == before
    for level, copy in enumerate(copies):
        own = 70 // merkle.FANOUT ** level
        assert other.levels[level][own] == copy
        assert other.levels[level][:own] + other.levels[level][own + 1:] == before[level][:own] + before[level][own + 1:]


# ---- 12


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a != b and (a[i + 1:] == b[i + 1:] if len(a) == len(b) else len(b) == len(a) + 1 and a[i:] == b[i + 1:])


@given(st.lists(st.tuples(st.integers(0, 5), st.lists(st.text("abé", max_size=1), min_size=1, max_size=25)), min_size=1, max_size=4),
       st.randoms(use_true_random=False))
@settings(max_examples=150, deadline=None)
def test_sorted_list_finds_all_pairs_one_edit_apart(sizes, rng):
    words, group = [], []
    for g, (m, many) in enumerate(sizes):
        own = {"".join(rng.choices("abé", k=rng.choice([m, m + 1]))) for _ in many}
        words += sorted(own)
        group += [g] * len(own)
    lengths = np.array([len(w) for w in words])
    width = max(1, int(lengths.max()))
    chars = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
    t, q = spelling.near_pairs(chars, lengths, np.array(group))
    assert sorted(zip(t.tolist(), q.tolist(), strict=True)) == sorted(
        (i, j) for i in range(len(words)) for j in range(len(words)) if group[i] == group[j] and one_edit(words[i], words[j]))


def plain_variants(counts):
    form = {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), None if form[w] is None else counts[form[w]]))
    return out


@pytest.mark.parametrize("limit", [3, 12, spelling.LIMIT])
def test_variants_against_brute_force(spark, limit):
    """Dense, repetitive words with ties; groups halved down to single places, batches cut between groups."""
    rng = random.Random(limit)
    words = {"".join(rng.choices("aab", k=rng.randrange(1, 9))) for _ in range(260)}
    words |= {"common" + "".join(rng.choices("xyéÿ", k=rng.choice([2, 3]))) for _ in range(60)} | {"é", "日本"}
    counts = {w: rng.choice([1, 2, 4, 4, 8, 16, 64, 300]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(frame, limit=limit).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert keyed(got) == keyed(plain_variants(counts))


def test_groups_are_bounded(spark):
    """A third of the vocabulary that shares its first half is halved until the groups are small."""
    words = [f"sharedprefix{a}{b}{c}{d}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh" for d in "abcdefgh"]
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    sizes = spelling.grouped(frame, 100).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.expr("hi - lo")).alias("wide"))
    assert sizes.where("n > 100 and wide > 1").isEmpty()


def test_batches_hold_whole_groups(monkeypatch):
    monkeypatch.setattr(spelling, "BATCH", 4)
    rows = [{"word": f"{k}word{c}", "n": i, "m": 6, "lo": 0, "hi": 7, "key": k}
            for k, n in (("a", 3), ("b", 9), ("c", 1), ("d", 2), ("e", 5)) for i, c in enumerate("pqrstuvwx"[:n])]
    table = pa.Table.from_pylist(rows)
    whole = spelling._nearest(table).to_pylist()
    parts = [r for b in spelling._scan(iter(table.to_batches(max_chunksize=2))) for r in b.to_pylist()]
    assert parts == whole and len(whole) == 19


def test_words_of_odd_texts(spark):
    texts = ["Straße naïve ABCDE abcde Abcde x×y÷zzzzz", None, "", "abcdé " * 7, "日本語abcdefg日本語 a-b-c-d-e", "q" * 200_000]
    frame = with_clashes(documents(spark, [t for t in texts for _ in range(3)]), ["word", "n", "run", "id", "h", "key"])
    want = collections.Counter()
    for i, t in enumerate(t for t in texts for _ in range(3)):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            at = h % len(run)
            want[run if h % 97 else run[:at] + run[at + 1:]] += 1
    want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert {r.word: r.n for r in spelling.word_counts(frame).collect()} == want
    assert spelling.spelling_variants(documents(spark, [])).count() == 0
    null_id = documents(spark, ["abcde abcde abcde"], ids=[None])
    assert [tuple(r) for r in spelling.spelling_variants(null_id).select("word", "root", "n_near").collect()] == [("abcde", "abcde", 0)]


# ---- 13


def archive(spark, pages, **params):
    files = warc.write_archives(pages, scratch_path(spark, "warc"), **params)
    return files.collect(), files


PAGES = "page_id long, url string, html string"


def odd_pages(rng):
    texts = [None, "", "x", "same", "é" * 50, "".join(rng.choices("abc \n", k=5000)), "WARC/1.1\r\n\r\n", "y" * 3_000_000]
    rows = [(i, rng.choice(["http://a/b?c=d", None, "h ttp://ü\r\nX: y"]), rng.choice(texts)) for i in range(200)]
    return rows + [(None, None, "same"), (None, "u", "only null"), (None, "u", "only null"), (900, "u", "same"), (900, "v", "same")]


@pytest.mark.parametrize(("least", "split"), [(0, 777), (3, 4096), (0, 1 << 23)])
def test_round_trip_of_odd_pages(spark, least, split):
    rows = odd_pages(random.Random(13))
    frame = with_clashes(spark.createDataFrame(rows, PAGES), ["id", "payload", "digest", "holder", "n", "key", "path"])
    listed, files = archive(spark, frame, least_bytes=least, file_bytes=50_000)
    assert sum(f.records for f in listed) == len(rows) and len(listed) > 1
    largest = collections.defaultdict(lambda: -1)
    for i, _, t in rows:
        largest[t or ""] = max(largest[t or ""], -1 if i is None else i)
    want = []
    for i, _, t in rows:
        body = (t or "").encode()
        holder = largest[t or ""] if len(body) >= least and i is not None and i < largest[t or ""] else None
        want.append((None if i is None else str(i), len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                     "response" if holder is None else "revisit", None if holder is None else str(holder),
                     body if holder is None else None))
    got = warc.read_archives(files, split).select(
        "record_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload").collect()
    assert keyed(got) == keyed(want)
    assert warc.read_archives(files, split, payload=False).where("payload is not null").isEmpty()


def test_files_are_plain_gzip_and_warc(spark):
    """What the standard library unpacks is one WARC record after another."""
    listed, _ = archive(spark, spark.createDataFrame([(1, "http://a", "one"), (2, "http://b", "one"), (3, None, "two")], PAGES))
    text = b"".join(gzip.open(f.path.removeprefix("file:")).read() for f in listed)
    assert text.count(b"WARC/1.1\r\n") == 3 and text.count(b"WARC-Type: revisit") == 1
    assert b"WARC-Refers-To: <urn:monthend:page:2>" in text
    for f in listed:
        data = open(f.path.removeprefix("file:"), "rb").read()
        assert len(data) == f.size and data.startswith(warc.MAGIC)


def window(data):
    return warc.Window(pa.BufferReader(data), len(data))


def plain_members(payloads):
    return [warc.packed(warc.record(i, f"http://{i}", p, base64.b32encode(hashlib.sha1(p).digest()).decode(), None, "d"))
            for i, p in enumerate(payloads)]


@given(st.lists(st.binary(max_size=300), min_size=1, max_size=8), st.integers(1, 400), st.sampled_from([1, 2, 7, 64, 1 << 20]))
@settings(max_examples=60, deadline=None)
def test_every_record_is_owned_by_the_range_it_starts_in(payloads, split, piece):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warc, "PIECE", piece)  # bytes read and unpacked at once
        check_ranges(payloads, split)


def check_ranges(payloads, split):
    members = plain_members(payloads)
    data = b"".join(members)
    starts = np.cumsum([0, *map(len, members)])[:-1]
    found = [r for at in range(0, len(data), split) for r in warc.records_in(window(data), at, at + split)]
    assert [r["start"] for r in found] == starts.tolist()
    assert [r["payload"] for r in found] == payloads


def test_false_magic_padding_and_foreign_members(monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 64)  # records cut by every piece
    a, b = plain_members([b"one", b"\x1f\x8b\x08" * 40 + bytes(range(256)) * 30])
    foreign = gzip.compress(b"no record at all")
    data = warc.MAGIC + b"junk" + a + b"\0" * 500 + warc.MAGIC + foreign + b + b"\x1f\x8b"
    for split in (50, 333, len(data)):
        found = [r for at in range(0, len(data), split) for r in warc.records_in(window(data), at, at + split)]
        assert [r["record_id"] for r in found] == ["0", "1"]


def test_no_member_holds_what_looks_like_a_record():
    """A payload that is itself an archive and does not compress."""
    inner = plain_members([random.Random(1).randbytes(4000)])[0]
    (outer,) = plain_members([random.Random(2).randbytes(70_000) + inner * 3 + random.Random(3).randbytes(70_000)])
    found = [r for at in range(0, len(outer), 1000) for r in warc.records_in(window(outer), at, at + 1000)]
    assert [r["start"] for r in found] == [0]


def test_damage_is_an_error():
    (a,) = plain_members([b"payload " * 50])
    with pytest.raises((EOFError, zlib.error)):
        list(warc.records_in(window(a[:-20]), 0, len(a)))
    wrong = warc.packed(warc.record(1, None, b"x", "A" * 32, None, "d"))
    with pytest.raises(ValueError, match="digest"):
        list(warc.records_in(window(wrong), 0, len(wrong)))


def test_hot_payloads_are_found_without_their_own_task(spark):
    rows = [(i, "u", "hot" if i % 3 else f"own {i // 6}") for i in range(600)] + [(1000, "u", "hot")]
    frame = warc.with_holders(spark.createDataFrame(rows, PAGES), "page_id", "url", "html", 0)
    got = {r.id: r.holder for r in frame.collect()}
    assert all(got[i] == 1000 for i in range(600) if i % 3) and got[1000] is None
    assert all(got[i] == (i + 3 if i % 6 == 0 else None) for i in range(0, 600, 3))


def test_empty_tables(spark):
    assert warc.archive_round_trip(spark, spark.createDataFrame([], PAGES)).count() == 0
