"""Parts of the operators: codings, signatures, sums, splits and edge cases."""

import hashlib
import math
import struct
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import oracle
import public_tokenizers
from plan import executed
from quotelake.llm import (bagminhash, chat_windows, common, decontaminate, host_quality, license_scan, mixing, queries,
                           sharding, substring_dedup, token_files, url_reputation)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))

# Nulls in every column, empty and very long texts, ties and repeated rows.
ODD_ROWS = [
    (1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (2, None, None, None, None),
    (None, "null id text of some words here", "en", None, 1), (3, "", "de", "s", 0), (4, LONG, "en", "t", len(LONG)),
    (5, LONG, "en", "t", len(LONG)), (6, " \t\n\r ", None, "", 5), (7, "é ü 漢字 \u0000 \U0001F600", "fr", "s", 9),
    (8, "x" * 200_000, "en", "u", 200_000), (9, "same same " * 400, "en", "u", 4000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def clashing(odd):
    names = ["size", "node", "label", "bad", "n", "target", "start", "hash", "depth", "kept", "bands", "term", "shingle",
             "digest", "file", "key_a", "key_b", "taken", "text2", "bucket", "first"]
    return odd.select("*", *(F.lit("clash").alias(n) for n in names))


# ---- token files

@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=9), max_size=8))
def test_packed_values_come_back(runs):
    ends = np.cumsum([len(r) for r in runs], dtype=np.int64)
    values = np.array([v for r in runs for v in r], dtype=np.uint32)
    control, data = token_files.pack(values, ends)
    assert token_files.unpack(control, data, np.array([len(r) for r in runs], dtype=np.int64)).tolist() == values.tolist()
    assert [len(c) for c in control.to_pylist()] == [math.ceil(len(r) / 4) for r in runs]


def test_words_encode_like_whole_texts():
    from tokenizers import Tokenizer
    path = public_tokenizers.path(queries.TOKENIZER)
    texts = ["It's a don't-know, 12.5%!", "", "  two\u00a0spaces\u3000and\ttabs\nlines \u0301x", "<|endoftext|> a<|startoftext|>b <| c",
             "ÀÉ İstanbul ΣΑΣ", "a\x1cb\x85c", "x" * 3000, "e\u0301 \u0301e"]
    ids, ends = token_files.WordEncoder.of(path).encode(pa.array(texts + [None]), 2)
    whole = Tokenizer.from_file(path)
    for text, begin, end in zip([*texts, ""], [0, *ends.tolist()], ends.tolist()):
        assert ids[begin:end].tolist() == whole.encode(text, add_special_tokens=False).ids + [2]


def test_slices_are_bounded_and_whole(monkeypatch):
    from quotelake.llm import text_slices
    monkeypatch.setattr(text_slices, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["aaaa", None, "bbbbbbb", "c" * 50, "d", ""])], names=["t"])
    parts = [p.column(0).to_pylist() for p in text_slices.slices(batch, 0)]
    assert sum(parts, []) == batch.column(0).to_pylist()
    assert all(sum(len(x or "") for x in p[:-1]) <= 10 for p in parts)


def whole_tokens(path, rows, end_id):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        yield doc_id, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_token_files_of_odd_rows(spark, odd, none, clashing):
    path = public_tokenizers.path(queries.TOKENIZER)
    for docs in (odd, clashing):
        got = token_files.token_digests(spark, token_files.write_token_files(docs, path, 2, files=3)).collect()
        expected = whole_tokens(path, [(r[0], r[1]) for r in ODD_ROWS], 2)
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(
            (i is not None, i or 0, n, c) for i, n, c in expected)
        ordered = sorted(got, key=lambda r: r.start)
        assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1].tolist()
        assert [r.doc_id for r in ordered] == sorted((r[0] for r in ODD_ROWS), key=lambda i: (i is not None, i or 0))
    assert token_files.token_digests(spark, token_files.write_token_files(none, path, 2)).collect() == []


# ---- near-duplicates

def test_signatures_estimate_weighted_jaccard_without_bias():
    rng = np.random.default_rng(3)
    off = []
    for _ in range(40):
        element = np.unique(rng.integers(0, 2 ** 63, 150).astype(np.uint64))
        a = rng.integers(1, 12, len(element))
        b = np.maximum(1, a + rng.integers(-4, 5, len(element)))
        kept = rng.random(len(element)) < 0.8
        bags = [(element, a), (element[kept], b[kept])]
        both = np.minimum(a, b)[kept].sum()
        times = bagminhash.signatures(bags, 512)
        off.append((times[0] == times[1]).mean() - both / (a.sum() + b[kept].sum() - both))
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.035


def test_a_signature_does_not_depend_on_the_other_texts():
    bags = [bagminhash.shingle_bag(t) for t in ("a b c d e f a b c d e f", LONG, "x", "")]
    together = bagminhash.signatures(bags)
    for bag, row in zip(bags, together):
        assert (bagminhash.signatures([bag])[0] == row).all()


@pytest.mark.parametrize("change", [0, 1, 2])
def test_overlap_counts_repeats(change):
    bag = bagminhash.flat_bag(bagminhash.shingle_bag("a b c d e " * 6))
    assert len(bag) == 26 and len(np.unique(bag)) == 26
    other = bagminhash.flat_bag(bagminhash.shingle_bag("a b c d e " * (6 + change)))
    assert bagminhash.overlaps(bag, other) == (100 * 26 >= 80 * (26 + 5 * change))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 200), (200, 250)]
    frame = spark.createDataFrame([(min(x), max(x)) for x in links], "a long, b long")
    got = {r.node: r.label for r in bagminhash.components(frame).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 200, 200: 200, 250: 200}


def test_classes_of_odd_rows(odd, none, clashing):
    for docs in (odd, clashing):
        rows = bagminhash.classes(docs).collect()
        assert len(rows) == len(ODD_ROWS)
        assert {r.doc_id: r.class_id for r in rows} == {1: 1, 2: 2, None: None, 3: 2, 4: 4, 5: 4, 6: 2, 7: 7, 8: 8, 9: 9}
        once = bagminhash.one_of_each(docs)
        assert once.columns == docs.columns
        assert sorted(r.doc_id or 0 for r in once.collect()) == [0, 1, 2, 4, 7, 8, 9]
    assert bagminhash.classes(none).collect() == [] and bagminhash.one_of_each(none).collect() == []


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        words[rng.integers(0, 120)] = f"new{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"other{i}x{k}" for k in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (512, 20):
        got = {r.doc_id: r.class_id for r in bagminhash.classes(docs, block).collect()}
        assert got == {i: 0 if i < 1000 else i for i, _ in rows}


# ---- repeats

def test_gear_hash_is_a_sum_over_sixteen_bytes():
    data = np.frombuffer(bytes(range(40, 100)), np.uint8)
    got = substring_dedup.gear_hash(data)
    for i in (0, 7, 20, 59):
        expected = sum(int(substring_dedup.GEAR[data[i - k]]) << k for k in range(min(16, i + 1))) % (1 << 16)
        assert got[i] == expected


def test_repeats_of_odd_rows(odd, none, clashing):
    for docs in (odd, clashing):
        rows = substring_dedup.find_repeats(docs).collect()
        assert {(r.doc_id, r.start, r.n_chars, r.kept) for r in rows} == {(4, 0, len(LONG), True), (5, 0, len(LONG), False)}
        left = substring_dedup.remove_repeats(docs)
        assert left.columns == docs.columns
        assert {r.doc_id: r.text for r in left.collect()} == {r[0]: r[1] for r in ODD_ROWS} | {5: ""}
    assert substring_dedup.find_repeats(none).collect() == []


def test_adjacent_passages_of_different_keepers_are_each_left_once(spark):
    rng = np.random.default_rng(11)

    def passage(n):
        return " ".join("".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(n))

    a, b, ends = passage(90), passage(90), [passage(60) for _ in range(6)]
    docs = spark.createDataFrame([(3, ends[0] + a + ends[1]), (5, ends[2] + a + b + ends[3]), (9, ends[4] + b + ends[5])],
                                 "doc_id long, text string")
    found = {(r.doc_id, r.kept): r.first_id for r in substring_dedup.find_repeats(docs).collect()}
    assert found == {(3, True): 3, (5, False): 3, (5, True): 5, (9, False): 5}
    left = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    assert [i for i, t in left.items() if a in t] == [3] and [i for i, t in left.items() if b in t] == [5]


def test_every_shared_window_of_51_words_is_found(spark):
    rng = np.random.default_rng(51)

    def words(n, least, most, pool="abcdefghijklmnopqrstuvwxyz"):
        return " ".join("".join(rng.choice(list(pool), rng.integers(least, most + 1))) for _ in range(n))

    rows, shared = [], []
    for i in range(400):
        least, most = ((1, 1), (2, 4), (3, 8), (1, 3))[i % 4]
        passage = words(51, least, most, "abé漢" if i % 3 == 0 else "abcdefghijklmnopqrstuvwxyz")
        if i % 10 == 0:
            passage = " ".join([words(1, 1, 2, "漢é") + str(i)] * 60)  # one word over and over
        for doc_id in (2 * i, 2 * i + 1):
            before, after = words(rng.integers(0, 40), 2, 7), words(rng.integers(0, 40), 2, 7)
            rows.append((doc_id, f"{before} #{doc_id}# {passage} #{doc_id}# {after}"))
        shared.append(passage)
    texts = dict(rows)
    found = {}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in substring_dedup.find_repeats(docs).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.start + r.n_chars, r.first_id, r.kept))
    for i, passage in enumerate(shared):
        for doc_id in (2 * i, 2 * i + 1):
            begin = texts[doc_id].index(passage)
            if len(passage) >= substring_dedup.MIN_CHARS:
                assert any(a <= begin and begin + len(passage) <= b for a, b, _, _ in found[doc_id]), (doc_id, passage)
    left = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    for i, passage in enumerate(shared):
        if len(passage) >= substring_dedup.MIN_CHARS:
            assert passage in left[2 * i] and passage not in left[2 * i + 1]


@pytest.mark.parametrize("group", [substring_dedup.GROUP, 2, 0])
def test_passages_equal_brute_force(spark, group):
    rng = np.random.default_rng(3)
    size = substring_dedup.MIN_CHARS
    pieces = ["".join(rng.choice(list("ab é"), rng.integers(40, 260))) for _ in range(12)] + ["ab" * 90, "a" * 150]
    rows = [(i, "".join(pieces[j] for j in rng.integers(0, len(pieces), rng.integers(1, 7)))) for i in range(80)]
    holders = {}
    for i, text in rows:
        for k in range(len(text) - size + 1):
            holders.setdefault(text[k:k + size], set()).add((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {}
    for r in substring_dedup.find_repeats(docs, group=group).collect():
        found.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        own, others = set(), set()
        for k in range(len(text) - size + 1):
            who = holders[text[k:k + size]]
            if len(who) > 1:
                (own if min(w[0] for w in who) == i else others).update(range(k, k + size))
        got = {kept: {c for r in found.get(i, []) if r.kept == kept for c in range(r.start, r.start + r.n_chars)} for kept in (True, False)}
        assert got[True] == own
        assert got[False] <= others - own
        missing = np.array(sorted(others - own - got[False]), int)
        assert all(len(run) < size for run in np.split(missing, np.flatnonzero(np.diff(missing) > 1) + 1))
    left = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    for window, who in holders.items():
        if len(who) > 1:
            assert window in left[min(who)[0]]


# ---- decontamination, quality, licences

def test_contamination_of_odd_rows(spark, odd, none, clashing):
    items = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (None, "null id text of some words here"),
                                   (3, ""), (4, "a b c")], "item_id long, text string")
    for docs in (odd, clashing):
        got = [(r.doc_id, r.item_id, r.n_found) for r in decontaminate.contamination(docs, items.withColumn("n", F.lit(0))).collect()]
        assert got == [(1, 1, 3)]
        clean = decontaminate.clean_documents(docs, items)
        assert clean.columns == docs.columns and clean.count() == len(ODD_ROWS) - 2
    assert decontaminate.contamination(none, items).collect() == []
    assert decontaminate.clean_documents(odd, items.limit(0)).count() == len(ODD_ROWS)


def test_measures_of_a_text():
    text = "a b c a b c\n\na b c\nx y #%\na b c"
    assert host_quality.measure_text(text) == (15, 16, 2, 1, 12)
    assert host_quality.measure_text(None) == host_quality.measure_text("") == (0, 0, 0, 0, 0)


def test_quality_of_odd_rows(odd, none, clashing):
    for docs in (odd, clashing):
        rows = host_quality.judge(docs).collect()
        assert len(rows) == len(ODD_ROWS)
        assert {r.doc_id for r in rows if r.kept} == {4, 5}
        kept = host_quality.keep_documents(docs)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5]
    assert host_quality.judge(none).collect() == [] and host_quality.keep_documents(none).collect() == []


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, "short" if i % 10 else good, "bad") for i in range(200)]
    rows += [(1000 + i, good if i % 10 else "short", f"good{i % 7}") for i in range(400)] + [(5000, good, "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in host_quality.judge(docs).filter("kept").collect()}
    assert kept == {i for i, text, source in rows if text == good and source != "bad"}


def test_licences_of_odd_paths(spark, none):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.py", "nothing here"), (3, "a/b/y.py", None),
        (4, "z.py", "text"), (5, None, "Licensed under the Apache License, Version 2.0.\n" + LONG), (6, "a/b/c/own.py", LONG + "\nAll rights reserved."),
        (7, "a/b/LICENSE", "licensed under the apache license, version 2.0"), (8, "b/x", ""), (8, "b/x", ""), (None, "a/b/c/d/n.py", "x"),
        (9, "ab/x.py", "the License of the kings, under which all Version numbers are 2.0 or the like, was long")]
    files = spark.createDataFrame(rows, "file_id long, path string, text string").select("*", *(F.lit("clash").alias(n) for n in (
        "dir", "row_key", "low", "of_line", "of_text", "terms", "term", "template", "line", "licence", "from_dir")))
    got = {(r.file_id, r.path): (r.licence, r.origin, r.from_dir) for r in license_scan.scan(files).collect()}
    expected = {1: ("MIT", "statement", None), 2: ("Apache-2.0", "directory", "a/b"), 3: ("Apache-2.0", "directory", "a/b"),
                4: (None, None, None), 5: ("Apache-2.0", "statement", None), 6: ("all-rights-reserved", "statement", None),
                7: ("Apache-2.0", "statement", None), 8: (None, None, None), None: ("Apache-2.0", "directory", "a/b"), 9: (None, None, None)}
    assert got == {(i, p): expected[i] for i, p, _ in rows}
    assert license_scan.scan(files.limit(0)).collect() == []


def test_licence_texts_headers_and_wrapped_statements(spark):
    def file(name):
        return license_scan.TEXTS[name]

    apache = "\n".join(f"# {line}" for line in license_scan.HEADERS["Apache-2.0"].split("\n"))
    gpl = "/*\n" + "\n".join(f" * {' '.join(words[i:i + 7])}" for words in [license_scan.HEADERS["GPL-3.0"].split()]
                              for i in range(0, len(words), 7)) + "\n */"
    prose = [(100 + i, f"p/{i}.txt", " ".join(f"w{(i * 7 + k * k) % 97}" for k in range(200))) for i in range(30)]
    rows = [
        (1, "m/LICENSE", file("MIT").replace("MIT License", "The MIT License\n\nCopyright (c) 2020 Some One")), (2, "m/src/a.py", "w1 w2"),
        (3, "g/COPYING", file("GPL-3.0")), (4, "g/a/b/c.py", "w3"), (5, "x/a.py", f"{apache}\n\nimport w1\n{prose[0][2]}"),
        (6, "x/b.c", f"{gpl}\nint w1;\n{prose[1][2]}"), (7, "x/c.py", "w5 w6\nThis work is licensed under the GNU\nGeneral Public License, version 3.\n" + prose[2][2]),
        (8, "x/d.py", "w8"), (9, "b/LICENSE", "Copyright (c) 2001 A B.\nAll rights reserved.\n" + file("BSD-3-Clause")),
        (10, "b/x", ""), (11, "h/LICENSE", file("Apache-2.0")), (12, "h/x", None), *prose]
    files = spark.createDataFrame(rows, "file_id long, path string, text string")
    got = {r.file_id: (r.licence, r.origin, r.from_dir) for r in license_scan.scan(files).collect()}
    stated = {1: "MIT", 3: "GPL-3.0", 5: "Apache-2.0", 6: "GPL-3.0", 7: "GPL-3.0", 9: "BSD-3-Clause", 11: "Apache-2.0"}
    given = {2: ("MIT", "m"), 4: ("GPL-3.0", "g"), 10: ("BSD-3-Clause", "b"), 12: ("Apache-2.0", "h")}
    for i, _, _ in rows:
        expected = (stated[i], "statement", None) if i in stated else (given[i][0], "directory", given[i][1]) if i in given else (None,) * 3
        assert got[i] == expected, (i, got[i])


def test_licence_tags(spark):
    code = "\n".join(f"let w{i} = w{i * 7 % 31} + mit;" for i in range(60))
    rows = [
        (1, "a/x.c", f"// SPDX-License-Identifier: MIT\n{code}"), (2, "a/y.py", f"#!/bin/sh\n# spdx-license-identifier:\t(GPL-3.0-or-later)\n{code}"),
        (3, "b/z.css", f"/* SPDX-License-Identifier: LGPL-2.1+ */\n{code}"), (4, "b/w.html", f"<!-- SPDX-License-Identifier: CC-BY-SA-4.0 -->\n{code}"),
        (5, "c/of.c", f"// SPDX-License-Identifier: Zlib\n{code}"), (6, "c/empty.c", f"// SPDX-License-Identifier:\n{code}"),
        (7, "c/two.c", f"// SPDX-License-Identifier: MIT OR Apache-2.0\n{code}"), (8, "c/said.c", f"{code}\nmit license identifier\n"),
        (9, "d/tag.c", "SPDX-License-Identifier: MIT"), (10, "d/other.c", "w1 w2 mit"),
        (11, "d/text.c", f"{license_scan.HEADERS['Apache-2.0']}\nSPDX-License-Identifier: MIT\n{code}"),
        (12, "e/both.c", f"SPDX-License-Identifier: MPL-2.0\nReleased under the MIT License.\n{code}"),
        *((20 + i, "f/x.c", "// SPDX-License-Identifier: Apache-2.0\n" + code) for i in range(12))]
    files = spark.createDataFrame(rows, "file_id long, path string, text string")
    got = {r.file_id: (r.licence, r.origin) for r in license_scan.scan(files).collect()}
    stated = {1: "MIT", 2: "GPL-3.0", 3: "LGPL-2.1", 4: "CC-BY-SA-4.0", 9: "MIT", 11: "Apache-2.0", 12: "MIT",
              **{20 + i: "Apache-2.0" for i in range(12)}}
    assert got == {i: (stated[i], "statement") if i in stated else (None, None) for i, _, _ in rows}


def test_licence_tags_equal_sql(spark, tmp_path):
    lines = [*license_scan.TAGS, *license_scan.TEMPLATES.values(), "SPDX-License-Identifier: Zlib", "// SPDX-License-Identifier:\tMIT"]
    rows = [(i, None if i % 50 == 49 else "\n".join(
        [" ".join(f"w{(i * k + k * k) % 83}" for k in range(60)), *([lines[i % 41]] if i % 41 < len(lines) else []), "last words"]), f"s{i % 2}")
        for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
        difference = oracle.compare(queries.op1_license_scan(spark, str(tmp_path)), con, queries.ORACLES["op1_license_scan"])
    assert difference is None, difference


# ---- sharding, mixing

@pytest.mark.parametrize("limit", [300, 5_000, 10 ** 9])
def test_shards_fit_and_split_only_what_is_too_large(spark, limit):
    rows = [(i, "x" * (17 * i % 101)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(docs, limit).collect()
    assert len(got) == len(rows) and sum(r.bytes for r in got) == sum(len(t) for _, t in rows)
    sizes = {}
    for r in got:
        assert len(r.shard) == r.depth
        sizes[r.shard] = sizes.get(r.shard, 0) + r.bytes
    assert all(r.shard_bytes == sizes[r.shard] <= limit and not r.oversized for r in got)
    names = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for name in names:  # the bucket above each shard had to split
        if name:
            assert sum(n for other, n in sizes.items() if other.startswith(name[:-1])) > limit


def test_rows_that_no_bit_divides_are_marked(spark, odd, none, clashing):
    docs = spark.createDataFrame([(1, "x" * 50)] * 20 + [(i, "y") for i in range(2, 50)], "doc_id long, text string")
    got = sharding.shard(docs, 100).collect()
    assert {r.doc_id for r in got if r.oversized} == {1} and {r.depth for r in got if r.oversized} == {sharding.BITS}
    assert all(r.shard_bytes <= 100 for r in got if not r.oversized)
    for frame in (odd, clashing):
        assert sharding.shard(frame).count() == len(ODD_ROWS)
    assert sharding.shard(none).collect() == []


def test_no_directory_is_broadcast_for_its_small_file(spark, monkeypatch):
    rows = [(i, "x" * (17 * i % 101)) for i in range(500)] + [(1000 + i, "y" * 400) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    measured = sharding.shard(docs, 300)
    assert "BroadcastHashJoin" in executed(measured)
    plans, stage_table = [], sharding.stage_table
    monkeypatch.setattr(sharding, "stage_table", lambda df, name: plans.append(executed(df)) or stage_table(df, name))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    merged = sharding.shard(docs, 300)
    plans.append(executed(merged))
    assert len(plans) > 5 and not any("Broadcast" in p for p in plans)
    assert sorted(merged.collect()) == sorted(measured.collect())
    assert {r.doc_id for r in merged.collect() if r.oversized} == set(range(1000, 1009))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_targets_stop_at_twice_the_source(spark, sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    table = spark.createDataFrame(list(enumerate(zip(sizes, weights))), "i int, of struct<source_size:long, weight:int>")
    targets = [r.target for r in sorted(mixing.fill(table.select("i", "of.*")).collect())]
    assert sum(targets) == pytest.approx(1.5 * sum(sizes))
    assert all(0 <= t <= 2 * s + 1e-6 for t, s in zip(targets, sizes))
    level = max((t / w for t, s, w in zip(targets, sizes, weights) if t < 2 * s - 1e-6), default=None)
    if level is not None:  # sources below their limit share one level, the others are below it
        assert all(t == pytest.approx(level * w) or t <= level * w + 1e-6 for t, w in zip(targets, weights))


@pytest.mark.parametrize("block", [7, 64, 1024])
def test_the_mix_takes_its_targets_in_an_even_order(spark, block):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), f"s{i % 4}" if i % 9 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed, sources = mixing.streams(docs)
    pieces = mixing.mix(placed, sources, block).collect()
    targets = {r.source_no: r.target for r in sources.collect()}
    taken, by_doc = {}, {}
    for r in pieces:
        taken[r.source_no] = taken.get(r.source_no, 0) + r.n_words
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.n_words
    assert taken == {n: int(t) for n, t in targets.items()}
    assert all(by_doc.get(i, 0) <= 2 * len(t.split()) for i, t, _ in rows)
    if block == 7:  # every hundred slots hold each source near its share
        slots = sorted({(r.position, r.source_no) for r in pieces})
        total = sum(targets.values())
        for k in range(0, len(slots) - 100, 100):
            for n, target in targets.items():
                assert abs(sum(s == n for _, s in slots[k:k + 100]) - 100 * target / total) <= 8


@pytest.mark.parametrize("broadcast", [True, False])
def test_many_sources_meet_their_targets(spark, monkeypatch, broadcast):
    # One source with half of all words, thousands with one or a few; several ranges of sources.
    if not broadcast:
        monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(mixing, "SOURCES_PER_RANGE", 100)
    rows = [(i, "w " * (1 + i % 5), f"s{i}") for i in range(700)] + [(1000 + i, "w " * 50, "hot") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed, sources = mixing.streams(docs)
    listed = sources.orderBy("source_no").collect()
    assert [(r.source_no, r.source) for r in listed] == list(enumerate(sorted({s for _, _, s in rows})))
    pieces = mixing.mix(placed, sources, 4).collect()
    taken = {r.source_no: 0 for r in listed}
    for r in pieces:
        taken[r.source_no] += r.n_words
    assert taken == {r.source_no: int(r.target) for r in listed}
    slots = {(r.position, r.source_no) for r in pieces}
    assert len(slots) == len({p for p, _ in slots})  # one source a position


def test_mixed_texts_are_the_words_of_their_pieces(spark, odd, none, clashing):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(1 + i * 7 % 40)), f"s{i % 4}" if i % 9 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    words = {i: t.split() for i, t, _ in rows}
    got = mixing.mixed_texts(docs, 16)
    pieces = got.collect()
    assert [(r.position, r.in_block) for r in pieces] == sorted((r.position, r.in_block) for r in pieces)
    assert all(r.text.split(" ") == words[r.doc_id][r.first_word:r.first_word + r.n_words] for r in pieces)
    assert all(r.source == rows[r.doc_id][2] for r in pieces)
    taken = {}
    for r in pieces:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.n_words
    assert taken == {r.doc_id: r.taken for r in mixing.taken_words(docs).collect() if r.taken}
    for frame in (odd, clashing):
        pieces = mixing.mixed_texts(frame).collect()
        assert sum(r.n_words for r in pieces) == sum(r.taken for r in mixing.taken_words(frame).collect())
        assert all(len(r.text.split(" ")) == r.n_words <= mixing.BLOCK_WORDS for r in pieces)
    assert mixing.mixed_texts(none).collect() == []


def test_mix_of_odd_rows(odd, none, clashing):
    for docs in (odd, clashing):
        rows = mixing.taken_words(docs).collect()
        assert len(rows) == len(ODD_ROWS)
        assert all(0 <= r.taken <= 2 * r.size for r in rows)
        for source in {r.source for r in rows}:
            own = [r for r in rows if r.source == source]
            assert sum(r.taken for r in own) == int(own[0].target) and sum(r.size for r in own) == own[0].source_size
        mixed = mixing.mixed_documents(docs)
        assert mixed.columns == docs.columns
        assert sum(len((r.text or "").encode().split()) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.taken_words(none).collect() == [] and mixing.mixed_documents(none).collect() == []


@pytest.mark.parametrize("flip", [False, True])
def test_a_null_is_no_value_of_the_next_column(spark, flip):
    rows = [(1, None, "alpha"), (1, "alpha", None), (1, "alpha", "beta"), (None, "alpha", "1")]
    docs = spark.createDataFrame(rows[::-1] if flip else rows, "doc_id long, source string, text string").coalesce(1)
    mixed = sorted(map(repr, mixing.mixed_documents(docs).collect()))
    taken = {(r.doc_id, r.source, r.size): r.taken for r in mixing.taken_words(docs).collect()}
    assert len({r.key_a for r in mixing.taken_words(docs).collect()}) == 4
    words = {r: (r[2] or "") for r in rows}
    expected = [repr(r) for row in rows for r in [next(x for x in docs.collect() if tuple(x) == row)] * int(
        taken.get((row[0], row[1], len(words[row].split())), 0)) if words[row]]
    assert mixed == sorted(expected)
    files = spark.createDataFrame([(1, None, "Released under the MIT License."), (1, "Released under the MIT License.", None)],
                                  "file_id long, path string, text string").coalesce(1)
    found = license_scan.scan(files.orderBy(F.col("path").isNull()) if flip else files).collect()
    assert {(r.path, r.licence) for r in found} == {(None, "MIT"), ("Released under the MIT License.", None)}


def test_golden_points_are_spread(spark):
    points = [r.x for r in spark.range(1000).select(mixing.golden_points(F.col("id")).alias("x")).collect()]
    for cut in (0.1, 0.37, 0.5, 0.9):
        assert abs(sum(p < cut for p in points) - 1000 * cut) < 6


def test_prefix_sums_over_buckets(spark):
    rows = [(i % 3 if i % 7 else None, i // 10, i, i % 5) for i in range(120)]
    got = common.prefix_sums(spark.createDataFrame(rows, "g int, b int, o int, v long"), ["g"], "b", ["o"], "v", "s")
    for r in got.collect():
        assert r.s == sum(v for g, b, o, v in rows if g == r.g and (b, o) < (r.b, r.o))


# ---- urls

def test_urls_and_rules(spark):
    urls = ["http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "http://x.net/es/1", "http://net/fr/", None, "no scheme",
            "http://example.com", "ftp://u.org?x", "http://a.com#b", "x://y://z.com/p", "http://badexample.com/en/", "http://h.com:80/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.filter_urls(pages, labels, queries.URL_RULES).collect()}
    assert got == {
        0: ("a.example.com", "/en/x", "example.com/en/", "block"), 1: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        2: ("x.net", "/es/1", "net/es/", "block"), 3: ("net", "/fr/", "net/fr/", "block"), 4: ("", "", None, "allow"),
        5: ("", "", None, "allow"), 6: ("example.com", "", None, "allow"), 7: ("u.org", "", None, "allow"), 8: ("a.com", "", None, "allow"),
        9: ("y:", "//z.com/p", None, "allow"), 10: ("badexample.com", "/en/", "com/", "allow"), 11: ("h.com:80", "/en/", None, "allow")}


def test_pages_and_labels_may_repeat_or_be_missing(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (2, "http://a.org/y"), (None, "http://b.org/"), (3, None)],
                                  "page_id long, url string").select("*", *(F.lit("clash").alias(n) for n in ("site", "n", "low", "domain", "bad", "path")))
    labels = spark.createDataFrame([(1, True), (1, None), (2, None), (9, True), (None, True)], "page_id long, bad boolean")
    got = url_reputation.filter_urls(pages, labels, []).collect()
    assert len(got) == 5 and {(r.host, r.site_n, r.site_bad) for r in got} == {("a.org", 3, 2), ("b.org", 0, 0), ("", 0, 0)}
    assert url_reputation.filter_urls(pages.limit(0), labels, queries.URL_RULES).collect() == []
    assert url_reputation.filter_urls(pages, labels.limit(0), []).count() == 5


def test_ports_user_names_and_addresses(spark):
    urls = ["http://shop.example.org:8080/a", "http://u:p@shop.example.org/b", "http://10.0.0.1/", "http://99.7.0.1:80/", "http://[::1]:80/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.domain, r.site_n) for r in url_reputation.filter_urls(
        pages, spark.createDataFrame([(0, False), (2, True)], "page_id long, bad boolean"), []).collect()}
    assert got == {0: ("shop.example.org:8080", "example.org", 1), 1: ("u:p@shop.example.org", "example.org", 1),
                   2: ("10.0.0.1", "10.0.0.1", 1), 3: ("99.7.0.1:80", "99.7.0.1", 0), 4: ("[::1]:80", "[::1]", 0)}


def test_reputation_is_shrunk_to_the_domain(spark):
    rows = [("bad.spam.org", int(i % 20 != 0)) for i in range(400)] + [("one.spam.org", 0)] * 2 + [("one.fine.net", 1)]
    rows += [(f"h{i % 15}.fine.net", int(i % 25 == 0)) for i in range(900)] + [("new.spam.org", None), ("new.fine.net", None), ("", None)]
    observed = spark.createDataFrame(rows, "host string, bad int")
    got = {r.host: r.blocked for r in url_reputation.reputation(observed).collect()}
    assert got["bad.spam.org"] and not got["one.fine.net"] and not got["new.fine.net"] and not got["h3.fine.net"] and not got[""]
    assert url_reputation.reputation(observed.limit(0)).collect() == []


def test_a_table_of_suffixes_parts_strangers(spark):
    names = spark.createDataFrame([(s,) for s in ("za", "co.za", "io", "github.io", "*.ck", "!www.ck")], "suffix string")
    hosts = spark.createDataFrame([(h,) for h in ("a.b.co.za", "x.github.io", "a.b.c.ck", "a.www.ck", "q.co.uk", "co.za", "")], "host string")
    got = {r.host: (r.domain, r.suffix) for r in url_reputation.with_domains(hosts, names).collect()}
    assert got == {"a.b.co.za": ("b.co.za", "co.za"), "x.github.io": ("x.github.io", "github.io"), "a.b.c.ck": ("b.c.ck", "c.ck"),
                   "a.www.ck": ("www.ck", "ck"), "q.co.uk": ("q.co.uk", "co.uk"), "co.za": ("co.za", "co.za"), "": ("", "")}
    rows = [("bad.co.za", True)] * 300 + [("fine.com", False)] * 300 + [("new.co.za", None)]
    observed = spark.createDataFrame(rows, "host string, bad boolean").withColumn("bad", F.col("bad").cast("int"))
    domains = {r.host: r.domain for r in url_reputation.reputation(observed, suffixes=names).collect()}
    assert domains["new.co.za"] != domains["bad.co.za"]


def test_registered_domains(spark):
    hosts = ["a.b.co.uk", "b.com", "com", "", "x.y.z.org"]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r.host: (r.d, r.s) for r in frame.select("host", url_reputation.registered_domain(F.col("host")).alias("d"),
                                                    url_reputation.suffix(F.col("host")).alias("s")).collect()}
    assert got == {"a.b.co.uk": ("b.co.uk", "co.uk"), "b.com": ("b.com", "com"), "com": ("com", "com"), "": ("", ""), "x.y.z.org": ("z.org", "org")}


# ---- chat

CHAT = "conv_id long, turn long, role string, text string"
NASTY = ["<|im_end|>", "\\", "<", "|", "<\\", "\\s\\p\\n", "\\\\<|im_start|>x\n<|im_end|>\n", "<|<|", "", None, "a\nb\n", "<\\|", "<\\p", "\n"]


def expected_digests(rows):
    result = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        shown = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        result[conv] = (len(turns), hashlib.sha256(shown.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return result


def digests(frame):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_windows.digests(frame).collect()}


def test_control_strings_come_back(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(NASTY)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(NASTY)] + [(None, 0, None, "x"), (None, None, "ro\nle\\n<|", "y"), (3, 0, "assistant", None)]
    rows += [(4, 1, "user", "tie"), (4, 1, "user", "tie"), (4, 1, "assistant", "tie")]
    frame = spark.createDataFrame(rows, CHAT).withColumn("before", F.lit("clash")).withColumn("size", F.lit("clash"))
    formatted = chat_windows.windows(frame)
    assert digests(formatted) == expected_digests(rows)
    assert not any("<|" in r.text.replace(chat_windows.START, "").replace(chat_windows.END, "") for r in formatted.collect())
    assert chat_windows.windows(frame.limit(0)).collect() == []


def test_a_very_long_turn(spark):
    rows = [(1, 0, "user", "short"), (1, 1, "assistant", "\\<|x\n " * 100_000), (1, 2, "assistant", "")]
    formatted = chat_windows.windows(spark.createDataFrame(rows, CHAT))
    assert digests(formatted) == expected_digests(rows)


@pytest.mark.parametrize("block", [5, 1024])
def test_windows_keep_the_budget_and_every_target_once(spark, monkeypatch, block):
    monkeypatch.setattr(chat_windows, "TURNS_PER_BLOCK", block)
    rng = np.random.default_rng(4)
    rows = [(1, 0, "system", "be kind")]
    rows += [(1, i, ["user", "assistant"][i % 2], " ".join(f"t{i}w{k}" for k in range(rng.integers(0, 60)))) for i in range(1, 200)]
    rows += [(2, i, ["user", "assistant"][i % 2], " ".join(f"u{i}w{k}" for k in range(rng.integers(0, 20)))) for i in range(30)]
    rows += [(3, 0, "user", "short"), (3, 1, "assistant", "long " * 900), (3, 2, "user", "end")]
    formatted = chat_windows.stage_table(chat_windows.windows(spark.createDataFrame(rows, CHAT), budget=400, history=60), "chat")
    assert digests(formatted) == expected_digests(rows)
    found = formatted.collect()
    assert len([r for r in found if r.conv_id == 1]) > 10
    for r in found:
        assert r.n_tokens <= 400 or (r.conv_id == 3 and r.n_turns == 1)
        assert r.conv_id != 1 or r.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n")
        assert r.text.count("<|im_start|>") == r.n_turns + r.n_repeated
    assert sum(len(r.loss) for r in found if r.conv_id == 1) == sum(r[2] == "assistant" and r[3] != "" for r in rows if r[0] == 1)
    assert any(r.n_repeated > 1 for r in found)
