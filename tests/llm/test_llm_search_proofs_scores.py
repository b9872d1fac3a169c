"""Lexical search, Merkle proofs and language-model scores against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quotelake.llm import interpolated_lm, lexical_search, merkle, varints
from quotelake.llm.common import read_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
ODD_ROWS = [
    (1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (2, None, None, None, None),
    (None, "null id text of some words here", "en", None, 1), (3, "", "de", "s", 0), (4, LONG, "en", "t", len(LONG)),
    (5, LONG, "en", "t", len(LONG)), (6, " \t\n\r ", None, "", 5), (7, "é ü 漢字 \u0000 \U0001F600 A\nb", "fr", "s", 9),
    (8, "x" * 200_000, "en", "u", 200_000), (9, "Same same\n" * 400, "en", "u", 4000), (None, None, None, None, None),
    (10, "a b c, d\n\n", "en", "s", 13), (11, "é a", "en", "é", 3), (0, "g f e", "en", "s", 5), (-3, "b", "en", "s", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


CLASHING = ["term", "segment", "df", "item", "score", "rank", "wanted", "weight", "tree", "level", "pos", "n", "grp", "ord", "leaf",
            "digest", "node", "run", "children", "changed", "subroot", "root", "proof", "segment2", "role", "chunk", "words",
            "codes", "lengths", "doc_ids", "n_tokens", "base_score", "total"]


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.select("*", *(F.lit("clash").alias(n) for n in CLASHING))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2 ** 62) | st.integers(0, 300), max_size=40))
def test_varints_come_back(values):
    data, sizes = varints.pack(np.array(values, np.uint64))
    assert varints.unpack(data).tolist() == values and sizes.sum() == len(data)


# ---- lexical search

def best_documents(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document."""
    def terms(text):
        return re.findall(lexical_search.TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scored = []
        for doc, bag in bags:
            m = 100 - 50 + (50 * bag.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[t] + 1)))
                        * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in set(terms(text)) if t in bag)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "a b c"), (2, "word3x3 word976x976 same"), (3, None), (4, ""), (None, "null words"), (1, "a b c"), (1, "É é ü 漢字"),
         (5, "a b c d e f g same x A-B,c"), (6, "nowhere")]


def test_search_of_odd_rows(spark, clashing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    index = lexical_search.build_index(clashing)
    for k in (1, 3, 50):
        rows = lexical_search.search(index, items.withColumn("term", F.lit("clash")), k).collect()
        assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=repr) == best_documents(
            [(r[0], r[1]) for r in ODD_ROWS], ITEMS, k)


def test_search_of_empty_tables(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(lexical_search.build_index(none), items).collect() == []
    found = lexical_search.search(lexical_search.build_index(odd), items.limit(0))
    assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_items_are_answered_in_blocks(spark, monkeypatch):
    docs, items = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "benchmark")
    monkeypatch.setattr(lexical_search, "ITEM_TERMS", 60)
    rows = lexical_search.search(lexical_search.build_index(docs), items, 7).collect()
    expected = best_documents([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 7)
    assert sorted(map(tuple, rows), key=repr) == expected


def test_blocks_are_skipped_and_nothing_is_lost(monkeypatch):
    for name, value in (("BLOCK", 4), ("SEGMENT_DOCUMENTS", 300), ("WINDOW", 32)):
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(60)], k=rng.randint(1, 60)))) for i in range(1500)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.sample(words, 6))) for i in range(20)]
    batches, segment, number, total = [], lexical_search._Segment(), 0, 0
    for doc, text in docs:
        segment.add(doc, text)
        total += len(text.split())
        if segment.full() or doc == docs[-1][0]:
            batches += segment.rows(number)
            number, segment = number + 1, lexical_search._Segment()
    assert number == 5
    df = Counter(t for _, text in docs for t in set(text.split()))
    asked = [(i, [(t, math.floor(1000 * math.log((2.0 * 1500 + 2) / (2.0 * df[t] + 1)))) for t in text.split()]) for i, text in items]
    opened = []
    inner = lexical_search._search_segment
    monkeypatch.setattr(lexical_search, "_search_segment", lambda *a: opened.append((inner(*a), sum(len(x.last) for _, x in a[1]))))
    got = [(r["item"], r["doc_id"], r["score"]) for b in lexical_search._search(batches, asked, 1500, total, 5) for r in b.to_pylist()]
    assert sorted(got) == sorted((i, d, s) for i, _, d, s in best_documents(docs, items, 5))
    assert sum(o for o, _ in opened) < 0.8 * sum(a for _, a in opened)


def test_impacts_bound_every_posting():
    rng = np.random.default_rng(2)
    block = np.sort(rng.integers(0, 40, 2000))
    tf, length = rng.integers(1, 9, 2000), rng.integers(1, 300, 2000)
    kept = list(zip(*(x.tolist() for x in lexical_search.skyline(block, tf, length))))
    pairs = set(zip(block.tolist(), tf.tolist(), length.tolist()))
    for b, f, n in pairs:
        assert any(b == b2 and f2 >= f and n2 <= n for b2, f2, n2 in kept)
    for b, f, n in kept:
        assert (b, f, n) in pairs and not any(b == b2 and (f2, n2) != (f, n) and f2 >= f and n2 <= n for b2, f2, n2 in kept)


# ---- Merkle manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_of(digests):
    """The top of a tree and the siblings of each leaf, (left, right) level by level."""
    paths, places, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for path, place in zip(paths, places):
            start = place // 3 * 3
            path.append(("".join(level[start:place]), "".join(level[place + 1:start + 3])))
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
        places = [p // 3 for p in places]
    return level[0], paths


def expected_manifest(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of (doc_id, source, lang, n_chars, text)."""
    def leaf_of(r, text):
        return sha("".join(map(field, (*r[:4], text))))

    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        trees[s] = tree_of([leaf_of(r, r[4]) for r in groups[s]])
    if not sources:
        return []
    root, above = tree_of([trees[s][0] for s in sources])
    out = []
    for s, upper in zip(sources, above):
        for r, lower in zip(groups[s], trees[s][1]):
            struck = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            fold = leaf_of(r, r[4].replace("\n", "") if struck and r[4] is not None else r[4])
            for left, right in [*lower, *upper]:
                fold = sha(left + fold + right)
            out.append((r[0], leaf_of(r, r[4]), trees[s][0], root, sha("".join(a + b for a, b in [*lower, *upper])), fold, fold == root))
    return sorted(out, key=repr)


def checked(docs):
    struck = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(struck, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted(map(tuple, merkle.verify(docs, tampered).collect()), key=repr)


def manifest_rows(docs):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]


def test_manifest_of_odd_rows(clashing, none):
    expected = expected_manifest(manifest_rows(clashing))
    assert checked(clashing) == expected
    assert {r[-1] for r in expected} == {True, False}
    assert checked(none) == []


@pytest.mark.parametrize("n", [1, 4, 28])
def test_manifest_of_few_rows(spark, n):
    docs = spark.createDataFrame([(i, f"t\n{i}", "en", "s" if n < 5 else f"s{i % 2 * i}", 3) for i in range(n)], DOCS)
    assert checked(docs) == expected_manifest(manifest_rows(docs))


def test_manifest_of_documents(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    assert checked(docs) == expected_manifest(manifest_rows(docs))


def test_equal_rows_are_spread_over_ranges(spark):
    docs = spark.range(900).select(F.lit(7).cast("long").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"),
                                   F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert checked(docs.repartition(4)) == expected_manifest(manifest_rows(docs))


# ---- language model

def expected_scores(rows, order):
    """doc_id, held_out, n_tokens, n_known, base, score by dictionaries of n-grams."""
    def role(i):
        number = zlib.crc32(("" if i is None else str(i)).encode())
        return 2 if number % 5 == 1 else int(number // 5 % interpolated_lm.HELD_PART == 0)

    docs = [(i, role(i), [None] * (order - 1) + (t or "").encode().lower().split() + [b" "]) for i, t in rows]

    def count(roles):
        grams, seen = Counter(), Counter()
        for _, r, tokens in docs:
            if r in roles:
                for at in range(order - 1, len(tokens)):
                    for size in range(1, order + 1):
                        grams[tuple(tokens[at - size + 1:at + 1])] += 1
                        seen[tuple(tokens[at - size + 1:at])] += 1
        return grams, seen, sum(len(g) == 1 for g in grams)

    def parts(tokens, at, grams, seen, distinct):
        ml, bucket = [1 / (distinct + 1)], 0
        for size in range(1, order + 1):
            context = tuple(tokens[at - size + 1:at])
            ml.append(grams.get(tuple(tokens[at - size + 1:at + 1]), 0) / max(1, seen.get(context, 0)))
            if size > 1 and seen.get(context, 0):
                bucket = (size - 1) * interpolated_lm.POWERS + int(math.log2(seen[context]))
        return bucket, ml

    counted = count((0,))
    evidence = [parts(t, at, *counted) for _, r, t in docs if r == 1 for at in range(order - 1, len(t))]
    weights = interpolated_lm.even_weights(order)
    even = weights.copy()
    for _ in range(interpolated_lm.ROUNDS):
        sums = defaultdict(lambda: np.zeros(order + 1))
        for bucket, ml in evidence:
            share = weights[bucket] * np.array(ml)
            sums[bucket] += share / share.sum()
        before, weights = weights, even.copy()
        for bucket, share in sums.items():
            weights[bucket] = (share + even[bucket]) / (share + even[bucket]).sum()
        if np.abs(weights - before).max() < interpolated_lm.CLOSE:
            break
    grams, seen, distinct = count((0, 1))
    n = seen[()]
    out = []
    for i, r, tokens in docs:
        total = base = 0.0
        known = 0
        for at in range(order - 1, len(tokens)):
            bucket, ml = parts(tokens, at, grams, seen, distinct)
            c = grams.get((tokens[at],), 0)
            known += c > 0
            total += math.log10(float(weights[bucket] @ np.array(ml)))
            base += math.log10((c + 0.5) / (n + 0.5 * (distinct + 1)))
        out.append((i, r == 2, len(tokens) - order + 1, known, n, base, total))
    return out


def same_scores(docs, rows, order):
    got = sorted((tuple(r) for r in interpolated_lm.score(docs, order=order).collect()), key=lambda r: (repr(r[:5]), r[5], r[6]))
    expected = sorted(expected_scores(rows, order), key=lambda r: (repr(r[:5]), r[5], r[6]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=1e-9, atol=1e-9)
    return got


SMALL_TEXTS = [(i, " ".join(random.Random(i).choices("abcdefgh", [20, 9, 5, 4, 3, 2, 1, 1], k=i % 37))) for i in range(160)]


@pytest.mark.parametrize("order", [1, 3])
def test_scores_equal_dictionaries(spark, order):
    rows = [*SMALL_TEXTS, *((r[0], r[1]) for r in ODD_ROWS if r[1] is None or len(r[1]) < 5000)]
    same_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows, order)


def test_scores_of_odd_rows(spark, clashing, none):
    same_scores(clashing, [(r[0], r[1]) for r in ODD_ROWS], 2)
    assert interpolated_lm.score(none).collect() == []
    held = spark.createDataFrame([(i, "a b") for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in interpolated_lm.score(held).collect())


def test_chunks_part_texts_anywhere(spark, monkeypatch):
    monkeypatch.setattr(interpolated_lm, "RANGE_KEYS", 64)  # many ranges
    same_scores(spark.createDataFrame(SMALL_TEXTS, "doc_id long, text string").repartition(4), SMALL_TEXTS, 2)


def test_probabilities_of_a_context_add_up_to_one(spark):
    """The weights and estimates of any seen context, over all known words and one unknown."""
    grams, seen = Counter({("a", "b"): 3, ("a", "c"): 1}), 4
    tokens = Counter(a=4, b=3, c=2, d=1)
    weights = interpolated_lm.even_weights(2)
    total = 0.0
    for word in [*tokens, "unknown"]:
        counts = [np.array([tokens[word]]), np.array([grams["a", word]])]
        at = interpolated_lm.bucket_of([np.array([seen])], 1)
        total += float((weights[at] * interpolated_lm.estimates(counts, [np.array([seen])], 10, 4)).sum())
    assert total == pytest.approx(1.0)


def test_contexts_help_on_held_out_documents(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    held = [r for r in same_scores(read_table(spark, SF_SMALL, "documents"), docs, interpolated_lm.ORDER) if r[1]]
    assert held and sum(r[6] for r in held) > sum(r[5] for r in held)
