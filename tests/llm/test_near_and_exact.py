"""Operators 6 and 7 against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from llm_fixtures import documents, edge_rows, empty, frame, rows_of

from paysift.llm import ngram_jaccard
from paysift.llm.exact_dedup import CuckooIndex, apply_changes, exact_dedup, keep_first
from paysift.llm.graph import connected_components
from paysift.llm.ngram_jaccard import CountTree, jaccard_components, prefix_length

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None], 2):
        if x and y and min(len(x), len(y)) * 100 >= 80 * max(len(x), len(y)):
            i = len(x & y)
            if 100 * i >= 80 * (len(x) + len(y) - i):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return sorted(((d, len(s), root(d) if d is not None else None) for d, s in sets), key=lambda r: [(x is not None, x) for x in r])


def variants(seed, n, copies):
    """Texts with chains of edits, so that similarities lie on both sides of 0.8."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice("abcdefghijklmnop") * rng.randint(1, 6) + str(rng.randint(0, 400)) for _ in range(rng.choice([3, 6, 40, 120]))]
        for _ in range(copies):
            rows.append((len(rows), " ".join(words), "en", "src0"))
            words = list(words)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 99)}"
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("clash", [False, True])
def test_jaccard_equals_brute_force(spark, clash):
    rows = documents() + edge_rows()
    out = jaccard_components(frame(spark, rows, clash))
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert rows_of(out) == brute_components(rows)


@pytest.mark.parametrize("rounds", [0, 1])
def test_jaccard_chains_with_and_without_hub_rounds(spark, rounds, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "CHUNK", 4)  # blocks are cut into many chunks
    rows = variants(rounds, 12, 9)
    assert rows_of(jaccard_components(frame(spark, rows), rounds=rounds)) == brute_components(rows)


def test_jaccard_of_empty_table(spark):
    assert jaccard_components(empty(spark)).collect() == []


def test_prefix_is_long_enough():
    for n in range(1, 300):
        least = -(-80 * n // 100)  # smallest overlap of a linked set
        assert prefix_length(n, 80) == n - least + 1 >= 1


def test_tree_prunes_no_link():
    rng = np.random.default_rng(1)
    sets = [rng.choice(4000, rng.integers(5, 90), replace=False) for _ in range(150)]
    sets += [np.unique(np.append(s[: int(len(s) * 0.93)], rng.integers(0, 4000, 1))) for s in sets[:100]]
    counts = np.array([np.bincount(s % 64, minlength=64) for s in sets], np.int32)
    sizes, labels = np.array([len(s) for s in sets]), np.arange(len(sets)) % 60
    tree = CountTree(counts, sizes, labels)
    got = set(zip(*(x.tolist() for x in tree.pairs(tree, 80)[:2])))
    links = [(a, b) for a, b in combinations(range(len(sets)), 2) if 100 * (i := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (len(sets[a]) + len(sets[b]) - i)]
    assert links and all(((a, b) in got) == (labels[a] != labels[b]) for a, b in links)
    assert len(got) < len(sets) ** 2 / 10


def test_components_of_long_paths_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 150), (200, 150)]
    random.Random(2).shuffle(edges)
    got = dict(rows_of(connected_components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100), 150: 150, 200: 150}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_exact(rows):
    same = defaultdict(list)
    for d, t, *_ in rows:
        same[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for text, ids in same.items():
        have = [d for d in ids if d is not None]
        keep = min(have) if have else None
        free = True
        for d in ids:
            out.append((d, keep, len(ids), d == keep and free, hashlib.sha256(text.encode()).hexdigest()))
            free = free and d != keep
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("clash, hot", [(False, 10_000), (True, 1), (True, 50)])  # all groups by broadcast, none, the large ones
def test_exact_equals_brute_force(spark, clash, hot, monkeypatch):
    monkeypatch.setattr("paysift.llm.exact_dedup.HOT", hot)
    hot_rows = [(30_000 + i // 2, "one  text\twith copies", "en", "src0") for i in range(60)] + [(None, "without ids", "en", "src0")] * 40
    rows = documents() + edge_rows() + hot_rows
    got = rows_of(exact_dedup(frame(spark, rows, clash)))
    assert got == brute_exact(rows)


def test_exact_keeps_whole_rows(spark):
    rows = documents() + edge_rows()
    docs = frame(spark, rows, clash=True)
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert [r[0] for r in rows_of(kept, "doc_id")] == [r[0] for r in brute_exact(rows) if r[3]]


def test_exact_of_empty_table(spark):
    assert exact_dedup(empty(spark)).collect() == [] and keep_first(empty(spark)).collect() == []


def test_cuckoo_index_grows_deletes_and_verifies():
    index = CuckooIndex(buckets=2)
    digest = lambda i: hashlib.sha256(str(i).encode()).digest()
    for i in range(3000):
        assert index.find(digest(i)) is None
        index.insert(digest(i), i)
    assert index.size == 3000 and index.mask + 1 >= 512
    # the same fingerprint and buckets, other content: a hit of the filter, but not of the index
    twin = digest(5)[:31] + bytes([digest(5)[31] ^ 1])
    assert index.find(twin) is None
    for i in range(0, 3000, 2):
        assert index.delete(digest(i)) and not index.delete(digest(i))
    assert all((index.find(digest(i)) is not None) == (i % 2 == 1) for i in range(3000))
    assert sorted(v for _, v in index.entries()) == list(range(1, 3000, 2))


def test_live_index_changes(spark):
    none = spark.createDataFrame([], "digest binary, doc_id long, n long")
    one = spark.createDataFrame([(1, "insert", 1, "a b"), (2, "insert", 2, "a  b"), (3, "insert", 3, "c"), (4, "delete", 3, "c"), (5, "delete", 9, "never"), (None, "insert", 8, "x")], "seq int, op string, doc_id long, text string")
    live = apply_changes(none, one, ranges=2)
    assert rows_of(live, "doc_id", "n") == [(1, 2)]
    two = spark.createDataFrame([(1, "delete", 1, "a b"), (2, "insert", 7, "c"), (3, "delete", 1, "a b"), (4, "insert", 5, None)], "seq int, op string, doc_id long, text string")
    assert rows_of(apply_changes(live, two, ranges=3), "doc_id", "n") == [(5, 1), (7, 1)]
