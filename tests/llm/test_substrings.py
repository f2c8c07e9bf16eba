"""Operators 8 and 9 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import documents, edge_rows, empty, frame, rows_of
from pyspark.sql import functions as F

from paysift.llm import bytesx, queries, suffix_dedup
from paysift.llm.sentence_dedup import remove_repeated_sentences
from paysift.llm.suffix_dedup import SIDE, BlindTrie, deep_shallow, remove_repeats, repeated_windows


def brute_repeats(rows, size=200):
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(t[i : i + size] for _, t in texts for i in range(len(t) - size + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((d, len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def passages(seed):
    """Documents that share passages of about the window's length, whole and cut, with periodic and repeated text."""
    rng = random.Random(seed)
    alphabet = "abcdefgh é."
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    pool = [make(rng.choice([195, 199, 200, 201, 230, 420])) for _ in range(5)]
    rows = []
    for i in range(60):
        text = make(rng.randint(0, 150))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(pool)
            a = rng.choice([0, 0, 1, rng.randint(0, 60)])
            text += p[a : len(p) - rng.choice([0, 0, 1, rng.randint(0, 60)])] + make(rng.choice([0, 1, 90]))
        rows.append((i, text, "en", "src0"))
    rows += [(100, "ab" * 260, "en", "s"), (101, "x" * 450, "en", "s"), (102, make(30) + "ab" * 110, "en", "s"), (103, "x" * 199, "en", "s"), (104, "\0" * 210 + "q", "en", "s")]
    return rows


@pytest.mark.parametrize("clash", [False, True])
def test_suffix_dedup_equals_brute_force(spark, clash):
    rows = documents()[:120] + [r for r in edge_rows() if r[1] is None or len(r[1]) < 2000]
    rows += [(20_000, "é" * 120 + "long " * 100, "en", "s"), (20_001, "x" + "é" * 120 + "long " * 100, "en", "s")]
    got = remove_repeats(frame(spark, rows, clash))
    assert rows_of(got.drop("kept", "spans")) == brute_repeats(rows)


@pytest.mark.parametrize("max_group", [0, 3, 50_000])
def test_shared_passages_with_any_group_bound(spark, max_group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TASK_ROWS", 16)  # groups go on over several batches
    rows = passages(7)
    got = remove_repeats(frame(spark, rows), max_group)
    assert rows_of(got.drop("kept", "spans")) == brute_repeats(rows)


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdef ") for _ in range(900))
    rows = [(i, "".join(rng.choice("ghijkl ") for _ in range(3000 + 7 * i)) + shared[40 * i :] + "zz" * i, "en", "s") for i in range(4)]
    data = [np.frombuffer(t.encode(), np.uint8) for _, t, *_ in rows]
    whole = [suffix_dedup.anchors(d, np.array([0, len(d)]))[0] for d in data]
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    import pyarrow as pa

    covered = defaultdict(set)
    for row, part, bounds, offset in suffix_dedup._pieces(pa.array([t for _, t, *_ in rows])):
        text, first, last, _ = suffix_dedup.anchors(part, bounds)[0]
        for k, a, b in zip(text, first - bounds[text] + offset, last - bounds[text] + offset):
            assert not covered[row + k] & set(range(a, b + 1))
            covered[row + k] |= set(range(a, b + 1))
    for i, (d, w) in enumerate(zip(data, whole)):
        assert covered[i] == set(range(len(d) - 199)) == {p for a, b in zip(w[1], w[2]) for p in range(a, b + 1)}


def test_suffix_dedup_of_empty_table(spark):
    assert remove_repeats(empty(spark)).collect() == []


def test_deep_shallow_order_and_trie():
    rng = random.Random(5)
    stems = [bytes(rng.choices(range(3), k=60)) for _ in range(4)]
    strings = [(rng.choice(stems)[: rng.choice([10, 30, 59])] + bytes(rng.choices(range(256), k=151)))[:151] for _ in range(400)]
    strings += strings[:50]
    group = np.array([rng.randint(0, 3) for _ in strings])
    order = deep_shallow(group, np.array([list(s) for s in strings], np.uint8))
    assert sorted(order) == list(range(len(strings)))
    assert [(group[i], strings[i]) for i in order] == sorted(zip(group, strings))
    trie = BlindTrie()
    for s in strings:
        trie.insert(s)
    assert list(trie) == sorted(set(strings))


def test_windows_of_contexts_equal_brute_force():
    rng = random.Random(11)
    core = bytes(rng.choices(range(97, 100), k=2 * SIDE))
    before, after, group = [], [], []
    for _ in range(120):
        a, b = rng.randint(0, SIDE), rng.randint(0, SIDE)
        x, y = bytearray(core[SIDE - a : SIDE]), bytearray(core[SIDE : SIDE + b])
        for part in (x, y):
            if part and rng.random() < 0.7:
                part[rng.randrange(len(part))] = rng.choice(b"abc")
        before.append(bytes(x))
        after.append(bytes(y))
        group.append(rng.randint(0, 2))
    got = repeated_windows(np.array(group), before, after)
    for l in range(SIDE + 1):  # noqa: E741
        seen = Counter((g, x[len(x) - l :], y[: SIDE - l]) for g, x, y in zip(group, before, after) if len(x) >= l and len(y) >= SIDE - l)
        for i, (g, x, y) in enumerate(zip(group, before, after)):
            assert got[i, l] == (len(x) >= l and len(y) >= SIDE - l and seen[g, x[len(x) - l :], y[: SIDE - l]] > 1)


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_sentences(text):
    """(start, words) of each sentence, word by word."""
    out = []
    fresh, last = True, 0
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        if fresh or "\n" in text[last : m.start()]:
            out.append((m.start(), []))
        out[-1][1].append(m[0].translate(LOWER))
        fresh, last = m[0][-1] in ".!?", m.end()
    return out


def brute_sentences(rows, span=3, min_words=12):
    docs = {(d if d is not None else -(1 << 63), t or "") for d, t, *_ in rows}
    parts = {k: split_sentences(k[1]) for k in docs}
    places = defaultdict(list)
    for k, s in parts.items():
        for i in range(len(s) - span + 1):
            words = tuple(w for _, x in s[i : i + span] for w in x)
            if len(words) >= min_words:
                places[words].append((k[0], i, k))
    gone = defaultdict(set)
    for where in places.values():
        for _, i, k in sorted(where, key=lambda x: x[:2])[1:]:
            gone[k] |= set(range(i, i + span))
    out = []
    for d, t, *_ in rows:
        k = (d if d is not None else -(1 << 63), t or "")
        s = parts[k]
        cut = [a for a, _ in s] + [len(k[1])]
        kept = k[1][: cut[0]] + "".join(k[1][a:b] for i, (a, b) in enumerate(zip(cut, cut[1:])) if i not in gone[k]) if gone[k] else k[1]
        out.append((d, len(s), len(gone[k]), kept))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("clash", [False, True])
def test_sentence_dedup_equals_brute_force(spark, clash):
    rows = documents() + edge_rows()
    rows += [(30_000 + i, "Own words number %d here. " % i + "One shared sentence of five. Then two of them come. And so a third one! Is it the end?" + " Tail %d." % i, "en", "s") for i in range(4)]
    got = remove_repeated_sentences(frame(spark, rows, clash))
    assert got.columns == ["doc_id", "n_sentences", "n_removed", "kept_sha256", "kept"]
    want = brute_sentences(rows)
    assert rows_of(got, "doc_id", "n_sentences", "n_removed", "kept") == want
    assert sum(r[2] > 0 for r in want) > 5
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got.collect())


def test_sentence_dedup_keeps_the_first(spark):
    passage = "The first sentence of a passage. It goes on for a while here. Then comes the third of them. And the last one is this."
    rows = [(3, "Before it. " + passage, None, None), (1, passage + " After it.", None, None), (2, "Nothing of the kind stands here at all. Not once. Never.", None, None)]
    got = rows_of(remove_repeated_sentences(frame(spark, rows)), "doc_id", "kept")
    assert got == [(1, rows[1][1]), (2, rows[2][1]), (3, "Before it. ")]


def test_sentence_dedup_of_empty_table(spark):
    assert remove_repeated_sentences(empty(spark)).collect() == []


CLOSERS, WIDE = "\"')]}»›”’」』】）〉》", "。！？｡．।॥؟۔።፧፨՜՞។៕၊။‼⁇⁈⁉…"


def registered_sentences(text):
    """(start, words) of each sentence as the registered query cuts them, character by character."""
    words, last = [], 0  # start, word, ends a sentence
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        if words and "\n" in text[last : m.start()]:
            words[-1][2] = True
        begin = i = m.start()
        while i < m.end():
            i += 1
            if text[i - 1] in WIDE:
                while i < m.end() and text[i] in CLOSERS + WIDE:
                    i += 1
                words.append([begin, text[begin:i], True])
                begin = i
        if begin < m.end():
            words.append([begin, text[begin : m.end()], False])
        bare = words[-1][1].rstrip(CLOSERS)
        words[-1][2] |= bool(bare) and bare[-1] in ".!?" + WIDE
        last = m.end()

    def stretches():
        out = [[]]
        for w in words:
            out[-1].append(w)
            if w[2]:
                out.append([])
        return [s for s in out if len(s) >= 50]

    for s in stretches():
        for w in s:
            raw = np.frombuffer(w[1].encode(), np.uint8)
            h = bytesx.span_hash(bytesx.running_hash(bytesx.LOWER_VALUE[raw]), np.array([0]), np.array([len(raw)]))[0]
            w[2] |= int(h) % 8 == 0
    for s in stretches():
        for w in s[49::50]:
            w[2] = True
    out = [[]]
    for w in words:
        out[-1].append(w)
        if w[2]:
            out.append([])
    return [(s[0][0], [w.translate(LOWER) for _, w, _ in s]) for s in out if s]


def brute_registered(rows, span=3, few=20):
    docs = {(d if d is not None else -(1 << 63), t or "") for d, t, *_ in rows}
    parts = {k: registered_sentences(k[1]) for k in docs}
    places = defaultdict(list)
    for k, s in parts.items():
        for size in range(1, span + 1):
            for i in range(len(s) - size + 1):
                words = tuple(w for _, x in s[i : i + size] for w in x)
                if size == span or len(words) >= few or size == len(s):
                    places[words].append((k[0], i, size, k))
    gone = defaultdict(set)
    for where in places.values():
        first = min(where, key=lambda x: x[:2])
        for d, i, size, k in where:
            if (d, i, size, k) != first:
                gone[k] |= set(range(i, i + size))
    out = {}
    for d, t, *_ in rows:
        k = (d if d is not None else -(1 << 63), t or "")
        cut = [a for a, _ in parts[k]] + [len(k[1])]
        out[d, k[1]] = (len(parts[k]), len(gone[k]), k[1] if not gone[k] else k[1][: cut[0]] + "".join(k[1][a:b] for i, (a, b) in enumerate(zip(cut, cut[1:])) if i not in gone[k]))
    return out


def planted_passages(seed):
    """Texts without stops, of long sentences and of short ones, some of which share a passage of over 50 words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 4)))

    def prose(n, mean):
        return [word() + (rng.choice([".", "!", '."', "?)", ". "]) if mean and rng.random() < 1 / mean else "") for _ in range(n)]

    rows = []
    for mean in (0, 5, 25):
        passages = [prose(70, mean) for _ in range(3)]
        for i in range(24):
            body = [prose(rng.randint(30, 90), mean), *([passages[i % 3]] if i % 2 else []), prose(rng.randint(30, 90), mean)]
            rows.append((40_000 + len(rows), " ".join(w for part in body for w in part), "en", str(bool(i % 2))))
    return rows + [(50_000 + i, "as " * (120 + 31 * i), "en", None) for i in range(4)] + [(60_000 + i, "今天天气很好。我们去公园。「你好。」她说。" + str(i), "zh", None) for i in range(3)]


def test_registered_sentence_dedup_equals_brute_force(spark, tmp_path):
    rows = documents() + edge_rows() + planted_passages(8)
    frame(spark, rows, True).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_sentence_dedup(spark, str(tmp_path)).collect()
    want = brute_registered(rows)
    texts = {d: t or "" for d, t, *_ in rows}
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_sentences"], r["n_removed"], r["kept"]) == want[r["doc_id"], texts[r["doc_id"]]], r["doc_id"]


def test_passages_in_texts_without_stops_are_caught(spark):
    rows = planted_passages(9)
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeated_sentences(frame(spark, rows), min_words=0, short=True, few_words=20).collect()}
    later = [(d, s) for d, _, _, s in rows[:72] if (d - 40_000) % 24 >= 6]
    caught, clean = [got[d] > 0 for d, s in later if s == "True"], [got[d] == 0 for d, s in later if s == "False"]
    assert sum(caught) >= 0.95 * len(caught) and all(clean)


def test_texts_without_ids_are_told_apart(spark):
    """Two texts without a doc_id whose 32-bit hashes agree: one repeats a document, the other nothing."""
    ids = spark.range(300_000).selectExpr("concat(sha2(cast(id as string), 512), sha2(concat('b', id), 512)) as t").selectExpr("t", "hash(t) as h")
    pair = ids.groupBy("h").agg(F.sort_array(F.collect_list("t")).alias("ts")).where("size(ts) > 1").orderBy("h").first()
    one, two = pair.ts[:2]
    rows = [(None, one, None, None), (None, two, None, None), (5, one + " and a tail", None, None)]
    got = sorted((r["n_bytes"], r["n_removed"], bytes(r["kept"]).decode()) for r in remove_repeats(frame(spark, rows)).collect())
    assert got == sorted([(256, 256, ""), (256, 0, two), (267, 256, " and a tail")])
