"""Operators 11 to 13 against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import documents, edge_rows, empty, frame, rows_of

from paysift.llm import bytesx, periodic_runs, spelling_groups
from paysift.llm.periodic_runs import collapse_runs, find_runs, inverse_ntt, ntt, zero_mismatches
from paysift.llm.quality_rules import apply_rules, without_lines
from paysift.llm.queries import op11_periodic_runs, op12_quality_rules, op13_spelling_groups
from paysift.llm.spelling_groups import Cell, group_spellings, word_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def stored(spark, tmp_path, rows, clash=False):
    """``rows`` as the documents of a folder that the registered queries read."""
    frame(spark, rows, clash).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# ---- 11: periodic runs -------------------------------------------------------------------


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def brute_periodic(rows):
    out = []
    for d, t, *_ in rows:
        words = planted(d, WORD.findall(t or ""))
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1] * 10**12 // r[2], r[0], r[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        out.append((d, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(listed), sha(collapsed(words, runs))))
    return out


def key(rows):
    return sorted(map(tuple, rows), key=repr)


def patterned(seed, n):
    """Texts of few and many words, with stretches that repeat with all kinds of periods."""
    rng = random.Random(seed)
    for _ in range(n):
        size = rng.randint(0, 150)
        words = [f"w{rng.randint(1, rng.choice([1, 2, 3, 9, 400]))}" for _ in range(size)]
        for _ in range(rng.randint(0, 3)):
            if size > 8:
                p, s = rng.randint(1, size // 4), rng.randint(0, size - 1)
                for i in range(s + p, min(size, s + p * rng.randint(3, 9) + rng.randint(0, 3))):
                    words[i] = words[i - p]
        yield words


@pytest.mark.parametrize("block, step", [(1 << 16, 1 << 19), (4, 64)])
def test_runs_of_patterned_texts(monkeypatch, block, step):
    monkeypatch.setattr(periodic_runs, "MAX_BLOCK", block)
    monkeypatch.setattr(periodic_runs, "STEP", step)
    texts = list(patterned(3, 400))
    firsts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids = np.array([int(w[1:]) for t in texts for w in t], np.uint64)
    start, stop, period = find_runs(bytesx.mix(ids), firsts)
    want = [(s + f, s + f + n, q) for t, f in zip(texts, firsts) for s, n, q in brute_runs(t)]
    assert list(zip(start.tolist(), stop.tolist(), period.tolist())) == sorted(want, key=lambda r: (r[0], r[2]))


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, periodic_runs.PRIME, (3, 16)).astype(np.uint64) for _ in range(2))
    got = inverse_ntt(ntt(a) * ntt(b) % np.uint64(periodic_runs.PRIME))
    for x, y, z in zip(a.tolist(), b.tolist(), got.tolist()):
        assert z == [sum(x[i] * y[(k - i) % 16] for i in range(16)) % periodic_runs.PRIME for k in range(16)]


def test_zero_mismatches_are_the_occurrences():
    values = np.array([5, 7, 5, 7, 5, 7, 5, 8, 5, 7], np.uint64)
    row, shift = zero_mismatches(values, np.array([0, 2]), np.array([2, 4]), 2)
    assert list(zip(row.tolist(), shift.tolist())) == [(0, 0), (1, 0)]


def test_one_word_text_is_linear():
    runs = find_runs(bytesx.mix(np.full(300_000, 3, np.uint64)), np.array([0, 300_000]))
    assert [c.tolist() for c in runs] == [[0], [300_000], [1]]


@pytest.mark.parametrize("clash", [False, True])
def test_periodic_runs_equal_brute_force(spark, tmp_path, clash):
    rows = [*edge_rows(), *[(20_000 + i, "\n ".join(t) + " ", "en", "src1") for i, t in enumerate(patterned(4, 150))], (None, "a b " * 9, None, None)]
    rows = [r for r in rows if r[1] is None or len(r[1]) < 10_000]
    got = op11_periodic_runs(spark, stored(spark, tmp_path, rows, clash))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert key(got.collect()) == key(brute_periodic(rows))


def test_periodic_runs_of_documents(spark, sf_dir):
    rows = [r for r in documents() if len(r[1] or "") < 6_000]
    got = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, sf_dir).collect()}
    want = brute_periodic(rows)
    assert [got[w[0]] for w in want] == want and any(w[1] for w in want)


def test_collapse_gives_runs_and_texts(spark):
    rows = [(1, "x  a b a b a b a b\ty", None, None), (2, None, None, None), (3, "ok " * 7, None, None)]
    got = rows_of(collapse_runs(frame(spark, rows)))
    assert [(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got] == [(1, 10, [(1, 8, 2)], "x a b y"), (2, 0, [], ""), (3, 7, [(0, 7, 1)], "ok")]
    assert collapse_runs(empty(spark)).count() == 0


# ---- 12: quality rules -------------------------------------------------------------------


def brute_quality(rows, limit_docs=20, limit_percent=1, min_words=50, min_kept=50):
    held, host_docs, read = defaultdict(set), defaultdict(set), []
    for d, t, _, host in rows:
        t, host = t or "", host or ""
        lines = [(i, raw, tuple(WORD.findall(raw.translate(LOWER)))) for i, raw in enumerate(t.split("\n"))]
        lines = [x for x in lines if x[2]]
        whole = tuple(x[2] for x in lines)
        if lines:
            host_docs[host].add(whole)
        for _, _, words in lines:
            held[host, words].add(whole)
        read.append((d, t, host, lines))
    out = []
    for d, t, host, lines in read:
        words = WORD.findall(t)
        grams = Counter(zip(words, words[1:], words[2:]))
        spread = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
        dups = len(lines) - len({raw for _, raw, _ in lines})
        gone = [(i, len(w)) for i, _, w in lines if len(held[host, w]) > limit_docs and len(held[host, w]) * 100 > len(host_docs[host]) * limit_percent]
        failed = len(words) < min_words or 100 * len(spread) > 50 * len(words)
        n_gone = sum(n for _, n in gone)
        out.append((d, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dups, len(spread), failed, [i for i, _ in gone], n_gone,
                    not failed and (len(words) - n_gone) * 100 >= len(words) * min_kept))
    return out


def lined(seed, n):
    """Documents of lines that few, some or nearly all documents of a host share."""
    rng = random.Random(seed)
    common = ["Accept all Cookies", "share  this page | print", "Read more & more", "Accept all cookies "]
    rows = []
    for i in range(n):
        lines = [" ".join(f"t{rng.randint(0, 30)}" for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 14))]
        lines += [c for c in common if rng.random() < 0.5] + [f"line {rng.randint(0, 5)}"] * rng.randint(0, 2)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), "en", rng.choice(["big", "big", "big", "small", None])))
    return rows + [(n + i, rows[3][1], "en", "big") for i in range(60)]


@pytest.mark.parametrize("clash", [False, True])
def test_quality_rules_equal_brute_force(spark, clash):
    rows = [*edge_rows(), *lined(5, 300), (None, "", "en", "big"), (900, "\n\n", "en", "big"), (901, "#*$ %&|\r\n<> é\n#*$ %&|\r\n", "en", "big")]
    for args in ({}, {"limit_docs": 3, "limit_percent": 10, "min_words": 5, "min_kept": 80}):
        got = apply_rules(frame(spark, rows, clash), **args)
        assert key(tuple(r) for r in got.collect()) == key(brute_quality(rows, **args))


def test_quality_rules_of_documents(spark, sf_dir):
    rows = documents()
    got = {r.doc_id: tuple(r) for r in op12_quality_rules(spark, sf_dir).collect()}
    assert got == {w[0]: w[:7] + w[8:] for w in brute_quality(rows)}


def test_copies_count_once_and_depleted_documents_go(spark):
    body = " ".join(f"b{i}" for i in range(60))
    copies = [(i, body, "en", "h") for i in range(100)]
    menus = [(1000 + i, " ".join(f"m{j}" for j in range(80)) + f"\nonly{i} " + " ".join(f"u{i}x{j}" for j in range(40)), "en", "m") for i in range(40)]
    got = {r.doc_id: (r.removed_lines, r.kept) for r in apply_rules(frame(spark, copies + menus)).collect()}
    assert all(got[i] == ([], True) for i in range(100)) and all(got[1000 + i] == ([0], False) for i in range(40))


def test_lines_are_cut_from_the_text(spark):
    df = spark.createDataFrame([("a\n\nb\nc\n", [0, 2])], "t string, r array<int>")
    assert df.select(without_lines(df.t, df.r).alias("x")).first().x == "\nc\n"


def test_quality_rules_of_an_empty_table(spark):
    assert apply_rules(empty(spark)).collect() == []


# ---- 13: spelling variants ---------------------------------------------------------------


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts):
    drop = defaultdict(set)
    for w in counts:
        drop[w].add(w)
        for i in range(len(w)):
            drop[w[:i] + w[i + 1 :]].add(w)
    partners = defaultdict(set)
    for met in drop.values():
        for a in met:
            partners[a] |= {b for b in met if near(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(partners[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(partners[w]), counts[form[w]] if form[w] is not None else None))
    return out


def vocabulary(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice(["th", "an", "e", "ré", "ß", "o", "ting"]) for _ in range(rng.randint(3, 6))) for _ in range(n)]
    counts = {w: rng.choice([2, 3, 30, 500]) for w in base}
    for w in base:
        i, c = rng.randrange(len(w)), rng.choice("aeñz")
        counts.setdefault(rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]]), rng.choice([2, 3, 30]))
    letters = list("abcdefg")
    for _ in range(80):  # rearranged letters: one count vector
        rng.shuffle(letters)
        counts["".join(letters)] = rng.randint(2, 90)
    return counts


@pytest.mark.parametrize("sample, cell, piece", [(50_000, 12_000, 1 << 19), (200, 15, 1 << 19), (200, 40, 120)])
def test_spelling_groups_equal_brute_force(spark, monkeypatch, sample, cell, piece):
    monkeypatch.setattr(spelling_groups, "SAMPLE_WORDS", sample)
    monkeypatch.setattr(spelling_groups, "CELL_WORDS", cell)
    monkeypatch.setattr(spelling_groups, "PIECE_LETTERS", piece)
    counts = vocabulary(7, 500) | {"": 3, "a": 40, "x" * 400: 5, "x" * 401: 50, "x" * 400 + "y": 7}
    words = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n long").repartition(3)
    assert key(group_spellings(words).collect()) == key(brute_groups(counts))


def test_near_pairs_by_length():
    rng = random.Random(2)
    points = sorted({"".join(rng.choice("abc") for _ in range(8)) for _ in range(900)})
    for size, roles in ((8, (spelling_groups.SAME,)), (7, (spelling_groups.EARLY, spelling_groups.LATE))):
        queries = sorted({"".join(rng.choice("abc") for _ in range(size)) for _ in range(300)})
        got = sorted((queries[q], points[p]) for role in roles for a, b in Cell(points, 8).near(queries, role) for q, p in zip(a, b))
        assert got == sorted((q, p) for q in queries for p in points if near(q, p))


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000, "aabbbbb": 200_000, "zzzzzzzz": 9}
    got = {r.word: (r.form, r.root) for r in group_spellings(spark.createDataFrame([*counts.items()], "word string, n long")).collect()}
    assert got["aaaaaaa"] == ("aaaaaab", "aabbbbb") and got["zzzzzzzz"] == (None, "zzzzzzzz") and got["aabbbbb"] == (None, "aabbbbb")


def brute_words(rows):
    counts = Counter()
    for d, t, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{d}:{run}".encode()) if d is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    return {w: n for w, n in counts.items() if n >= 2}


@pytest.mark.parametrize("clash", [False, True])
def test_spelling_query_equals_brute_force(spark, tmp_path, clash):
    rows = [*edge_rows(), *documents()[:60], (70_001, "ÀÉÎõüÿß×÷ Àéîõüÿß ABCDEFG abcdefg abcdefgh", None, None), (70_002, "x" * 5_000 + " " + "x" * 5_000, None, None)]
    got = op13_spelling_groups(spark, stored(spark, tmp_path, rows, clash))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert key(got.collect()) == key(brute_groups(brute_words(rows)))


def test_spelling_of_an_empty_table(spark):
    assert group_spellings(word_counts(empty(spark))).collect() == []
