"""The mix and the corpus pipeline against brute force."""

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pyarrow.parquet as pq
import pytest
from llm_fixtures import SMALL, documents, edge_rows, empty, frame
from pyspark.sql import functions as F

from paysift.llm import decontaminate, language_id, mixing
from paysift.llm.queries import DOMAIN_WEIGHTS, LANG_WEIGHTS, MAX_EPOCHS, SEED, mix_levels


def brute_share(budget, children):
    """{child: budget} of siblings {child: (weight, capacity)}: fill the child with the least capacity per weight while its share would overfill it."""
    out, open_ = {}, {k: v for k, v in children.items() if v[0] > 0 and v[1] > 0}
    while open_:
        name = min(open_, key=lambda k: (Fraction(open_[k][1], open_[k][0]), k))
        w, cap = open_[name]
        if cap * sum(x for x, _ in open_.values()) > budget * w:
            break
        out[name] = cap
        budget -= cap
        del open_[name]
    total = sum(x for x, _ in open_.values())
    return out | {k: budget * w // total for k, (w, _) in open_.items()}


def branch(d, text, lang, source):
    number = re.search("([0-9]+)$", source or "")
    return (str(int(number[1]) % 4) if number else "(none)", "(none)" if lang is None else lang, "(none)" if source is None else source)


def brute_mix(rows, total=None, weights=(DOMAIN_WEIGHTS, LANG_WEIGHTS, {}), max_epochs=MAX_EPOCHS):
    """Sorted (doc_id, domain, lang, source, epoch, n_tokens, take_tokens)."""
    leaves = defaultdict(list)
    for d, text, lang, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        if n:
            leaves[branch(d, text, lang, source)].append((d, n))
    tokens = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}
    everything = sum(tokens.values())
    budgets = {(): min(everything * max_epochs, everything if total is None else total)}
    for level in range(3):
        kids = defaultdict(dict)
        for leaf, n in tokens.items():
            have = kids[leaf[:level]].get(leaf[level], (0, 0))[1]
            kids[leaf[:level]][leaf[level]] = (weights[level].get(leaf[level], 1), have + n * max_epochs)
        budgets = {(*path, k): b for path, budget in budgets.items() for k, b in brute_share(budget, kids[path]).items()}
    out = []
    for leaf, budget in budgets.items():
        passes, rest = divmod(budget, tokens[leaf])
        out += [(d, *leaf, e, n, n) for d, n in leaves[leaf] for e in range(passes)]
        digest = lambda d: hashlib.md5(f"{SEED}:{passes}:{'' if d is None else d}".encode()).hexdigest()  # noqa: B023, E731
        for d, n in sorted(leaves[leaf], key=lambda x: (digest(x[0]), x[0] is not None, x[0] or 0, x[1])):
            if rest > 0:
                out.append((d, *leaf, passes, n, min(n, rest)))
                rest -= n
    return sorted(out, key=str)


def mixed(df):
    return sorted((tuple(r) for r in df.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "take_tokens").collect()), key=str)


@pytest.mark.parametrize("total", [None, 0, 1, 5_003, 10**9])
@pytest.mark.parametrize("clash, bucket", [(False, 4096), (True, 3)])
def test_mix_equals_brute_force(spark, total, clash, bucket, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows = documents() + edge_rows()
    got = mixed(mixing.mix(frame(spark, rows, clash), mix_levels(), total, MAX_EPOCHS, SEED))
    assert got == brute_mix(rows, total)
    asked = sum(len((t or "").split()) for _, t, *_ in rows) * (1 if total is None else MAX_EPOCHS)
    spent = sum(r[-1] for r in got)
    assert spent <= (asked if total is None else min(asked, total))


def test_mix_meets_shortages_by_siblings_first(spark):
    # domain 0 has en (scarce) and de; domain 1 has plenty: en's shortage goes to de, not to domain 1
    rows = [(1, "a " * 10, "en", "s0"), (2, "b " * 1000, "de", "s0"), (3, "c " * 1000, "en", "s1")]
    got = mixing.leaf_budgets(
        spark.createDataFrame([("0", "en", "s0", 10), ("0", "de", "s0", 1000), ("1", "en", "s1", 1000)], "domain string, lang string, source string, tokens long"),
        [("domain", F.lit(1)), ("lang", F.lit(1)), ("source", F.lit(1))], 400, 1,
    )
    assert {(r["domain"], r["lang"]): r["budget"] for r in got.collect()} == {("0", "en"): 10, ("0", "de"): 190, ("1", "en"): 200}
    assert mixed(mixing.mix(frame(spark, rows), mix_levels(), 400, 1, SEED)) == brute_mix(rows, 400, max_epochs=1)


def test_mix_of_nothing(spark):
    assert mixing.mix(empty(spark), mix_levels()).collect() == []
    zero = [(n, v, F.lit(0)) for n, v, _ in mix_levels()]
    assert mixing.mix(frame(spark, documents()), zero).collect() == []


def brute_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_near(rows):
    sets = {d: brute_shingles(t) for d, t, *_ in rows if d is not None}
    by = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            by[x].add(d)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d, s in sets.items():
        for o in set().union(*(by[x] for x in s)) if s else ():
            both = len(s & sets[o])
            if 100 * both >= 80 * (len(s) + len(sets[o]) - both):
                a, b = sorted((find(d), find(o)))
                root[b] = a
    return {d for d in sets if find(d) == d}


def test_each_pipeline_stage_equals_brute_force(spark):
    import corpus_pipeline

    items = pq.read_table(f"{SMALL}/benchmark.parquet").to_pydict()
    windows = {w for t in items["text"] for w in decontaminate.windows_of(t)}
    rows = documents() + edge_rows() + [(20_001, "An opening. " + max((t for t in items["text"] if t), key=len) + " The end.", "en", "src1")]
    docs = frame(spark, rows)
    words = language_id._Words(language_id.train(docs))

    def told(text):
        lang, score = language_id.predict_text(text, words)
        return lang != "und" and score >= 0.5

    def first_copies(rows):
        least = {}
        for r in rows:
            key = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
            least[key] = min(least.get(key, r), r, key=lambda x: (x[0] is None, x[0] or 0))
        return list(least.values())

    def clean(text):
        line = f" {' '.join(re.findall('[0-9A-Za-z\u0080-\U0010ffff]+', re.sub('[A-Z]', lambda m: m[0].lower(), text or '')))} "
        return not any(w in line for w in windows)

    brute = {
        "language_id": lambda rows: [r for r in rows if told(r[1])],
        "exact_dedup": first_copies,
        "ngram_jaccard": lambda rows: [r for near in [brute_near(rows)] for r in rows if r[0] is None or r[0] in near],
        "decontaminate": lambda rows: [r for r in rows if clean(r[1])],
    }
    assert [name for name, _ in corpus_pipeline.STAGES] == [*brute, "source_mix"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        before, rows = rows, brute[name](rows)
        assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(rows, key=str), name
        assert 0 < len(rows) < len(before), name
        docs = frame(spark, rows)
    assert mixed(corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)) == brute_mix(rows)
