
from llm_fixtures import frame
from pyspark.sql import functions as F

from paysift.llm import html_text, language_id, queries, secrets
from paysift.llm.sampling import in_share, sample
from paysift.llm.sentence_dedup import remove_repeated_sentences


def test_language_model_keeps_rare_words(spark):
    """9,000 words of one language, each seen once beside common ones: all are known."""
    letters = "abcdefghijklmnopqrst"
    name = lambda i: "".join(letters[i // 20**k % 20] for k in range(4))
    rows = [(i, " ".join(f"{name(j)}x" for j in range(30 * i, 30 * i + 30)), "aa", "s") for i in range(400)] + [(1000 + i, "common words of another one", "bb", "s") for i in range(30)]
    model = language_id.train(frame(spark, rows))
    words = {w for d, t, lang, _ in rows for w in t.split() if not spark_held(d)}
    assert len(words) > 8_000 and all(map(model.knows, words)) and (model.kinds == 0).sum() == len(words)
    assert (model.kinds == 4).sum() == len({g for w in words for g in language_id.grams(w, 4)}) > 4_000


def spark_held(d):
    import zlib

    return zlib.crc32(str(d).encode()) % 4 == 2


def test_rare_language_is_learned_whole(spark):
    """20 documents of a language among 4,000 of another: the sample takes all of them, and about 40 of the other."""
    rows = [(i, "plain words of the common language number " + "abcdefghij"[i % 10], "big", "s") for i in range(4_000)]
    rows += [(10_000 + i, f"seldom heard speech {name} zzq", "rare", "s") for i, name in enumerate("one two three four five six seven eight nine ten".split() * 2)]
    model = language_id.train(frame(spark, rows), sample_rows=40)
    assert model.langs == ["big", "rare"]
    words = {w for d, t, lang, _ in rows if lang == "rare" and not spark_held(d) for w in t.split()}
    assert all(map(model.knows, words))
    got = language_id.identify(frame(spark, rows), sample_rows=40).where("doc_id >= 10000").collect()
    assert {r["lang_pred"] for r in got} == {"rare"}


def test_sample_is_bounded_and_never_empty(spark):
    rows = spark.range(200_000).selectExpr("id", "if(id % 1000 = 0, 'b', 'a') g")
    found = {r["g"]: r["c"] for r in sample(rows, 500, "g", "id").groupBy("g").agg(F.count("*").alias("c")).collect()}
    assert found["b"] == 200 and 400 < found["a"] < 600
    # the threshold of a share below 2 ** -20, which the former rounding made 0
    assert sample(rows.where("g = 'a'"), 0.5, "g", "id").count() < 20 and (0.5 / 2**40 - 0.5) * 2.0**64 > -(2.0**63)


def test_every_repeated_run_goes(spark, tmp_path):
    """The registered query: short runs, quoted and Unicode sentence ends, whole short texts."""
    rows = [
        (1, "Own start here. Yes. No. Well.", None, None),
        (2, "Yes. No. Well. Another own end of it.", None, None),
        (3, 'He said "stop." She said (go!) They "left?" First own.', None, None),
        (4, 'Second own. He said "stop." She said (go!) They "left?"', None, None),
        (5, "今天天气很好。我们去公园。「你好。」她说。", None, None),
        (6, "另一个开头。今天天气很好。我们去公园。「你好。」她说。", None, None),
        (7, "यह एक है। वह दो है। यह तीन है।", None, None),
        (8, "पहले। यह एक है। वह दो है। यह तीन है।", None, None),
        (9, "Only one sentence", None, None),
        (10, "only  one sentence", None, None),
        (11, "", None, None),
        (12, " ", None, None),
    ]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_sentences"], r["kept"]) for r in queries.op9_sentence_dedup(spark, str(tmp_path)).collect()}
    assert [got[i][1] for i in (1, 3, 5, 7, 9, 11, 12)] == [rows[i - 1][1] for i in (1, 3, 5, 7, 9, 11, 12)]
    assert [got[i] for i in (2, 4, 6, 8, 10)] == [(4, "Another own end of it."), (4, "Second own. "), (5, "另一个开头。"), (4, "पहले। "), (1, "")]
    kept = {r["doc_id"]: r["kept"] for r in remove_repeated_sentences(frame(spark, rows)).collect()}
    assert kept[2] == rows[1][1] and kept[10] == rows[9][1]  # the library's defaults stay


def test_wrappers_and_regions_of_pages():
    words = "several plain words of an article that goes on"
    side = "<div class='left-sidebar'><p>menu words</p></div>"
    pages = {
        **{f"<body><div class='{c}'><article><h1>T</h1><p>{words}</p></article>{side}</div></body>": f"T\n\n{words}" for c in ("layout has-sidebar", "no-sidebar", "share-enabled", "widget")},
        f"<body><form id=aspnetForm action=x><div><h1>T</h1><p>{words}</p><p>{words}</p></div></form></body>": f"T\n\n{words}\n\n{words}",
        f"<body><form><nav>Home</nav><main><p>{words}</p></main><label>Name</label></form></body>": words,
        # the region lies in one of the articles of <main>
        f"<main><article><p>{words * 9}</p></article><nav>{'<a>x</a>' * 40}</nav><article><p>teaser</p></article></main>": words * 9,
        # long comments are not the page
        f"<body><div><h1>T</h1><p>{words * 4}</p></div><div id=comments><p>{words * 20}</p></div></body>": f"T\n\n{words * 4}",
    }
    for page, want in pages.items():
        assert html_text.main_text(page, html_text.Weights({})) == want, page


def test_secret_words_are_counted_over_all_documents(spark):
    """A word of 30 of 6,000 documents ranks by exactly that count; 6,000 kinds of words fit in the list."""
    letters = "abcdefghij"
    name = lambda i: "".join(letters[i // 10**k % 10] for k in range(4))
    rows = [(i, f"z{name(i)} " + ("thirtyfold " if i % 200 == 0 else "") + ("fewer " if i % 250 == 0 else "") + "always", None, None) for i in range(6_000)]
    ranks = secrets.learn_words(frame(spark, rows))
    first = len(dict.fromkeys(secrets.COMMON))
    assert [w for w, r in sorted(ranks.items(), key=lambda x: x[1])][first : first + 3] == ["always", "thirtyfold", "fewer"]
    assert all(f"z{name(i)}" in ranks for i in range(6_000))


def test_share_of_rows(spark):
    ids = spark.range(100_000)
    assert ids.where(in_share("id", share=1.5)).count() == 100_000
    assert 800 < ids.where(in_share("id", share=0.01)).count() < 1_200
    # the threshold of one page in 2 ** 40 is above the least hash; the former one was 0
    assert ids.selectExpr("-9223372036854775807L as h").where(F.col("h").cast("double") < (2.0**-40 - 0.5) * 2.0**64).count() == 100_000
