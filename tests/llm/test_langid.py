import zlib

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from careline.llm import langid
from careline.llm.queries import held_out, op6_language_id


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op6_language_id(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es", "und"}
    held = [r for r in got if r.held_out and docs[r.doc_id].lang]
    assert len(held) > 100 and np.mean([docs[r.doc_id].lang == r.lang_pred for r in held]) > 0.98


def test_only_the_text_decides(spark):
    """Other languages, sources and ids of held-out documents change no prediction."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs.where(~held_out(F.col("doc_id"))))
    a = langid.predict(docs, model).select("text", "language.*").collect()
    b = langid.predict(docs.withColumns({"lang": F.lit("xx"), "source": F.lit(""), "doc_id": F.lit(1)}), model).select("text", "language.*").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    again = langid.train(docs.repartition(3).where(~held_out(F.col("doc_id"))))
    assert all(np.array_equal(model.pairs[k], again.pairs[k]) for k in model.pairs) and np.array_equal(model.family, again.family)


def test_odd_texts(spark):
    data = [(1, None), (2, ""), (3, "123 !? 45 ½ ²"), (4, " \n"), (5, "é"), (6, "the and of " * 30000), (7, "A."), (7, "A.")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in data], "doc_id bigint, text string, language string, score int")
    model = langid.Model(["en", "de", "fr"], np.array([langid.features(t) for t in ("the and of", "der und die", "le et la")]), langid.FAMILIES)
    got = [(r.language.lang_pred, r.language.score) for r in langid.predict(docs, model).collect()]
    assert [g[0] for g in got[:4]] == ["und"] * 4 and [g[1] for g in got[:4]] == [0.0] * 4
    assert got[5][0] == "en" and got[6] == got[7] and all(0 < g[1] <= 1 for g in got[4:])
    assert langid.predict(docs.limit(0), model).count() == 0


def test_score_does_not_depend_on_the_number_of_families():
    """Machines that give a family nothing leave the score of the others as it is."""
    texts = ["the and of with", "der und die mit", "le et la avec"]
    model = langid.Model(["en", "de", "fr"], np.array([langid.features(t) for t in texts]), langid.FAMILIES)
    x = np.array([langid.features(t) for t in texts])
    before = model.predict(x)
    nothing = np.zeros_like(model.family[:1])
    model.families |= {f"f{i}": [f"f{i}"] for i in range(5)}
    model.family = np.vstack([model.family, *[nothing] * 5])
    after = model.predict(x)
    assert before[0].tolist() == after[0].tolist() == ["en", "de", "fr"] and np.array_equal(before[1], after[1])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12", "en"), (3, None, "en")], "doc_id bigint, text string, lang string")
    assert langid.train(docs) is None
    assert {r.language.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def test_one_language_and_one_family(spark):
    docs = spark.createDataFrame([(i, f"the and of {i}", "en") for i in range(5)], "doc_id bigint, text string, lang string")
    assert {r.language.lang_pred for r in langid.predict(docs, langid.train(docs)).collect()} == {"en"}
    two = docs.union(spark.createDataFrame([(i, f"der und die {i}", "de") for i in range(10, 15)], "doc_id bigint, text string, lang string"))
    got = {r.doc_id: r.language.lang_pred for r in langid.predict(two, langid.train(two)).collect()}
    assert all(v == ("en" if k < 10 else "de") for k, v in got.items())


def test_sample_is_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    docs = docs.union(docs.where("doc_id < 10").withColumn("lang", F.lit("de"))).union(docs.where("doc_id < 10"))
    model = langid.train(docs, per_language=50)
    assert model.langs == ["de", "en"]


def test_rows_of_one_id_are_cut_before_the_collect(spark, monkeypatch):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(7).alias("doc_id"),
                                    F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij").alias("text"), F.lit("en").alias("lang"))
    collect, rows = type(docs).toArrow, []
    monkeypatch.setattr(type(docs), "toArrow", lambda df: rows.append(got := collect(df)) or got)
    langid.train(docs, per_language=2000, sample=2000)
    langid.train(docs.where("doc_id = 7"), per_language=50)
    assert [t.num_rows for t in rows] == [2000, 50] and len(set(rows[1].column("x").to_pylist())) == 50


def test_long_texts_are_read_to_the_end():
    a = "x" * langid._CHUNK * 2 + " zebra crossing"
    counts = langid.features(a)
    assert not np.array_equal(counts, langid.features(a[:-15]))
    assert abs(float((counts**2).sum()) - 1) < 1e-3


def plain_features(text):
    """Shares of one to three adjacent bytes by slot, as square roots, counted one by one."""
    data = [b if b >= 128 or 97 <= b <= 122 else 32 for b in (" " + text.lower() + " ").encode()]
    counts = {}
    for size in (1, 2, 3):
        for at in range(len(data) - size + 1):
            gram = 0
            for b in data[at:at + size]:
                gram = gram << 8 | b
            slot = ((gram * 4 + size) * 2654435761 % 2**32) >> 20
            counts[slot] = counts.get(slot, 0) + 1
    total = sum(counts.values())
    return {k: (n / total) ** 0.5 for k, n in counts.items()}


def test_prediction_equals_plain_loops(spark):
    """Features, the families' machines and the duels of the best family, without arrays."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs.where(~held_out(F.col("doc_id"))))
    texts = [r.text for r in docs.limit(60).collect() if any(c.isalpha() for c in r.text)] + ["a", "Ein Satz mit ß", "¿qué?", "x" * 3000]

    def chance(machine, x):
        margin = float(machine[-1]) + sum(float(machine[k]) * v for k, v in x.items())
        return 1 / (1 + np.exp(-4 * min(10, max(-10, margin))))

    for text in texts:
        x = plain_features(text)
        by_family = {f: chance(model.family[i], x) for i, f in enumerate(model.families)}
        family = max(by_family, key=by_family.get)
        members = model.families[family]
        wins, total = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for (a, b), machine in model.pairs.items():
            if a in members:
                p = chance(machine, x)
                wins[a if p >= 0.5 else b] += 1
                total[a] += p
                total[b] += 1 - p
        best = max(members, key=lambda m: (wins[m], total[m]))
        got, score = model.predict(np.array([langid.features(text)]))
        assert got[0] == best
        assert score[0] == np.float64(score[0]) and abs(score[0] - by_family[family] * total[best] / (len(members) - 1)) < 1e-4


def test_sample_is_the_smallest_hashes_of_each_language(spark):
    """Whatever the number of rows, repeats and texts of one id: the bound holds, and the model is that of the sample alone."""
    words = {"en": "the house and the garden are near", "de": "das haus und der garten sind nah"}
    rows = [(i, lang, f"{words[lang]} {i}") for i in range(300) for lang in words] + [(7, "en", f"{words['en']} x{k}") for k in range(200)]
    df = spark.createDataFrame(rows + rows[:100], "doc_id long, lang string, text string")
    model = langid.train(df, per_language=20, sample=40)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    chosen = df.distinct().withColumn("n", F.row_number().over(order)).where("n <= 20").drop("n")
    alone = langid.train(chosen, per_language=20, sample=40)
    assert np.array_equal(model.family, alone.family)
