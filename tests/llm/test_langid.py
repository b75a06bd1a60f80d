import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from difframe.llm.langid import NAMES, Model, codewords, detect_languages, label_language, prose_words
from difframe.runtime import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def found(spark):
    docs, cells, langs = (table(spark, SF, t) for t in ("documents", "notebook_cells", "languages"))
    return detect_languages(docs, cells, langs).cache()


def test_labels(spark):
    forms = {"en-US": "en", " EN": "en", "en_GB": "en", "German": "de", "ger": "de", "deu": "de", "zh-Hans": "zh", "und": None, "": None, None: None, "unknown": None, "  ": None, "12": None}
    df = spark.createDataFrame([Row(x=k) for k in forms], "x string").withColumn("y", label_language(F.col("x")))
    assert {r.x: r.y for r in df.collect()} == forms


def test_codewords_are_far_apart():
    code = codewords(12)
    assert min((code[i] != code[j]).sum() for i in range(12) for j in range(i)) >= 7


def test_prose_words():
    assert prose_words("## Die Breite `fit_profile(x)` $\\sin x$ https://a.b/c load_scan run2 ![pic](a.png) passt (n = 3)") == ["die", "breite", "passt", "n"]
    assert prose_words("$$ 1 $$") == [] and prose_words("`abc`") == ["abc"]


def test_held_out_accuracy(spark, found):
    """Cells of documents whose label names a language: nearly all agree, though labels may be wrong."""
    cells = found.where("cell_no >= 0 AND label_lang IS NOT NULL")
    assert cells.where("lang = label_lang").count() > 0.8 * cells.count()
    assert cells.where("label_lang IN ('ru', 'ja', 'zh') AND lang IN ('ru', 'ja', 'zh') AND lang <> label_lang").count() < 0.1 * cells.count()
    # Scripts are certain: Cyrillic text is Russian, kana is Japanese.
    texts = table(spark, SF, "documents").select("doc_id", "text", "layout").join(table(spark, SF, "notebook_cells"), "doc_id").where("layout <> 'json'")
    piece = F.substring("text", F.col("start_char") + 1, F.col("length"))
    seen = texts.select("doc_id", "cell_no", piece.alias("t")).join(found.where("cell_no >= 0"), ["doc_id", "cell_no"])
    for script, lang in (("\\p{IsCyrillic}{4}", "ru"), ("\\p{IsHiragana}{2}", "ja")):
        own = seen.where(F.col("t").rlike(script))
        assert own.count() > 0 and own.where(F.col("lang") != lang).count() == 0


def test_model_trained_on_part_scores_the_rest():
    data = {
        "de": "der die das und nicht wird eine kleine messung zeigt zwei gruppen ohne jede glättung nach der korrektur".split(),
        "en": "the and with without smoothing each small measurement shows two groups after the correction was made".split(),
        "fr": "le la les et avec sans lissage chaque petite mesure montre deux groupes après la correction faite".split(),
    }
    cells, labels = [], []
    for lang, w in data.items():
        for i in range(len(w) - 4):
            cells.append(w[i : i + 5])
            labels.append(lang)
    labels[0] = "fr"  # one wrong label
    m = Model(sorted(data))
    m.fit(cells, labels)
    assert [m.classify(c)[0] for c in cells[:3]] == ["de"] * 3
    assert m.classify(["measurements", "grouped"])[0] == "en" and m.classify([]) == (None, 0.0)


def _small(spark, rows):
    docs = spark.createDataFrame([Row(doc_id=i, text=t, lang=la, layout="transcript", label="x", cells=0) for i, (t, la, _) in enumerate(rows)], "doc_id long, text string, lang string, layout string, label string, cells int")
    cells = spark.createDataFrame([(i, k, "markdown", None, a, n) for i, (_, _, cs) in enumerate(rows) for k, (a, n) in enumerate(cs)], "doc_id long, cell_no int, cell_type string, exec_count int, start_char int, length int")
    return docs, cells, spark.createDataFrame([("de", "Latin"), ("en", "Latin")], "lang string, script string")


def test_edge_cases(spark):
    de, en = "Die kleine Messung zeigt zwei Gruppen nach der Korrektur.", "The small measurement shows two groups after the correction."
    both = de + en
    rows = [(de, "de", [(0, len(de))])] * 6 + [(en, "EN-us", [(0, len(en))])] * 6
    rows += [(en, None, [(0, len(en))]), (None, "de", []), ("", None, []), (both, "de", [(0, len(de)), (len(de), len(en))]), (both * 2, "de", [(0, len(de)), (len(de), len(en)), (len(both), len(de))]), ("123 ++", "de", [(0, 6)]), (en * 5000, "xx", [(0, 5000 * len(en))])]
    docs, cells, langs = _small(spark, rows)
    out = detect_languages(docs, cells.union(cells), langs)
    wrong = {(r.doc_id, r.cell_no, r.lang) for r in out.where("wrong").collect()}
    assert wrong == {(12, -1, "en"), (16, 1, "en"), (18, -1, "en")}
    assert {(r.doc_id, r.lang) for r in out.where("cell_no = -1 AND lang IS NULL").collect()} == {(15, None), (17, None)}
    assert detect_languages(docs.limit(0), cells, langs).count() == 0
    assert detect_languages(docs, cells.limit(0), langs).count() == 0


def test_every_language_has_names():
    assert len({f for k, v in NAMES.items() for f in (k, *v)}) == sum(1 + len(v) for v in NAMES.values())
