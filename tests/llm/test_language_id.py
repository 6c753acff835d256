import pytest
from pyspark.sql import functions as F

from riskledger.llm import language_id as li

DATA = "/root/testdata/sf0.01"
SAMPLES = {
    "en": "the of and that this with from they were have been their would there which",
    "de": "der die und nicht mit sich auch eine werden haben durch zwischen schön für",
    "fr": "les des est une que pour dans avec sont mais être cette aussi leur où",
    "es": "los las una que por con para está pero como más este también entre año",
}


@pytest.fixture(scope="module")
def labelled(documents):
    rows, number = [], 0
    for lang, words in SAMPLES.items():
        words = words.split()
        for k in range(40):
            text = " ".join(words[(k * 7 + j * 3) % len(words)] for j in range(12))
            rows.append((number := number + 1, text, lang))
    return documents([*rows, (9001, "unlabelled words", None), (9002, None, "en")])


def test_families():
    assert li.family_of("en") == li.family_of("de-AT") == "germanic"
    assert li.family_of("tlh") == "other"


def test_prediction_and_edge_cases(labelled, documents):
    model = li.fit(labelled.select("doc_id", "text", "lang"))
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    rows = [(1, "They would have been there"), (2, None), (3, ""), (4, "12 345 !?"),
            (5, "nicht durch die werden"), (6, "cette aussi dans les"), (7, "para los años también"),
            (8, "THEY WOULD HAVE BEEN THERE"), (9, "the and which " * 100_000), (9, "a")]
    got = documents(rows).select("doc_id", li.predict(documents(rows), model).alias("p")).collect()
    found = [(r.doc_id, r.p.lang) for r in got][:9]
    assert found == [(1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "de"), (6, "fr"), (7, "es"),
                     (8, "en"), (9, "en")]
    assert all(0 <= r.p.score <= 1 for r in got) and got[1].p.score == 0


def test_more_than_two_families(documents):
    texts = {"en": "the which were have", "fr": "les dans cette être", "ru": "это когда были который",
             "fi": "mutta koska olivat joka"}
    rows = [(i * 4 + k, " ".join([t] * (i % 5 + 1)), lang) for k, (lang, t) in enumerate(texts.items()) for i in range(15)]
    model = li.fit(documents(rows).select("doc_id", "text", "lang"))
    given = documents([(k, t) for k, t in enumerate(texts.values())])
    got = given.select(li.predict(given, model).alias("p")).collect()
    assert [r.p.lang for r in got] == list(texts)


def test_one_or_no_language(documents):
    one = li.fit(documents([(1, "hello there", "en")]).select("doc_id", "text", "lang"))
    given = documents([(1, "bonjour"), (2, "1")])
    assert [r.p.lang for r in given.select(li.predict(given, one).alias("p")).collect()] == ["en", "und"]
    none = li.fit(documents([(1, "hello", None)]).select("doc_id", "text", "lang"))
    assert [r.p.lang for r in given.select(li.predict(given, none).alias("p")).collect()] == ["und"] * 2


def test_filter_keeps_columns(labelled, documents):
    docs = documents([(1, "they would have"), (2, "..."), (3, None), (4, "nicht durch")])
    model = li.fit(labelled.select("doc_id", "text", "lang"))
    kept = li.keep_identified(docs, model)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1, 4]
    assert [r.doc_id for r in li.keep_identified(docs, model, ["de"]).collect()] == [4]
    clashing = docs.selectExpr("*", "1 AS language", "2 AS `row`", "3 AS __language")
    assert li.keep_identified(clashing, model).columns == clashing.columns
    assert li.keep_identified(clashing, model).count() == kept.count()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    report = li.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id")
    share = report.filter("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert share >= 0.97
    same = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    assert report.filter(F.col("held_out") != same).count() == 0
    assert report.count() == docs.count()
