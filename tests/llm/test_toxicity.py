import random

import numpy as np
from pyspark.sql import functions as F

from riskledger.llm import toxicity as tx
from riskledger.llm.blocks import blocks

DATA = "/root/testdata/sf0.01"


def training(spark, documents, n=400):
    rnd = random.Random(6)
    words = [f"word{k}" for k in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        rude, junk = rnd.random() < 0.3, rnd.random() < 0.3
        if rude:
            text.insert(rnd.randrange(len(text)), rnd.choice(["idiot", "scumbag", "scumling"]))
        if junk:
            text += ["zzz", "qqq"]
        docs.append((i, " ".join(text)))
        labels.append((i, int(junk), int(rude or junk)))
    labels += [(5, None, None), (None, 1, 1), (99_999, 1, 1), (7, 0, 0), (7, 0, 0)]
    return documents(docs), spark.createDataFrame(labels, "doc_id long, junk int, bad int")


def test_later_links_use_earlier_probabilities(spark, documents):
    docs, labels = training(spark, documents)
    chain = tx.fit(docs, labels, ["junk", "bad"])
    assert [link.category for link in chain.links] == ["junk", "bad"]
    assert len(chain.links[0].earlier) == 0 and len(chain.links[1].earlier) == 1
    assert chain.links[1].earlier[0] > 0
    rows = [(1, "Word1 IDIOT word2"), (2, "word1 word2 word3"), (3, None), (4, ""), (5, "zzz qqq word9"),
            (6, "word5 " * 50_000 + "idiot"), (1, "Word1 IDIOT word2")]
    given = documents(rows)
    got = [r.p for r in given.select(tx.predict(given, chain).alias("p")).collect()]
    assert [r.bad > 0.5 for r in got] == [True, False, False, False, True, True, True]
    assert got[4].junk > 0.5 > got[0].junk
    assert [r.any_word for r in got] == [True, True, False, False, True, True, True]


def test_constant_categories_and_no_labels(spark, documents):
    docs = documents([(1, "a b"), (2, "c d"), (None, "e")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, yes int, no int")
    p = docs.select(tx.predict(docs, tx.fit(docs, labels, ["yes", "no"])).alias("p")).first().p
    assert (round(p.yes, 6), round(p.no, 6)) == (1.0, 0.0)
    none = tx.fit(docs, labels.limit(0), ["yes", "no"])
    p = docs.select(tx.predict(docs, none).alias("p")).first().p
    assert (round(p.yes, 6), round(p.no, 6)) == (0.0, 0.0)


def test_features_are_words_and_prefixes():
    import pyarrow as pa

    (block,) = blocks(pa.array(["abcdef abc abcdef", None, "ABCDEF", "abcdxyz"]))
    bounds, features = tx.text_features(block)
    assert np.diff(bounds).tolist() == [4, 0, 3, 3]
    of = [set(features[s:e].tolist()) for s, e in zip(bounds[:-1], bounds[1:])]
    assert len(of[0] & of[3]) == 1  # the first four letters


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    report = tx.toxicity_report(docs, labels)
    assert report.count() == docs.count()
    judged = report.join(labels.select("doc_id", F.col("toxic").alias("truth")), "doc_id").filter("held_out")
    n = {(r.truth, r.toxic): r["count"] for r in judged.groupBy("truth", "toxic").count().collect()}
    # Few labels here; clean documents stay clean and most toxic ones are found.
    assert n.get((0, True), 0) <= 0.05 * n[(0, False)]
    assert n.get((1, True), 0) >= n.get((1, False), 0)
