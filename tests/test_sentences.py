"""Abbreviations from planted texts against a plain count, and sentences that go on after them."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postgauge.operators import sentences


def corpus():
    """Three hundred texts in which `dr.` and `e.g.` always have a stop; other words end sentences."""
    words = "garden window letter river morning kitchen bottle paper".split()
    texts = []
    for k in range(300):
        a, b, c = (words[(k * m + k // 8) % 8] for m in (1, 3, 5))
        texts.append(f"We saw Dr. Hill near the {a} and a {b}. Tools, e.g. a {c}, lay by the {b}. The {a} was old! Was it?")
    return texts + [None, "", " \n", "dr", "Étang. été."]


def plain_scores(texts):
    n, stops = Counter(), Counter()
    for text in texts:
        for token in re.findall(r"[^\W\d_]+(?:\.[^\W\d_]+)*\.?", text or ""):
            word = token.removesuffix(".").lower()
            n[word] += 1
            stops[word] += token.endswith(".")
    p, scores = stops.total() / n.total(), {}
    for word, k in stops.items():
        rest, letters = n[word] - k, len(word.replace(".", ""))
        if k:
            ratio = k * math.log(0.99 / p) + rest * math.log(0.01 / (1 - p))
            scores[word] = 2 * ratio * (word.count(".") + 1) / math.exp(letters) / letters**rest if rest < 200 else 0.0
    return scores


def test_planted_abbreviations(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, body string").repartition(3)
    counts = sentences.stop_counts(docs, "body")
    found = {r["word"]: r["score"] for r in sentences.abbreviations(counts).collect()}
    wanted = {w: s for w, s in plain_scores(texts).items() if s >= sentences.THRESHOLD}
    assert {"dr", "e.g"} <= set(found) and not {"garden", "river", "paper"} & set(found)
    assert found == pytest.approx(wanted)
    split = sentences.split_sentences(docs, "body", "id", sentences.abbreviations(counts))
    rows = sorted(split.where("id = 0").collect(), key=lambda r: r["sentence_no"])
    assert [r["sentence"] for r in rows] == [
        "We saw Dr. Hill near the garden and a garden.", "Tools, e.g. a garden, lay by the garden.", "The garden was old!", "Was it?",
    ]
    assert {r["id"] for r in split.select("id").distinct().collect()} == set(range(301)) - {300} | {303, 304}


def test_pieces_that_go_on(spark):
    known = spark.createDataFrame([("dr",), ("e.g",), ("dr",)], "word string")
    texts = ["Dr. Dr. Who. Yes.", "Ends with Dr.", "xdr. Next.", "(dr. x) e.g. E.G. y. Dr.\nz", "dr! No.", "."]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    split = sentences.split_sentences(docs, "body", "id", known).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("sentence_no", "sentence"))).alias("s"))
    got = {r["id"]: [x["sentence"] for x in r["s"]] for r in split.collect()}
    assert got == {0: ["Dr. Dr. Who.", "Yes."], 1: ["Ends with Dr."], 2: ["xdr.", "Next."], 3: ["(dr. x) e.g. E.G. y.", "Dr. z"], 4: ["dr!", "No."], 5: ["."]}


def test_empty_tables_and_too_many_words(spark, monkeypatch):
    none = spark.createDataFrame([], "id int, body string")
    counts = sentences.stop_counts(none, "body")
    assert counts.collect() == [] and sentences.abbreviations(counts).collect() == []
    assert sentences.split_sentences(none, "body", "id", sentences.abbreviations(counts)).collect() == []
    only = spark.createDataFrame([(1, "a. b. c.")], "id int, body string")
    assert sentences.abbreviations(sentences.stop_counts(only, "body")).collect() == []  # nothing to compare with
    monkeypatch.setattr(sentences, "MAX_WORDS", 1)
    with pytest.raises(ValueError):
        sentences.split_sentences(only, "body", "id", spark.createDataFrame([("a",), ("b",)], "word string"))
