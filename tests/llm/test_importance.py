import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from postgauge.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def runs(text, longest, buckets):
    words = WORD.findall(lower(text))
    made = [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) % buckets for f in made]


def plain(docs, target, percent=25, seed=7, least=20, longest=2, buckets=10_000):
    """doc_id, n_features, weight, score and whether the row may be drawn; the cut as a set of scores."""
    made = [runs(t, longest, buckets) for _, t in docs]
    s = Counter(c for _, codes in made for c in codes)
    t = Counter(c for text in target for c in runs(text, longest, buckets)[1])
    total_s, total_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))

    rows = []
    for (doc_id, _), (n, codes) in zip(docs, made):
        weight = sum(map(gain, codes)) // len(codes) if codes else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(codes), weight, score, n >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = list(range(1, percent * len(able) // 100 + 1))
    placed = [(*r[:4], k) for k, r in zip(ranks, able)]
    return Counter(placed + [(*r[:4], None) for r in able[len(ranks) :]] + [(*r[:4], None) for r in rows if not r[4]])


def found(df, doc_id="doc_id"):
    return Counter(tuple(r) for r in df.select(f"row.{doc_id}", "n_features", "weight", "score", "rank").collect())


TEXT = st.text(st.sampled_from("aB1é日 .\0\n"), max_size=30)


@given(st.lists(st.none() | TEXT, max_size=8), st.integers(1, 4), st.sampled_from([7, 10_000, 1 << 20]))
@settings(deadline=None)
def test_runs_are_those_of_each_text_alone(texts, longest, buckets):
    n_words, n_features, codes = I.hashed_runs([None if t is None else t.encode() for t in texts], longest, buckets)
    expected = [runs(t, longest, buckets) for t in texts]
    assert n_words.tolist() == [n for n, _ in expected]
    ends = np.cumsum([0, *n_features]).tolist()
    assert [sorted(codes[a:b].tolist()) for a, b in zip(ends, ends[1:])] == [sorted(c) for _, c in expected]


def test_draw_equals_the_definition(spark):
    docs = [(k, " ".join(f"w{(k * j) % 37}" for j in range(k % 45))) for k in range(300)]
    docs += [(None, None), (None, "x " * 25), (5000, ""), (5001, "Ünï Ünï " * 20), (5002, "long words " * 50_000)]
    docs += docs[100:110] + docs[100:101] * 3  # repeated rows tie in score and id
    target = ["w1 w2 w3 w5 " * 30, None, "", "Ünï"]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, row int, id int").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    assert found(I.resample(df, wanted)) == plain(docs, target)
    got = I.resample(df, wanted, percent=60, seed=3, least_words=0, longest=3, buckets=100, carry=["doc_id"])
    assert found(got) == plain(docs, target, 60, 3, 0, 3, 100)
    assert got.select("row.*").columns == ["doc_id"]


def test_empty_tables(spark):
    schema = "doc_id bigint, text string"
    none, some = spark.createDataFrame([], schema), spark.createDataFrame([(1, "a b " * 20)], schema)
    assert I.resample(none, some).count() == 0
    assert found(I.resample(some, none)) == plain([(1, "a b " * 20)], [])


def test_the_draw_leans_towards_the_target(spark):
    docs = [(k, ("good words here " if k % 2 else "other stuff there ") * 10) for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    drawn = I.resample(df, spark.createDataFrame([("good words here " * 50,)], "text string")).where("rank is not null")
    like = drawn.selectExpr("avg(row.doc_id % 2)").first()[0]
    assert like > 0.9
