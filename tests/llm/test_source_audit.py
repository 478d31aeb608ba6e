import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postgauge.llm import source_audit as S

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows, least, top):
    """(lang, source, part, item) to (value, rank), by the definition."""
    rows = [(lang or "", source or "", TERM.findall(lower(text))) for lang, source, text in rows]
    out = {}
    for lang in {r[0] for r in rows}:
        docs = Counter(w for a, _, words in rows if a == lang for w in set(words))
        kept = {w for w, n in docs.items() if n >= least}
        had = defaultdict(Counter)
        whole = Counter()
        for a, source, words in rows:
            if a == lang:
                had[source].update(w for w in words if w in kept)
                whole.update(w for w in words if w in kept)

        def shares(counts):
            total = sum(counts.values()) + 2 * len(kept)
            return {w: 1 + 10**9 * (counts[w] + 2) // total for w in kept}

        q = shares(whole)
        p = {source: shares(counts) for source, counts in had.items()}
        for source in p:
            far = {o: sum((p[source][w] - p[o][w]) ** 2 // (p[source][w] + p[o][w]) for w in kept) for o in p if o != source}
            ahead = {w: (p[source][w] - q[w]) ** 2 // (p[source][w] + q[w]) for w in kept if had[source][w] and p[source][w] > q[w]}
            for part, values, most in (("pair", far, len(far)), ("term", ahead, top)):
                order = sorted(values, key=lambda i: (-values[i], i.encode()))[:most]
                out |= {(lang, source, part, item): (values[item], k + 1) for k, item in enumerate(order)}
    return out


def found(df):
    rows = df.collect()
    got = {(r.lang, r.source, r.part, r.item): (r.value, r["rank"]) for r in rows}
    assert len(got) == len(rows)
    return got


WORDS = st.text(st.sampled_from("abAB é日\0 .1\n"), max_size=14) | st.sampled_from(["wordsofeight", "wordsofe", "wordsofeightandmore", "x" * 40])


@given(st.lists(st.lists(WORDS, max_size=6).map(" ".join), max_size=30))
@settings(deadline=None)
def test_pointers_are_sorted_by_word_and_then_by_text(texts):
    data = [t.encode() for t in texts]
    begins = np.cumsum([0, *map(len, data)])
    found = S.Pointers(np.frombuffer(b"".join(data), np.uint8), begins)
    expected = sorted((w.encode(), k) for k, t in enumerate(texts) for w in TERM.findall(lower(t)))
    for few, width in ((S.FEW, S.SLICE), (1, 9)):  # by comparison, and by splits alone
        old, (S.FEW, S.SLICE) = (S.FEW, S.SLICE), (few, width)
        try:
            order, runs = found.sort(np.arange(len(found.at)))
        finally:
            S.FEW, S.SLICE = old
        assert [(found.word(k), int(found.docs[k])) for k in order] == expected
        assert [k for k in range(len(expected)) if not k or expected[k][0] != expected[k - 1][0]] == runs.tolist()
        assert found.words(order).to_pylist() == [w.decode() for w, _ in expected]


def test_a_sliced_shard_counts_its_own_texts_only():
    texts = pa.array(["no no", "A b a", None, "B", "no"]).slice(1, 3)
    langs, sources = pa.array(["x", "en", "en", "en", "x"]).slice(1, 3), pa.array(["x", "s", "t", "s", "x"]).slice(1, 3)
    got = sorted(zip(*S.shard_counts(texts, langs, sources).to_pydict().values()))
    assert got == [("en", "s", "a", 2, 1), ("en", "s", "b", 2, 2)]


def test_many_equal_words_are_split_around_pivots():
    words = [b"same"] * 50_000 + [b"%d" % 0 + b"zz"] + [b"samesamesamesame%s" % (b"a" * (k % 30)) for k in range(30_000)]
    data = b" ".join(words)
    found = S.Pointers(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    order, runs = found.sort(np.arange(len(found.at)))
    got = [found.word(k) for k in order]
    assert got == sorted(got) and len(runs) == len(set(got))


@pytest.mark.parametrize("block,share", [(64, 2048), (2, 3)])
def test_audit_equals_the_definition(spark, block, share):
    rows = []
    for k in range(90):
        lang = [None, "", "en", "de"][k % 4]
        source = [None, "a", "b", "ü", "c"][k * 7 % 5]
        words = [f"w{'abcdefgh'[(k * j) % 8]}" for j in range(k % 9)] + ["common", "Ünï" * (k % 3)]
        rows.append((lang, source, None if k % 11 == 0 else " ".join(words)))
    rows += rows[:20] + [("xx", "lonely", "nothing is kept here"), ("yy", "e", None), ("yy", "f", ""), ("en", "long", "wa wb " * 30_000)]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "lang string, source string, text string, term int")
    got = found(S.audit_sources(docs.repartition(3), least_docs=4, top=3, block=block, share=share))
    assert got == plain(rows, 4, 3)
    assert ("yy", "e", "pair", "f") in got and got["yy", "e", "pair", "f"] == (0, 1)


def test_hot_source_and_empty_table(spark):
    schema = "lang string, source string, text string"
    rows = [("en", "hot", "the same words again")] * 400 + [("en", f"s{k % 7}", f"the words {'xyz'[k % 3]}") for k in range(200)]
    assert found(S.audit_sources(spark.createDataFrame(rows, schema))) == plain(rows, 10, 10)
    assert S.audit_sources(spark.createDataFrame([], schema)).count() == 0


def test_counts_beyond_64_bits_stay_exact(spark):
    n, total, terms = 9 * 10**15, 10**18, 10**6
    df = spark.createDataFrame([(n, total, terms)], "n bigint, total bigint, terms bigint")
    from pyspark.sql import functions as F

    got = df.select(S.frequency(F.col("n"), F.col("total"), F.col("terms"))).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * terms)
