import hashlib
import re

import pytest

from postgauge.llm import decontaminate as D
from postgauge.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, width=10):
    """Every window of every item looked up at every place of every document."""
    windows = {}
    for item, text in items:
        w = plain_words(text)
        n = min(width, len(w))
        for b in range(len(w) - n + 1 if n and item is not None else 0):
            windows.setdefault(tuple(w[b : b + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in lengths:
            for b in range(len(w) - n + 1):
                names = windows.get(tuple(w[b : b + n]))
                if names:
                    hit |= set(range(b, b + n))
                    found |= names
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0, row[1:])


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_plain_search(spark, rows, folder):
    folder = f"/root/testdata/{folder}"
    got = [tuple(r) for r in QUERIES["op9_benchmark_contamination"](spark, folder).orderBy("doc_id").collect()]
    docs = [(r["doc_id"], r["text"]) for r in rows("documents", folder)]
    items = [(r["item_id"], r["text"]) for r in rows("benchmark", folder)]
    sha = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in expected(docs, items)]
    assert got == sorted(sha)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_odd_items_and_texts(spark, odd):
    items = [
        (1, "One!"),
        (2, None),
        (3, "..."),
        (None, "long words"),
        (5, "again and again"),
        (6, "a b " * 9),
        (7, "A-B " * 9),
        (8, "Straße σίσυφος"),
        (9, "long words " * 30),
        (10, "and again"),
        (5, "again and again"),
    ]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    more = spark.createDataFrame([(50, "a a b a b a b a b a b a b c", 0), (51, "x long WORDS", 0)], odd.schema)
    docs = odd.unionByName(more)
    want = sorted(expected([(r.doc_id, r.text) for r in docs.collect()], items), key=key)
    for per_file in (100, 2):  # one pattern file, and several
        found = D.find_contamination(docs, table, rows_per_file=per_file)
        got = [(r.row.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()]
        assert sorted(got, key=key) == want


def test_empty_tables(spark, odd):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert D.remove_contaminated(odd, items).count() == odd.count()
    assert D.remove_contaminated(odd.limit(0), items).collect() == []


def test_kept_documents_keep_their_columns(spark, odd):
    items = spark.createDataFrame([(1, "again and again and again")], "item_id bigint, text string")
    kept = D.remove_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == odd.count() - 3
