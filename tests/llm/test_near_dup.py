import itertools
import math
import random
import re

import numpy as np
import pytest

from postgauge.llm import near_dup as N
from postgauge.llm.queries import QUERIES


def plain_shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5))))


def expected(docs, percent):
    """All pairs compared, links followed; doc_ids are unique and not null."""
    sets = {d: plain_shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        one, two = sets[a], sets[b]
        if one and two and 100 * min(len(one), len(two)) >= percent * max(len(one), len(two)):
            if 100 * len(one & two) >= percent * len(one | two):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in sets)


def test_query_equals_all_pairs(spark, rows):
    folder = "/root/testdata/sf0.01"
    got = sorted(tuple(r) for r in QUERIES["op2_near_duplicates"](spark, folder).collect())
    assert got == expected([(r["doc_id"], r["text"]) for r in rows("documents", folder)], 85)


@pytest.mark.parametrize("percent", [80, 85])
def test_families_of_edited_copies(spark, percent, monkeypatch):
    """Copies near the threshold, chains, and short texts; short and long lists both."""
    monkeypatch.setattr(N, "SHORT_LIST", 8)
    monkeypatch.setattr(N, "BLOCK", 16)
    rng, docs = random.Random(percent), []
    for size, copies in ((6, 10), (12, 25), (18, 25), (60, 70), (150, 60), (400, 15)):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, max(1, size // 60), max(1, size // 40)])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            docs.append(" ".join(words))
            if rng.random() < 0.2:  # drifts away step by step
                base = words
    rng.shuffle(docs)
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    got = sorted(tuple(r) for r in N.near_duplicates(table, percent).collect())
    assert got == expected(list(enumerate(docs)), percent)


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_similar_small_sets_share_a_key(percent):
    """All sizes at which sketches hold whole sets, differences placed evenly and at random."""
    rng = random.Random(percent)
    for both, one, two in itertools.product(range(1, 52), range(4), range(4)):
        apart = one + two
        if not apart or 100 * both < percent * (both + apart):
            continue
        for trial in range(4):
            values = np.sort(np.random.default_rng(trial).choice(2**60, both + apart, replace=False).astype(np.uint64))
            if trial:
                odd = rng.sample(range(both + apart), apart)
            else:  # the runs between differences as short as can be
                odd = [(k + 1) * (both + apart + 1) // (apart + 1) - 1 for k in range(apart)]
            a = np.delete(values, odd[:one])
            b = np.delete(values, odd[one:])
            found = [set(N.run_keys(x, N.run_widths(len(x), percent)).tolist()) for x in (a, b)]
            assert found[0] & found[1], (both, one, two)


def test_short_texts_at_the_threshold(spark):
    """Four of five shingles in both, and five of six."""
    words = [f"w{k}" for k in range(30)]
    docs = [words[:8], words[:9], words[10:19], words[10:20], words[20:27], words[20:28]]
    table = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id bigint, text string")
    rows = [(k, " ".join(d)) for k, d in enumerate(docs)]
    for percent in (80, 85):
        assert sorted(tuple(r) for r in N.near_duplicates(table, percent).collect()) == expected(rows, percent)
    assert sorted(r.component_id for r in N.near_duplicates(table, 80).collect()) == [0, 0, 2, 2, 4, 5]
    with pytest.raises(ValueError, match="percent"):
        N.near_duplicates(table, 50)


def test_odd_texts(spark, odd):
    got = N.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert (by_id[0].n_shingles, by_id[0].component_id, by_id[0].kept) == (0, 0, True)
    assert by_id[1].component_id == 1 and by_id[2].component_id == 2
    assert by_id[5].component_id == 4 and not by_id[5].kept
    assert (by_id[None].component_id, by_id[None].kept) == (None, True)
    kept = N.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 4, 6, 7, 8, 9, 10]
    assert N.near_duplicates(odd.limit(0)).collect() == []


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 240)] + [(300, 300), (5, 239)]
    rng.shuffle(links)
    got = {r.node: r.component for r in N.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {k: 100 for k in range(100, 161)} | {k: 5 for k in [5, 7, *range(200, 240)]}
    assert got == want


def test_estimate_of_small_sets_is_exact():
    a, b = np.arange(0, 40, dtype=np.uint64), np.arange(10, 50, dtype=np.uint64)
    assert N.estimate(a, b) == (30 / 50, 50)


@pytest.mark.parametrize("percent", [80, 85])
def test_estimate_loses_no_more_than_keys_do(percent):
    s, n = percent / 100, N.KEPT
    low = (k for k in range(n + 1) if k / n < N.least_estimate(s, n))
    assert sum(math.comb(n, k) * s**k * (1 - s) ** (n - k) for k in low) < 4e-10
