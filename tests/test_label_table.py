"""Merges of a label table: the last edit wins, other buckets stay, JSON types too."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postgauge.operators import annotate
from postgauge.operators.label_table import LabelTable

EDIT = "Id bigint, ts bigint, event_id bigint, key string, value string"
TYPED = '{"n":1,"x":2.5,"t":"1","o":{"c":[1,"2",null]},"yes":true,"none":null}'


def edits(spark, *rows):
    return spark.createDataFrame(list(rows), EDIT)


def stores(table, **kw):
    return {r[0]: json.loads(r[1]) for r in table.stores(**kw).collect()}


def files(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_merges_touch_their_buckets_alone(spark, tmp_path):
    table = LabelTable(spark, str(tmp_path), buckets=8)
    assert table.version() == 0 and table.manifest() == {}
    with pytest.raises(ValueError):
        table.labels()
    assert table.merge(edits(spark, *[(k, 5, k, "Topic", f"t{k}") for k in range(60)])) == 1
    first, before = table.manifest(), files(tmp_path)
    late = [(3, 4, 900, "Topic", "older"), (3, 6, 901, "Kind", 'q"\\'), (3, 5, 1, "Topic", "older id")]
    assert table.merge(edits(spark, *late)) == 2
    second = table.manifest()
    assert len(first) > 4 and sum(first[b] != second[b] for b in first) == 1
    assert {p: t for p, t in files(tmp_path).items() if p in before} == before
    assert stores(table)[3] == {"Topic": "t3", "Kind": 'q"\\'} and stores(table, version=1)[3] == {"Topic": "t3"}
    seen = stores(table)
    assert table.merge(edits(spark, *late)) == 3 and stores(table) == seen  # merged twice
    assert table.merge(edits(spark, (3, 9, 9, " ", "x"), (3, 9, 9, "Topic", ""), (None, 9, 9, "Topic", "x"), (3, 9, 9, None, "x"))) == 3
    again = LabelTable(spark, str(tmp_path), buckets=8)
    assert again.version() == 3 and stores(again) == seen and len(seen) == 60
    with pytest.raises(ValueError, match="buckets"):
        LabelTable(spark, str(tmp_path), buckets=2).labels()


def test_a_merge_cut_short_is_not_seen(spark, tmp_path, monkeypatch):
    table = LabelTable(spark, str(tmp_path), buckets=4)
    table.merge(edits(spark, (1, 1, 1, "a", "x")))
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a: 1 / 0)
        cut = spark.sql("select 1L Id, 2L ts, 2L event_id, 'a' key, 'y' value")
        with pytest.raises(ZeroDivisionError):
            table.merge(cut)
    assert stores(table) == {1: {"a": "x"}} and table.version() == 1
    assert table.merge(cut) == 2 and stores(table) == {1: {"a": "y"}}


def test_json_types_stay(spark, tmp_path):
    df = spark.createDataFrame([(1, TYPED), (2, "{broken"), (3, None), (4, '{"a":{"x":1,"x":2},"b":"c"}'), (None, '{"a":1}')], "Id bigint, label_store string")
    fresh = edits(spark, (1, 1, 1, "t", "2"), (2, 1, 2, "a", "b"), (4, 1, 3, "z", "1"))
    wanted = json.loads(TYPED) | {"t": "2"}
    merged = {r["Id"]: r["label_store"] for r in annotate.apply_labels(df, fresh).collect()}
    assert json.loads(merged[1]) == wanted and json.loads(merged[2]) == {"a": "b"} and merged[3] == "{}" and merged[None] == '{"a":1}'
    assert json.loads(merged[4])["b"] == "c" and json.loads(merged[4])["z"] == "1"
    table = LabelTable(spark, str(tmp_path), buckets=4)
    table.add_stores(df)
    table.merge(fresh)
    got = stores(table)
    assert got[1] == wanted and got[2] == {"a": "b"} and got[4]["b"] == "c" and set(got) == {1, 2, 4}
    table.add_stores(df.withColumn("label_store", F.lit('{"t":"old","new":0}')))
    assert stores(table)[1]["t"] == "2" and stores(table)[1]["new"] == 0  # edits are newer than any store
