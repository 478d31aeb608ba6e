import csv
import io
import random

import pytest

from postgauge.sources import csv_records, post_files


def written(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


def some_rows(seed, n):
    rng = random.Random(seed)
    words = ["a", "ü", '"', '""', "\n", "\n\n", ",", " ", "x" * 40, '"\n', "日", ""]
    return [(str(k), "1", "".join(rng.choices(words, k=rng.randrange(8))), str(rng.randrange(9))) for k in range(n)]


@pytest.fixture
def small_blocks(spark):
    """Files are cut every few bytes, so records cross any number of blocks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, v) for n, v in zip(names, (str(size), "1"))]
    for n, v in old.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [61, 200, 1000])
def test_records_are_those_of_a_plain_reader(spark, tmp_path, small_blocks, size):
    header, expected = ["Id", "PostTypeId", "Body", "Score"], []
    for file, n in enumerate((60, 1, 25)):
        rows = some_rows(file, n)
        expected += rows
        (tmp_path / f"p{file}.csv").write_text(written([header, *rows]))
    (tmp_path / "empty.csv").write_text("")
    small_blocks(size)
    df = post_files.read_posts_csv(spark, str(tmp_path), header)
    got = {(r["Id"], r["Body"], r["Score"]) for r in df.collect()}
    assert got == {(int(i), body or None, int(score)) for i, _, body, score in expected}
    assert df.count() == len(expected)
    tasks = csv_records._lines(spark, str(tmp_path)).rdd.getNumPartitions()
    assert tasks > 4


def test_a_record_longer_than_many_blocks(spark, tmp_path, small_blocks):
    body = "line\n" * 400 + 'end "quoted"'
    (tmp_path / "p.csv").write_text(written([["Id", "Body"], ("1", "before"), ("2", body), ("3", "after\nit")]))
    small_blocks(100)
    got = {r["Id"]: r["Body"] for r in post_files.read_posts_csv(spark, str(tmp_path / "p.csv"), ["Id", "Body"]).collect()}
    assert got == {1: "before", 2: body, 3: "after\nit"}


def test_carriage_returns_blank_lines_and_no_last_line_end(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes(b'Id,Body\r\n1,"a\r\nb"\r\n\r\n2,c\r\n3,"d"')
    whole, split = (
        {(r["Id"], r["Body"]) for r in post_files.read_posts_csv(spark, str(tmp_path), ["Id", "Body"], split=s).collect()} for s in (False, True)
    )
    assert {i for i, _ in split} == {1, 2, 3} and dict(split)[2] == "c" and dict(split)[3] == "d"
    assert {i: b.replace("\r", "") for i, b in split} == {i: b.replace("\r", "") for i, b in whole}
