"""Readers of keyword files, and sinks."""

import pytest

from recordloom.operators import merge
from recordloom.sources import landing


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def terms(df):
    return sorted(r["term"] for r in df.collect())


def test_keyword_lines(spark, tmp_path):
    assert terms(landing.keyword_lines(spark, write(tmp_path, "k.txt", "# note\nAbc \n\n #kept\n"))) == ["#kept", "abc"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Drug Name,Aliases\nFoo,a|B\nBar,-\n", ["a", "b", "bar", "foo"]),
        ("x,Keyword\n1,Foo\n2,nan\n", ["foo"]),
        ("anything,other\nFoo,1\n", ["foo"]),
    ],
)
def test_keyword_table(spark, tmp_path, text, want):
    assert terms(landing.keyword_table(spark, write(tmp_path, "k.csv", text))) == want


def test_id_column(spark, tmp_path):
    got = landing.id_column(spark, write(tmp_path, "i.csv", "nct\n NCT1 \n\"\"\nNCT2\n"), "nct")
    assert sorted(r["id"] for r in got.collect()) == ["NCT1", "NCT2"]


def test_csv_sink_does_not_overwrite(spark, tmp_path):
    df = spark.range(3)
    landing.write_csv(df, str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exist"):
        landing.write_csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3


def test_merged_table_goes_to_a_new_path(spark, tmp_path):
    merge.overwrite(spark.range(2), str(tmp_path / "v1"))
    assert spark.read.parquet(str(tmp_path / "v1")).count() == 2


def test_merge_writes_only_buckets_that_change(spark, tmp_path):
    path = str(tmp_path / "t")
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").glob("bucket=*/*.parquet")}
    counts = lambda rows, n: tuple(merge.merge_into(spark.createDataFrame(rows, "id int, v string"), path, str(tmp_path / f"s{n}"), ["id"], 8).first())
    merge.write_bucketed(spark.createDataFrame([(i, "a" if i % 2 else None) for i in range(100)], "id long, v string"), path, ["id"], 8)
    before = files()
    assert len(before) == 8
    assert counts([(1, "a"), (2, None)], 0) == (0, 0, 2) and files() == before
    assert counts([(1, "b"), (2, None)], 1) == (0, 1, 1)
    assert len(before.keys() - files().keys()) == 1  # one bucket is new, seven have their files
    assert counts([(1, "b"), (500, None)], 2) == (1, 0, 1) and counts([], 3) == (0, 0, 0)
    rows = {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert len(rows) == 101 and rows[1] == "b" and rows[3] == "a" and rows[500] is None
