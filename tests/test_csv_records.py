"""The reader by records equals Spark's reader of whole files."""

import random
import warnings

import pytest

from kredo.sources import csv_records, loaders


def _same(spark, path, warn=None):
    if warn:
        with pytest.warns(UserWarning, match=warn):
            got = csv_records.read_csv(spark, path, loaders.CSV_OPTIONS, longest=1000)
    else:
        with warnings.catch_warnings():
            warnings.simplefilter("error", UserWarning)
            got = csv_records.read_csv(spark, path, loaders.CSV_OPTIONS, longest=1000)
    want = spark.read.options(**loaders.CSV_OPTIONS).csv(path)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    return got


def _write(path, text):
    path.write_bytes(text.encode("iso-8859-1"))
    return str(path)


AWKWARD = [
    'a,b,c\n1,2,3\n',
    'a,b,c\n',
    'a,"b\nb",c\n1,"x\ny","z ""q"", \\"\n',
    'a,b,c\r\n1,"Société\r\nanonyme",\r\n\r\n"","",2\r\n',
    '\n\na,b,c\n"1\n\n\n2",,"\n"\n\n4\n5,6,7,8,9\n , ,\n"""",",",""""""',
    'a,b,c\n"x","y","no end of line"',
    'a,b,c\n1,2,3\n4,5,6\r\n7,"8\r\n8",9\n',
]


@pytest.mark.parametrize("text", AWKWARD)
def test_awkward_files(spark, tmp_path, text):
    _same(spark, _write(tmp_path / "x.csv", text))


@pytest.mark.parametrize("text, warn", [
    ('a,b\n1,5" pipe\n2,"x"\n', "plain field"),
    ('a,b\n1,5" pipe\n2,"x\ny" \n', "plain field"),
    ('a,b\n1,2\n3,"never closed\n4,5\n', "plain field"),
    ('a,b\r1,2\r3,"4\n5"\r', "carriage return alone"),
    ('a,b\n1,"' + "long\n" * 300 + '"\n', "longer than 1000"),
])
def test_files_that_break_the_rule_are_read_whole(spark, tmp_path, text, warn):
    _same(spark, _write(tmp_path / "x.csv", text), warn)


def test_one_file_is_many_tasks_and_a_folder_many_headers(spark, tmp_path):
    draw = random.Random(5)
    pieces = ["plain", '"quoted, comma"', '"two\nlines"', '"a ""b"" c"', "", '""', '"\n\n"', '"é\r\nè"']
    folder = tmp_path / "big"
    folder.mkdir()
    for name, n in (("one", 3000), ("two", 40)):
        body = "".join(f"{k}," + ",".join(draw.choice(pieces) for _ in range(3)) + "\n" for k in range(n))
        _write(folder / f"{name}.csv", "id,p,q,r\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert csv_records._lines(spark, str(folder), "ISO-8859-1").rdd.getNumPartitions() > 10
        got = _same(spark, str(folder))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got.count() == 3040


def test_pieces_grow_with_the_file(spark, tmp_path, monkeypatch):
    """Lines are sorted in more pieces where a file has more splits, and first rows are found without a sort of the lines."""
    seen = []
    plain = csv_records.running_total
    monkeypatch.setattr(csv_records, "running_total", lambda *a, **k: (seen.append(a[5]), plain(*a, **k))[1])
    path = _write(tmp_path / "x.csv", "a,b\n" + '1,"x\ny"\n' * 3000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        splits = csv_records._lines(spark, path, "ISO-8859-1").rdd.getNumPartitions()
        got = _same(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got.count() == 3000
    assert splits > 10 and seen == [csv_records.PIECES * splits] * 2
    lines = csv_records._lines(spark, path, "ISO-8859-1")
    firsts = csv_records._first_places(lines)
    plan = firsts._sc._jvm.PythonSQLUtils.explainString(firsts._jdf.queryExecution(), "simple")
    assert "HashAggregate" in plan and "line" not in plan.split("HashAggregate")[0]
