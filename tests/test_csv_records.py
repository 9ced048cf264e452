import random

import pytest
from pyspark.sql import functions as F

from reviewgrain.operators.scaling import scratch_path, store
from reviewgrain.sources import csv_records, files


def written(tmp_path, text, name="a.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


@pytest.fixture
def ranges_of(spark):
    """Sets how many bytes a range has."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield set_to
    for k, v in old.items():
        spark.conf.set(k, v)


def own(spark, path, **more):
    return csv_records.read(spark, path, lambda rows: store(rows, "ranges"), **more)


def spark_reader(spark, path):
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_states_of_lines():
    cases = [
        ("a,b", False, False), ("a,b", True, True), ('"a', False, True), ('a"', True, False), ('a""', True, True), ('a"",b', True, True), ('a",b', True, False),
        ('a",  "b', True, False), ('a","b', True, True), ('5" wide,b', False, False), ('5",b,"c', False, True), ('""', False, False), ('""""', False, False), ('"""', False, True), ("", True, True), ("", False, False),
        ('"a"x"b,c', False, False), ('"a"x,"b', False, True),
    ]
    for line, inside, want in cases:
        assert csv_records.ends_inside(line, inside) == want, line


@pytest.mark.parametrize("seed", range(4))
def test_same_rows_as_the_multi_line_reader(spark, tmp_path, ranges_of, seed):
    rng = random.Random(seed)
    pieces = ["x", "word ", "\n", "\n\n", '""', ",", "é", "\r\n" if seed % 2 else "\n", "long text " * 3]
    end = "\r\n" if seed % 4 == 3 else "\n"

    def field():
        kind = rng.random()
        if kind < 0.45:
            return '"' + "".join(rng.choices(pieces, k=rng.randrange(12))) + '"'
        return "".join(rng.choices(["a", "b ", '5" z', "'"], k=rng.randrange(1, 4))) if kind < 0.9 else ""

    lines = ["id,text one,note"] + [f"{i},{field()},{field()}" for i in range(60)]
    path = written(tmp_path, end.join(lines) + (end if seed % 4 else ""))
    want = rows(spark_reader(spark, path))
    for size in (150, 1 << 20):
        ranges_of(size)
        got = own(spark, path, position="at")
        assert rows(got.drop("at")) == want
        if size == 150:
            assert csv_records._lines(spark, path).rdd.getNumPartitions() > 10
            assert [r.id for r in got.orderBy("at").collect()] == [str(i) for i in range(60)]


def test_records_longer_than_many_ranges_and_several_files(spark, tmp_path, ranges_of):
    ranges_of(300)
    long = "\n".join(f'line {i}, with ""quotes""' for i in range(100))
    written(tmp_path, f'"head\nline",b\n1,"{long}"\n2,x\n"3","{long}\n"\n')
    written(tmp_path, '"head\nline",b\n\n\n4,"y\nz"\n5,""\n6,\n', "b.csv")
    got = own(spark, str(tmp_path))
    assert got.columns == ["head\nline", "b"] and rows(got) == rows(spark_reader(spark, str(tmp_path)))
    assert got.where(F.length("b") > 1000).count() == 2


def test_few_and_no_rows(spark, tmp_path, ranges_of):
    ranges_of(10)
    assert own(spark, written(tmp_path, "a,b\n")).count() == 0
    path = written(tmp_path, 'a,b\n1,"unclosed\nquote', "b.csv")
    assert rows(own(spark, path)) == rows(spark_reader(spark, path))
    ragged = written(tmp_path, "a,b\n1\n1,2,3\n\n , \n", "c.csv")
    assert rows(own(spark, ragged)) == rows(spark_reader(spark, ragged))


def test_endless_records_raise(spark, tmp_path, monkeypatch, ranges_of):
    path = written(tmp_path, 'a,b\n1,"unclosed\n' + "text\n" * 100)
    monkeypatch.setattr(csv_records, "LONGEST", 50)
    with pytest.raises(Exception, match="too long|longer than"):
        own(spark, path).collect()
    ranges_of(200)
    with pytest.raises(Exception, match="too long"):
        own(spark, path).collect()


def test_normalised_names(spark, tmp_path):
    path = written(tmp_path, 'Review Text,uniq _id\n"a\nb",1\n')
    assert rows(files.read_csv(spark, path)) == [("a\nb", "1")] and "review_text" in files.read_csv(spark, path).columns
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_the_window_over_a_file_holds_no_texts(spark, tmp_path, ranges_of):
    ranges_of(40)
    path = written(tmp_path, "a,b\n" + "".join(f'{i},"{"x" * 30}\n{"y" * 30}"\n' for i in range(20)))
    reports = store(csv_records.reported(csv_records._lines(spark, path)))
    found = csv_records.crossing_records(reports, store(csv_records.composed(reports)))

    def nodes(plan):
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    windows = [n for n in nodes(found._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Window"]
    columns = {n.output().apply(i).name() for n in windows for i in range(n.output().size())}
    assert windows and not columns & {"head", "tail"}
    assert own(spark, path).count() == 20
