"""Quoted cells with line breaks, in files of many splits, against Python's own reader."""

import csv
import io
import random

import pytest
from conftest import bag

from helixmart.sources import catalog, quoted, tsv


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "8", "spark.sql.files.minPartitionNum": "30"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def cell(rng):
    text = "".join(rng.choice(["a", "bé", '"', "\n", "\t", " ", "x\ny", '""', "long " * 9]) for _ in range(rng.randrange(1, 6))).strip()
    if not text:
        return "w", "w"
    if any(c in text for c in '"\n\t') or rng.random() < 0.2:
        return text, '"' + text.replace('"', '""') + '"'
    return text, text


def table_text(rng, n, end="\n"):
    rows = [[cell(rng) for _ in range(3)] for _ in range(n)]
    return [[c[0] for c in r] for r in rows], "x\ty\tz" + end + "".join("\t".join(c[1] for c in r) + end for r in rows)


@pytest.mark.parametrize("seed", range(2))
def test_breaks_equal_a_sequential_reader(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    expected = []
    for name in "ab":
        rows, text = table_text(rng, 60, "\r\n" if name == "b" else "\n")
        write(tmp_path / f"{name} {seed}.tsv", text)
        assert [r for r in csv.reader(io.StringIO(text, newline=""), delimiter="\t")][1:] == rows
        expected += rows
    write(tmp_path / "c.tsv", 'x\tz\ty\n1\t"2 ""q"" 2"\t3\n')
    found = tsv.read_tsv_files(catalog.discover_files(spark, str(tmp_path)), with_file=True, with_order=True)
    assert bag(found.select("x", "y", "z")) == sorted([*map(tuple, expected), ("1", "3", '2 "q" 2')], key=repr)
    assert found.rdd.getNumPartitions() > 10
    # The order column sorts the rows of a file as they stand there.
    mine = found.where(f"_file like 'a%{seed}.tsv'").orderBy(tsv.ORDER).select("x", "y", "z").collect()
    assert [list(r) for r in mine] == expected[:60]


def test_a_record_may_span_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i} of a very long cell" for i in range(200))
    path = write(tmp_path / "a.tsv", f'x\ty\n1\t"{long}"\n2\tb\n\n"3"\t"c\n"\n4\t"d""\n"""\n')
    assert bag(tsv.read_tsv(spark, [path], "x\ty")) == sorted([("1", long), ("2", "b"), ("3", "c\n"), ("4", 'd"\n"')])


def test_only_files_with_breaks_are_read_the_long_way(spark, tmp_path):
    plain = write(tmp_path / "a.tsv", 'x\ty\n"1 ""a"""\t2\nb"c\t"d"e\n')
    broken = write(tmp_path / "b.tsv", 'x\ty\n1\t"2\n3"\n')
    assert [p.rsplit("/", 1)[1] for p in quoted.files_with_breaks(spark, [plain, broken])] == ["b.tsv"]
    got = tsv.read_tsv(spark, [str(tmp_path)], "x\ty")
    assert ("1", "2\n3") in bag(got) and got.count() == 3
    # Spark's own one-task reader says the same.
    assert bag(got) == bag(tsv.read_tsv(spark, [str(tmp_path)], "x\ty", multi_line=True))


def test_short_long_and_blank_records(spark, tmp_path):
    path = write(tmp_path / "a.tsv", 'x\ty\tx\n"a\nb"\n\n\t"c\n"\tlast\textra\n1\t2\t3\n')
    assert bag(tsv.read_tsv(spark, [path], "x\ty\tx").select("x", "y")) == sorted([(None, None), ("last", "c\n"), ("3", "2")], key=repr)


def test_unbalanced_quotes_name_the_file(spark, tmp_path):
    write(tmp_path / "good.tsv", 'x\ty\n1\t"2\n3"\n')
    write(tmp_path / "bad.tsv", 'x\ty\n1\t"2\n3\n')
    with pytest.raises(ValueError, match="bad.tsv"):
        tsv.read_tsv(spark, [str(tmp_path)], "x\ty")


def test_header_only_and_no_rows(spark, tmp_path):
    path = write(tmp_path / "a.tsv", "x\ty\n")
    assert tsv.read_tsv(spark, [path], "x\ty").collect() == []
    assert quoted.records(spark, [path]).collect() == []
