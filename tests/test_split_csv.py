"""CSV read in byte ranges against Spark's multi-line reader and Python's csv module."""

import csv
import io as stdio
import os
import random

import pytest

from vitrine.sources import catalog_io as io
from vitrine.sources import split_csv


def written(folder, files):
    for name, data in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
            f.write(data)
    return str(folder)


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "61", "spark.sql.files.openCostInBytes": "20", "spark.sql.files.minPartitionNum": "64"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def random_csv(seed, rows=60, end="\n"):
    rng = random.Random(seed)
    out = stdio.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "name", "u"])
    for i in range(rows):
        name = "".join(rng.choice(["a", "é日", '"', ",", "\n", " ", "word", "\n\n", '""', "x" * 30]) for _ in range(rng.randint(0, 9)))
        w.writerow([i + 1, name, "y"][: rng.choice([3, 3, 3, 2])] + ["extra"] * rng.choice([0, 0, 0, 0, 1, 3]))
        if rng.random() < 0.1:
            out.write(end)
    return out.getvalue()


def rows(df):
    return sorted(tuple(r) for r in df.select("src_pos", "id", "name", "u").collect())


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_same_rows_and_positions_as_one_split(spark, tmp_path, tiny_splits, seed, end):
    path = written(tmp_path, {"a.csv": random_csv(seed, end=end), "b.csv": random_csv(seed + 100, 25, end)})
    whole = rows(io.read_catalog_csv(spark, path, splittable=False))
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    assert rows(io.read_catalog_csv(spark, path)) == whole and len(whole) > 50


def test_records_equal_the_csv_module(spark, tmp_path, tiny_splits):
    data = random_csv(7, 80)
    path = written(tmp_path, {"a.csv": data})
    want = [r for r in csv.reader(stdio.StringIO(data)) if r]
    for bound in (split_csv.BROADCAST_SPLITS, 0):  # both ways of giving the lines their split's start
        got = split_csv.read_records(spark, path, bound).orderBy("record").collect()
        assert [r["record"] for r in got] == list(range(len(want)))
        assert [next(csv.reader(stdio.StringIO(r["text"]))) for r in got] == want


def test_quotes_inside_unquoted_fields(spark, tmp_path, tiny_splits):
    data = 'id,name,u\n' + "".join(f'{i},5" pipe {i},"a\nb ""c"" {i}"\n{i + 100},"x" tail,z\n' for i in range(30))
    path = written(tmp_path, {"a.csv": data})
    whole = rows(io.read_catalog_csv(spark, path, splittable=False))
    assert rows(io.read_catalog_csv(spark, path)) == whole and len(whole) == 60


def test_every_cut_of_a_text():
    """The two-valued functions compose to the same records wherever the lines are cut."""
    lines = 'h,i\n1,"a\nb"\n\n2,""\n3,"x ""y\n"" z",w\n4," \n\n,"\n5,q"r\n'.split("\n")[:-1]
    whole = list(split_csv.records(lines, False, 0))
    for cuts in [(a, b) for a in range(len(lines) + 1) for b in range(a, len(lines) + 1)]:
        parts = [lines[: cuts[0]], lines[cuts[0]: cuts[1]], lines[cuts[1]:]]
        inside, first, texts = False, 0, {}
        for p in parts:
            for number, _, text in split_csv.records(p, inside, first):
                texts.setdefault(number, []).append(text)
            s = split_csv.summarise(p)
            first, inside = first + s[3 if inside else 1], s[2 if inside else 0]
        assert {n: "\n".join(t) for n, t in texts.items()} == {n: t for n, _, t in whole}


def test_open_quote_at_the_end_and_empty_files(spark, tmp_path, tiny_splits):
    path = written(tmp_path, {"a.csv": 'id,name,u\n1,"open\n2,b\n', "b.csv": "id,name,u\n", "c.csv": ""})
    got = io.read_catalog_csv(spark, path).collect()
    assert [(r["id"], r["u"]) for r in got] == [("1", None)]
    assert got[0]["name"].startswith("open\n2,b") or got[0]["name"].startswith('"open\n2,b')
