"""Streamed near-duplicate check: within a batch, over batches, repeated batches, compaction."""

import math
import random

import pytest

from vitrine.streaming import duplicates as sd


def at(degrees):
    return [math.cos(math.radians(degrees)), math.sin(math.radians(degrees)), 0.0]


def frame(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in rows], "id BIGINT, embedding ARRAY<DOUBLE>")


def brute(stored, batch, t):
    """One listing after the other, by id."""
    known, hits = list(stored), {}
    for i, v in sorted(batch):
        found = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in known if j != i]
        best = min(found, default=(0, None))
        if -best[0] >= t:
            hits[i] = (best[1], round(-best[0], 9))
        else:
            known.append((i, v))
    return hits, {i for i, _ in known}


def run(spark, folder, batches, t=0.95):
    hits = {}
    for n, rows in enumerate(batches):
        for r in sd.check_batch(frame(spark, rows), folder, n, t).collect():
            hits[r.new_id] = (r.existing_id, round(r.similarity, 9))
    store = sd.read_store(spark, folder)
    return hits, {i for r in store.select("r_ids").collect() for i in r.r_ids}


def test_two_equal_listings_in_one_batch_give_one_hit(spark, tmp_path):
    hits, kept = run(spark, str(tmp_path), [[(1, at(0)), (2, at(0)), (3, at(90))]])
    assert hits == {2: (1, 1.0)} and kept == {1, 3}


def test_chains_and_batches(spark, tmp_path):
    rng = random.Random(3)
    old = [(i, at(rng.uniform(0, 360))) for i in range(6)]
    new = [(100 + i, at(rng.uniform(0, 360))) for i in range(50)] + [(200 + i, at(10 * i)) for i in range(20)]  # a chain of steps below the limit
    want = brute(old, new, 0.95)
    for k, cuts in enumerate([[len(new)], [20, 50, len(new)]]):
        folder = str(tmp_path / str(k))
        sd.append(frame(spark, old), folder, sd.INITIAL, block_rows=3)
        batches = [sorted(new)[a:b] for a, b in zip([0, *cuts], cuts)]
        assert run(spark, folder, batches) == want


@pytest.mark.parametrize("limit", [sd.BROADCAST_BYTES, 0])
def test_nearest_stored_either_way(spark, tmp_path, limit):
    rng = random.Random(5)
    old, new = ([(i + base, at(rng.uniform(0, 360))) for i in range(40)] for base in (0, 100))
    sd.append(frame(spark, old), str(tmp_path), sd.INITIAL, block_rows=7)
    got = {r.id: (r.existing_id, round(r.similarity, 9)) for r in sd.nearest_stored(frame(spark, new), sd.read_store(spark, str(tmp_path)), limit, 11).collect()}
    best = {i: max((sum(a * b for a, b in zip(v, w)), -j) for j, w in old) for i, v in new}
    assert got == {i: (-j, round(s, 9)) for i, (s, j) in best.items()}


def test_repeated_batches_and_compaction(spark, tmp_path):
    folder = str(tmp_path)
    first = [(1, at(0)), (2, at(30))]
    assert run(spark, folder, [first])[1] == {1, 2}
    assert sd.check_batch(frame(spark, first), folder, 0, 0.95).count() == 0  # run again: it does not meet itself
    sd.check_batch(frame(spark, [(3, at(60)), (4, at(1))]), folder, 1, 0.95).collect()
    sd.compact(spark, folder, 1)
    assert sd.versions(spark, folder) == ["base=1"] and sd.versions(spark, folder, 1) == ["epoch=0"]
    assert sorted(i for r in sd.read_store(spark, folder).collect() for i in r.r_ids) == [1, 2, 3]
    hits = {r.new_id: r.existing_id for r in sd.check_batch(frame(spark, [(9, at(61))]), folder, 2, 0.95).collect()}
    assert hits == {9: 3}


def test_awkward_rows(spark, tmp_path):
    rows = [(1, None), (None, at(0)), (2, [0.0, 0.0, 0.0]), (3, at(0)), (3, at(90)), (4, at(0)), (5, at(90))]
    hits, kept = run(spark, str(tmp_path), [rows, []])
    assert kept in ({3, 4}, {3, 5}) and len(hits) == 1
