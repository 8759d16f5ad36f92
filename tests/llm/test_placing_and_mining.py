"""Shards and hard negatives against brute force."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelhouse.llm import hard_negatives as mining
from parcelhouse.llm.hard_negatives import hard_negatives, hilbert_key
from parcelhouse.llm.sharding import (
    Permutation, assign_shards, op13_sharding, place, row_at, write_shards)
from parcelhouse.session import scratch_dir

ODD = [
    (1, "a"), (1, "a"), (1, "b"), (None, "x"), (None, None), (7, None), (8, ""), (9, "Été"),
    (10, "x " * 300_000), *[(20, "same")] * 40, *[(i, "same") for i in range(30, 60)],
]


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 16, 17, 63, 64, 65, 1000, 4099])
def test_permutation_is_one_to_one(rows):
    permutation = Permutation(rows)
    there = permutation.forth(np.arange(rows))
    assert sorted(there.tolist()) == list(range(rows))
    assert (permutation.back(there) == np.arange(rows)).all()


def test_permutation_depends_on_the_seed_and_scatters_neighbours():
    one, other = (Permutation(10_000, seed).forth(np.arange(10_000)) for seed in (1, 2))
    assert (one == other).mean() < 0.01
    near = np.abs(np.diff(one)) < 100
    assert near.mean() < 0.05
    assert abs(np.corrcoef(one, np.arange(10_000))[0, 1]) < 0.05


def test_large_row_numbers():
    rows = 10**12 + 39
    numbers = np.array([0, 1, 2**32, 10**12, rows - 1])
    shard, slot = place(numbers, rows)
    assert (slot * 40 + shard < rows).all() and len(set(slot.tolist())) == 5
    assert (row_at(shard, slot, rows) == numbers).all()


def expected_shards(rows, shards):
    keys = sorted(
        ((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in rows))
    shard, slot = place(np.arange(len(keys)), len(keys), shards)
    return sorted((k[1] if k[0] else -1, k[3], k[2], n, int(s), int(o))
                  for n, (k, s, o) in enumerate(zip(keys, shard, slot)))


@pytest.mark.parametrize("rows_per_task", [1_000_000, 7])
@pytest.mark.parametrize("partitions", [1, 9])
def test_shards_equal_brute_force_however_rows_lie(documents, rows_per_task, partitions):
    docs = documents(ODD).repartition(partitions)
    found = assign_shards(docs, 6, rows_per_task=rows_per_task).collect()
    got = sorted((-1 if r["id"] is None else r["id"], r["size"], r["crc"], r["number"], r["shard"], r["slot"])
                 for r in found)
    assert got == expected_shards(ODD, 6)


def test_shards_law(text_spark, small):
    found = op13_sharding(text_spark, small)
    held = {r["shard"]: r for r in found.groupBy("shard").agg(
        F.count("slot").alias("n"), F.min("slot").alias("first"), F.max("slot").alias("last"),
        F.count_distinct("slot").alias("slots")).collect()}
    rows = found.count()
    assert set(held) == set(range(40))
    assert {r["n"] for r in held.values()} <= {rows // 40, -(-rows // 40)}
    assert all(r["first"] == 0 and r["last"] == r["n"] - 1 and r["slots"] == r["n"] for r in held.values())
    texts = {r["doc_id"]: r["text"] or "" for r in text_spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in found.collect():
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (
            len(data) + 16, zlib.crc32(data), "rows", None)


def test_written_shards_hold_whole_rows_in_order(text_spark, documents):
    docs = documents([(i, f"text {i}") for i in range(100)] + [(None, None)])
    path = scratch_dir(text_spark, "test-shards")
    assert write_shards(docs, path, shards=4, rows_per_file=7) == 101
    back = text_spark.read.parquet(path)
    assert back.select("row.*").columns == docs.columns
    assert back.select("row.*").exceptAll(docs).isEmpty() and docs.exceptAll(back.select("row.*")).isEmpty()
    number = {r["row"]["doc_id"]: int(row_at(r["shard"], r["slot"], 101, 4)) for r in back.collect()}
    assert number == {None: 0, **{i: i + 1 for i in range(100)}}
    assert back.where(f"part <> slot div 7").isEmpty()
    assert back.groupBy("shard", "part").count().agg(F.max("count")).first()[0] <= 7


def test_shards_of_no_rows(documents):
    assert assign_shards(documents([])).isEmpty()


@pytest.mark.parametrize(("axes", "bits"), [(1, 4), (2, 1), (2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_takes_single_steps(axes, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    key = hilbert_key(grid, bits)
    assert sorted(key.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


VECTORS = "vec_id long, label int, embedding array<float>"


def brute_force(rows, is_anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    """rows: (id, label, vector). All pairs, in plain Python."""
    sound = [
        (i, l, [math.floor(scale * float(np.float32(x))) for x in v]) for i, l, v in rows
        if i is not None and l is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, label, q in (r for r in sound if is_anchor(r[0])):
        scored = [(-sum(x * y for x, y in zip(q, v)), i, l) for i, l, v in sound if len(v) == len(q)]
        for p, positive, _ in sorted(s for s in scored if s[2] == label and s[1] != a)[:positives]:
            fit = sorted(s for s in scored if s[2] != label
                         and low * -p <= 100 * -s[0] <= high * -p)
            out += [(a, positive, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(fit[:negatives])]
    return sorted(out)


def mined(df, condition="vec_id % 5 = 0", **more):
    found = hard_negatives(df, F.expr(condition), **more)
    return sorted(tuple(r) for r in found.collect())


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    at = rng.integers(0, 6, n)
    v = centres[at] + 0.3 * rng.normal(size=(n, dims))
    return [(i, int(rng.integers(0, 4)), [float(x) for x in v[i]]) for i in range(n)]


@pytest.fixture
def small_blocks(monkeypatch):
    """Many blocks, files and portions of zone maps on few rows."""
    for name, value in {"ROWS_PER_BLOCK": 8, "ROWS_PER_FILE": 32, "ANCHORS_AT_ONCE": 4,
                        "ZONES_AT_ONCE": 3, "CACHED_BLOCKS": 2}.items():
        monkeypatch.setattr(mining, name, value)


def test_mining_equals_brute_force(text_spark, small_blocks):
    rows = clustered(300, 6, 1)
    df = text_spark.createDataFrame(rows, VECTORS).repartition(5)
    assert mined(df) == brute_force(rows, lambda i: i % 5 == 0)


def test_mining_with_a_third_of_equal_vectors(text_spark, small_blocks):
    rows = clustered(120, 5, 2)
    rows += [(1000 + i, i % 3, [0.5, 0.25, -0.5, 0.125, 0.0]) for i in range(60)]
    df = text_spark.createDataFrame(rows, VECTORS)
    assert mined(df) == brute_force(rows, lambda i: i % 5 == 0)


def test_mining_of_odd_rows(text_spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 1.0]), (2, 2, [0.5, 1.0]), (3, 2, [0.5, 1.0]),
        (None, 1, [1.0, 1.0]), (4, None, [1.0, 1.0]), (5, 1, None), (6, 1, [nan, 1.0]), (7, 2, [inf, 0.0]),
        (8, 2, [None, 1.0]), (9, 1, []), (10, 2, []), (15, 1, []), (11, 2, [1.0, 0.5, 3.0]), (0, 1, [1.0, 2.0]),
        (12, 1, [300.0, 1.0]), (13, 2, [100.0, 90.0]), (14, 3, [1e6, 3.0]), (20, 1, [-2.0, 1.0]),
    ]
    df = text_spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS dims", "2 AS curve", "'x' AS id")
    assert mined(df) == brute_force(rows, lambda i: i % 5 == 0)


def test_mining_of_no_rows(text_spark):
    df = text_spark.createDataFrame([], VECTORS)
    assert mined(df) == []
    assert mined(text_spark.createDataFrame([(1, 1, [1.0])], VECTORS)) == []


def test_scores_between_doubles_and_longs_are_exact():
    rng = random.Random(3)
    left = [[rng.randrange(2**28) for _ in range(4)] for _ in range(5)]
    exact = [[sum(a * b for a, b in zip(x, y)) for y in left] for x in left]
    assert mining._scores(np.array(left, float), np.array(left, float)).tolist() == exact
    with pytest.raises(ArithmeticError):
        mining._scores(np.full((1, 4), 2.0**40), np.full((1, 4), 2.0**40))


def test_zone_maps_spare_blocks(text_spark, small_blocks, monkeypatch):
    """Rows in far-apart clusters: an anchor leaves most blocks unread, with the same result."""
    rng = np.random.default_rng(4)
    rows = []
    for c in range(20):
        centre = np.zeros(20)
        centre[c] = 4
        for k in range(40):
            rows.append((len(rows), k % 4, (centre + 0.05 * rng.normal(size=20)).tolist()))
    monkeypatch.setattr(mining, "CACHED_BLOCKS", 0)
    df = text_spark.createDataFrame(rows, VECTORS)
    # The tasks run in other processes, so blocks are counted by reading the same way here.
    whole = [(i, l, np.floor(256 * np.array(v, np.float32).astype(float))) for i, l, v in rows]
    q = whole[5][2][None, :]
    read = []

    class Counting:
        def zones(self, dims):
            for at in range(0, len(whole), 8):
                part = np.array([w[2] for w in whole[at:at + 8]])
                yield [at], part.min(0)[None], part.max(0)[None], [{w[1] for w in whole[at:at + 8]}]

        def read(self, at, dims):
            read.append(at)
            part = whole[at:at + 8]
            return (np.array([w[0] for w in part]), np.array([w[1] for w in part]),
                    np.array([w[2] for w in part]))

    every = np.full(1, mining.LAST)
    best = mining._search(Counting(), np.array([5]), np.array([1]), q, np.array([0]), -every, every, True, 5)
    scores = sorted(((-int(w[2] @ q[0]), w[0]) for w in whole if w[1] == 1 and w[0] != 5))[:5]
    assert list(zip((-best.score).tolist(), best.id.tolist())) == scores
    assert len(read) < len(whole) / 8 / 4
    assert mined(df, "vec_id = 5") == brute_force(rows, lambda i: i == 5)
