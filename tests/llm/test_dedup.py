"""Exact, line and SimHash duplicates against brute force."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from parcelhouse.llm.exact_dedup import exact_dedup, exact_groups, key_filter, may_hold, passes
from parcelhouse.llm.line_dedup import line_dedup
from parcelhouse.llm import decontamination, packing, quality, simhash
from parcelhouse.llm.common import giving_back
from parcelhouse.llm.simhash import (
    _close_pairs, components, fingerprint, near_dedup, simhash_groups)

ODD = [
    (1, "Same text"), (2, "same TEXT"), (3, None), (4, ""), (5, "Été"), (6, "été"),
    (7, "other"), (7, "other"), (8, "x " * 200_000), (9, "X " * 200_000), (None, "other"),
    (None, "alone"),
]


def lowered(text):
    return (text or "").encode().lower().decode()


def test_exact_groups(documents):
    found = exact_groups(documents(ODD), digest_all=True).collect()
    assert len(found) == len(ODD)
    by_text = {}
    for i, text in ODD:
        by_text.setdefault(lowered(text), []).append(i)
    expected = sorted(
        (str(i), str(max((x for x in ids if x is not None), default=None)), len(ids))
        for ids in by_text.values() for i in ids)
    assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == len(by_text)


def test_exact_dedup_keeps_columns_and_one_row(documents):
    docs = documents(ODD)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "4", "5", "6", "7", "9", "None"]


def test_filter_never_misses(text_spark):
    keys = [random.Random(1).getrandbits(63) - 2**62 for _ in range(1000)] + [-1, 0, -2**63]
    df = text_spark.createDataFrame([(k,) for k in keys], "key long")
    bits = key_filter(df)
    assert may_hold(bits, np.array(keys)).all()
    assert df.where(~passes(bits, F.col("key"))).isEmpty()
    other = text_spark.range(5000).select(F.xxhash64("id").alias("key"))
    assert other.where(passes(bits, F.col("key"))).count() < 50


def test_empty_tables(documents):
    empty = documents([])
    assert exact_groups(empty).count() == 0
    assert exact_dedup(empty).count() == 0
    assert simhash_groups(empty).count() == 0
    assert line_dedup(empty).count() == 0


def plain_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t\n", "one", "one two", "A b c d", "a\x0bb\x0cc É d " * 9])
def test_fingerprint(text):
    assert fingerprint(text, 3, 42) == plain_fingerprint(text)


def test_close_pairs_with_and_without_cutting(monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    expected = {
        (i, j) for i in range(300) for j in range(300)
        if bin(int(base[i]) ^ int(near[j])).count("1") <= 2}
    for block in (1 << 22, 64):
        monkeypatch.setattr("parcelhouse.llm.simhash.BLOCK", block)
        found = {(int(i), int(j)) for a, b in _close_pairs(base, near, 2) for i, j in zip(a, b)}
        assert found == expected


def test_simhash_components(documents):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    rows = []
    for g in range(12):
        text = [rng.choice(words) for _ in range(150)]
        for _ in range(6):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            text[rng.randrange(150)] = rng.choice(words)
    rows += [(900, None), (901, ""), (902, "short"), (None, "short")]
    found = {r["id"]: r for r in simhash_groups(documents(rows)).collect()}
    prints = {i: plain_fingerprint(t or "") for i, t in rows}
    for i, row in found.items():
        assert row["fp"] & (2**64 - 1) == prints[i]
    label = {i: i for i in prints}
    order = {i: (i is None, i or 0) for i in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if bin(prints[a] ^ prints[b]).count("1") <= 2:
                    label[a] = label[b] = min(label[a], label[b], key=order.get)
    assert {i: r["component_id"] for i, r in found.items()} == label
    kept = near_dedup(documents(rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({x for x in label.values()})


def linked_sets(edges):
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        root[find(a)] = find(b)
    found = {}
    for x in list(root):
        found.setdefault(find(x), set()).add(x)
    return {frozenset(s) for s in found.values()}


@pytest.mark.parametrize("tile_rows", [7, 40, 1 << 16])
def test_links_of_a_tile_with_a_third_of_all(text_spark, monkeypatch, tile_rows):
    """A third of the fingerprints lie in one tile; it is compared in cells of bounded size."""
    monkeypatch.setattr(simhash, "TILE_ROWS", tile_rows)
    rng = np.random.default_rng(5)
    spread = rng.integers(0, 2**63, 400, dtype=np.uint64)
    near = [f ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for f in spread[:150] for a, b in [rng.integers(0, 63, 2)]]
    base = np.uint64(0x00FF00FF00FF00FF)
    crowd = set()
    while len(crowd) < 300:  # two bits cleared and two set in one quarter: the counts stay
        a, b = rng.choice(8, 2, replace=False), 8 + rng.choice(8, 2, replace=False)
        q = 16 * int(rng.integers(0, 4))
        flips = sum(1 << (q + int(x)) for x in (*a, *b))
        crowd.add(int(base) ^ flips)
    fps = np.unique(np.concatenate([spread, near, np.array(sorted(crowd), np.uint64)]))
    rows = text_spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    if tile_rows < 100:
        cells = simhash.dealt_tiles(rows, 2).groupBy("cell").count()
        assert cells.agg(F.max("count")).first()[0] <= 3 * tile_rows + 12 * tile_rows ** 0.5
    found = [(r["a"], r["b"]) for r in simhash.links(rows, 2).collect()]
    distance = np.bitwise_count(fps[:, None] ^ fps[None, :])
    close = {(int(fps.view(np.int64)[i]), int(fps.view(np.int64)[j]))
             for i, j in zip(*np.nonzero(distance <= 2)) if i < j}
    assert linked_sets(found) == linked_sets(close) and len(close) > 300


def test_components_of_a_long_chain(text_spark):
    edges = text_spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    found = components(edges)
    assert found.count() == 301
    assert found.select("root").distinct().count() == 1


def test_components_of_few_links_write_few_files(text_spark):
    edges = text_spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    settings = {"spark.sql.shuffle.partitions": "60",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: text_spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            text_spark.conf.set(k, v)
        found = components(edges)
        files = found.rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            text_spark.conf.set(k, v)
    assert files <= text_spark.sparkContext.defaultParallelism
    assert found.count() == 301 and found.select("root").distinct().count() == 1


def own_mb():
    with open("/proc/self/smaps_rollup") as rollup:
        return sum(int(line.split()[1]) for line in rollup if line.startswith("Anonymous:")) / 1024


def test_workers_give_memory_back():
    def run(batches):
        for batch in batches:
            # Freed below a block that stays, where the C library keeps it.
            rows = [bytes(2000) for _ in range(40_000)]
            kept.append(rows[-1])
            del rows
            yield batch

    kept, before = [], own_mb()
    assert list(run([1, 2])) == list(giving_back(run)([1, 2]))
    assert own_mb() - before < 40


def test_worker_functions_of_the_stages_give_back(text_spark, monkeypatch, documents):
    wrapped = []

    def noting(function):
        wrapped.append(function)
        return function

    rows = documents([(1, "some words of a text"), (2, None)])
    for module in (simhash, packing, quality, decontamination):
        monkeypatch.setattr(module, "giving_back", noting)
    simhash.fingerprints(rows)
    packing.pack(rows)
    quality.keep_good(rows, quality.Network.start())
    decontamination.gram_hits(rows.withColumn("key", F.lit(1).cast("bigint")), bytes(1 << 20), [4])
    assert len(wrapped) == 4


def test_packing_workers_keep_chunks_only_if_told(text_spark, documents, monkeypatch):
    runs = []
    monkeypatch.setattr(packing, "giving_back", lambda f: runs.append(f) or f)
    rows = documents([(1, "some words of a text"), (2, None)])
    for keep in (True, False):
        packing.pack(rows, keep_chunks=keep)
    path = packing.default_tokenizer()
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "text": ["some words of a text", ""]})
    found, left = [], []
    for run in runs:
        found.append([b.to_pydict() for b in run(iter([batch]))])
        left.append(len(packing._cache[path]))
    assert found[0] == found[1] and left[0] > 0 and left[1] == 0


def spark_hash(value, seed=42):
    data = value if isinstance(value, bytes) else struct.pack("<q", value)
    return xxhash.xxh64_intdigest(data, seed)


def plain_chunks(text):
    out, chunk, before = [], [], 0
    for line in text.split("\n"):
        h = spark_hash(line.encode())
        signed = h - 2**64 if h >> 63 else h
        chunk.append(line)
        if spark_hash(before, spark_hash(signed)) % 2 == 0:
            out.append(chunk)
            chunk = []
        before = signed
    return out + [chunk] if chunk else out


def test_line_dedup(documents):
    rng = random.Random(5)
    passage = [f"passage line {i}" for i in range(12)]
    rows = []
    for i in range(40):
        own = [f"line {rng.random()}" for _ in range(rng.randrange(6))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + (passage if i % 2 else []) + own[at:])))
    rows += [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "\n\n\n\n")]
    seen, expected = set(), {}
    for i, text in rows:
        if text is None:
            expected[i] = None
            continue
        kept = []
        for chunk in plain_chunks(text):
            joined = "\n".join(chunk)
            if len(chunk) > 1 and joined.strip(" "):
                if joined in seen:
                    continue
                seen.add(joined)
            kept += chunk
        expected[i] = "\n".join(kept)
    found = {r["doc_id"]: r for r in line_dedup(documents(rows)).collect()}
    assert {i: r["text"] for i, r in found.items()} == expected
    assert sum(r["removed_lines"] for r in found.values()) > 100
    assert found[100]["n_lines"] == 0


def test_line_dedup_finds_whole_passages(documents):
    """Passages of 1 to 5 lines and over 50 words, between neighbours that differ each time."""
    rng = random.Random(9)

    def line(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    def own():
        return [line(rng.randrange(1, 20)) for _ in range(rng.randrange(1, 4))]

    passages = [[line(60 // n + 1) for _ in range(n)] for n in (1, 2, 3, 4, 5) for _ in range(8)]
    passages += [[line(70), "", line(3)], [line(3), line(70)], [line(1) for _ in range(51)],
                 ["\u6f22" + "".join(chr(0x4e00 + rng.randrange(9000)) for _ in range(60))]]
    rows, expected, first = [], {}, {}
    for copy in range(3):
        for passage in passages:
            before, after, i = own(), own(), len(rows)
            rows.append((i, "\n".join(before + passage + after)))
            expected[i] = "\n".join(before + (passage if copy == 0 else []) + after)
    # Twice in one text; runs of 50 words stay; lines that overlap their own first run stay.
    twice, short, same = [line(30), line(30)], [line(50)], ["ha"] * 120
    for text, left in (
            (["a", *twice, "b", *twice, "c"], ["a", *twice, "b", "c"]),
            (["d", *short, "e", *short, "f"], ["d", *short, "e", *short, "f"])):
        expected[len(rows)] = "\n".join(left)
        rows.append((len(rows), "\n".join(text)))
    rows.append((len(rows), "\n".join(same)))
    found = {r["doc_id"]: r for r in line_dedup(documents(rows)).collect()}
    assert {i: found[i]["text"] for i in expected} == expected
    assert 0 < len(found[len(rows) - 1]["text"].split()) <= 51
    for i, text in rows:
        lost = len(text.split("\n")) - len(found[i]["text"].split("\n"))
        assert found[i]["removed_lines"] == lost
        assert (found[i]["removed_chunks"] > 0) == (lost > 0)
