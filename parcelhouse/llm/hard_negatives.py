"""Hard negatives: rows of other labels that score within a window below a positive's score.

Candidates lie along a Hilbert curve in Parquet blocks (row groups), each with a zone map:
the least and greatest value of every dimension and the labels it holds. From a zone map
follow bounds of the inner product of an anchor with any row of the block, so an anchor reads
only those blocks that can still change its result. The result is exact.
"""

from __future__ import annotations

import io
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import (
    is_local, local_path, shared_path, store_bytes, table, written)

CURVE_DIMS = 8
CURVE_BITS = 4
ROWS_PER_BLOCK = 1024
ROWS_PER_FILE = 16 * ROWS_PER_BLOCK
ANCHORS_AT_ONCE = 128
ZONES_AT_ONCE = 1024
CACHED_BLOCKS = 64
LAST = np.iinfo(np.int64).max
EXACT_DOUBLE = 2**53

ROW = "id long, label long, anchor boolean, dims int, curve long, vec binary"
ZONE = ("file string, block int, dims int, low binary, high binary, labels array<long>")
FOUND = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
         "negative_score long")


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates below 2**bits.

    `cells` holds a row per point. After J. Skilling, Programming the Hilbert curve (2004):
    coordinates are rotated from the highest bit down, then Gray-coded and interleaved.
    """
    x = cells.T.astype(np.int64).copy()
    if not len(x):
        return np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in x:
            flipped = (axis >> bit & 1).astype(bool)
            swap = np.where(flipped, 0, (x[0] ^ axis) & below)
            x[0] ^= np.where(flipped, below, swap)
            axis ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | axis >> bit & 1
    return key


def _whole_vectors(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of floor(scale * x)) per vector length, rows without fault only."""
    vectors = batch.column("vec")
    ends = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
    lengths = np.diff(ends)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
    faults = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    sound = faults[ends[1:]] == faults[ends[:-1]]
    for dims in np.unique(lengths[sound]):
        at = np.flatnonzero(sound & (lengths == dims))
        yield at, np.floor(scale * values[ends[at][:, None] + np.arange(dims)])


def _statistics(rows: DataFrame, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation of every dimension, by vector length. They only steer the curve."""
    def run(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for _, m in _whole_vectors(batch, scale):
                got = sums.setdefault(m.shape[1], [0, 0.0, 0.0])
                got[0] += len(m)
                got[1] = got[1] + m.sum(axis=0)
                got[2] = got[2] + (m * m).sum(axis=0)
        for dims, (n, one, two) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dims, dims)), pa.array(np.arange(dims)),
                 pa.array(np.full(dims, n)), pa.array(np.broadcast_to(one, dims)),
                 pa.array(np.broadcast_to(two, dims))],
                ["dims", "d", "n", "one", "two"])

    parts = rows.mapInArrow(run, "dims long, d long, n long, one double, two double")
    found: dict[int, list] = {}
    for r in parts.groupBy("dims", "d").agg(
            *[F.sum(c).alias(c) for c in ("n", "one", "two")]).collect():
        mean = r["one"] / r["n"]
        found.setdefault(r["dims"], []).append((r["d"], mean, max(r["two"] / r["n"] - mean**2, 0.0)))
    return {
        dims: (np.array([m for _, m, _ in sorted(v)]), np.sqrt([s for _, _, s in sorted(v)]))
        for dims, v in found.items()
    }


def _packed(matrix: np.ndarray) -> list[bytes]:
    """Rows as bytes: 16-bit numbers where they fit, else doubles."""
    small = np.abs(matrix).max(axis=1, initial=0) < 2**15
    return [(r.astype("<i2") if s else r.astype("<f8")).tobytes() for r, s in zip(matrix, small)]


def _unpacked(vectors: list[bytes], dims: int) -> np.ndarray:
    if not dims:
        return np.zeros((len(vectors), 0))
    joined = b"".join(vectors)
    if len(joined) == 2 * dims * len(vectors):
        return np.frombuffer(joined, "<i2").reshape(-1, dims).astype(np.float64)
    rows = [np.frombuffer(v, "<i2" if len(v) == 2 * dims else "<f8") for v in vectors]
    return np.array(rows, np.float64).reshape(-1, dims)


def _on_curve(rows: DataFrame, scale: float) -> DataFrame:
    """Sound rows with their whole vector and its place on the curve.

    The curve runs through the dimensions that vary most, each cut into equal cells over two
    deviations on both sides of its mean.
    """
    statistics = _statistics(rows, scale)
    chosen = {
        dims: np.argsort(-deviations, kind="stable")[:CURVE_DIMS]
        for dims, (_, deviations) in statistics.items()
    }
    cells = 1 << CURVE_BITS

    def run(batches):
        for batch in batches:
            for at, m in _whole_vectors(batch, scale):
                dims = m.shape[1]
                if dims:
                    axes = chosen[dims]
                    mean, deviation = (s[axes] for s in statistics[dims])
                    spread = (m[:, axes] - mean) / np.maximum(deviation, 1e-9)
                    cell = np.clip((spread + 2) * cells / 4, 0, cells - 1).astype(np.int64)
                    curve = hilbert_key(cell, CURVE_BITS)
                else:
                    curve = np.zeros(len(m), np.int64)
                some = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("label"), some.column("anchor"),
                     pa.array(np.full(len(at), dims, np.int32)), pa.array(curve),
                     pa.array(_packed(m), pa.binary())],
                    ["id", "label", "anchor", "dims", "curve", "vec"])

    return rows.mapInArrow(run, ROW)


def _stored_blocks(ranged: DataFrame, folder: str) -> DataFrame:
    """Write the rows, which come in curve order, as Parquet blocks; returns the zone maps.

    A file is whole or not there at all, and a task that runs again writes files of new
    names, so that the zone maps always belong to the files they name.
    """
    def run(batches):
        context = TaskContext.get()
        task = f"{context.partitionId()}-{context.taskAttemptId()}"
        held: list[pa.Table] = []
        n_held, n_files = 0, 0

        def file_of(rows: pa.Table) -> pa.RecordBatch:
            nonlocal n_files
            name = f"{folder}/blocks/{task}-{n_files}.parquet"
            n_files += 1
            dims = rows.column("dims").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), len(dims)]
            zones, out = [], io.BytesIO()
            schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("vec", pa.binary())])
            with pq.ParquetWriter(out, schema, use_dictionary=False) as writer:
                for start, end in zip(cuts, cuts[1:]):
                    for at in range(start, end, ROWS_PER_BLOCK):
                        part = rows.slice(at, min(ROWS_PER_BLOCK, end - at))
                        writer.write_table(part.select(schema.names).cast(schema))
                        m = _unpacked(part.column("vec").to_pylist(), int(dims[at]))
                        zones.append((
                            name, len(zones), int(dims[at]), m.min(axis=0).tobytes(),
                            m.max(axis=0).tobytes(),
                            np.unique(part.column("label").to_numpy()).tolist()))
            store_bytes(name, out.getvalue())
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*zones), kinds)],
                ["file", "block", "dims", "low", "high", "labels"])

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            n_held += batch.num_rows
            while n_held >= ROWS_PER_FILE:
                rows = pa.concat_tables(held)
                yield file_of(rows.slice(0, ROWS_PER_FILE))
                held, n_held = [rows.slice(ROWS_PER_FILE)], n_held - ROWS_PER_FILE
        if n_held:
            yield file_of(pa.concat_tables(held))

    return ranged.mapInArrow(run, ZONE)


def _file_system(uri: str):
    from pyarrow import fs

    return (fs.LocalFileSystem(), local_path(uri)) if is_local(uri) else fs.FileSystem.from_uri(uri)


class Blocks:
    """Reads zone maps in portions and blocks one by one, keeping the last few blocks."""

    def __init__(self, folder: str):
        self.folder = folder
        self.kept: OrderedDict[tuple, tuple] = OrderedDict()
        self.files: OrderedDict[str, pq.ParquetFile] = OrderedDict()
        self.blocks_read = 0

    def zones(self, dims: int) -> Iterator[tuple]:
        """(names, low, high, labels) of ZONES_AT_ONCE blocks at most."""
        import pyarrow.dataset as ds

        store, path = _file_system(f"{self.folder}/zones")
        zones = ds.dataset(path, filesystem=store, format="parquet")
        portions = zones.to_batches(
            filter=ds.field("dims") == dims, batch_size=ZONES_AT_ONCE, batch_readahead=1,
            fragment_readahead=1, use_threads=False)
        held: list[pa.RecordBatch] = []

        def portion(batches):
            t = pa.Table.from_batches(batches)
            names = list(zip(t.column("file").to_pylist(), t.column("block").to_pylist()))
            low, high = (
                np.array([np.frombuffer(v, "<f8") for v in t.column(c).to_pylist()])
                for c in ("low", "high"))
            return names, low, high, [set(x) for x in t.column("labels").to_pylist()]

        for batch in portions:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= ZONES_AT_ONCE:
                yield portion(held)
                held = []
        if held:
            yield portion(held)

    def read(self, name: tuple[str, int], dims: int) -> tuple:
        """(ids, labels, matrix) of a block."""
        if name in self.kept:
            self.kept.move_to_end(name)
            return self.kept[name]
        file = self.files.pop(name[0], None)
        if file is None:
            store, path = _file_system(name[0])
            file = pq.ParquetFile(store.open_input_file(path))
        self.files[name[0]] = file
        rows = file.read_row_group(name[1], use_threads=False)
        self.blocks_read += 1
        block = (
            rows.column("id").to_numpy(), rows.column("label").to_numpy(),
            _unpacked(rows.column("vec").to_pylist(), dims))
        self.kept[name] = block
        if len(self.kept) > CACHED_BLOCKS:
            self.kept.popitem(last=False)
        if len(self.files) > CACHED_BLOCKS:
            self.files.popitem(last=False)[1].close()
        return block


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers as 64-bit integers."""
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, left.shape[1])
    if most < EXACT_DOUBLE:
        return (left @ right.T).astype(np.int64)
    if most >= 2**62:
        raise ArithmeticError("an inner product may exceed 64 bits")
    return left.astype(np.int64) @ right.T.astype(np.int64)


class Best:
    """The first k rows of each window, by score from the highest, then by id."""

    def __init__(self, windows: int, k: int):
        self.k = k
        self.window = np.empty(0, np.int64)
        self.score, self.id = self.window.copy(), self.window.copy()
        # What a row must beat to enter a window: nothing while it is not full.
        self.worst = np.full(windows, -LAST, np.int64)
        self.worst_id = np.full(windows, LAST, np.int64)
        self.full = np.zeros(windows, bool)

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        window = np.concatenate([self.window, window])
        score = np.concatenate([self.score, score])
        ids = np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, window))
        window, score, ids = window[order], score[order], ids[order]
        begins = np.flatnonzero(np.diff(window, prepend=-1))
        rank = np.arange(len(window)) - np.repeat(begins, np.diff(begins, append=len(window)))
        kept = rank < self.k
        self.window, self.score, self.id = window[kept], score[kept], ids[kept]
        last = kept & (rank == self.k - 1)
        self.worst[window[last]], self.worst_id[window[last]] = score[last], ids[last]
        self.full[window[last]] = True


def _search(
    blocks: Blocks, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray,
    anchor: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int,
) -> Best:
    """The first k rows with a score from low to high per window.

    A window belongs to an anchor and takes rows of the same label (but not the anchor's own
    id) or of other labels. Of each portion of blocks those are read first that promise the
    highest score; a block is read for the windows it can still change.
    """
    best = Best(len(anchor), k)
    dims = vectors.shape[1]
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    # Bounds are sums of doubles: exact below 2**53, else widened by their rounding.
    for names, least, greatest, held in blocks.zones(dims):
        highest = up @ greatest.T + down @ least.T
        lowest = up @ least.T + down @ greatest.T
        size = np.abs(vectors) @ np.maximum(np.abs(least), np.abs(greatest)).T
        slack = np.where(size < EXACT_DOUBLE / 2, 0, size * (dims + 2) * 2.0**-50)
        highest, lowest = highest + slack, lowest - slack
        wanted = {
            label: np.array([label in h if same else bool(h - {label}) for h in held])
            for label in set(labels.tolist())
        }
        holds = np.array([wanted[label] for label in labels.tolist()])
        for z in np.argsort(-highest.max(axis=0), kind="stable"):
            bound = highest[anchor, z]
            open_windows = np.flatnonzero(
                holds[anchor, z] & (bound >= low) & (lowest[anchor, z] <= high)
                & (~best.full | (bound >= best.worst)))
            if not open_windows.size:
                continue
            row_ids, row_labels, rows = blocks.read(names[z], dims)
            readers, of = np.unique(anchor[open_windows], return_inverse=True)
            score = _scores(vectors[readers], rows)
            fits = row_labels == labels[readers][:, None]
            fits = fits & (row_ids != ids[readers][:, None]) if same else ~fits
            score, fits = score[of], fits[of]
            worst = best.worst[open_windows][:, None]
            fits &= (score >= low[open_windows][:, None]) & (score <= high[open_windows][:, None])
            fits &= (score > worst) | ((score == worst) & (row_ids < best.worst_id[open_windows][:, None]))
            at, row = np.nonzero(fits)
            if at.size:
                best.add(open_windows[at], score[at, row], row_ids[row])
    return best


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: float = 256.0, id_col: str = "vec_id",
    label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """For each anchor and positive the best rows of other labels within a window of scores.

    Vectors are taken as floor(scale * x). A score is the inner product with the anchor; higher
    scores come first, then smaller ids. Positives are the first rows of the anchor's label,
    other than the anchor; negatives the first rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score. An anchor without positives, or a positive without negatives, has no row.

    Every row is compared with every anchor, in blocks; what is skipped cannot belong to the
    result. Rows without id or label, without vector or with a null or non-finite component
    take no part. Ids and labels are whole numbers. Vectors of different lengths have no
    score with one another. A repeated row counts as often as it is there, but an anchor's
    own id is never its positive. Scores beyond 64 bits are an error. An empty table
    gives no row. Extra columns are ignored.
    """
    spark = rows.sparkSession
    folder = shared_path(spark, "hard-negatives")
    usable = rows.select(
        rows[id_col].cast("long").alias("id"), rows[label_col].cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        rows[vector_col].cast("array<double>").alias("vec"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    placed = written(_on_curve(usable, scale))
    n_rows, n_anchors = placed.agg(F.count("id"), F.count_if("anchor")).first()

    def along_curve(df: DataFrame, n: int, per_task: int) -> DataFrame:
        order = ("dims", "curve", "id")
        return df.repartitionByRange(max(1, -(-n // per_task)), *order).sortWithinPartitions(*order)

    zones = _stored_blocks(along_curve(placed, n_rows, ROWS_PER_FILE), folder)
    zones.write.parquet(f"{folder}/zones")

    def run(batches):
        blocks = Blocks(folder)
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), len(dims)]
            for start, end in zip(cuts, cuts[1:]):
                for at in range(start, end, ANCHORS_AT_ONCE):
                    part = batch.slice(at, min(ANCHORS_AT_ONCE, end - at))
                    if part.num_rows:
                        yield mined(blocks, part, int(dims[at]))

    def mined(blocks: Blocks, part: pa.RecordBatch, dims: int) -> pa.RecordBatch:
        ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
        vectors = _unpacked(part.column("vec").to_pylist(), dims)
        every = np.full(len(ids), LAST, np.int64)
        first = _search(
            blocks, ids, labels, vectors, np.arange(len(ids)), -every, every, True, positives)
        score = first.score
        # ceil(low * score / 100) and floor(high * score / 100), in unbounded whole numbers
        least = np.array([-(-low * int(s) // 100) for s in score], np.int64)
        most = np.array([high * int(s) // 100 for s in score], np.int64)
        second = _search(
            blocks, ids, labels, vectors, first.window, least, most, False, negatives)
        begins = np.flatnonzero(np.diff(second.window, prepend=-1))
        rank = np.arange(len(second.window)) - np.repeat(
            begins, np.diff(begins, append=len(second.window)))
        of = second.window
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[first.window[of]]), pa.array(first.id[of]),
             pa.array((rank + 1).astype(np.int32)), pa.array(second.id),
             pa.array(score[of]), pa.array(second.score)],
            [c.split()[0] for c in FOUND.split(", ")])

    anchors = along_curve(placed.where("anchor"), n_anchors, ANCHORS_AT_ONCE)
    return anchors.mapInArrow(run, FOUND)


def op12_hard_negatives(spark, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = rows.withColumn(
        "label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return hard_negatives(moved, F.expr("vec_id % 100 = 0"))


OP12_SQL = """
WITH sound AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, o.vec_id AS id, a.label = o.label AS same,
           CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
    FROM sound a JOIN sound o ON len(a.v) = len(o.v) WHERE a.vec_id % 100 = 0
), positive AS (
    SELECT * FROM scored WHERE same AND id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), negative AS (
    SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score,
           n.score AS negative_score, CAST(row_number() OVER (
               PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank
    FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= 10
"""
