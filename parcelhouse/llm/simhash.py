"""Near duplicates by SimHash fingerprints, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import giving_back, id_and_text, table, tokens, written

QUARTER = 16
# Fingerprints of a tile, with its guests, that are compared in one piece.
TILE_ROWS = 1 << 16
BLOCK = 1 << 22
ROUNDS = 200


def fingerprint(text: str, shingle: int, seed: int) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; 0 if there is no word."""
    words = tokens(text)
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words])
    starts = (stops - [len(w) + 1 for w in words])[:max(1, len(words) - shingle + 1)].tolist()
    ends = (stops[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts, ends)), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
    seed: int = 42,
) -> DataFrame:
    """id and fp (the 64 bits as a signed long) of every row, from its whole text."""
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            found = np.fromiter(
                (fingerprint(texts[i].as_py(), shingle, seed) for i in range(len(texts))),
                np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(giving_back(run), f"id {id_type}, fp long")


def tile_neighbours(radius: int) -> list[list[int]]:
    """Steps from a tile to those at most `radius` away, one of each opposite pair, itself first.

    A tile holds the fingerprints with the same population counts of their four quarters.
    Two fingerprints within the radius differ by no more than the radius in the sum of
    these counts' differences, so all other tile pairs are skipped.
    """
    span = range(-radius, radius + 1)
    steps = [
        [a, b, c, d] for a in span for b in span for c in span for d in span
        if abs(a) + abs(b) + abs(c) + abs(d) <= radius
    ]
    return [s for s in steps if s >= [0, 0, 0, 0]]


def _close_pairs(left: np.ndarray, right: np.ndarray, radius: int, byte: int = 0):
    """Index pairs at most `radius` bits apart, by exclusive-or and bit counts.

    Large tiles are cut again by the population count of one byte after the other, and
    pairs of parts whose counts differ beyond the radius are skipped.
    """
    if len(left) == 0 or len(right) == 0:
        return
    if byte < 8 and len(left) * len(right) > BLOCK:
        at = [np.bitwise_count((x >> np.uint64(8 * byte)) & np.uint64(255)) for x in (left, right)]
        for a in np.unique(at[0]):
            rows = np.flatnonzero(at[0] == a)
            for b in np.unique(at[1]):
                if abs(int(a) - int(b)) <= radius:
                    cols = np.flatnonzero(at[1] == b)
                    for i, j in _close_pairs(left[rows], right[cols], radius, byte + 1):
                        yield rows[i], cols[j]
        return
    width = max(1, BLOCK // len(right)) if len(right) <= BLOCK else 1
    for i in range(0, len(left), width):
        for j in range(0, len(right), BLOCK):
            xor = left[i:i + width, None] ^ right[None, j:j + BLOCK]
            found = np.nonzero(np.bitwise_count(xor) <= radius)
            yield found[0] + i, found[1] + j


def _merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining each a with its b: the smallest index of the joined set."""
    while True:
        least = np.minimum(labels[a], labels[b])
        before = labels.copy()
        np.minimum.at(labels, before[a], least)
        np.minimum.at(labels, before[b], least)
        labels = labels[labels]
        if np.array_equal(labels, before):
            return labels


def _tile_forest(
    home: np.ndarray, guests: np.ndarray, radius: int, within: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs within a tile and with its guests connect."""
    nodes = np.concatenate([home, guests])
    labels = np.arange(len(nodes))
    pairs = [(home, home, 0)] if within else []
    for left, right, shift in [*pairs, (home, guests, len(home))]:
        for i, j in _close_pairs(left, right, radius):
            if len(i):
                labels = _merged(labels, i, j + shift)
    while not np.array_equal(labels, labels[labels]):
        labels = labels[labels]
    linked = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[linked], nodes[labels[linked]]


def dealt_tiles(distinct: DataFrame, radius: int) -> DataFrame:
    """cell, guest and fp: which fingerprints are compared together.

    Each fingerprint goes to its own tile and as a guest to the neighbours on one side, a
    number that depends on the radius only. A tile of more than TILE_ROWS of both is dealt by
    a hash into blocks of about that size, and each pair of blocks (i, j) is a cell of its
    own: block i of the tile's fingerprints meets block j of its guests and, where i < j, its
    own block j as further guests. In the cell (i, i) block i is also compared within itself.
    So each pair meets once, and no cell holds more than three blocks, however many
    fingerprints a tile has. A tile's number is below 2**24, that of a block below 2**16.
    """
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", QUARTER * q).bitwiseAND(0xFFFF)) for q in range(4)
    ]
    steps = tile_neighbours(radius)
    tiles = F.array(*[
        F.struct(
            sum(((counts[q] + step[q] + radius) * 64 ** q for q in range(4)), F.lit(0))
            .cast("long").alias("tile"),
            F.lit(step != [0, 0, 0, 0]).alias("guest"))
        for step in steps
    ])
    dealt = distinct.select("fp", F.explode(tiles).alias("t")).select("t.tile", "t.guest", "fp")
    # A row per large tile: there are at most 64**4 tiles, and as many as fingerprints allow.
    large = dealt.groupBy("tile").agg(F.ceil(F.count("fp") / TILE_ROWS).alias("blocks")).where(
        "blocks > 1")
    blocked = dealt.join(F.broadcast(large), "tile", "left").withColumn(
        "block", F.coalesce(F.pmod(F.xxhash64("fp"), "blocks"), F.lit(0)))
    cells = F.expr("""
        CASE WHEN blocks IS NULL THEN array(struct(0L AS i, 0L AS j, guest AS guest))
             WHEN guest THEN transform(sequence(0L, blocks - 1), i -> struct(i AS i, block AS j, true AS guest))
             ELSE concat(
                transform(sequence(0L, blocks - 1), j -> struct(block AS i, j AS j, false AS guest)),
                transform(filter(sequence(0L, blocks - 1), i -> i < block),
                          i -> struct(i AS i, block AS j, true AS guest))) END""")
    return blocked.select("tile", "fp", F.explode(cells).alias("c")).select(
        (F.col("tile") * 2 ** 32 + F.col("c.i") * 2 ** 16 + F.col("c.j")).cast("long").alias("cell"),
        "c.guest", "fp")


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between different fingerprints, enough to connect all within the radius.

    Each cell of dealt_tiles is compared whole; what it returns is a forest, so that a dense
    group gives no more links than it has members in the cell.
    """
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_tiles = dealt_tiles(distinct, radius).repartition(
        partitions, "cell").sortWithinPartitions("cell", "guest", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(cell: int, parts: list[tuple[np.ndarray, np.ndarray]]):
            guest = np.concatenate([g for g, _ in parts])
            fps = np.concatenate([f for _, f in parts])
            home = fps[~guest]
            if len(home) == 0 or len(fps) < 2:
                return None
            within = cell >> 16 & 0xFFFF == cell & 0xFFFF
            a, b = _tile_forest(home, fps[guest], radius, within)
            if not len(a):
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        open_cell, parts = None, []
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            guest = batch.column("guest").to_numpy(zero_copy_only=False).astype(bool)
            fps = batch.column("fp").to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                if cell[start] != open_cell:
                    if parts and (out := compared(open_cell, parts)) is not None:
                        yield out
                    open_cell, parts = int(cell[start]), []
                parts.append((guest[start:stop], fps[start:stop]))
        if parts and (out := compared(open_cell, parts)) is not None:
            yield out

    return sorted_tiles.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node and root for every node of the links (a, b): connected nodes have the same root.

    Each round every node joins the neighbour that a hash of the round ranks first, and links
    are carried over to the joined nodes, which leaves a constant share fewer of them. Rounds
    are cut off by checkpoints in the shared folder; only counts reach the driver. They are
    written by as many tasks as the links left need, so that late rounds are short.
    """
    edges = written(edges.where("a <> b").distinct())
    mapping, nodes = None, 0
    for step in range(ROUNDS):
        left = edges.count()
        if not left:
            break
        nodes = nodes or 2 * left  # at most; later rounds bring no new ones
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def rank(c: str, step: int = step):
            return F.struct(F.xxhash64(c, F.lit(step)).alias("h"), F.col(c).alias("node"))

        parents = written(
            both.groupBy("a").agg(F.min(rank("b")).alias("best"))
            .select(F.col("a").alias("node"),
                    F.least(rank("a"), F.col("best"))["node"].alias("parent")), 2 * left)
        if mapping is None:
            mapping = parents.withColumnRenamed("parent", "root")
        else:
            up = parents.select(F.col("node").alias("root"), "parent")
            mapping = written(mapping.join(up, "root", "left").select(
                "node", F.coalesce("parent", "root").alias("root")), nodes)
        for side in ("a", "b"):
            up = parents.select(F.col("node").alias(side), F.col("parent").alias("to"))
            edges = edges.join(up, side).drop(side).withColumnRenamed("to", side)
        edges = written(edges.select("a", "b").where("a <> b").distinct(), left)
    else:
        raise RuntimeError("links still open after the last round")
    if mapping is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return mapping


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
    radius: int = 2, seed: int = 42,
) -> DataFrame:
    """Fingerprint and component of every document.

    Fingerprints at most `radius` bits apart are linked; component_id is the smallest id
    that links reach. Returns id, fp, component_id, one row per input row.

    Null and empty texts have fingerprint 0 and are linked like any other. Equal fingerprints
    are compared once. Rows that repeat an id are the same document; a null id is larger than
    any other, and component_id is null if the whole component has none. Extra columns are
    ignored; an empty table gives an empty one.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle, seed))
    distinct = written(marked.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("id", "fp", "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options):
    """The documents that stay: of each component the smallest id, all columns kept.

    Rows without an id stay if their whole component has none.
    """
    groups = simhash_groups(docs, id_col, text_col, **options)
    lost = groups.where("not (id <=> component_id)").select(F.col("id").alias("__pc_id"))
    stay = groups.where("id <=> component_id").select(F.col("id").alias("__pc_id"))
    # Ids of rows in several components stay if any of their rows does.
    lost = lost.distinct().join(stay.distinct().withColumnRenamed("__pc_id", "__pc_stay"),
                                F.col("__pc_id").eqNullSafe(F.col("__pc_stay")), "left_anti")
    return docs.join(lost, docs[id_col].eqNullSafe(lost["__pc_id"]), "left_anti")


def op6_simhash(spark, folder: str) -> DataFrame:
    groups = simhash_groups(table(spark, folder, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
