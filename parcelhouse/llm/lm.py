"""Language-model scores from an Elias-Fano n-gram trie in memory-mapped levels.

Level 1 holds the words of the training texts, sorted by a 63-bit hash, with their counts and
back-off weights; a word's id is its place. Level 2 holds the words seen after each word:
context ids, monotone pointers to each context's successors, the successors (made monotone by
adding context place times vocabulary size) and their quantised log probabilities. All integer
sequences are Elias-Fano coded; a bigram is found by a successor search among its context's
successors only. Levels are cut into shards of bounded size. Shards are files in the shared
folder that tasks write and memory-map; none of them passes through the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import (
    id_and_text, mapped, shards_for, shared_path, store_bytes, table, tokens, written)
from parcelhouse.llm.elias_fano import EliasFano, pack, unpack

END = b"\n"
HASH_BITS = 63
WORDS_PER_SHARD = 1 << 20
TOKENS_PER_SHARD = 2_000_000
PAIRS_AT_ONCE = 3_000_000
COUNTED_WORDS = 300_000
# Log probabilities and back-off weights are kept in so many steps.
STEPS = 256
FOLDS, LEFT_OUT = 5, 1


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> 1


def _least(a: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest unsigned type."""
    top = int(a.max()) if len(a) else 0
    for kind in ("<u1", "<u2", "<u4"):
        if top <= np.iinfo(kind).max:
            return a.astype(kind)
    return a.astype("<u8")


def _quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and a codebook of at most STEPS bins, each with the mean of its values.

    Half of the edges part the values into equal numbers and half into equal widths, so that
    common values are exact and rare ones not far off.
    """
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(STEPS, np.float32)
    half = np.linspace(0, 1, STEPS // 2 + 1)[1:-1]
    low, high = values.min(), values.max()
    edges = np.unique(np.concatenate([np.quantile(values, half), low + (high - low) * half]))
    codes = np.searchsorted(edges, values, "right")
    sums = np.bincount(codes, values, STEPS)
    sizes = np.bincount(codes, minlength=STEPS)
    return codes.astype(np.uint8), (sums / np.maximum(sizes, 1)).astype(np.float32)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[:len(keys)]
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


_open: dict[str, list[np.ndarray]] = {}


def _arrays(uri: str) -> list[np.ndarray]:
    """A shard's arrays, mapped once per worker; those of other models are let go."""
    folder = uri.rsplit("/", 1)[0]
    if uri not in _open:
        for other in [u for u in _open if not u.startswith(folder)]:
            del _open[other]
        _open[uri] = unpack(mapped(uri))
    return _open[uri]


@dataclass(frozen=True)
class Model:
    """What scoring needs besides the shards. Its size follows the number of word shards."""

    folder: str
    word_shards: int
    offsets: tuple[int, ...]
    total: int
    discount: tuple[float, float]
    pair_shards: int

    @property
    def words(self) -> int:
        return self.offsets[-1]

    def _shard_bits(self) -> int:
        return HASH_BITS - (self.word_shards.bit_length() - 1)

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word ids (-1 if unknown) and counts."""
        ids = np.full(len(hashes), -1, np.int64)
        counts = np.zeros(len(hashes), np.int64)
        home = hashes >> self._shard_bits()
        for shard in np.unique(home):
            size = self.offsets[shard + 1] - self.offsets[shard]
            if not size:
                continue
            arrays = _arrays(f"{self.folder}/words-{shard}")
            rows = np.flatnonzero(home == shard)
            inside = hashes[rows] & ((1 << self._shard_bits()) - 1)
            at, found = EliasFano.of(arrays[:4]).successor(inside)
            rows, at = rows[found], at[found]
            ids[rows] = at + self.offsets[shard]
            counts[rows] = arrays[4][at]
        return ids, counts

    def by_id(self, ids: np.ndarray, kind: str) -> np.ndarray:
        """Counts, or log back-off weights, of known words."""
        out = np.zeros(len(ids), np.int64 if kind == "counts" else np.float64)
        home = np.searchsorted(self.offsets, ids, "right") - 1
        for shard in np.unique(home):
            rows = np.flatnonzero(home == shard)
            at = ids[rows] - self.offsets[shard]
            if kind == "counts":
                out[rows] = _arrays(f"{self.folder}/words-{shard}")[4][at]
            else:
                codes, book = _arrays(f"{self.folder}/backoff-{shard}")
                out[rows] = book[codes[at]]
        return out

    def pair_shard(self, first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The shard of a pair: that of its context. A frequent context's successors are dealt
        out over as many shards as its count asks for."""
        n = self.pair_shards
        pieces = np.minimum(n, 1 + counts * (4 * n) // max(1, self.total))
        piece = second * pieces // max(1, self.words)
        mixed = (first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return ((mixed.astype(np.int64) + piece) % n).astype(np.int64)

    def known_log(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the unigram probability; a count of 0 is the unknown word."""
        if not self.total:
            return np.zeros(len(counts))
        d = self.discount[0]
        p = np.where(counts > 0, np.maximum(counts - d, 0.0), d * self.words) / self.total
        return np.log10(p)


def _batches_of_tokens(batch: pa.RecordBatch, only: str | None = None):
    """Distinct tokens of a batch, the tokens of all texts as places among them, text lengths.

    Each text is its words and END. The token before a text's first word is END, too.
    """
    index: dict[bytes, int] = {END: 0}
    codes: list[int] = []
    sizes: list[int] = []
    texts = batch.column("text")
    keep = batch.column(only).to_pylist() if only else None
    for i in range(len(texts)):
        if keep is None or keep[i]:
            words = tokens(texts[i].as_py())
            codes += [index.setdefault(w, len(index)) for w in words]
            codes.append(0)
            sizes.append(len(words) + 1)
    return list(index), np.array(codes, np.int64), np.array(sizes, np.int64)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((word_hash(w) for w in words), np.int64, len(words))


def _rows(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _word_counts(docs: DataFrame) -> DataFrame:
    """hash and n of the tokens of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words, counts = list(counter), np.array(list(counter.values()), np.int64)
            counter.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(_hashes(words)), pa.array(counts)], ["hash", "n"])

        for batch in batches:
            for text in batch.column("text"):
                words = tokens(text.as_py())
                counter.update(words)
                counter[END] += 1
                if len(counter) > COUNTED_WORDS:
                    yield flush()
        if counter:
            yield flush()

    counted = docs.where("train").select("text").mapInArrow(run, "hash long, n long")
    return counted.groupBy("hash").agg(F.sum("n").alias("n"))


def _grouped(batches: Iterator[pa.RecordBatch], name: str):
    """Consecutive rows with the same value, of input sorted by it: (value, list of batches)."""
    value, parts = None, []
    for batch in batches:
        keys = batch.column(name).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for start, stop in zip(cuts, cuts[1:]):
            if start == stop:
                continue
            if keys[start] != value:
                if parts:
                    yield value, parts
                value, parts = int(keys[start]), []
            parts.append(batch.slice(start, stop - start))
    if parts:
        yield value, parts


def _column(parts: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([p.column(name).to_numpy() for p in parts])


def _write_words(counts: DataFrame, folder: str, shards: int) -> list[int]:
    """Level 1, one file per range of hashes; how many words each has."""
    bits = HASH_BITS - (shards.bit_length() - 1)
    dealt = counts.withColumn("shard", F.shiftright("hash", bits))
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in _grouped(batches, "shard"):
            inside = _column(parts, "hash") & ((1 << bits) - 1)
            coded = EliasFano.build(inside, 1 << bits)
            counts_ = _least(_column(parts, "n"))
            store_bytes(f"{folder}/words-{shard}", pack([*coded.arrays(), counts_]))
            yield _rows(["shard", "n"], [pa.int64(), pa.int64()], [(shard, len(inside))])

    sizes = [0] * shards
    for row in dealt.select("shard", "hash", "n").mapInArrow(run, "shard long, n long").collect():
        sizes[row["shard"]] = row["n"]
    return sizes


def _pair_blocks(docs: DataFrame, model: Model) -> DataFrame:
    """Counts of neighbouring tokens, as sorted blocks of bytes per task and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = _summed(
                np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            held.clear()
            first, second = keys // model.words, keys % model.words
            shard = model.pair_shard(first, second, model.by_id(first, "counts"))
            rows = []
            for s in np.unique(shard):
                at = np.flatnonzero(shard == s)
                gaps, n = _least(np.diff(keys[at], prepend=keys[at[0]])), _least(counts[at])
                rows.append((int(s), int(keys[at[0]]), gaps.tobytes(), gaps.itemsize,
                             n.tobytes(), n.itemsize))
            yield _rows(
                ["shard", "base", "gaps", "gap_bytes", "counts", "count_bytes"],
                [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int32()], rows)

        for batch in batches:
            words, codes, _ = _batches_of_tokens(batch)
            ids, _ = model.ids(_hashes(words))
            now = ids[codes]
            before = np.concatenate([[ids[0]], now[:-1]])
            keys, counts = np.unique(before * model.words + now, return_counts=True)
            held.append((keys, counts))
            if sum(len(k) for k, _ in held) > PAIRS_AT_ONCE:
                yield from flush()
        if held:
            yield from flush()

    return docs.where("train").select("text").mapInArrow(
        run, "shard long, base long, gaps binary, gap_bytes int, counts binary, count_bytes int")


def _decoded(base: int, gaps: bytes, gap_bytes: int) -> np.ndarray:
    steps = np.frombuffer(gaps, f"<u{gap_bytes}").astype(np.int64)
    return np.cumsum(steps) + base


def _merge_pairs(blocks: DataFrame, model: Model) -> DataFrame:
    """Pair counts of each shard as a file; how many successors each context has there.

    Returns a row per pair shard and word shard: home, ids and sizes (of contexts), and once
    per pair shard the number of pairs seen once and twice.
    """
    folder = model.folder
    dealt = blocks.repartition(model.pair_shards, "shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in _grouped(batches, "shard"):
            keys, counts = [], []
            for part in parts:
                for row in part.to_pylist():
                    keys.append(_decoded(row["base"], row["gaps"], row["gap_bytes"]))
                    counts.append(
                        np.frombuffer(row["counts"], f"<u{row['count_bytes']}").astype(np.int64))
            all_keys, all_counts = _summed(np.concatenate(keys), np.concatenate(counts))
            gaps = _least(np.diff(all_keys, prepend=all_keys[0]))
            store_bytes(f"{folder}/counts-{shard}", pack(
                [all_keys[:1], gaps, _least(all_counts)]))
            ids, sizes = np.unique(all_keys // model.words, return_counts=True)
            home = np.searchsorted(model.offsets, ids, "right") - 1
            rows = []
            for k, h in enumerate(np.unique(home)):
                at = np.flatnonzero(home == h)
                rows.append((
                    int(h), ids[at].astype("<i8").tobytes(), sizes[at].astype("<i8").tobytes(),
                    int((all_counts == 1).sum()) if k == 0 else 0,
                    int((all_counts == 2).sum()) if k == 0 else 0))
            yield _rows(["home", "ids", "sizes", "once", "twice"],
                        [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()], rows)

    return dealt.mapInArrow(run, "home long, ids binary, sizes binary, once long, twice long")


def _write_backoff(contexts: DataFrame, model: Model) -> None:
    """The share of each context's probability that is left for words not seen after it."""
    dealt = contexts.select("home", "ids", "sizes").repartition(
        model.word_shards, "home").sortWithinPartitions("home")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, parts in _grouped(batches, "home"):
            start, stop = model.offsets[home], model.offsets[home + 1]
            successors = np.zeros(stop - start, np.int64)
            for part in parts:
                for row in part.to_pylist():
                    ids = np.frombuffer(row["ids"], "<i8") - start
                    np.add.at(successors, ids, np.frombuffer(row["sizes"], "<i8"))
            counts = model.by_id(np.arange(start, stop), "counts")
            weight = model.discount[1] * np.maximum(successors, 1) / counts
            codes, book = _quantised(np.log10(weight))
            store_bytes(f"{model.folder}/backoff-{home}", pack([codes, book]))
            yield _rows(["home"], [pa.int64()], [(home,)])

    dealt.mapInArrow(run, "home long").agg(F.count("home")).collect()


def _write_pairs(spark, model: Model) -> None:
    """Level 2: contexts, pointers, successors and smoothed probabilities of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                try:
                    base, gaps, counts = unpack(mapped(f"{model.folder}/counts-{shard}"))
                except FileNotFoundError:  # a shard no pair falls into
                    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
                else:
                    keys = np.cumsum(gaps.astype(np.int64)) + base[0]
                first, second = keys // max(1, model.words), keys % max(1, model.words)
                contexts, starts = np.unique(first, return_index=True)
                place = np.repeat(np.arange(len(contexts)), np.diff(np.append(starts, len(keys))))
                context_counts = model.by_id(contexts, "counts")[place]
                weight = 10 ** model.by_id(contexts, "backoff")[place]
                lower = 10 ** model.known_log(model.by_id(second, "counts"))
                d = model.discount[1]
                p = np.maximum(counts - d, 0) / np.maximum(context_counts, 1) + weight * lower
                codes, book = _quantised(np.log10(np.minimum(p, 1)))
                store_bytes(f"{model.folder}/pairs-{shard}", pack([
                    *EliasFano.build(contexts, model.words + 1).arrays(),
                    *EliasFano.build(np.append(starts, len(keys)), len(keys) + 1).arrays(),
                    *EliasFano.build(
                        place * model.words + second, max(1, len(contexts)) * model.words).arrays(),
                    codes, book]))
            yield batch

    spark.range(0, model.pair_shards, 1, model.pair_shards).mapInArrow(run, "id long").agg(
        F.count("id")).collect()


def _discount(once: int, twice: int) -> float:
    """Absolute discounting; kept off 0 and 1, where words would lose all or nothing."""
    return min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_where=None) -> Model:
    """A bigram model of the whole texts of the rows `train_where` (a column) picks, or of all.

    P(w | v) = max(c(vw) - d2, 0) / c(v) + d2 n(v) / c(v) P(w), n(v) the number of words seen
    after v. P(w) = (c(w) - d1) / N for a known word and d1 V / N for the unknown one. Every
    count of every text enters; nothing is pruned. Null texts are empty: a lone end.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col) if train_where is None else docs.select(
        F.coalesce(docs[text_col], F.lit("")).alias("text"), train_where.alias("train"))
    if train_where is None:
        rows = rows.select("text", F.lit(True).alias("train"))
    folder = shared_path(spark, "lm")
    counts = written(_word_counts(rows))
    totals = counts.agg(
        F.count("n").alias("words"), F.sum("n").alias("total"),
        F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
    ).first()
    word_shards = 1 << max(0, (max(1, totals["words"]) - 1).bit_length() - WORDS_PER_SHARD.bit_length() + 1)
    sizes = _write_words(counts, folder, word_shards)
    offsets = tuple(int(x) for x in np.concatenate([[0], np.cumsum(sizes)]))
    total = int(totals["total"] or 0)
    model = Model(folder, word_shards, offsets, total,
                  (_discount(totals["once"], totals["twice"]), 0.5),
                  shards_for(total, TOKENS_PER_SHARD))
    if not total:
        return model
    contexts = written(_merge_pairs(_pair_blocks(rows, model), model))
    seen = contexts.agg(F.sum("once").alias("once"), F.sum("twice").alias("twice")).first()
    model = Model(folder, word_shards, offsets, total,
                  (model.discount[0], _discount(seen["once"], seen["twice"])), model.pair_shards)
    _write_backoff(contexts, model)
    _write_pairs(spark, model)
    return model


def _pair_logs(model: Model, before: np.ndarray, now: np.ndarray, before_counts: np.ndarray,
               now_counts: np.ndarray) -> np.ndarray:
    """log10 P(now | before) of pairs; ids are -1 where unknown."""
    out = model.known_log(now_counts)
    known = np.flatnonzero(before >= 0)
    if not len(known):
        return out
    out[known] += model.by_id(before[known], "backoff")
    pairs = known[now[known] >= 0]
    shard = model.pair_shard(before[pairs], now[pairs], before_counts[pairs])
    order = np.argsort(shard, kind="stable")
    pairs, shard = pairs[order], shard[order]
    cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    for start, stop in zip(cuts, np.append(cuts[1:], len(pairs))):
        if start == stop:
            continue
        arrays = _arrays(f"{model.folder}/pairs-{shard[start]}")
        contexts, pointers, successors = (EliasFano.of(arrays[k:k + 4]) for k in (0, 4, 8))
        codes, book = arrays[12:]
        rows = pairs[start:stop]
        ids, back = np.unique(before[rows], return_inverse=True)
        place, found = contexts.successor(ids)
        place[~found] = 0
        if not contexts.n:
            continue
        first, last = pointers.get(place)[back], pointers.get(place + 1)[back]
        rows_found = found[back]
        rows, place = rows[rows_found], place[back][rows_found]
        at, seen = successors.successor(
            place * model.words + now[rows], first[rows_found], last[rows_found])
        out[rows[seen]] = book[codes[at[seen]]]
    return out


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_tokens, n_known, base_score (smoothed unigrams) and score of every whole text.

    Each task maps the shards its texts need and asks for each different pair of a batch
    once. Null texts are empty texts: a lone end. Rows that repeat an id are scored each on its
    own; ids may be null. Extra columns are ignored. Without training texts all scores are 0.
    """
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm = np.log10(model.total + 0.5 * (model.words + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            words, codes, sizes = _batches_of_tokens(batch)
            ids, counts = model.ids(_hashes(words))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            base = (np.log10(counts + 0.5) - norm)[codes]
            known = (counts > 0)[codes]
            before = np.concatenate([[0], codes[:-1]])
            pairs, back = np.unique(before * len(words) + codes, return_inverse=True)
            first, second = pairs // len(words), pairs % len(words)
            logs = np.zeros(len(pairs)) if not model.total else _pair_logs(
                model, ids[first], ids[second], counts[first], counts[second])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes), pa.array(np.add.reduceat(known, starts, dtype=np.int64)),
                 pa.array(np.add.reduceat(base, starts)),
                 pa.array(np.add.reduceat(logs[back], starts))],
                ["id", "n_tokens", "n_known", "base_score", "score"])

    return rows.mapInArrow(
        run, f"id {id_type}, n_tokens long, n_known long, base_score double, score double")


def left_out(doc_id):
    """Whether the model must not learn from a document: crc32(id as text) mod 5 is 1."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == LEFT_OUT


def op5_lm_scoring(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs, train_where=~left_out(F.col("doc_id")))
    return score(docs, model).select(
        F.col("id").alias("doc_id"), left_out(F.col("id")).alias("held_out"), "n_tokens",
        "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
