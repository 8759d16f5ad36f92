"""Finds benchmark items in documents: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import giving_back, id_and_text, table, written
from parcelhouse.llm.exact_dedup import key_filter, may_hold

SEED_WORDS = 4
PART_WORDS = 256
# An n-gram of more texts or item parts than this is frequent; it takes a second one to match.
RARE_TEXTS = 100
RARE_PARTS = 10
# How many words later that second n-gram may begin.
REACH = 16
# Item parts looked for in a text at a time.
PARTS_AT_ONCE = 200
SLACK = 8
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
LEAST_MATCHED = 8
CACHED_WORDS = 500_000
_SPACES = bytes(
    b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_word_hashes: dict[bytes, int] = {}


# Scripts that put no spaces between words (Thai to Myanmar, Khmer, kana, Han): every character
# counts as a word. Marks beyond ASCII end a word as those of ASCII do.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
_MARKS = re.compile("[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f\uff00-\uff0f\uff1a-\uff20\uff3b-\uff40]+")


def words(text: str) -> list[bytes]:
    """Lower-cased words without punctuation."""
    text = text.lower()
    if not text.isascii():
        text = _UNSPACED.sub(r" \g<0> ", _MARKS.sub(" ", text))
    return text.encode("utf-8", "surrogatepass").translate(_SPACES).split()


def gram_hashes(parts: list[bytes], n: int) -> np.ndarray:
    """A signed 64-bit hash of each run of n words."""
    if len(parts) < n:
        return np.zeros(0, np.int64)
    cache = _word_hashes
    if len(cache) > CACHED_WORDS:
        cache.clear()
    for word in set(parts):
        if word not in cache:
            cache[word] = xxhash.xxh3_64_intdigest(word)
    each = np.array([cache[w] for w in parts], np.uint64)
    rolled = np.zeros(len(parts) - n + 1, np.uint64)
    for k in range(n):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + each[k:len(parts) - n + 1 + k]
    rolled ^= rolled >> np.uint64(32)
    return (rolled * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def item_parts(benchmark: DataFrame, item_col: str, text_col: str, n: int) -> DataFrame:
    """item, part, part_text (normalised words), n, whole, pos and gram of every n-gram.

    Items longer than PART_WORDS are cut into parts that overlap by half. An item of n words
    or fewer has one gram that is the whole of it.
    """
    rows = id_and_text(benchmark, item_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for item, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                all_words = words(text)
                starts = range(0, max(1, len(all_words) - PART_WORDS // 2), PART_WORDS // 2)
                for part, start in enumerate(starts):
                    these = all_words[start:start + PART_WORDS]
                    joined = b" ".join(these).decode("utf-8", "replace")
                    size = min(n, len(these))
                    if size:
                        grams = gram_hashes(these, size).tolist()
                        out += [(item, part, joined, size, len(grams) == 1, pos, g)
                                for pos, g in enumerate(grams)]
            kinds = [batch.column("id").type, pa.int32(), pa.string(), pa.int32(), pa.bool_(),
                     pa.int32(), pa.int64()]
            arrays = [pa.array([r[k] for r in out], kinds[k]) for k in range(len(kinds))]
            yield pa.RecordBatch.from_arrays(
                arrays, ["item", "part", "part_text", "n", "whole", "pos", "gram"])

    return rows.mapInArrow(
        run, f"item {id_type}, part int, part_text string, n int, whole boolean, pos int, gram long")


def gram_hits(docs: DataFrame, bits: bytes, sizes: list[int]) -> DataFrame:
    """key, gram and pos of the texts' n-grams, of each size, that a filter lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, grams = ([np.zeros(0, np.int64)] for _ in range(3))
            texts = batch.column("text")
            for i in range(len(texts)):
                parts = words(texts[i].as_py())
                for n in sizes:
                    found = gram_hashes(parts, n)
                    at = np.flatnonzero(may_hold(bits, found))
                    if len(at):
                        rows.append(np.full(len(at), i))
                        places.append(at)
                        grams.append(found[at])
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(take), pa.array(np.concatenate(grams)),
                 pa.array(np.concatenate(places).astype(np.int32))],
                ["key", "gram", "pos"])

    return docs.select("key", "text").mapInArrow(
        giving_back(run), "key long, gram long, pos int")


def seeded_places(hits: DataFrame, items: DataFrame) -> DataFrame:
    """key, item, part, part_text and diagonal of every seed that texts and items share.

    A rare n-gram is a seed by itself. Two frequent ones are a seed where an item has the same
    two as far apart, so that a phrase which many texts and items hold gives no rows alone.
    Equal texts count as one, so copies make no n-gram frequent. An item that is a single
    gram is looked for by that.
    """
    texts = hits.select("gram", "key").distinct().groupBy("gram").agg(F.count("key").alias("texts"))
    parts = items.groupBy("gram").agg(
        F.count_distinct("item", "part").alias("parts"))
    kinds = written(parts.join(texts, "gram").select(
        "gram", ((F.col("texts") <= RARE_TEXTS) & (F.col("parts") <= RARE_PARTS)).alias("rare")))
    seeds = items.select(
        "item", "part", "part_text", F.col("pos").alias("at"), "gram", "whole").join(kinds, "gram")
    alone = hits.join(seeds.where("rare OR whole").drop("rare", "whole"), "gram").select(
        "key", "item", "part", "part_text", (F.col("pos") - F.col("at")).alias("diagonal"))

    frequent = written(hits.join(kinds.where("NOT rare").select("gram"), "gram"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(REACH))).alias("step")
    first = frequent.select("key", "pos", F.col("gram").alias("one"), steps).withColumn(
        "next", F.col("pos") + F.col("step"))
    second = frequent.select("key", F.col("pos").alias("next"), F.col("gram").alias("other"))
    in_texts = first.join(second, ["key", "next"]).select("key", "pos", "one", "other", "step")
    common = seeds.where("NOT rare").drop("rare", "whole")
    ahead = common.select(
        F.col("item").alias("same_item"), F.col("part").alias("same_part"),
        F.col("at").alias("next"), F.col("gram").alias("other"))
    in_items = common.withColumnRenamed("gram", "one").select("*", steps).join(
        ahead, F.col("item").eqNullSafe(F.col("same_item")) & (F.col("part") == F.col("same_part"))
        & (F.col("at") + F.col("step") == F.col("next"))
    ).select("item", "part", "part_text", "at", "one", "other", "step")
    paired = in_texts.join(in_items, ["one", "other", "step"]).select(
        "key", "item", "part", "part_text", (F.col("pos") - F.col("at")).alias("diagonal"))
    return alone.unionByName(paired)


def _only(rows: DataFrame, bits: bytes) -> DataFrame:
    """The rows whose key the filter lets pass. The filter stays out of the query plan, which
    the driver keeps as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(bits, batch.column("key").to_numpy())))

    return rows.mapInArrow(run, rows.schema)


def align(item: list, passage: list) -> tuple[int, int, int, int]:
    """Smith-Waterman over words: best score, matched words, start and stop in the passage."""
    codes: dict = {}
    a = np.array([codes.setdefault(w, len(codes)) for w in item])
    b = np.array([codes.setdefault(w, len(codes)) for w in passage])
    table_ = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    slope = -GAP * np.arange(len(b) + 1)
    for i in range(1, len(a) + 1):
        step = np.where(b == a[i - 1], MATCH, MISMATCH)
        best = np.maximum(table_[i - 1] + GAP, 0)
        best[1:] = np.maximum(best[1:], table_[i - 1, :-1] + step)
        best[0] = 0
        # A gap in the item: the best earlier cell, less the gap's length.
        table_[i] = np.maximum.accumulate(best + slope) - slope
    i, j = np.unravel_index(int(table_.argmax()), table_.shape)
    score, stop, matched = int(table_[i, j]), int(j), 0
    while i and j and table_[i, j] > 0:
        same = a[i - 1] == b[j - 1]
        if table_[i, j] == table_[i - 1, j - 1] + (MATCH if same else MISMATCH):
            matched += bool(same)
            i, j = i - 1, j - 1
        elif table_[i, j] == table_[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, matched, int(j), stop


def best_alignment(item: list[bytes], text: list[bytes], diagonals: list[int], least: float = 0):
    """The best alignment of an item near the diagonals its seeds lie on: score from 0 to 1,
    matched words, start and stop among the words of the text.

    Seeds up to the item's length apart in their diagonals are aligned together, as words put
    into a copy move what follows; more of them would cost a copy half its score. Passages
    that share too few words with the item to reach `least` matches are left out.
    """
    best = (0.0, 0, 0, 0)
    bag = Counter(item)
    diagonals = sorted(diagonals)
    done = 0
    for first, low in enumerate(diagonals):
        after = bisect_right(diagonals, low + len(item), first)
        if after <= done:
            continue  # all of these have been aligned together with an earlier one
        done = after
        start = max(0, low - SLACK)
        passage = text[start:diagonals[after - 1] + len(item) + SLACK]
        if (bag & Counter(passage)).total() < least:
            continue
        score, matched, begin, stop = align(item, passage)
        best = max(best, (score / (MATCH * len(item)), matched, start + begin, start + stop))
    return best


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", n: int = SEED_WORDS,
    least_score: float = LEAST_SCORE, least_matched: int = LEAST_MATCHED,
) -> DataFrame:
    """The documents that hold a benchmark item or an edited copy of it, and where.

    Rare n-grams of an item are seeds, and frequent ones in pairs (see seeded_places). Where
    seeds meet a text, the item is aligned with the words around (match 2, mismatch and gap
    -1). The score is the alignment's share of a perfect one; `least_score`, and
    `least_matched` words or the whole of a shorter item, make a document contaminated. Long
    items are tested in parts, documents whole. A copy that shares no n-gram with the item is
    not found.

    Document n-grams pass a filter of fixed size (1 MB) where they are read, so that few
    rows are shuffled; the join behind it is exact. Returns id, key (a hash of the text),
    item, score, matched, start, stop and passage, the best part of each item.

    Null texts are empty texts; items without words match nothing. Items of fewer than n
    words are looked for as they are. Rows that repeat an id and a text give one row. Null
    ids are kept. Either table may be empty. Extra columns are ignored.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    items = written(item_parts(benchmark, item_col, item_text_col, n))
    bits = key_filter(items.select(F.col("gram").alias("key")))
    sizes = sorted(r["n"] for r in items.select("n").distinct().collect())  # n and less
    grams = items.select("gram").distinct()
    hits = written(gram_hits(rows, bits, sizes).dropDuplicates().join(grams, "gram", "left_semi"))
    # At most one diagonal per word of a text and item that shares a seed there.
    near = written(
        seeded_places(hits, items).groupBy("key", "item", "part", "part_text")
        .agg(F.collect_set("diagonal").alias("diagonals")))
    # The items of a text come in portions, so that no row holds all of them.
    portions = near.groupBy("key").agg(F.ceil(F.count("part") / PARTS_AT_ONCE).alias("portions"))
    places = written(
        near.join(portions, "key")
        .groupBy("key", F.pmod(F.xxhash64("item"), F.col("portions")).alias("portion"))
        .agg(F.collect_list(F.struct("item", "part", "part_text", "diagonals")).alias("places"))
    )
    few = key_filter(places.select("key"))
    wanted = places.select(F.col("key").alias("__pc_key"), "places")
    texts = _only(rows.select("id", "text", "key"), few).join(
        wanted, F.col("key") == F.col("__pc_key")).select("id", "key", "text", "places")
    types = {"id": rows.schema["id"].dataType.simpleString(),
             "item": items.schema["item"].dataType.simpleString()}
    schema = (f"id {types['id']}, key long, item {types['item']}, score double, matched int, "
              "start int, stop int, passage string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            kinds = [batch.column("id").type, pa.int64(), batch.column("places").type.value_type.field("item").type,
                     pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            for i in range(batch.num_rows):
                text = words(batch.column("text")[i].as_py())
                best: dict = {}
                for place in batch.column("places")[i].as_py():
                    item, part = place["item"], place["part_text"].encode().split()
                    least = max(least_score * len(part) - 1e-9, min(least_matched, len(part)))
                    found = best_alignment(part, text, place["diagonals"], least)
                    enough = found[0] >= least_score and found[1] >= min(least_matched, len(part))
                    if enough and found > best.get(item, (0.0,)):
                        best[item] = found
                for item, (score, matched, start, stop) in best.items():
                    passage = b" ".join(text[start:stop]).decode("utf-8", "replace")
                    out.append((batch.column("id")[i].as_py(), batch.column("key")[i].as_py(), item,
                                score, matched, start, stop, passage))
            arrays = [pa.array([r[k] for r in out], kinds[k]) for k in range(len(kinds))]
            yield pa.RecordBatch.from_arrays(
                arrays, ["id", "key", "item", "score", "matched", "start", "stop", "passage"])

    return texts.mapInArrow(run, schema).dropDuplicates(["id", "key", "item"])


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The documents that hold no benchmark item, all their columns kept."""
    found = contaminated(docs, benchmark, id_col, text_col, **options)
    found = found.select(F.col("id").alias("__pc_id"), F.col("key").alias("__pc_key")).distinct()
    key = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(found, docs[id_col].eqNullSafe(F.col("__pc_id")) & (key == F.col("__pc_key")), "left_anti")


def op3_decontamination(spark, folder: str) -> DataFrame:
    found = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score", "matched", "start",
        "stop", "passage")
