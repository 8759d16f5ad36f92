"""Alignment of two tokenizers over the same text, with corpus-wide counts of linked id pairs.

Documents are numbered within blocks. For each pair of ids a block holds an inverted posting:
a compressed bitmap of the documents that link the pair, and planes of the same kind for the
binary digits of how often they do. The bitmaps count a pair's documents, with the planes its
links. The postings then return the corpus-wide counts of each pair to the documents.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelhouse.llm.common import id_and_text, shared_path, table

# A block ends after so many links or documents, whichever comes first.
LINKS_PER_BLOCK = 1_000_000
DOCS_PER_BLOCK = 1 << 14
TEXTS_AT_ONCE = 1 << 20
B_IDS = 1 << 20
# Fixed value: how byte-level vocabularies of this kind split a text before they merge bytes.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# A plane that holds more than one document in so many is kept as bits.
DENSE_SHARE = 16


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _rank_encoder(tokenizer, bytes_of: list[bytes]):
    """A faster encoder of the same vocabulary, or None where it might give other ids.

    It joins the neighbours whose joined bytes have the smallest id. That is the order of the
    merges if they are listed by the id they give. Nor does it matter that it asks for joined
    bytes instead of a listed pair: as long as nothing is joined across the ends of a token's
    bytes, they go the way they go alone, which ends with the listed pair.
    """
    import tiktoken

    spec = json.loads(tokenizer.to_str())
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE" and not spec["normalizer"] and split.get("type") == "ByteLevel"
        and split.get("use_regex", True) and not split["add_prefix_space"]
        and not any(model.get(k) for k in (
            "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    if not plain:
        return None
    made = [model["vocab"]["".join(m)] for m in merges]
    single = {i for i, data in enumerate(bytes_of) if len(data) == 1}
    if len(single) != 256 or made != sorted(made) or made[:1] < [max(single)]:
        return None
    ranks = {bytes_of[i]: i for i in (*single, *made)}
    return tiktoken.Encoding(
        "ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Token ids of two tokenizers and the bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = self._bytes_of_a()
        self.ranks = _rank_encoder(self.a, self.bytes_a)
        self.bytes_b = [self._bytes_of_b(i) for i in range(self.b.get_piece_size())]
        if len(self.bytes_b) > B_IDS:
            raise ValueError(f"the second tokenizer has more than {B_IDS} ids")
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # An id in decimal digits, with the mark that may follow it.
        self.shown_a = [f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"]
        self.shown_b = [f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"]

    def _bytes_of_a(self) -> list[bytes]:
        """Byte-level vocabularies write a byte as a visible character; this reads it back."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = self.a.get_vocab()
        found = [b""] * (1 + max(vocabulary.values()))
        for entry, i in vocabulary.items():
            if all(c in byte_of for c in entry):
                found[i] = bytes(byte_of[c] for c in entry)
        return found

    def _bytes_of_b(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by both; none where either does not give back space + text."""
        spaced = [" " + t for t in texts]
        if self.ranks:
            ids_a = [self.ranks.encode_ordinary(t) for t in spaced]
        else:
            encoded = self.a.encode_batch_fast(spaced, add_special_tokens=False)
            ids_a = [e.ids for e in encoded]
        ids_b = self.b.encode(texts, num_threads=1)
        for k, text in enumerate(texts):
            whole = spaced[k].encode()
            if (not text or b"".join([self.bytes_a[i] for i in ids_a[k]]) != whole
                    or b"".join([self.bytes_b[i] for i in ids_b[k]]) != whole):
                ids_a[k], ids_b[k] = [], []
        return [np.array(x, np.int64) for x in ids_a], [np.array(x, np.int64) for x in ids_b]

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int, str]:
        """(linked pairs, number of groups, groups as text) of one document's ids.

        Tokens are byte ranges side by side, so between one end of a token (of either side)
        and the next lies exactly one overlapping pair: one link per different end.
        """
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        over_a, over_b = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)
        last_a, last_b = end_b[over_a] == end_a, end_a[over_b] == end_b
        alone = ~last_b
        pairs = np.concatenate([a * B_IDS + b[over_a], a[over_b[alone]] * B_IDS + b[alone]])
        # The A ids of a group come after all B ids of earlier groups, and so on.
        first_a = np.concatenate([[0], np.flatnonzero(last_a) + 1])
        first_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        place = np.empty(len(a) + len(b), np.int64)
        place[np.arange(len(a)) + first_b[group_a]] = 2 * a + last_a
        place[np.arange(len(b)) + first_a[group_b + 1]] = -1 - (2 * b + last_b)
        shown_a, shown_b = self.shown_a, self.shown_b
        text = "".join([shown_a[x] if x >= 0 else shown_b[-1 - x] for x in place.tolist()])
        return pairs, len(first_a) - 1, text[:-1]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """Kept by each Python worker between tasks."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


class Postings:
    """For each pair linked in a block: which of its documents link it, and how often.

    Plane 0 of a pair is the bitmap of its documents. Plane k is the bitmap of those whose
    number of links, less one, has binary digit k - 1; most pairs have no such plane. A plane
    of many documents is kept as bits, one of few as an ascending list.
    """

    FIELDS = {
        "dense_pair": "<i4", "dense_plane": "u1", "bits": "u1",
        "sparse_pair": "<i4", "sparse_plane": "u1", "sizes": "<i4", "listed": "<u2",
    }

    def __init__(self, docs: int, **fields: np.ndarray):
        self.docs, self.fields = docs, fields
        self.bits = fields["bits"].reshape(-1, -(-docs // 8))
        self.dense_pair, self.sparse_pair = fields["dense_pair"], fields["sparse_pair"]
        self.sizes, self.listed = fields["sizes"], fields["listed"]
        self.dense_weight = self._weight(fields["dense_plane"])
        self.sparse_weight = self._weight(fields["sparse_plane"])

    @staticmethod
    def _weight(plane: np.ndarray) -> np.ndarray:
        return np.int64(1) << np.maximum(plane.astype(np.int64) - 1, 0)

    @classmethod
    def merged(cls, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, Postings]:
        """Pairs in ascending order, and postings of them, from one part per document.

        A part holds the document's different pairs and how often each is linked. The bits of
        all parts of a pair are or-ed together.
        """
        docs = len(parts)
        empty = [np.empty(0, np.int64)]
        pair = np.concatenate(empty + [p for p, _ in parts])
        over = np.concatenate(empty + [c for _, c in parts]) - 1
        doc = np.repeat(np.arange(docs), [len(p) for p, _ in parts])
        pairs, number = np.unique(pair, return_inverse=True)
        planes = 1 + int(over.max(initial=0)).bit_length()
        held = [np.arange(len(pair))] + [np.flatnonzero(over >> k & 1) for k in range(planes - 1)]
        key = np.concatenate([number[at] * planes + k for k, at in enumerate(held)])
        doc = np.concatenate([doc[at] for at in held])
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        sizes = np.diff(heads, append=len(key))
        dense = sizes * DENSE_SHARE > docs
        many = np.repeat(dense, sizes)
        row = np.repeat(np.cumsum(dense) - 1, sizes)[many]
        bits = np.zeros((int(dense.sum()), -(-docs // 8)), np.uint8)
        of = doc[many]
        np.bitwise_or.at(bits, (row, of >> 3), (128 >> (of & 7)).astype(np.uint8))
        head = key[heads]
        return pairs, cls(
            docs, dense_pair=head[dense] // planes, dense_plane=head[dense] % planes, bits=bits,
            sparse_pair=head[~dense] // planes, sparse_plane=head[~dense] % planes,
            sizes=sizes[~dense], listed=doc[~many])

    def stored(self) -> list[bytes]:
        return [self.fields[name].astype(kind).tobytes() for name, kind in self.FIELDS.items()]

    @classmethod
    def loaded(cls, docs: int, stored: list[bytes]) -> Postings:
        return cls(docs, **{
            name: np.frombuffer(data, kind).astype(kind if name == "bits" else np.int64)
            for (name, kind), data in zip(cls.FIELDS.items(), stored)
        })

    def counts(self, pairs: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, links) of each pair: bits set in plane 0, and in all planes by weight."""
        documents, links = np.zeros((2, pairs), np.int64)
        set_bits = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        np.add.at(links, self.dense_pair, set_bits * self.dense_weight)
        np.add.at(links, self.sparse_pair, self.sizes * self.sparse_weight)
        first = self.fields["dense_plane"] == 0
        documents[self.dense_pair[first]] = set_bits[first]
        first = self.fields["sparse_plane"] == 0
        documents[self.sparse_pair[first]] = self.sizes[first]
        return documents, links

    def returned(self, value: np.ndarray) -> np.ndarray:
        """For each document the values of its links' pairs, added up."""
        found = np.zeros(self.docs, np.int64)
        per_entry = value[self.sparse_pair] * self.sparse_weight
        np.add.at(found, self.listed, np.repeat(per_entry, self.sizes))
        per_row = value[self.dense_pair] * self.dense_weight
        portion = max(1, (1 << 20) // max(1, self.docs))
        for at in range(0, len(per_row), portion):
            row, doc = np.nonzero(np.unpackbits(self.bits[at:at + portion], axis=1, count=self.docs))
            np.add.at(found, doc, per_row[at:at + portion][row])
        return found


def _block_schema(id_type: str) -> str:
    postings = ", ".join(f"{name} binary" for name in Postings.FIELDS)
    return (f"block long, ids array<{id_type}>, n_a array<long>, n_b array<long>, "
            "n_groups array<long>, groups_sha256 array<string>, pairs array<long>, "
            f"documents array<long>, links array<long>, {postings}")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, about TEXTS_AT_ONCE characters at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        column = batch.column("text")
        for k, doc in enumerate(batch.column("id").to_pylist()):
            ids.append(doc)
            texts.append(column[k].as_py())
            size += len(texts[-1])
            if size >= TEXTS_AT_ONCE:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def aligned_blocks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    path_a: str | None = None, path_b: str | None = None,
) -> DataFrame:
    """Blocks of documents with their figures and postings, written to the shared folder.

    Texts are read and encoded once. A block lies in one task and holds LINKS_PER_BLOCK links
    (of whole documents) or DOCS_PER_BLOCK documents, so it stays small whatever repeats.
    """
    default_a, default_b = default_tokenizers() if not (path_a and path_b) else ("", "")
    path_a, path_b = path_a or default_a, path_b or default_b
    rows = id_and_text(docs, id_col, text_col)
    schema = _block_schema(rows.schema["id"].dataType.simpleString())
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        figures: list[tuple] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        id_arrow, links = None, 0

        def block() -> pa.RecordBatch:
            nonlocal number, links
            pairs, postings = Postings.merged(parts)
            documents, counted = postings.counts(len(pairs))
            ids, n_a, n_b, n_groups, digests = zip(*figures)
            long = pa.list_(pa.int64())
            values = [
                pa.array([number]), pa.array([ids], pa.list_(id_arrow)), pa.array([n_a], long),
                pa.array([n_b], long), pa.array([n_groups], long),
                pa.array([digests], pa.list_(pa.string())), pa.array([pairs], long),
                pa.array([documents], long), pa.array([counted], long),
                *[pa.array([data], pa.binary()) for data in postings.stored()],
            ]
            number, links = number + 1, 0
            parts.clear()
            figures.clear()
            return pa.RecordBatch.from_arrays(values, names)

        def typed(batches):
            nonlocal id_arrow
            for batch in batches:
                id_arrow = batch.column("id").type
                yield batch

        for ids, texts in _texts(typed(batches)):
            for doc, a, b in zip(ids, *both.ids(texts)):
                if len(a):
                    pairs, n_groups, shown = both.aligned(a, b)
                    digest = hashlib.sha256(shown.encode()).hexdigest()
                else:
                    pairs, n_groups, digest = a, 0, ""
                parts.append(np.unique(pairs, return_counts=True))
                figures.append((doc, len(a), len(b), n_groups, digest))
                links += len(pairs)
                if links >= LINKS_PER_BLOCK or len(parts) >= DOCS_PER_BLOCK:
                    yield block()
        if parts:
            yield block()

    folder = shared_path(docs.sparkSession, "aligned")
    rows.mapInArrow(run, schema).write.parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Per linked id pair: pair, a_id, b_id, documents, links, best.

    `best` says whether no other pair of the B id has more links. A block adds one row per
    pair, summed before the shuffle; a B id has at most as many rows as there are A ids.
    """
    entries = blocks.select(F.inline(F.arrays_zip("pairs", "documents", "links")))
    totals = entries.groupBy(F.col("pairs").alias("pair")).agg(
        F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    of_b = Window.partitionBy("b_id")
    return totals.select(
        "pair", F.shiftright("pair", B_IDS.bit_length() - 1).alias("a_id"),
        F.col("pair").bitwiseAND(B_IDS - 1).alias("b_id"), "documents", "links",
    ).withColumn("best", F.col("links") == F.max("links").over(of_b))


def document_scores(blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per document its figures, and what the postings return of the pairs' counts.

    A block sends the pairs it holds, not its postings, to the counts. What comes back is at
    most a row per pair of the block, ordered by the pair's place there.
    """
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()
    asked = blocks.select(F.col("block").alias("asking"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pairs.select("pair", "links", "best"), "pair").select(
        "asking", "place", "links", F.col("best").cast("long").alias("best"))
    fields = list(Postings.FIELDS)
    held = blocks.select("block", "ids", "n_a", "n_b", "n_groups", "groups_sha256", *fields)

    def score(block: pa.Table, found: pa.Table) -> pa.Table:
        row = block.slice(0, 1)
        ids = row.column("ids").combine_chunks().flatten()
        n_a, n_b, n_groups = (
            row.column(c).combine_chunks().flatten().to_numpy() for c in ("n_a", "n_b", "n_groups"))
        postings = Postings.loaded(len(ids), [row.column(f)[0].as_py() for f in fields])
        place = found.column("place").to_numpy()
        links, best = np.zeros((2, len(place)), np.int64)
        links[place], best[place] = found.column("links").to_numpy(), found.column("best").to_numpy()
        return pa.table({
            "doc_id": ids, "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
            "n_links": postings.returned(np.ones(len(place), np.int64)),
            "n_best": postings.returned(best), "count_sum": postings.returned(links),
            "groups_sha256": row.column("groups_sha256").combine_chunks().flatten(),
        })

    return held.groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(
        score, f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups_sha256 string")


def align_tokenizers(docs: DataFrame, **named: str) -> DataFrame:
    """Per document how its tokens of two tokenizers overlap, and how common its links are.

    Arguments as in aligned_blocks. Returns doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256. Groups are cut where tokens of both end; a link is a pair of
    overlapping tokens; the count of an id pair is its number of links in all documents;
    n_best are the links whose pair no other pair of the same B id exceeds.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte,
    have zeros and an empty digest. Every row is a document of its own, also where ids repeat
    or are null. An empty table gives no row. Extra columns are ignored.
    """
    blocks = aligned_blocks(docs, **named)
    return document_scores(blocks, pair_counts(blocks))


def op11_cross_tokenizer(spark, folder: str) -> DataFrame:
    return align_tokenizers(table(spark, folder, "documents"))
