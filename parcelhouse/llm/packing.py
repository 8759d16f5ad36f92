"""Sum-of-squares packing of tokenized documents into windows of fixed length."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import giving_back, id_and_text, table

# Token ids of chunks of text, kept by each Python worker between tasks.
CACHED_CHUNKS = 700_000
MARKS = ".,;:!?%&$#*|()"
LAST_LATIN = "\u00ff"
_cache: dict[str, dict[str, bytes]] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkTokenizer:
    """Token ids of a text, by chunks between spaces and line feeds.

    The tokenizer drops white space and never joins tokens across it, so equal chunks have
    equal ids. Nor does it join letters with the ASCII marks after them. Each chunk is
    tokenized once and looked up afterwards; the cache is bounded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache = _cache.setdefault(path, {})
        # How the tokenizer writes the bytes of a text before it looks for merges.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.byte_chars = {b: 256 + i for i, b in enumerate(others)}

    def _word(self, word: str) -> bytes:
        """Ids of a run of Latin letters, which normalizing only lower-cases."""
        written = word.lower().encode().decode("latin-1").translate(self.byte_chars)
        return np.array([t.id for t in self.tokenizer.model.tokenize(written)], "<u4").tobytes()

    def _learn(self, chunks: list[str]) -> None:
        cache, words, ends, others = self.cache, {}, {}, []
        for chunk in chunks:
            word = chunk.rstrip(MARKS)
            if word.isalpha() and max(word) <= LAST_LATIN:
                words[chunk] = word
                ends[chunk] = chunk[len(word):]
            else:
                others.append(chunk)
        others += {e for e in ends.values() if e and e not in cache}
        for at in range(0, len(others), 4096):
            part = others[at:at + 4096]
            for chunk, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                cache[chunk] = np.array(e.ids, "<u4").tobytes()
        for chunk, word in words.items():
            ids = cache.get(word)
            if ids is None:
                ids = cache[word] = self._word(word)
            if ends[chunk]:
                cache[chunk] = ids + cache[ends[chunk]]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if text.isascii() and "<|" not in text:
            text = text.lower()
        chunks = text.replace("\n", " ").split(" ")
        cache = self.cache
        distinct = set(chunks)
        new = [c for c in distinct if c not in cache]
        if new:
            if len(cache) + 2 * len(new) > CACHED_CHUNKS:
                cache.clear()
                new = list(distinct)
            self._learn(new)
        return b"".join([cache[c] for c in chunks])


class Packer:
    """Windows filled by the sum-of-squares rule.

    levels[h] counts the open windows holding h ids. A piece of length s goes to the level h
    whose move to h + s leaves the smallest sum of squared counts; h = 0 opens a window, and
    a full window no longer counts. With N the counts, the change of the sum is
    2 (N[h+s] - N[h] + 1), less what level 0 and the full level don't count.
    """

    def __init__(self, size: int):
        self.size = size
        self.levels = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def place(self, piece) -> list | None:
        """Put a piece shorter than a window somewhere; return the window if it is full now."""
        length = piece[2]
        n = self.levels
        change = 2 * (n[length:] - n[:self.size + 1 - length] + 1)
        change[0] = 2 * n[length] + 1
        change[-1] = 1 - 2 * n[self.size - length]
        change[1:][n[1:self.size + 1 - length] == 0] = np.iinfo(np.int64).max
        level = int(np.argmin(change))
        if level:
            window = self.open[level].pop()
            n[level] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        level += length
        if level == self.size:
            return window
        n[level] += 1
        self.n_open += 1
        self.open.setdefault(level, []).append(window)
        return None

    def drain(self) -> list[list]:
        """Close all open windows: the emptiest are cut up to fill the others.

        What is left at last is less than one window. It is cut into sequences whose lengths
        are powers of two, which need no padding.
        """
        left = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        pieces = [p for window in left for p in window]
        total = sum(p[2] for p in pieces)
        sizes = [self.size] * (total // self.size)
        rest = total % self.size
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        self.levels[:] = 0
        self.open, self.n_open = {}, 0
        windows, at, used = [], 0, 0
        for size in sizes:
            window, room = [], size
            while room:
                doc, start, length, ids, total_ids = pieces[at]
                take = min(room, length - used)
                window.append(
                    [doc, start + used, take, ids[4 * used:4 * (used + take)], total_ids])
                used, room = used + take, room - take
                if used == length:
                    at, used = at + 1, 0
            windows.append(window)
        return windows


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4096,
    end_id: int = 2, tokenizer: str | None = None, keep_chunks: bool = True,
) -> DataFrame:
    """Pieces of documents, packed into sequences of at most `size` ids.

    A document is its token ids and `end_id`. Whole windows are cut from long documents; the
    rest of each document is placed online by the sum-of-squares rule, within the input split
    that holds it, so that nothing is shuffled and a lost task gives the same pieces again.
    At the end of a split the windows still open are merged by cutting pieces; sequences
    shorter than `size` are powers of two, a dozen at most per split. Open windows hold ids of
    the split only, so a task never holds more than the ids of its split. `keep_chunks` lets
    workers keep tokenized chunks for their next split: quicker, but they rest with more memory.

    Returns doc_id, start (ids of the document before the piece), length, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset (place in the sequence).

    Null and empty texts are the end id alone. Rows that repeat an id are packed each on its
    own; ids may be null and are only passed on. An empty table gives no piece. Extra columns
    are ignored.
    """
    path = tokenizer or default_tokenizer()
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, "
              "sequence_id long, offset long")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = ChunkTokenizer(path), Packer(size)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 36
        id_arrow = None
        out: list[tuple] = []

        def emit(window: list) -> None:
            nonlocal number
            offset = 0
            for doc, start, length, ids, total in window:
                out.append((doc, start, length, ids, total, number, offset))
                offset += length
            number += 1

        def flush() -> pa.RecordBatch:
            kinds = [id_arrow, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(
                arrays, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            id_arrow = batch.column("id").type
            doc_ids, texts = batch.column("id").to_pylist(), batch.column("text")
            for i, doc in enumerate(doc_ids):
                ids = encoder.ids(texts[i].as_py()) + end
                total = len(ids) // 4
                whole = total - total % size
                for start in range(0, whole, size):
                    emit([[doc, start, size, ids[4 * start:4 * (start + size)], total]])
                if whole < total:
                    full = packer.place([doc, whole, total - whole, ids[4 * whole:], total])
                    if full:
                        emit(full)
                if len(out) >= 2000:
                    yield flush()
        if not keep_chunks:
            encoder.cache.clear()
        for window in packer.drain():
            emit(window)
        if out:
            yield flush()

    return rows.mapInArrow(giving_back(run), schema)


def op9_packing(spark, folder: str) -> DataFrame:
    pieces = pack(table(spark, folder, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")
