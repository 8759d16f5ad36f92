"""Alignment of two tokenizers against a plain count over token pairs."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelhouse.llm import cross_tokenizer
from parcelhouse.llm.cross_tokenizer import (
    Postings, align_tokenizers, aligned_blocks, default_tokenizers, op11_cross_tokenizer,
    pair_counts)

ODD = [
    (1, "The quick brown fox"), (1, "The quick brown fox"), (2, None), (3, ""), (4, " "), (None, "null id"),
    (None, None), (5, "tab\there\r\n\n  lines "), (6, "naïve café – “quotes” €"), (7, "日本語のテキスト 漢字"),
    (8, "emoji 👩‍👩‍👧 🏳️‍🌈 x"), (9, "▁ already marked"), (10, "<|endoftext|> </s> <unk> <0x41>"),
    (11, "a" * 5000), (12, "long words repeat, " * 20_000), (13, "\u0000 zero ﻿ mark"), (14, "१२३ Ελληνικά"),
    (15, "é combining"), (16, "    four"), (17, "x"),
]


def plain_encodings(texts):
    """(A ids, B ids, A byte lengths, B byte lengths) of each text, one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = default_tokenizers()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    # Visible characters that stand for the bytes of a byte-level vocabulary.
    visible, extra = {}, 256
    for byte in range(256):
        if byte in range(33, 127) or byte in range(161, 173) or byte in range(174, 256):
            visible[chr(byte)] = byte
        else:
            visible[chr(extra)] = byte
            extra += 1

    def bytes_b(i):
        piece = b.id_to_piece(i)
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes.fromhex(piece[3:5])
        return piece.replace("▁", " ").encode()

    for text in texts:
        if not text:
            yield [], [], [], []
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        parts_a = [bytes(visible[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [bytes_b(i) for i in ids_b]
        whole = (" " + text).encode()
        if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            yield [], [], [], []
        else:
            yield ids_a, ids_b, [len(x) for x in parts_a], [len(x) for x in parts_b]


def brute_force(rows):
    linked, shown = [], []
    for a, b, len_a, len_b in plain_encodings([t for _, t in rows]):
        ends_a, ends_b = np.cumsum(len_a).tolist(), np.cumsum(len_b).tolist()
        links, j = [], 0
        for i in range(len(a)):
            start, end = ends_a[i] - len_a[i], ends_a[i]
            while ends_b[j] <= start:
                j += 1
            k = j
            while k < len(b) and ends_b[k] - len_b[k] < end:
                links.append((a[i], b[k]))
                k += 1
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, at_a, at_b = [], 0, 0
        for cut in cuts:
            to_a, to_b = ends_a.index(cut, at_a) + 1, ends_b.index(cut, at_b) + 1
            groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        linked.append(links)
        shown.append((len(a), len(b), len(groups), ";".join(groups)))
    count = Counter(p for links in linked for p in links)
    holders = Counter(p for links in linked for p in set(links))
    best = defaultdict(int)
    for (_, b_id), n in count.items():
        best[b_id] = max(best[b_id], n)
    out = []
    for (doc, _), links, (n_a, n_b, n_groups, text) in zip(rows, linked, shown):
        out.append((doc, n_a, n_b, n_groups, len(links), sum(count[p] == best[p[1]] for p in links),
                    sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    pairs = {(a, b, holders[a, b], n, n == best[b]) for (a, b), n in count.items()}
    return sorted(out, key=repr), pairs


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in {"LINKS_PER_BLOCK": 500, "TEXTS_AT_ONCE": 100}.items():
        monkeypatch.setattr(cross_tokenizer, name, value)


def test_odd_texts(documents):
    found = align_tokenizers(documents(ODD))
    assert sorted([tuple(r) for r in found.collect()], key=repr) == brute_force(ODD)[0]


def test_whole_table_and_pairs(text_spark, small):
    rows = [(r["doc_id"], r["text"]) for r in text_spark.read.parquet(f"{small}/documents.parquet").collect()]
    expected, pairs = brute_force(rows)
    found = op11_cross_tokenizer(text_spark, small).collect()
    assert sorted([tuple(r) for r in found], key=repr) == expected
    blocks = aligned_blocks(text_spark.read.parquet(f"{small}/documents.parquet"))
    got = pair_counts(blocks).select("a_id", "b_id", "documents", "links", "best").collect()
    assert {tuple(r) for r in got} == pairs and len(got) == len(pairs)


def test_many_small_blocks(documents, small_blocks):
    rows = ODD + [(100 + i, "one common passage " * (i % 7) + f"number {i}") for i in range(150)]
    docs = documents(rows).repartition(3)
    found = align_tokenizers(docs).collect()
    assert sorted([tuple(r) for r in found], key=repr) == brute_force(rows)[0]


def test_no_documents_and_only_empty_ones(documents):
    assert align_tokenizers(documents([])).isEmpty()
    found = align_tokenizers(documents([(1, None), (2, "")])).collect()
    assert sorted(tuple(r) for r in found) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_rank_encoder_gives_the_tokenizers_ids():
    """On every character between letters, digits, marks and spaces, and on random strings."""
    both = cross_tokenizer.aligner(*default_tokenizers())
    assert both.ranks is not None
    characters = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c} {c}1{c}.{c}\n{c}{c}" for c in characters]
    rng = np.random.default_rng(5)
    marks = [" ", "  ", "\n", "\t", "\r\n", "'s", "'LL", "1", ".", "é", "ß", "ж", "の", "👍", "\u0301", "ab", "the", "ing"]
    texts += ["".join(rng.choice(marks, rng.integers(1, 60))) for _ in range(20_000)]
    encoded = both.a.encode_batch(texts, add_special_tokens=False)
    assert all(both.ranks.encode_ordinary(t) == e.ids for t, e in zip(texts, encoded))


@pytest.mark.parametrize("docs", [1, 5, 40, 300])
def test_postings_round_trip(docs):
    rng = np.random.default_rng(docs)
    per_doc = [Counter(rng.zipf(1.3, rng.integers(0, 60)).tolist()) for _ in range(docs)]
    parts = [np.array(sorted(c.items()), np.int64).reshape(-1, 2).T for c in per_doc]
    pairs, postings = Postings.merged([(p[0], p[1]) for p in parts])
    again = Postings.loaded(docs, postings.stored())
    total, held = Counter(), Counter()
    for c in per_doc:
        total.update(c)
        held.update(c.keys())
    assert pairs.tolist() == sorted(total)
    for some in (postings, again):
        documents, links = some.counts(len(pairs))
        assert documents.tolist() == [held[p] for p in sorted(total)]
        assert links.tolist() == [total[p] for p in sorted(total)]
        assert some.returned(links).tolist() == [sum(n * total[p] for p, n in c.items()) for c in per_doc]
