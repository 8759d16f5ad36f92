"""Benchmark items in documents, against aligning every item with every whole document."""

import random

import pytest

from parcelhouse.llm import decontamination
from parcelhouse.llm.decontamination import align, contaminated, without_contaminated, words

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "so", "ti", "va") for b in
         ("bar", "den", "fos", "gil", "han", "jut", "kel", "lom", "mar", "nis", "pad", "rok")]
COMMON = "which of the following is the best answer to the question below".split()


def brute_force(rows, items):
    """Every (id, item) whose alignment over the whole text is good enough."""
    found = set()
    for i, text in rows:
        have = words(text or "")
        for item, item_text in items:
            want = words(item_text or "")
            if not want or not have:
                continue
            score, matched, _, _ = align(want, have)
            if score >= len(want) and matched >= min(8, len(want)):
                found.add((i, item))
    return found


def edited(rng, text, share):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text)


def planted(seed, items=12, copies=4):
    """Items with a common opening; verbatim and edited copies between other words."""
    rng = random.Random(seed)
    texts = [COMMON + [rng.choice(WORDS) for _ in range(rng.randint(20, 40))] for _ in range(items)]
    rows, shares = [], {}
    for k, text in enumerate(texts):
        for share in [0, 0] + [0.1, 0.2, 0.3] * copies:
            around = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 60))) for _ in "ab"]
            shares[len(rows), k] = share
            rows.append((len(rows), f"{around[0]} {edited(rng, text, share)} {around[1]}"))
    for _ in range(60):  # the opening alone, and nothing of any item
        rows.append((len(rows), " ".join(COMMON + [rng.choice(WORDS) for _ in range(50)])))
    return rows, [(k, " ".join(t)) for k, t in enumerate(texts)], shares


@pytest.mark.parametrize("rare", [100, 2])
def test_whole_result_and_recall_beside_verbatim_copies(documents, text_spark, monkeypatch, rare):
    monkeypatch.setattr(decontamination, "RARE_TEXTS", rare)
    monkeypatch.setattr(decontamination, "RARE_PARTS", 3)
    rows, items, shares = planted(3)
    benchmark = text_spark.createDataFrame(items, "item_id long, text string")
    found = {(r["id"], r["item"]) for r in contaminated(documents(rows), benchmark).collect()}
    expected = brute_force(rows, items)
    assert found <= expected
    for share in (0, 0.1, 0.2, 0.3):
        meant = {pair for pair in expected if shares.get(pair) == share}
        assert len(found & meant) >= 0.9 * len(meant), share
    clean = {i for i, _ in rows} - {i for i, _ in expected}
    left = {r["doc_id"] for r in without_contaminated(documents(rows), benchmark).collect()}
    assert clean <= left and len(clean) >= 60


@pytest.mark.parametrize("put_in", [6, 12, 18, 30])
def test_words_put_into_a_copy(documents, text_spark, put_in):
    rng = random.Random(put_in)
    item = [rng.choice(WORDS) for _ in range(40)]
    text = item[:20] + [f"x{k}" for k in range(put_in)] + item[20:]
    rows = [(1, " ".join(["before"] * 30 + text + ["after"] * 30))]
    benchmark = text_spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = contaminated(documents(rows), benchmark).collect()
    assert [round(r["score"], 4) for r in found] == [round((80 - put_in) / 80, 4)]


def test_frequent_phrases_are_seeds_in_pairs_only(text_spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "RARE_TEXTS", 3)
    opening = " ".join(COMMON[:4])  # a single 4-gram
    rng = random.Random(9)
    rows = [(i, f"{opening} " + " ".join(rng.choice(WORDS) for _ in range(30))) for i in range(50)]
    items = [(k, f"{opening} " + " ".join(f"w{k}x{j}" for j in range(20))) for k in range(30)]
    schema = "item_id long, text string"
    frame = text_spark.createDataFrame(items, schema)
    parts = decontamination.item_parts(frame, "item_id", "text", 4)
    docs = text_spark.createDataFrame(rows, "id long, text string").selectExpr("xxhash64(text) AS key", "text")
    bits = decontamination.key_filter(parts.selectExpr("gram AS key"))
    hits = decontamination.gram_hits(docs, bits, [4]).join(parts.select("gram").distinct(), "gram")
    assert hits.count() >= 50 and decontamination.seeded_places(hits, parts).isEmpty()


def test_scripts_without_spaces_and_short_items(documents, text_spark):
    items = [
        (1, "東京は日本の首都であり世界最大級の都市です"), (2, "one two three"), (3, "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานคร"),
        (4, "кто был первым человеком в космосе и когда это случилось"), (5, "…"), (6, None), (None, "null item of five words"),
    ]
    rows = [
        (10, "前文。東京は日本の首都であり、世界最大級の都市です。後文"), (11, "say One, two; three now"),
        (12, "x ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานคร y"), (13, "«Кто был первым человеком в космосе — и когда это случилось?»"),
        (14, "one two four three"), (15, "大阪は西日本の都市"), (16, "a null item of five words here"), (17, None),
    ]
    benchmark = text_spark.createDataFrame(items, "item_id long, text string")
    found = {(r["id"], r["item"]) for r in contaminated(documents(rows), benchmark).collect()}
    assert found == {(10, 1), (11, 2), (12, 3), (13, 4), (16, None)}
    # Of an item shorter than a gram only the words as they are count, not "one two four three".
    assert brute_force(rows, items) - found == {(14, 2)}


def test_many_items_in_one_text_and_many_copies(documents, text_spark, monkeypatch):
    monkeypatch.setattr(decontamination, "PARTS_AT_ONCE", 3)
    rng = random.Random(4)
    items = [(k, " ".join(rng.choice(WORDS) for _ in range(12))) for k in range(25)]
    rows = [(i, " ".join(t for _, t in items)) for i in range(40)]
    rows += [(40 + i, "same words again and again " * 2000) for i in range(3)]
    benchmark = text_spark.createDataFrame(items, "item_id long, text string")
    found = [(r["id"], r["item"]) for r in contaminated(documents(rows), benchmark).collect()]
    assert sorted(found) == [(i, k) for i in range(40) for k in range(25)]
