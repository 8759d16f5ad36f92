"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import id_and_text, table, written
from parcelhouse.llm.labelled import held_out, training_sample

FEATURES = (
    "lexicon_density", "lexicon_hits", "lexicon_kinds", "lexicon_weight", "stem_rate",
    "disguised_rate", "second_person_rate", "near_second_person", "capital_rate", "shouted_rate", "exclamation_rate", "mark_rate",
    "digit_rate",
)
# The sample the model is fitted on: at most so many documents of at most so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 8000, 32_768
TREES, DEPTH = 12, 3
REACH = 3
CACHED_WORDS = 500_000
# How letters are disguised, and the second person in the corpus' languages.
DISGUISES = str.maketrans("0134578@$!|", "oieastbasil")
SECOND_PERSON = frozenset(
    "you your yours u ur yourself du dich dir dein deine ihr euch euer tu te toi ton ta vous "
    "votre vos tú ti usted ustedes vosotros".split())
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
INNER = re.compile(r"[\W_]+")
LEXICON, DISGUISED, SECOND, SHOUTED, STEM = 1, 2, 4, 8, 16
# Beginnings of so many letters stand for all words made from them.
STEM_SIZES = range(4, 10)
LEAST_ODDS = 3


@dataclass
class Lexicon:
    """Words and beginnings of words that mark toxic texts, with their log odds, and what
    each chunk of a text is."""

    words: dict[str, float]
    stems: dict[str, float] = field(default_factory=dict)
    _seen: dict[str, tuple[int, str, float]] = field(default_factory=dict)

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "_seen": {}}

    def kind(self, chunk: str) -> tuple[int, str, float]:
        found = self._seen.get(chunk)
        if found is None:
            if len(self._seen) > CACHED_WORDS:
                self._seen.clear()
            found = self._seen[chunk] = self._kind(chunk)
        return found

    def _kind(self, chunk: str) -> tuple[int, str, float]:
        core = EDGES.sub("", chunk)
        word = core.lower()
        flags = SHOUTED if len(core) > 1 and core.isupper() else 0
        if word in SECOND_PERSON:
            flags |= SECOND
        if word in self.words:
            return flags | LEXICON, word, self.words[word]
        # i-d-i-o-t, 1d1ot, idiiiot
        plain = INNER.sub("", chunk.lower().translate(DISGUISES))
        for guess in (plain, INNER.sub("", word), re.sub(r"(.)\1+", r"\1", plain)):
            if guess != word and guess in self.words:
                return flags | LEXICON | DISGUISED, guess, self.words[guess]
        stems = [word[:k] for k in STEM_SIZES if k < len(word) and word[:k] in self.stems]
        if stems:
            best = max(stems, key=self.stems.get)
            return flags | LEXICON | STEM, best, self.stems[best]
        return flags, "", 0.0

    @classmethod
    def learn(cls, texts: list[str], labels: list[int], most: int = 200) -> Lexicon:
        """Words and stems in many more toxic than other texts, by the log odds of holding them.

        A stem is counted only if its own beginning is frequent in toxic texts, which bounds
        what is kept.
        """
        n_toxic = max(1, sum(labels))
        n_other = max(1, len(labels) - sum(labels))
        least = max(5, 0.02 * n_toxic)
        vocabularies = [
            ({w for c in text.split() if len(w := EDGES.sub("", c).lower()) > 2}, label)
            for text, label in zip(texts, labels)]

        def chosen(size: int | None, frequent: set[str]) -> tuple[dict[str, float], set[str]]:
            """Words (no size) or stems of a size whose odds are high, and all frequent ones."""
            def parts(words: set[str]) -> set[str]:
                if size is None:
                    return words
                return {
                    w[:size] for w in words
                    if len(w) > size and (size == STEM_SIZES[0] or w[:size - 1] in frequent)}

            toxic, other = Counter(), Counter()
            for words, label in vocabularies:
                if label:
                    toxic.update(parts(words))
            common = {w for w, n in toxic.items() if n >= least}
            for words, label in vocabularies:
                if not label:
                    other.update(parts(words) & common)
            odds = {
                w: math.log((toxic[w] + 0.5) / (n_toxic + 1) * (n_other + 1) / (other[w] + 0.5))
                for w in common}
            return {w: o for w, o in odds.items() if o > LEAST_ODDS}, common

        def best(found: dict[str, float]) -> dict[str, float]:
            return dict(sorted(found.items(), key=lambda e: (-e[1], e[0]))[:most])

        words, _ = chosen(None, set())
        stems: dict[str, float] = {}
        frequent: set[str] = set()
        for size in STEM_SIZES:
            more, frequent = chosen(size, frequent)
            stems |= more
        return cls(best(words), best(stems))


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The FEATURES of a whole text; all zero for one without words."""
    chunks = text.split()
    if not chunks:
        return [0.0] * len(FEATURES)
    kinds = [lexicon.kind(c) for c in chunks]
    hits = [i for i, k in enumerate(kinds) if k[0] & LEXICON]
    second = [i for i, k in enumerate(kinds) if k[0] & SECOND]
    near = 0
    if hits and second:
        at = np.searchsorted(second, np.array(hits) - REACH)
        near = sum(a < len(second) and second[a] <= h + REACH for a, h in zip(at, hits))
    n = len(chunks)
    data = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=128)
    upper, lower, digits = data[65:91].sum(), data[97:123].sum(), data[48:58].sum()
    size = max(1, data.sum())
    marks = data[33:48].sum() + data[58:65].sum() + data[91:97].sum() + data[123:127].sum()
    return [
        len(hits) / n, math.log1p(len(hits)), len({kinds[i][1] for i in hits}),
        max((kinds[i][2] for i in hits), default=0.0),
        sum(bool(kinds[i][0] & STEM) for i in hits) / n,
        sum(bool(kinds[i][0] & DISGUISED) for i in hits) / n, len(second) / n, float(near),
        upper / max(1, upper + lower), sum(bool(k[0] & SHOUTED) for k in kinds) / n,
        data[33] / size, marks / size, digits / size,
    ]


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float = 0.0


def _with_features(rows: DataFrame, lexicon: Lexicon, passed: list[str]) -> DataFrame:
    """The `passed` columns of rows and FEATURES of their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            found = np.array(
                [features(texts[i].as_py(), lexicon) for i in range(len(texts))], np.float64
            ).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in passed] + [pa.array(found[:, k]) for k in range(len(FEATURES))],
                [*passed, *FEATURES])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"{c} {kinds[c]}" for c in passed] + [f"{c} double" for c in FEATURES])
    return rows.mapInArrow(run, schema)


def _margins(trees: GBTClassificationModel, featured: DataFrame) -> DataFrame:
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured)
    return trees.transform(assembled).withColumn(
        "margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "probability", "prediction")


def _measured_sample(
    pairs: list[tuple[str, int]],
) -> tuple[Lexicon, list[list[float]], list[list[float]]]:
    """A lexicon, and label and FEATURES of the texts for the trees and for the calibration."""
    fit, rest = [p for i, p in enumerate(pairs) if i % 4], pairs[::4]

    def learned(part: list[tuple[str, int]]) -> Lexicon:
        return Lexicon.learn([t for t, _ in part], [y for _, y in part])

    def measured(part: list[tuple[str, int]], by: Lexicon) -> list[list[float]]:
        return [[float(y), *features(t, by)] for t, y in part]

    # Each half is measured by the lexicon of the other one, as its own would look too good.
    first, second = fit[::2], fit[1::2]
    crossed = measured(first, learned(second)) + measured(second, learned(first))
    lexicon = learned(fit)
    return lexicon, crossed, measured(rest, lexicon)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
    text_col: str = "text", rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES,
) -> ToxicityModel:
    """A model fitted on a bounded sample of labelled documents that are not held out.

    Three quarters of the sample give the lexicon and the trees, one quarter the calibration.
    The trees see each half of theirs as a lexicon of the other half measures it.
    Without both labels in the sample the score is a constant.

    One task reads the sampled texts, learns the lexicon and measures the FEATURES, and a lost
    executor only repeats it; the driver receives the lexicon and the trees are fitted on rows
    of features. Of several labels of a document the largest counts. Null labels, ids and texts
    take no part, empty texts do; an empty sample gives the score 0.
    """
    sample = training_sample(docs, labels, label, rows, most_bytes, id_col, text_col)
    plan = ", ".join(f"{c} double" for c in ("label", *FEATURES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[str, int]] = []
        for batch in batches:
            pairs += zip(batch.column("text").to_pylist(), batch.column("label").to_pylist())
        lexicon, fitted, rest = _measured_sample(pairs)
        found = [("fit", r) for r in fitted] + [("rest", r) for r in rest]
        # The lexicon goes with one row more, whose features nobody reads.
        found.append((json.dumps([lexicon.words, lexicon.stems]), [0.0] * (1 + len(FEATURES))))
        values = np.array([r for _, r in found], np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part for part, _ in found], pa.string())]
            + [pa.array(values[:, k]) for k in range(values.shape[1])],
            ["part", "label", *FEATURES])

    # Written, as each round of the trees reads it and the texts must be measured once only.
    measured = written(sample.coalesce(1).mapInArrow(run, f"part string, {plan}"))
    stored = measured.where("part not in ('fit', 'rest')").collect()
    lexicon = Lexicon(*json.loads(stored[0]["part"])) if stored else Lexicon({})
    fitted, rest = measured.where("part = 'fit'"), measured.where("part = 'rest'")
    counts = {
        (r["part"], r["label"]): r["n"] for r in measured.where("part in ('fit', 'rest')")
        .groupBy("part", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 4:
        share = sum(n for (_, y), n in counts.items() if y) / max(1, sum(counts.values()))
        return ToxicityModel(lexicon, None, None, share)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(fitted)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1).fit(assembled)
    margins = _margins(trees, rest).select("label", "margin")
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins)
    return ToxicityModel(lexicon, trees, calibration)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id and score (0 to 1) of every row, from its whole text and nothing else.

    Null texts are empty texts; these have a score too. Rows that repeat an id are scored each
    on its own; ids may be null. Extra columns are ignored; an empty table gives an empty one.
    """
    rows = id_and_text(docs, id_col, text_col)
    if model.trees is None:
        return rows.select("id", F.lit(float(model.constant)).alias("score"))
    margins = _margins(model.trees, _with_features(rows, model.lexicon, ["id"]))
    scored = model.calibration.transform(margins.select("id", "margin"))
    return scored.select("id", F.col("prediction").alias("score"))


def op10_toxicity(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit_toxicity(docs, table(spark, folder, "labels"))
    return score_toxicity(docs, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
