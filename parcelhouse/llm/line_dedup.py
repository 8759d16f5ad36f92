"""Removes passages that occur again elsewhere: content-defined chunks, and every run of lines
of more than LEAST_WORDS words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import table, written
from parcelhouse.llm.exact_dedup import key_filter, passes

WINDOW = 2
DIVISOR = 2
# A passage of more words is found whatever its number of lines and its neighbours.
LEAST_WORDS = 50
# A word is a run of anything but white space; in scripts without spaces each character is one.
_DENSE = (r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF"
          r"\x{20000}-\x{3FFFF}")
_WORD = rf"[{_DENSE}]|[^\s{_DENSE}]+"
ADDED = ("n_lines", "removed_lines", "removed_chunks")


def _rolling(hashes: Column, size: Column, window: int) -> Column:
    """For each line a hash of it and the `window` - 1 lines before it."""
    rolling = hashes
    for back in range(1, window):
        earlier = F.concat(
            F.array_repeat(F.lit(0).cast("long"), back),
            F.slice(hashes, 1, F.greatest(size - back, F.lit(0))))
        rolling = F.zip_with(
            rolling, F.slice(earlier, 1, size), lambda x, y: F.xxhash64(x, y))
    return rolling


def with_chunks(df: DataFrame, text_col: str, window: int, divisor: int) -> DataFrame:
    """Adds __pc_lines, _hashes of the lines, and _spans: for each chunk its first line (from 1) and number of lines.

    A chunk ends after a line whose rolling hash is divisible by `divisor`. The hash covers
    `window` lines only, so a passage is cut at the same lines wherever it stands.
    """
    lines = (
        df.withColumn("__pc_lines", F.split(df[text_col], "\n", -1))
        .withColumn("__pc_hashes", F.transform("__pc_lines", lambda x: F.xxhash64(x)))
    )
    size = F.size("__pc_lines")
    marked = F.transform(
        _rolling(F.col("__pc_hashes"), size, window),
        lambda h, i: F.when(F.pmod(h, F.lit(divisor)) == 0, i + 1))
    ends = F.array_union(F.filter(marked, lambda i: i.isNotNull()), F.array(size))
    spans = F.zip_with(
        F.concat(F.array(F.lit(0)), F.slice("__pc_ends", 1, F.size("__pc_ends") - 1)), F.col("__pc_ends"),
        lambda a, b: F.struct((a + 1).alias("first"), (b - a).alias("n")))
    return lines.withColumn("__pc_ends", ends).withColumn("__pc_spans", spans).drop("__pc_ends")


def _n_words(line: Column) -> Column:
    """The words of a line. Where single spaces part them they are counted without _WORD."""
    other = F.lit(False)
    for space in ("  ", "\t", "\r", "\x0b", "\f"):
        other = other | line.contains(space)
    other = other | line.startswith(" ") | line.endswith(" ")
    # A character of _DENSE has three bytes or more.
    dense = (F.octet_length(line) >= F.length(line) + 2) & line.rlike(r"[\u0E00-\u1FFF\u3040-\x{3FFFF}]")
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(line == "", 0).when(~(other | dense), spaces + 1).otherwise(
        F.regexp_count(line, F.lit(_WORD)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _reach(words: Column, least_words: int) -> Column:
    """For each line the number of lines, from it on, that together have more than `least_words`
    words; one beyond the last line if the rest is too short. Every line has a word.

    Sums over 1, 2, 4, ... lines are formed and fitted in from the longest down, so the work
    is the number of lines times the logarithm of `least_words`.
    """
    levels = least_words.bit_length()
    one = 1 << 20

    def fitted(sums: Column, k: int) -> Callable[[Column, Column], Column]:
        def step(state: Column, at: Column) -> Column:
            more = F.coalesce(F.get(sums, at + F.shiftright(state, 20)), F.lit(0))
            fits = state.bitwiseAND(one - 1) + more <= least_words
            return F.when(fits, state + more + (one << k)).otherwise(state)
        return step

    def build(sums: list[Column]) -> Column:
        if len(sums) < levels:
            last = sums[-1]
            double = F.zip_with(
                last, F.slice(last, (1 << len(sums) - 1) + 1, F.size(last)),
                lambda a, b: a + F.coalesce(b, F.lit(0)))
            return _let(double, lambda x: build([*sums, x]))
        # The lines that fit in times `one`, plus their words.
        states = F.transform(sums[0], lambda _: F.lit(0))
        for k in reversed(range(levels)):
            states = F.transform(states, fitted(sums[k], k))
        return F.transform(states, lambda s: F.shiftright(s, 20) + 1)

    return _let(words, lambda x: build([x]))


def with_passages(cut: DataFrame, least_words: int) -> DataFrame:
    """Adds __pc_runs: first line and number of lines of the shortest runs of more than
    `least_words` words, from each line on and back from each line.

    Such a run depends on its own lines only. A passage of more than `least_words` words is the
    union of the runs within it: those from its lines on, and the one back from its last
    line. So two copies of a passage share all runs of the passage, whatever stands around them.
    """
    clipped = F.transform(
        "__pc_lines", lambda x, i: F.struct(
            (i + 1).alias("at"), F.least(_n_words(x), F.lit(least_words + 1)).alias("words")))
    full = F.filter(clipped, lambda s: s["words"] > 0)

    def runs(full: Column) -> Column:
        size, words, at = F.size(full), full["words"], full["at"]
        width = (least_words + 2).bit_length()

        def code(first: Column, n: Column) -> Column:
            return F.shiftleft(first.cast("long"), width) + n

        on = F.transform(_reach(words, least_words), lambda n, i: F.when(i + n <= size, code(i, n)))
        back = F.transform(
            _reach(F.reverse(words), least_words), lambda n, i: F.when(i + n <= size, code(size - i - n, n)))
        codes = F.filter(F.array_union(on, back), lambda c: c.isNotNull())

        def span(c: Column) -> Column:
            first = F.shiftright(c, width).cast("int")
            n = c.bitwiseAND((1 << width) - 1).cast("int")
            start = F.get(at, first)
            return F.struct(start.alias("first"), (F.get(at, first + n - 1) - start + 1).alias("n"))

        return _let(at, lambda _: F.transform(codes, span))

    return cut.withColumn("__pc_runs", _let(full, runs))


def repeated_passages(
    rows: DataFrame, window: int, divisor: int, least_lines: int = 2, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """id, key (hash of the text), first line and number of lines of the passages to remove.

    Passages are the chunks of `least_lines` or more and the runs of `with_passages`. Hashes
    are counted first. Only passages whose hash occurs again are read and grouped by the
    SHA-256 of their text. Of equal passages the first stays: that of the smallest id, and in
    its document the earliest; so do those that overlap it. The earliest place of a line
    thus always stays.
    """
    cut = with_passages(
        with_chunks(rows.where("text is not null"), "text", window, divisor), least_words)
    chunks = F.filter("__pc_spans", lambda s: s["n"] >= least_lines)
    pieces = F.transform(F.concat(chunks, F.col("__pc_runs")), lambda s: F.struct(
        s["first"].alias("first"), s["n"].alias("n"),
        F.xxhash64(F.slice(F.col("__pc_hashes"), s["first"], s["n"])).alias("hash")))
    cut = cut.select("id", F.xxhash64("text").alias("key"), "__pc_lines", pieces.alias("__pc_pieces"))
    again = (
        cut.select(F.explode_outer("__pc_pieces.hash").alias("hash")).where("hash is not null")
        .groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    again = key_filter(again.select(F.col("hash").alias("key")))
    digested = F.transform(
        F.filter("__pc_pieces", lambda s: passes(again, s["hash"])),
        lambda s: F.struct(
            s["first"].alias("first"), s["n"].alias("n"),
            F.unhex(F.sha2(F.array_join(F.slice(F.col("__pc_lines"), s["first"], s["n"]), "\n"), 256))
            .alias("digest")))
    candidates = written(
        cut.select("id", "key", F.explode_outer(digested).alias("c"))
        .where("c is not null").select("id", "key", "c.*"))
    # explode_outer, as Spark adds a filter to explode that works the array out once more.
    # Written, so that the join has its own exchanges and Spark can split a hot passage there.
    groups = written(
        candidates.groupBy("digest")
        .agg(F.min(F.struct("id", "key", "first", "n")).alias("kept"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1").drop("copies")
    )
    overlaps = (
        F.struct("id", "key").eqNullSafe(F.struct("kept.id", "kept.key"))
        & (F.col("first") < F.col("kept.first") + F.col("kept.n")))
    return candidates.join(groups, "digest").where(~overlaps).select("id", "key", "first", "n")


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    divisor: int = DIVISOR, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """The documents without the passages that occurred before, and how much went.

    Every run of lines of more than `least_words` words that stands elsewhere with equal bytes
    is found whole, be it one line or many. Shorter passages are found where they hold a whole
    chunk: lines are hashed, a rolling hash over `window` lines chooses chunk boundaries, and
    chunks of two lines or more are compared. Of equal passages only the first stays: the one
    in the document with the smallest id. Adds n_lines, removed_lines and removed_chunks
    (the chunks that lost lines).

    Null texts stay null and have no lines. Rows that repeat an id and its text are one document
    and are treated alike. A null id comes before all others. A text of repeated passages only
    becomes empty. Other columns stay; those with the names of the added ones are replaced.
    An empty table gives an empty one.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    lost = (
        repeated_passages(rows, window, divisor, least_words=least_words).groupBy("id", "key")
        .agg(F.collect_set(F.struct("first", "n")).alias("__pc_lost"))
        .select(F.col("id").alias("__pc_id"), F.col("key").alias("__pc_key"), "__pc_lost")
    )
    names = [c for c in docs.columns if c not in ADDED]
    source = docs.select(*names, F.xxhash64(docs[text_col]).alias("__pc_text_key"))
    same = source[id_col].eqNullSafe(lost["__pc_id"]) & (source["__pc_text_key"] == lost["__pc_key"])
    # Cut again after the join rather than shuffled with all lines.
    cut = with_chunks(source.join(lost, same, "left"), text_col, window, divisor)
    cut = cut.withColumn("__pc_gone", F.array_distinct(F.flatten(F.transform(
        "__pc_lost", lambda s: F.sequence(s["first"], s["first"] + s["n"] - 1)))))
    kept = F.array_except(F.sequence(F.lit(1), F.size("__pc_lines")), F.col("__pc_gone"))
    text = _let(F.col("__pc_lines"), lambda lines: F.array_join(
        F.transform(kept, lambda i: F.get(lines, i - 1)), "\n"))
    chunk_of = F.flatten(F.transform("__pc_spans", lambda s: F.array_repeat(s["first"], s["n"])))
    chunks = _let(chunk_of, lambda first: F.size(F.array_distinct(
        F.transform("__pc_gone", lambda i: F.get(first, i - 1)))))
    some = F.col("__pc_lost").isNotNull()
    changed = {
        text_col: F.when(some, text).otherwise(F.col(text_col)),
        "n_lines": F.coalesce(F.size("__pc_lines"), F.lit(0)).cast("long"),
        "removed_lines": F.when(some, F.size("__pc_gone")).otherwise(0).cast("long"),
        "removed_chunks": F.when(some, chunks).otherwise(0).cast("long"),
    }
    return cut.select(
        *[changed[c].alias(c) if c == text_col else F.col(c) for c in names],
        *[changed[c].alias(c) for c in ADDED])


def op1_line_dedup(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup(docs)
