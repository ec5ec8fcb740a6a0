"""Line dedup by content-defined chunks of lines.

Every line is hashed, and a rolling hash over ``WINDOW`` neighbouring line hashes decides whether a chunk starts at a
line. The decision looks at nothing else, so lines inserted elsewhere in a document move no boundary. A line of more
than ``OWN_LINE`` words is always its own chunk. Chunks that occur more than once in the corpus are compared byte by
byte with their first occurrence. Repeats of several lines, and of single lines of more than ``LONG_LINE`` words, are
removed everywhere but at their first occurrence; a shorter line that repeats by itself stays.

The chunk at either edge of a shared passage also holds lines of its own document, and a short passage may hold no whole
chunk. Passages need no boundary: every two neighbouring lines with words are a pair, pairs that repeat an earlier one
byte by byte are joined to stretches where they share lines, and stretches of more than ``LONG_LINE`` words go. So every
passage of more words that stands earlier, in one place or in parts, goes whole, within a document as well. Of every line
that goes, the earliest equal one stays.

Plan: DataFrame functions only. First only 64-bit digests and positions of chunks and pairs move, combined before the
shuffle, so one that a third of all documents share is a row per task. Texts are read again only for digests that repeat:
the smallest and the largest text of a digest, taken before the shuffle as well, are equal exactly if all its texts are,
byte by byte; texts that merely share a digest are grouped by themselves. Stretches are found by document from positions
and word counts alone, and removals are joined to the documents by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.text import WORD_PATTERN
from marquee.session import materialize

WINDOW = 2
EXPECTED_LINES = 2  # a chunk has about so many lines
LONG_LINE = 50
OWN_LINE = 20
# Fixed values of the rolling hash: a prime below 2^31 and the multiplier of a step.
MODULUS = 2147483647
STEP = 1000003
COUNTS = ("removed_chunks", "removed_lines")


def _line_hash(line: Column) -> Column:
    """31 bits of the line's digest."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long") % MODULUS


def _rolling(hashes: Column, at: Column, window: int) -> Column:
    """Hash of the ``window`` line hashes that end at index ``at``; fewer at the start of a document."""
    first = F.greatest(at - (window - 1), F.lit(0))
    return F.aggregate(
        F.slice(hashes, first + 1, at - first + 1), F.lit(0).cast("long"), lambda so_far, h: (so_far * STEP + h) % MODULUS
    )


def _lines(docs: DataFrame, key: str) -> DataFrame:
    return docs.filter("text IS NOT NULL").select(
        F.col(key).alias("key"), F.xxhash64("text").alias("text_digest"), F.split("text", "\n", -1).alias("lines")
    )


def _text(pair: Column, at: Column, size: Column) -> Column:
    """What is compared of a part: a chunk whole, of a pair its two lines."""
    both = F.concat(F.get("lines", at), F.lit("\n"), F.get("lines", at + size - 1))
    return F.when(pair, both).otherwise(F.array_join(F.slice("lines", at + 1, size), "\n"))


def parted(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, expected: int = EXPECTED_LINES) -> DataFrame:
    """(key, text_digest, pair, at, n_lines, words, last_words, digest): what is compared of every text.

    Chunks that would go if they repeat, of several lines with some word or of one with more than ``LONG_LINE``: ``words``
    are those of the longest line. Pairs of neighbouring lines with words, blank ones between them left out of the text:
    ``words`` and ``last_words`` are those of both. ``at`` is the index of the first line. Null texts have none.
    """
    marked = _lines(docs, key).withColumn(
        "facts", F.transform("lines", lambda x: F.struct(_line_hash(x).alias("h"), F.regexp_count(x, F.lit(WORD_PATTERN)).alias("words")))
    )
    hashes, own = F.col("facts.h"), lambda i: F.get(F.col("facts.words"), i) > OWN_LINE
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    starts = F.filter(
        every, lambda i: (i == 0) | own(i) | own(i - 1) | (F.shiftright(_rolling(hashes, i, window), 7) % expected == 0),
    )
    worded = F.filter(every, lambda i: F.get(F.col("facts.words"), i) > 0)
    cut = marked.select(
        "key", "text_digest", "lines", F.col("facts.words").alias("counts"), starts.alias("starts"), worded.alias("worded")
    )

    def part(pair: bool, at: Column, size: Column, words: Column, last: Column) -> Column:
        text = _text(F.lit(pair), at, size)
        return F.struct(
            F.lit(pair).alias("pair"), at.alias("at"), size.alias("n_lines"), words.alias("words"), last.alias("last_words"),
            F.xxhash64(F.lit(pair), text).alias("digest"),
        )

    def chunk(start: Column, number: Column) -> Column:
        size = F.coalesce(F.get("starts", number + 1), F.size("lines")) - start
        return part(False, start, size, F.array_max(F.slice("counts", start + 1, size)), F.lit(0))

    def pair(start: Column, number: Column) -> Column:
        end = F.get("worded", number + 1)
        return part(True, start, end - start + 1, F.get("counts", start), F.get("counts", end))

    chunks = F.filter(F.transform("starts", chunk), lambda c: ((c["n_lines"] > 1) & (c["words"] > 0)) | (c["words"] > LONG_LINE))
    pairs = F.transform(F.slice("worded", 1, F.greatest(F.size("worded") - 1, F.lit(0))), pair)
    return cut.select("key", "text_digest", F.inline(F.concat(chunks, pairs)))


def _texts(suspects: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """(digest, place, pair, text) of the suspects; each document is met once, with all of its own."""
    wanted = suspects.groupBy(F.col("place.key").alias("_key"), F.col("place.text_digest").alias("_digest")).agg(
        F.collect_set(F.struct("digest", "place", "pair", "n_lines")).alias("wanted")
    )
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("text_digest") == F.col("_digest"))
    each = F.transform("wanted", lambda w: F.struct(
        w["digest"].alias("digest"), w["place"].alias("place"), w["pair"].alias("pair"), _text(w["pair"], w["place"]["at"], w["n_lines"]).alias("text"),
    ))
    return _lines(docs, key).join(wanted, same).select(F.inline(each))


def repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, expected: int = EXPECTED_LINES) -> DataFrame:
    """(pair, key, text_digest, at, n_lines, words, last_words) of every chunk and pair that repeats one at an earlier place.

    A place is (last, key, text_digest, at); places are ordered by key, null last, then by the text's digest and
    the first line.
    """
    place = F.struct(F.col("key").isNull().alias("last"), "key", "text_digest", "at").alias("place")
    rows = materialize(parted(docs, key, window, expected).select("digest", "pair", place, "n_lines", "words", "last_words"), "line-parts")
    # Several rows at one place are copies of one document and count once.
    often = rows.groupBy("digest").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last")
    suspects = materialize(rows.join(often.select("digest", "first"), "digest"), "line-suspects")
    texts = _texts(suspects, docs, key)
    same_kind, same_text = F.min("pair") == F.max("pair"), F.min("text") == F.max("text")
    alike = materialize(texts.groupBy("digest").agg((same_kind & same_text).alias("alike")), "line-texts")
    found = suspects.join(alike.filter("alike"), "digest").filter("place > first")
    mixed = alike.filter("NOT alike").select("digest")
    if not mixed.isEmpty():  # different texts of one digest
        theirs = _texts(suspects.join(mixed, "digest", "left_semi"), docs, key)
        first = theirs.groupBy("digest", "pair", "text").agg(F.min("place").alias("_first"))
        again = theirs.join(first, ["digest", "pair", "text"]).filter("place > _first").select("pair", "place").distinct()
        found = found.drop("alike").unionByName(suspects.join(again, ["pair", "place"], "left_semi"))
    return found.select(
        "pair", F.col("place.key").alias("key"), F.col("place.text_digest").alias("text_digest"), F.col("place.at").alias("at"),
        "n_lines", "words", "last_words",
    ).distinct()


def stretches(pairs: DataFrame) -> DataFrame:
    """(key, text_digest, at, n_lines) of the runs of repeated pairs that share lines and have more than ``LONG_LINE`` words."""
    in_order = Window.partitionBy("key", "text_digest").orderBy("at")
    end = F.col("at") + F.col("n_lines") - 1
    apart = F.coalesce(F.col("at") > F.lag(end).over(in_order), F.lit(True))
    runs = pairs.withColumn("end", end).withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(in_order))
    return (
        runs.groupBy("key", "text_digest", "run")
        .agg(
            F.min("at").alias("low"), F.max("end").alias("high"),
            (F.sum("words") + F.max_by("last_words", "at")).alias("total"),
        )
        .filter(F.col("total") > LONG_LINE)
        .select("key", "text_digest", F.col("low").alias("at"), (F.col("high") - F.col("low") + 1).alias("n_lines"))
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, expected: int = EXPECTED_LINES) -> DataFrame:
    """The documents with repeated chunks and passages cut out of ``text``, and the number of both and of removed lines.

    Returns the columns of ``docs`` with the new text, ``removed_chunks`` and ``removed_lines``, which replace columns
    of these names. The lines that stay keep their order. A text of which all is removed is empty. Null and empty
    texts stay as they are. Rows that share key and text are copies of one document: they are treated alike, and none
    is a repeat of the other. No rows give no rows.
    """
    found = materialize(repeats(docs, key, window, expected), "line-repeats")
    ranges = found.filter("NOT pair").select("key", "text_digest", "at", "n_lines").unionByName(stretches(found.filter("pair")))
    cuts = ranges.groupBy(F.col("key").alias("_key"), F.col("text_digest").alias("_digest")).agg(
        F.collect_list(F.struct("at", "n_lines")).alias("_cuts")
    )
    # The rows travel as one struct, so no column of theirs can clash with those that are added.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    text = F.col("_row")["text"]
    same = F.col("_row")[key].eqNullSafe(F.col("_key")) & (F.xxhash64(text) == F.col("_digest"))
    gone = F.array_distinct(F.flatten(F.transform("_cuts", lambda c: F.sequence(c["at"], c["at"] + c["n_lines"] - 1))))
    joined = rows.join(cuts, same, "left").select(
        "_row", "_cuts", gone.alias("_gone"), F.when(F.col("_cuts").isNotNull(), F.split(text, "\n", -1)).alias("_all")
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("_gone"))
    rest = F.when(F.col("_cuts").isNull(), text).otherwise(F.array_join(F.transform(stay, lambda i: F.get("_all", i)), "\n"))
    count = lambda column: F.when(F.col(column).isNull(), 0).otherwise(F.size(column)).cast("long")
    return joined.select(
        *[(rest if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns if c not in COUNTS],
        count("_cuts").alias(COUNTS[0]), count("_gone").alias(COUNTS[1]),
    )
