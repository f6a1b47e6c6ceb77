"""Line dedup by winnowing over line hashes (DataFrame functions only).

A document is its sequence of non-empty lines, each a 128-bit hash and a number of words.  The window ahead of a line is
the run of lines from it on that first reaches ``window_words`` words, the window behind it the run up to it that does.

Winnowing: a window's fingerprint is its least line, the longest first, then by hash.  Equal runs select equal lines, so
every run of ``window_words`` words or more that stands at two places has its windows' fingerprints at both: a window
whose fingerprint stands at one place only is no match, and goes before anything is compared.

Extension: a match goes back and forth from a shared fingerprint through the windows that hold it.  Each of them, as a
whole run, is looked up at its earliest place; one that stands at an earlier place is part of the match.  A line of a
repeated run has the run's window ahead of it, or, within the last words of the run, the one behind it, or lies in the
window ahead of the run's first line.  So matches are extended to both true ends, at whichever earlier places the run
and its parts stand, and a run's later places, by doc_id, then text hash, then line, are deleted; nothing else is.  A
deleted line always equals a line at an earlier place, so the first place of every line stays.

Scale: lines travel as hashes; no pairs of places are made: a fingerprint is shared if the least and greatest of its
places differ, and a run's first place is a minimum, both combined map-side; the joins back are between two shuffled
tables, one of them unique in the key, so a passage in a third of all documents is split by Spark's skew-join handling;
sorted windows are per document.  The text is shuffled once, to meet the numbers of its deleted lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import named, staged

GRAM_WORDS = 25


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, window_words: int = GRAM_WORDS) -> DataFrame:
    """The windows ahead of and behind each line: doc_id, text_hash, fp and fp_pos (the fingerprint's hash and line number),
    w1 and w2 (the run's hashes), lines (their numbers)."""
    trimmed = lambda x: F.struct(F.xxhash64(F.trim(x)).alias("h"), F.xxhash64(F.lit("second"), F.trim(x)).alias("h2"), F.regexp_count(x, F.lit(r"\S+")).alias("words"))
    lines = (
        docs.filter(F.col("text").isNotNull())
        .select(F.col("doc_id"), F.xxhash64("text").alias("text_hash"), F.transform(_lines(F.col("text")), trimmed).alias("lines"))
        .dropDuplicates(["doc_id", "text_hash"])  # a repeated row is the same document
        .select("doc_id", "text_hash", F.posexplode("lines").alias("pos", "line"))
        .select("doc_id", "text_hash", "pos", "line.*")
        .filter("words > 0")
    )
    doc = Window.partitionBy("doc_id", "text_hash")
    ends = lines.withColumn("till", F.sum("words").over(doc.orderBy("pos")).cast("long")).withColumn("at", F.col("till") - F.col("words"))
    ahead = doc.orderBy("at").rangeBetween(0, window_words - 1)
    behind = doc.orderBy("till").rangeBetween(-(window_words - 1), 0)

    def window(over: Window, when: Column) -> Column:
        run = F.collect_list(F.struct("pos", "h", "h2")).over(over)
        least = F.min(F.struct((-F.col("words")).alias("rank"), "h", "pos")).over(over)
        return F.when(when, F.struct(least["h"].alias("fp"), least["pos"].alias("fp_pos"), F.xxhash64(run["h"]).alias("w1"),
                                     F.xxhash64(run["h2"]).alias("w2"), run["pos"].alias("lines")))

    found = ends.select(
        "doc_id", "text_hash",
        window(ahead, F.sum("words").over(ahead) >= window_words).alias("ahead"),
        # a line that is a window by itself is so on both sides
        window(behind, (F.col("words") < window_words) & (F.sum("words").over(behind) >= window_words)).alias("behind"),
    )
    return found.select("doc_id", "text_hash", F.explode(F.array_compact(F.array("ahead", "behind"))).alias("w")).select("doc_id", "text_hash", "w.*")


def shared_fingerprints(found: DataFrame) -> DataFrame:
    """fp of the fingerprints that stand at two places or more."""
    place = ("doc_id", "text_hash", "fp_pos")
    ranged = found.groupBy("fp").agg(*(f(c).alias(f"{name}_{c}") for c in place for name, f in (("low", F.min), ("high", F.max))),
                                     F.count("doc_id").alias("named"), F.count(F.lit(1)).alias("n"))
    differ = (F.col("named") > 0) & (F.col("named") < F.col("n"))
    for c in place:
        differ = differ | F.coalesce(F.col(f"low_{c}") != F.col(f"high_{c}"), F.lit(False))
    return ranged.filter(differ).select(F.col("fp").alias("sfp"))


def repeated_lines(docs: DataFrame, window_words: int = GRAM_WORDS) -> DataFrame:
    """doc_id, text_hash, removed: the sorted numbers (from 0) of the lines to delete, for documents that have any."""
    found = staged(windows(docs, window_words), "line-windows")
    matched = found.join(shared_fingerprints(found), F.col("fp") == F.col("sfp"), "left_semi").withColumn("start", F.col("lines")[0])
    matched = staged(matched.select("doc_id", "text_hash", "w1", "w2", "start", "lines"), "line-matches")
    firsts = matched.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "text_hash", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("w1").alias("f1"), F.col("w2").alias("f2"), F.col("first.doc_id").alias("fid"), F.col("first.text_hash").alias("fth"), F.col("first.start").alias("fstart"))
    later = matched.join(firsts, (F.col("w1") == F.col("f1")) & (F.col("w2") == F.col("f2"))).filter(
        (F.col("text_hash") != F.col("fth")) | (F.col("start") != F.col("fstart")) | ~F.col("doc_id").eqNullSafe(F.col("fid")))
    return later.select("doc_id", "text_hash", F.explode("lines").alias("pos")).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


def dedup_lines(docs: DataFrame, window_words: int = GRAM_WORDS, counts: tuple[str, str] = ("__n_lines", "__n_removed")) -> DataFrame:
    """All rows and columns of ``docs``, the text without its later repeated runs, with two columns named by ``counts`` (other
    names than those of ``docs``): its lines, and how many of them were removed.

    Null text stays null (no lines); an empty text has no words and stays; lines are compared without the spaces
    around them; empty lines are never deleted; documents of fewer than ``window_words`` words stay as they are.
    Rows alike in doc_id and text are one document: both keep or lose the same lines.  Documents with the same or a
    null doc_id but other texts are told apart by the text's hash.  Texts of any length are read whole.  An empty table gives no rows.
    """
    gone = repeated_lines(docs.select("doc_id", "text"), window_words).select(
        F.col("doc_id").alias("__gid"), F.col("text_hash").alias("__gth"), "removed")
    rows = docs.select(F.struct(*named(docs)).alias("__row"), F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    joined = rows.join(gone, (F.xxhash64("__text") == F.col("__gth")) & F.col("__id").eqNullSafe(F.col("__gid")), "left")
    joined = joined.withColumn("__lines", F.when(F.col("removed").isNotNull(), _lines(F.col("__text"))))
    # the kept lines are the gaps between deleted ones: linear in the document's lines
    cuts = F.concat(F.array(F.lit(-1)), F.col("removed"), F.array(F.size("__lines")))
    joined = joined.withColumn("__cuts", cuts)
    kept = F.expr("array_join(flatten(transform(sequence(1, size(__cuts) - 1), i -> "
                  "slice(__lines, __cuts[i - 1] + 2, __cuts[i] - __cuts[i - 1] - 1))), '\n')")
    text = F.when(F.col("removed").isNotNull(), kept).otherwise(F.col("__text"))
    return joined.select(
        *(text.alias(c) if c == "text" else F.col("__row").getField(c).alias(c) for c in docs.columns),
        F.when(F.col("__text").isNull(), 0).otherwise(F.regexp_count("__text", F.lit("\n")) + 1).cast("long").alias(counts[0]),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias(counts[1]),
    )
