"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes: shifted left by one and increased by a random number of the new byte, so it
depends on the last ``WIDTH`` bytes alone.  A chunk ends where the hash's upper bits are zero; boundaries are
normalised: up to the normal length more bits must be zero than beyond it.  No chunk is shorter than ``LEAST`` (but the
last) or longer than ``MOST``.  As a boundary depends on the bytes of its own chunk alone, an insertion shifts the
chunks behind it without changing them.

A fingerprint is the set of chunk digests, each with its chunk's length; likeness is containment: the lengths of the
chunks found in the other fingerprint as a share of all lengths.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ship_code

LEAST, NORMAL, MOST = 16, 32, 128
WIDTH = 16  # bytes that the 16-bit hash depends on
STRICT, LOOSE = 1 << (16 - 6), 1 << (16 - 4)  # below: 6 or 4 upper bits are zero
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=20) & 0xFFFF for b in range(256)], np.uint16)
QUANTILE_STEPS = 20  # a partition's rows are counted to one part in this many
OUT_ROWS = 500

SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def gear(data: bytes) -> np.ndarray:
    """The rolling hash after each byte, by doubling the window."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):
        wider = h.copy()
        wider[step:] += h[:-step] << np.uint16(step)
        h = wider
    return h


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear(data)
    places = np.flatnonzero(h < LOOSE)
    strict = (h[places] < STRICT).tolist()
    places = places.tolist()
    out, start, i = [], 0, 0
    while n - start > LEAST:
        normal, cut = start + NORMAL, min(start + MOST, n)
        i = bisect_left(places, start + LEAST, i)
        while i < len(places) and places[i] < cut:
            if strict[i] or places[i] >= normal:
                cut = places[i] + 1
                break
            i += 1
        out.append(cut)
        start = cut
    if start < n:
        out.append(n)
    return out


def digests(data: bytes, ends: list[int], start: int = 0) -> list[int]:
    """Per chunk, 56 bits of digest above 8 bits of length."""
    digest, out = xxhash.xxh64_intdigest, []
    for end in ends:
        out.append(digest(data[start:end]) & ~0xFF | (end - start))
        start = end
    return out


def packed(chunks: set[int]) -> str:
    return base64.b64encode(np.sort(np.fromiter(chunks, np.uint64, len(chunks))).tobytes()).decode()


def unpacked(fingerprint: str) -> set[int]:
    return set(np.frombuffer(base64.b64decode(fingerprint), np.uint64).tolist())


def likeness(mine: set[int], other: set[int]) -> float:
    """Share of ``mine``, by length, that ``other`` holds; 1.0 for two empty sets, 0.0 if only mine is empty."""
    if not mine:
        return 0.0 if other else 1.0
    return sum(x & 0xFF for x in mine & other) / sum(x & 0xFF for x in mine)


class Print:
    """A text with its chunks."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        self.data = text.encode()
        self.ends = cuts(self.data)
        self.chunks = digests(self.data, self.ends)
        self.set = set(self.chunks)

    def edited(self, following: str) -> tuple[str, set[int]]:
        """The text with its last quarter replaced by as much of ``following``, and its chunks; those before the
        change are taken over."""
        gone = len(self.text) // 4
        if not gone:
            return self.text, self.set
        kept = self.text[:len(self.text) - gone]
        text = kept + following[:gone]
        same = bisect_left(self.ends, len(kept.encode()) + 1)
        start = self.ends[same - 1] if same else 0
        rest = text.encode()[start:]
        return text, set(self.chunks[:same]) | set(digests(rest, cuts(rest)))

    def row(self, following: "Print") -> tuple:
        text, chunks = self.edited(following.text)
        return (self.doc_id, len(self.text), hashlib.sha256(text.encode()).hexdigest(), packed(self.set), packed(chunks),
                likeness(self.set, chunks), likeness(self.set, following.set))


def _limits(docs: DataFrame) -> list[tuple]:
    """Starts (has an id, id, text hash) of all partitions but the first, of about equal row counts, from counted quantiles
    of the ids.  An id, or rows without one, that fill several partitions are cut by text hash as often."""
    rows, ids = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    size = max(1, -(-rows // parts))
    spread = Counter({(False, 0): -(-(rows - ids) // size)})
    shares = [i * size / ids for i in range(1, -(-ids // size))] if ids else []
    if ids:
        cuts = docs.agg(F.percentile_approx("doc_id", [0.0, *shares], QUANTILE_STEPS * parts)).first()[0]
        spread += Counter((True, int(c)) for c in cuts)
    starts = sorted((has, key, -(1 << 63) + (1 << 64) * j // n) for (has, key), n in spread.items() for j in range(n))
    return starts[1:]


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows by doc_id in partitions of about equal row counts, sorted, the first row of the following partition (after
    the last, of the first) behind each.

    The driver holds a few numbers for each partition; the texts are shuffled once, and read twice more where they lie, for
    the first row of each partition.  Rows alike in id and text lie in one partition.
    """
    spark = docs.sparkSession
    limits = _limits(docs)

    @F.pandas_udf("int")
    def part_of(has: pd.Series, key: pd.Series, th: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(limits, at) for at in zip(has.tolist(), key.tolist(), th.tolist())], dtype="int32")

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.col("doc_id").isNotNull().alias("has"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("key"),
                       F.xxhash64(text).alias("th"))
    rows = rows.withColumn("part", part_of("has", "key", "th"))
    found = sorted(rows.groupBy("part").agg(F.min(F.struct("has", "key", "th")).alias("at")).collect())  # a row for each partition
    used = [r.part for r in found]
    following = zip(used[-1:] + used[:-1], (tuple(r["at"]) for r in found))
    firsts = spark.createDataFrame([(p, *at) for p, at in following], "part int, has boolean, key long, th long")
    guests = rows.drop("part").join(F.broadcast(firsts), ["has", "key", "th"])  # as many rows as partitions
    guests = guests.groupBy("part", "has", "key", "th").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    own = rows.withColumn("guest", F.lit(0))
    both = own.unionByName(guests.withColumn("guest", F.lit(1))).repartitionById(len(limits) + 1, "part")
    return both.sortWithinPartitions("part", "guest", "has", "key", "th", "text").select("part", "guest", "doc_id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, fingerprint; sha256 and fingerprint of its edited text (the last quarter
    of the code points replaced by as many, or all, of the following document); near_edited and near_next.

    Documents follow each other by doc_id (null first, of one id by text hash and text); the first follows the last.
    A null text counts as empty; repeated rows are documents of their own; a single document follows itself; an empty
    table gives no rows; other columns are ignored.  Memory holds one batch and two documents a task.
    """
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, last, rows = None, None, []
        for batch in batches:
            for p, guest, doc_id, text in zip(batch.part, batch.guest, batch.doc_id, batch.text):
                if p != part:
                    part, last = p, None
                now = Print(None if pd.isna(doc_id) else int(doc_id), text)
                if last is not None:
                    rows.append(last.row(now))
                last = None if guest else now
            while len(rows) >= OUT_ROWS:
                yield _frame(rows[:OUT_ROWS])
                rows = rows[OUT_ROWS:]
        if rows:
            yield _frame(rows)

    return _in_order(docs.select(F.col("doc_id").cast("long"), "text")).mapInPandas(run, SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in SCHEMA.split(", ")]).astype({"doc_id": "Int64"})
