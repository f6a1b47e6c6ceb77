"""Ranked lexical search over geometrically blocked posting lists; exact.

A document's coordinate for a term is its scaled frequency; its score for an item is the sum of its coordinates times the
terms' weights over the item's terms.  Documents are dealt to tasks by similarity (signs of random projections), and a
task indexes them in chunks.  In a chunk, every term's posting list is clustered around some of its own documents, by
the inner product of their projections; clusters are cut into blocks, and each block keeps the greatest coordinate of
its documents for its own term and for those after it, terms standing in order of falling weight.

A block answers for the documents that hold none of the item's terms before its own: others are met in the blocks of
those.  So the item's weights times the block's summary, from its own term on, bound all it answers for.  A block is
skipped only when that bound is under the score that the item's k-th best document is known to have; documents of the
other blocks are scored in whole numbers, over all the item's terms.

The corpus is read once for each block of items: documents become vectors over the block's terms, whose counts give the
weights; the index is written under the checkpoint folder.  A first search opens each item's best blocks of every chunk,
which gives the k-th best score it must at least reach, the second all blocks whose bound reaches that.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.llm.common import ship_code, staged

CHUNK_DOCS = 4096
CHUNK_ENTRIES = 1 << 20  # coordinates of a chunk; a single document may have more
BLOCK = 64  # documents of a block
SUMMARY = 256  # terms after its own that a block has the greatest coordinates for, per item
ITEM_BYTES = 8 << 20  # text of a block of items, about; one item may have more
PROJECTIONS = 16
SCALE = 1_000_000  # no coordinate reaches it

#: A term is a run of other characters than these; A to Z only are lower-cased, here on UTF-8.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = bytes(range(0x61, 0x7B))
for _c in _SEPARATORS:
    _TABLE[_c] = 0x20
_TABLE = bytes(_TABLE)

RANKED = "item_id long, rank int, doc_id long, score long"
VECTORS = "doc_id long, no_id boolean, n long, cols binary, tfs binary"
INDEX = ("ids binary, no_ids binary, ptr binary, cols binary, coords binary, list_terms binary, list_blocks binary, block_ptr binary, "
         "block_docs binary, summary binary")


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order; of a null none."""
    return text.translate(_TABLE).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """A block of items over the terms that documents hold, which are numbered by falling weight."""

    def __init__(self, items: dict, weights: dict[bytes, int]):
        order = sorted((t for t, w in weights.items() if w > 0), key=lambda t: (-weights[t], t))
        self.number = {t: i for i, t in enumerate(order)}
        self.w = np.array([weights[t] for t in order], np.int64)
        self.ids, self.of = [], []
        for item, words in items.items():
            found = sorted(self.number[t] for t in words if t in self.number)
            if found:
                self.ids.append(item)
                self.of.append(np.array(found, np.int64))
        after: list[set] = [set() for _ in order]
        for own in self.of:
            for i, t in enumerate(own):
                after[t].update(own[i + 1:i + 1 + SUMMARY].tolist())
        self.after = [np.array(sorted(a), np.int64) for a in after]
        #: for each item and term: places of the item's later terms in the summary, their weights, and what others can add
        self.places = []
        for own in self.of:
            rows = []
            for i, t in enumerate(own):
                near, far = own[i + 1:i + 1 + SUMMARY], own[i + 1 + SUMMARY:]
                rows.append((np.concatenate([[0], 1 + np.searchsorted(self.after[t], near)]), self.w[own[i:i + 1 + SUMMARY]], int(self.w[far].sum()) * SCALE))
            self.places.append(rows)


def _flat(ptr: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The places ``ptr[d] .. ptr[d + 1] - 1`` of every d in ``of``, one after the other."""
    n = ptr[of + 1] - ptr[of]
    return np.repeat(ptr[of] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def _clustered(docs: np.ndarray, sketch: np.ndarray) -> list[np.ndarray]:
    """The documents of a posting list (sorted by similarity) in blocks of at most ``BLOCK``: each document goes to the
    nearest of evenly spaced centres of the list."""
    count = -(-len(docs) // BLOCK)
    if count == 1:
        return [docs]
    centres = docs[(np.arange(count) * len(docs)) // count]
    to = (sketch[docs] @ sketch[centres].T).argmax(1)
    docs = docs[np.argsort(to, kind="stable")]
    ends = np.cumsum(np.bincount(to, minlength=count))
    out = []
    for low, high in zip(np.concatenate([[0], ends[:-1]]), ends):
        out += [docs[i:min(i + BLOCK, high)] for i in range(low, high, BLOCK)]
    return out


def build_chunk(ids: np.ndarray, no_ids: np.ndarray, ptr: np.ndarray, cols: np.ndarray, coords: np.ndarray, sketch: np.ndarray, after: list[np.ndarray]) -> tuple:
    """The index of one chunk, as a row of ``INDEX``.  Documents are rows of a sparse matrix (``ptr``, ``cols``, ``coords``)."""
    doc = np.repeat(np.arange(len(ids)), np.diff(ptr))
    by_term = np.argsort(cols, kind="stable")
    held, at = np.unique(cols[by_term], return_index=True)
    ends = np.append(at[1:], len(by_term))
    place = np.full(len(after), -1, np.int64)
    list_blocks, sizes, block_docs, summaries = [0], [], [], []
    for t, low, high in zip(held, at, ends):
        blocks = _clustered(doc[by_term[low:high]], sketch)
        members = np.concatenate(blocks)
        n = [len(b) for b in blocks]
        width = 1 + len(after[t])
        place[t], place[after[t]] = 0, np.arange(1, width)
        entries = _flat(ptr, members)
        block = np.repeat(np.repeat(np.arange(len(blocks)), n), ptr[members + 1] - ptr[members])
        to = place[cols[entries]]
        fit = to >= 0
        summary = np.zeros(len(blocks) * width, np.int32)
        np.maximum.at(summary, block[fit] * width + to[fit], coords[entries][fit])
        place[t], place[after[t]] = -1, -1
        list_blocks.append(list_blocks[-1] + len(blocks))
        sizes += n
        block_docs.append(members)
        summaries.append(summary)
    pieces = (ids.astype(np.int64), no_ids.astype(np.int8), ptr.astype(np.int64), cols.astype(np.int32), coords.astype(np.int32), held.astype(np.int32),
              np.array(list_blocks, np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
              np.concatenate(block_docs).astype(np.int32), np.concatenate(summaries))
    return tuple(p.tobytes() for p in pieces)


class Chunk:
    """The index of a chunk, read back."""

    def __init__(self, row, after: list[np.ndarray]):
        kinds = dict(ids=np.int64, no_ids=np.int8, ptr=np.int64, cols=np.int32, coords=np.int32, list_terms=np.int32, list_blocks=np.int64, block_ptr=np.int64, block_docs=np.int32, summary=np.int32)
        for name, kind in kinds.items():
            setattr(self, name, np.frombuffer(getattr(row, name), kind))
        self.lists, self.summaries, start = {}, [], 0
        for i, t in enumerate(self.list_terms.tolist()):
            count, width = int(self.list_blocks[i + 1] - self.list_blocks[i]), 1 + len(after[t])
            self.lists[t] = i
            self.summaries.append(self.summary[start:start + count * width].reshape(count, width))
            start += count * width

    def bounds(self, own: np.ndarray, places: list) -> tuple[np.ndarray, np.ndarray]:
        """The blocks of an item's terms and what each one's documents score at most."""
        blocks, bounds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for t, (columns, weights, rest) in zip(own.tolist(), places):
            i = self.lists.get(t)
            if i is not None:
                blocks.append(np.arange(self.list_blocks[i], self.list_blocks[i + 1]))
                bounds.append(self.summaries[i][:, columns].astype(np.int64) @ weights + rest)
        return np.concatenate(blocks), np.concatenate(bounds)

    def scored(self, blocks: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents of ``blocks`` and their scores; ``weights`` has those of the item's terms, else zeros."""
        docs = np.unique(self.block_docs[_flat(self.block_ptr, blocks)]).astype(np.int64)
        entries = _flat(self.ptr, docs)
        gain = weights[self.cols[entries]] * self.coords[entries]
        starts = np.concatenate([[0], np.cumsum(self.ptr[docs + 1] - self.ptr[docs])[:-1]])
        return docs, np.add.reduceat(gain, starts) if len(docs) else np.zeros(0, np.int64)


def search_chunk(chunk: Chunk, items: Items, k: int, least: dict | None, opened: list | None = None) -> Iterator[tuple]:
    """(item number, document, score) of the chunk's documents among the item's k best.  Without ``least`` the best blocks
    alone are opened, until they hold k documents; with it, all whose bound reaches the item's least score.  ``opened``
    gets the number of blocks that were opened and of all that hold one of the item's terms."""
    for j, own in enumerate(items.of):
        blocks, bounds = chunk.bounds(own, items.places[j])
        if not len(blocks):
            continue
        if least is None:
            order = np.argsort(-bounds, kind="stable")
            held = np.cumsum((chunk.block_ptr[blocks + 1] - chunk.block_ptr[blocks])[order])
            chosen = blocks[order[:int((held < k).sum()) + 1]]
        else:
            chosen = blocks[bounds >= least.get(j, 1)]
        if opened is not None:
            opened.append((len(chosen), len(blocks)))
        if not len(chosen):
            continue
        weights = np.zeros(len(items.w), np.int64)
        weights[own] = items.w[own]
        docs, scores = chunk.scored(chosen, weights)
        fit = scores >= (1 if least is None else least.get(j, 1))
        docs, scores = docs[fit], scores[fit]
        best = np.lexsort((chunk.ids[docs], chunk.no_ids[docs], -scores))[:k]
        yield from ((j, int(d), int(s)) for d, s in zip(docs[best], scores[best]))


def _count(docs: DataFrame, column: dict[bytes, int]) -> DataFrame:
    """``VECTORS`` of the documents that hold any term: how many, and how often those of ``column``."""
    sent = docs.sparkSession.sparkContext.broadcast(column)

    def run(batches):
        number = sent.value.get
        for batch in batches:
            out = []
            for doc_id, no_id, text in zip(batch.doc_id, batch.no_id, batch.text):
                words = terms(text)
                if words:
                    found = Counter(map(number, words))
                    found.pop(None, None)
                    out.append((doc_id, no_id, len(words), np.fromiter(found, np.int32, len(found)).tobytes(), np.fromiter(found.values(), np.int64, len(found)).tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "no_id", "n", "cols", "tfs"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, VECTORS)


def _held_in(vectors: DataFrame, n_columns: int) -> np.ndarray:
    """For each column, the number of documents that hold it: partial counts of each task, added up by Spark."""

    def run(batches):
        held = np.zeros(n_columns, np.int64)
        for batch in batches:
            held += np.bincount(np.frombuffer(b"".join(batch.cols), np.int32), minlength=n_columns)
        at = np.flatnonzero(held)
        yield pd.DataFrame({"c": at, "df": held[at]})

    out = np.zeros(n_columns, np.int64)
    for r in vectors.select("cols").mapInPandas(run, "c long, df long").groupBy("c").agg(F.sum("df").alias("df")).collect():  # a row per term of the items
        out[r.c] = r.df
    return out


def _sketched(vectors: DataFrame, renumbered: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """Coordinates, projections and the similarity code of every document that holds a term of weight."""
    sides = np.random.default_rng(11).choice(np.array([-1, 1], np.float32), (len(weights), PROJECTIONS))
    powers = 1 << np.arange(PROJECTIONS)[::-1]

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            sizes = batch.cols.map(len).to_numpy(np.int64) // 4
            doc = np.repeat(np.arange(len(batch)), sizes)
            col = renumbered[np.frombuffer(b"".join(batch.cols), np.int32)]
            tf = np.frombuffer(b"".join(batch.tfs), np.int64)
            length = 50 + (50 * batch.n.to_numpy(np.int64) * n_docs) // n_terms
            fit = col >= 0
            doc, col, tf = doc[fit], col[fit], tf[fit]
            coord = (1_000_000_000 * tf) // (1000 * tf + 20 * length[doc])
            mass = (coord * weights[col]).astype(np.float64)
            sketch = np.stack([np.bincount(doc, mass * sides[col, i], len(batch)) for i in range(PROJECTIONS)], 1)
            sketch /= np.maximum(np.sqrt((sketch * sketch).sum(1, keepdims=True)), 1e-30)
            ptr = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(batch)))])
            col, coord = col.astype(np.int32), coord.astype(np.int32)
            out = pd.DataFrame({
                "doc_id": batch.doc_id, "no_id": batch.no_id, "code": ((sketch > 0) * powers).sum(1),
                "cols": [col[a:b].tobytes() for a, b in zip(ptr, ptr[1:])], "coords": [coord[a:b].tobytes() for a, b in zip(ptr, ptr[1:])],
                "sketch": [s.tobytes() for s in sketch.astype(np.float32)]})
            yield out[np.diff(ptr) > 0]

    return vectors.mapInPandas(run, "doc_id long, no_id boolean, code int, cols binary, coords binary, sketch binary")


def _indexed(sketched: DataFrame, sent) -> DataFrame:
    """The index: documents in the order of their codes, a row for each chunk."""

    def chunk_of(rows: list, after: list[np.ndarray]) -> pd.DataFrame:
        ids, no_ids, cols, coords, sketch = zip(*rows)
        ptr = np.concatenate([[0], np.cumsum([len(c) // 4 for c in cols])])
        made = build_chunk(np.array(ids, np.int64), np.array(no_ids, bool), ptr, np.frombuffer(b"".join(cols), np.int32), np.frombuffer(b"".join(coords), np.int32),
                           np.frombuffer(b"".join(sketch), np.float32).reshape(-1, PROJECTIONS), after)
        return pd.DataFrame([made], columns=[c.split()[0] for c in INDEX.split(", ")])

    def run(batches):
        after, rows, entries = sent.value.after, [], 0
        for batch in batches:
            for row in zip(batch.doc_id, batch.no_id, batch.cols, batch.coords, batch.sketch):
                if rows and (len(rows) >= CHUNK_DOCS or entries + len(row[2]) // 4 > CHUNK_ENTRIES):
                    yield chunk_of(rows, after)
                    rows, entries = [], 0
                rows.append(row)
                entries += len(row[2]) // 4
        if rows:
            yield chunk_of(rows, after)

    # documents alike are dealt over tasks, too
    dealt = sketched.withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    return dealt.repartitionByRange("code", "spread").sortWithinPartitions("code", "spread").drop("spread").mapInPandas(run, INDEX)


def _searched(index: DataFrame, sent, k: int, least) -> DataFrame:
    """item (its number), no_id, doc_id, score; ``least`` is a broadcast dict or None."""

    def run(batches):
        items, limit = sent.value, None if least is None else least.value
        for batch in batches:
            for row in batch.itertuples(index=False):
                chunk = Chunk(row, items.after)
                found = list(search_chunk(chunk, items, k, limit))
                if found:
                    item, doc, score = map(np.array, zip(*found))
                    yield pd.DataFrame({"item": item, "no_id": chunk.no_ids[doc] > 0, "doc_id": chunk.ids[doc], "score": score})

    return index.mapInPandas(run, "item int, no_id boolean, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "no_id", "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _item_terms(items: DataFrame, part: int, parts: int) -> dict:
    """item_id -> its terms, for one block of items; rows of one item_id are one item."""

    def run(batches):
        for batch in batches:
            out = [(i, n, t) for i, n, text in zip(batch.item_id, batch.no_id, batch.text) for t in set(terms(text))]
            yield pd.DataFrame(out, columns=["item_id", "no_id", "term"])

    rows = items.select(F.coalesce(F.col("item_id").cast("long"), F.lit(0)).alias("item_id"), F.col("item_id").isNull().alias("no_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.filter(F.pmod(F.xxhash64("item_id", "no_id"), F.lit(parts)) == part)
    out: dict = {}
    for r in rows.mapInPandas(run, "item_id long, no_id boolean, term binary").distinct().collect():  # about ITEM_BYTES at most
        out.setdefault(None if r.no_id else r.item_id, set()).add(bytes(r.term))
    return out


def _search_block(spark: SparkSession, docs: DataFrame, items: dict, k: int) -> DataFrame | None:
    vocabulary = sorted({t for words in items.values() for t in words})
    if not vocabulary:
        return None
    vectors = staged(_count(docs, {t: i for i, t in enumerate(vocabulary)}), "ranked-vectors")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    held = _held_in(vectors, len(vocabulary))
    block = Items(items, {t: weight(n_docs, int(d)) for t, d in zip(vocabulary, held) if d})
    if not block.ids:
        return None
    renumbered = np.array([block.number.get(t, -1) for t in vocabulary], np.int64)
    sent = spark.sparkContext.broadcast(block)
    index = staged(_indexed(_sketched(vectors, renumbered, block.w, n_docs, n_terms), sent), "ranked-index")
    first = _best(_searched(index, sent, k, None), k).groupBy("item").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    least = {r.item: r.least for r in first.filter(F.col("n") >= k).collect()}  # a row per item of the block
    found = _best(_searched(index, sent, k, spark.sparkContext.broadcast(least)), k)
    names = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id long")
    return found.join(names, "item").select("item_id", F.col("rank").cast("int"), F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """For each item (item_id, text) its k documents (doc_id, text) of the highest score above 0, ties to the smaller
    doc_id: item_id, rank (from 1), doc_id, score.  Scores are those of the brief: weights ``floor(1000 ln((2N + 2) /
    (2 df + 1)))`` times ``10^9 tf div (1000 tf + 20 m)``, with ``m = 50 + 50 n N div L``.

    Null and empty texts have no terms: such documents are not counted, such items have no rows.  Every row of ``docs`` is
    a document, also a repeated one; a null doc_id comes after all others and is returned as null.  Rows of one item_id
    are one item with the terms of all; a null item_id is an item as well.  Texts of any length are read whole.  Other
    columns are not read.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    ship_code(spark)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // ITEM_BYTES))
    out = spark.createDataFrame([], RANKED)
    for part in range(parts):
        found = _search_block(spark, docs, _item_terms(items, part, parts), k)
        if found is not None:
            out = found if parts == 1 else out.unionByName(found)
    return out
