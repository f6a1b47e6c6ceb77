"""N-gram Jaccard join by grouped prefixes.

A document is the set of its distinct five-word shingles, as 64-bit hashes.  Shingles have one global order, common ones
last; two sets of Jaccard similarity ``t`` share a shingle among their first ``n - ceil(t n) + 1``, their prefixes.

1. Common shingles are counted over all documents, in packed form: the df of every shingle in the lower ``ZONE`` of the
   hash range is counted exactly, and those in more than ``COMMON`` documents go last in the order.  (Any order gives
   right results; this one keeps shared passages out of prefixes.)
2. Documents of equal sets form a class; classes of identical prefix and size form a group.  Each group is posted once
   under each shingle of its prefix.
3. Group pairs are filtered: lists of up to ``SHORT`` groups give pairs, with the number of prefix shingles they share,
   which must suffice for the threshold given both sizes.  Longer lists hold what is common to many near copies; their
   groups are put into one cluster at once, without pairs.
4. Clusters - components of the surviving pairs and long lists - are expanded to their classes, whose texts are fetched
   once, and verified in blocks: intersections of whole sets by one product of incidence matrices for each pair of
   blocks.  Blocks are cut by set size, so pairs of blocks whose sizes can't match are skipped.  A block pair gives at
   most one link less than it has members, enough for the components, and the number of links of each member.

No task holds more than two blocks of texts, and the pairs of a large group of near copies are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import bucket_count, maybe_among, named, numbered, ship_code, staged
from shoplens.llm.components import components

WORDS = 5
THRESHOLD = 80  # per cent
ZONE = 0.3
COMMON = 32
SHORT = 32  # lists up to this length give pairs; not below COMMON
COMMON_MOST = 1 << 20  # shingles that may be marked as common: 8 MB
BLOCK = 1024  # texts
REMEMBERED = 150_000  # word hashes or groups that a task remembers

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of a text with fewer words, one of all its words."""
    tokens = text.encode().lower().split() if text else []  # of bytes: lowers A-Z, splits at \x20 and \x09-\x0D
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), seed=len(tokens))], np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))
    n = len(h) - words + 1
    s = h[:n].copy()
    for i in range(1, words):
        s *= _MIX
        s ^= s >> np.uint64(29)
        s += h[i:i + n]
    s ^= s >> np.uint64(32)
    s *= _MIX
    s ^= s >> np.uint64(29)
    return np.unique(s)


def prefix_size(n: int, threshold: int = THRESHOLD) -> int:
    return n - -(-threshold * n // 100) + 1 if n else 0


def _lead_bits(documents: int) -> int:
    """Bits of a shingle that name its counting bucket: about a thousand documents a bucket, 2^16 at most."""
    return max(4, min(16, (documents // 1000).bit_length()))


def common_shingles(docs: DataFrame, words: int, lead: int) -> np.ndarray:
    """The upper ``lead + 32`` bits, sorted, of the shingles of the zone that more than ``COMMON`` documents hold: of
    more than ``COMMON_MOST``, the most frequent."""
    end = np.uint64(int(ZONE * 2**64))
    low = np.uint64(32 - lead)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch.text]
            zone = np.concatenate([s[:np.searchsorted(s, end)] for s in sets] or [np.empty(0, np.uint64)]) >> low
            found, n = np.unique(zone, return_counts=True)
            bucket = (found >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            rest, n = (found & np.uint64(0xFFFFFFFF)).astype(np.uint32), n.astype(np.uint32)
            rows = []
            for b, r, c in zip(bucket[np.r_[0, cuts]] if len(bucket) else [], np.split(rest, cuts), np.split(n, cuts)):
                many = c > 1
                rows.append((int(b), r[~many].tobytes(), r[many].tobytes(), c[many].tobytes()))
            yield pd.DataFrame(rows, columns=["bucket", "once", "more", "times"])

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(bucket, parts):
            rest = np.concatenate([np.frombuffer(x, np.uint32) for once, more, _ in parts for x in (once, more)])
            times = np.concatenate([x for once, _, t in parts for x in (np.ones(len(once) // 4, np.uint32), np.frombuffer(t, np.uint32))])
            found, at = np.unique(rest, return_inverse=True)
            n = np.bincount(at, times, len(found))
            many = n > COMMON
            return pd.DataFrame({"shingle": (np.uint64(bucket) << np.uint64(32) | found[many].astype(np.uint64)).astype(np.int64), "n": n[many].astype(np.int64)})

        now, parts = None, []
        for batch in batches:
            for b, *part in zip(batch.bucket, batch.once, batch.more, batch.times):
                if b != now:
                    if parts:
                        yield done(now, parts)
                    now, parts = b, []
                parts.append(part)
        if parts:
            yield done(now, parts)

    packed = docs.select("text").mapInPandas(count, "bucket long, once binary, more binary, times binary")
    counted = packed.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(add_up, "shingle long, n long")
    most = counted.orderBy(F.desc("n"), "shingle").limit(COMMON_MOST).select("shingle").toPandas()
    return np.sort(most.shingle.to_numpy(np.int64).astype(np.uint64))


def ordered(s: np.ndarray, common: np.ndarray, lead: int) -> np.ndarray:
    """Shingles in the global order: uncommon ones of the zone, those beyond it, common ones; each by hash."""
    zone = int(np.searchsorted(s, np.uint64(int(ZONE * 2**64))))
    if not zone or not len(common):
        return s
    key = s[:zone] >> np.uint64(32 - lead)
    at = np.minimum(np.searchsorted(common, key), len(common) - 1)
    last = common[at] == key
    return np.concatenate([s[:zone][~last], s[zone:], s[:zone][last]])


def sketches(docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """Per row: doc_id, text_hash, n, set_hash (of the whole set, null if empty), grp (a hash of size and prefix), and
    prefix, in the first row of a group that a task sees."""
    lead = _lead_bits(docs.count())
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, words, lead))  # COMMON_MOST numbers at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for text in batch.text:
                s = shingles(text, words)
                n = len(s)
                if not n:
                    rows.append((0, None, None, None))
                    continue
                prefix = ordered(s, common.value, lead)[:prefix_size(n, threshold)].astype(np.int64)
                grp = xxhash.xxh64_intdigest(prefix.tobytes(), seed=n) - (1 << 63)
                rows.append((n, xxhash.xxh128_hexdigest(s.tobytes()), grp, None if grp in seen else prefix))
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(grp)
            out = pd.DataFrame(rows, columns=["n", "set_hash", "grp", "prefix"]).astype({"grp": "Int64"})
            yield pd.concat([batch[["doc_id", "text_hash"]].astype({"doc_id": "Int64"}).reset_index(drop=True), out], axis=1)

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInPandas(run, "doc_id long, text_hash long, n long, set_hash string, grp long, prefix array<long>")


def candidate_pairs(sketched: DataFrame, threshold: int) -> DataFrame:
    """Edges a, b between groups that may hold linked documents."""
    groups = sketched.filter("grp IS NOT NULL").groupBy("grp").agg(F.min("n").alias("n"))
    posted = sketched.filter("prefix IS NOT NULL").select("grp", F.explode("prefix").alias("shingle")).dropDuplicates(["shingle", "grp"])
    # lists are counted map-side and joined back, which Spark splits where one is long; only short ones meet in one task
    lists = posted.groupBy("shingle").agg(F.count(F.lit(1)).alias("length"), F.min("grp").alias("least")).filter("length > 1")
    shared = staged(posted.join(lists, "shingle"), "ngram-shared")
    long = shared.filter((F.col("length") > SHORT) & (F.col("grp") != F.col("least"))).select(F.col("grp").alias("a"), F.col("least").alias("b")).distinct()
    earlier = Window.partitionBy("shingle").orderBy("grp").rowsBetween(-(SHORT - 1), -1)
    short = shared.filter(F.col("length") <= SHORT).select("grp", F.collect_list("grp").over(earlier).alias("before"))
    pairs = short.select(F.col("grp").alias("a"), F.explode("before").alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    pairs = pairs.join(groups.select(F.col("grp").alias("a"), F.col("n").alias("na")), "a").join(groups.select(F.col("grp").alias("b"), F.col("n").alias("nb")), "b")
    # shingles outside the prefix
    outside = F.greatest(*(F.expr(f"({threshold} * n{x} + 99) div 100 - 1") for x in "ab"))
    overlap = F.expr(f"({threshold} * (na + nb) + {99 + threshold}) div {100 + threshold}")
    sizes = F.expr(f"100 * least(na, nb) >= {threshold} * greatest(na, nb)")
    # a pair that also meets in a long list is joined there, so too few shared shingles in short lists rule out the rest
    return long.unionByName(pairs.filter(sizes & (F.col("shared") + outside >= overlap)).select("a", "b"))


def _similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: int) -> np.ndarray:
    """Which pairs with one member in each block (rows ``left`` and ``right``) are similar."""
    sizes = np.array([len(s) for s in sets], np.int64)
    of = np.repeat(np.arange(len(sets)), sizes)
    _, token, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n[token] > 1
    columns, token = np.unique(token[shared], return_inverse=True)
    of = of[shared]
    both = np.zeros((len(left), len(right)))
    place_l, place_r = np.full(len(sets), -1), np.full(len(sets), -1)
    place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(token, kind="stable")
    token, of = token[order], of[order]
    wide = 8192  # columns of a slice of the incidence matrices
    for start in range(0, len(columns), wide):
        a, b = np.searchsorted(token, [start, start + wide])
        t, d = token[a:b] - start, of[a:b]
        x, y = np.zeros((len(left), min(wide, len(columns) - start)), np.float32), np.zeros((len(right), min(wide, len(columns) - start)), np.float32)
        in_l, in_r = place_l[d] >= 0, place_r[d] >= 0
        x[place_l[d[in_l]], t[in_l]] = 1
        y[place_r[d[in_r]], t[in_r]] = 1
        both += x @ y.T
    inter = np.rint(both).astype(np.int64)
    return 100 * inter >= threshold * (sizes[left][:, None] + sizes[right][None, :] - inter)


def _forest(similar: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the similar pairs."""
    root = list(range(max(left.max(), right.max()) + 1))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in zip(*np.nonzero(similar)):
        a, b = int(left[i]), int(right[j])
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def verified_links(members: DataFrame, words: int, threshold: int, every: bool = False) -> DataFrame:
    """Links a, b among ``members`` (cluster, node, n, rows, text), cluster by cluster: with ``every`` all of them, else
    enough for the components.  Rows of a null b give node a's links to other members in a pair of blocks, as a number
    of ``rows``."""
    own = staged(members.select("cluster", "node", "n"), "ngram-members")
    parts = bucket_count(own.count(), least=1)  # a cluster of any size is numbered in buckets, by set size and a hash
    own = own.withColumn("__b", F.col("n").cast("long") * parts + F.pmod(F.xxhash64("node"), F.lit(parts)))
    placed = numbered(own, "__b", [F.col("node")], "place", by=("cluster",))
    keys = staged(placed.select("cluster", "node", "n", F.floor(F.col("place") / BLOCK).alias("block")), "ngram-blocks")
    spans = keys.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = spans.select(F.col("cluster").alias("c2"), F.col("block").alias("j"), F.col("low").alias("low2"))
    # pairs of blocks i <= j of one cluster whose sizes can match
    pairs = spans.join(other, (F.col("cluster") == F.col("c2")) & (F.col("block") <= F.col("j"))).filter(f"100 * high >= {threshold} * low2").select("cluster", F.col("block").alias("i"), "j")
    sides = pairs.select("cluster", "i", "j", F.col("i").alias("block")).unionByName(pairs.filter("i < j").select("cluster", "i", "j", F.col("j").alias("block")))
    dealt = members.join(keys.select("node", "block"), "node").join(sides, ["cluster", "block"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(key, rows):
            nodes, blocks, times, sets = zip(*rows)
            _, i, j = key
            block, times = np.array(blocks), np.array(times, np.float64)  # whole numbers up to 2^53
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            similar = _similar(list(sets), left, right, threshold)
            if i == j:
                np.fill_diagonal(similar, False)
            n = similar @ times[right]
            counts = [(left, n)] if i == j else [(left, n), (right, times[left] @ similar)]
            found = [(left[x], right[y]) for x, y in zip(*np.nonzero(np.triu(similar) if i == j else similar))] if every else _forest(similar, left, right)
            return [(nodes[a], nodes[b], 0) for a, b in found] + [(nodes[a], None, int(k)) for side, ks in counts for a, k in zip(side, ks) if k]

        def framed(out):
            return pd.DataFrame(out, columns=["a", "b", "n"]).astype({"b": "Int64"})

        now, rows, out = None, [], []
        for batch in batches:
            for cluster, i, j, node, block, times, text in zip(batch.cluster, batch.i, batch.j, batch.node, batch.block, batch.rows, batch.text):
                if (cluster, i, j) != now:
                    if len(rows) > 1:
                        out += done(now, rows)
                    now, rows = (cluster, i, j), []
                rows.append((node, block, times, shingles(text, words)))
            if out:
                yield framed(out)
                out = []
        if len(rows) > 1:
            yield framed(done(now, rows))

    dealt = dealt.select("cluster", "i", "j", "node", "block", "rows", "text").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return dealt.mapInPandas(run, "a long, b long, n long")


def _members(docs: DataFrame, words: int, threshold: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sketches of all rows, the classes of equal sets, and the classes that may have links, with a text of each."""
    ship_code(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketched = staged(sketches(docs, words, threshold), "ngram-sketches")
    classes = sketched.filter("set_hash IS NOT NULL").groupBy("set_hash").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min("grp").alias("grp"), F.min("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    classes = staged(classes.select("set_hash", "least_id", "rep.*", "grp", "n", "rows").withColumn("node", F.monotonically_increasing_id()), "ngram-classes")

    edges = staged(candidate_pairs(sketched, threshold), "ngram-candidates")
    several = classes.groupBy("grp").count().filter("count > 1").select("grp", F.col("grp").alias("own"))
    clusters = components(edges).select(F.col("node").alias("grp"), F.col("component").alias("cluster"))
    # a group outside all pairs that holds several classes is a cluster of its own
    alone = several.join(clusters, "grp", "left_anti").select("grp", F.col("own").alias("cluster"))
    chosen = classes.join(clusters.unionByName(alone), "grp").select("node", "cluster", "n", "rows", F.col("doc_id").alias("rep_id"), F.col("text_hash").alias("rep_hash"))
    chosen = staged(chosen, "ngram-chosen")
    # the text hash tells the few documents in clusters from the rest before the text is shuffled
    in_cluster = maybe_among(chosen, F.col("rep_hash"))
    texts = docs.withColumn("th", F.xxhash64("text")).filter(in_cluster(F.col("th")))
    members = chosen.join(texts, (F.col("th") == F.col("rep_hash")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))).dropDuplicates(["node"]).select("cluster", "node", "n", "rows", "text")
    return sketched, classes, staged(members, "ngram-members")


def _joined(docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """Columns of :func:`join_documents`, and component: a number for each component, null for texts without words."""
    sketched, classes, members = _members(docs, words, threshold)
    links = staged(verified_links(members, words, threshold), "ngram-links")
    linked = components(links.filter("b IS NOT NULL").select("a", "b"))
    others = links.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))

    ids = classes.join(linked, "node", "left").join(others, "node", "left").select(
        "set_hash", "least_id", F.coalesce("component", "node").alias("component"), (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    least = ids.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = staged(ids.join(least, "component").select(F.col("set_hash").alias("sh"), "component", "component_id", "n_links"), "ngram-ids")
    return sketched.join(ids, F.col("set_hash") == F.col("sh"), "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("set_hash").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component")


def join_documents(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_shingles, component_id (the least doc_id reachable by links of a Jaccard
    similarity of ``threshold`` per cent or more, its own included), n_links (the other rows it has such a link to).

    Texts without words, empty or null ones have no shingles and no links: their component is their doc_id.  Rows alike
    in text are linked, whatever their ids; rows of a null doc_id take part, and their component is null only if it has
    no other id.  An empty table gives no rows; other columns are ignored.
    """
    return _joined(docs, words, threshold).drop("component")


def similar_classes(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """Every link between different shingle sets, once: doc_id and text_hash of the sets' representatives (the least
    doc_id, then text hash; null first), and the same of the other one, other_id and other_hash.  Their number can grow
    with the square of a group of near copies."""
    _, classes, members = _members(docs, words, threshold)
    links = verified_links(members, words, threshold, every=True).filter("b IS NOT NULL")
    one = classes.select(F.col("node").alias("a"), "doc_id", "text_hash")
    other = classes.select(F.col("node").alias("b"), F.col("doc_id").alias("other_id"), F.col("text_hash").alias("other_hash"))
    return links.join(one, "a").join(other, "b").select("doc_id", "text_hash", "other_id", "other_hash")


def without_copies(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component: the first by doc_id (null last), then text hash; of rows alike in both,
    any one.

    Texts without words are no copies of each other: of those, only rows alike in text and in an id that is not null
    count as one.
    """
    alike = staged(_joined(docs, words, threshold).groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")), "ngram-alike")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    firsts = alike.filter("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("first")).withColumnRenamed("component", "of")
    found = alike.join(firsts, F.col("component") == F.col("of"), "left")
    stays = F.col("component").isNull() | (F.col("first.id").eqNullSafe(F.col("doc_id")) & (F.col("first.hash") == F.col("text_hash")))
    found = found.select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), stays.alias("stays"),
                         ((F.col("n") > 1) & (F.col("component").isNotNull() | F.col("doc_id").isNotNull())).alias("repeated"))
    found = staged(found.filter("NOT stays OR repeated"), "ngram-found")
    # most rows are surely kept; only the others are shuffled to be looked up
    rows = docs.select(F.struct(*named(docs)).alias("row"), F.xxhash64("text").alias("th"), F.col("doc_id").cast("long").alias("id"))
    rows = rows.withColumn("maybe", maybe_among(found, F.col("found_hash"))(F.col("th")))
    looked_up = rows.filter("maybe").join(found, (F.col("th") == F.col("found_hash")) & F.col("id").eqNullSafe(F.col("found_id")), "left")
    single = looked_up.filter("stays IS NULL").select("row")
    repeated = looked_up.filter("stays").dropDuplicates(["id", "th"]).select("row")
    return rows.filter("NOT maybe").select("row").unionByName(single).unionByName(repeated).select("row.*")
