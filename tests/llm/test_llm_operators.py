"""The training-data operators against brute force on small fixtures, with nulls, empty and long texts, ties, repeated
rows, empty tables and clashing extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
FIELDS = ("doc_id long, text string, lang string, source string, n_chars long, shard int, removed string, row string, "
          "verdict string, n long, cluster long, words string, part int, position long, __h long")


def words(seed, n):
    r = random.Random(seed)
    return [r.choice("the of and to in was that river stone light paper north cloud engine garden mirror".split()) + r.choice(["", "", "s", "ed"]) for _ in range(n)]


def prose(seed, n=120):
    w = words(seed, n)
    return "\n".join(" ".join(w[i:i + 30]) for i in range(0, n, 30))


@pytest.fixture(scope="module")
def rows():
    """(doc_id, text, source), all odd cases together."""
    base = [(i, prose(i), f"src{i % 3}" if i % 7 else "src0") for i in range(40)]
    odd = [(100, None, "src1"), (101, "", "src1"), (102, " \n\t ", None), (103, "x", "src2"), (104, "aaaa " * 30_000, "src0"),
           (105, prose(3), "src1"), (106, prose(3), "src2"), (107, prose(3).replace("river", "flood", 1), "src0"),
           (108, "one two three", None), (109, "one two three", "src1"), (110, "\x00 é日本😀\r\n▁▁ <s>", "src0"),
           (None, prose(60), "src0"), (None, None, None), (111, "Released under the MIT License.", "src2"),
           (111, "Released under the MIT License.", "src2"), (112, prose(70), "src1"), (112, prose(71), "src1")]
    return base + odd


def frame(spark, rows):
    made = [(i, t, "en", s, None if t is None else len(t), 1, "r", "w", "v", 2, 3, "x", 4, 5, 6) for i, t, s in rows]
    return spark.createDataFrame(made, FIELDS).repartition(4)


def listed(df):
    return [tuple(r) for r in df.collect()]


# ---- 1: license scan ----------------------------------------------------------------------------------------------

def test_license_scan_against_brute_force(spark):
    from shoplens.llm import license_scan as L

    notice = dict(L.NOTICES)["bsd"]
    texts = ["Licensed under the Apache License, Version 2.0.", "MIT license mit LICENSE", "cc-by 4.0 CC BY", "gnu general public license",
             "gnu general public", None, "", "é mit license é", "x " * 500 + notice + " y", notice.replace("binary forms", "binary or other forms"),
             "mitlicense", "apache apache license license", "Licensed under CC BY-NC 4.0.", notice.replace("binary forms", "compiled files")]
    data = [(i, t, "s") for i, t in enumerate(texts)] + [(1, texts[1], "s"), (None, "mit license", "s"), (4, "apache license", "s")]
    got = sorted(listed(L.scan_licenses(frame(spark, data))), key=str)
    expected = []
    for i, text, _ in data:
        w = re.findall(L.WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))
        found = sorted((k, label) for label, p in L.PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split())
        expected.append((i, len(w), len(found), found[0][0] if found else None, found[-1][0] if found else None, ",".join(sorted({x for _, x in found}))))
    assert [g[:6] for g in got] == sorted(expected, key=str)
    by_id = {g[0]: g for g in got}
    assert by_id[8][6] == "bsd" and by_id[8][7] == 1.0  # a whole notice inside another text
    assert by_id[9][6] == "bsd" and by_id[9][7] == 1.0  # with words put in: two neighbouring diagonals
    assert by_id[13][6] == "bsd" and 0.5 <= by_id[13][7] < 1.0  # with words changed
    assert by_id[6][6] == "" and by_id[6][7] == 0.0
    assert listed(L.scan_licenses(frame(spark, []))) == []


# ---- 2: top-k -----------------------------------------------------------------------------------------------------

def vectors(spark, made):
    return spark.createDataFrame(made, "vec_id long, embedding array<float>, label int, q string, score long").repartition(3)


def test_topk_against_brute_force(spark):
    import math

    import numpy as np

    from shoplens.llm import topk

    r = random.Random(5)
    made = [(i, [round(r.gauss(0, 0.4 + i % 3), 3) for _ in range(8)], 0, "a", 1) for i in range(230)]
    made += [(1000 + i, made[7][1], 0, "a", 1) for i in range(60)]  # ties
    made += [(2000, None, 0, "a", 1), (2020, [1.0, None], 0, "a", 1), (2040, [float("nan")] * 8, 0, "a", 1), (2060, [float("inf")] * 8, 0, "a", 1),
             (2080, [], 0, "a", 1), (2100, [0.5], 0, "a", 1), (None, [1.0] * 8, 0, "a", 1), (20, made[20][1], 0, "a", 1)]
    got = defaultdict(list)
    for q, rank, v, s in sorted(listed(topk.neighbours(vectors(spark, made)))):
        got[q].append((rank, v, s))
    whole = {}
    for i, e, *_ in made:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            whole[i] = [math.floor(64 * float(np.float32(x))) for x in e]
    for q in whole:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:20]
            assert got.pop(q) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert not got
    assert listed(topk.neighbours(vectors(spark, []))) == []
    few = listed(topk.neighbours(vectors(spark, made[:4])))
    assert sorted((q, k) for q, k, *_ in few) == [(0, 1), (0, 2), (0, 3)]


def test_topk_of_repeated_ids(spark):
    """Another vector of the same vec_id is a row of its own, as a candidate and as a query."""
    from shoplens.llm import topk

    r = random.Random(6)
    made = [(i, [float(r.randrange(-9, 9)) for _ in range(5)], 0, "a", 1) for i in range(80)]
    made += [(i, [float(r.randrange(-9, 9)) for _ in range(5)], 0, "a", 1) for i in (0, 0, 20, 33, 33)] + made[:30]
    got = defaultdict(list)
    for q, rank, v, s in sorted(listed(topk.neighbours(vectors(spark, made))), key=lambda x: (x[0], x[1])):
        got[q].append((rank, v, s))
    whole = sorted({(i, tuple(int(64 * x) for x in e)) for i, e, *_ in made})
    want = defaultdict(list)
    for q, u in whole:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(u, v)), i) for i, v in whole if (i, v) != (q, u))[:20]
            want[q] += [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()} and len(got[0]) == 60


def test_topk_searched_share(spark):
    """Far clusters: the bounds leave each query little more than its own cluster."""
    import numpy as np

    from shoplens.llm import topk

    r = np.random.default_rng(2)
    centres = r.normal(0, 40, (16, 4))
    made = [(i, [float(x) for x in centres[i % 16] + r.normal(0, 0.3, 4)], 0, "a", 1) for i in range(16_000)]
    assert topk.searched_share(vectors(spark, made), every=200) < 0.25
    assert topk.searched_share(vectors(spark, [])) == 1.0


def test_topk_of_large_components(spark):
    """Scores beyond 64 bits are the nearest long and never wrap; others of the same block stay exact."""
    import numpy as np

    from shoplens.llm import topk

    made = [(0, [1e300, 1.0]), (1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0**40]), (4, [0.0, 1.0]), (5, [1.0, 3.0])]
    table = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    got = [r[1:] for r in sorted(listed(topk.neighbours(table)))]
    assert got[0] == (1, 1, 2**63 - 1) and got[-1] == (5, 2, -2**63)
    assert got[1:4] == [(2, 5, 2**63 - 1), (3, 3, 2**52), (4, 4, 64 * 64)]
    q, b = np.array([[2**31, 5], [2**40, -1]]), np.array([[2**31, 7], [2**40, 2], [0, 1]])
    want = [[min(max(sum(int(x) * int(y) for x, y in zip(u, v)), -2**63), 2**63 - 1) for v in b] for u in q]
    assert topk._scores(q, b).tolist() == want


def test_topk_prunes_rings(spark):
    """Bounds are valid, and rule rings out."""
    import numpy as np
    import pandas as pd

    from shoplens.llm import topk

    r = np.random.default_rng(1)
    centres = r.normal(0, 300, (6, 4))
    points = np.rint(np.concatenate([c + r.normal(0, 5, (50, 4)) for c in centres])).astype(np.int64)
    d = topk._distances(points, centres)
    ring = d.argmin(1) * topk.RINGS
    table = pd.DataFrame({"ring": ring, "d": d.min(1), "norm2": (points.astype(float) ** 2).sum(1)}).groupby("ring").agg(low=("d", "min"), high=("d", "max"), norm2=("norm2", "max"), n=("d", "size")).reset_index()
    bounds = topk.Rings(centres, table, 4).bounds(points)
    scores = points @ points.T
    for j, k in enumerate(table.ring):
        assert (scores[:, ring == k] <= bounds[:, [j]]).all()
    assert (bounds < np.sort(scores, axis=1)[:, [-20]]).mean() > 0.3
    ranges = tuple(np.array([how(d[ring == k], axis=0) for k in table.ring]) for how in (np.min, np.max))
    closer = topk.Rings(centres, table, 4, ranges).bounds(points)  # by all pivots
    for j, k in enumerate(table.ring):
        assert (scores[:, ring == k] <= closer[:, [j]]).all()
    assert (closer <= bounds).all() and closer.mean() < bounds.mean()


# ---- 3: quality ---------------------------------------------------------------------------------------------------

def test_quality_on_held_out_labels(spark):
    from shoplens.llm import quality

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.judge(docs).select("row.doc_id", "verdict.*").join(labels, "doc_id").toPandas()
    good, bad = judged[judged.quality == 1], judged[judged.quality == 0]
    assert good.keep.mean() >= 0.99 and (~bad.keep).mean() >= 0.9
    assert good.score.mean() > bad.score.mean() + 0.4


def test_quality_odd_rows(spark, rows):
    from shoplens.llm import quality

    docs = frame(spark, rows + [(200, "%%% ### " * 100, "s"), (201, "SHOUT!! LOUD!! NOISE!! " * 30, "s")])
    judged = quality.judge(docs)
    assert judged.count() == len(rows) + 2
    keep = {r.doc_id: r.keep for r in judged.select("row.doc_id", "verdict.keep").collect()}
    assert keep[100] and keep[101] and keep[102] and keep[103] and keep[1]
    assert judged.select("row.*").schema == docs.schema
    assert quality.judge(frame(spark, [])).collect() == []


def test_quality_has_no_size_switch(spark):
    """Votes do not turn with the length alone, and the scorer rejects where no labeller does."""
    from shoplens.llm import quality as Q

    at = Q.LABELLERS.index("variety")
    spam, passage = "click here for the best offer ".split(), words(1, 100)
    for n in (60, 1998, 2004, 20_004, 250_002):
        assert Q.votes(*Q.statistics(" ".join((spam * (n // 6 + 1))[:n]))[:2])[at] == 1, n
    for n in (1900, 2100, 210_000):
        assert Q.votes(*Q.statistics(" ".join((passage * (n // 100 + 1))[:n]))[:2])[at] == 1, n
    r = random.Random(8)
    long = [f"The, word{r.randrange(3000)}. THE" for _ in range(70_000)]
    short, whole = (Q.statistics(" ".join(long[:k]))[0] for k in (60_000, 70_000))
    assert abs(short - whole).max() < 0.01 and Q.votes(whole, 210_000)[at] == 2

    m, n, _ = Q.statistics(prose(1))
    assert 1 not in Q.votes(m, n)
    pattern = sum(v * 3**i for i, v in enumerate(Q.votes(m, n)))
    for bias, expected in ((-3.0, False), (3.0, True)):
        weights = [0.0] * Q.SLOTS + [bias]
        judged = Q.verdict({"weights": Q.np.array(weights), "posterior": {pattern: 0.9}})
        assert frame(spark, [(1, prose(1), "s")]).select(judged("text").alias("v")).first().v.keep is expected


def brute_quality(texts):
    """(score, posterior, keep) of each text, by plain loops: labellers by their rules, EM document by document, and
    gradient descent over a dense matrix."""
    import math

    import numpy as np
    import xxhash

    from shoplens.llm import quality as Q

    def measures(text):
        w = [x.strip(".,") for x in re.findall(r"[^ \t\n\r\f\v]+", re.sub("[A-Z]", lambda x: x[0].lower(), text))]
        n, size = len(w), len(text.encode())
        if not n:
            return [0.0] * 7, 0
        odd = sum(1 for c in text if c < "\x80" and not re.match(r"[A-Za-z0-9 \n\t\r.,;:'\"?()!-]", c))
        ascii_letters, wide = len(re.findall("[A-Za-z]", text)), sum(len(c.encode()) for c in text if c >= "\x80")
        spans = [w[i:i + 500] for i in range(0, n - 500, 500)] + [w[-500:]]
        fives = [tuple(w[i:i + 5]) for i in range(max(1, n - 4))]
        near = sum(len(set(x)) for x in spans) / sum(map(len, spans))
        return [odd / size, len(re.findall("[A-Z]", text)) / max(1, ascii_letters + wide), text.count("!") / n, min(near, len(set(fives)) / len(fives)),
                sum(a == b for a, b in zip(w, w[1:])) / n, sum(x.encode() in Q.FUNCTION_WORDS for x in w) / n, size / n], n

    def cast(m, n):
        good = [m[0] < 0.005, m[1] < 0.15, m[2] < 0.02, n >= 20 and m[3] > 0.3, m[4] < 0.05, n >= 20 and m[5] > 0.08, n >= 20 and 4 < m[6] < 12]
        bad = [m[0] > 0.03, m[1] > 0.5, m[2] > 0.4, n >= 20 and m[3] < 0.12, m[4] > 0.2, n >= 20 and m[5] < 0.005, n >= 20 and (m[6] < 3 or m[6] > 20)]
        return [0] * 7 if n < 6 else [1 if b else 2 if g else 0 for g, b in zip(good, bad)]

    found = [measures(t) for t in texts]
    voted = [cast(m, n) for m, n in found]
    post = [0.1 if 1 in v else 0.95 if 2 in v else 0.9 for v in voted]
    for _ in range(60):
        share, chance = sum(post) / len(post), {}
        for k, belief in ((0, (0.4, 0.3, 0.3)), (1, (0.4, 0.01, 0.59))):
            weight = [p if k else 1 - p for p in post]
            for i in range(7):
                counts = [sum(w for w, v in zip(weight, voted) if v[i] == x) + belief[x] * 0.01 * len(post) for x in range(3)]
                for x in range(3):
                    chance[k, i, x] = counts[x] / sum(counts)
        share = min(max(share, 0.5), 0.99)
        odds = [math.log(share / (1 - share)) + sum(math.log(chance[1, i, x] / chance[0, i, x]) for i, x in enumerate(v)) for v in voted]
        post = [1 / (1 + math.exp(-max(-50, min(50, o)))) for o in odds]

    x = np.zeros((len(texts), 4097))
    for row, text, (m, n) in zip(x, texts, found):
        classes = [ord("a") if c >= 128 or chr(c).islower() else ord("A") if chr(c).isupper() else ord("0") if chr(c).isdigit() else 32 if c in (9, 11, 12, 13) else c
                   for c in text.encode()]
        pairs = Counter(((a * 256 + b) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 52 for a, b in zip(classes, classes[1:]))
        for slot, count in pairs.items():
            row[slot] += math.sqrt(count / (len(classes) - 1))
        if n >= 6:
            for name, value in zip(Q.LABELLERS, m):
                row[xxhash.xxh32_intdigest(f"{name}>{sum(b < value for b in Q._BINS)}", seed=3) % 4096] += 0.5
        row[-1] = 1
    taught = np.array([n >= 20 for _, n in found])
    target = np.array(post)[taught]
    weight = (target / max(target.sum(), 1) + (1 - target) / max((1 - target).sum(), 1))
    weight /= weight.sum()
    w, seen = np.zeros(4097), np.full(4097, 1e-6)
    for _ in range(200):
        g = x[taught].T @ (weight * (1 / (1 + np.exp(-np.clip(x[taught] @ w, -50, 50))) - target)) + 1e-5 * w
        seen += g * g
        w -= 0.2 * g / np.sqrt(seen)
    scores = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
    return [(1.0, p, True) if n < 6 else (float(s), p, bool(s >= 0.5 or n < 20 and (p >= 0.5 or 1 not in v))) for s, p, v, (_, n) in zip(scores, post, voted, found)]


def test_quality_against_brute_force(spark, rows):
    from shoplens.llm import quality

    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    data = [tuple(r) for r in given] + [(10_000 + i, t, s) for i, (_, t, s) in enumerate(rows) if len(t or "") < 50_000]
    got = {r.doc_id: (r.score, r.posterior, r.keep) for r in quality.judge(frame(spark, data)).select("row.doc_id", "verdict.*").collect()}
    want = brute_quality([t or "" for _, t, _ in data])
    assert len(got) == len(data)
    for (i, _, _), (score, post, keep) in zip(data, want):
        assert got[i][1] == pytest.approx(post, abs=1e-6), i
        assert got[i][0] == pytest.approx(score, abs=1e-4), i
        assert got[i][2] is keep or abs(score - 0.5) < 1e-4, i
    assert {k for _, _, k in got.values()} == {True, False}


def test_em_finds_accuracies():
    import numpy as np

    from shoplens.llm import quality

    r = np.random.default_rng(0)
    truth = r.random(20_000) < 0.8
    accuracy = [0.95, 0.9, 0.85, 0.95, 0.9, 0.8, 0.9]
    cast = np.stack([np.where(r.random(20_000) < 0.2, 0, np.where((r.random(20_000) < a) == truth, 2, 1)) for a in accuracy], 1)
    patterns, counts = np.unique(cast, axis=0, return_counts=True)
    post, chance, prior = quality.estimate(patterns, counts.astype(float))
    assert abs(prior - 0.8) < 0.05
    assert np.allclose(chance[1, :, 2] / (chance[1, :, 1] + chance[1, :, 2]), accuracy, atol=0.06)


# ---- 4: fingerprints ----------------------------------------------------------------------------------------------

def test_fingerprints_against_brute_force(spark, rows):
    from shoplens.llm import fingerprint as P

    unique = [r for r in rows if r[0] is not None and r[0] not in (111, 112)] + [(-5, prose(90), "s"), (10**15, prose(91), "s")]
    got = {r.doc_id: r for r in P.fingerprints(frame(spark, unique)).collect()}
    ordered = sorted((i, t or "") for i, t, _ in unique)
    assert len(got) == len(ordered)
    chunks = lambda t: set(P.digests(t.encode(), P.cuts(t.encode())))
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        gone = len(text) // 4
        edited = text[:len(text) - gone] + after[:gone]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert P.unpacked(r.fingerprint) == chunks(text) and P.unpacked(r.edited_fingerprint) == chunks(edited)
        assert r.near_edited == P.likeness(chunks(text), chunks(edited)) and r.near_next == P.likeness(chunks(text), chunks(after))
    assert got[105].fingerprint == got[106].fingerprint and got[105].near_next == 1.0
    everything = P.fingerprints(frame(spark, rows)).collect()
    assert len(everything) == len(rows)
    assert P.fingerprints(frame(spark, [])).collect() == []
    (alone,) = P.fingerprints(frame(spark, [(1, "abcdefgh", "s")])).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


def test_fingerprints_of_hot_and_outlying_ids(spark):
    """One outlying id, a third of all rows without id and a third with one id are spread over the partitions."""
    from shoplens.llm import fingerprint as P

    least = -(1 << 63)
    data = [(None, f"no id {i} " + prose(i, 12), "s") for i in range(120)] + [(7, f"hot {i} " + prose(i, 12), "s") for i in range(120)]
    data += [(i * 3 + 100, f"own {i} " + prose(i, 12), "s") for i in range(120)] + [(least, "the least id", "s"), (1 << 62, "far out", "s")]
    docs = frame(spark, data)
    laid = P._in_order(docs.select("doc_id", "text")).collect()
    sizes = Counter(r.part for r in laid if not r.guest)
    assert sum(sizes.values()) == len(data) and max(sizes.values()) <= 4 * len(data) / 16
    assert sorted(r.part for r in laid if r.guest) == sorted(sizes)
    order = {}
    for r in docs.select("doc_id", "text", F.xxhash64("text").alias("th")).collect():
        order[r.text] = (r.doc_id is not None, r.doc_id or 0, r.th)
    texts = sorted(order, key=order.get)
    got = {r.edited_sha256 for r in P.fingerprints(docs).collect()}
    want = {hashlib.sha256((t[:len(t) - len(t) // 4] + after[:len(t) // 4]).encode()).hexdigest() for t, after in zip(texts, texts[1:] + texts[:1])}
    assert got == want


def test_ranks_of_rows_without_ids_are_spread(spark):
    """Rows that share an id, or have none, fall into many buckets of the shuffle by hash."""
    from shoplens.llm import common, mixing, sharding

    taken = []
    real = common.numbered
    data = [(None, f"text {i}", "s") for i in range(400)]
    for module, call in ((sharding, lambda d: sharding.assign_shards(d)), (mixing, lambda d: mixing.mix(d))):
        module.numbered = lambda df, bucket, *a, **k: taken.append(df.select(bucket).distinct().count()) or real(df, bucket, *a, **k)
        try:
            assert call(frame(spark, data)).count() == 400
        finally:
            module.numbered = real
    assert len(taken) == 3 and min(taken) > 50


def test_chunks_resist_shifts():
    from shoplens.llm import fingerprint as P

    text = " ".join(words(1, 3000)).encode()
    ends = P.cuts(text)
    assert ends[-1] == len(text) and max(b - a for a, b in zip([0] + ends, ends)) <= P.MOST
    own = set(P.digests(text, ends))
    moved = b"something new in front, " + text
    assert P.likeness(own, set(P.digests(moved, P.cuts(moved)))) > 0.95


# ---- 5: n-gram join -----------------------------------------------------------------------------------------------

def brute_components(rows):
    """By repeated passes over all pairs; keyed by row number."""
    def shingled(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [shingled(t) for _, t, _ in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            o = len(sets[a] & sets[b])
            if sets[a] and 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _, _), g in zip(rows, group):
        least[g] = min([x for x in (least.get(g), i) if x is not None], default=None)
    return sorted(((i, len(s), least[g]) for (i, _, _), s, g in zip(rows, sets, group)), key=str)


def near_copies(seed, n, share):
    r, base = random.Random(seed), words(seed, 150)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, share)):
            w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_ngram_join_against_brute_force(spark, rows):
    from shoplens.llm import ngram_join as N

    data = rows + [(300 + i, t, "s") for i, t in enumerate(near_copies(1, 90, 6) + near_copies(2, 12, 4) + near_copies(3, 5, 2))]
    got = N.join_documents(frame(spark, data)).select("doc_id", "n_shingles", "component_id")
    assert sorted(listed(got), key=str) == brute_components(data)
    assert listed(N.join_documents(frame(spark, []))) == []


def test_ngram_join_at_the_threshold(spark):
    """Sets of exactly 80 per cent link, sets just below don't; short sets too."""
    from shoplens.llm import ngram_join as N

    data = []
    for k, n in enumerate((8, 13, 22, 40, 53, 104)):
        w = [f"a{k}x{i}" for i in range(n)]
        for cut in range(n // 3):
            data.append((1000 * k + cut, " ".join(w[:n - cut]), "s"))
    got = N.join_documents(frame(spark, data)).select("doc_id", "n_shingles", "component_id")
    assert sorted(listed(got), key=str) == brute_components(data)


def test_long_lists_and_several_blocks(spark, monkeypatch):
    """With tiny limits, every step of a large corpus is taken."""
    from shoplens.llm import ngram_join as N

    monkeypatch.setattr(N, "SHORT", 3)
    data = [(i, t, "s") for i, t in enumerate(near_copies(4, 40, 16) + near_copies(5, 25, 30))]
    docs = frame(spark, data)
    edges = N.candidate_pairs(N.sketches(docs.select("doc_id", "text"), 5, 80).cache(), 80)
    assert edges.count() > 0
    monkeypatch.setattr(N, "BLOCK", 7)
    got = N.join_documents(docs).select("doc_id", "n_shingles", "component_id")
    assert sorted(listed(got), key=str) == brute_components(data)


def test_ngram_join_counts_every_link(spark, rows, monkeypatch):
    """A chain and a triangle differ in their links; every link between different sets is given once."""
    from shoplens.llm import ngram_join as N

    monkeypatch.setattr(N, "BLOCK", 7)
    w = [f"a{i}" for i in range(100)]
    chain = [" ".join(w[k:k + 60]) for k in (0, 6, 12)]  # neighbours share 50 of 62 shingles, the ends 44 of 68
    triangle = [" ".join(f"b{i}" for i in range(k, k + 60)) for k in (0, 2, 4)]
    data = rows + [(300 + i, t, "s") for i, t in enumerate(near_copies(1, 40, 12) + near_copies(1, 40, 12)[:5] + chain + triangle)]

    def shingled(t):
        v = (t or "").encode().lower().split()
        return frozenset(tuple(v[i:i + 5]) for i in range(len(v) - 4)) if len(v) >= 5 else frozenset([tuple(v)] if v else [])

    sets = [shingled(t) for _, t, _ in data]
    alike = lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)
    expected = sorted(((d[0], sum(alike(a, b) for k, b in enumerate(sets) if k != i) if a else 0) for i, (d, a) in enumerate(zip(data, sets))), key=str)
    got = sorted(listed(N.join_documents(frame(spark, data)).select("doc_id", "n_links")), key=str)
    assert got == expected
    by_id = dict(got)
    assert [by_id[345 + k] for k in range(6)] == [1, 2, 1, 2, 2, 2]

    classes = list({s for s in sets if s})
    pairs = {frozenset([a, b]) for i, a in enumerate(classes) for b in classes[:i] if alike(a, b)}
    text = {d[0]: s for d, s in zip(data, sets)}
    found = [frozenset([text[r.doc_id], text[r.other_id]]) for r in N.similar_classes(frame(spark, data)).collect()]
    assert len(found) == len(pairs) and set(found) == pairs


def test_without_copies_keeps_one_of_each(spark, rows):
    from shoplens.llm import ngram_join as N

    docs = frame(spark, rows)
    kept = N.without_copies(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[3] == 1 and ids[105] == ids[106] == ids[107] == 0 and ids[108] == 1 and ids[109] == 0
    assert ids[100] == ids[101] == ids[102] == 1  # nothing to compare


def test_without_copies_drops_repeated_rows(spark):
    """One row of a component stays where copies share an id, lack one, or are rows alike."""
    from shoplens.llm import ngram_join as N

    near = prose(80).replace("river", "flood", 1)
    data = ([(1, prose(81), "a")] * 3 + [(2, prose(80), "a"), (2, near, "b"), (2, near, "b"), (3, near, "c")]
            + [(None, prose(82), "a")] * 2 + [(None, prose(83), "a"), (4, prose(83), "a"), (5, prose(84), "a")]
            + [(6, "", "a")] * 2 + [(7, "", "a"), (None, "", "a"), (None, "", "a")])
    for table in (data, data + data):
        kept = Counter(r.doc_id for r in N.without_copies(frame(spark, table)).collect())
        assert kept.pop(None) == 1 + 2 * len(table) // len(data) and kept == {1: 1, 2: 1, 4: 1, 5: 1, 6: 1, 7: 1}


def test_components_against_union_find(spark):
    from shoplens.llm.components import components

    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (5, 5)]
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
        if not changed:
            break
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    got = {tuple(x) for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, m) for x, m in root.items() if x not in loops}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- 6: sharding --------------------------------------------------------------------------------------------------

def test_sharding_laws(spark, rows):
    from shoplens.llm.sharding import assign_shards

    got = assign_shards(frame(spark, rows), n_shards=5).collect()
    assert len(got) == len(rows)
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(5)]
    assert max(counts) - min(counts) <= 1
    source = Counter(s for _, _, s in rows)
    for k in range(5):
        here = Counter(r.source for r in got if r.shard == k)
        assert all(abs(here[s] - n / 5) <= 2 for s, n in source.items())
    assert assign_shards(frame(spark, [])).collect() == []
    assert sorted(r.shard for r in assign_shards(frame(spark, rows[:3]), n_shards=24).collect()) == [0, 8, 16]


def test_sharding_over_many_buckets(spark, monkeypatch):
    from shoplens.llm import common, sharding

    docs = frame(spark, [(i, f"t{i}", "hot" if i % 3 else f"s{i % 30}") for i in range(500)])
    whole = sorted(listed(sharding.assign_shards(docs, 7)), key=str)
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", 10)
    assert sorted(listed(sharding.assign_shards(docs, 7)), key=str) == whole


# ---- 7: piece encoding --------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import sentencepiece

    from shoplens.llm.pieces import default_model

    return sentencepiece.SentencePieceProcessor(model_file=default_model())


def test_pieces_equal_the_library(spark, rows, library):
    from shoplens.llm.pieces import default_model, encode_documents

    got = Counter(listed(encode_documents(frame(spark, rows), default_model())))
    expected = Counter()
    for i, text, _ in rows:
        ids = library.encode(text or "")
        expected[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())] += 1
    assert got == expected
    assert encode_documents(frame(spark, []), default_model(), with_ids=True).collect() == []


def test_pieces_on_random_strings(library):
    from shoplens.llm.pieces import PieceCodec, default_model

    coder, r = PieceCodec(default_model()), random.Random(11)
    letters = [chr(x) for x in range(128)] + list("▁▁  é日한ßñ😀�\U0010ffff́") + ["</s>", "the ", "  ", "aaaa", "{\r", "-----", "====", "<0x0A>"]
    for _ in range(4000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 50)))
        ids = library.encode(text)
        assert coder.encode(text) == ids, text
        assert coder.decode(ids) == library.decode(ids), text
    for _ in range(500):  # any ids, broken byte runs among them
        ids = [r.choice([r.randrange(3, 260), r.randrange(3, 32_000)]) for _ in range(r.randint(0, 12))]
        assert coder.decode(ids) == library.decode(ids), ids


# ---- 8: chat format -----------------------------------------------------------------------------------------------

def test_chat_reads_back(spark):
    from shoplens.llm import chat

    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user<|body|>hi<|end|>", "<\\s> <\\\\|end|>", "<|image:0|>", "", None, "a\n😀 [INST", "<" * 50 + "s>"]
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", nasty[(c + t) % len(nasty)], 1) for c in range(4) for t in range(5)]
    turns += [(None, 0, None, "x", 1), (None, None, "assistant", "y", 1), (7, 1, "assistant", "twice", 1), (7, 1, "assistant", "twice", 1)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, formatted long").repartition(5)
    formatted = chat.format_chats(df)
    out = {r.conv_id: r for r in chat.conversation_digests(formatted).collect()}
    for c in {t[0] for t in turns}:
        own = [(t, r or "", x or "") for conv, t, r, x, _ in turns if conv == c]
        own = sorted(own, key=lambda x: (-1 if x[0] is None else x[0], x[1:]))
        assert out[c].n_turns == len(own)
        assert out[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        said = "".join(x for _, r, x in own if r == "assistant")
        assert (out[c].loss_chars, out[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    for r in formatted.collect():
        body = r.formatted[len(chat.TURN):-len(chat.END)]
        assert not any(x in body.replace(chat.BODY, "", 1) for x in ("<s>", "</s>", "[INST]", "[/INST]", chat.TURN, chat.BODY, chat.END))
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.format_chats(empty)).collect() == []


def test_chat_takes_malformed_parts(spark):
    import json

    from shoplens.llm import chat

    deep = "[" * 100_000 + "]" * 100_000
    parts = [
        [{"type": "text", "text": 12}, {"type": "text", "text": {"a": [None]}}, {"text": False}],
        [{"type": "image", "ref": "i", "width": "wide", "height": -3}, {"type": "image", "ref": 7, "width": "1024", "height": 1e300}],
        [{"type": "audio", "seconds": "2s"}, {"type": "audio", "seconds": float("nan")}, {"type": "audio", "seconds": 1.2}, {"type": "audio", "seconds": True}],
        [{"type": "document", "pages": [1]}, {"type": "document", "pages": 2.5}],
        [{"type": "video", "ref": "v.mp4", "text": "see </s>"}, {"type": ["x"], "ref": {"u": 1}}, {"type": 5}],
        [{"type": "text", "text": "half \ud800 and <|image:3|>"}],
    ]
    raw = [json.dumps(p) for p in parts] + [deep, '[{"text": ' + deep + "}]", "[1]", "", "[]", "x" * 3_000_000]
    df = spark.createDataFrame([(1, i, "assistant", p) for i, p in enumerate(raw)], "conv_id long, turn long, role string, parts string")
    out = {r.turn: r for r in chat.format_chats(df).collect()}
    assert len(out) == len(raw)
    said = {t: "".join(chat.unescape(r.formatted[s.start:s.start + s.length]) for s in r.loss_spans) for t, r in out.items()}
    assert said[0] == '12{"a": [null]}false' and said[5] == "half \ufffd and <|image:3|>"
    assert [(a.ref, a.tokens) for a in out[1].attachments] == [("i", 85 + 170), ("7", 85 + 170 * 2)]
    assert [a.tokens for a in out[2].attachments] == [25, 25, 50, 25]
    assert [a.tokens for a in out[3].attachments] == [1500, 4500]
    assert [(a.kind, a.ref, a.tokens) for a in out[4].attachments] == [("video", "v.mp4", 0), ('["x"]', '{"u": 1}', 0)] and said[4] == "see </s>"
    assert [said[i] for i in range(6, 12)] == [deep, raw[7], "[1]", "", "", "x" * 3_000_000]
    for r in out.values():
        assert "".join(t for _, t in chat.read_turns(r.formatted)) == said[r.turn]
        r.formatted.encode()
    assert chat.conversation_digests(chat.format_chats(df)).first().n_turns == len(raw)


def test_chat_parts(spark):
    import json

    from shoplens.llm import chat

    parts = [{"type": "text", "text": "look "}, {"type": "image", "ref": "a.png", "width": 1024, "height": 600}, {"type": "text", "text": " and <|image:0|> "},
             {"type": "audio", "ref": "b.wav", "seconds": 2.5}, {"type": "document", "ref": "c.pdf", "pages": 3}]
    df = spark.createDataFrame([(1, 0, "assistant", json.dumps(parts)), (1, 1, "user", None), (1, 2, "user", "no json")], "conv_id long, turn long, role string, parts string")
    out = sorted(chat.format_chats(df).collect(), key=lambda r: r.turn)
    first = out[0]
    assert first.formatted == "<|turn|>assistant<|body|>look <|image:0|> and <\\|image:0|> <|audio:1|><|document:2|><|end|>"
    assert [(a.kind, a.ref, a.tokens) for a in first.attachments] == [("image", "a.png", 85 + 170 * 4), ("audio", "b.wav", 75), ("document", "c.pdf", 4500)]
    assert first.media_tokens == 85 + 680 + 75 + 4500
    said = "".join(chat.unescape(first.formatted[s.start:s.start + s.length]) for s in first.loss_spans)
    assert said == "look  and <|image:0|> "
    assert out[2].formatted == "<|turn|>user<|body|>no json<|end|>" and out[2].loss_spans == []


# ---- 9: mixing ----------------------------------------------------------------------------------------------------

def test_mixing_stays_within_a_block(spark):
    from shoplens.llm import mixing

    rows = [(i, f"t{i}", s) for i, s in enumerate(["hot"] * 400 + ["b"] * 150 + ["c"] * 60 + [None] * 30)]
    weights = {"hot": 0.5, "b": 0.3, "c": 0.15, None: 0.05}
    got = sorted(mixing.mix(frame(spark, rows), weights, block_rows=2, period=64).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(rows))) and Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    assert all(r.release <= r.slot < r.deadline for r in got)
    slots = mixing.quantised(weights, 64)
    share = {s: n / 64 for s, n in slots.items()}
    last = {s: max(r.slot for r in got if r.source == s) for s in weights}
    by_slot = {r.slot: r.source for r in got}
    done = Counter()
    for t in range(min(last.values())):  # until a source runs out
        done[by_slot[t]] += 1
        assert all(abs(done[s] - share[s] * (t + 1)) < 1 for s in weights)
    assert mixing.mix(frame(spark, [])).collect() == []


def test_pfair_windows():
    from shoplens.llm import mixing

    r = random.Random(2)
    for _ in range(30):
        slots = mixing.quantised({f"s{i}": r.random() + 0.001 for i in range(r.randint(1, 40))}, 512)
        made = mixing.pfair(slots)
        assert sum(slots.values()) == 512 and sorted(x[4] for x in made) == list(range(512))
        assert all(release <= t < deadline for _, _, release, deadline, t in made)


def test_mixing_follows_the_given_weights(spark):
    """Over many periods' worth of slots, no source strays a block from its exact weight, with one source hot or not."""
    from shoplens.llm import mixing

    for counts in ({f"s{i}": 50_000 for i in range(20)}, {f"s{i}": 100 for i in range(1000)} | {"hot": 100_000, None: 40}):
        weights = mixing.target_weights(counts)
        blocks, whole = {s: -(-n // 16) for s, n in counts.items()}, sum(weights.values())
        done, worst = Counter(), 0
        for s, block, release, deadline, t in mixing.schedule(blocks, mixing.whole_weights(counts)):
            assert block == done[s] and t == done.total() and release <= t < deadline
            worst = max(worst, abs(done[s] - weights[s] / whole * t), abs(done[s] + 1 - weights[s] / whole * (t + 1)))
            done[s] += 1
            if done[s] == blocks[s]:
                break
        assert worst < 1 and done.total() > 3000, (worst, done.total())

    rows = [(i, f"t{i}", f"s{i % 20}") for i in range(6000)] + [(10_000 + i, "x", "hot") for i in range(3000)]
    got = sorted(mixing.mix(frame(spark, rows), block_rows=1).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(9000)) and {r.doc_id for r in got} == {i for i, _, _ in rows}
    weights = mixing.target_weights(Counter(s for _, _, s in rows))
    share, done = {s: w / sum(weights.values()) for s, w in weights.items()}, Counter()
    for t, r in enumerate(got):
        assert r.block == done[r.source] and r.release <= r.slot < r.deadline
        done[r.source] += 1
        if t % 100 == 99:
            assert all(abs(done[s] - share[s] * (t + 1)) < 1 for s in share), t
        if done[r.source] == (3000 if r.source == "hot" else 300):
            break
    assert t > 5000


def test_mixed_layout_keeps_rows(spark, rows):
    from shoplens.llm import mixing

    docs = frame(spark, rows)
    out = mixing.in_mixed_order(docs)
    assert out.schema == docs.schema
    assert Counter(map(str, out.collect())) == Counter(map(str, docs.collect()))


# ---- 10: line dedup -----------------------------------------------------------------------------------------------

def test_line_dedup_deletes_later_runs(spark):
    from shoplens.llm.line_dedup import dedup_lines

    r = random.Random(9)
    line = lambda n: " ".join(r.choice(words(r.randrange(10**6), 3)) + str(r.randrange(10**5)) for _ in range(n))
    passage = [line(60)]
    several = [line(9) for _ in range(8)]  # 72 words on eight lines
    short = [line(6)]
    data = []
    for i in range(30):
        own = [line(15) for _ in range(4)]
        body = own[:2] + (passage if i % 3 == 0 else []) + own[2:3] + (several if i % 5 == 0 else []) + short + own[3:]
        data.append((i, "\n".join(body), "s"))
    data += [(50, None, "s"), (51, "", "s"), (52, "\n\n", "s"), (53, data[1][1], "s"), (None, "\n".join(several), "s"), (54, "\n".join([line(40)] * 5), "s")]
    docs = frame(spark, data)
    got = dedup_lines(docs)
    assert got.columns[:len(docs.columns)] == docs.columns
    out = defaultdict(list)
    for x in got.collect():
        out[x.doc_id].append(x)
    assert sum(map(len, out.values())) == len(data)
    first = {}
    for i, text, _ in sorted(data, key=lambda x: (-1 if x[0] is None else x[0])):
        for at in (text or "").split("\n"):
            first.setdefault(at, i)
    for i, text, _ in data:
        if i in (50, 51, 52, 54):
            continue
        kept = out[i][0].text.split("\n")
        for part in (passage, several):
            if set(part) <= set(text.split("\n")):
                assert (set(part) <= set(kept)) == (first[part[0]] == i) and (first[part[0]] == i or not set(part) & set(kept))
    assert out[53][0].text.strip() in ("", short[0]) and out[1][0].text.split("\n") == data[1][1].split("\n")[:len(data[1][1].split("\n"))]
    assert out[50][0].text is None and out[51][0].text == "" and out[52][0].text == "\n\n" and out[54][0].text.count("\n") == 0
    assert out[54][0]["__n_lines"] == 5 and out[54][0]["__n_removed"] == 4
    # the first place of every line stays
    remaining = Counter(x for rows in out.values() for row in rows for x in (row.text or "").split("\n"))
    assert all(remaining[x] >= 1 for x in first if x)
    assert dedup_lines(frame(spark, [])).collect() == []


def test_line_dedup_against_all_pairs(spark):
    """On real rows: what goes stands in an earlier place, and no later run of 50 words or more keeps a whole fingerprint."""
    from shoplens.llm.line_dedup import GRAM_WORDS, dedup_lines

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    places = defaultdict(list)
    for i in sorted(before):
        for n, x in enumerate((before[i] or "").split("\n")):
            places[x.strip(" ")].append((i, n))
    for i in before:
        a, b = (before[i] or "").split("\n"), (after[i] or "").split("\n")
        assert len(b) <= len(a)
        gone = Counter(a) - Counter(b)
        assert all(places[x.strip(" ")][0] < (i, a.index(x)) or a.count(x) > 1 for x in gone if x.strip())
        for n, x in enumerate(a):  # a repeated line of 50 words is a run by itself
            if len(x.split()) >= 50 and places[x.strip(" ")][0] != (i, n):
                assert Counter(b)[x] < Counter(a)[x]
    assert sum(len(t or "") for t in after.values()) < sum(len(t or "") for t in before.values())
    assert GRAM_WORDS == 25


def whole_runs(data, gram_words):
    """Brute force: per (doc_id, text) the numbers of the lines in equal runs, to both true ends, with an earlier place."""
    docs = sorted({(i, t) for i, t, _ in data}, key=lambda d: d[0])
    lines = [[(n, x.strip(" ")) for n, x in enumerate(t.split("\n")) if x.split()] for _, t in docs]
    gone = defaultdict(set)
    for b in range(len(docs)):
        for a in range(b + 1):
            for shift in range(-len(lines[a]), len(lines[b])):  # a diagonal: line k of a beside line k + shift of b
                if a == b and shift <= 0:
                    continue
                run = []
                for k in range(len(lines[a]) + 1):
                    if k < len(lines[a]) and 0 <= k + shift < len(lines[b]) and lines[a][k][1] == lines[b][k + shift][1]:
                        run.append(k + shift)
                        continue
                    if sum(len(lines[b][j][1].split()) for j in run) >= gram_words:
                        gone[docs[b]] |= {lines[b][j][0] for j in run}
                    run = []
    return gone


def test_line_dedup_against_whole_runs(spark):
    """Runs go to their true ends, beyond long lines, whichever earlier place holds them."""
    from shoplens.llm.line_dedup import dedup_lines

    r = random.Random(5)
    line = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    text = lambda *sizes: [line(n) for n in sizes]
    tailed, headed, four = text(10, 22, 93, 2), text(5, 360, 7), line(31)
    turns = [line(11)] + [four] * 4 + [line(20)]  # every copy of the line meets its first place first
    shared = text(8, 8, 30, 8, 8)
    data = [(1, tailed), (2, tailed), (3, headed), (4, text(30) + headed + text(30)), (5, turns), (6, turns),
            (7, text(9) + shared[2:3] + text(9)), (8, text(9) + shared + text(9)), (9, text(9) + shared + ["", " "] + text(9)), (10, shared[1:4] * 2)]
    pool = text(2, 3, 6, 6, 9, 14, 26, 60)
    data += [(20 + i, [r.choice(pool) if r.random() < 0.8 else line(7) for _ in range(r.randrange(1, 15))]) for i in range(40)]
    data = [(i, "\n".join(x), "s") for i, x in data]
    got = {x.doc_id: x.text for x in dedup_lines(frame(spark, data)).collect()}
    gone = whole_runs(data, 25)
    assert got[2] == got[6] == "" and got[4].count("\n") == 1
    for i, t, _ in data:
        assert got[i] == "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i, t]), i


def test_line_dedup_meets_every_earlier_place(spark):
    """The first holder of a gram need not be the one that holds the run around it."""
    from shoplens.llm.line_dedup import dedup_lines

    r = random.Random(6)
    line = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    gram, before, after, four, last = line(26), line(20), line(20), line(31), line(20)
    data = [(1, [line(9), gram, line(9)]), (2, [before, gram, after]), (3, [line(9), before, gram, after, line(9)]),
            (4, [line(11), four, four, four, four, last]), (5, [four, last, line(9)])]
    got = {x.doc_id: x["__n_removed"] for x in dedup_lines(frame(spark, [(i, "\n".join(x), "s") for i, x in data])).collect()}
    assert got == {1: 0, 2: 1, 3: 3, 4: 3, 5: 2}


def test_line_dedup_winnows(spark):
    """Fingerprints are the windows' least lines; only windows of a shared one are compared; adjacent windows share theirs."""
    from shoplens.llm.line_dedup import shared_fingerprints, windows

    r = random.Random(8)
    line = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    passage = [line(n) for n in (9, 12, 7, 30, 3)]
    data = [(i, "\n".join([line(r.randrange(2, 20)) for _ in range(12)] + passage * (i in (3, 8)) + [line(4)]), "s") for i in range(12)] + [(None, "\n".join(passage), "s")]
    found = windows(frame(spark, data)).collect()
    texts = {i: t.split("\n") for i, t, _ in data}
    for w in found:
        own = texts[w.doc_id]
        assert w.fp_pos in w.lines and len(own[w.fp_pos].split()) == max(len(own[n].split()) for n in w.lines)
        assert sum(len(own[n].split()) for n in w.lines) >= 25 and list(w.lines) == list(range(w.lines[0], w.lines[-1] + 1))
        assert len(w.lines) == 1 or min(sum(len(own[n].split()) for n in part) for part in (w.lines[1:], w.lines[:-1])) < 25
    chosen = {(w.doc_id, w.fp_pos) for w in found}
    assert len(chosen) < 0.75 * len(found)
    shared = {x.sfp for x in shared_fingerprints(windows(frame(spark, data))).collect()}
    assert {(w.doc_id, texts[w.doc_id][w.fp_pos]) for w in found if w.fp in shared} <= {(i, x) for i in (3, 8, None) for x in passage}
    runs = Counter(tuple(texts[w.doc_id][n] for n in w.lines) for w in found)
    assert all(w.fp in shared for w in found if len({v.doc_id for v in found if v.w1 == w.w1}) > 1) and max(runs.values()) >= 3


def test_line_dedup_long_texts_and_odd_columns(spark):
    from shoplens.llm.line_dedup import dedup_lines

    r = random.Random(3)
    long = "\n".join(" ".join(f"w{r.randrange(10**6)}" for _ in range(8)) for _ in range(20_000))
    docs = spark.createDataFrame([(1, long, 1, 2, 3), (2, "head line\n" + long, 1, 2, 3), (3, "word " * 300_000, 1, 2, 3)], "doc_id long, text string, `a.b` int, __n_removed int, removed int")
    got = {x[0]: x for x in dedup_lines(docs.drop("__n_removed")).collect()}
    assert got[1].text == long and got[2].text == "head line" and got[2]["__n_removed"] == 20_000 and got[3]["__n_removed"] == 0


# ---- queries and pipeline -----------------------------------------------------------------------------------------

def test_oracles(spark):
    from shoplens.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        got = QUERIES[name](spark, SMALL).toPandas()
        expected = con.execute(sql).df()
        columns = sorted(got.columns)
        assert columns == sorted(expected.columns), name
        assert sorted(map(str, got[columns].values.tolist())) == sorted(map(str, expected[columns].values.tolist())), name


def test_queries_cover_their_tables(spark):
    from shoplens.llm.queries import QUERIES

    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op1_license_scan", "op4_fingerprint", "op5_ngram_join", "op6_sharding", "op7_piece_encoding", "op9_pfair_mixing", "op10_line_dedup"):
        df = QUERIES[name](spark, SMALL)
        assert df.count() == n, name
        assert dict(df.dtypes)["doc_id"] == "bigint", name


def test_native_plans(spark):
    from shoplens.llm.queries import QUERIES

    for name in ("op6_sharding", "op10_line_dedup"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan), name


def test_pipeline(spark):
    import corpus_pipeline as C

    from shoplens.llm import ngram_join

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    now = docs
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, now, SMALL).cache()
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= now.count()
        if stage is C.copy_filter:
            kept = {r.doc_id for r in out.collect()}
            groups = ngram_join.join_documents(now).collect()
            assert kept == {r.component_id for r in groups}
        now = out
    expected = sorted(map(str, C.STAGES[-1][1](spark, now, SMALL).collect()))
    assert sorted(map(str, C.run(spark, SMALL).collect())) == expected


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_take_odd_tables(spark, rows, stage):
    import corpus_pipeline as C

    plain = "doc_id long, text string, lang string, source string, n_chars long, __row string, gone_id long, __n_removed int, `a.b` int"
    made = [(i, t, "en", s, None if t is None else len(t), "x", 1, 5, 6) for i, t, s in rows]
    docs = spark.createDataFrame(made, plain).repartition(3)
    out = C.STAGES[stage][1](spark, docs, SMALL)
    assert 0 < out.count() <= len(rows) and (stage == 4 or out.columns == docs.columns)
    assert C.STAGES[stage][1](spark, spark.createDataFrame([], plain), SMALL).count() == 0


def test_pipeline_gives_the_mixed_order(spark, monkeypatch):
    """Positions of the result follow the target weights, also when the mixing stage wrote several files of many sizes."""
    import corpus_pipeline as C

    from shoplens.llm import mixing

    data = [(i, f"text {i} " + "word " * (i * 37 % 400), "hot" if i % 3 else f"s{i % 4}") for i in range(900)]
    docs = frame(spark, data)
    target = mixing.target_weights(Counter(s for _, _, s in data))
    share = {s: w / sum(target.values()) for s, w in target.items()}
    place = {r.doc_id: r.position for r in mixing.mix(docs).collect()}
    order = sorted(place, key=place.get)
    monkeypatch.setattr(C, "read", lambda *_: docs)
    monkeypatch.setattr(C, "STAGES", C.STAGES[-2:])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(C.run(spark, SMALL).collect(), key=lambda r: r.position)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.position for r in got] == list(range(len(data))) and [r.doc_id for r in got] == order
    source, done = {i: s for i, _, s in data}, Counter()
    for t, r in enumerate(got[:300], 1):
        done[source[r.doc_id]] += 1
        assert all(abs(done[s] - share[s] * t) < 2 * mixing.BLOCK_ROWS for s in share)
