"""FLT6 by relevance and ORD1 by counted ranges, against plain recomputations."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shoplens.operators import dashboard, search_index


def _brute(docs, tokens, n):
    words = {k: t.lower().split() for k, t in docs if t and t.split()}
    mean = sum(map(len, words.values())) / len(words)
    df = {t: sum(t in w for w in words.values()) for t in tokens}
    scores = {}
    for k, w in words.items():
        c = Counter(w)
        parts = [math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in tokens if c[t]]
        if parts:
            scores[k] = round(sum(parts), 6)
    return sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:n]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(rnd.choices(vocabulary, [1 / (j + 1) for j in range(200)], k=rnd.choice((3, 8, 30, 200))))) for i in range(3000)]
    docs += [(3000, None), (3001, ""), (3002, "w150 " * 40), (3003, docs[7][1]), (3004, "W7 W7 w9")]
    path = str(tmp_path_factory.mktemp("index"))
    search_index.write_index(spark.createDataFrame(docs, "id long, text string").repartition(4), "id", "text", path)
    return path, docs


@pytest.mark.parametrize("query", ["w150", "w7 w9", "W0 w1 w2 w199", "w180 w0", "w7 w7 nowhere"])
@pytest.mark.parametrize("n", [1, 10, 4000])
def test_ranked_match_equals_brute_force(spark, index, query, n):
    path, docs = index
    got = [(r.key, r.score) for r in search_index.match_ranked(spark, path, query, n).orderBy("rank").collect()]
    want = _brute(docs, sorted(set(query.lower().split())), n)
    assert [k for k, _ in got] == [k for k, _ in want]
    assert all(abs(a[1] - b[1]) < 2e-6 for a, b in zip(got, want))


def test_blocks_are_skipped_by_their_bounds(spark, index):
    path, _ = index
    all_blocks = search_index.open_blocks(spark, path, "w0 w150", 100000).count()
    assert 0 < search_index.open_blocks(spark, path, "w0 w150", 5).count() < all_blocks / 2


def test_only_folders_of_the_querys_tokens_are_read(spark, index):
    path, _ = index
    plan = search_index.match_ranked(spark, path, "w150", 5)._jdf.queryExecution().executedPlan().toString()
    assert "folder#" in plan.split("PartitionFilters: ")[1][:60]
    assert "EqualTo(token,w150)" in plan or "In(token" in plan


def test_odd_queries_and_texts(spark, scratch):
    docs = spark.createDataFrame([(1, "红海行动 Red"), (2, "红 红 blue"), (3, None)], "id long, text string")
    search_index.write_index(docs, "id", "text", f"{scratch}/i")
    assert [r.key for r in search_index.match_ranked(spark, f"{scratch}/i", "红海", 5).orderBy("rank").collect()] == [1, 2]
    assert search_index.match_ranked(spark, f"{scratch}/i", "", 5).count() == 0
    assert search_index.match_ranked(spark, f"{scratch}/i", "nowhere", 5).count() == 0
    search_index.write_index(docs.limit(0), "id", "text", f"{scratch}/empty")
    assert search_index.match_ranked(spark, f"{scratch}/empty", "red", 5).count() == 0


def test_pages_by_ranges_are_the_pages(spark, scratch):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "2024-01-01", "2024-01-02", "2024-02-01"]), f"{rnd.randrange(50)}-{i}") for i in range(400)]
    rows += [("2024-01-02", f"1234567890123-{i}") for i in range(200)]  # one long prefix
    spark.createDataFrame(rows, "dt string, order_detail_id string").write.parquet(f"{scratch}/hits")
    hits = spark.read.parquet(f"{scratch}/hits")
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for start, size in ((0, 5), (97, 10), (250, 7), (430, 5), (590, 25), (599, 1), (600, 5), (10_000, 5)):
        got = dashboard.page_by_ranges(hits, start, size)
        assert [tuple(r) for r in got.orderBy("dt", "order_detail_id").select("dt", "order_detail_id").collect()] == want[start:start + size]
        assert {r.total for r in got.collect()} <= {600}
    assert dashboard.page_by_ranges(hits.where(F.lit(False)), 0, 5).count() == 0


def test_a_deep_page_sorts_one_range_only(spark, scratch):
    rows = [(f"2024-01-{d:02d}", f"{i:05d}") for d in range(1, 29) for i in range(300)]
    spark.createDataFrame(rows, "dt string, order_detail_id string").write.parquet(f"{scratch}/hits")
    plan = dashboard.page_by_ranges(spark.read.parquet(f"{scratch}/hits"), 5000, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Offset" not in plan or int(plan.split("Offset ")[1].split()[0]) < 100
    assert "dt" in plan.split("Filter")[1]
