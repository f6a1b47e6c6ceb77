"""Ranked search, embedding near-dedup and structure repair against brute force on small fixtures, with nulls, empty and
long texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def listed(df):
    return [tuple(r) for r in df.collect()]


# ---- 11: ranked search --------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def ranked(docs, items, k):
    """By the definition: every document against every item."""
    docs = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    words = defaultdict(set)
    for item, text in items:
        words[item] |= set(TERM.findall(lower(text)))
    out = []
    for item, wanted in words.items():
        scores = []
        for i, c in docs:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, i is None, i))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, n):
    r = random.Random(seed)
    common = ["the", "of", "and", "É", "日本"]
    rare = [f"w{i}" for i in range(300)]
    texts = [" ".join(r.choice(common) if r.random() < 0.4 else rare[min(int(r.expovariate(0.02)), 299)] for _ in range(r.randrange(1, 60))) for _ in range(n)]
    return r, texts


DOCS = "doc_id long, text string, item_id long, score long, rank int, cols string, code int"


def doc_frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x", 4) for i, t in docs], DOCS).repartition(4)


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, 9, "y") for i, t in items], "item_id long, text string, doc_id long, no_id string")


def test_ranked_against_brute_force(spark, monkeypatch):
    from shoplens.llm import ranked as R

    r, texts = corpus(1, 400)
    docs = list(enumerate(texts)) + [(1000, None), (1001, ""), (1002, " .,-"), (None, texts[3]), (None, None), (5, texts[7]), (5, texts[7]),
                                     (1003, "The the THE w1 " * 40_000), (1004, "w1\x00w2\x7fW3éÉ_x"), *((2000 + i, texts[11]) for i in range(150))]
    items = [(i, " ".join(r.sample(texts[i * 5].split(), min(12, len(texts[i * 5].split()))))) for i in range(30)]
    items += [(90, None), (91, ""), (92, "nowhere at all"), (93, texts[11]), (94, "the of and the"), (None, "w1 w2 w3"), (95, "w4 w5"), (95, "w6"), (96, " ".join(texts[:60]))]
    want = ranked(docs, items, 50)
    assert sorted(listed(R.rank_documents(doc_frame(spark, docs), item_frame(spark, items), 50)), key=str) == want
    # small chunks, blocks and summaries, and several blocks of items, give the same rows
    for name, value in dict(CHUNK_DOCS=37, BLOCK=4, SUMMARY=3, ITEM_BYTES=700).items():
        monkeypatch.setattr(R, name, value)
    assert sorted(listed(R.rank_documents(doc_frame(spark, docs), item_frame(spark, items), 50)), key=str) == want


def test_ranked_empty_tables(spark):
    from shoplens.llm import ranked as R

    docs, items = doc_frame(spark, [(1, "a b")]), item_frame(spark, [(1, "a b")])
    assert listed(R.rank_documents(docs.limit(0), items)) == []
    assert listed(R.rank_documents(docs, items.limit(0))) == []
    assert listed(R.rank_documents(docs.withColumn("text", F.lit(None).cast("string")), items)) == []


def test_ranked_bounds_hold_and_skip():
    """Every bound is at least the best score that its block answers for; far-off blocks are skipped."""
    from shoplens.llm import ranked as R

    r = np.random.default_rng(3)
    n, n_terms = 3000, 120
    topic = r.integers(0, 6, n)
    hold = r.random((n, n_terms)) < np.where((np.arange(n_terms)[None, :] % 6) == topic[:, None], 0.35, 0.02)
    x = np.where(hold, r.integers(1, 900_000, (n, n_terms)), 0)
    weights = {b"%03d" % t: int(w) for t, w in enumerate(np.sort(r.integers(100, 9000, n_terms))[::-1])}
    items = R.Items({i: {b"%03d" % t for t in r.choice(n_terms, 8, replace=False)} for i in range(20)}, weights)
    order = np.lexsort((r.random(n), topic))
    x = x[order]
    ptr = np.concatenate([[0], np.cumsum((x > 0).sum(1))])
    cols = np.nonzero(x)[1]
    sketch = np.eye(6, dtype=np.float32)[topic[order]]
    row = R.build_chunk(np.arange(n), np.zeros(n, bool), ptr, cols, x[x > 0], sketch, items.after)
    chunk = R.Chunk(type("Row", (), dict(zip([c.split()[0] for c in R.INDEX.split(", ")], row))), items.after)
    opened = []
    for j, own in enumerate(items.of):
        scores = x[:, own] @ items.w[own]
        blocks, bounds = chunk.bounds(own, items.places[j])
        first = np.where((x[:, own] > 0).any(1), (x[:, own] > 0).argmax(1), -1)  # a document's first term of the item
        at = 0
        for i, t in enumerate(own):
            if t not in chunk.lists:
                continue
            li = chunk.lists[t]
            for b in range(chunk.list_blocks[li], chunk.list_blocks[li + 1]):
                docs = chunk.block_docs[chunk.block_ptr[b]:chunk.block_ptr[b + 1]]
                answered = docs[first[docs] == i]
                assert b == blocks[at] and (not len(answered) or scores[answered].max() <= bounds[at])
                at += 1
    least = {j: int(np.sort(x[:, own] @ items.w[own])[-10]) for j, own in enumerate(items.of)}
    found = defaultdict(list)
    for j, d, s in R.search_chunk(chunk, items, 10, least, opened):
        found[j].append(s)
    for j, own in enumerate(items.of):
        assert sorted(found[j]) == np.sort(x[:, own] @ items.w[own])[-10:].tolist()
    done, all_ = np.array(opened).sum(0)
    assert done < 0.6 * all_


# ---- 12: embedding near-dedup -------------------------------------------------------------------------------------

def linked(rows, cosine=0.98):
    """By the definition; rows of (vec_id, embedding, label)."""
    def fit(x, label):
        return label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x) and any(x)

    width = max((len(x) for _, x, label in rows if fit(x, label)), default=0)
    units = []
    for _, x, label in rows:
        if fit(x, label):
            v = np.zeros(width)
            v[:len(x)] = x
            v /= np.abs(v).max()
            units.append(v / np.sqrt(v @ v))
        else:
            units.append(None)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and units[i] @ units[j] >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            least[find(i)] = min(v, least.get(find(i), v))
    return sorted(((v, links[i], least.get(find(i)), v == least.get(find(i))) for i, (v, _, _) in enumerate(rows)), key=str)


VECS = "vec_id long, embedding array<double>, label int, n_links long, component long, node string, part int"


def vec_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], VECS).repartition(5)


def vectors(seed, width=12):
    r = np.random.default_rng(seed)
    rows = [(i, r.normal(size=width).tolist(), int(i % 3)) for i in range(120)]
    centre = r.normal(size=width)
    rows += [(200 + i, (centre + r.normal(size=width) * s).tolist(), 1) for i, s in enumerate([0.02] * 60 + [0.12] * 60 + [0.3] * 40)]
    rows += [(400 + i, centre.tolist(), 2) for i in range(70)]  # copies
    rows += [(500 + i, (np.cos(i / 40) * np.eye(width)[0] + np.sin(i / 40) * np.eye(width)[1]).tolist(), 0) for i in range(60)]  # a chain
    return rows


ODD = [(900, None, 1), (901, [], 1), (902, [0.0] * 12, 1), (903, [1.0, None], 1), (904, [float("nan")] * 12, 1), (905, [float("inf"), 1.0], 1),
       (906, [1.0] * 12, None), (907, [1e300] * 12, 0), (908, [1e-300] * 12, 0), (909, [1.0] * 12, 0), (909, [1.0] * 12, 0), (909, [-1.0] * 12, 0),
       (None, [2.0] * 12, 0), (None, [5.0, -5.0] * 6, 2), (None, None, None), (910, [3.0], 2), (911, [4.0, 0.0], 2)]


@pytest.mark.parametrize("block, leaf, fan", [(1024, 64, 8), (8, 3, 2)])
def test_grid_order_against_brute_force(spark, monkeypatch, block, leaf, fan):
    from shoplens.llm import grid_order as G

    for name, value in dict(BLOCK=block, LEAF=leaf, FAN=fan).items():
        monkeypatch.setattr(G, name, value)
    rows = vectors(4) + ODD
    random.Random(5).shuffle(rows)
    assert sorted(listed(G.link_vectors(vec_frame(spark, rows))), key=str) == linked(rows)


def test_grid_order_small_tables(spark):
    from shoplens.llm import grid_order as G

    assert listed(G.link_vectors(vec_frame(spark, [(1, [1.0], 1)]).limit(0))) == []
    assert sorted(listed(G.link_vectors(vec_frame(spark, [(1, None, 1), (2, [0.0], 1)])))) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert sorted(listed(G.link_vectors(vec_frame(spark, [(1, [2.0], 1), (2, [1.0], 1), (3, [-1.0], 1)])))) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_grid_order_resolves_copies_without_pairs(spark, monkeypatch):
    """Intervals of copies are near each other: no pair of their blocks is opened; distant intervals are skipped."""
    from shoplens.llm import grid_order as G

    monkeypatch.setattr(G, "BLOCK", 4)
    monkeypatch.setattr(G, "FAN", 2)
    opened = []
    kept = G.interval_pairs
    monkeypatch.setattr(G, "interval_pairs", lambda *a: opened.append(kept(*a)) or opened[-1])
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(100)] + [(200 + i, [-3.0, 2.0, -1.0], 1) for i in range(100)]
    got = listed(G.link_vectors(vec_frame(spark, rows)))
    assert {(n, c) for _, n, c, _ in got} == {(99, 0), (99, 200)}
    near, open_pairs = opened[0]
    mixed = open_pairs.count()  # only blocks that hold both kinds stay open
    assert mixed <= 8 and sum(n.count() for n in near) < 200


# ---- 13: structure repair -----------------------------------------------------------------------------------------

BLANKS = " \t\n\v\f\r"


def broken(rows):
    """Damage by the definition: conv_id -> rows (turn, role, text)."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv] += []
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def mended(rows):
    """Report and repaired rows by trying all edits; rows of one conversation, damaged."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        solid = text.strip(BLANKS)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    grammar = re.compile(r"(s?(ua)+)?\Z")
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    # least (cost, audit) over all edit strings with at most two inserts in a row, from the end, comparing whole audits
    best = {}
    for i in range(len(rows), -1, -1):
        plain = {}
        for state in ("", "s", "u", "a"):
            options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
            if i < len(rows):
                _, role, text = rows[i]
                cost, audit, made = best[i + 1, state]
                options.append((cost + 4, "D" + audit, made))
                if faults[i] in (None, "truncated"):
                    more = 3 if faults[i] else 0
                    if role[:1] in step[state]:
                        cost, audit, made = best[i + 1, step[state][role[:1]]]
                        options.append((cost + more, "K" + audit, ((role, text), *made)))
                    for name in ("user", "assistant"):
                        if name[0] in step[state]:
                            cost, audit, made = best[i + 1, step[state][name[0]]]
                            options.append((cost + more + 3, "R" + audit, ((name, text), *made)))
            plain[state] = options
        for state in plain:
            options, reached = list(plain[state]), [(state, 0, "", ())]
            for _ in range(3):
                reached = [(step[s][n[0]], c + 3, a + "I", (*m, (n, ""))) for s, c, a, m in reached for n in ("user", "assistant") if n[0] in step[s]]
                options += [(c + cost, a + audit, (*m, *made)) for s, c, a, m in reached for cost, audit, made in plain[s]]
            best[i, state] = min(options)
    cost, audit, made = best[0, ""]
    assert grammar.match("".join(r[:1] for r, _ in made))
    counts = Counter(faults)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())


TALK = "conv_id long, turn long, role string, text string, dropped string, kind string, h int, position long"


def talk_frame(spark, rows):
    return spark.createDataFrame([(*r, "d", "k", 1, 2) for r in rows], TALK).repartition(4)


def talks(seed, n):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randrange(0, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", "unknown"]) if r.random() < 0.4 else ["user", "assistant"][turn % 2]
            text = r.choice(["Yes.", "No!", "Why? ", "so it goes", "", " \t", "…", "ok.\n", "日本。"]) if r.random() < 0.5 else f"text {r.random()}."
            rows.append((conv, turn if r.random() < 0.95 else None, role, text))
    return rows


def test_repair_against_brute_force(spark):
    from shoplens.llm import repair as R

    rows = talks(1, 400)
    rows += [(None, 0, "user", "hi."), (None, None, None, None), (1000, 1, None, "a."), (1000, 1, "user", None), (1000, 1, "user", "x."), (1000, 1, "user", "x."),
             (1001, 5, "user", "long text. " * 100_000), (1001, 9, "assistant", "word " * 200_000), *((1002, 7, "user", "same.") for _ in range(30)),
             *((1003, i, ["user", "assistant"][i % 2], f"turn {i}.") for i in range(600))]
    rows += [(2000 + i, t, r, x) for i in range(200) for t, r, x in [(0, "user", "copied."), (1, "assistant", "copied")]]
    random.Random(2).shuffle(rows)
    want = sorted(((c, *mended(x)) for c, x in broken(rows).items()), key=str)
    got = sorted(listed(R.repair_report(talk_frame(spark, rows))), key=str)
    assert got == want
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert any(row[1:] == nothing for row in got)  # conversations of which all rows were dropped


def test_repair_empty_table(spark):
    from shoplens.llm import repair as R

    assert listed(R.repair_report(talk_frame(spark, [(1, 1, "user", "x")]).limit(0))) == []


def test_repaired_rows_follow_the_grammar(spark):
    from shoplens.llm import repair as R

    rows = R.damage(talk_frame(spark, talks(3, 200)))
    audited, fixed = R.repair(rows)
    by_conv = defaultdict(list)
    for r in fixed.collect():
        by_conv[r.conv, r.no_conv].append((r.position, r.role, r.edit))
    edits = {(r.conv, r.no_conv): r.audit for r in audited.collect()}
    assert set(by_conv) <= set(edits)
    for key, audit in edits.items():
        made = sorted(by_conv.get(key, []))
        assert [p for p, _, _ in made] == list(range(len(made)))
        assert "".join(e for _, _, e in made) == audit.replace("D", "")
        assert re.fullmatch(r"(s?(ua)+)?", "".join(role[:1] for _, role, _ in made))


def test_automaton_shares_suffixes():
    """A node for each distinct suffix, whatever the number of signatures; brute force over all short signatures."""
    from itertools import product

    from shoplens.llm.repair import Automaton

    alphabet = "suaxSUAXD"
    signatures = ["".join(s) for n in range(5) for s in product(alphabet, repeat=n)]
    automaton = Automaton()
    best = {}
    for back in sorted(s[::-1] for s in signatures):
        best[back[::-1]] = automaton.repair(back)
        assert automaton.repair(back) == best[back[::-1]]
    assert automaton.made == len(signatures)  # all suffixes of these are signatures themselves

    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def search(signature, state, inserts):
        options = [(0, "")] if not signature and state in ("", "a") else []
        if inserts < 2:
            for to in ("u", "a"):
                if to in step[state]:
                    options += [(c + 3, "I" + a) for c, a in search(signature, step[state][to], inserts + 1)]
        if signature:
            x, rest = signature[0], signature[1:]
            options += [(c + 4, "D" + a) for c, a in search(rest, state, 0)]
            if x != "D":
                more = 3 if x.isupper() else 0
                if x.lower() in step[state]:
                    options += [(c + more, "K" + a) for c, a in search(rest, step[state][x.lower()], 0)]
                for to in ("u", "a"):
                    if to in step[state]:
                        options += [(c + more + 3, "R" + a) for c, a in search(rest, step[state][to], 0)]
        return options

    r = random.Random(1)
    for signature in r.sample(signatures, 300):
        assert best[signature] == min(search(signature, "", 0)), signature


# ---- the queries --------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_embedding_dedup"])
def test_queries_match_sql(spark, name):
    from shoplens.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SMALL)
    assert got.columns == columns
    assert sorted(listed(got)) == sorted(want.fetchall())


def test_repair_query_covers_the_table(spark):
    from shoplens.llm.queries import QUERIES

    rows = spark.read.parquet(f"{SMALL}/conversations.parquet")
    got = sorted(listed(QUERIES["op13_structure_repair"](spark, SMALL)))
    assert got == sorted((c, *mended(x)) for c, x in broken([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]).items())
