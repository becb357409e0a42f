"""op3, op7, op8, op10, the component routine and the pipeline."""
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ventana.llm import graph, grid_join, ngram_join, sharding, topk
from ventana.llm.shingles import Shingler


def reach(n, pairs):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in pairs:
        a, b = top(i), top(j)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.root for r in graph.components(spark, spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = reach(500, pairs)
    assert all(got.get(i, i) == want[i] for i in range(500))
    assert graph.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(words, n_groups=12, size=6):
    rows, rng, i = [], random.Random(1), 0
    for g in range(n_groups):
        base = words(1000 + g, rng.randint(3, 90))
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words(i, 3))
            rows.append((i, " ".join(text)))
            i += 1
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_ngram_join_equals_brute_force(spark, words, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", block)
    rows = near_copies(words, size=12)
    rows += [(5, rows[5][1]), (900, rows[5][1].upper()), (901, None), (902, ""), (903, "!!"), (904, "one two"), (905, "one two"), (None, rows[20][1])]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, class_id long, TEXT string")
    shingle = Shingler()
    sets = [set(shingle(t or "").tolist()) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = reach(len(rows), pairs)
    links = [sum(i in p for p in pairs) for i in range(len(rows))]
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(root[i], []).append(d)
    want = sorted((str(rows[i][0]), str(min((d for d in least[root[i]] if d is not None), default=None)), links[i]) for i in range(len(rows)))
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in ngram_join.join(spark, df).collect())
    assert got == want and sum(links) > 200
    assert ngram_join.join(spark, df.limit(0)).count() == 0


def test_pruning_bound_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    least = ngram_join.needed(0.8)
    equal = rng.random((20000, ngram_join.VALUES)) < 0.8 + 0.2 / 256
    seen = equal.cumsum(axis=1)[:, ngram_join.LOOK - 1::ngram_join.LOOK]
    assert (seen >= np.array(least)).all(axis=1).mean() > 0.9995
    far = (rng.random((20000, ngram_join.VALUES)) < 0.5).cumsum(axis=1)[:, ngram_join.LOOK - 1::ngram_join.LOOK]
    assert (far >= np.array(least)).all(axis=1).mean() < 0.001


def vectors(spark, rows, kind="float"):
    rows = [(i, v and [None if x is None else float(x) for x in v], a, b) for i, v, a, b in rows]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, score long")


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).round(3).tolist(), 1, 2) for i in range(1, 160)]
    rows += [(200 + i, (np.array(rows[3][1]) * (i + 1)).tolist(), 1, 2) for i in range(4)]
    rows += [(300, rows[7][1], 0, 0), (300, rows[7][1], 0, 0), (0, rows[7][1], 0, 0), (50, rows[9][1], 0, 0)]
    rows += [(400, None, 0, 0), (401, [0.0] * 6, 0, 0), (402, [1.0, None, 0, 0, 0, 0], 0, 0), (403, [float("nan")] + [1.0] * 5, 0, 0),
             (404, [float("inf")] + [1.0] * 5, 0, 0), (405, [], 0, 0), (None, rows[11][1], 0, 0)]
    return rows


@pytest.mark.parametrize("blocks", [(4096, 256), (16, 1)])
def test_topk_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "ROWS", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rows = odd_vectors()
    got = sorted(tuple(r) for r in topk.search(spark, vectors(spark, rows, "double"), every=50, k=5).select("query_id", "rank", "vec_id", "score").collect())
    valid = [(i, np.floor(256 * np.array([*v, *[0.0] * (6 - len(v))])).astype(int)) for i, v, *_ in rows
             if v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for n, (q, v) in enumerate(valid):
        if q is not None and q % 50 == 0:
            best = sorted(((-int(v @ w), -1 if i is None else i, i) for m, (i, w) in enumerate(valid) if m != n), key=lambda x: x[:2])[:5]
            want += [(q, k + 1, i, -s) for k, (s, _, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk.search(spark, vectors(spark, rows).limit(0)).count() == 0
    few = topk.search(spark, vectors(spark, [(0, [1.0, 2.0], 0, 0), (1, [3.0, 1.0], 0, 0)]))
    assert [tuple(r) for r in few.collect()] == [(0, 1, 1, 256 * 256 * 5)]


@pytest.mark.parametrize("interval", [4096, 16])
def test_grid_join_equals_brute_force(spark, monkeypatch, interval):
    monkeypatch.setattr(grid_join, "INTERVAL", interval)
    rng = np.random.default_rng(6)
    rows = odd_vectors()
    for i in range(12):
        centre = rng.normal(size=6)
        rows += [(1000 + 10 * i + j, (centre + rng.normal(scale=0.12, size=6)).tolist(), 0, 0) for j in range(9)]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in grid_join.join(spark, vectors(spark, rows, "double"), 0.95).collect())
    unit = [None if v is None or not v or None in v or not np.isfinite(v).all() or not any(v) else np.array(v) / np.linalg.norm(v) for _, v, *_ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None and unit[i] @ unit[j] >= 0.95]
    root, links = reach(len(rows), pairs), [0] * len(rows)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    least = {}
    for i, r in enumerate(rows):
        least.setdefault(root[i], []).append(r[0])
    want = []
    for i, r in enumerate(rows):
        c = min((x for x in least[root[i]] if x is not None), default=None)
        want.append((str(r[0]), links[i], str(c), r[0] is not None and r[0] == c))
    assert got == sorted(want) and len(pairs) > 100
    assert grid_join.join(spark, vectors(spark, rows).limit(0)).count() == 0


def test_sharding(spark, words, messy, no_docs):
    rows = [(i, " ".join(words(i, 5 + i % 60))) for i in range(3000)] + [(5000 + i, "the same text again " * 5) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard(spark, df, shards=16)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = out.collect()
    text = dict(rows)
    assert len(got) == len(rows)
    assert all(r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    sizes = [sum(r.size for r in v) for v in by.values()]
    assert len(by) == 16 and max(sizes) - min(sizes) < 0.03 * np.mean(sizes) + 2 * max(r.size for r in got)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    # one shard more: far fewer rows move than by a modulus (16/17)
    more = {r.doc_id: r.shard for r in sharding.shard(spark, df, shards=17).collect()}
    assert sum(more[r.doc_id] != r.shard for r in got) / len(got) < 0.6
    assert sharding.shard(spark, messy, shards=4).count() == messy.count()
    assert sharding.shard(spark, no_docs, shards=4).count() == 0


def ring_byte_by_byte(rows, shards, vnodes, slack):
    """(doc_id, text) -> shard, by walking a ring of single bytes. ``rows`` without hot texts."""
    import xxhash
    signed = lambda h: h - (1 << 64) if h >> 63 else h

    def chain(*parts):
        h = 42
        for b in parts:
            h = xxhash.xxh64(b, seed=h).intdigest()
        return signed(h)

    nodes = sorted((chain(b"vnode", s.to_bytes(4, "little"), n.to_bytes(8, "little")), s) for s in range(shards) for n in range(vnodes))
    arcs = [[] for _ in nodes]
    for i, t in rows:
        place = chain((t or "").encode())
        arcs[next((k for k, (p, _) in enumerate(nodes) if place <= p), 0)].append((place, i, t))
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    room = [int(total / shards * (1 + slack)) + 1] * shards
    owner, left = {}, []
    for k, arc in enumerate(arcs):
        for place, i, t in sorted(arc):
            for byte in range(len((t or "").encode()) + 1):
                s = nodes[k][1]
                if room[s]:
                    room[s] -= 1
                    owner.setdefault((i, t), s)  # a row is where its first byte is
                else:
                    left.append((k, i, t))
    for k, i, t in left:
        while not room[nodes[k][1]]:
            k = (k + 1) % len(nodes)
        room[nodes[k][1]] -= 1
        owner.setdefault((i, t), nodes[k][1])
    return owner


def test_sharding_equals_a_ring_of_bytes(spark, words):
    rng = random.Random(11)
    texts = [" ".join(words(i, rng.randint(1, 12))) for i in range(500)] + ["", None, "é漢"]
    rows = [(i, rng.choice(texts) if i % 3 else texts[i % len(texts)]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shards, slack in ((5, 0.001), (3, 0.2)):
        # which of a cut text's copies lie on which side is free
        text = dict(rows)
        got = Counter((text[r.doc_id], r.shard) for r in sharding.shard(spark, df, shards=shards, vnodes=3, slack=slack).collect())
        assert got == Counter((t, s) for (_, t), s in ring_byte_by_byte(rows, shards, 3, slack).items())


def test_copies_stand_together_and_hot_texts_are_split(spark, words):
    many = [(i, " ".join(words(i % 600, 40))) for i in range(6000)]  # ten copies of each text
    hot = [(10_000 + i, "the same text " * 30) for i in range(2000)] + [(None, "another one " * 30)] * 1500 + [(7, "repeated " * 40)] * 1500
    out = sharding.shard(spark, spark.createDataFrame(many + hot, "doc_id long, text string").repartition(8), shards=8).collect()
    assert len(out) == 11_000
    where = {}
    for r in out:
        where.setdefault(r.text_crc32, set()).add(r.shard)
    # a border cuts one text at most: as many as byte ranges at the most, far fewer than texts
    assert sum(len(s) > 1 for s in where.values()) <= 8 + 64
    loads, slots = {}, {}
    for r in out:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert max(loads.values()) / (sum(loads.values()) / 8) < 1.02 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    same = [r for r in out if r.text_crc32 == next(x.text_crc32 for x in out if x.doc_id == 10_000)]
    assert len(same) == 2000 and len({r.slot for r in same if r.shard == same[0].shard}) == sum(r.shard == same[0].shard for r in same)


def test_plan_fills_shards_in_ring_order():
    nodes = [(0, 0), (1, 1), (2, 0), (3, 2)]
    out = sharding.plan({0: 5, 1: 30, 2: 7, 3: 1}, nodes, 3, 15)
    load = {}
    for r in out:
        load[r["shard"]] = load.get(r["shard"], 0) + r["to"] - r["from"]
    assert load == {0: 15, 1: 15, 2: 13}
    assert [r for r in out if r["arc"] == 1] == [{"arc": 1, "from": 0, "to": 15, "shard": 1}, {"arc": 1, "from": 15, "to": 18, "shard": 0},
                                                 {"arc": 1, "from": 18, "to": 30, "shard": 2}]


def test_pipeline_stages(spark, words, tmp_path):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(240):
        text, toxic = words(5000 + i, 40), int(i % 5 == 0)
        for _ in range(4 if toxic else 0):
            text.insert(rng.randrange(40), "grobianest")
        rows.append((i, " ".join(text), "en", f"src{i % 3}", None))
        labels.append((i, 1, toxic))
    rows += [(300, rows[1][1], "en", "copy", 5), (301, rows[2][1] + " mo", "en", "near", 5), (301, rows[2][1] + " mo", "en", "near", 5),
             (302, rows[3][1] + " write to lu.ta@mail1.example.com or 10.2.3.4", "fr", "pii", 7), (303, None, None, None, None), (304, "", "en", "e", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    after = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        after.append(docs)
        if len(after) < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
    toxic = {i for i, _, y in labels if y}
    kept = sorted(str(r.doc_id) for r in after[0].collect())
    assert kept == sorted(str(r[0]) for r in rows if r[0] not in toxic)
    kept = sorted(r.doc_id for r in after[1].collect())
    assert kept == sorted({r[0] for r in rows if r[0] not in toxic and r[0] not in (300, 301)})
    masked = {r.doc_id: r for r in after[2].collect()}
    assert "<EMAIL>" in masked[302].text and "<IP>" in masked[302].text and masked[302].n_chars == len(masked[302].text)
    assert masked[1].text == rows[1][1] and masked[303].text is None and masked[304].text == ""
    ends = after[3].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("d")).collect()
    assert sorted(r.doc_id for r in ends) == kept and all(r.n == r.d for r in ends)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == after[3].count()


def test_pipeline_of_odd_tables(spark, words, tmp_path):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, Doc_Id string, score double, `class` long"
    long = " ".join(words(1, 60_000)) + " a.b@mail1.example.com"
    odd = [(1, None, None, None, None), (2, "", "", "", 0), (None, "no id here", "en", "x", 9), (None, "no id here", "en", "x", 9),
           (3, long, "en", "x", len(long)), (4, "-----", "en", "x", 5), (5, "-----", "en", "x", 5)]
    rows = [(*r, "other", "x", 0.5, 1) for r in odd]
    for name, some, kept in (("odd", rows, [1, 2, 3, 4, None]), ("none", [], [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(some, kinds).createOrReplaceTempView("odd_docs")
        docs = spark.sql("select * from odd_docs")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder)
        got = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
        assert sorted((r.doc_id for r in got), key=str) == sorted(kept, key=str) and all(r.n == r["all"] for r in got)


def test_one_row_of_each_group_stays(spark, words):
    texts = [" ".join(words(7000 + i, 30)) for i in range(5)]
    rows = [(7, texts[0], "en", "b", 1)] * 400 + [(7, texts[0], "en", "a", 1), (8, texts[0], "en", "a", 1)]  # a repeated representative
    rows += [(11, texts[1], "en", "x", 1), (11, texts[1] + " mo", "en", "x", 1), (12, texts[1], "en", "x", 1)]  # near copies share the least id
    rows += [(None, texts[2], "en", "x", 1)] * 3 + [(None, texts[2] + " mo", "en", "x", 1)]  # two groups of null ids
    rows += [(None, texts[3], "en", "x", 1)] * 2
    rows += [(None, texts[4], "en", "x", 1), (40, texts[4], "en", "x", 1)]
    rows += [(20, None, "en", "x", 1)] * 3 + [(21, None, "en", "x", 1), (22, "", "en", "x", 1), (22, "", "en", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    for _ in range(2):
        got = [tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()]
        assert sorted(str(r[0]) for r in got) == sorted(["7", "11", "None", "None", "40", "20", "21", "22"])
        assert set(got) <= set(rows) and (7, texts[0], "en", "a", 1) in got
        docs = spark.createDataFrame(got, docs.schema)


def test_equal_texts_without_a_word_are_one_class(spark, words):
    rows = [(i, "-----") for i in range(10, 15)] + [(i, "") for i in range(20, 23)] + [(30, "----"), (31, None), (32, None)]
    rows += [(40, " ".join(words(1, 9))), (41, " ".join(words(1, 9)))]
    docs = spark.createDataFrame([(*r, "en", "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(spark, docs).collect()}
    assert got == {**{i: (10, 4) for i in range(10, 15)}, **{i: (20, 2) for i in range(20, 23)}, 30: (30, 0), 31: (31, 0), 32: (32, 0), 40: (40, 1), 41: (40, 1)}
    kept = sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect())
    assert kept == [10, 20, 30, 31, 32, 40]
