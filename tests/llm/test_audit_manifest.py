"""op11 on held-out documents and against naive reading, op12 and op13 against brute force."""
import random
import re
from collections import Counter
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ventana.llm import filter_audit, manifest, quality

# ---------------------------------------------------------------- op11


def test_quality_reads_what_its_features_say():
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(0, 1, (quality.BUCKETS, 4)), rng.normal(0, 1, (4, 3)), rng.normal(0, 1, 3))
    rows = ["the cat\tsat the the the", None, "", " \n", "x" * 3000 + " é 漢字漢字", "one"]
    total, count = model.sums(pa.array(rows))
    for t, got, n in zip(rows, total, count):
        words = re.findall(r"[^\x20\x09-\x0d]+", t or "")
        at = [b for w in words for found, _ in quality.features([w]) for b in found]
        own = [int(next(quality.features([w]))[0][0]) for w in words]
        at += [int(quality.pairs(np.array([0, 1]) if a != b else np.array([0, 0]), np.array([2]), np.array([a, b]))[0][0]) for a, b in zip(own, own[1:])]
        assert n == len(at)
        assert sum(len(f) for f, _ in quality.features(["abc"])) == 1 + 4 + 3 + 2 + 1  # <abc> and its n-grams of 2 to 5
        want = model.vectors[at].sum(axis=0) @ model.layer if at else np.zeros(3)
        assert np.allclose(got, want, rtol=1e-3, atol=1e-2)
    assert np.allclose(model.read(pa.array(rows))[0].sum(axis=1), 1)


def test_quality_pieces_do_not_matter(monkeypatch):
    words = [f"word{i}" + "é" * (i % 7) for i in range(300)]

    def listed():
        found = list(quality.features(words))
        return sorted((int(w), int(b)) for at, of in found for b, w in zip(at, of))
    whole = listed()
    monkeypatch.setattr(quality, "PIECE", 40)
    assert listed() == whole


def test_quality_on_held_out_documents(spark, words, messy, no_docs):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        text = words(i, rng.randint(30, 120))
        bad = i % 4 == 0
        kind = i % 3
        if bad:
            text = [w.upper() + "!!" for w in text] if kind == 0 else [w + rng.choice(["###", "$$$"]) for w in text] if kind == 1 else [text[0]] * len(text)
        rows.append((i, " ".join(text)))
        labels.append((i, 0 if bad else 1))
    labels += [(5, 0), (None, 1), (7, None), (9999, 1), (8, 5)]  # a second label: the smallest counts
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(spark, docs, known.where("doc_id < 250 or doc_id > 1000"), quality.Sample(per_class=100, epochs=8))
    got = {r.doc_id: r.score for r in quality.score(spark, docs, model).collect()}
    right = [(got[i] >= quality.THRESHOLD) == bool(y) for i, y in labels if i is not None and 250 <= i < 400]
    assert sum(right) / len(right) > 0.95 and all(0 <= s <= 1 for s in got.values())
    out = quality.score(spark, messy, model, keep=("score",)).collect()
    assert len(out) == messy.count() and {r.keep_score for r in out} == {0.5, 0.1, 0.0}
    empty = {r.score for r in quality.score(spark, messy.where("doc_id in (0, 1, 2)"), model).collect()}
    assert len(empty) == 1  # the bias alone
    assert quality.score(spark, no_docs, model).count() == 0
    nothing = quality.train(spark, no_docs, known)
    assert {r.score for r in quality.score(spark, messy, nothing).collect()} == {0.5}


# ---------------------------------------------------------------- op12


def test_orders_are_all_met_by_swaps():
    for n in range(1, 6):
        order, met = list(range(n)), set()
        met.add(tuple(order))
        for i in filter_audit.orders(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            assert tuple(order) not in met
            met.add(tuple(order))
        assert met == set(permutations(range(n)))


def brute_walk(rows, names):
    """rows: (mask, good, toxic) one by one."""
    out, shares = [], Counter()
    for order in permutations(range(len(names))):
        left = rows
        for step, k in enumerate(order, 1):
            gone = [r for r in left if r[0] >> k & 1]
            left = [r for r in left if not r[0] >> k & 1]
            fails = sum(r[0] >> k & 1 for r in rows)
            shares[k] += len(gone)
            out.append(["".join(names[i] for i in order), step, len(left), len(gone), fails - len(gone), sum(r[0] == 1 << k for r in rows),
                        sum(r[1] for r in gone), sum(r[2] for r in gone), k])
    return sorted((*r[:-1], shares[r[-1]]) for r in out)


def test_diagram_equals_applying_filters_one_by_one():
    rng = random.Random(6)
    for n, size in [(1, 3), (3, 0), (3, 40), (5, 200), (5, 1), (4, 1000)]:
        rows = [(rng.randrange(1 << n) & rng.randrange(1 << n), rng.random() < 0.3, rng.random() < 0.1) for _ in range(size)]
        counts = {}
        for m, g, t in rows:
            old = counts.get(m, (0, 0, 0))
            counts[m] = (old[0] + 1, old[1] + g, old[2] + t)
        assert sorted(filter_audit.walk(counts, "ABCDE"[:n])) == brute_walk(rows, "ABCDE"[:n])
    # equal functions are one node: independent filters need few nodes
    diagram = filter_audit.Diagram({m: (1,) for m in range(32)}, 5, 1)
    assert [len(x) for x in diagram.nodes] == [1] * 5
    diagram.swap(2)
    assert [len(x) for x in diagram.nodes] == [1] * 5 and diagram.order == [0, 1, 3, 2, 4]


def test_masks_and_audit(spark, messy, no_docs):
    long = "aa bb cc " * 100
    rows = [(1, "en", long), (2, "de", long), (2, "en", long), (3, "en", long), (3, "en", long), (None, "en", long), (None, None, ""),
            (4, None, None), (5, "", ""), (6, "fr", "ABC def"), (7, "fr", "x#y"), (8, "fr", "A" * 4 + "b" * 96), (9, "fr", "É" * 50),
            (10, "en", " ".join(f"w{i}" for i in range(250))), (11, "en", "a\x1cb　c\x85d " * 60)]
    docs = spark.createDataFrame([(i, lang, t, 1, "x") for i, lang, t in rows], "doc_id long, lang string, text string, n int, LANG string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, 1, None), (3, None, None), (None, 1, 1), (10, 1, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    want = {}
    for i, lang, t in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0d]+", t)
        least = min((j for j, _, u in rows if j is not None and (u or "") == t), default=None)
        mask = ((len(ws) < 200) | (100 * len(set(ws)) < 50 * len(ws)) << 1 | (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)) << 2
                | bool(re.search(r"[#$%&*|]", t)) << 3 | (i is not None and least < i) << 4)
        want.setdefault(lang or "", []).append((mask, i in (1, 3, 10), i == 3))
    counted = filter_audit.masks(docs, labels)
    got = {}
    for r in counted.collect():
        got.setdefault(r.part, []).extend([(r["mask"], r.good, r.toxic)] * r.n)
    assert {p: sorted(v) for p, v in got.items()} == {p: sorted(v) for p, v in want.items()}
    table = {}
    for r in filter_audit.audit(counted, "ABCDE").collect():
        table.setdefault(r.part, []).append(tuple(r)[1:])
    assert {p: sorted(v) for p, v in table.items()} == {p: brute_walk(v, "ABCDE") for p, v in want.items()}
    none = filter_audit.masks(docs.limit(0), labels)
    assert none.count() == 0 and filter_audit.audit(none, "ABCDE").count() == 0
    assert filter_audit.masks(docs, labels.limit(0)).agg(F.sum("n")).first()[0] == len(rows)
    with pytest.raises(ValueError):
        filter_audit.audit(counted, "ABCDEFGHI")


# ---------------------------------------------------------------- op13


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """(root, proofs)."""
    level, at, proofs = list(leaves), list(range(len(leaves))), [""] * len(leaves)
    while len(level) > 1:
        for i, a in enumerate(at):
            run = range(a // 3 * 3, min(a // 3 * 3 + 3, len(level)))
            proofs[i] += "".join(level[j] for j in run if j != a)
        level, at = [h(*level[k:k + 3]) for k in range(0, len(level), 3)], [a // 3 for a in at]
    return level[0], proofs


def test_block_sweeps():
    for n in (1, 2, 3, 4, 9, 10, 26, 28):
        items = [h(str(i)) for i in range(n)]
        block = manifest.Block(items, manifest.levels_of(n))
        root, proofs = brute_tree(items)
        assert block.forward() == root and block.backward("end") == [p + "end" for p in proofs]


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


@pytest.mark.parametrize("slab", [1, 2, 7])
def test_manifest_equals_brute_force(spark, slab):
    rng = random.Random(8)
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", "é", "z", None, ""]), rng.choice(["en", None]), i, f"text {i % 40}\nof a row\n" * (i % 3)) for i in range(120)]
    rows += [(i, f"one{i}", "", None, None) for i in range(12)]  # sources of one row
    rows += [rows[5], rows[5], (5, rows[5][1], "xx", 1, "same id"), (None, "b", "en", 0, "a\nb"), (None, None, None, None, None)]
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, TEXT string, leaf double")
    leaf = lambda r: h(*map(field, r))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: brute_tree([leaf(r) for r in groups[s]]) for s in names}
    root, tops = brute_tree([trees[s][0] for s in names])
    want = []
    for s, top in zip(names, tops):
        for r, p in zip(groups[s], trees[s][1]):
            changed = r[4] is not None and r[0] is not None and r[0] % 2 == 0 and "\n" in r[4]
            want.append((r[0], s, leaf(r), leaf((*r[:4], r[4].replace("\n", ""))) if changed else None, trees[s][0], root, p + top))
    got = manifest.manifest(spark, docs, lambda i, t: F.when(i % 2 == 0, F.replace(t, F.lit("\n"), F.lit(""))).otherwise(t), slab=slab)
    places = [(F.col("place"), F.col("n")), (F.col("source_place"), F.col("n_sources"))]
    got = got.withColumn("back", manifest.folded(F.col("leaf"), F.col("proof"), places)).withColumn(
        "other", manifest.folded(F.col("tampered_leaf"), F.col("proof"), places)).collect()
    key = lambda t: tuple((x is not None, x) if x is not None else (False, "") for x in t)
    assert sorted([(r.doc_id, r.source, r.leaf, r.tampered_leaf, r.subroot, r.root, r.proof) for r in got], key=key) == sorted(want, key=key)
    assert all(r.back == r.root for r in got)
    assert all((r.other is None) == (r.tampered_leaf is None) and r.other != r.root for r in got) and any(r.other for r in got)


def test_manifest_of_nothing_and_of_one_row(spark, messy, no_docs):
    fields = ("doc_id", "text", "TEXT")
    assert manifest.manifest(spark, no_docs, fields=fields, group_col="TEXT").count() == 0
    one = manifest.manifest(spark, messy.where("doc_id = 3"), fields=fields, group_col="TEXT").collect()
    assert [(r.leaf, r.subroot, r.root, r.proof, r.tampered_leaf) for r in one] == [(one[0].leaf, one[0].leaf, one[0].leaf, "", None)]
    every = manifest.manifest(spark, messy, fields=fields, group_col="TEXT").collect()
    assert len(every) == messy.count() and len({r.root for r in every}) == 1
