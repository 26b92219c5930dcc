"""Classifier, mixing, sharding, licences, top-k, decontamination, URL rules: odd inputs and brute force."""

import math
import random
import zlib

import numpy as np
import pytest
from llm_helpers import docs_df, shard_statement, words
from pyspark.sql import functions as F

from mallsight.llm import decontam, license_texts, licenses, mixing, quality, sharding, topk, url_filter
from mallsight.llm.common import WordHash


# ------------------------------------------------------------------ quality
def labelled(spark, n=240):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        ws = [rng.choice(["alpha", "beta", "gamma", "delta", "noun", "verb"]) + rng.choice(["s", "ed", ""]) for _ in range(30)]
        bad = i % 4 == 0
        rows.append((i, " ".join(w + "$$$" if bad else w for w in ws)))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_quality_separates_held_out_rows(spark):
    rows, labels = labelled(spark)
    rows += [(1000, ""), (1001, None), (None, "alpha beta"), (1002, "alpha " * 5000), (5, "alpha betas")]
    lab = spark.createDataFrame(labels + [(None, 1), (7, None), (8, 0), (8, 0)], "doc_id long, quality int")
    docs = docs_df(spark, rows, extra=True)
    out = quality.score_documents(docs, lab, train_docs=120).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out if r.doc_id != 5}
    for i, y in labels:
        if i != 5:
            assert by_id[i].predicted == y
            assert by_id[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert by_id[1000].score == by_id[1001].score and by_id[None].held_out is False
    kept = quality.keep_good(docs, lab, train_docs=120)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in out)


def test_quality_without_labels_and_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.score_documents(docs_df(spark, [(1, "a b"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert quality.score_documents(docs_df(spark, []), none).count() == 0


def test_scorer_equals_model_beyond_its_cache(monkeypatch):
    """Texts with more distinct words than the cache: same score as the plain sum over features."""
    monkeypatch.setattr(quality, "WORD_CACHE", 64)
    monkeypatch.setattr(quality, "CHUNK_WORDS", 50)
    rng = np.random.default_rng(0)
    model = quality.Model(rng.normal(size=quality.BUCKETS + 1).astype(np.float32), 0.25)
    import pandas as pd
    texts = [b" ".join(b"w%d" % rng.integers(0, n) for _ in range(m)) for n, m in ((10, 5), (40, 60), (30, 50), (500, 300), (10, 4))]
    got = pd.concat(model.scorer().func(iter([pd.Series([*texts, None, b""]), pd.Series(texts)])), ignore_index=True)
    assert got[:5].tolist() == pytest.approx(got[7:].tolist())
    for text, p in zip(texts, got):
        at, share = quality.bag(text)
        assert math.isclose(p, 1 / (1 + math.exp(-(0.25 + float(model.weights[at].astype(float) @ share)))), rel_tol=1e-4)
    assert got[5] == got[6] == pytest.approx(1 / (1 + math.exp(-0.25)))


def test_training_steps_follow_numerical_gradients(monkeypatch):
    """Each step of ``fit`` moves every parameter against the loss's finite differences."""
    monkeypatch.setattr(quality, "BUCKETS", 6)
    monkeypatch.setattr(quality, "DIM", 3)
    monkeypatch.setattr(quality, "EPOCHS", 3)
    bags = [(np.array(b), np.array(s, np.float32)) for b, s in (([0, 2, 5], [.5, .3, .2]), ([1, 2], [.6, .4]), ([4], [1.0]), ([], []))]
    bags = [(b.astype(np.int64), s) for b, s in bags]
    labels = np.array([1, 0, 1, 0])
    rng = np.random.default_rng(7)
    vec = rng.uniform(-1 / 3, 1 / 3, (7, 3)).astype(np.float32).astype(np.float64)
    out, bias = np.zeros((3, 2)), np.zeros(2)

    def loss(i):
        b, s = bags[i]
        z = s.astype(np.float64) @ vec[b] @ out + bias
        return np.log(np.exp(z).sum()) - z[labels[i]]

    def gradient(x, i):
        g = np.zeros_like(x)
        for k in np.ndindex(*x.shape):
            old = x[k]
            x[k] = old + 1e-5
            up = loss(i)
            x[k] = old - 1e-5
            g[k] = (up - loss(i)) / 2e-5
            x[k] = old
        return g
    at = 0
    for _ in range(3):
        for i in rng.permutation(4):
            rate = quality.RATE * (1 - at / 12)
            at += 1
            of_vec, of_out, of_bias = (gradient(x, i) for x in (vec, out, bias))
            spread = np.sqrt((bags[i][1].astype(np.float64) ** 2).sum()) or 1.0
            vec -= rate / spread * of_vec
            out -= rate * of_out
            bias -= 0.1 * rate * of_bias
    model = quality.fit(bags, labels)
    assert np.allclose(model.weights, vec @ (out[:, 1] - out[:, 0]), rtol=1e-3, atol=1e-4)
    assert abs(model.bias - (bias[1] - bias[0])) < 1e-4 and np.abs(model.weights).max() > 0.01


def test_quality_accuracy_on_held_out_rows(spark, sf_mid):
    docs = spark.read.parquet(f"{sf_mid}/documents.parquet")
    labels = spark.read.parquet(f"{sf_mid}/labels.parquet")
    test = quality.score_documents(docs, labels).filter("held_out").join(labels.select("doc_id", "quality"), "doc_id")
    right, n = test.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n >= 0.95


# ------------------------------------------------------------------ mixing
def test_targets_by_repeated_resharing(spark):
    """The closed form equals capping and resharing until nothing exceeds its cap."""
    sizes = {"a": 100, "b": 5, "c": 400, "d": 0, "é": 90, None: 30, "": 12}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df, (3, 1, 2), 150, 2).collect()}
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            break
        capped |= set(over)
    want = {s: 2 * sizes[s] if s in capped else share[s] for s in order}
    assert got == pytest.approx(want)


def test_mix_meets_budgets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice(["big", "big", "big", "mid", "tiny", None])) for i in range(400)]
    rows += [(None, "null id", "mid"), (7, None, "mid"), (3, "a b", "mid"), (3, "a b", "mid")]
    docs = docs_df(spark, rows, extra=True)
    out = mixing.mix(docs).collect()
    again = sorted(map(str, mixing.mix(docs.repartition(3)).collect()))
    assert len(out) == len(rows) and sorted(map(str, out)) == again
    for source in {r.source for r in out}:
        own = [r for r in out if r.source == source]
        assert {r.source_size for r in own} == {sum(len(words(t)) for _, t, s in rows if s == source)}
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        assert all(0 <= r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 40
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)


def test_mix_of_nothing(spark):
    assert mixing.mix(docs_df(spark, [])).count() == 0
    assert [(r.size, r.target, r.taken) for r in mixing.mix(docs_df(spark, [(1, ""), (2, None)])).collect()] == [(0, 0.0, 0)] * 2


# ------------------------------------------------------------------ sharding
@pytest.mark.parametrize("shards,split", [(1, 1), (7, 3), (40, None)])
def test_shards_equal_the_statement(spark, shards, split):
    rng = random.Random(shards)
    rows = [(i, "".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    rows += [(i, "the same text") for i in rng.sample(range(1000, 10**12), 400)]  # a large group of copies
    rows += [(2000, None), (2001, ""), (None, "no id"), (2002, "twice"), (2002, "twice"), (2003, "long " * 3000)]
    got = sharding.shard_by_bytes(docs_df(spark, rows, extra=True), shards, split=split).collect()
    assert sorted(((r.doc_id if r.doc_id is not None else -1), *r[1:]) for r in got) == \
        sorted(((x[0] if x[0] is not None else -1), *x[1:]) for x in shard_statement(rows, shards, 16))
    docs = sharding.sharded_documents(docs_df(spark, rows, extra=True), shards)
    assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and docs.columns[-3:] == ["shard", "slot", "n_bytes"]
    assert len(set(docs.columns)) == len(docs.columns) and docs.count() == len(rows)


def test_small_groups_are_not_parted(spark, monkeypatch):
    rows = [(i, f"{i % 100:03d}" * (20 + i % 100)) for i in range(1000)]  # a hundred groups of ten
    for most in (1024, 8):  # few exact parts: cells do the rest
        monkeypatch.setattr(sharding, "MOST_PARTS", most)
        got = sharding.shard_by_bytes(docs_df(spark, rows), 8).collect()
        assert sorted((r.doc_id, *r[1:]) for r in got) == sorted(shard_statement(rows, 8, 16))
    limit = max(2 * max(r["size"] for r in got), sum(r["size"] for r in got) // 160)
    shards, size = {}, {}
    for r in got:
        shards.setdefault(r.doc_id % 100, set()).add(r.shard)
        size[r.doc_id % 100] = size.get(r.doc_id % 100, 0) + r["size"]
    assert all(len(s) == 1 for g, s in shards.items() if size[g] <= limit)


def test_sharding_within_a_tolerance(spark):
    rows = [(i, "x" * (i % 50)) for i in range(2000)]
    got = sharding.shard_by_bytes(docs_df(spark, rows), 8, tolerance=2000, split=1).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    mean = sum(r.b for r in got) / 8
    assert len(got) == 8 and all(abs(r.b - mean) <= 4100 for r in got)
    assert sharding.shard_by_bytes(docs_df(spark, []), 8).count() == 0


# ------------------------------------------------------------------ licences
def test_license_inheritance(spark):
    notice = dict(reversed(license_texts.LINES))
    mit, gpl, apache = (notice[k] + "." for k in ("MIT", "GPL-3.0", "Apache-2.0"))
    prose = "some words of prose that fill\nthe lines of the file " * 20
    files = [("a/LICENSE", mit), ("a/x.txt", prose), ("a/b/y.txt", prose), ("a/b/c/LICENSE.md", prose + "\n" + gpl),
             ("a/b/c/z.txt", prose), ("a/b/c/own.txt", apache.upper() + "\n" + prose), ("q/r.txt", prose), ("ab/r.txt", ""),
             ("top.txt", None), (None, mit), ("a/x.txt", "second row"), ("a/b/notice.txt.bak", prose)]
    df = spark.createDataFrame(files, "path string, text string").withColumn("license", F.lit(1)).withColumn("dir", F.lit("x"))
    got = {r.path: (r.license, r.origin, r.license_dir) for r in licenses.scan_licenses(df).collect()}
    assert got["a/LICENSE"] == ("MIT", "own", None) and got["a/x.txt"] == ("MIT", "inherited", "a")
    assert got["a/b/y.txt"] == ("MIT", "inherited", "a") and got["a/b/c/z.txt"] == ("GPL-3.0", "inherited", "a/b/c")
    assert got["a/b/c/own.txt"] == ("Apache-2.0", "own", None)
    assert got["q/r.txt"] == got["ab/r.txt"] == got["top.txt"] == (None, None, None)
    assert len(got) == 10
    root = spark.createDataFrame([("COPYING", gpl), ("d/e.txt", "x")], "path string, text string")
    assert {r.path: r.license for r in licenses.scan_licenses(root).collect()} == {"COPYING": "GPL-3.0", "d/e.txt": "GPL-3.0"}
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def license_of(spark, files):
    df = spark.createDataFrame(files, "path string, text string")
    return {r.path: (r.license, r.origin) for r in licenses.scan_licenses(df).collect()}


def test_headers_files_and_identifiers_are_found(spark):
    bodies = {}
    for i, t in license_texts.BLOCKS:
        bodies.setdefault(i, []).append(t)
    wrap = lambda t, n, mark="": "\n".join(mark + " ".join(t.split()[i:i + n]) for i in range(0, len(t.split()), n))
    code = "\n".join(f"value_{i} = compute(value_{i - 1}, {i})" for i in range(400))
    files = [("m/LICENSE", "MIT License\n\nCopyright (c) 2024 Somebody Else\n\n" + wrap(bodies["MIT"][0], 12)), ("m/src/a.py", code),
             ("s/a.py", "# SPDX-License-Identifier: MIT\n" + code), ("s/b.py", code + "\n// SPDX-License-Identifier: GPL-3.0\n"),
             ("g/COPYING", wrap(bodies["GPL-3.0"][1], 9) + "\n" + code), ("g/x/y/z.c", code),
             ("h/a.c", code + "\n" + wrap(bodies["Apache-2.0"][0], 11, " * ") + "\n" + code), ("h/b.c", code),
             ("w/a.c", "/*\n" + wrap(license_texts.LINES[6][1], 7, " * ") + "\n */\n" + code),
             ("b/LICENSE.txt", wrap(bodies["BSD-3-Clause"][0], 13)), ("b2/LICENSE.txt", wrap(bodies["BSD-2-Clause"][0], 13)),
             ("long/a.txt", code * 30 + "\n" + wrap(bodies["GPL-2.0"][0], 10) + "\n" + code * 30)]
    got = license_of(spark, files)
    assert got["m/LICENSE"] == ("MIT", "own") and got["m/src/a.py"] == ("MIT", "inherited")
    assert got["s/a.py"] == ("MIT", "own") and got["s/b.py"] == ("GPL-3.0", "own")
    assert got["g/COPYING"] == ("GPL-3.0", "own") and got["g/x/y/z.c"] == ("GPL-3.0", "inherited")
    assert got["h/a.c"] == ("Apache-2.0", "own") and got["h/b.c"] == (None, None)
    assert got["w/a.c"] == ("MPL-2.0", "own")
    assert got["b/LICENSE.txt"] == ("BSD-3-Clause", "own") and got["b2/LICENSE.txt"] == ("BSD-2-Clause", "own")
    assert got["long/a.txt"] == ("GPL-2.0", "own")


def best_units(files, templates, percent):
    """Every line, window and licence file against every template, without prefilter or index."""
    import re
    terms = lambda t: list(dict.fromkeys(re.findall(r"[0-9]+(?:\.[0-9]+)+|[^\W_]+", t.lower())))
    docs = {p: [t for t in map(terms, (text or "").split("\n")) if t] for p, text in files}
    total, df = sum(map(len, docs.values())), {}
    for ls in docs.values():
        for t in (t for line in ls for t in line):
            df[t] = df.get(t, 0) + 1
    vocabulary = {t for _, text in templates for t in terms(text)}
    idf = lambda t: math.log((1 + total) / (1 + (df.get(t, 0) if t in vocabulary else 0))) + 1
    out = {}
    for p, ls in docs.items():
        spans = [(i, w, ls[i:i + w]) for w in licenses.WINDOWS for i in range(len(ls) - w + 1)]
        if re.match(licenses.LICENSE_FILE, p.rsplit("/", 1)[-1]) and ls:
            spans.append((0, licenses.WHOLE, ls))
        found = []
        for i, w, unit in spans:
            u = {t for line in unit for t in line}
            for license, text in templates:
                v = set(terms(text))
                score = sum(idf(t) ** 2 for t in u & v) / math.sqrt(sum(idf(t) ** 2 for t in u) * sum(idf(t) ** 2 for t in v))
                if round(score, 6) >= percent / 100:
                    found.append((-round(score, 6), i, w, license))
        if found:
            out[p] = (min(found)[3], -min(found)[0])
    return out


def test_license_scores_equal_brute_force(spark):
    rng = random.Random(6)
    templates = [("A", "alpha beta gamma delta"), ("B", "beta gamma delta epsilon zeta eta"), ("C", "one 2.0 three four five six seven eight nine ten"),
                 ("T1", "tie breaker text"), ("T2", "tie breaker text")]
    words = [w for _, t in templates for w in t.split()] + ["noise", "other", "the"]
    files = []
    for i in range(60):
        lines = [" ".join(rng.choices(words, k=rng.randint(0, 6))) for _ in range(rng.randint(0, 12))]
        if i % 3 == 0:
            text = rng.choice(templates)[1].split()
            lines[len(lines) // 2:len(lines) // 2] = [" ".join(text[k:k + 3]) for k in range(0, len(text), 3)]
        files.append((f"d{i % 7}/{'LICENSE' if i % 5 == 0 else 'f'}-{i}", "\n".join(lines) if i % 11 else None))
    got = {r.path: (r.license, r.score) for r in licenses.notices(spark.createDataFrame(files, "path string, text string"), templates, 80).collect()}
    want = best_units(files, templates, 80)
    assert got.keys() == want.keys() and len(want) > 15
    assert all(got[p][0] == want[p][0] and abs(got[p][1] - want[p][1]) < 2e-6 for p in want), (got, want)
    assert any(v[0] == "T1" for v in want.values()) and not any(v[0] == "T2" for v in want.values())


# ------------------------------------------------------------------ top-k
def test_topk_equals_brute_force(spark):
    rng = random.Random(4)
    vecs = [(i, [rng.uniform(-1, 1) for _ in range(16)], 0) for i in range(0, 700, 3)]
    vecs += [(i, [0.5] * 16, 0) for i in range(1000, 1300)]  # one common vector: ties
    vecs += [(2000, None, 0), (2100, [0.1, None] + [0.0] * 14, 0), (2200, [float("nan")] * 16, 0), (2300, [float("inf")] * 16, 0),
             (None, [0.9] * 16, 0), (2400, [], 0), (2500, [0.3] * 5, 0), (2600, [0.2] * 5, 0), (2700, [1e30] * 16, 0), (1000, [0.5] * 16, 0)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>, score int")
    got = {}
    for r in topk.top_k(df, df.filter("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    usable = {}
    for i, v, _ in vecs:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, []).append([math.floor(1024 * x) for x in v])
    flat = [(i, v) for i, vs in usable.items() for v in vs]
    for q, qv in flat:
        if q % 100 == 0 and q != 1000:
            best = sorted((-min(2**63 - 1, max(-2**63, sum(a * b for a, b in zip(qv, v)))), i) for i, v in flat
                          if i != q and len(v) == len(qv))[:10]
            assert sorted(got.get(q, [])) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)], q
    assert topk.top_k(df.limit(0), df).count() == 0 and topk.top_k(df, df.limit(0)).count() == 0


def test_topk_in_many_blocks_and_pruning(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 150)
    rng = np.random.default_rng(5)
    m = rng.normal(size=(600, 16)).cumsum(axis=1)  # smooth vectors: segments tell much
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 60 = 0")
    got = {}
    for r in topk.top_k(df, asked, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    x = np.floor(m * 1024)
    for q in range(0, 600, 60):
        scores = x @ x[q]
        order = [i for i in np.lexsort((np.arange(600), -scores)) if i != q][:5]
        assert sorted(got[q]) == [(n + 1, i, int(scores[i])) for n, i in enumerate(order)]
    left = [r.candidates for r in topk.pruned_shares(df, asked, k=5).orderBy("level").collect()]
    assert left[0] == 10 * 599 and left == sorted(left, reverse=True) and left[-1] < left[0] / 5


def test_segment_bounds_hold():
    rng = np.random.default_rng(1)
    m, q = np.floor(rng.normal(size=(200, 50)) * 1024), np.floor(rng.normal(size=(20, 50)) * 1024)
    last = None
    for s in (1, 2, 8, 50, 80):
        bound = topk.segment_stats(m, s) @ topk.segment_stats(q, s).T
        assert (bound >= m @ q.T - 1e-6 * np.abs(bound)).all()
        assert last is None or bound.mean() <= last * 1.001
        last = bound.mean()


# ------------------------------------------------------------------ decontamination
def test_contamination_in_long_documents(spark):
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 5, 6, 12, 25, 40, 70, 150, 300])]
    items += [(20, ""), (21, None), (None, "no id at all here"), (22, "...")]
    rows = [(i, " ".join(word() for _ in range(rng.choice([10, 300, 6000])))) for i in range(30)]
    for i, t in items[:9]:
        ws = [word() for _ in range(8000)]
        at = rng.randrange(8000)
        rows.append((100 + i, " ".join(ws[:at]) + "\n" + t.upper().replace(" ", ",  ") + "! " + " ".join(ws[at:])))
        part = t.split()
        rows.append((200 + i, " ".join(ws[:at] + part[:int(len(part) * 0.9)] + ws[at:])))
        rows.append((300 + i, " ".join(ws[:at] + part[:int(len(part) * 0.6)] + ws[at:])))
    rows += [(400, None), (401, ""), (None, items[4][1])]
    items_df = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("sh", F.lit(2))
    docs = docs_df(spark, rows, extra=True)
    got = {(r.doc_id, r.item_id): (r.item_shingles, r.shared) for r in decontam.contaminated(docs, items_df).collect()}

    def grams(t, k):
        ws = "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
        return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)}, len(ws)
    want = {}
    for i, t in items:
        k = min(5, grams(t, 1)[1])
        if i is not None and k:
            own = grams(t, k)[0]
            for d, text in rows:
                both = len(own & grams(text, k)[0])
                if d is not None and 100 * both >= 80 * len(own):
                    want[d, i] = (len(own), both)
    assert got == want and {(100 + i, i) for i in range(9)} <= set(got)
    clean = decontam.drop_contaminated(docs, items_df)
    assert clean.columns == docs.columns and clean.count() == len(rows) - len({d for d, _ in want})
    assert decontam.contaminated(docs, items_df.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), items_df).count() == 0


# ------------------------------------------------------------------ URL rules
def test_urls(spark):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    urls = {1: "http://A.Example.NET/en/x?y#z", 2: "https://example.net/de/", 3: "http://x.example.com/de/1", 4: "http://notexample.com/de/1",
            5: "http://w.org/fr/", 6: "http://w.org/fr", 7: None, 8: "no scheme", 9: "http://net", 10: "http://net/", 11: "http://h?q=/en/#f",
            12: "x://y://net/", 13: "http://example.net/en", 14: "://Host.Net/a", 15: ""}
    urls |= {i: f"http://spam.example.org/win/{i}?ref=1" for i in range(100, 120)}
    urls |= {i: f"http://good.example.org/win/{i}" for i in range(120, 160)}
    pages = spark.createDataFrame([*urls.items(), (None, "http://net/"), (100, urls[100])], "page_id long, url string") \
        .withColumn("host", F.lit("x")).withColumn("mined", F.lit(3)).withColumn("tokens", F.lit(3))
    labels = spark.createDataFrame([(i, i < 120) for i in range(100, 150)] + [(None, True), (5, None), (7, True), (15, True)],
                                   "id long, block boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, labels, rules).collect()}
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[2][2:] == ("net/", "block")
    assert got[3][2:] == ("example.com/de/", "block") and got[4][2:] == (None, "allow")
    assert got[5][2:] == ("org/fr/", "allow") and got[6] == ("w.org", "/fr", None, "allow")
    assert got[7] == got[8] == got[15] == ("", "", None, "allow")
    assert got[9] == ("net", "", None, "allow") and got[10][2:] == ("net/", "block") and got[11] == ("h", "", None, "allow")
    assert got[12] == ("y:", "//net/", None, "allow") and got[13][2] == "net/" and got[14] == ("host.net", "/a", "net/", "block")
    assert all(got[i][3] == ("block" if i < 120 else "allow") for i in range(100, 160))
    assert url_filter.judge(pages.limit(0), labels, rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, labels.limit(0), rules).filter("page_id >= 100").collect()} == {"allow"}


def test_mined_rules_of_every_length(spark):
    """Mined verdicts against all subsets of the tokens; one block rule needs three tokens."""
    import itertools
    triple = [("bad", "win", "ref")]
    halves = [("bad", "win", "x"), ("bad", "y", "ref"), ("z", "win", "ref")]
    rows = [(f"http://{h}/{p}?{q}=1&n{i}=2", (h, p, q) in triple) for i in range(12) for h, p, q in triple + halves]
    rows += [(f"http://h{i % 3}/p{i % 2}?q{i % 5}", i % 7 < 3) for i in range(60)]
    rows += [("http://bad/win?new=1", None), ("http://bad/win?new=1&ref=2", None)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows) if b is not None], "id long, block boolean")
    got = {r.page_id: r.mined for r in url_filter.judge(pages, labels, {}).collect()}
    tokens = {r.page_id: frozenset(r.t) for r in pages.select("page_id", url_filter.tokens_of(F.col("url")).alias("t")).collect()}
    n_pages, blocked = {}, {}
    for i, (_, b) in enumerate(rows):
        for k in range(1, len(tokens[i]) + 1) if b is not None else ():
            for s in itertools.combinations(sorted(tokens[i]), k):
                n_pages[s] = n_pages.get(s, 0) + 1
                blocked[s] = blocked.get(s, 0) + b
    rules = [set(s) for s, n in n_pages.items() if blocked[s] >= 5 and blocked[s] * 100 >= n * 80]
    assert got == {i: any(r <= tokens[i] for r in rules) for i in tokens}
    assert got[len(rows) - 1] and not got[len(rows) - 2] and min(map(len, rules)) == 3


def test_tokens_that_always_stand_together(spark):
    """24 tokens on the same pages are mined as one: no set of all their subsets, the same verdicts."""
    many = "&".join(f"q{i}=1" for i in range(24))
    rows = [(f"http://h{i % 3}/win?{many}&u{i}=1", True) for i in range(10)]           # with the path: blocked
    rows += [(f"http://h{i % 3}/x?{many}", False) for i in range(10)]                  # without it: half of all
    rows += [(f"http://h{i % 3}/win?z=1", False) for i in range(10)]
    spam = "&".join(f"s{i}=1" for i in range(24))
    rows += [(f"http://h{i % 3}/y?{spam}", True) for i in range(10)]                   # each token a rule by itself
    n = len(rows)
    rows += [("http://a/win?q7=1", None), ("http://a/x?q7=1&q8=2", None), ("http://a/win", None), ("http://a/b?s3=1", None), ("http://a/y", None)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows) if b is not None], "id long, block boolean")
    got = {r.page_id: r.mined for r in url_filter.judge(pages, labels, {}).collect()}
    assert [got[i] for i in range(n)] == [i < 10 or i >= 30 for i in range(n)]
    assert [got[n + i] for i in range(5)] == [True, False, False, True, True]
    rules, named = url_filter.mine_block_rules(
        pages.join(labels.withColumnRenamed("id", "page_id"), "page_id").select(url_filter.tokens_of(F.col("url")).alias("tokens"), "block"), 5, 1, 80)
    pairs = {tuple(r.names) for r in rules.collect() if len(r.names) > 1}
    names = {r.token: r.name for r in named.collect()}
    assert pairs == {("p:win", "q:q0")} and all(names[f"q:q{i}"] == "q:q0" for i in range(24))
    assert {names[f"q:s{i}"] for i in range(24)} == {f"q:s{i}" for i in range(24)}     # rules by themselves


def test_topk_of_more_than_the_seed_rows():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(400, 32)) * 1024)
    x *= np.linspace(0.2, 3, 400)[:, None].round(1)
    x = np.floor(x)
    q, ids = np.floor(rng.normal(size=(5, 32)) * 1024), np.arange(400)
    found = topk.search_block(np.arange(1000, 1005), q, ids, x, 100)
    for i in range(5):
        scores = x @ q[i]
        want = [(1000 + i, int(j), int(scores[j])) for j in np.lexsort((ids, -scores))[:100]]
        assert [f for f in found if f[0] == 1000 + i] == want


def test_word_hash_cache_is_bounded(monkeypatch):
    from mallsight.llm import common
    monkeypatch.setattr(common, "WORD_CACHE", 10)
    cache = WordHash()
    ws = [b"%d" % i for i in range(100)]
    assert (cache.hashes(ws) == cache.hashes(ws)).all() and len(cache) <= 10
