"""Near-duplicate, passage and line removal against brute force, with odd inputs."""

import hashlib
import random

import numpy as np
import pytest
from llm_helpers import docs_df, near_dup_components, passages_removed, shingle_set, words
from pyspark.sql import functions as F

from mallsight.llm import components, line_dedup, near_dedup, substring
from mallsight.llm.common import WordHash, shingle_hashes


def corpus(seed, n=60, length=80, vocabulary=400):
    """Random texts, near copies at many distances, exact copies, shared passages, odd texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    texts = [" ".join(word() for _ in range(rng.randrange(1, length))) for _ in range(n)]
    base = [word() for _ in range(length * 2)]
    for edits in range(0, 24):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = word()
        texts.append(("\n" if edits % 2 else " ").join(copy))
    texts += [texts[3], texts[3].upper(), "", "  \t ", "one", "One", "two words", "two\x0bwords", "a b c", "a b c",
              " ".join(["same"] * 300), " ".join(["same"] * 299), " ".join(base[:60] + [word() for _ in range(40)]),
              "é ß " * 70, " ".join(["x"] * 5)]
    rng.shuffle(texts)
    return list(enumerate(texts, start=10))


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_all_pairs(spark, k, percent):
    rows = corpus(k)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs_df(spark, rows, extra=True), k, percent).collect()}
    want = near_dup_components(rows, k, percent)
    assert len(got) == len(rows)
    for i, text in rows:
        assert (got[i].n_shingles, got[i].component_id) == (len(shingle_set(text, k)), want[i]), text
        assert got[i].kept == (want[i] == i)


def test_near_duplicates_of_a_large_group(spark):
    """600 different near copies of one text: stragglers are found through any other copy."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(600):
        copy = list(base)
        for _ in range(rng.randrange(0, 6)):
            copy[rng.randrange(120)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs_df(spark, rows), 3, 85).collect()}
    assert got == near_dup_components(rows, 3, 85)


def test_near_duplicates_of_a_crowded_leader(spark, monkeypatch):
    """A third of all rows follow one leader; followers spread over groups of a few rows each."""
    monkeypatch.setattr(near_dedup, "MINOR_BLOCK", 8)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join(base[:i % 3] + [f"x{i}"] + base[i % 3:])) for i in range(100)]
    rows += [(i, " ".join(f"w{rng.randrange(10_000)}" for _ in range(30))) for i in range(100, 300)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs_df(spark, rows), 3, 85).collect()}
    assert got == near_dup_components(rows, 3, 85)


def test_near_duplicates_of_very_long_texts(spark):
    """Texts of 60,000 words: the last words decide, so no prefix stands for the whole."""
    base = [f"b{i * 7919 % 50_021}" for i in range(60_000)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:-500] + ["end"] * 3)),
            (3, " ".join(base[:40_000] + [f"other{i}" for i in range(20_000)])), (4, "x" * 1_000_000), (5, "x" * 1_000_000)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs_df(spark, rows), 3, 85).collect()}
    assert got == near_dup_components(rows, 3, 85) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c d"), (1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (4, "A B C d"), (5, None)]
    got = near_dedup.near_duplicates(docs_df(spark, rows), 3, 85).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in got) == [
        (-1, 2, -1, True), (1, 0, 1, True), (2, 0, 2, True), (3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False),
        (5, 0, 5, True)]
    assert near_dedup.near_duplicates(docs_df(spark, []), 3, 85).count() == 0


def test_near_duplicates_of_different_texts_under_one_id(spark):
    """Both texts of id 1 stand for a class; each keeps its own links."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, "alone")]
    got = near_dedup.near_duplicates(docs_df(spark, rows), 3, 85).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]


def test_drop_near_duplicates_keeps_one_of_each_group(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (2, "other text of some words here"), (3, "x"), (3, "x"), (None, "x"), (4, None)]
    docs = docs_df(spark, rows)
    out = near_dedup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in out.collect()) == [
        (-1, "x"), (1, "a b c d e f"), (2, "A b c d e f"), (2, "other text of some words here"), (3, "x"), (4, "")]


def test_posterior_floor_is_safe():
    """At similarity 0.85 a pair falls below a batch's floor with probability near the chosen miss."""
    floors = near_dedup.posterior_floor(0.85, 1e-6)
    rng = np.random.default_rng(0)
    matches = (rng.random((200_000, near_dedup.N_HASHES)) < 0.85).cumsum(axis=1)
    for n, floor in floors.items():
        assert (matches[:, n - 1] < floor).sum() <= 3
        assert floor >= 0.4 * n  # and it prunes


def test_minhash_estimates_jaccard():
    words_, rng = WordHash(), random.Random(1)
    a = [b"%d" % rng.randrange(10**6) for _ in range(3000)]
    x, y = (shingle_hashes(words_.hashes(w), 3) for w in (a, a[:2400] + [b"%d" % rng.randrange(10**6) for _ in range(600)]))
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((near_dedup.minhash(x) == near_dedup.minhash(y)).mean() - true) < 0.15


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(1000, 1300)]
    links = path + star + [(5, 5), (1200, 3), (None, 4)]
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 3 for i in (3, 7, *range(1000, 1300))}


def test_every_cover_reaches_every_difference():
    for period, cover in substring.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    for window in (1, 5, 20, 50, 100):
        size, period, _ = substring.cover_for(window)
        assert size >= 1 and size + period - 1 == window


@pytest.mark.parametrize("window", [5, 20, 50])
def test_passages_equal_brute_force(spark, window):
    rng = random.Random(window)
    rows = corpus(window + 1, n=40)
    passage = [f"p{i}" for i in range(70)]
    for i in range(200, 230):
        ws = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(0, 90))]
        at = rng.randrange(0, len(ws) + 1)
        lo = rng.randrange(0, 30)
        rows.append((i, " ".join(ws[:at] + passage[lo:lo + rng.randrange(20, 71)] + ws[at:])))
    got = {r.doc_id: r for r in substring.repeated_passages(docs_df(spark, rows, extra=True), window).collect()}
    for i, kept in passages_removed(rows, window):
        n = len(words(dict(rows)[i]))
        assert (got[i].n_words, got[i].n_removed) == (n, n - len(kept)), i
        assert got[i].kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()
        if 0 < got[i].n_removed < n:
            assert got[i].kept_text == " ".join(kept)


def test_passages_of_very_long_texts(spark):
    """A passage at the far end of a text of 60,000 words, and one held by a third of all rows."""
    long = [f"l{i}" for i in range(60_000)]
    passage = [f"p{i}" for i in range(55)]
    rows = [(1, " ".join(long + passage)), (2, " ".join(["a", *passage, "b"])), (3, " ".join(long[59_930:]))]
    rows += [(i, " ".join([f"u{i}", *passage[:52]])) for i in range(10, 40)]
    rows += [(i, " ".join(f"v{i * 100 + j}" for j in range(60))) for i in range(40, 100)]
    got = {r.doc_id: r for r in substring.repeated_passages(docs_df(spark, rows), 50).collect()}
    for i, kept in passages_removed(rows, 50):
        n = len(words(dict(rows)[i]))
        assert (got[i].n_words, got[i].n_removed) == (n, n - len(kept)), i
        assert got[i].kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_passages_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (9, text), (9, text), (9, "y " + text), (5, text + " z"), (6, None), (7, ""), (12, text)]
    got = substring.repeated_passages(docs_df(spark, rows), 50).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in got) == [
        (-1, 60, 0), (5, 61, 0), (6, 0, 0), (7, 0, 0), (9, 60, 60), (9, 60, 60), (9, 61, 60), (12, 60, 60)]
    assert substring.repeated_passages(docs_df(spark, []), 50).count() == 0


def test_line_spread(spark):
    rows = [(i, f"own line {i}\n  shared by four \nshared by three" if i < 3 else f"own {i}\nshared by four\t", f"s{i}") for i in range(4)]
    rows += [(10, "shared by four\n\n\nkept", None), (11, None, "s9"), (12, "", "s9"), (13, "many of one site\n" * 50, "s0"),
             (None, "shared by four", "s1")]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text)
           for r in line_dedup.drop_boilerplate(docs_df(spark, rows, extra=True), sites=4).collect()}
    assert got[0] == (3, 1, "own line 0\nshared by three")
    assert got[10] == (4, 1, "\n\nkept")
    assert got[11] == (0, 0, None) and got[12] == (1, 0, "") and got[13][1] == 0
    assert got[None] == (1, 1, "")
    assert line_dedup.drop_boilerplate(docs_df(spark, [])).count() == 0


def test_line_spread_of_very_long_texts(spark):
    """The last of 50,000 lines, and one line of a million characters, are judged like any other."""
    wide = "x" * 1_000_000
    rows = [(i, "\n".join([*(f"own {i} {j}" for j in range(50_000 if i == 0 else 5)), wide, "shared"]), f"s{i}") for i in range(4)]
    rows.append((9, f"{wide}y\nshared", "s9"))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.drop_boilerplate(docs_df(spark, rows), sites=4).collect()}
    for i, text, _ in rows:
        kept = [x for x in text.split("\n") if x not in (wide, "shared")]
        assert got[i] == (text.count("\n") + 1, text.count("\n") + 1 - len(kept), "\n".join(kept)), i


def test_line_spread_counts_an_empty_site(spark):
    rows = [(i, f"shared\nown {i}", s) for i, s in enumerate(["a", "b", "c", ""])]
    got = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(docs_df(spark, rows), sites=4).collect()}
    assert got == {i: f"own {i}" for i in range(4)}


def test_line_spread_beyond_the_exact_band(spark):
    """400 sites: the sketch alone decides; just below and at the threshold the exact count does."""
    rows = [(i, "on all\n" + ("on 49\n" if i < 49 else "") + ("on 50" if i < 50 else "none"), f"s{i}") for i in range(400)]
    lines = docs_df(spark, rows).select(F.explode(line_dedup.lines_of(F.col("text"))).alias("line"), F.col("source").alias("site")) \
        .select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"), "site", "line")
    bad = line_dedup.spread_lines(lines.drop("line"), 50)
    assert sorted(r.line for r in lines.join(bad, ["h1", "h2"]).select("line").distinct().collect()) == ["none", "on 50", "on all"]
