"""Secret scan, conversation trie and source divergence against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm_helpers import CLASHING, WORD, docs_df
from pyspark.sql import functions as F

from mallsight.llm import conversation_trie as T
from mallsight.llm import divergence, queries, secrets
from mallsight.llm.list_rank import list_rank
from mallsight.llm.term_counts import term_counts

# ---- secrets ---------------------------------------------------------------------------------

LETTERS = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")


def base_spans(text):
    """The statement of the base patterns, place by place, without the scanner's shortcuts."""
    found = []
    for kind, pattern, fits in (
            ("assign", "(" + LETTERS + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 6),
            ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 24)):
        at, rx = 0, re.compile(pattern)
        while m := next((m for i in range(at, len(text)) if (m := rx.match(text, i))), None):
            if fits(m):
                found.append((m.start(), ("assign", "access", "hex").index(kind), kind, m.end()))
            at = m.end()
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def prose(r, n):
    return " ".join("".join(r.choice(("ka", "lo", "mi", "ter", "son", "ne")) for _ in range(r.randint(2, 4))) for _ in range(n))


def test_base_spans_equal_brute_force(spark):
    r = random.Random(5)
    bits = ["password", "PassWd", "secret", "token", "api_key", "apiKEY", "ſecret", "toKen", '"', "'", " ", "=", ":", "abc", "AKIA", "ABCDEF0123456789",
            "deadbeef", "0123456789abcdef", "é", "\n", "hunter2", "-", "."]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(400)]
    texts += ["token = " + "x" * 6, "token = xxxxx", "é" * 3 + "AKIA" + "A" * 16, "AKIA" + "A" * 15, "a" * 23, "a" * 24, "b" * 200_000,
              ("password=abcdefg " * 5000)]
    df = docs_df(spark, list(enumerate(texts)) + [(None, "secret: abcdef"), (999, None), (999, "")], extra=True)
    rows = secrets.find_secrets(df).collect()
    assert len(rows) == len(texts) + 3
    got = {row.doc_id: [f"{s.kind}:{s.start}:{s.end}" for s in row.spans if s.kind != "novel"] for row in rows if row.doc_id != 999}
    for i, t in enumerate(texts):
        assert got[i] == base_spans(t) if len(t) < 1000 else len(got[i]) in (1, 5000), (i, t[:80])
    assert got[None] == ["assign:0:14"]
    assert sorted(len(row.spans) for row in rows if row.doc_id == 999) == [0, 0]


def test_keys_are_novel_and_names_are_not(spark):
    r = random.Random(7)
    filler = [(i, prose(r, 200)) for i in range(60)]
    keys = ["".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(32)) for _ in range(30)]
    names = ["_".join(r.choice(("kalo", "miter", "sonne", "lokami")) for _ in range(5)) for _ in range(30)]
    planted = [(1000 + i, f"{prose(r, 150)} Authorization: Bearer {k} {prose(r, 150)}") for i, k in enumerate(keys)]
    plain = [(2000 + i, f"{prose(r, 150)} credential {n} {prose(r, 150)}") for i, n in enumerate(names)]
    far = [(3000, f"{prose(r, 150)} {keys[0]} {prose(r, 150)}"), (3001, f"bearer\n{keys[1]} {prose(r, 150)}"),
           (3002, f"{prose(r, 90)} bearer {keys[2]} {prose(r, 20)} {keys[2]} {prose(r, 90)}")]
    got = {row.doc_id: row.spans for row in secrets.find_secrets(docs_df(spark, filler + planted + plain + far)).collect()}
    for i, k in enumerate(keys):
        assert [(s.kind, s.secret) for s in got[1000 + i]] == [("novel", k)] and got[1000 + i][0].novelty >= secrets.NOVEL
        start = dict(planted)[1000 + i].index(k)
        assert (got[1000 + i][0].start, got[1000 + i][0].end) == (start, start + len(k))
    assert not any(got[2000 + i] for i in range(30)), "names made of known pieces"
    assert not got[3000] and not got[3001], "no sensitive word on the line"
    assert [s.secret for s in got[3002]] == [keys[2]], "a copy close by does not hide it"


def test_identifier_dictionary_is_counted_over_all_rows(spark):
    rows = [(i, f"common word{'x' * (i % 3)} Common") for i in range(30)] + [(99, "once"), (98, None)]
    assert secrets.identifier_dictionary(docs_df(spark, rows)) == b"wordxx wordx word common"
    assert secrets.identifier_dictionary(docs_df(spark, rows), max_bytes=12) == b"word common"
    assert secrets.identifier_dictionary(docs_df(spark, [])) == b""
    assert secrets.find_secrets(docs_df(spark, [])).collect() == []


def test_term_counts(spark):
    rows = [(1, "A a b", "x"), (2, "a1b", "x"), (3, "É é", None), (4, None, "x"), (5, "a " * 70_000, "y")]
    got = {(r.source, r.term): (r.n, r.docs) for r in term_counts(docs_df(spark, rows), ("source",)).collect()}
    assert got == {("x", "a"): (3, 2), ("x", "b"): (2, 2), ("", "É"): (1, 1), ("", "é"): (1, 1), ("y", "a"): (70_000, 1)}


# ---- conversation trie -----------------------------------------------------------------------

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_order(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    return {c: [x[3:] for x in sorted(ts)] for c, ts in own.items()}


def rebuilt(rows):
    own = turn_order(rows)
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def trie(convs):
    """Every node by its whole prefix."""
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        leaves = [q for q in below if not any(x[:-1] == q and x for x in members)]
        saved = sum((len(members[q]) - 1) * len(WORD.findall(q[-1][1])) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in cs if len(convs[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), sum(1 for q in members if q and q[:-1] == p),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def conversations(r, n):
    rows = []
    for c in range(n):
        rows += [(c, t if r.random() < 0.95 else None, r.choice(("user", "assistant", None)), r.choice(("a b", "c", "", None, "d e f")))
                 for t in range(r.randint(0, 5))]
    rows += [(c, t, "user", "same opening") for c in range(n, 2 * n) for t in range(3)]  # whole copies
    rows += [(-3, 1, "user", "x"), (-20, 0, "u", "y"), (None, 1, "u", "z"), (-20, 0, "u", "y"), (7, 0, "userx", ""), (7, 0, "user", "x")]
    return rows + [(2 * n + 5, t, "u", "long " * 3) for t in range(700)] + [(2 * n + 6, 0, "u", "w " * 100_000)]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(-2**63 if x is None else x for x in r))


def test_tries_equal_brute_force(spark):
    r = random.Random(3)
    rows = conversations(r, 60)
    r.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in CLASHING])
    small = [x for x in rows if x[0] is None or x[0] < 125]  # the statement is quadratic
    want = lambda convs: sorted(trie(convs), key=lambda t: tuple(-2**63 if x is None else x for x in t))
    part = df.filter("conv_id IS NULL OR conv_id < 125")
    assert found(T.rebuilt_trie(part, rate=4, local=16)) == want(rebuilt(small))
    assert found(T.conversation_trie(part)) == want(turn_order(small))
    whole = T.rebuilt_trie(df, rate=8, local=64).filter("depth = 0").first()
    convs = rebuilt(rows)
    assert (whole.n_convs, whole.n_leaves) == (len(convs), sum(1 for n in trie_leaves(convs)))


def trie_leaves(convs):
    seqs = {tuple(ts) for ts in convs.values()}
    inner = {s[:d] for s in seqs for d in range(len(s))}
    return seqs - inner


def test_empty_conversations_have_no_root(spark):
    assert T.rebuilt_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert T.conversation_trie(spark.createDataFrame([(None, 1, "u", "t")], SCHEMA)).collect() == []


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(21, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    row = T.rebuilt_trie(spark.createDataFrame([(c, 1, "u", "t")], SCHEMA)).collect()
    assert [tuple(x) for x in row] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


@pytest.mark.parametrize("rate,local", [(4, 8), (16, 100), (64, 16_384)])
def test_list_rank(spark, rate, local):
    r = random.Random(rate)
    rows, want = [], {}
    for length in (1, 2, 700, 53):  # several lists at once
        ids = r.sample(range(10**6), length) if length > 2 else [10**7 + length, 10**8 + length][:length]
        weights = [r.randint(0, 9) for _ in ids]
        rows += [(a, b, w) for a, b, w in zip(ids, ids[1:] + [-1], weights)]
        want |= {a: sum(weights[i:]) for i, a in enumerate(ids)}
    r.shuffle(rows)
    got = {x.a: x.dist for x in list_rank(spark.createDataFrame(rows, "a long, after long, w long"), rate, local).collect()}
    assert got == want


# ---- source divergence -----------------------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergences(rows, least, top):
    """(lang, source, part, item, value, rank) from the statement, term by term."""
    docs = [(lang or "", source or "", TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for l, _, ts in docs if l == lang for t in set(ts))
        kept = [t for t in df if df[t] >= least]
        count = {s: Counter() for l, s, _ in docs if l == lang}
        for l, s, ts in docs:
            if l == lang:
                count[s].update(t for t in ts if df[t] >= least)
        total = sum(count.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda a, b: (a - b) ** 2 // b
        for s in count:
            pairs = [(-sum(f(p(count[s], t), p(count[o], t)) for t in kept), o.encode(), o) for o in count if o != s]
            terms = [(-f(p(count[s], t), p(total, t)), t.encode(), t) for t in kept if count[s][t] > 0 and p(count[s], t) > p(total, t)]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


@pytest.mark.parametrize("block", [128, 2])
def test_divergence_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", block)
    monkeypatch.setattr(divergence, "CHUNK_TERMS", 5)
    r = random.Random(11)
    vocab = [chr(97 + i % 26) * (1 + i // 26) for i in range(60)] + ["é", "É", "ß", "日本"]
    rows = [(r.choice(("en", "de", None, "")), r.choice(("s1", "s2", "s3", "", None, "é", "s4")), " ".join(r.choices(vocab, k=r.randint(0, 30)))) for _ in range(150)]
    rows += rows[:5] + [("xx", "only", "one two three")] + [("yy", "a", "rare"), ("yy", "b", None), ("yy", "c", "12 34")]
    rows += [("en", "s1", "Long LONG long " * 40_000)] + [("zz", s, "tie TIE other") for s in "abc"]
    df = spark.createDataFrame([(i, t, lang, s) for i, (lang, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string")
    df = df.select("*", *[F.lit(7).alias(c) for c in (*CLASHING, "term", "docs", "total", "kept", "chunk", "a", "b", "p", "q", "value")])
    for top in (200, 4):
        assert sorted(tuple(x) for x in divergence.audit(df, top=top).collect()) == divergences(rows, 3, top)


def test_divergence_of_nothing(spark):
    assert divergence.audit(docs_df(spark, [])).collect() == []


def test_large_counts_stay_exact(spark):
    """Counts whose product with the unit leaves BIGINT."""
    n, total, kept = 9 * 10**15, 9 * 10**16 + 7, 12345
    got = spark.range(1).select(F.lit(n).alias("n"), F.lit(total).alias("total"), F.lit(kept).alias("kept")) \
        .select(divergence.share("n", "total", "kept").alias("p")).first().p
    assert got == 1 + 10**9 * (n + 1) // (total + kept)


def test_scan_queries_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_secret_scan"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = base_spans(docs[r.doc_id] or "") if len(docs[r.doc_id] or "") < 3000 else None
        if base is not None:
            assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
            assert [s for s in r.spans.split(",") if s and not s.startswith("novel")] == base
