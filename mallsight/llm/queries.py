"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole table(s) it is
meant for and returns the full result; it is thin, the operators hold the methods.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_trie, decontam, divergence, licenses, line_dedup, mixing, near_dedup, quality, secrets, sharding, substring, topk,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Word pattern inside the SQL texts.
W = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, oracle: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def near_dup_sql(docs: str, shingle: int, percent: int) -> str:
    """CTEs ending in ``near_dups(doc_id, n_shingles, component_id)`` over all pairs that share a shingle."""
    return rf"""
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{W}') AS ws FROM {docs}),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {shingle} THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, CAST(len(ws) - {shingle - 2} AS BIGINT)),
                            lambda i: array_to_string(ws[i:i + {shingle - 1}], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM shared JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
         WHERE 100 * c >= {percent} * (x.n + y.n - c)),
sym AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, sym.v FROM reach r JOIN sym ON sym.u = r.b),
near_dups AS (SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
         FROM w LEFT JOIN n USING (doc_id)
         JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) c USING (doc_id))"""


@query("op2_minhash_dedup", oracle=f"""
WITH RECURSIVE {near_dup_sql("documents", 3, 85)}
SELECT doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM near_dups""")
def op2_minhash_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


@query("op10_substring_dedup", oracle=rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{W}') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
        FROM w, unnest(range(1, CAST(len(ws) - 48 AS BIGINT))) AS u(i) WHERE len(ws) >= 50),
firsts AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN firsts USING (h), unnest(range(0, 50)) AS o(k) WHERE lo < doc_id),
word AS (SELECT doc_id, p, ws[p] AS x FROM w, unnest(range(1, CAST(len(ws) + 1 AS BIGINT))) AS u(p)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op10_substring_dedup(spark, sf_dir):
    return (substring.repeated_passages(table(spark, sf_dir, "documents"), window=50)
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return (quality.score_documents(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), "quality")
            .select("doc_id", "held_out", "score", "predicted"))


@query("op3_source_mix", oracle=rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{W}')) AS BIGINT) AS size,
                  md5(concat('mix-1:', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
r AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w, 2 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS place FROM r),
l AS (SELECT *, 150 * sum(source_size) OVER () - 100 * coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest FROM o),
f AS (SELECT min(place) AS place FROM l WHERE rest * w < 100 * cap * w_rest),
t AS (SELECT l.source, l.source_size,
             CASE WHEN f.place IS NULL OR l.place < f.place THEN CAST(l.cap AS DOUBLE)
                  ELSE CAST(l.w AS DOUBLE) * CAST(x.rest AS DOUBLE) / (100.0 * CAST(x.w_rest AS DOUBLE)) END AS target
      FROM l CROSS JOIN f LEFT JOIN l x ON x.place = f.place),
b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM t),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
p AS (SELECT d.*, e.source_size, e.target, e.epochs, e.budget - e.epochs * e.source_size AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM p""")
def op3_source_mix(spark, sf_dir):
    return (mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), percent=150, limit=2)
            .select("doc_id", "size", "source_size", "target", "taken"))


#: CRC-32 (polynomial 0xEDB88320) of a blob's hex text, by table; DuckDB has no function for it.
CRC_SQL = """
tab AS (SELECT list(c ORDER BY n) AS t FROM (
   SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
   FROM range(256) r(n))),
hexed AS (SELECT text, hex(encode(text)) AS x FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)),
crc AS (SELECT text, CAST(xor(list_reduce(list_prepend(4294967295, list_transform(range(CAST(length(x) // 2 AS BIGINT)),
     lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c // 256, tab.t[xor(c % 256, b) + 1])), 4294967295) AS BIGINT) AS crc
   FROM hexed, tab)"""


@query("op4_sharding", oracle=rf"""
WITH {CRC_SQL},
d AS (SELECT doc_id, coalesce(text, '') AS text, CAST(octet_length(encode(coalesce(text, ''))) + 16 AS BIGINT) AS size,
             CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
b AS (SELECT *, sum(size) OVER () AS total,
             sum(size) OVER (ORDER BY h, doc_id NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               - sum(size) OVER (PARTITION BY h, doc_id) AS below
      FROM (SELECT * FROM d)),
g AS (SELECT *, sum(size) OVER (PARTITION BY h) AS together, min(below) OVER (PARTITION BY h) AS first,
             greatest(2 * max(size) OVER (), total // 800) AS most FROM b),
p AS (SELECT *, CAST(CASE WHEN together <= most THEN max(CASE WHEN 2 * (below - first) <= together THEN 40 * below // total END) OVER (PARTITION BY h)
                          ELSE 40 * below // total END AS INT) AS shard FROM g)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM p JOIN crc USING (text)""")
def op4_sharding(spark, sf_dir):
    return (sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=40, overhead=16)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


@query("op5_line_dedup", oracle=r"""
WITH l AS (SELECT doc_id, source, i, string_split(text, chr(10))[i] AS raw, trim(string_split(text, chr(10))[i], ' ' || chr(9) || chr(13)) AS line
           FROM documents, unnest(range(1, CAST(len(string_split(text, chr(10))) + 1 AS BIGINT))) AS u(i)),
bad AS (SELECT line FROM l WHERE line <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 4),
k AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY i) AS text, count(*) AS kept FROM l ANTI JOIN bad USING (line) GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k.kept, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN k USING (doc_id)""")
def op5_line_dedup(spark, sf_dir):
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"), sites=4)


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of one repository per source: every 10th id is a licence file, and
    ids divisible by 1000 or 100 lie one or two directories higher than the others."""
    n = F.col("doc_id")
    name = F.when(n % 10 == 0, F.concat(F.lit("LICENSE-"), n)).otherwise(F.concat(n, F.lit(".txt")))
    folder = F.when(n % 1000 == 0, F.lit("")).when(n % 100 == 0, F.concat(F.expr("doc_id div 1000"), F.lit("/"))) \
        .otherwise(F.concat(F.expr("doc_id div 1000"), F.lit("/"), F.expr("doc_id div 100"), F.lit("/")))
    return docs.select(F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), folder, name).alias("path"), "text")


def _template_sql() -> str:
    return ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(licenses.TEMPLATES))


_TERM = r"([0-9]+(?:\.[0-9]+)+|[\p{L}\p{N}]+)"


@query("op6_license_scan", oracle=rf"""
WITH tpl AS (SELECT template, license, unnest(list_distinct(regexp_extract_all(lower(notice), '{_TERM}'))) AS term
             FROM (VALUES {_template_sql()}) v(template, license, notice)),
f AS (SELECT concat(coalesce(source, 'none'), '/', CASE WHEN doc_id % 1000 = 0 THEN '' WHEN doc_id % 100 = 0 THEN concat(doc_id // 1000, '/')
        ELSE concat(doc_id // 1000, '/', doc_id // 100, '/') END,
        CASE WHEN doc_id % 10 = 0 THEN concat('LICENSE-', doc_id) ELSE concat(doc_id, '.txt') END) AS path, text FROM documents),
doc AS (SELECT path, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: list_distinct(regexp_extract_all(lower(x), '{_TERM}'))),
                                 lambda t: len(t) > 0) AS ls FROM f),
ln AS (SELECT path, unnest(ls) AS terms FROM doc),
total AS (SELECT count(*) AS n FROM ln),
df AS (SELECT term, count(*) AS n FROM (SELECT unnest(terms) AS term FROM ln) GROUP BY 1),
v AS (SELECT DISTINCT tpl.term, ln((1.0 + total.n) / (1.0 + coalesce(df.n, 0))) + 1.0 AS idf FROM tpl LEFT JOIN df USING (term), total),
norm AS (SELECT template, license, sqrt(sum(idf * idf)) AS norm FROM tpl JOIN v USING (term) GROUP BY 1, 2),
known AS (SELECT list(term) AS words FROM v),
span AS (SELECT path, ls, i, w FROM doc, (VALUES {", ".join(f"({w})" for w in licenses.WINDOWS)}) s(w), unnest(range(1, CAST(len(ls) - w + 2 AS BIGINT))) AS u(i)
         UNION ALL SELECT path, ls, 1, {licenses.WHOLE} FROM doc WHERE len(ls) > 0 AND regexp_matches(path, '/LICENSE-[0-9]+$')),
un AS (SELECT path, i, w, list_distinct(flatten(ls[i:i + w - 1])) AS terms FROM span),
lt AS (SELECT path, i, w, len(terms) AS n_terms, unnest(list_intersect(terms, words)) AS term FROM un, known
       WHERE len(list_intersect(terms, words)) * 10000 >= len(terms) * 6400),
sq AS (SELECT path, i, w, any_value(n_terms) AS n_terms, count(*) AS known, sum(idf * idf) AS known_sq FROM lt JOIN v USING (term) GROUP BY 1, 2, 3),
dot AS (SELECT path, i, w, template, sum(idf * idf) AS dot FROM lt JOIN v USING (term) JOIN tpl USING (term) GROUP BY 1, 2, 3, 4),
sc AS (SELECT path, i, w, license, round(dot / (sqrt(known_sq + (n_terms - known) * pow(ln(1.0 + total.n) + 1.0, 2)) * norm), 6) AS score
       FROM dot JOIN sq USING (path, i, w) JOIN norm USING (template), total),
own AS (SELECT path, license, score FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY score DESC, i, w, license) AS rn
        FROM sc WHERE score >= 0.8) WHERE rn = 1),
fd AS (SELECT DISTINCT path, regexp_replace(path, '/?[^/]*$', '') AS dir FROM f),
ld AS (SELECT dir, license, score FROM (SELECT dir, license, score, row_number() OVER (PARTITION BY dir ORDER BY score DESC, path) AS rn
        FROM own JOIN fd USING (path) WHERE regexp_matches(path, '/LICENSE-[0-9]+$')) WHERE rn = 1),
inh AS (SELECT path, ld.dir, ld.license, ld.score, row_number() OVER (PARTITION BY path ORDER BY length(ld.dir) DESC) AS rn
        FROM fd JOIN ld ON fd.dir = ld.dir OR starts_with(fd.dir, ld.dir || '/'))
SELECT fd.path, coalesce(own.license, inh.license) AS license, coalesce(own.score, inh.score) AS score,
       CASE WHEN own.path IS NOT NULL THEN 'own' WHEN inh.path IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN own.path IS NULL THEN inh.dir END AS license_dir
FROM fd LEFT JOIN own USING (path) LEFT JOIN (SELECT * FROM inh WHERE rn = 1) inh USING (path)""")
def op6_license_scan(spark, sf_dir):
    return licenses.scan_licenses(document_files(table(spark, sf_dir, "documents")))


@query("op7_exact_topk", oracle="""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.e, x.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id AND len(q.e) = len(x.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def op7_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10, scale=1024)


_WORDS_SQL = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


def contaminated_sql(docs: str) -> str:
    """CTEs ending in ``leaks(doc_id, item_id, item_shingles, shared)``."""
    gram = lambda k: (f"list_transform(range(1, CAST(greatest(len(ws) - {k} + 2, 1) AS BIGINT)), "  # noqa: E731
                      f"lambda i: array_to_string(ws[i:i + {k} - 1], ' '))")
    return f"""
iw AS (SELECT item_id, {_WORDS_SQL} AS ws FROM benchmark WHERE item_id IS NOT NULL),
ish AS (SELECT DISTINCT item_id, least(len(ws), 5) AS k, unnest({gram("least(len(ws), 5)")}) AS sh FROM iw WHERE len(ws) > 0),
isz AS (SELECT item_id, count(*) AS n FROM ish GROUP BY 1),
dw AS (SELECT doc_id, {_WORDS_SQL} AS ws FROM {docs} WHERE doc_id IS NOT NULL),
dsh AS (SELECT DISTINCT doc_id, k, unnest({gram("k")}) AS sh FROM dw, (SELECT DISTINCT k FROM ish)),
leaks AS (SELECT doc_id, item_id, n AS item_shingles, count(*) AS shared FROM dsh JOIN ish USING (k, sh) JOIN isz USING (item_id)
          GROUP BY 1, 2, 3 HAVING count(*) * 100 >= n * 80)"""


@query("op8_decontaminate", oracle=f"WITH {contaminated_sql('documents')} SELECT * FROM leaks")
def op8_decontaminate(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Explicit URL rules of op9.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def _rule_sql() -> tuple[str, str]:
    rule = verdict = ""
    for r, says in sorted(URL_RULES.items(), key=lambda x: (-len(x[0]), x[0])):
        host, path = r[:r.index("/")], r[r.index("/"):]
        fits = f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN "
        rule, verdict = rule + fits + f"'{r}' ", verdict + fits + f"'{says}' "
    return f"CASE {rule}END", f"CASE {verdict}END"


_RULE, _VERDICT = _rule_sql()


@query("op9_url_filter", oracle=rf"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, rest, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
tk AS (SELECT page_id, url, list_distinct(list_concat(
    CASE WHEN contains(url, '://') AND instr(url, '://') > 1 THEN ['s:' || translate(string_split(url, '://')[1], '{UPPER}', '{LOWER}')] ELSE [] END,
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
    list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'p:' || x),
    list_transform(list_filter(list_transform(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
        lambda x: string_split(x, '=')[1]), lambda x: x <> ''), lambda x: 'q:' || x))) AS tokens FROM p),
lab AS (SELECT t.page_id, t.tokens, l.quality = 0 AS block FROM tk t JOIN labels l ON l.doc_id = t.page_id
        WHERE l.quality IS NOT NULL AND (len(t.tokens) > 0 OR l.quality = 0)),
need AS (SELECT greatest(5, CAST(ceil(count(*) / 1000.0) AS BIGINT)) AS least FROM lab),
one AS (SELECT page_id, block, unnest(tokens) AS a FROM lab),
sets AS (SELECT [a] AS s, block, page_id FROM one UNION ALL
         SELECT [x.a, y.a], x.block, x.page_id FROM one x JOIN one y ON x.page_id = y.page_id AND x.a < y.a),
mined AS (SELECT s, count(*) AS n, count(*) FILTER (WHERE block) AS b FROM sets GROUP BY 1),
rules AS (SELECT s FROM mined, need WHERE b >= least AND b * 100 >= n * 80),
fired AS (SELECT DISTINCT url FROM tk, rules WHERE list_has_all(tokens, s))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, {_RULE} AS rule,
       coalesce({_VERDICT}, CASE WHEN fired.url IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, fired.url IS NOT NULL AS mined
FROM p LEFT JOIN fired USING (url)""")
def op9_url_filter(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 0).alias("block"))
    return url_filter.judge(table(spark, sf_dir, "pages"), labels, URL_RULES)


@query("op11_secret_scan")
def op11_secret_scan(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.kind != "novel")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


@query("op12_conversation_trie", oracle=rf"""
WITH RECURSIVE t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS i
      FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT list(c ORDER BY n) AS t FROM (
   SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
   FROM range(256) r(n))),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, CAST(xor(list_reduce(list_prepend(4294967295, list_transform(range(length(CAST(conv_id AS VARCHAR))),
        lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i + 1, 1)) AS BIGINT))), lambda x, b: xor(x // 256, bits.t[xor(x % 256, b) + 1])), 4294967295) AS BIGINT) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM t), bits),
turns AS (SELECT c.conv_id, 0 AS part, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
          UNION ALL SELECT c.conv_id, 1, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d FROM turns),
seq(conv_id, d, pre, text) AS (SELECT conv_id, CAST(0 AS BIGINT), sha256(''), '' FROM c
  UNION ALL SELECT s.conv_id, r.d, sha256(concat(s.pre, '|', length(r.role), ':', r.role, r.text)), r.text FROM seq s JOIN r ON r.conv_id = s.conv_id AND r.d = s.d + 1),
m AS (SELECT s.*, min(s.conv_id) OVER (PARTITION BY s.d, s.pre) AS node, max(s.d) OVER (PARTITION BY s.conv_id) AS last FROM seq s),
up AS (SELECT m.*, p.node AS parent FROM m LEFT JOIN m p ON p.conv_id = m.conv_id AND p.d = m.d - 1),
n AS (SELECT node AS conv_id, d AS depth, min(parent) AS parent_conv_id, count(*) AS n_convs,
             (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(min(text), '{W}')) END AS saved,
             sha256(coalesce(string_agg(CAST(up.conv_id AS VARCHAR), ',' ORDER BY up.conv_id) FILTER (WHERE d = last), '')) AS ends_sha256
      FROM up GROUP BY 1, 2),
k AS (SELECT n.*, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.parent_conv_id = n.conv_id) AS n_children FROM n),
above AS (SELECT DISTINCT a.node AS conv_id, a.d AS depth, b.node AS below, b.d AS below_depth FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.d >= a.d),
s AS (SELECT a.conv_id, a.depth, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves, sum(k.saved) AS saved_tokens
      FROM above a JOIN k ON k.conv_id = a.below AND k.depth = a.below_depth GROUP BY 1, 2)
SELECT conv_id, depth, parent_conv_id, CAST(n_convs AS BIGINT) AS n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256 FROM k JOIN s USING (conv_id, depth)""")
def op12_conversation_trie(spark, sf_dir):
    return conversation_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


@query("op13_source_divergence", oracle=rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
lt AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
gt AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN lt USING (lang, term) GROUP BY 1, 2, 3),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM lt GROUP BY 1),
g AS (SELECT x.lang, x.source, coalesce(sum(gt.n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN gt USING (lang, source) GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, lt.term, coalesce(gt.n, 0) AS n, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(gt.n, 0) + 1)) // (CAST(g.total AS HUGEINT) + l.v) AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (lt.n + 1)) // (CAST(l.total AS HUGEINT) + l.v) AS q
      FROM g JOIN l USING (lang) JOIN lt USING (lang) LEFT JOIN gt USING (lang, source, term)),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200""")
def op13_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)
