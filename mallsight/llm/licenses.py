"""Licence detection by sparse TF-IDF cosine, and inheritance along directories.

Every line, every header block (window of consecutive lines) and every whole licence file is compared
with the templates (one-line notices, SPDX lines, file headers, title blocks, short full texts).  Terms
are weighted by inverse line frequency over the whole corpus, and only the terms a unit shares with
the templates are joined (an inverted index).  A file's best unit names its own licence.  A directory
takes the licence of the best licence file directly inside it; files without a notice inherit from
the nearest ancestor directory that has one.  Only DataFrame functions.

A unit can reach the threshold with a template only if it holds one of the template's heaviest terms,
those without which less than the square of the threshold is left of its norm (prefix filtering).  Files
without any such term are passed over without loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import landed
from .license_texts import TEMPLATES

#: Lines with terms that a header block has.
WINDOWS = (1, 2, 3, 4, 6, 8, 12, 16, 24)
#: Width that stands for the whole of a licence file.
WHOLE = 1_000_000
EVERY_LINE = "\n"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice)([-._].*)?$"


def terms_of(line: Column) -> Column:
    """Distinct lower-case terms of a line: letters and digits, dotted numbers in one piece."""
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(r"([0-9]+(?:\.[0-9]+)+|[\p{L}\p{N}]+)"), F.lit(1)))


def units(files: DataFrame, vocabulary: Column) -> DataFrame:
    """``(path, first, width, n_terms, known)``: lines, windows of lines and whole licence files.

    ``first`` numbers the lines that have terms from 1; ``known`` are the terms of the vocabulary."""
    lines = files.select("path", F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), terms_of), lambda t: F.size(t) > 0).alias("lines"))
    spans = F.concat(*[F.when(F.size("lines") >= w, F.transform(F.sequence(F.lit(1), F.size("lines") - (w - 1)),
                                                                lambda i: F.struct(i.alias("first"), F.lit(w).alias("width"))))
                       .otherwise(F.array().cast("array<struct<first:int,width:int>>")) for w in WINDOWS],
                     F.when(name_of(F.col("path")).rlike(LICENSE_FILE) & (F.size("lines") > 0),
                            F.array(F.struct(F.lit(1).alias("first"), F.lit(WHOLE).alias("width"))))
                     .otherwise(F.array().cast("array<struct<first:int,width:int>>")))
    terms = F.array_distinct(F.flatten(F.slice("lines", F.col("span.first"), F.col("span.width"))))
    return (lines.select("path", "lines", F.explode(spans).alias("span"))
            .select("path", "span.first", "span.width", terms.alias("terms"))
            .select("path", "first", "width", F.size("terms").alias("n_terms"), F.array_intersect("terms", vocabulary).alias("known")))


def name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def notices(files: DataFrame, templates: list[tuple[str, str]], percent: int) -> DataFrame:
    """``(path, license, score)``: each file's best unit, where its cosine reaches ``percent`` %.

    A unit's vector has the weight idf = ln((1 + lines) / (1 + lines with the term)) + 1 for each
    distinct term; terms outside the templates weigh as if no line had them.  Ties go to the first
    unit, then the narrower one, then the licence's name.
    """
    spark = files.sparkSession
    rows = [(i, license, text) for i, (license, text) in enumerate(templates)]
    of_template = (spark.createDataFrame(rows, "template int, license string, notice string")
                   .select("template", "license", F.explode(terms_of(F.col("notice"))).alias("term")))
    vocabulary = sorted(r.term for r in of_template.select("term").distinct().collect())  # the caller's templates only
    words = F.array(*[F.lit(t) for t in vocabulary])
    # one pass counts the lines of every known term and, under a term no line has, all lines
    lines = (files.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
             .select(terms_of(F.col("line")).alias("terms")).filter(F.size("terms") > 0).select(F.array_intersect("terms", words).alias("known")))
    seen = landed(lines.select(F.explode(F.concat("known", F.array(F.lit(EVERY_LINE)))).alias("term"))
                  .groupBy("term").agg(F.count("*").alias("n")), "term-lines")
    counted = seen.filter(F.col("term") == EVERY_LINE).first()
    total = counted.n if counted else 0
    idf = lambda n: F.log((F.lit(1.0) + total) / (F.lit(1.0) + n)) + 1.0
    weight = (of_template.select("term").distinct().join(seen, "term", "left")
              .select("term", idf(F.coalesce("n", F.lit(0)).cast("double")).alias("idf")))
    weight = landed(weight, "term-weights")  # one row per template term
    index = of_template.join(F.broadcast(weight), "term")
    norms = index.groupBy("template", "license").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("norm"))
    anchors = F.array(*[F.lit(t) for t in heaviest_terms(index, percent)])
    likely = files.filter(F.arrays_overlap(terms_of(F.coalesce("text", F.lit(""))), anchors))
    # unknown terms weigh at least as much as any known one: cosine^2 <= known / all terms
    close = units(likely, words).filter(F.arrays_overlap("known", anchors)) \
        .filter(F.size("known") * 10000 >= F.col("n_terms").cast("long") * percent * percent)
    key = ["path", "first", "width"]
    weighed = close.select(*key, "n_terms", F.size("known").alias("n_known"), F.explode("known").alias("term")) \
        .join(F.broadcast(weight), "term")
    norm = weighed.groupBy(*key, "n_terms", "n_known").agg(
        F.sum(F.col("idf") * F.col("idf")).alias("known_sq"), F.collect_list(F.struct("term", "idf")).alias("known"))
    oov = idf(F.lit(0.0)) * idf(F.lit(0.0))
    scored = (norm.withColumn("unit_sq", F.col("known_sq") + (F.col("n_terms") - F.col("n_known")) * oov)
              .select(*key, "unit_sq", F.explode("known").alias("k"))
              .select(*key, "unit_sq", F.col("k.term").alias("term"), F.col("k.idf").alias("w"))
              .join(F.broadcast(index.select("template", "term")), "term")
              .groupBy(*key, "unit_sq", "template").agg(F.sum(F.col("w") * F.col("w")).alias("dot"))
              .join(F.broadcast(norms), "template")
              .withColumn("score", F.round(F.col("dot") / (F.sqrt("unit_sq") * F.col("norm")), 6))
              .filter(F.col("score") >= percent / 100))
    order = F.struct(-F.col("score"), "first", "width", "license")
    return scored.groupBy("path").agg(F.min_by("license", order).alias("license"), F.max("score").alias("score"))


def heaviest_terms(index: DataFrame, percent: int) -> list[str]:
    """Terms of which any unit that reaches ``percent`` % with a template holds at least one.

    Of each template the heaviest terms, until the others are less than ``percent``^2 of its squared
    norm: the cosine of a unit without them is at most the root of that share.  (The rounding of
    scores is allowed for.)  As many rows as the templates have terms reach the driver.
    """
    by_template: dict[int, list] = {}
    for r in index.select("template", "term", "idf").collect():
        by_template.setdefault(r.template, []).append((-r.idf * r.idf, r.term))
    out = set()
    for terms in by_template.values():
        left = whole = -sum(w for w, _ in terms)
        for w, term in sorted(terms):
            if left < (percent / 100 - 1e-6) ** 2 * whole:
                break
            out.add(term)
            left += w
    return sorted(out)


def parent(path: Column) -> Column:
    """Directory of a path; the root is the empty text."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(files: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = 80,
                  path_col: str = "path", text_col: str = "text") -> DataFrame:
    """``(path, license, score, origin, license_dir)``, a row for every distinct path of ``files``.

    ``templates`` are pairs of a licence and a text that names it; a licence may have several.

    ``origin`` is ``own`` (a notice in the file), ``inherited`` (from ``license_dir``, the
    nearest ancestor directory that holds a licence file with a notice; of several the best
    score wins, then the smallest path) or NULL with the other columns when there is none.
    Licence files have a base name like LICENSE, COPYING or NOTICE.  Rows without a path are
    left out; rows that repeat a path are one file whose units lie within single rows.  NULL texts have
    no lines.  Empty input gives an empty result; other columns are ignored.
    """
    base = files.filter(F.col(path_col).isNotNull()).select(F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    own = landed(notices(base, templates or TEMPLATES, percent), "notices")
    paths = base.select("path").distinct().withColumn("dir", parent(F.col("path")))
    licensed = (own.filter(name_of(F.col("path")).rlike(LICENSE_FILE)).withColumn("dir", parent(F.col("path")))
                .groupBy("dir").agg(F.min_by("license", F.struct(-F.col("score"), "path")).alias("dir_license"),
                                    F.max("score").alias("dir_score")))
    licensed = landed(licensed, "licensed-directories")
    # ancestors of each distinct directory, itself included, deepest first
    parts = F.split("dir", "/")
    ancestors = (paths.select("dir").distinct()
                 .select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"))
                 .select("dir", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("ancestor")).distinct())
    nearest = (ancestors.join(licensed.withColumnRenamed("dir", "ancestor"), "ancestor")
               .groupBy("dir").agg(F.max_by(F.struct("dir_license", "dir_score", "ancestor"), "depth").alias("from_dir")))
    nearest = landed(nearest, "nearest-licences")
    has = F.col("license").isNotNull()
    return (paths.join(own, "path", "left").join(nearest, "dir", "left")
            .select("path", F.coalesce("license", "from_dir.dir_license").alias("license"),
                    F.coalesce("score", "from_dir.dir_score").alias("score"),
                    F.when(has, "own").when(F.col("from_dir").isNotNull(), "inherited").alias("origin"),
                    F.when(~has, F.col("from_dir.ancestor")).alias("license_dir")))
