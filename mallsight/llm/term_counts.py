"""Term counts of whole texts, summed inside the tasks before any shuffle.

A *term* is a maximal run of ASCII letters and non-ASCII code points; only A-Z are lower-cased.
In UTF-8 every byte of a non-ASCII code point is 0x80 or above, so one byte map (letters to
lower case, those bytes kept, all others to blanks) and ``bytes.split()`` give exactly the terms.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries, and bytes of text behind them, after which a task passes its counts on.
HELD_TERMS, HELD_BYTES = 250_000, 64 << 20
#: Bytes of text after which a task looks at what it holds.
LOOK_BYTES = 1 << 20


def term_bytes() -> bytes:
    """The byte map: A-Z to a-z, a-z and 0x80-0xFF kept, all other bytes to a blank."""
    return bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _counter(by: list[str]):
    table = term_bytes()

    def flush(held: dict) -> pa.RecordBatch:
        keys, terms, n, docs = [], [], [], []
        for key, (all_of, in_docs) in held.items():
            keys += [key] * len(all_of)
            terms += all_of.keys()
            n += all_of.values()
            docs += map(in_docs.__getitem__, all_of)
        cols = [pa.array([k[i] for k in keys], pa.string()) for i in range(len(by))]
        cols += [pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
        held.clear()
        return pa.RecordBatch.from_arrays(cols, names=[*by, "term", "n", "docs"])

    def run(batches):
        held: dict = {}
        size = since = 0
        for batch in batches:
            groups = list(zip(*(batch.column(i).to_pylist() for i in range(len(by))))) or [()] * batch.num_rows
            for key, text in zip(groups, batch.column(len(by)).cast(pa.binary())):
                raw = text.as_py()
                terms = raw.translate(table).split()
                all_of, in_docs = held.get(key) or held.setdefault(key, (Counter(), Counter()))
                all_of.update(terms)
                in_docs.update(set(terms))
                size += len(raw)
                since += len(raw)
                if since >= LOOK_BYTES:
                    since = 0
                    if size >= HELD_BYTES or sum(len(x) for x, _ in held.values()) >= HELD_TERMS:
                        yield flush(held)
                        size = 0
        if held:
            yield flush(held)
    return run


def term_counts(docs: DataFrame, by: tuple[str, ...] = (), text_col: str = "text") -> DataFrame:
    """``(*by, term, n, docs)``: occurrences of a term and rows that hold it, for each value of ``by``.

    ``by`` names text columns; NULLs in them and in the text count as empty texts.  Rows without
    any term add nothing.
    """
    cols = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in (*by, text_col)]
    schema = ", ".join([f"`{c}` string" for c in by] + ["term string", "n long", "docs long"])
    partial = docs.select(*cols).mapInArrow(_counter(list(by)), schema)
    return partial.groupBy(*by, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
