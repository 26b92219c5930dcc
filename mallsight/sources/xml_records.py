"""SRC8: XML of any shape as path / value rows.

``from_xml`` needs a schema, and one inferred over documents that disagree (an element empty
here and nested there, one copy here and three there) loses values.  So each document is read by
the standard library's parser inside Arrow batches, without any schema; everything after that is
DataFrame work on the rows.
"""

from __future__ import annotations

import sys
import xml.etree.ElementTree as ET
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.flatten import UNKNOWN_ERROR

# tasks need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows after which a task hands on a batch, at most one document more.
BATCH_ROWS = 20_000
_ROWS = "ingest_seq long, pos long, path string, tag_path string, value string, reason string, error string, raw string"


def _name(el) -> str:
    """Tag without its namespace."""
    return el.tag.rpartition("}")[2]


def _leaves(root):
    """``(path, tag_path, text)`` of every element without children, in document order."""
    todo = [(root, "", "")]
    while todo:
        el, path, tags = todo.pop()
        if len(el) == 0:
            if el is not root:
                yield path, tags, el.text
            continue
        copies = Counter(map(_name, el))
        met: Counter = Counter()
        below = []
        for child in el:
            tag = _name(child)
            at = f"{tag}[{met[tag]}]" if copies[tag] > 1 else tag
            met[tag] += 1
            below.append((child, f"{path}/{at}" if path else at, f"{tags}/{tag}" if tags else tag))
        todo.extend(reversed(below))


def _error_of(root) -> str | None:
    """Message of the first error element at any depth, None without one."""
    for el in root.iter():
        if _name(el) == "Error" and el is not root:
            return next((c.text for c in el if _name(c) == "Message"), None) or UNKNOWN_ERROR
    return None


def _read(batches):
    schema = pa.schema([(c, pa.int64() if t == "long" else pa.string()) for c, t in (f.split() for f in _ROWS.split(", "))])
    rows: list[tuple] = []

    def out():
        cols = list(zip(*rows)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    for batch in batches:
        for seq, text in zip(batch.column("ingest_seq"), batch.column("value")):
            seq, text = seq.as_py(), text.as_py()
            try:
                root = ET.fromstring(text or "")
            except (ET.ParseError, ValueError) as e:
                rows.append((seq, None, None, None, None, "unparsed", str(e), text))
            else:
                error = _error_of(root)
                if error is None:
                    rows.extend((seq, i, *leaf, None, None, None) for i, leaf in enumerate(_leaves(root)))
                else:
                    rows.append((seq, None, None, None, None, "error_response", error, text))
            if len(rows) >= BATCH_ROWS:
                yield out()
                rows.clear()
    yield out()


def xml_rows(documents: DataFrame, value_col: str = "value", seq_col: str = "ingest_seq") -> DataFrame:
    """Rows of all documents: leaves and set-aside documents together; write them once to use both parts.

    One document is read whole in one task; its rows leave in batches of about ``BATCH_ROWS``.
    """
    cols = documents.select(F.col(seq_col).cast("long").alias("ingest_seq"), F.col(value_col).cast("string").alias("value"))
    return cols.mapInArrow(_read, _ROWS)


def xml_paths(rows: DataFrame) -> DataFrame:
    """SRC8: ``(ingest_seq, pos, path, tag_path, value)``, one row for each element without children.

    ``path`` leads from below the root to the element by tags without namespaces, joined by ``/``; a
    tag that stands several times under one parent is a list there and carries its position
    from 0 (``Item[1]/Title``), a tag that stands once is not (``Item/Title``).  ``tag_path`` is the path
    without positions, equal for both.  ``value`` is the text as it stands, NULL for an empty
    element; attributes and text beside child elements are left out.  ``pos`` numbers the rows of a
    document in its order.  A root without child elements gives no row.
    """
    return rows.filter("reason is null").select("ingest_seq", "pos", "path", "tag_path", "value")


def xml_quarantine(rows: DataFrame) -> DataFrame:
    """SRC8 + SRC9: ``(ingest_seq, reason, error, value)`` of the documents that gave no record.

    ``unparsed`` is text that is no well-formed XML (NULL and empty text too), with the parser's
    message; ``error_response`` a document that holds an ``Error`` element below its root, with its
    message.
    """
    return rows.filter("reason is not null").select("ingest_seq", "reason", "error", F.col("raw").alias("value"))


def xml_table(paths: DataFrame, fields: dict[str, str], each: str | None = None) -> DataFrame:
    """Columns from path rows: ``(ingest_seq, [item,] *fields)``, one row a document or a list entry.

    ``fields`` maps column names to tag paths.  With ``each`` (a tag path such as ``Info/Item``) there
    is one row for every element at that path, ``item`` its full path, and the fields are tag paths
    below it; whether a document holds one such element or many makes no difference.  A field a
    record lacks is NULL; of one it holds several times the first counts.  Records without any row give none.
    """
    keys = ["ingest_seq"]
    if each is not None:
        tags = each.split("/")
        # the element's own path: one part of the path for each tag
        head = F.array_join(F.slice(F.split("path", "/"), 1, len(tags)), "/")
        paths = (paths.filter((F.col("tag_path") == each) | F.col("tag_path").startswith(each + "/"))
                 .withColumn("item", head).withColumn("tag_path", F.substr("tag_path", F.lit(len(each) + 2))))
        keys.append("item")
    wanted = paths if each is not None else paths.filter(F.col("tag_path").isin(list(fields.values())))
    return wanted.groupBy(*keys).agg(*[
        F.min_by(F.struct("value"), F.when(F.col("tag_path") == path, F.col("pos"))).getField("value").alias(name)
        for name, path in fields.items()])
