"""Secret scan: fixed patterns, and strings that stay novel to a primed compressor.

Base spans come from three patterns.  Beyond them, a string that stands close behind a sensitive
word is a candidate.  Its *marginal size* is what it adds to a zstandard frame primed with the
corpus' identifiers and the text around the candidate: names, paths and prose are made of pieces
and letters the compressor has seen, keys are not.  A candidate that costs a whole byte for
every byte is reported as ``novel``.

The identifier dictionary is counted over all texts (letter runs, lower-cased, in two documents
at least); its size is a parameter, as zstandard dictionaries have one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import landed
from .term_counts import term_counts

#: The base patterns, their shortest accepted lengths, and the order of kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "novel")
#: Words behind which a string may be a credential; they include those of ``ASSIGN``.
SENSITIVE = r"pass(?:word|wd|phrase|code)|pwd|secret|token|api[_ -]?key|(?:access|private|signing|encryption)[_ -]?key|" \
            r"credential|auth|bearer|signature|client[_ -]?id|connection[_ -]?string|webhook"
#: Characters of a candidate; it starts at none but a first one and holds a letter.
CANDIDATE = r"(?<![A-Za-z0-9+/_~-])[A-Za-z0-9+/_~-][A-Za-z0-9+/_~.=-]*"
LETTER = re.compile("[A-Za-z]")
#: Code points behind a sensitive word within which a candidate starts, its shortest length, and
#: the code points before and after it that prime the compressor.
REACH, LEAST, AROUND = 64, 16, 2048
#: Marginal bytes for each byte of a candidate from which it is novel.
NOVEL = 1.0
#: Compression level: the fastest that still finds the primed pieces.
LEVEL = 3
DICTIONARY_BYTES, DICTIONARY_WORDS = 64 << 10, 16_384

SPAN = "kind: string, start: int, end: int, secret: string, novelty: double"


def identifier_dictionary(docs: DataFrame, text_col: str = "text", max_bytes: int = DICTIONARY_BYTES,
                          max_words: int = DICTIONARY_WORDS) -> bytes:
    """Most widespread letter runs (4 to 32 bytes, two rows at least), the commonest last.

    Counted over all rows; only the ``max_words`` first of them (ties: smaller term) reach the driver.
    """
    counted = term_counts(docs, (), text_col)
    size = F.octet_length("term")
    words = (counted.filter((F.col("docs") >= 2) & (size >= 4) & (size <= 32))
             .orderBy(F.col("docs").desc(), "term").limit(max_words).select("term"))
    kept, room = [], max_bytes
    for row in landed(words, "identifiers").collect():
        word = row.term.encode()
        room -= len(word) + 1
        if room < 0:
            break
        kept.append(word)
    return b" ".join(reversed(kept))


def marginal_bytes(candidate: bytes, known: bytes) -> int:
    """Bytes that ``candidate`` adds to a frame primed with ``known``.

    Both stand in one block, so pieces of ``known`` become matches and other letters take the code
    lengths learned from it."""
    frame = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    return len(frame.compress(known + candidate)) - len(frame.compress(known))


class Scanner:
    """Finds the spans of one text; holds the compiled patterns and the identifier dictionary."""

    def __init__(self, identifiers: bytes):
        self.identifiers = identifiers
        self.assign = re.compile(ASSIGN, re.I | re.A)
        self.access, self.hex = re.compile(ACCESS), re.compile(HEX)
        self.sensitive = re.compile(SENSITIVE, re.I | re.A)
        self.candidate = re.compile(CANDIDATE)

    def base(self, text: str, sensitive: list[int]) -> list[tuple]:
        found = []
        if sensitive:  # every word of the assign pattern is a sensitive one
            found += [("assign", m.start(), m.end(), m.group(2)) for m in self.assign.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
        if "AKIA" in text:
            found += [("access", m.start(), m.end(), m.group()) for m in self.access.finditer(text) if len(m.group()) >= ACCESS_LEAST]
        return found + [("hex", m.start(), m.end(), m.group()) for m in self.hex.finditer(text)]

    def candidates(self, text: str, sensitive: list[int]):
        """Spans of strings that start within reach of a sensitive word on its line."""
        done = 0
        for at in sensitive:
            lo, hi = max(at, done), at + REACH
            line = text.find("\n", at, hi)
            hi = hi if line < 0 else line
            while lo < hi:
                m = self.candidate.search(text, lo, hi)
                if m is None:
                    break
                m = self.candidate.match(text, m.start())
                end = m.start() + len(m.group().rstrip("."))
                if end - m.start() >= LEAST and LETTER.search(text, m.start(), end):
                    yield m.start(), end
                lo = m.end()
            done = max(done, lo, hi)

    def novelty(self, text: str, start: int, end: int) -> float:
        """Marginal bytes per byte against the identifiers and the text around, other copies of the string cut out."""
        candidate = text[start:end]
        around = text[max(0, start - AROUND):start].replace(candidate, "") + text[end:end + AROUND].replace(candidate, "")
        raw = candidate.encode()
        return marginal_bytes(raw, self.identifiers + around.encode()) / len(raw)

    def spans(self, text: str) -> list[tuple]:
        sensitive = [m.end() for m in self.sensitive.finditer(text)]
        found = [(*s, None) for s in self.base(text, sensitive)]
        starts = sorted(s[1] for s in found)
        ends = list(accumulate((s[2] for s in sorted(found, key=lambda s: s[1])), max))  # of all spans that start so far
        for start, end in self.candidates(text, sensitive):
            before = bisect_left(starts, end)
            if not before or ends[before - 1] <= start:
                novelty = self.novelty(text, start, end)
                if novelty >= NOVEL:
                    found.append(("novel", start, end, text[start:end], novelty))
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _scan(identifiers: bytes):
    def run(batches):
        scanner = Scanner(identifiers)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("secret", pa.string()), ("novelty", pa.float64())]))
        names = ("kind", "start", "end", "secret", "novelty")
        for batch in batches:
            spans = [[dict(zip(names, s)) for s in scanner.spans(text.as_py() or "")] for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])
    return run


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)``, one row for each row of ``docs``: ``spans`` lists kind, start, end, secret, novelty.

    Positions count code points, ends are exclusive; a span of kind ``assign`` covers the whole
    match, its secret is the assigned value.  Spans run by start, then kind (assign, access, hex,
    novel).  Matches of one kind do not overlap, those of two kinds may; ``novel`` spans touch no
    base span.  NULL and empty texts have no spans; NULL or repeated ids are kept as they are;
    other columns are ignored; an empty table gives no rows.  Texts are read whole.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    identifiers = identifier_dictionary(base)
    id_type = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(_scan(identifiers), f"doc_id {id_type}, spans array<struct<{SPAN}>>")
