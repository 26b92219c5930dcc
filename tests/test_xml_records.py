"""XML of any shape: paths and values against a plain nested-dict reading, quarantine, tables."""

import xml.etree.ElementTree as ET

from hypothesis import given, settings
from hypothesis import strategies as st

from mallsight.sources import xml_records as X

DOCS = [
    (1, "<a:R xmlns:a='http://x/y' id='7'><a:Item k='1'><T>x &amp; y</T></a:Item><Item><T>z</T><T/></Item>"
        "<N> 5 </N><E></E><!-- c --><D><![CDATA[<q>]]></D></a:R>"),
    (2, "<R><N>1</N></R>"), (3, "<R><N>1</N><N>"), (4, None), (5, ""), (6, "<R/>"), (7, "<R>text</R>"),
    (8, "<R>t1<b>u</b>t2</R>"), (9, "<R><N>007</N><N>null</N><E><Z>1</Z></E></R>"),
    (10, "<R><Item/><Item>abc</Item><Item><T>q</T></Item></R>"), (11, "<R><N>a</N></Q>"),
    (12, "<R><x><y:Error xmlns:y='u'><Code>1</Code><Message>busy</Message></y:Error></x></R>"), (13, "<R><Error/></R>"),
    (14, "<R><a.b><c>1</c></a.b></R>"), (None, "<R><N>no id</N></R>"),
    (2, "<R><N>1</N></R>"),
]


def _rows(spark, docs):
    df = spark.createDataFrame(docs, "ingest_seq long, value string")
    return X.xml_rows(df.selectExpr("ingest_seq", "value", "'x' AS path", "1 AS reason"))


def test_paths_of_differing_documents(spark):
    got = {}
    for r in X.xml_paths(_rows(spark, DOCS)).collect():
        got.setdefault(r.ingest_seq, []).append((r.pos, r.path, r.tag_path, r.value))
    at = {k: [x[1:] for x in sorted(v)] for k, v in got.items()}
    assert at[1] == [("Item[0]/T", "Item/T", "x & y"), ("Item[1]/T[0]", "Item/T", "z"), ("Item[1]/T[1]", "Item/T", None),
                     ("N", "N", " 5 "), ("E", "E", None), ("D", "D", "<q>")]
    assert at[2] == [("N", "N", "1")] * 2                      # a repeated row is read twice
    assert at[8] == [("b", "b", "u")]
    assert at[9] == [("N[0]", "N", "007"), ("N[1]", "N", "null"), ("E/Z", "E/Z", "1")]
    assert at[10] == [("Item[0]", "Item", None), ("Item[1]", "Item", "abc"), ("Item[2]/T", "Item/T", "q")]
    assert at[14] == [("a.b/c", "a.b/c", "1")] and at[None] == [("N", "N", "no id")]
    assert set(at) == {1, 2, 8, 9, 10, 14, None}


def test_quarantine(spark):
    bad = {r.ingest_seq: (r.reason, r.value) for r in X.xml_quarantine(_rows(spark, DOCS)).collect()}
    text = dict(DOCS)
    assert bad == {k: ("unparsed", text[k]) for k in (3, 4, 5, 11)} | {k: ("error_response", text[k]) for k in (12, 13)}
    errors = {r.ingest_seq: r.error for r in X.xml_quarantine(_rows(spark, DOCS)).filter("reason = 'error_response'").collect()}
    assert errors == {12: "busy", 13: "Unknown error"}


def test_empty_table(spark):
    rows = _rows(spark, [(1, "<R/>")]).limit(0)
    assert X.xml_paths(rows).count() == X.xml_quarantine(rows).count() == 0
    assert X.xml_table(X.xml_paths(rows), {"n": "N"}).columns == ["ingest_seq", "n"]


def test_table_of_entries(spark):
    paths = X.xml_paths(_rows(spark, DOCS))
    items = {(r.ingest_seq, r.item): (r.t, r.own) for r in X.xml_table(paths, {"t": "T", "own": ""}, each="Item").collect()}
    assert items == {(1, "Item[0]"): ("x & y", None), (1, "Item[1]"): ("z", None), (10, "Item[0]"): (None, None),
                     (10, "Item[1]"): (None, "abc"), (10, "Item[2]"): ("q", None)}
    whole = {r.ingest_seq: (r.n, r.z) for r in X.xml_table(paths, {"n": "N", "z": "E/Z"}).collect()}
    assert whole == {1: (" 5 ", None), 2: ("1", None), 9: ("007", "1"), None: ("no id", None)}


def test_long_and_deep_documents(spark):
    wide = "<R>" + "".join(f"<N>{i}</N>" for i in range(50_000)) + "</R>"
    deep = "<R>" + "<d>" * 3000 + "x" + "</d>" * 3000 + "</R>"
    rows = X.xml_paths(_rows(spark, [(1, wide), (2, deep), (3, wide)]))
    assert rows.filter("ingest_seq <> 2").selectExpr("count(*)", "count(distinct path)", "sum(cast(value as long))").first() == \
        (100_000, 50_000, 2 * sum(range(50_000)))
    assert rows.filter("ingest_seq = 2").first().path == "/".join(["d"] * 3000)


_TREE = st.recursive(st.sampled_from([None, "v", " w "]), lambda t: st.lists(st.tuples(st.sampled_from("abc"), t), min_size=1, max_size=4), max_leaves=12)


def _xml(tree):
    return "" if tree is None else tree if isinstance(tree, str) else "".join(f"<{k}>{_xml(v)}</{k}>" for k, v in tree)


def _nested(tree):
    """The record a tree stands for: repeated tags as lists."""
    if not isinstance(tree, list):
        return tree
    out = {}
    for k, v in tree:
        out.setdefault(k, []).append(_nested(v))
    return {k: v if len(v) > 1 else v[0] for k, v in out.items()}


def _flat(v, path=""):
    if isinstance(v, dict):
        for k, x in v.items():
            yield from _flat(x, f"{path}/{k}" if path else k)
    elif isinstance(v, list):
        for i, x in enumerate(v):
            yield from _flat(x, f"{path}[{i}]")
    else:
        yield path, v


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), _TREE), min_size=1, max_size=4))
def test_paths_equal_the_nested_record(tree):
    got = sorted((p, v) for p, _, v in X._leaves(ET.fromstring(f"<R>{_xml(tree)}</R>")))
    assert sorted(got, key=repr) == sorted(_flat(_nested(tree)), key=repr)
