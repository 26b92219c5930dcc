"""Flattening raw order documents to canonical order lines (PRJ1-PRJ9, PRJ19).

Every flattener is a ``select`` over ``posexplode``/``explode_outer`` of the
nested arrays plus built-in expressions; nothing leaves the JVM.  Flatteners
that can meet dirty input return ``(lines, quarantine)``: the quarantine keeps
whole documents with a reason, never half an order (D14).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions.money import first_nonzero
from ..functions.time import ntz, parse_compact_time, parse_offset_time, with_time_parts
from ..schema import ORDER_LINE_COLUMNS, Y_ITEM, Y_ORDER_INFO
from ..sources.adapters import CANCELLED
from .grain import keep_first

# Labels of the marketplaces and their default store names.
MALL_R, MALL_Y, MALL_M = "R", "Y", "M"
DEFAULT_STORE_R = "楽天"
STORE_Y = "Yahoo"
# Positions of a line inside a document: package index x LINE_STRIDE + item index
# (array positions are 32-bit, so the two never overlap).
LINE_STRIDE = 2**31
# Positions of a node: status set, page, place on the page.
PAGE_STRIDE, SET_STRIDE = 2**31, 2**56


def _lit_long(v) -> Column:
    return F.lit(v).cast("bigint")


def _canonical(df: DataFrame) -> DataFrame:
    return with_time_parts(df).select(*ORDER_LINE_COLUMNS)


# ---------------------------------------------------------------------------
# R: order -> packages -> items
# ---------------------------------------------------------------------------
def flatten_r(docs: DataFrame, default_store: str = DEFAULT_STORE_R, mall: str = MALL_R) -> DataFrame:
    """PRJ1-PRJ5 + FLT1: one row per item of every non-cancelled order.

    Orders without packages or items yield no row (D15).  Missing fields take
    the defaults ''/0/1 (PRJ2); an empty or missing item number becomes ''.
    """
    cols = set(docs.columns)
    # Arrival order: the landed sequence when present, else the read order
    # (monotonically increasing within one read of the files).
    read_order = F.monotonically_increasing_id()
    seq = F.coalesce(F.col("_ingest_seq"), read_order) if "_ingest_seq" in cols else read_order
    store = F.coalesce(F.col("_store_name"), F.lit(default_store)) if "_store_name" in cols \
        else F.lit(default_store)
    status = F.coalesce(F.col("orderProgress"), F.lit(0))
    goods = F.coalesce(F.col("goodsPrice"), _lit_long(0))
    coupon = F.coalesce(F.col("couponAllTotalPrice"), _lit_long(0))
    orders = docs.filter(status != CANCELLED).select(
        F.coalesce(F.col("orderNumber"), F.lit("")).alias("order_number"),
        parse_offset_time("orderDatetime").alias("order_datetime"),
        goods.alias("total_price"), coupon.alias("coupon_used"),
        (goods - coupon).alias("order_net_sales"),
        F.coalesce(F.col("pointAmount"), _lit_long(0)).alias("point_used"),
        F.coalesce(F.col("settlementMethodName"), F.lit("")).alias("payment_method"),
        status.alias("status"), store.alias("source"), F.lit(mall).alias("mall"),
        seq.alias("ingest_seq"),
        F.posexplode("PackageModelList").alias("pkg_pos", "pkg"))
    items = orders.select("*", F.posexplode("pkg.ItemModelList").alias("item_pos", "item"))
    price = F.coalesce(F.col("item.price"), _lit_long(0))
    units = F.coalesce(F.col("item.units"), _lit_long(1))
    lines = items.select(
        "order_number", "order_datetime",
        F.coalesce(F.col("item.itemId"), F.lit("")).alias("item_id"),
        F.coalesce(F.col("item.itemName"), F.lit("")).alias("item_name"),
        F.coalesce(F.col("item.itemNumber"), F.lit("")).alias("item_number"),
        price.alias("unit_price"), units.alias("quantity"), (price * units).alias("subtotal"),
        "point_used", "coupon_used",
        F.coalesce(F.col("pkg.postagePrice"), _lit_long(0)).alias("shipping_charge"),
        "total_price", "order_net_sales", "payment_method", "status", "source", "mall",
        (F.col("pkg_pos").cast("bigint") * LINE_STRIDE + F.col("item_pos")).alias("line_seq"),
        "ingest_seq")
    return _canonical(lines)


# ---------------------------------------------------------------------------
# Y: XML order detail responses
# ---------------------------------------------------------------------------
# Name of the root element; a declaration, comments and a document type may come first.
_ROOT_TAG = (r"(?s)^\s*(?:<\?xml[^>]*\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*"
             r"<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)")
_XML_OPTS = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
_RESULT = T.StructType([T.StructField("OrderInfo", Y_ORDER_INFO)])
# The places of an order below any root element, in the order they are looked up.
_ENVELOPE = T.StructType([T.StructField("ResultSet", T.StructType([T.StructField("Result", _RESULT)])),
                          T.StructField("Result", _RESULT), T.StructField("OrderInfo", Y_ORDER_INFO)])
_NO_MARKUP = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
_ERROR = r"<(?:[\w.-]+:)?Error[\s/>]"
_ERROR_MESSAGE = r"(?s)<(?:[\w.-]+:)?Error(?:\s[^>]*)?>.*?<(?:[\w.-]+:)?Message(?:\s[^>]*)?>([^<]*)<"
# Fixed value: message of an error element without one.
UNKNOWN_ERROR = "Unknown error"


def y_order_info(responses: DataFrame, value: str = "value") -> DataFrame:
    """SRC7-SRC9: ``responses`` with ``o`` (OrderInfo struct) and ``error`` (message) of their XML.

    Below a root of any name the order is looked up at ResultSet.Result.OrderInfo,
    Result.OrderInfo and OrderInfo; a root OrderInfo is the order itself.  Each text is
    parsed once, whichever place holds the order.  An ``Error`` element at any depth, with or
    without a namespace, yields its message.  Malformed XML gives a NULL order.
    """
    text = F.col(value)
    root = F.regexp_extract(text, _ROOT_TAG, 1)
    places = responses.select("*", *parse_once(
        F.when(root != "OrderInfo", F.from_xml(text, _ENVELOPE, _XML_OPTS)).alias("_env"),
        F.when(root == "OrderInfo", F.from_xml(text, Y_ORDER_INFO, _XML_OPTS)).alias("_order"),
        F.when(text.contains("Error"), _error_message(text)).alias("error")))
    env = F.col("_env")
    info = F.coalesce(env.getField("ResultSet").getField("Result").getField("OrderInfo"),
                      env.getField("Result").getField("OrderInfo"), env.getField("OrderInfo"), F.col("_order"))
    return places.select(*responses.columns, "error", *parse_once(info.alias("o")))


def _error_message(value: Column) -> Column:
    text = F.when(value.contains("<!"), F.regexp_replace(value, _NO_MARKUP, "")).otherwise(value)
    message = F.nullif(F.regexp_extract(text, _ERROR_MESSAGE, 1), F.lit(""))
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        message = F.replace(message, F.lit(entity), F.lit(char))
    return F.when(text.rlike(_ERROR), F.coalesce(message, F.lit(UNKNOWN_ERROR)))


def parse_once(*cols: Column) -> list[Column]:
    """Evaluate costly parse expressions exactly once per row.

    The columns come out of a one-element ``inline`` generator, so filters
    written on them stay above it; a plain projection would let predicate
    pushdown copy the parser into every filter that mentions a parsed field.
    """
    return [F.inline(F.array(F.struct(*cols)))]


def _strict_int(c: Column) -> tuple[Column, Column]:
    """Python ``int(x or 0)`` on text: (value, is_bad).  '' and NULL -> 0."""
    txt = F.trim(c)
    empty = F.coalesce(txt, F.lit("")) == ""
    val = txt.try_cast("bigint")
    return F.when(empty, _lit_long(0)).otherwise(val), (~empty) & val.isNull()


def flatten_y(responses: DataFrame, fallback_ts=None, store: str = STORE_Y,
              mall: str = MALL_Y) -> tuple[DataFrame, DataFrame]:
    """PRJ6-PRJ9: XML responses (``value``, ``ingest_seq``) -> (lines, quarantine).

    * total: Pay.TotalPrice, else Detail.TotalPrice, else top-level TotalPrice (first non-zero)
    * net = total - UsePoint - GiftCardDiscount
    * item: Quantity (empty/absent -> 1), UnitPrice (-> 0), SubTotal: absent -> price x qty,
      empty element -> 0; an order without items gets one synthetic line (qty 1, total)
    * bad time -> ``fallback_ts`` (default NULL: quarantine); a non-numeric amount
      quarantines the whole order.
    """
    orders = _y_orders(responses, fallback_ts)
    # quarantine: whole documents with a reason, never half an order (D14)
    quarantine = orders.filter(F.col("reason").isNotNull()).select(
        "ingest_seq", "order_number", "reason", "error", "value")
    return _canonical(_y_lines(orders.filter(F.col("reason").isNull()), store, mall)), quarantine


def flatten_y_checked(responses: DataFrame, fallback_ts=None, store: str = STORE_Y, mall: str = MALL_Y) -> DataFrame:
    """Both parts of ``flatten_y`` from one parse of each response: the lines with ``reason`` and ``error`` NULL,
    and for each document of the quarantine one row with its reason and error, whose line columns have no meaning."""
    orders = _y_orders(responses, fallback_ts)
    orders = orders.withColumn("items", F.when(F.col("reason").isNull(), F.col("items"))) \
        .withColumn("no_items", F.col("no_items") | F.col("reason").isNotNull())
    lines = _y_lines(orders, store, mall, keep=("reason", "error"))
    return with_time_parts(lines).select(*ORDER_LINE_COLUMNS, "reason", "error")


def _y_orders(responses: DataFrame, fallback_ts) -> DataFrame:
    """One row a response: its order's values and items, and the ``reason`` to set it aside."""
    if "ingest_seq" not in responses.columns:
        responses = responses.withColumn("ingest_seq", F.lit(None).cast("bigint"))
    # arrival order: the landed sequence when present, else the read order
    responses = responses.withColumn("ingest_seq", F.coalesce("ingest_seq", F.monotonically_increasing_id()))
    parsed = y_order_info(responses.select("value", "ingest_seq"))
    o = F.col("o")
    texts = [o.getField("Pay").getField("TotalPrice"), o.getField("Detail").getField("TotalPrice"), o.getField("TotalPrice"),
             o.getField("Pay").getField("UsePoint"), o.getField("Pay").getField("GiftCardDiscount")]
    # an empty <Item/> is no item
    some = F.filter(o.getField("Item"), lambda x: F.coalesce(
        *[x.getField(f) for f in Y_ITEM.fieldNames()]).isNotNull())
    # each text is read once, by one expression over an array: written out, the generated code is too large to be compiled
    amount = lambda c: F.struct(*[v.alias(n) for v, n in zip(_strict_int(c), ("value", "bad"))])
    parsed = parsed.select("*", *parse_once(F.transform(F.array(*texts), amount).alias("amounts"), some.alias("some"),
                                            F.transform(F.array(o.getField("OrderTime")), parse_compact_time).alias("times")))
    pay_total, det_total, top_total, point, gift = (F.col("amounts")[i]["value"] for i in range(len(texts)))
    total = first_nonzero(pay_total, det_total, top_total)
    ts = F.col("times")[0]
    if fallback_ts is not None:
        ts = F.coalesce(ts, ntz(fallback_ts))
    items = F.col("some")
    n_items = F.coalesce(F.size(items), F.lit(0))

    def bad_item(x):
        return (_strict_int(x.getField("Quantity"))[1] | _strict_int(x.getField("UnitPrice"))[1]
                | _strict_int(x.getField("SubTotal"))[1])

    bad = F.exists("amounts", lambda a: a["bad"]) | F.coalesce(F.exists(items, bad_item), F.lit(False))
    reason = (F.when(F.col("error").isNotNull(), F.lit("error_response"))
               .when(o.isNull() | o.getField("OrderId").isNull(), F.lit("unparsed"))
               .when(ts.isNull(), F.lit("bad_time"))
               .when(bad, F.lit("bad_amount")))
    return parsed.select(
        "value", "ingest_seq", "error", reason.alias("reason"),
        F.coalesce(o.getField("OrderId"), F.lit("")).alias("order_number"),
        ts.alias("order_datetime"),
        total.alias("total_price"), point.alias("point_used"), gift.alias("coupon_used"),
        (total - point - gift).alias("order_net_sales"),
        F.when(n_items > 0, items).alias("items"), (n_items == 0).alias("no_items"))


def _y_lines(orders: DataFrame, store: str, mall: str, keep=()) -> DataFrame:
    """A row for each item of ``_y_orders``, or one for an order without items; ``keep`` are further columns."""
    exploded = (orders.select("*", F.posexplode_outer("items").alias("item_pos", "item"))
                .filter(F.col("no_items") | F.col("item").isNotNull()))   # null items are skipped
    it = F.col("item")
    # ``int(text or 1)``: empty or missing text -> 1; the text "0" stays 0
    q_txt = F.trim(it.getField("Quantity"))
    qty = F.when(F.coalesce(q_txt, F.lit("")) == "", _lit_long(1)).otherwise(q_txt.try_cast("bigint"))
    unit = _strict_int(it.getField("UnitPrice"))[0]
    sub = F.when(it.getField("SubTotal").isNull(), unit * qty).otherwise(
        _strict_int(it.getField("SubTotal"))[0])
    synthetic = F.col("no_items")
    return exploded.select(
        "order_number", "order_datetime",
        F.when(synthetic, F.lit(None).cast("string")).otherwise(it.getField("ItemId")).alias("item_id"),
        F.when(synthetic, F.lit("")).otherwise(F.coalesce(it.getField("Title"), F.lit(""))).alias("item_name"),
        F.lit("").alias("item_number"),
        F.when(synthetic, F.col("total_price")).otherwise(unit).alias("unit_price"),
        F.when(synthetic, _lit_long(1)).otherwise(qty).alias("quantity"),
        F.when(synthetic, F.col("total_price")).otherwise(sub).alias("subtotal"),
        "point_used", "coupon_used", _lit_long(0).alias("shipping_charge"),
        "total_price", "order_net_sales", F.lit("").alias("payment_method"),
        F.lit(None).cast("int").alias("status"), F.lit(store).alias("source"), F.lit(mall).alias("mall"),
        F.coalesce(F.col("item_pos"), F.lit(0)).cast("bigint").alias("line_seq"), "ingest_seq", *keep)


# ---------------------------------------------------------------------------
# M: GraphQL connection pages
# ---------------------------------------------------------------------------
# Message of a page that is no GraphQL response.
UNREADABLE_PAGE = "unreadable page"


def m_nodes_from_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC11: pages (``value`` JSON, ``set_seq``, ``page``) -> (nodes, failed pages).

    A page with an ``errors`` array is a failed request, and so is one without
    ``data`` (truncated or not JSON); their nodes are not used.
    """
    from ..schema import M_PAGE
    p = pages.select("set_seq", "page", *parse_once(F.from_json("value", M_PAGE).alias("p")))
    good = F.col("p.errors").isNull() & F.col("p.data").isNotNull()
    failed = p.filter(~good).select("set_seq", "page", F.when(
        F.col("p.errors").isNull(), F.lit(UNREADABLE_PAGE)).otherwise(F.get(F.col("p.errors"), F.lit(0)).getField("message"))
        .alias("message"))
    nodes = (p.filter(good)
              .select("set_seq", "page", F.posexplode("p.data.orders.edges").alias("pos", "edge"))
              .select("set_seq", "page", "pos", F.col("edge.node").alias("node")))
    return nodes, failed


def m_order_time(node: Column) -> Column:
    """FLT6/D7: createdAt (or paidAt when createdAt is missing) as JST wall clock.

    A present but unparseable createdAt does not fall back to paidAt.
    """
    text = F.coalesce(F.nullif(node.getField("createdAt"), F.lit("")), node.getField("paidAt"))
    return parse_offset_time(text)


def flatten_m(nodes: DataFrame, start=None, end=None, store: str = MALL_M,
              mall: str = MALL_M) -> DataFrame:
    """SRC12 + SET4 + WIN3 + FLT11 + PRJ19: nodes of all status sets -> order lines.

    * nodes outside [start, end] are dropped; undated or unparseable ones are kept
    * empty ids are dropped; an id seen in several status sets keeps the first
      (sets are collected COMPLETED, SHIPPED, WAITING_FOR_SHIPMENT)
    * one line per order: quantity 1, product price, gross = net = payment total
    """
    n = nodes.select("set_seq", "page", "pos", F.col("node.*"))
    n = n.select("*", *parse_once(
        m_order_time(F.struct(*[F.col(c) for c in ("createdAt", "paidAt")])).alias("order_datetime")))
    if start is not None or end is not None:
        t = F.col("order_datetime")
        keep = t.isNull()
        inside = F.lit(True)
        if start is not None:
            inside = inside & (t >= ntz(start))
        if end is not None:
            inside = inside & (t <= ntz(end))
        n = n.filter(keep | inside)
    n = n.filter(F.nullif(F.col("id"), F.lit("")).isNotNull())
    first = keep_first(n, ("id",), ("set_seq", "page", "pos"),
                       columns=["id", "orderNumber", "status", "order_datetime", "product", "payment",
                                "set_seq", "page", "pos"])
    price = F.coalesce(F.col("product.price"), _lit_long(0))
    total = F.coalesce(F.col("payment.totalPrice"), _lit_long(0))
    page = F.coalesce(F.col("page"), F.lit(0)).cast("bigint")
    lines = first.select(
        F.coalesce(F.col("orderNumber"), F.col("id")).alias("order_number"), "order_datetime",
        F.col("product.id").alias("item_id"), F.coalesce(F.col("product.name"), F.lit("")).alias("item_name"),
        F.lit("").alias("item_number"), price.alias("unit_price"), _lit_long(1).alias("quantity"),
        price.alias("subtotal"), _lit_long(0).alias("point_used"), _lit_long(0).alias("coupon_used"),
        F.coalesce(F.col("payment.shippingFee"), _lit_long(0)).alias("shipping_charge"),
        total.alias("total_price"), total.alias("order_net_sales"), F.lit("").alias("payment_method"),
        F.lit(None).cast("int").alias("status"), F.lit(store).alias("source"), F.lit(mall).alias("mall"),
        _lit_long(0).alias("line_seq"),
        (F.coalesce(F.col("set_seq"), F.lit(0)).cast("bigint") * SET_STRIDE
         + F.when(page < SET_STRIDE // PAGE_STRIDE, page).otherwise(F.raise_error(F.lit("page number out of range")).cast("bigint"))
         * PAGE_STRIDE + F.col("pos")).alias("ingest_seq"))
    return _canonical(lines)


# ---------------------------------------------------------------------------
# Y: order-list pages
# ---------------------------------------------------------------------------
def y_list_ids(pages: DataFrame) -> DataFrame:
    """SRC6 + FLT4 + FLT11: list pages -> (order_id, order_time, status), empty ids dropped.

    The list sits at ``Result/Search`` or at ``Search``; one order or many.
    """
    from ..schema import Y_LIST_DOC
    search = Y_LIST_DOC["Search"].dataType
    root = F.regexp_extract(F.col("value"), _ROOT_TAG, 1)
    s = (F.when(root == "Result", F.from_xml("value", T.StructType([T.StructField("Search", search)]),
                                             _XML_OPTS).getField("Search"))
          .when(root == "Search", F.from_xml("value", search, _XML_OPTS)))
    parsed = pages.select(*parse_once(s.alias("s")))
    orders = parsed.select(F.explode("s.OrderInfo").alias("o")).select(
        F.col("o.OrderId").alias("order_id"), parse_compact_time("o.OrderTime").alias("order_time"),
        F.col("o.OrderStatus").alias("status"))
    return orders.filter(F.nullif(F.col("order_id"), F.lit("")).isNotNull())
