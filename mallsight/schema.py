"""Explicit schemas: the canonical order-line table and every raw input shape.

No reader in this package infers a schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# ---------------------------------------------------------------------------
# Canonical order-line table (one row per order line; money in integral yen)
# ---------------------------------------------------------------------------
ORDER_LINE = T.StructType([
    _f("order_number", S),
    _f("order_datetime", T.TimestampNTZType()),   # JST wall clock
    _f("order_date", T.DateType()),
    _f("order_hour", I),
    _f("order_month", S),                          # yyyy-MM
    _f("order_weekday", I),                        # 0 = Monday .. 6 = Sunday
    _f("item_id", S),
    _f("item_name", S),
    _f("item_number", S),
    _f("unit_price", L),
    _f("quantity", L),
    _f("subtotal", L),
    _f("point_used", L),
    _f("coupon_used", L),
    _f("shipping_charge", L),
    _f("total_price", L),
    _f("order_net_sales", L),
    _f("payment_method", S),
    _f("status", I),
    _f("source", S),                               # store
    _f("mall", S),                                 # marketplace
    _f("line_seq", L),                             # position of the line inside its order
    _f("ingest_seq", L),                           # arrival order of the order document
])

ORDER_LINE_COLUMNS = [f.name for f in ORDER_LINE.fields]

# Columns that fix "input order" of lines; the amounts break the ties of lines
# that share document, position and item, so a whole-row pick is determined.
LINE_ORDER = ["ingest_seq", "line_seq", "item_id", "quantity", "unit_price", "shipping_charge"]

# ---------------------------------------------------------------------------
# Marketplace R: nested order document (JSON)
# ---------------------------------------------------------------------------
R_ITEM = T.StructType([
    _f("itemId", S), _f("itemName", S), _f("itemNumber", S),
    _f("price", L), _f("units", L),
])
R_PACKAGE = T.StructType([
    _f("postagePrice", L),
    _f("ItemModelList", T.ArrayType(R_ITEM)),
])
R_ORDER = T.StructType([
    _f("orderNumber", S),
    _f("orderDatetime", S),
    _f("orderProgress", I),
    _f("goodsPrice", L),
    _f("couponAllTotalPrice", L),
    _f("pointAmount", L),
    _f("settlementMethodName", S),
    _f("_store_name", S),
    _f("PackageModelList", T.ArrayType(R_PACKAGE)),
])
# Paged id search response.
R_SEARCH_PAGE = T.StructType([
    _f("orderNumberList", T.ArrayType(S)),
    _f("PaginationResponseModel", T.StructType([_f("totalPages", I)])),
])

# ---------------------------------------------------------------------------
# Marketplace Y: order detail XML.  Amounts are declared as strings so that
# an empty element ('') and an absent one (NULL) stay apart.
# ---------------------------------------------------------------------------
Y_ITEM = T.StructType([
    _f("ItemId", S), _f("Title", S), _f("UnitPrice", S), _f("Quantity", S), _f("SubTotal", S),
])
Y_ORDER_INFO = T.StructType([
    _f("OrderId", S),
    _f("OrderTime", S),
    _f("OrderStatus", S),
    _f("TotalPrice", S),
    _f("Pay", T.StructType([
        _f("TotalPrice", S), _f("UsePoint", S), _f("GiftCardDiscount", S),
        _f("PayCharge", S), _f("ShipCharge", S),
    ])),
    _f("Detail", T.StructType([_f("TotalPrice", S)])),
    _f("Item", T.ArrayType(Y_ITEM)),
])
Y_LIST_ORDER = T.StructType([
    _f("OrderId", S), _f("OrderTime", S), _f("OrderStatus", S), _f("TotalPrice", S),
])
Y_LIST_DOC = T.StructType([
    _f("Result", T.StructType([_f("Search", T.StructType([
        _f("TotalCount", S), _f("OrderInfo", T.ArrayType(Y_LIST_ORDER))]))])),
    _f("Search", T.StructType([
        _f("TotalCount", S), _f("OrderInfo", T.ArrayType(Y_LIST_ORDER))])),
    _f("Error", T.StructType([_f("Code", S), _f("Message", S)])),
])

# ---------------------------------------------------------------------------
# Marketplace M: GraphQL connection page (JSON)
# ---------------------------------------------------------------------------
M_NODE = T.StructType([
    _f("id", S), _f("orderNumber", S), _f("status", S),
    _f("createdAt", S), _f("paidAt", S), _f("shippedAt", S), _f("completedAt", S),
    _f("product", T.StructType([_f("id", S), _f("name", S), _f("price", L)])),
    _f("shippingInfo", T.StructType([_f("name", S), _f("prefecture", S)])),
    _f("payment", T.StructType([
        _f("productPrice", L), _f("shippingFee", L), _f("totalPrice", L),
        _f("platformFee", L), _f("settlementAmount", L),
    ])),
])
M_PAGE = T.StructType([
    _f("data", T.StructType([_f("orders", T.StructType([
        _f("edges", T.ArrayType(T.StructType([_f("cursor", S), _f("node", M_NODE)]))),
        _f("pageInfo", T.StructType([_f("hasNextPage", B), _f("endCursor", S)])),
    ]))])),
    _f("errors", T.ArrayType(T.StructType([_f("message", S)]))),
])

# Imported-order dataset written by the CSV importer (SNK6) and read back (SRC14).
IMPORTED_ORDER = T.StructType([
    _f("order_number", S), _f("order_date", T.TimestampNTZType()), _f("item_name", S),
    _f("quantity", L), _f("unit_price", L), _f("subtotal", L), _f("total_price", L),
    _f("use_point", L), _f("coupon_discount", L), _f("order_net_sales", L), _f("source", S),
    _f("import_id", S), _f("row_seq", L), _f("file_name", S),
])

# Store dimension (credentials are not modelled).
STORE = T.StructType([_f("name", S), _f("store_seq", I)])
