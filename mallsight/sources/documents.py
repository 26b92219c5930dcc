"""Raw marketplace documents built by Spark from the driver tables.

These are the inputs of the document readers (JSON / XML / GraphQL pages /
CSV exports).  Nesting an order's lines into one document groups by order
key; the collected arrays are bounded by the lines of one order, never by the
size of the table, and every array is sorted so documents are deterministic.

Shape variety (all derived from keys, so each case grows with the tables):
  R  +0900 and +09:00 offsets, cancelled orders (900), orders without lines
     (empty package list), null vs empty item numbers, re-fetched duplicates.
  Y  three response wrappers, namespaced tags, one item vs many vs none,
     totals only in Detail or at the top level, empty <SubTotal/>.
  M  createdAt in UTC ('Z'), missing createdAt with paidAt, undated and
     unparseable times, one id in two status sets, error pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ntz
from .adapters import _store_dim, cents
from .tables import read_table


def _star_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                  "l_quantity", "l_extendedprice", "l_returnflag"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_size"])
    return li.join(part, li.l_partkey == part.p_partkey, "left").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("units"),
        F.expr("CAST(ROUND(l_extendedprice * 100) AS BIGINT) DIV CAST(l_quantity AS BIGINT)").alias("price"),
        "p_name", "p_size", "p_partkey")


def _star_order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                               "o_orderdate", "o_orderpriority"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    return (o.join(cust, o.o_custkey == cust.c_custkey, "left")
             .join(_store_dim(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left")
             .withColumn("total", cents("o_totalprice"))
             .withColumn("coupon", F.expr("CAST(ROUND(o_totalprice * 100) AS BIGINT) "
                                          "* CAST(substring(o_orderpriority, 1, 1) AS INT) DIV 100")))


#: Lines that one task gathers into documents: its sorts stay in memory however large the tables are.
LINES_A_TASK = 250_000


def _by_order(spark: SparkSession, sf_dir: str, items: DataFrame, lines_a_task: int = LINES_A_TASK) -> DataFrame:
    """``items`` shuffled by order key, in as many partitions as the line count (from the file footers) asks for."""
    wanted = -(-read_table(spark, sf_dir, "lineitem").count() // lines_a_task)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # few lines: the session's partitions, which may be merged
    return items.repartition(max(wanted, n), "l_orderkey") if wanted > 24 else items.repartition("l_orderkey")


# ---------------------------------------------------------------------------
# R: nested order documents
# ---------------------------------------------------------------------------
def r_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested order document per order (schema.R_ORDER + ``_ingest_seq``).

    Packages group an order's lines by supplier class (l_suppkey % 5, which also
    sets the postage); items keep line-number order inside a package.
    """
    items = _star_items(spark, sf_dir).select("l_orderkey", F.struct(
        (F.col("l_suppkey") % 5).alias("pkg"), F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"),
        "units", "price", F.col("p_name").alias("itemName"),
        F.when(F.col("p_size") < 3, F.lit(None).cast("string"))
         .when(F.col("p_size") < 5, F.lit(""))
         .otherwise(F.concat(F.lit("SKU-"), (F.col("p_partkey") % 500).cast("string"))).alias("itemNumber")).alias("item"))
    # one shuffle by order key serves the grouping and the join with the order heads; the
    # packages are cut out of an order's sorted items
    per_order = (_by_order(spark, sf_dir, items).groupBy("l_orderkey").agg(F.array_sort(F.collect_list("item")).alias("its"))
                 .select("l_orderkey", F.transform(F.array_distinct("its.pkg"), lambda k: F.struct(
                     (k * 100).cast("bigint").alias("postagePrice"),
                     F.transform(F.filter("its", lambda x: x["pkg"].eqNullSafe(k)), lambda x: F.struct(
                         x["pk"].cast("string").alias("itemId"), x["itemName"].alias("itemName"),
                         x["itemNumber"].alias("itemNumber"), x["price"].alias("price"), x["units"].alias("units"))).alias("ItemModelList")))
                         .alias("PackageModelList")))
    heads = _star_order_heads(spark, sf_dir)
    ts_text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    doc = heads.join(per_order, heads.o_orderkey == per_order.l_orderkey, "left").select(
        F.col("o_orderkey").cast("string").alias("orderNumber"),
        F.concat(ts_text, F.when(F.col("o_orderkey") % 2 == 0, F.lit("+0900")).otherwise(F.lit("+09:00")))
         .alias("orderDatetime"),
        F.when(F.col("o_orderstatus") == "P", F.lit(900)).otherwise(F.lit(100)).alias("orderProgress"),
        F.col("total").alias("goodsPrice"),
        F.col("coupon").alias("couponAllTotalPrice"),
        ((F.col("o_custkey") % 4) * 100).alias("pointAmount"),
        F.col("c_mktsegment").alias("settlementMethodName"),
        F.col("source").alias("_store_name"),
        F.coalesce("PackageModelList", F.array().cast("array<struct<postagePrice:bigint,"
                   "ItemModelList:array<struct<itemId:string,itemName:string,itemNumber:string,"
                   "price:bigint,units:bigint>>>>")).alias("PackageModelList"),
        F.col("o_orderkey").alias("_ingest_seq"),
    )
    return doc


def r_search_pages(spark: SparkSession, sf_dir: str, start=None, end=None,
                   page_size: int = 1000) -> DataFrame:
    """SRC3 input: paged id-search responses for orders placed in [start, end)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    if start is not None:
        o = o.filter(F.col("o_orderdate") >= ntz(start))
    if end is not None:
        o = o.filter(F.col("o_orderdate") < ntz(end))
    pages = (o.groupBy((F.col("o_orderkey") / page_size).cast("bigint").alias("page"))
              .agg(F.array_sort(F.collect_list("o_orderkey")).alias("keys")))
    return pages.select(
        "page",
        F.transform("keys", lambda k: k.cast("string")).alias("orderNumberList"),
        F.struct(F.lit(None).cast("int").alias("totalPages")).alias("PaginationResponseModel"))


# ---------------------------------------------------------------------------
# Y: XML order-detail responses, one document per line of text
# ---------------------------------------------------------------------------
def y_xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML detail response per order (column ``value``) plus ``ingest_seq``."""
    items = _star_items(spark, sf_dir).select("l_orderkey", F.struct(
        F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"), "units", "price",
        F.col("p_name").alias("Title"), F.col("l_returnflag").alias("flag")).alias("item"))

    def xml_item(x):
        # empty <SubTotal/> for returned lines ('R'), absent for 'A', given otherwise
        sub = (F.when(x["flag"] == "R", F.lit("")).when(x["flag"] == "A", F.lit(None).cast("string"))
               .otherwise((x["price"] * x["units"]).cast("string")))
        return F.struct(x["pk"].cast("string").alias("ItemId"), x["Title"].alias("Title"), x["price"].cast("string").alias("UnitPrice"),
                        x["units"].cast("string").alias("Quantity"), sub.alias("SubTotal"))
    per_order = (_by_order(spark, sf_dir, items).groupBy("l_orderkey").agg(F.array_sort(F.collect_list("item")).alias("its"))
                 .select("l_orderkey", F.transform("its", xml_item).alias("Item")))
    heads = _star_order_heads(spark, sf_dir)
    d = heads.join(per_order, heads.o_orderkey == per_order.l_orderkey, "left")
    k = F.col("o_orderkey")
    total_txt = F.col("total").cast("string")
    info = F.struct(
        k.cast("string").alias("OrderId"),
        F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("OrderTime"),
        F.col("o_orderstatus").alias("OrderStatus"),
        # top-level total always; Pay total missing for key % 5 == 1 (-> Detail),
        # missing in Pay and Detail for key % 5 == 2 (-> top level)
        total_txt.alias("TotalPrice"),
        F.struct(F.when(k % 5 == 1, F.lit("0")).when(k % 5 == 2, F.lit(None).cast("string"))
                  .otherwise(total_txt).alias("TotalPrice"),
                 ((F.col("o_custkey") % 4) * 100).cast("string").alias("UsePoint"),
                 F.col("coupon").cast("string").alias("GiftCardDiscount"),
                 F.lit("0").alias("PayCharge"), F.lit("0").alias("ShipCharge")).alias("Pay"),
        F.struct(F.when(k % 5 == 2, F.lit(None).cast("string")).otherwise(total_txt).alias("TotalPrice"))
         .alias("Detail"),
        F.col("Item"))
    body = F.to_xml(info, {"rowTag": "OrderInfo"})
    # Namespaced variant for key % 7 == 3: prefix every element name.
    body = F.when(k % 7 == 3, F.regexp_replace(F.regexp_replace(body, "<(/?)([A-Za-z])", "<$1y:$2"),
                                                "<y:OrderInfo>", "<y:OrderInfo xmlns:y=\"urn:y\">")) \
        .otherwise(body)
    body = F.regexp_replace(body, "\\s*\\n\\s*", "")
    wrapped = (F.when(k % 3 == 0, F.concat(F.lit("<ResultSet><Result>"), body, F.lit("</Result></ResultSet>")))
                .when(k % 3 == 1, F.concat(F.lit("<Result>"), body, F.lit("</Result>")))
                .otherwise(body))
    return d.select(wrapped.alias("value"), k.alias("ingest_seq"))


def y_error_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC9 input: error responses, one per store (derived from the nation table)."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return n.select(F.concat(F.lit("<Error><Code>rate-limit</Code><Message>too many requests for "),
                             F.col("n_name"), F.lit("</Message></Error>")).alias("value"),
                    (-1 - F.col("n_nationkey")).cast("bigint").alias("ingest_seq"))


# ---------------------------------------------------------------------------
# M: GraphQL connection pages
# ---------------------------------------------------------------------------
# The status sets collected, in collection order.
M_STATUS_SETS = ["COMPLETED", "SHIPPED", "WAITING_FOR_SHIPMENT"]


def _m_status_sets():
    """Status sets that list an order: its own, and SHIPPED once more for every fifth completed order."""
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("COMPLETED"))
               .when(F.col("o_orderstatus") == "O", F.lit("SHIPPED"))
               .otherwise(F.lit("WAITING_FOR_SHIPMENT")))
    return F.array_compact(F.array(status, F.when((status == "COMPLETED") & (F.col("o_orderkey") % 5 == 0), F.lit("SHIPPED"))))


def m_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order node per order (+ a stale SHIPPED copy of every fifth completed order)."""
    heads = _star_order_heads(spark, sf_dir)
    k = F.col("o_orderkey")
    # an order and its stale copy leave one row of one scan
    heads = heads.select("*", F.explode(_m_status_sets()).alias("status_set"))
    status = F.col("status_set")
    # createdAt: the JST order time as a UTC instant ('Z'), i.e. 9 hours earlier
    utc = F.date_format(F.timestamp_add("HOUR", F.lit(-9), F.col("o_orderdate")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    created = (F.when(k % 7 == 0, F.lit(None).cast("string"))
                .when(k % 13 == 0, F.lit("not-a-date"))
                .when(k % 11 == 0, F.lit(None).cast("string"))
                .otherwise(utc))
    paid = F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(utc)
    node = F.struct(
        F.concat(F.lit("m"), k.cast("string")).alias("id"),
        k.cast("string").alias("orderNumber"),
        status.alias("status"),
        created.alias("createdAt"), paid.alias("paidAt"),
        F.lit(None).cast("string").alias("shippedAt"), F.lit(None).cast("string").alias("completedAt"),
        F.struct((F.col("o_custkey") % 97).cast("string").alias("id"),
                 F.col("c_name").alias("name"), F.col("total").alias("price")).alias("product"),
        F.struct(F.col("c_name").alias("name"), F.col("source").alias("prefecture")).alias("shippingInfo"),
        F.struct(F.col("total").alias("productPrice"), F.lit(0).cast("bigint").alias("shippingFee"),
                 F.col("total").alias("totalPrice"), (F.col("total") / 10).cast("bigint").alias("platformFee"),
                 (F.col("total") - (F.col("total") / 10).cast("bigint")).alias("settlementAmount")).alias("payment"))
    return heads.select(k.alias("key"), "status_set", node.alias("node"))


def m_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """GraphQL pages (schema.M_PAGE as JSON text) per status set, plus error pages.

    A page holds the nodes whose key falls in one block of ``page_size`` keys,
    so paging needs no global numbering.
    """
    nodes = m_nodes(spark, sf_dir)
    page = (F.col("key") / page_size).cast("bigint")
    edges = (nodes.groupBy("status_set", page.alias("page"))
                  .agg(F.array_sort(F.collect_list(F.struct(F.col("key").alias("_k"),
                       F.col("node.id").alias("cursor"), "node"))).alias("e")))
    data = edges.select(
        "status_set", "page",
        F.to_json(F.struct(F.struct(F.struct(
            F.transform("e", lambda x: x.dropFields("_k")).alias("edges"),
            F.struct(F.lit(True).alias("hasNextPage"),
                     F.element_at("e", -1).getField("cursor").alias("endCursor")).alias("pageInfo"),
        ).alias("orders")).alias("data"))).alias("value"))
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    errors = (orders.select(F.explode(_m_status_sets()).alias("status_set")).distinct()
              .select("status_set", F.lit(-1).cast("bigint").alias("page"),
                      F.lit('{"data":null,"errors":[{"message":"Throttled"}]}').alias("value")))
    set_rank = F.when(F.col("status_set") == M_STATUS_SETS[0], 0).when(
        F.col("status_set") == M_STATUS_SETS[1], 1).otherwise(2)
    return data.unionByName(errors).withColumn("set_seq", set_rank)


# ---------------------------------------------------------------------------
# Y: CSV order exports (three header vocabularies, two encodings)
# ---------------------------------------------------------------------------
# layout -> (encoding, date pattern, header names in canonical order; None = column absent)
CSV_LAYOUTS = {
    0: ("windows-31j", "yyyy/MM/dd HH:mm:ss",
        ["注文ID", "注文日時", "商品名", "数量", "単価", "小計", "合計金額", "ポイント利用", "クーポン割引"]),
    1: ("UTF-8", "yyyy-MM-dd HH:mm:ss",
        ["OrderId", "OrderTime", "Title", "Quantity", "UnitPrice", "SubTotal", "TotalPrice", "UsePoint",
         "CouponDiscount"]),
    2: ("UTF-8", "yyyy-MM-dd",
        ["オーダーID", "注文日", "商品タイトル", "個数", "商品単価", None, "請求金額", None, None]),
}


def csv_export(lines: DataFrame, layout: int, bump_quantity: bool = False, ordered=None) -> DataFrame:
    """Order lines rendered as one export layout (all text columns, file order = line order).

    Layout 0 writes amounts with thousands separators, layout 1 writes some
    unit prices as decimals ('1234.0') and a byte-order mark on its first header.
    ``ordered(lines, columns)`` sorts the lines, by default over all files.
    """
    _, date_fmt, names = CSV_LAYOUTS[layout]
    qty = F.col("quantity") + (1 if bump_quantity else 0)
    sub = F.col("unit_price") * qty

    def amount(c):
        if layout == 0:
            return F.format_number(c.cast("double"), 0)
        return c.cast("string")

    unit = amount(F.col("unit_price"))
    if layout == 1:
        unit = F.when(F.col("ingest_seq") % 4 == 0, F.concat(unit, F.lit(".0"))).otherwise(unit)
    values = [F.col("order_number"), F.date_format("order_datetime", date_fmt), F.col("item_name"),
              qty.cast("string"), unit, amount(sub), amount(F.col("total_price")),
              amount(F.col("point_used")), amount(F.col("coupon_used"))]
    out = [v.alias(n) for v, n in zip(values, names) if n is not None]
    if layout == 1:
        out[0] = values[0].alias("\ufeff" + names[0])
    order = ["ingest_seq", "line_seq", "item_id", "quantity", "unit_price", "shipping_charge"]
    if ordered is None:  # ranges by two numbers: what is sampled for them goes through the driver
        return lines.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select(*out)
    return ordered(lines, order).select(*out)


def y_list_pages(spark: SparkSession, sf_dir: str, start, end, page_size: int = 100) -> DataFrame:
    """SRC6 input: order-list XML pages for orders placed in [start, end).

    Pages hold blocks of ``page_size`` order keys; even pages use the
    ``Result/Search`` path, odd pages the bare ``Search`` path.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    o = o.filter((F.col("o_orderdate") >= ntz(start)) & (F.col("o_orderdate") < ntz(end)))
    page = (F.col("o_orderkey") / page_size).cast("bigint")
    info = F.struct(F.col("o_orderkey").alias("_k"),
                    F.col("o_orderkey").cast("string").alias("OrderId"),
                    F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("OrderTime"),
                    F.col("o_orderstatus").alias("OrderStatus"),
                    cents("o_totalprice").cast("string").alias("TotalPrice"))
    pages = o.groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(info)).alias("infos"))
    search = F.struct(F.size("infos").cast("string").alias("TotalCount"),
                      F.transform("infos", lambda x: x.dropFields("_k")).alias("OrderInfo"))
    body = F.regexp_replace(F.to_xml(search, {"rowTag": "Search"}), "\\s*\\n\\s*", "")
    value = F.when(F.col("page") % 2 == 0, F.concat(F.lit("<Result>"), body, F.lit("</Result>"))).otherwise(body)
    return pages.select("page", value.alias("value"))
