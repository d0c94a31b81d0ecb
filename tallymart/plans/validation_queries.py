"""Queries that validate documents made of the tables, and cards of listing pages made of suppliers and their parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import validators
from tallymart.plans.catalog import register
from tallymart.sources import cards
from tallymart.sources.tables import table

c, lit = F.col, F.lit
_DAY = "2024-01-01T00:00:00Z"


def _numbered(rows: str) -> str:
    """SQL of issues with their places: rows has id, o (order), path, message."""
    return f"SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY o) - 1 AS INTEGER) AS at, path, message FROM ({rows})"


def _english(text):
    return F.struct(text.alias("en"))


def _object_id(number):
    return F.lpad(number.cast("string"), 24, "0")


def _dated(*names):
    return [lit(_DAY).alias(n) for n in names]


def _dealt(rows, key):
    """Rows over all tasks: a small row makes a document whose rules take much longer than moving the row."""
    return rows.repartition(key)


def _document(rows, key, *fields):
    return _dealt(rows, key).select(key.alias("id"), F.parse_json(F.to_json(F.struct(*fields))).alias("doc"))


@register(
    "restaurant_issues",
    _numbered("""SELECT s_suppkey AS id, 0 AS o, 'sourceKey' AS path, 'does not match the identity fields (expected talabat:restaurant:id:' || s_suppkey || ')' AS message FROM supplier WHERE s_suppkey % 11 = 0
 UNION ALL SELECT s_suppkey, 1, 'name', 'is required' FROM supplier WHERE s_suppkey % 7 = 0
 UNION ALL SELECT s_suppkey, 2, 'url.en', 'must use http or https' FROM supplier WHERE s_suppkey % 13 = 0
 UNION ALL SELECT s_suppkey, 3, 'cuisines[1]', 'must not have leading/trailing whitespace' FROM supplier WHERE s_suppkey % 4 = 0
 UNION ALL SELECT s_suppkey, 4, 'rating', 'must be <= 5' FROM supplier WHERE s_nationkey > 20
 UNION ALL SELECT s_suppkey, 5, 'deliveryFee', 'must be >= 0' FROM supplier WHERE s_acctbal < 0
 UNION ALL SELECT s_suppkey, 6, 'location.lat', 'must be <= 90' FROM supplier WHERE s_suppkey % 3 = 0"""),
)
def restaurant_issues(spark, sf):
    """Restaurants made of suppliers."""
    k = c("s_suppkey")
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), c("s_nationkey") == c("n_nationkey"))
    documents = _document(
        rows, k, lit("talabat").alias("platform"), k.cast("string").alias("platformRestaurantId"), lit("id").alias("sourceKeyKind"), F.concat(F.when(k % 11 == 0, "talabat:place:").otherwise("talabat:restaurant:id:"), k).alias("sourceKey"),
        F.when(k % 7 != 0, _english(c("s_name"))).alias("name"), _english(F.concat(F.when(k % 13 == 0, "ftp").otherwise("https"), lit("://menu.example/"), k)).alias("url"), F.array(c("n_name"), F.concat(F.when(k % 4 == 0, " ").otherwise("x"), c("n_name"))).alias("cuisines"),
        F.array().alias("tags"), F.array().alias("offers"), (c("s_nationkey") / 4.0).alias("rating"), c("s_acctbal").cast("double").alias("deliveryFee"), lit("AED").alias("currency"), lit(True).alias("isActive"),
        F.struct(c("n_name").alias("city"), F.when(k % 3 == 0, 100.5).otherwise(24.5).alias("lat")).alias("location"), _english(lit(_DAY)).alias("lastScrapedAtByLocale"), _english(lit("run-00001")).alias("lastRunIdByLocale"), *_dated("firstSeenAt", "createdAt", "updatedAt"),
    )
    return validators.issue_rows(documents, validators.RESTAURANT, "id")


@register(
    "item_issues",
    _numbered("""SELECT p_partkey AS id, 0 AS o, 'originalPrice' AS path, 'must not be lower than price' AS message FROM part WHERE p_retailprice > 1200
 UNION ALL SELECT p_partkey, 1, 'isAvailable', 'must be false when availabilityStatus is "unavailable"' FROM part WHERE p_partkey % 5 = 0
 UNION ALL SELECT p_partkey, 2, 'calories', 'must be >= 0' FROM part WHERE p_size < 10
 UNION ALL SELECT p_partkey, 3, 'modifiers[0].minSelections', 'must not exceed maxSelections' FROM part WHERE p_partkey % 6 = 0
 UNION ALL SELECT p_partkey, 4, 'modifiers[0].options[1].priceDelta', 'must be a finite number' FROM part WHERE p_partkey % 4 = 0
 UNION ALL SELECT p_partkey, 5, 'modifiers[1].options', 'must be a non-empty array' FROM part WHERE p_partkey % 3 = 0
 UNION ALL SELECT p_partkey, 6, 'modifiers[1].options[0].currency', 'must be an ISO 4217 code (e.g. AED)' FROM part WHERE p_partkey % 3 = 1"""),
)
def item_issues(spark, sf):
    """Menu items made of parts, with groups of modifiers and their options."""
    k, size = c("p_partkey"), c("p_size")
    option = lambda name, delta, currency=lit("AED"): F.struct(_english(name).alias("name"), delta.alias("priceDelta"), currency.alias("currency"))
    first = F.array(option(c("p_type"), lit("1.5")), option(c("p_brand"), F.when(k % 4 == 0, "free").otherwise("2")))
    second = F.when(k % 3 == 0, F.array().cast(first_type := "array<struct<name:struct<en:string>,priceDelta:string,currency:string>>")).otherwise(F.array(option(c("p_type"), lit("0"), F.when(k % 3 == 1, "aed").otherwise("AED")))).cast(first_type)
    group = lambda name, least, options: F.struct(_english(name).alias("name"), least.alias("minSelections"), lit(2).alias("maxSelections"), options.alias("options"))
    groups = F.array(group(lit("Size"), F.when(k % 6 == 0, 3).otherwise(1), first), group(lit("Milk"), lit(0), second))
    fields = F.struct(
        lit("deliveroo").alias("platform"), _object_id(k).alias("restaurantId"), lit("deliveroo:restaurant:anchor:x").alias("restaurantSourceKey"), k.cast("string").alias("platformItemId"), lit("id").alias("sourceKeyKind"),
        F.concat(lit("deliveroo:restaurant:anchor:x:item:id:"), k).alias("sourceKey"), _english(c("p_name")).alias("name"), _english(lit("https://menu.example/x")).alias("sourceUrl"), c("p_retailprice").cast("double").alias("price"), lit(1200).alias("originalPrice"),
        lit("AED").alias("currency"), F.when(k % 5 == 0, "unavailable").otherwise("available").alias("availabilityStatus"), lit(True).alias("isAvailable"), lit(True).alias("isActive"), F.array(c("p_type")).alias("dietaryTags"), (size - 10).alias("calories"),
        groups.alias("modifiers"), _english(lit(_DAY)).alias("lastSeenAtByLocale"), _english(lit("run-00001")).alias("lastRunIdByLocale"), *_dated("firstSeenAt", "lastSeenAt", "createdAt", "updatedAt"),
    )
    # deltas that look like numbers are numbers
    text = F.regexp_replace(F.to_json(fields), '"priceDelta":"([0-9.]+)"', '"priceDelta":$1')
    return validators.issue_rows(_dealt(table(spark, sf, "part"), k).select(k.alias("id"), F.parse_json(text).alias("doc")), validators.ITEM, "id")


@register(
    "run_issues",
    _numbered("""SELECT o_orderkey AS id, 0 AS o, 'finishedAt' AS path, 'must be absent while the run is running' AS message FROM orders WHERE o_orderstatus = 'O'
 UNION ALL SELECT o_orderkey, 1, 'finishedAt', 'must not be earlier than startedAt' FROM orders WHERE o_orderstatus <> 'O' AND o_orderkey % 5 = 0
 UNION ALL SELECT o_orderkey, 2, 'durationMs', 'must be an integer' FROM orders WHERE o_totalprice <> floor(o_totalprice)
 UNION ALL SELECT o_orderkey, 3, 'counts.itemsSeen', 'must be >= 0' FROM orders WHERE o_custkey % 9 = 0
 UNION ALL SELECT o_orderkey, 4, 'errors', 'must contain at least one entry for a failed run' FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0
 UNION ALL SELECT o_orderkey, 5, 'errors[0].message', 'must not contain secret query parameters' FROM orders WHERE o_orderkey % 6 = 1"""),
)
def run_issues(spark, sf):
    """Runs made of orders."""
    k = c("o_orderkey")
    status = F.when(c("o_orderstatus") == "O", "running").when(c("o_orderstatus") == "F", "succeeded").otherwise("failed")
    error = F.struct(lit("fetch").alias("stage"), lit("HTTP").alias("code"), F.when(k % 6 == 1, "https://a.example/?x=1&token=1").otherwise("gone").alias("message"))
    counts = F.struct(*((F.when(c("o_custkey") % 9 == 0, -1).otherwise(c("o_custkey")) if n == "itemsSeen" else lit(0)).alias(n) for n in validators.COUNTS))
    stamp = lambda day: F.date_format(day.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    documents = _document(
        table(spark, sf, "orders"), k, F.concat(lit("run-0000000-"), k).alias("runId"), lit("talabat").alias("platform"), lit("en").alias("locale"), lit("listing").alias("targetType"), lit("cron").alias("trigger"), status.alias("status"),
        lit("https://menu.example/").alias("targetUrl"), lit(False).alias("dryRun"), stamp(c("o_orderdate")).alias("startedAt"), stamp(F.date_add(c("o_orderdate").cast("date"), F.when(k % 5 == 0, -1).otherwise(1))).alias("finishedAt"),
        c("o_totalprice").cast("double").alias("durationMs"), counts.alias("counts"), F.when(k % 2 == 0, F.array()).otherwise(F.array(error)).alias("errors"), *_dated("createdAt", "updatedAt"),
    )
    return validators.issue_rows(documents, validators.RUN, "id")


@register(
    "item_mapping_issues",
    _numbered("""WITH m AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS id, CASE l_returnflag WHEN 'A' THEN 'MATCHED' WHEN 'R' THEN 'REJECTED' ELSE 'UNMATCHED' END AS s, l_linenumber % 2 = 1 AS given, l_quantity > 25 AS imported, l_linestatus = 'O' AS live, l_discount AS d FROM lineitem)
 SELECT id, 0 AS o, 'canonicalItemId' AS path, 'must be absent while UNMATCHED' AS message FROM m WHERE s = 'UNMATCHED' AND given
 UNION ALL SELECT id, 1, 'matchMethod', 'must be absent while UNMATCHED' FROM m WHERE s = 'UNMATCHED'
 UNION ALL SELECT id, 2, 'canonicalItemId', 'is required when ' || s FROM m WHERE s <> 'UNMATCHED' AND NOT given
 UNION ALL SELECT id, 3, 'isActive', 'must be false when REJECTED' FROM m WHERE s = 'REJECTED' AND live
 UNION ALL SELECT id, 4, 'supersededAt', 'is required on an inactive (superseded) mapping' FROM m WHERE NOT live AND s <> 'REJECTED'
 UNION ALL SELECT id, 5, 'confidence', 'must be between 0 and 1' FROM m WHERE d >= 0.08
 UNION ALL SELECT id, 6, 'confidence', 'must be 1 for IMPORT' FROM m WHERE imported AND (d >= 0.08 OR d < 0.07)
 UNION ALL SELECT id, 7, 'evidence.nameScore', 'must be between 0 and 1' FROM m WHERE d < 0.01"""),
)
def item_mapping_issues(spark, sf):
    """Mappings of items made of order lines."""
    status = F.when(c("l_returnflag") == "A", "MATCHED").when(c("l_returnflag") == "R", "REJECTED").otherwise("UNMATCHED")
    confidence = F.when(c("l_discount") >= 0.08, 1.5).when(c("l_discount") >= 0.07, 1.0).otherwise(c("l_discount").cast("double"))
    evidence = F.struct(F.when(c("l_discount") < 0.01, -0.5).otherwise(0.5).alias("nameScore"), F.array(lit("NAME_EXACT")).alias("reasons"), F.array().alias("conflicts"))
    documents = _document(
        table(spark, sf, "lineitem"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c("l_shipdate").cast("date").cast("string")), _object_id(c("l_suppkey")).alias("restaurantGroupId"), _object_id(c("l_partkey")).alias("menuItemId"), _object_id(c("l_suppkey")).alias("restaurantId"),
        lit("careem").alias("platform"), status.alias("matchStatus"), lit("matcher").alias("decidedBy"), F.when(c("l_linenumber") % 2 == 1, _object_id(c("l_partkey"))).alias("canonicalItemId"), F.when(c("l_quantity") > 25, "IMPORT").otherwise("MANUAL").alias("matchMethod"),
        (c("l_linestatus") == "O").alias("isActive"), confidence.alias("confidence"), evidence.alias("evidence"), *_dated("decidedAt", "createdAt", "updatedAt"),
    )
    return validators.issue_rows(documents, validators.ITEM_MAPPING, "id")


#: The same pages as SQL sees them: cards of a supplier's parts by key, each fifth with a card of its own inside; parts of one size are one place.
_CARDS = """WITH sold AS (SELECT DISTINCT l_suppkey AS page_id, l_partkey AS p FROM lineitem), own AS (SELECT page_id, p, p_size, p_brand, p_name FROM sold JOIN part ON p = p_partkey),
card AS (SELECT page_id, p, 0 AS inner_card, 'r' || p_size AS id, p_name AS name, '/menu/' || p AS path, p_size || '% off selected items' AS a, CASE WHEN p % 2 = 0 THEN 'Spend AED ' || p || ', get free delivery' END AS b FROM own
 UNION ALL SELECT page_id, p, 1, CAST(p AS VARCHAR), p_brand, NULL, 'Buy 1, get 1 free', NULL FROM own WHERE p % 5 = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY p, inner_card) - 1 AS spot FROM card), """


def listing(spark, sf):
    """page_id, html: a supplier's page with a card for each of its parts, at changing depth."""
    k = c("p_partkey")
    sold = table(spark, sf, "lineitem").select(c("l_suppkey").alias("page_id"), "l_partkey").distinct().join(table(spark, sf, "part"), c("l_partkey") == k)
    inner = F.concat(lit('"more":[{"partner-name.content":"'), c("p_brand"), lit('","card.on-tap":{"action":{"parameters":{"restaurant_id":'), k, lit('}}},"promotional-x-label.content":"Buy 1,  get 1 free"}],'))
    card = F.concat(
        lit('{"z":[1,{"q":null}],'), F.when(k % 5 == 0, inner).otherwise(""), lit('"partner-name.content":"‎'), c("p_name"), lit('","b.on-tap":{"action":{"parameters":{"restaurant_id":"r'), c("p_size"), lit('","restaurant_href":"/menu/'), k, lit('?d=1"}}},"promotional-b-label.content":"'),
        c("p_size"), lit("% off selected items\""), F.when(k % 2 == 0, F.concat(lit(',"promotional-a-label.content":"Spend AED '), k, lit(', get free delivery"'))).otherwise(""), lit(',"promotional-c-label.content":7}'),
    )
    nested = F.when(k % 3 == 0, F.concat(lit('{"a":{"b":[['), card, lit("]]}}"))).otherwise(card)
    pages = sold.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), nested.alias("card")))), lambda x: x["card"]), ",").alias("cards"))
    return pages.select("page_id", F.concat(lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"feed":['), "cards", lit("]}}</script>")).alias("html"))


@register(
    "listed_places",
    _CARDS
    + """label AS (SELECT page_id, id, spot * 2 AS o, a AS label FROM placed UNION ALL SELECT page_id, id, spot * 2 + 1, b FROM placed WHERE b IS NOT NULL),
once AS (SELECT page_id, id, label, min(o) AS o FROM label GROUP BY ALL), told AS (SELECT page_id, id, string_agg(label, '; ' ORDER BY o) AS labels FROM once GROUP BY ALL)
SELECT page_id, CAST(min(spot) AS INTEGER) AS at, id, arg_min(name, spot) AS name, arg_min(path, spot) AS path, any_value(labels) AS labels FROM placed JOIN told USING (page_id, id) GROUP BY page_id, id""",
)
def listed_places(spark, sf):
    """Cards at any depth, those of one place as one, with the labels of all of them."""
    return cards.listed_places(listing(spark, sf)).withColumn("labels", F.array_join("labels", "; "))


@register(
    "listed_offers",
    _CARDS
    + """label AS (SELECT page_id, id, a AS label FROM placed UNION ALL SELECT page_id, id, b FROM placed WHERE b IS NOT NULL), once AS (SELECT DISTINCT page_id, id, label FROM label)
SELECT CASE WHEN label LIKE 'Spend%' THEN 'FREE_DELIVERY' WHEN label LIKE 'Buy%' THEN 'BUY_ONE_GET_ONE' ELSE 'PERCENT_OFF_ITEMS' END AS type, count(*) AS n, count(DISTINCT page_id) AS pages,
 max(CASE WHEN label LIKE '%off%' THEN CAST(split_part(label, '%', 1) AS DOUBLE) END) AS most, min(CASE WHEN label LIKE 'Spend%' THEN CAST(regexp_extract(label, '[0-9]+') AS DOUBLE) END) AS least FROM once GROUP BY 1""",
)
def listed_offers(spark, sf):
    """S9 with T43: offers that the labels of listed places make, by type."""
    found = cards.listed_offers(cards.listed_places(listing(spark, sf)))
    return found.groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("pages"), F.max("percentage").alias("most"), F.min("minimum").alias("least"))
