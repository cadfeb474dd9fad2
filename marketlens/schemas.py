"""Landed-JSON read schemas and sink table contracts.

Read schemas are Spark DDL strings, used by ``spark.read.schema(...)`` and ``from_json``. Numbers that the
source sends are read as ``string`` and cast later (a JSON ``"7"`` or ``12.5`` read as ``bigint`` silently becomes null).
Timestamps are text on the wire.

Contracts are ordered ``(column, type)`` lists: the column order of each sink table.
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------------------------------
# Landed read schemas (one JSON document per file, or one per line).
# ---------------------------------------------------------------------------------------------------

def as_text(schema: str) -> str:
    """The schema with every number read as text: JSON numbers and numbers in quotes both arrive, whatever their digits."""
    return re.sub(r"\b(bigint|int|double)\b", "string", schema)


def flat_types(fields: str) -> list[tuple[str, str]]:
    """(name, type) of the plain fields of a struct's field list, for ``operators.project.typed``."""
    plain = re.sub(r"\w+:(struct|array)<.*>", "", fields)
    return [(n.strip(), t.strip()) for n, t in re.findall(r"(\w+)[: ]\s*(bigint|int|double|string|boolean)\b", plain)]


CAMPAIGN_COUNTS = as_text(
    "adverts array<struct<type:int, status:int, count:int,"
    " advert_list:array<struct<advertId:bigint, changeTime:string>>>>"
)

CAMPAIGN_DETAIL_FIELDS = (
    "advertId bigint, name string, status int, type int,"
    " createTime string, startTime string, endTime string"
)

CAMPAIGN_DETAILS = as_text(CAMPAIGN_DETAIL_FIELDS)

AD_STATS_NM = (
    "nmId:bigint, name:string, views:bigint, clicks:bigint, ctr:double, cpc:double, sum:double,"
    " atbs:bigint, orders:bigint, cr:double, shks:bigint, sum_price:double"
)
AD_STATS = as_text(
    "advertId bigint, days array<struct<date:string,"
    f" apps:array<struct<appType:int, nm:array<struct<{AD_STATS_NM}>>>>>>"
)

PRODUCT_HISTORY_DAY = (
    "dt:string, openCardCount:int, addToCartCount:int, addToCartConversion:double, ordersCount:int,"
    " ordersSumRub:double, cartToOrderConversion:double, buyoutsCount:int, buyoutsSumRub:double,"
    " buyoutPercent:double"
)
PRODUCT_HISTORY = as_text(
    "error boolean, errorText string, data array<struct<nmID:bigint, imtName:string, vendorCode:string,"
    f" history:array<struct<{PRODUCT_HISTORY_DAY}>>>>"
)

FUNNEL_CARD = (
    "nmID:bigint, vendorCode:string, brandName:string, object:struct<id:int, name:string>,"
    " statistics:struct<selectedPeriod:struct<begin:string, end:string, openCardCount:int,"
    " addToCartCount:int, ordersCount:int, ordersSumRub:double, buyoutsCount:int, buyoutsSumRub:double,"
    " cancelCount:int, cancelSumRub:double, avgOrdersCountPerDay:double, avgPriceRub:double,"
    " conversions:struct<addToCartPercent:double, cartToOrderPercent:double, buyoutsPercent:double>>>,"
    " stocks:struct<stocksMp:int, stocksWb:int>"
)
FUNNEL_PAGE = as_text(f"data struct<page:int, isNextPage:boolean, cards:array<struct<{FUNNEL_CARD}>>>")

WAREHOUSE_REMAINS = as_text(
    "brand string, subjectName string, vendorCode string, inWayToClient int, inWayFromClient int,"
    " quantityWarehousesFull int, warehouses array<struct<warehouseName:string, quantity:int>>"
)

# Supplier orders: the 28 source columns of the order log; dates are text, flags are JSON booleans.
SUPPLIER_ORDERS = as_text(
    "date string, lastChangeDate string, warehouseName string, warehouseType string, countryName string,"
    " oblastOkrugName string, regionName string, supplierArticle string, nmId bigint, barcode string,"
    " category string, subject string, brand string, techSize string, incomeID bigint, isSupply boolean,"
    " isRealization boolean, totalPrice double, discountPercent int, spp int, finishedPrice double,"
    " priceWithDisc double, isCancel boolean, cancelDate string, orderType string, sticker string,"
    " gNumber string, srid string"
)

# The 73 realization-report source columns, in the order of the sink table.
REALIZATION_SOURCE_COLUMNS = [
    "realizationreport_id", "date_from", "date_to", "create_dt", "currency_name",
    "suppliercontract_code", "rrd_id", "gi_id", "dlv_prc", "fix_tariff_date_from",
    "fix_tariff_date_to", "subject_name", "nm_id", "brand_name", "sa_name", "ts_name",
    "barcode", "doc_type_name", "quantity", "retail_price", "retail_amount",
    "sale_percent", "commission_percent", "office_name", "supplier_oper_name",
    "order_dt", "sale_dt", "rr_dt", "shk_id", "retail_price_withdisc_rub",
    "delivery_amount", "return_amount", "delivery_rub", "gi_box_type_name",
    "product_discount_for_report", "supplier_promo", "rid", "ppvz_spp_prc",
    "ppvz_kvw_prc_base", "ppvz_kvw_prc", "sup_rating_prc_up", "is_kgvp_v2",
    "ppvz_sales_commission", "ppvz_for_pay", "ppvz_reward", "acquiring_fee",
    "acquiring_percent", "payment_processing", "acquiring_bank", "ppvz_vw",
    "ppvz_vw_nds", "ppvz_office_name", "ppvz_office_id", "ppvz_supplier_id",
    "ppvz_supplier_name", "ppvz_inn", "declaration_number", "bonus_type_name",
    "sticker_id", "site_country", "srv_dbs", "penalty", "additional_payment",
    "rebill_logistic_cost", "storage_fee", "deduction", "acceptance", "assembly_id",
    "srid", "report_type", "is_legal_entity", "trbx_id", "rebill_logistic_org",
]
# Realization date columns, and the nullable text columns where '' means null.
REALIZATION_DATE_COLUMNS = ["date_from", "date_to", "create_dt", "fix_tariff_date_from",
                            "fix_tariff_date_to", "order_dt", "sale_dt", "rr_dt", "load_dt"]
REALIZATION_NULLABLE_TEXT = [
    "project", "suppliercontract_code", "fix_tariff_date_from", "fix_tariff_date_to",
    "subject_name", "brand_name", "sa_name", "ts_name", "barcode", "doc_type_name",
    "office_name", "gi_box_type_name", "payment_processing", "acquiring_bank",
    "ppvz_office_name", "ppvz_supplier_name", "ppvz_inn", "declaration_number",
    "bonus_type_name", "site_country", "srid", "trbx_id", "rebill_logistic_org",
]
REALIZATION_BOOL_COLUMNS = ["srv_dbs", "is_legal_entity"]

# Types of the realization columns are our choice (the source names keys, not types).
_REALIZATION_LONG = {"realizationreport_id", "rrd_id", "gi_id", "nm_id", "quantity", "shk_id", "rid", "ppvz_office_id", "ppvz_supplier_id",
                     "assembly_id", "report_type"}
_REALIZATION_DOUBLE = {"dlv_prc", "retail_price", "retail_amount", "commission_percent",
                       "retail_price_withdisc_rub", "delivery_rub", "sale_percent", "delivery_amount", "return_amount", "product_discount_for_report",
                       "supplier_promo", "ppvz_spp_prc", "ppvz_kvw_prc_base", "ppvz_kvw_prc",
                       "sup_rating_prc_up", "is_kgvp_v2", "ppvz_sales_commission", "ppvz_for_pay",
                       "ppvz_reward", "acquiring_fee", "acquiring_percent", "ppvz_vw", "ppvz_vw_nds",
                       "penalty", "additional_payment", "rebill_logistic_cost", "storage_fee",
                       "deduction", "acceptance"}


def _realization_type(c: str, landed: bool) -> str:
    if c in _REALIZATION_LONG or c in _REALIZATION_DOUBLE:
        return "string" if landed else "bigint" if c in _REALIZATION_LONG else "double"
    if c in REALIZATION_BOOL_COLUMNS:
        return "boolean" if landed else "int"
    if c in REALIZATION_DATE_COLUMNS:
        return "string" if landed else "timestamp_ntz"
    return "string"


REALIZATION_REPORT = ", ".join(f"{c} {_realization_type(c, True)}" for c in REALIZATION_SOURCE_COLUMNS)

FINANCE_OPERATIONS = as_text(
    "result struct<operations:array<struct<operation_id:string, operation_type:string,"
    " operation_date:string, operation_type_name:string, delivery_charge:string,"
    " return_delivery_charge:string, accruals_for_sale:string, sale_commission:string, amount:string,"
    " type:string, posting:struct<delivery_schema:string, order_date:string, posting_number:string,"
    " warehouse_id:bigint>, items:array<struct<name:string, sku:string>>,"
    " services:array<struct<name:string, price:double>>>>>"
)

# Realization by day: inner keys are not named by the source; this is our own two-level example.
REALIZATION_BY_DAY = (
    "error string, message string, rows array<struct<item:struct<offer_id:string, name:string, sku:bigint>,"
    " delivery_commission:struct<quantity:int, amount:double, bonus:double>,"
    " return_commission:struct<quantity:int, amount:double>, prices:array<double>>>"
)

PERFORMANCE_CAMPAIGNS = (
    "list array<struct<id:string, title:string, state:string, advObjectType:string, PaymentType:string,"
    " productCampaignMode:string, productAutopilotStrategy:string, placement:array<string>,"
    " createdAt:string>>"
)

CAMPAIGN_OBJECTS = "list array<struct<id:string>>"

# The 13 text metrics of the product statistics report.
PRODUCT_STATS_METRICS = ["dailyBudget", "weeklyBudget", "spending", "views", "clicks", "addToCart",
                         "averageRate", "average1000ViewsPrice", "ctr", "averageClickPrice",
                         "ordersCount", "ordersSum", "drr"]
PRODUCT_STATS_COLUMNS = ["campaignId", "date", *PRODUCT_STATS_METRICS]
PRODUCT_STATS = ", ".join(f"{m} string" for m in PRODUCT_STATS_COLUMNS)

ERP_PROFIT = as_text(
    "rows array<struct<assortment:struct<name:string, code:string, article:string, uom:struct<name:string>,"
    " meta:struct<href:string, uuidHref:string>>, sellQuantity:double, sellPrice:double, sellSum:double,"
    " sellCostSum:double, returnQuantity:double, returnSum:double, profit:double, margin:double,"
    " salesMargin:double>>"
)

ERP_STOCK = as_text(
    "stocks array<struct<moment:string, assortment:struct<type:string, code:string, name:string,"
    " gtin:string, brand:string, state:string, folder:string, volume:double>,"
    " stock:struct<stock:double, transit:double, reserve:double, quantity:double, days:double, cost:double>>>"
)

MONTHLY_SALES_SHEET = ("product_code string, ProductName string, ordered string, ordered_change string,"
                       " fbo_stock_end string")

# ---------------------------------------------------------------------------------------------------
# Sink table contracts: ordered (column, type). The column names and their order are the source's sink tables'.
# ---------------------------------------------------------------------------------------------------

CAMPAIGN_DATA_WB = [
    ("nmId", "bigint"), ("day", "timestamp_ntz"), ("name_product", "string"), ("views", "bigint"),
    ("clicks", "bigint"), ("sum", "double"), ("atbs", "bigint"), ("orders", "bigint"), ("shks", "bigint"),
    ("sum_price", "double"), ("advertId", "bigint"), ("Project", "string"), ("Marketplace", "string"),
    ("endTime", "date"), ("createTime", "date"), ("startTime", "date"), ("name_campaign", "string"),
    ("status", "string"), ("type", "string"), ("ordersCount", "bigint"), ("ordersSumRub", "double"),
    ("addToCartCount", "bigint"),
]
CAMPAIGN_DATA_WB_PERIOD = CAMPAIGN_DATA_WB[:19]

ORDER_HISTORY_WB = [
    ("nmID", "bigint"), ("vendorCode", "string"), ("brandName", "string"), ("objectID", "int"),
    ("objectName", "string"), ("begin", "timestamp_ntz"), ("openCardCount", "int"),
    ("addToCartCount", "int"), ("ordersCount", "int"), ("ordersSumRub", "double"), ("buyoutsCount", "int"),
    ("buyoutsSumRub", "double"), ("cancelCount", "int"), ("cancelSumRub", "double"), ("stocksMp", "int"),
    ("stocksWb", "int"), ("Project", "string"), ("Marketplace", "string"),
]

WAREHOUSE_DATA_WB = [
    ("warehouseName", "string"), ("quantity", "int"), ("brand", "string"), ("subjectName", "string"),
    ("vendorCode", "string"), ("inWayToClient", "int"), ("inWayFromClient", "int"),
    ("quantityWarehousesFull", "int"), ("Project", "string"), ("Date", "timestamp_ntz"),
    ("Marketplace", "string"),
]

ORDERS_WB = [
    ("date", "timestamp_ntz"), ("lastChangeDate", "timestamp_ntz"), ("warehouseName", "string"),
    ("warehouseType", "string"), ("countryName", "string"), ("oblastOkrugName", "string"),
    ("regionName", "string"), ("supplierArticle", "string"), ("nmId", "bigint"), ("barcode", "string"),
    ("category", "string"), ("subject", "string"), ("brand", "string"), ("techSize", "string"),
    ("incomeID", "bigint"), ("isSupply", "tinyint"), ("isRealization", "tinyint"), ("totalPrice", "double"),
    ("discountPercent", "tinyint"), ("spp", "tinyint"), ("finishedPrice", "double"),
    ("priceWithDisc", "double"), ("isCancel", "tinyint"), ("cancelDate", "timestamp_ntz"),
    ("orderType", "string"), ("sticker", "string"), ("gNumber", "string"), ("srid", "string"),
    ("Marketplace", "string"), ("Project", "string"),
]
ORDERS_WB_KEY = ["date", "srid", "nmId"]
ORDERS_WB_VERSION = "lastChangeDate"

WB_FINANCE = ([(c, _realization_type(c, False)) for c in REALIZATION_SOURCE_COLUMNS]
              + [("load_dt", "timestamp_ntz"), ("source", "string"), ("project", "string")])
WB_REALIZATION_REPORTS = WB_FINANCE[:-1]

OZON_FINANCE = [
    ("project", "string"), ("operation_id", "bigint"), ("operation_type", "string"),
    ("operation_date", "timestamp_ntz"), ("operation_type_name", "string"), ("delivery_charge", "double"),
    ("return_delivery_charge", "double"), ("accruals_for_sale", "double"), ("sale_commission", "double"),
    ("amount", "double"), ("type", "string"), ("posting_delivery_schema", "string"),
    ("posting_order_date", "timestamp_ntz"), ("posting_posting_number", "string"),
    ("posting_warehouse_id", "bigint"), ("item_name", "string"), ("item_sku", "bigint"),
    ("service_name", "string"), ("service_price", "double"),
]

STOCKS = [
    ("moment", "timestamp_ntz"), ("assortment_type", "string"), ("assortment_code", "string"),
    ("assortment_name", "string"), ("assortment_gtin", "string"), ("assortment_brand", "string"),
    ("assortment_state", "string"), ("assortment_folder", "string"), ("assortment_volume", "double"),
    ("stock_stock", "double"), ("stock_transit", "double"), ("stock_reserve", "double"),
    ("stock_quantity", "double"), ("stock_days", "double"), ("stock_cost", "double"),
    ("metadata_json", "string"),
]


# The load-audit table (SNK-11): one row per project response.
LOAD_AUDIT = [("API", "string"), ("Status Code", "int"), ("Status", "string"), ("Response Text", "string"),
              ("Date", "timestamp_ntz")]


def ddl(contract: list[tuple[str, str]]) -> str:
    """``CREATE TABLE`` column list for a contract (backticked, since ``sum``/``type`` are keywords)."""
    return ", ".join(f"`{c}` {t}" for c, t in contract)


def names(contract: list[tuple[str, str]]) -> list[str]:
    return [c for c, _ in contract]
