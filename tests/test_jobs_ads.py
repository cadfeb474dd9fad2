"""Advertising jobs (JOB-1 to JOB-7) on hand-written landed JSON."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from marketlens import schemas
from marketlens.operators.quality import reconcile_totals
from marketlens.plans import ads, funnel

STATS = [
    {"advertId": 100, "days": [
        {"date": "2024-03-01T23:30:00+03:00", "apps": [
            {"appType": 1, "nm": [{"nmId": 1, "name": "Кружка", "views": 10, "clicks": 2, "ctr": 20.0, "cpc": 5.0,
                                   "sum": 10.5, "atbs": 1, "orders": 1, "cr": 50.0, "shks": 1, "sum_price": 500.25}]},
            {"appType": 32, "nm": [{"nmId": 1, "name": None, "views": 5, "clicks": 1, "ctr": 20.0, "cpc": 3.0,
                                    "sum": 3.1, "atbs": 0, "orders": 0, "cr": 0.0, "shks": 0, "sum_price": 0.0},
                                   {"nmId": 2, "name": "Чайник", "views": 7}]}]},
        {"date": "2024-03-02T00:15:00+03:00", "apps": [{"appType": 1, "nm": []}]}]},
    {},
    {"advertId": 200, "days": [{"date": "2024-03-01T10:00:00", "apps": [
        {"appType": 1, "nm": [{"nmId": 1, "name": "Кружка", "views": 3, "clicks": 0, "sum": 1.0}]}]}]},
    {"advertId": 300, "days": [{"date": "2024-03-01T10:00:00", "apps": [
        {"appType": 1, "nm": [{"nmId": None, "views": 9}]}]}]},
]
DETAILS = [
    {"advertId": 100, "name": "Поиск", "status": 9, "type": 8, "createTime": "2024-02-29T23:50:00+03:00",
     "startTime": "01.03.2024", "endTime": "2024-03-31"},
    {"advertId": 300, "name": "X", "status": 42, "type": 4, "createTime": None, "startTime": "bad",
     "endTime": "2024-04-01 10:00:00"},
]
COUNTS = [{"adverts": [
    {"type": 8, "status": 9, "count": 2, "advert_list": [{"advertId": 100, "changeTime": "2024-03-01T10:00:00.123+03:00"},
                                                        {"advertId": 300, "changeTime": "bad"}]},
    {"type": 9, "status": 11, "count": 0, "advert_list": []}]}]
HISTORY = [
    {"error": False, "data": [
        {"nmID": 1, "imtName": "Кружка", "vendorCode": "K-1", "history": [
            {"dt": "2024-03-01", "ordersCount": 4, "ordersSumRub": 2000, "addToCartCount": 6},
            {"dt": "2024-03-02", "ordersCount": 1, "ordersSumRub": 500, "addToCartCount": 1}]},
        {"nmID": 5, "imtName": "Ложка", "vendorCode": "L-5", "history": [
            {"dt": "2024-03-01", "ordersCount": 2, "ordersSumRub": 100, "addToCartCount": 3}]}]},
    {"error": True, "errorText": "limit", "data": None},
]


def tenant(df):
    return df.withColumns({"Project": F.lit("P1"), "Marketplace": F.lit("Wildberries")})


def test_flatten_ad_stats_drops_empty_and_keeps_wall_clock(spark, landed):
    flat = ads.flatten_ad_stats(tenant(landed(STATS, schemas.AD_STATS)))
    got = rows(flat, "advertId", "nmId", "date", "views")
    assert len(got) == 5  # 4 products of record 100/200/300 plus the second app row; {} and [] give none
    assert (100, 1, dt.datetime(2024, 3, 1, 23, 30), 10) in got


def test_daily_fact_sums_means_first_and_null_keys(spark, landed):
    facts = ads.ad_daily_fact(ads.flatten_ad_stats(tenant(landed(STATS, schemas.AD_STATS))))
    got = {(r.advertId, r.nmId): r for r in facts.collect()}
    assert set(got) == {(100, 1), (100, 2), (200, 1)}  # the null product key is dropped
    a = got[(100, 1)]
    assert a.day == dt.date(2024, 3, 1) and a.date == dt.datetime(2024, 3, 1, 23, 30)
    assert a.name == "Кружка"  # first non-null name
    assert (a.views, a.clicks, a.atbs, a.orders, a.shks) == (15, 3, 1, 1, 1)
    assert (a.sum, a.sum_price) == (13.6, 500.25)
    assert (a.ctr, a.cpc, a.cr) == (20.0, 4.0, 25.0)
    b = got[(100, 2)]
    assert (b.views, b.clicks, b.sum, b.ctr) == (7, 0, 0.0, None)  # all-null sums are 0, means stay null
    ratio = ads.daily_ad_fact(ads.flatten_ad_stats(tenant(landed(STATS, schemas.AD_STATS))), ratio_of_sums=True)
    assert {r.nmId: r.ctr_of_sums for r in ratio.filter("advertId = 100").collect()} == {1: 20.0, 2: 0.0}


def test_campaign_list_and_dim(spark, landed):
    listed = ads.campaign_list(landed(COUNTS, schemas.CAMPAIGN_COUNTS, multi_line=True))
    assert rows(listed, "advertId", "type", "status", "count") == [(100, 8, 9, 2), (300, 8, 9, 2)]
    assert rows(listed, "changeTime")[0][0] == dt.datetime(2024, 3, 1, 10, 0, 0, 123000)
    recent = ads.campaign_list(landed(COUNTS, schemas.CAMPAIGN_COUNTS, multi_line=True), min_year=2024)
    assert rows(recent, "advertId") == [(100,)]  # the unparseable change time is not >= 2024
    dim = ads.campaign_dim(landed(DETAILS, schemas.CAMPAIGN_DETAILS), listed=listed)
    got = {r.advertId: r for r in dim.collect()}
    assert got[100].status == "Идут показы" and got[100].type == "Автоматическая кампания"
    assert got[100].createTime == dt.date(2024, 2, 29)  # wall clock, not the UTC day
    assert got[100].startTime == dt.date(2024, 3, 1) and got[100].endTime == dt.date(2024, 3, 31)
    assert got[300].status == "42" and got[300].startTime is None and got[300].createTime is None


def attributed(spark, landed):
    facts = ads.ad_daily_fact(ads.flatten_ad_stats(tenant(landed(STATS, schemas.AD_STATS))))
    dim = ads.campaign_dim(landed(DETAILS, schemas.CAMPAIGN_DETAILS))
    fwc = ads.ad_facts_with_campaign(facts, dim)
    orders = ads.product_day_orders_from_history(ads.flatten_history(landed(HISTORY, schemas.PRODUCT_HISTORY)))
    return facts, fwc, orders


def test_join_keeps_fact_rows_and_renames(spark, landed):
    facts, fwc, _ = attributed(spark, landed)
    assert fwc.count() == facts.count()  # conservation: the dimension is unique per advertId
    assert {"name_product", "name_campaign"} <= set(fwc.columns) and "ctr" not in fwc.columns
    period = ads.ad_period_fact(facts, ads.campaign_dim(landed(DETAILS, schemas.CAMPAIGN_DETAILS)))
    assert period.columns == schemas.names(schemas.CAMPAIGN_DATA_WB_PERIOD)
    missing = [r for r in fwc.collect() if r.advertId == 200][0]
    assert missing.name_campaign is None and missing.status is None


def test_orders_fact_fills_zero_and_fans_out(spark, landed):
    _, fwc, orders = attributed(spark, landed)
    out = ads.ad_orders_fact(fwc, orders)
    assert out.columns == schemas.names(schemas.CAMPAIGN_DATA_WB)
    got = {(r.advertId, r.nmId): r for r in out.collect()}
    assert (got[(100, 1)].ordersCount, got[(200, 1)].ordersCount) == (4, 4)  # repeated on both campaigns
    assert (got[(100, 2)].ordersCount, got[(100, 2)].ordersSumRub, got[(100, 2)].addToCartCount) == (0, 0, 0)
    assert got[(100, 1)].day == dt.datetime(2024, 3, 1)
    rec = reconcile_totals(orders, out, {"ordersCount": None, "ordersSumRub": 2}).first()
    assert (rec.ordersCount_before, rec.ordersCount_after, rec.ordersCount_diff) == (7, 8, 1)


def test_join_order_does_not_matter(spark, landed):
    """JON-5: orders first, then campaigns, gives the same rows as campaigns first."""
    facts, fwc, orders = attributed(spark, landed)
    a = ads.ad_orders_fact(fwc, orders)
    dim = ads.campaign_dim(landed(DETAILS, schemas.CAMPAIGN_DETAILS))
    orders_first = ads.left_join(facts, orders.select("nmId", "day", *ads.ORDER_METRICS), ["nmId", "day"])
    b = ads.ad_orders_fact(ads.ad_facts_with_campaign(orders_first.drop(*ads.ORDER_METRICS), dim), orders)
    assert rows(a) == rows(b)


def test_product_first_keeps_products_without_ads(spark, landed):
    _, fwc, orders = attributed(spark, landed)
    out = ads.product_first_fact(orders, fwc)
    got = rows(out, "nmId", "day", "advertId")
    assert got == [(1, dt.date(2024, 3, 1), 100), (1, dt.date(2024, 3, 1), 200),
                   (1, dt.date(2024, 3, 2), None), (5, dt.date(2024, 3, 1), None)]


def test_by_project_key(spark, landed):
    facts, fwc, orders = attributed(spark, landed)
    other = orders.withColumn("Project", F.lit("P2"))
    out = ads.ad_orders_fact(fwc, other, by_project=True)
    assert out.agg(F.sum("ordersCount")).first()[0] == 0


def test_funnel_daily_contract_and_upper(spark, landed):
    page = {"data": {"page": 1, "isNextPage": False, "cards": [
        {"nmID": 7, "vendorCode": "V7", "brandName": "бренд", "object": {"id": 3, "name": "Кружки"},
         "statistics": {"selectedPeriod": {"begin": "2024-03-01 00:00:00", "end": "2024-03-01 23:59:59",
                                           "openCardCount": 10, "ordersCount": 2, "ordersSumRub": 900,
                                           "conversions": {"addToCartPercent": 12.5}}},
         "stocks": {"stocksMp": 4, "stocksWb": 6}},
        {"nmID": 8, "vendorCode": "V8", "brandName": None, "object": None}]}}
    empty = {"data": {"page": 2, "isNextPage": False, "cards": []}}
    pages = tenant(landed([page, empty], schemas.FUNNEL_PAGE))
    flat = ads.flatten_funnel_cards(pages)
    assert len(flat.columns) == 22 + 2
    out = funnel.funnel_daily(pages)
    assert out.columns == schemas.names(schemas.ORDER_HISTORY_WB)
    got = {r.nmID: r for r in out.collect()}
    assert got[7].brandName == "БРЕНД" and got[7].begin == dt.datetime(2024, 3, 1) and got[7].stocksWb == 6
    assert got[8].brandName is None and got[8].objectID is None and got[8].ordersCount is None
    cards_orders = ads.product_day_orders_from_cards(flat)
    assert rows(cards_orders, "nmId", "day", "ordersCount")[0] == (7, dt.date(2024, 3, 1), 2)


def test_reload_ad_window_job(spark, landed, tmp_path):
    from marketlens.sinks import writers
    table = [*[(c, t) for c, t in schemas.CAMPAIGN_DATA_WB if c != "day"], ("day", "date")]
    target = writers.Target(str(tmp_path / "campaign_data_wb"), table, ("day",))
    writers.create_table(spark, target)
    flat = ads.flatten_ad_stats(tenant(landed(STATS, schemas.AD_STATS)))
    dim = ads.campaign_dim(landed(DETAILS, schemas.CAMPAIGN_DETAILS))
    orders = ads.product_day_orders_from_history(ads.flatten_history(landed(HISTORY, schemas.PRODUCT_HISTORY)))
    window = ads.reload_ad_window(spark, flat, dim, orders, target, today="2024-03-03", days=6)
    assert window == (dt.date(2024, 2, 26), dt.date(2024, 3, 2))
    out = writers.read(spark, target)
    assert out.count() == 3 and rows(out, "day")[0][0] == dt.date(2024, 3, 1)
    assert out.agg(F.sum("ordersCount")).first()[0] == 8
    ads.reload_ad_window(spark, flat, dim, orders, target, today="2024-03-03", days=6)
    assert writers.read(spark, target).count() == 3  # idempotent (re-read: the files were replaced)
