"""Stock, order, finance, performance, ERP, alert and audit jobs (JOB-8 to JOB-20) on landed JSON."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from marketlens import schemas
from marketlens.operators.quality import all_successful, load_audit
from marketlens.plans import ads, erp, finance, orders, performance, stock
from marketlens.sinks import writers
from marketlens.sources.landed import read_landed, read_report, split_corrupt

NOW = "2024-03-05 06:00:00"


def test_stock_snapshot(spark, landed):
    remains = [
        {"brand": "kitchenaid", "subjectName": "Миксеры", "vendorCode": "KA-1", "inWayToClient": 1, "inWayFromClient": 0,
         "quantityWarehousesFull": 12, "warehouses": [{"warehouseName": "Коледино", "quantity": 7},
                                                      {"warehouseName": "Казань", "quantity": 5}]},
        {"brand": None, "subjectName": "Ножи", "vendorCode": "N-2", "warehouses": [{"warehouseName": "Коледино",
                                                                                   "quantity": 3}]},
        {"brand": "x", "subjectName": "Пусто", "vendorCode": "E-3", "warehouses": []},
    ]
    df = landed(remains, schemas.WAREHOUSE_REMAINS).withColumn("Project", F.lit("P1"))
    out = stock.stock_snapshot(df, NOW)
    assert out.columns == schemas.names(schemas.WAREHOUSE_DATA_WB)
    got = rows(out, "warehouseName", "quantity", "brand", "inWayToClient", "Date", "Marketplace")
    ts = dt.datetime(2024, 3, 5, 6)
    assert got == [("Казань", 5, "KITCHENAID", 1, ts, "Wildberries"), ("Коледино", 3, "", None, ts, "Wildberries"),
                   ("Коледино", 7, "KITCHENAID", 1, ts, "Wildberries")]


def test_stock_load_is_all_or_nothing(spark, landed, tmp_path):
    remains = landed([{"brand": "b", "subjectName": "s", "vendorCode": "v",
                       "warehouses": [{"warehouseName": "w", "quantity": 1}]}], schemas.WAREHOUSE_REMAINS)
    target = writers.Target(str(tmp_path / "warehouse_data_wb"), schemas.WAREHOUSE_DATA_WB)
    writers.create_table(spark, target)
    resp = spark.createDataFrame([("P1", 200, "ok"), ("P2", 500, "fail")], "project string, status_code int, text string")
    assert not stock.load_stock_snapshot(spark, remains, load_audit(resp, NOW), target, NOW, ["P1", "P2"])
    assert writers.read(spark, target).count() == 0
    ok = load_audit(resp.filter("status_code = 200"), NOW)
    assert not stock.load_stock_snapshot(spark, remains, ok, target, NOW, ["P1", "P2"])  # P2 has no response
    assert not stock.load_stock_snapshot(spark, remains, ok.limit(0), target, NOW, ["P1"])
    assert stock.load_stock_snapshot(spark, remains, ok, target, NOW, ["P1"])
    assert writers.read(spark, target).count() == 1


def test_erp_stock_snapshot_json_keeps_nulls(spark, landed):
    payload = [{"stocks": [
        {"moment": "2024-03-01 10:00:00.000", "assortment": {"type": "product", "code": "A1", "name": "Товар",
                                                             "gtin": None, "brand": "B", "state": "active",
                                                             "folder": "F", "volume": 1.5},
         "stock": {"stock": 10, "transit": 0, "reserve": 1, "quantity": 9, "days": 30, "cost": 100.5}},
        {"moment": "2024-03-01 10:00:00.000", "assortment": {"type": "variant", "code": "A2"}}]}]
    out = stock.erp_stock_snapshot(landed(payload, schemas.ERP_STOCK, multi_line=True))
    assert out.columns == schemas.names(schemas.STOCKS)
    got = {r.assortment_code: r for r in out.collect()}
    assert got["A1"].stock_quantity == 9.0 and got["A1"].moment == dt.datetime(2024, 3, 1, 10)
    meta = json.loads(got["A2"].metadata_json)
    assert len(meta) == 15 and meta["assortment.name"] is None and meta["assortment.code"] == "A2"


def order(srid, date, change, price, cancel=False, cancel_date=None, nm=1):
    return {"date": date, "lastChangeDate": change, "srid": srid, "nmId": nm, "totalPrice": price,
            "isCancel": cancel, "isSupply": True, "cancelDate": cancel_date, "warehouseName": "Коледино"}


def test_orders_upsert_latest_version_and_high_water_mark(spark, landed, tmp_path):
    target = orders.orders_target(str(tmp_path / "orders_wb"))
    writers.create_table(spark, target)
    first = [order("s1", "2024-03-01T10:00:00", "2024-03-01T12:00:00", 100.0, cancel_date="0001-01-01T00:00:00"),
             order("s2", "2024-03-01T11:00:00", "2024-03-01T12:00:00", 50.0),
             order("s2", "2024-03-01T11:00:00", "2024-03-01T12:00:00", 55.0)]  # tied version
    orders.orders_upsert(spark, landed(first, schemas.SUPPLIER_ORDERS), target, project="P1")
    got = {r.srid: r for r in writers.read(spark, target).collect()}
    assert got["s1"].cancelDate == dt.datetime(2100, 1, 1) and got["s1"].isSupply == 1
    assert got["s2"].totalPrice == 55.0  # tie broken by the other columns, deterministically
    second = [order("s1", "2024-03-01T10:00:00", "2024-03-02T09:00:00", 90.0, True, "2024-03-02T09:00:00"),
              order("s1", "2024-03-01T10:00:00", "2024-03-01T12:00:00", 100.0),  # boundary row sent again
              order("s4", "2024-02-27T10:00:00", "2024-02-28T10:00:00", 10.0)]  # before the high-water mark
    orders.orders_upsert(spark, landed(second, schemas.SUPPLIER_ORDERS), target, project="P1")
    out = writers.read(spark, target)
    got = {r.srid: r for r in out.collect()}
    assert set(got) == {"s1", "s2"} and out.count() == 2
    assert (got["s1"].totalPrice, got["s1"].isCancel, got["s1"].cancelDate) == (90.0, 1, dt.datetime(2024, 3, 2, 9))
    assert out.columns[:30] == schemas.names(schemas.ORDERS_WB)


def test_realization_clean(spark, landed):
    rep = [{"realizationreport_id": 1, "rrd_id": 10, "date_from": "2024-02-26", "date_to": "2024-03-03",
            "create_dt": "2024-03-04T03:00:00+03:00", "subject_name": "", "brand_name": "Бренд", "srv_dbs": True,
            "is_legal_entity": None, "srid": "", "office_name": "Склад"},
           {"realizationreport_id": 1, "rrd_id": 11, "date_from": "", "srv_dbs": False, "is_legal_entity": True}]
    out = finance.realization_clean(landed(rep, schemas.REALIZATION_REPORT), NOW, project="P1")
    assert out.columns == schemas.names(schemas.WB_FINANCE) and len(out.columns) == 76
    got = {r.rrd_id: r for r in out.collect()}
    a, b = got[10], got[11]
    assert a.subject_name is None and a.srid is None and a.brand_name == "Бренд"
    assert a.create_dt == dt.datetime(2024, 3, 4, 3) and a.date_from == dt.datetime(2024, 2, 26)
    assert (a.srv_dbs, a.is_legal_entity, b.srv_dbs, b.is_legal_entity) == (1, None, 0, 1)
    assert b.date_from is None and a.load_dt == dt.datetime(2024, 3, 5, 6) and a.source == "WB-Realization-API"
    assert a.project == "P1" and a.ppvz_inn is None


def test_finance_operations_first_item_and_casts(spark, landed):
    ops = [{"result": {"operations": [
        {"operation_id": "12.7", "operation_type": "Delivered", "operation_date": "2024-03-01 10:00:00",
         "operation_type_name": "Доставка", "delivery_charge": "abc", "return_delivery_charge": None,
         "accruals_for_sale": "1500.50", "sale_commission": "-150", "amount": "1350.5", "type": "orders",
         "posting": {"delivery_schema": "FBO", "order_date": "2024-02-28 09:00:00", "posting_number": "P-1",
                     "warehouse_id": 77},
         "items": [{"name": "Кружка", "sku": "555"}, {"name": "Ложка", "sku": "556"}],
         "services": [{"name": "Доставка покупателю", "price": -50.0}]},
        {"operation_id": "x", "operation_type": "Claim", "operation_date": "bad", "items": [], "services": []}]}}]
    payload = landed(ops, schemas.FINANCE_OPERATIONS, multi_line=True)
    out = finance.finance_operations(payload, project="P1")
    assert out.columns == schemas.names(schemas.OZON_FINANCE)
    got = {r.operation_type: r for r in out.collect()}
    a, b = got["Delivered"], got["Claim"]
    assert (a.operation_id, a.delivery_charge, a.return_delivery_charge, a.accruals_for_sale) == (12, 0.0, 0.0, 1500.5)
    assert (a.item_name, a.item_sku, a.service_price, a.posting_warehouse_id) == ("Кружка", 555, -50.0, 77)
    assert a.posting_order_date == dt.datetime(2024, 2, 28, 9)
    assert (b.operation_id, b.operation_date, b.item_name, b.item_sku, b.posting_posting_number) == (0, None, None, 0, None)
    every = finance.finance_operations(payload, project="P1", all_items=True)
    assert rows(every, "item_name") == [("Кружка",), ("Ложка",), (None,)]


def test_realization_by_day_recursive(spark, landed):
    payloads = [{"day": "2024-03-05", "rows": [
        {"item": {"offer_id": "O1", "name": "Товар", "sku": 1},
         "delivery_commission": {"quantity": 2, "amount": 100.0, "bonus": 5.0}, "return_commission": None,
         "prices": [10.0, 20.0, 30.0]}]},
        {"day": "2024-03-06", "error": "ERR", "message": "limit"}]
    df = landed(payloads, "day date, " + schemas.REALIZATION_BY_DAY)
    out = finance.realization_by_day(df)
    assert out.count() == 1
    r = out.first()
    assert (r.item_offer_id, r.delivery_commission_bonus, r.return_commission_quantity) == ("O1", 5.0, None)
    assert (r.prices_0, r.prices_2, r.date) == (10.0, 30.0, "2024-3-5")
    declared = finance.realization_by_day(df, array_sizes={"prices": 2})
    assert declared.first().prices_2 == 30.0  # a declared size adds columns, it never cuts data
    wider = finance.realization_by_day(df, array_sizes={"prices": 5})
    assert "prices_4" in wider.columns and wider.first().prices_4 is None


def test_performance_campaign_dim_and_objects(spark, landed):
    camps = [{"list": [
        {"id": "1", "title": "A", "state": "CAMPAIGN_STATE_RUNNING", "advObjectType": "SKU", "PaymentType": "CPC",
         "productCampaignMode": "PRODUCT_CAMPAIGN_MODE_AUTO", "productAutopilotStrategy": "NEW_STRATEGY",
         "placement": ["PLACEMENT_PDP", "PLACEMENT_NEW"], "createdAt": "2024-09-15T10:00:00Z"},
        {"id": "2", "state": "X", "placement": [], "createdAt": "2024-08-31T23:59:59Z"}]}]
    out = performance.performance_campaign_dim(landed(camps, schemas.PERFORMANCE_CAMPAIGNS, multi_line=True),
                                               created_from="2024-09-01")
    r = out.collect()
    assert len(r) == 1 and r[0].state == "активная кампания" and r[0].productAutopilotStrategy is None
    assert r[0].placement == "карточка товара, PLACEMENT_NEW" and r[0].PaymentType == "за клики"
    objs = landed([{"campaign_id": "1", "list": [{"id": "a"}, {"id": "b"}]}, {"campaign_id": "2", "list": []}],
                  "campaign_id string, " + schemas.CAMPAIGN_OBJECTS)
    assert rows(performance.campaign_objects(objs)) == [("1", "a"), ("1", "b")]


def test_performance_stats_json_and_csv(spark, tmp_path):
    j = tmp_path / "rep.json"
    j.write_text(json.dumps([{"campaignId": "1", "date": "2024-03-01", "views": "100", "clicks": "5", "spending": "12,5"},
                             {"campaignId": "1", "date": "2024-03-01", "views": "50", "clicks": "x",
                              "spending": "7.25"}]))
    c = tmp_path / "rep.csv"
    c.write_text("campaignId,date,views,clicks,spending\n2,2024-03-01,10,1,3.5\n")
    rep = read_report(spark, json_path=str(j), csv_path=str(c))
    out = performance.performance_stats(rep)
    got = {r.campaignId: r for r in out.collect()}
    assert (got["1"].views, got["1"].clicks, got["1"].spending, got["1"].n_rows) == (150.0, 5.0, 7.25, 2)
    assert (got["2"].views, got["2"].spending, got["2"].day) == (10.0, 3.5, dt.date(2024, 3, 1))


def test_erp_profit_uuid(spark, landed):
    payload = [{"rows": [
        {"assortment": {"name": "Товар", "code": "C1", "article": "A1", "uom": {"name": "шт"},
                        "meta": {"href": "https://h/1", "uuidHref": "https://h/app/#good/edit?id=uuid-1"}},
         "sellQuantity": 2, "profit": 10.0},
        {"assortment": {"name": "Без меты"}, "profit": 5.0},
        {"assortment": {"meta": {"uuidHref": "https://h/no-marker"}}}]}]
    out = erp.erp_profit(landed(payload, schemas.ERP_PROFIT, multi_line=True))
    assert len(out.columns) == 15
    assert rows(out, "product_name", "product_uuid", "product_uom") == [
        ("Без меты", None, None), ("Товар", "uuid-1", "шт"), (None, "https://h/no-marker", None)]


def test_stock_alerts_from_sheet(spark, tmp_path):
    p = tmp_path / "sheet.csv"
    p.write_text("product_code,ProductName,ordered,ordered_change,fbo_stock_end\n1,A,10,-0.6,0\n2,B,3,-0.9,5\n"
                 "3,C,8,-0.2,n/a\n4,D,6,-0.51,0.0\n")
    sheet = spark.read.option("header", True).schema(schemas.MONTHLY_SALES_SHEET).csv(str(p))
    assert rows(stock.stock_alert_out_of_stock(sheet), "product_code") == [("1",), ("4",)]
    assert rows(stock.sheet_falling_sales(sheet), "product_code") == [("1",), ("4",)]


def test_falling_sales_does_not_bridge_gaps(spark):
    weekly = spark.createDataFrame([(1, dt.date(2024, 1, 1), 20), (1, dt.date(2024, 1, 15), 6),
                                    (2, dt.date(2024, 1, 1), 20), (2, dt.date(2024, 1, 8), 6),
                                    (3, dt.date(2024, 1, 1), 0), (3, dt.date(2024, 1, 8), 6)],
                                   "p int, week date, ordered bigint")
    out = stock.stock_alert_falling_sales(weekly, ["p"], "week", "ordered", lambda w: F.date_sub(w, 7))
    assert rows(out, "p", "change") == [(2, -0.7)]  # product 1 skipped a week; product 3 had 0 before


def test_load_audit(spark):
    resp = spark.createDataFrame([("P1", 200, "ok"), ("P2", 429, "too many")], "project string, status_code int, text string")
    audit = load_audit(resp, NOW)
    assert audit.columns == schemas.names(schemas.LOAD_AUDIT)
    assert rows(audit, "API", "Status Code", "Status") == [("P1", 200, "Successful"), ("P2", 429, "Error")]
    one = audit.filter("API = 'P1'")
    assert not all_successful(audit, ["P1", "P2"]) and all_successful(one, ["P1"])
    assert not all_successful(one, ["P1", "P2"]) and not all_successful(audit.limit(0), ["P1"]) and not all_successful(one, [])


def test_history_csv_binds_by_header(spark, tmp_path):
    from marketlens.sources.landed import read_history
    p = tmp_path / "hist.csv"
    p.write_text("quantity,warehouseName,extra\n7,Коледино,x\nbad,Казань,y\n")
    out = read_history(spark, str(p), "csv", [("warehouseName", "string"), ("quantity", "int"), ("brand", "string")])
    assert rows(out) == [("Казань", None, None), ("Коледино", 7, None)]


def test_report_folder_with_json_and_csv(spark, tmp_path):
    from marketlens.sources.landed import read_report_folder
    d = tmp_path / "reports" / "day=2024-03-01"
    d.mkdir(parents=True)
    (d / "c1.json").write_text(json.dumps([{"campaignId": "1", "date": "2024-03-01", "views": "5"}]))
    (d / "c2.csv").write_text("views,campaignId,date\n7,2,2024-03-01\n")
    out = performance.performance_stats(read_report_folder(spark, str(tmp_path / "reports")))
    assert rows(out, "campaignId", "views") == [("1", 5.0), ("2", 7.0)]


def test_numbers_sent_as_json_numbers_or_text_both_survive(spark, landed):
    """Fields that may arrive as text are declared string: a JSON number read into a string field keeps its
    value, where a bigint field would turn the text form into null (the trap the schema avoids)."""
    ops = [{"result": {"operations": [
        {"operation_id": 123, "operation_type": "a", "amount": 10.5, "items": [{"name": "x", "sku": 77}]},
        {"operation_id": "124", "operation_type": "b", "amount": "11.25", "items": [{"name": "y", "sku": "78"}]}]}}]
    out = finance.finance_operations(landed(ops, schemas.FINANCE_OPERATIONS, multi_line=True))
    assert rows(out, "operation_type", "operation_id", "amount", "item_sku") == [("a", 123, 10.5, 77),
                                                                              ("b", 124, 11.25, 78)]
    history = [{"error": False, "data": [{"nmID": "5", "history": [{"dt": "2024-03-01", "ordersCount": "3", "ordersSumRub": 1234.5},
                                                                   {"dt": "2024-03-02", "ordersCount": 2.0, "ordersSumRub": "n/a"}]}]}]
    got = ads.flatten_history(landed(history, schemas.PRODUCT_HISTORY))
    assert rows(got, "nmID", "dt", "ordersCount", "ordersSumRub") == [(5, "2024-03-01", 3, 1234.5), (5, "2024-03-02", 2, None)]
    report = landed([{"rrd_id": 2**60 + 1, "quantity": 2.0, "sale_percent": 12.5, "srv_dbs": True}], schemas.REALIZATION_REPORT)
    (r,) = finance.realization_clean(report, NOW).collect()
    assert (r.rrd_id, r.quantity, r.sale_percent, r.srv_dbs) == (2**60 + 1, 2, 12.5, 1)


def test_truncated_page_stops_the_load_or_reaches_the_audit(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"list": [{"id": "1"}, {"id": "2"}]}')
    (tmp_path / "b.json").write_text('{"list": [{"id": "3"}, {"id')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        read_landed(spark, str(tmp_path), schemas.CAMPAIGN_OBJECTS).collect()
    sound, damaged = split_corrupt(read_landed(spark, str(tmp_path), schemas.CAMPAIGN_OBJECTS, keep_corrupt=True))
    assert [[x.id for x in r.list] for r in sound.collect()] == [["1", "2"]]
    assert [r[0] for r in damaged.collect()] == ['{"list": [{"id": "3"}, {"id']
    (tmp_path / "c.json").write_text('[{"list": [{"id": "5"}]}, {"list": null}]')
    (tmp_path / "d.json").write_text('[{"list": [')
    (tmp_path / "e.json").write_text("[]")
    sound, damaged = split_corrupt(read_landed(spark, str(tmp_path), schemas.CAMPAIGN_OBJECTS, keep_corrupt=True))
    assert sound.count() == 3 and sorted(r[0] for r in damaged.collect()) == ['[{"list": [', '{"list": [{"id": "3"}, {"id']


def test_performance_stats_sum_only_what_adds_up(spark):
    report = spark.createDataFrame([("1", "2024-03-01", "100", "10", "50", "10.5", "0.004", "100"), ("1", "2024-03-01", "300", "30", "90", "12", "0.004", None)],
                                   "campaignId string, date string, views string, clicks string, spending string, averageClickPrice string, drr string, dailyBudget string")
    (r,) = performance.performance_stats(report).collect()
    assert (r.views, r.clicks, r.spending, r.averageClickPrice, r.dailyBudget, r.n_rows) == (400, 40, 140, 3.5, 100, 2)
    assert "drr" not in r  # without the order sum there is no ratio to give


def test_erp_json_keeps_keys_beyond_the_contract(spark):
    schema = schemas.ERP_STOCK.replace("struct<moment:string,", "struct<moment:string, uom:string, prices:array<string>,")
    payload = spark.createDataFrame(['{"stocks": [{"moment": "2024-03-01 10:00:00", "uom": "pcs", "prices": [1, 2.5], "assortment": {"code": "A"}}]}'], "string")
    out = stock.erp_stock_snapshot(payload.select(F.from_json("value", schema).alias("d")).select("d.*"))
    meta = json.loads(out.first().metadata_json)
    assert meta["uom"] == "pcs" and meta["prices"] == ["1", "2.5"] and meta["assortment.code"] == "A" and meta["stock.cost"] is None


def test_orders_upsert_keeps_a_mark_for_each_project(spark, landed, tmp_path):
    target = orders.orders_target(str(tmp_path / "orders_wb"))
    writers.create_table(spark, target)
    row = lambda srid, changed, price=1.0: {"date": "2024-02-01T10:00:00", "lastChangeDate": changed, "srid": srid, "nmId": 1, "totalPrice": price}
    load = lambda recs, project: orders.orders_upsert(spark, landed(recs, schemas.SUPPLIER_ORDERS), target, project=project)
    load([row("a", "2024-02-02T00:00:00"), row("bad", "not a date")], "A")
    load([row("b", "2024-02-01T00:00:00")], "B")  # older than A's mark
    load([row("a", "2024-02-01T12:00:00", 9.0), row("a2", "2024-02-03T00:00:00"), row("bad2", None)], "A")
    load([row("b", "2024-02-01T00:00:00")], "B")  # repeated
    got = rows(writers.read(spark, target), "Project", "srid", "totalPrice")
    assert got == [("A", "a", 1.0), ("A", "a2", 1.0), ("A", "bad", 1.0), ("A", "bad2", 1.0), ("B", "b", 1.0)]
    assert rows(orders.high_water_marks(spark, target), "Project") == [("A",), ("B",)]
    scans = writers.read(spark, orders.marks_target(target))
    assert scans.count() == 2  # a row for each project, whatever the number of loads


def test_first_item_of_an_operation_with_many_items(spark, landed):
    items = [{"name": f"i{k}", "sku": str(k)} for k in range(1000)]
    ops = [{"result": {"operations": [{"operation_id": 1, "items": items}, {"operation_id": 2, "items": []}]}}]
    out = finance.finance_operations(landed(ops, schemas.FINANCE_OPERATIONS))
    assert rows(out, "operation_id", "item_name", "item_sku") == [(1, "i0", 0), (2, None, 0)]
