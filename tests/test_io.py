"""Round trips of readers and sinks, landed pages and the streaming upsert."""
import datetime as dt
import os
import tempfile
from decimal import Decimal


from pyspark.sql import functions as F

from branchlens.operators import incremental as I
from branchlens.schemas import PAYMENT, SALE
from branchlens.sources import documents as D
from branchlens.sources import fixtures as fx
from branchlens.sources import readers, sinks
from branchlens.streaming.upsert_stream import stream_upsert


def tmp():
    return tempfile.mkdtemp(prefix="branchlens-test-")


def test_raw_csv_without_branch_column(spark):
    d = tmp()
    with open(os.path.join(d, "ventas.csv"), "w") as f:
        f.write("sale_id,total,people,saleType,createdAt,closedAt,customer_id\n")
        f.write("1,10.5,2,EAT-IN,2025-01-03T23:30:00.000-03:00,2025-01-04T00:40:00.000-03:00,7\n")
        f.write("2,3,1,DELIVERY,2025-01-04T10:00:00-03:00,,\n")
    df = readers.read_raw_csv(spark, d, SALE)
    assert df.schema == SALE
    rows = sorted(df.collect())
    assert rows[0].branch is None and rows[0].created_at == dt.datetime(2025, 1, 3, 23, 30)
    assert rows[0].total == Decimal("10.50") and rows[1].closed_at is None and rows[1].customer_id is None


def test_missing_table_is_empty(spark):
    df = readers.read_or_empty(spark, os.path.join(tmp(), "absent.csv"), PAYMENT)
    assert df.count() == 0 and df.schema == PAYMENT


def test_sheet_reader(spark):
    d = tmp()
    with open(os.path.join(d, "sheet.csv"), "w") as f:
        f.write('Fecha Evento,Cliente ,Sucursal,Tipo de menu,PAX,Horario,valor persona (IVA NO INCLUIDO),Total,Estado\n')
        f.write('3/1/2025,JUAN perez,A,Menu 1,12,noche,"AR$ 1.000,00","AR$ 12.000,00",Ganado\n')
    from branchlens.operators.bookings import clean_bookings
    r = clean_bookings(readers.read_sheet(spark, d)).first()
    assert (r.event_date, r.client, r.guests, r.total, r.month) == ("2025-01-03", "Juan Perez", 12, 12000.0, "2025-01")


def test_versioned_table_upsert_reads_and_rewrites(spark):
    t = sinks.VersionedTable(spark, tmp() + "/payments")
    assert t.read() is None
    base = spark.createDataFrame([(str(i), Decimal(i), None, "m", None, "A") for i in range(5)], PAYMENT)
    t.publish(base)
    batch = spark.createDataFrame([("4", Decimal(40), None, "m", None, "A"), ("5", Decimal(5), None, "m", None, "A")],
                                  PAYMENT)
    t.publish(I.upsert(t.read(), batch, ["payment_id", "branch"]).drop("ingest_seq"))
    got = {r.payment_id: r.amount for r in t.read().collect()}
    assert got == {"0": 0, "1": 1, "2": 2, "3": 3, "4": 40, "5": 5}


def test_facts_partitioned_and_pruned(spark):
    d = tmp() + "/facts"
    df = spark.createDataFrame([("2025-01", 1), ("2025-02", 2)], "month string, v int")
    sinks.write_facts(df, d)
    sinks.write_facts(spark.createDataFrame([("2025-02", 3)], "month string, v int"), d)  # dynamic overwrite
    got = sorted((r.month, r.v) for r in readers.read_facts(spark, d).collect())
    assert got == [("2025-01", 1), ("2025-02", 3)]
    sinks.write_facts(df, d, dynamic=False)


def test_append_new_pairs(spark):
    d = tmp() + "/pairs"
    pairs = spark.createDataFrame([("a", "x"), ("b", "y")], "product string, category string")
    assert sinks.append_new_pairs(spark, pairs, d).count() == 2
    more = spark.createDataFrame([("a", "x"), ("c", "z")], "product string, category string")
    sinks.append_new_pairs(spark, more, d)
    assert sorted(tuple(r) for r in spark.read.parquet(d).collect()) == [("a", "x"), ("b", "y"), ("c", "z")]


def test_reports_and_split(spark):
    d = tmp()
    rep = spark.createDataFrame([("today", "A", "p", 2.0, 1.0), ("today", "A", "q", 1.0, 1.0)],
                                "report string, scope string, product string, qty double, revenue double")
    sinks.publish_reports(rep, d + "/reports")
    back = sinks.read_published(spark, d + "/reports").filter("report = 'today' AND scope = 'A'")
    assert back.count() == 2
    split = spark.createDataFrame([("p", "c", "accepted", None)], "product string, category string, status string, reason string")
    sinks.write_accepted_rejected(split, d + "/split")
    assert sinks.read_published(spark, d + "/split").count() == 1


def test_observed_counts(spark):
    df, obs = sinks.observe_counts(spark.range(7), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7


def test_landed_pages_round_trip(spark, sf_dir):
    sales, lines = fx.fx_sales(spark, sf_dir), fx.fx_lines(spark, sf_dir)
    d = tmp() + "/pages"
    D.write_pages(D.build_sales_pages(sales, lines), d)
    pages = D.read_pages(spark, d, D.SALES_PAGE)
    flat = D.flatten_sales(pages).drop("people", "stay_seconds", "landed_at")
    assert flat.exceptAll(sales).count() == 0 and sales.exceptAll(flat).count() == 0
    items = D.flatten_items(pages)
    assert items.count() == lines.count()


def test_stream_upsert_equals_batch(spark, sf_dir):
    ev = fx.fx_payments_ev(spark, sf_dir)
    old, new = fx.split_old_new(ev, "created_at", fx.EVENTS_SPLIT_DATE, "amount")
    streamed = stream_upsert(spark, [old.drop("ingest_seq"), new.drop("ingest_seq")], PAYMENT,
                             ["payment_id", "branch"], [], tmp(), files_per_trigger=1)
    batch = I.upsert(old.drop("ingest_seq"), new.drop("ingest_seq"), ["payment_id", "branch"])
    cols = [f.name for f in PAYMENT.fields]
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert streamed.count() == batch.count()


def test_pages_stay_bounded_with_hot_id(spark):
    import datetime as dt
    # one payment id re-delivered 3000 times next to 1000 ordinary ids
    rows = [("7", Decimal("1.00"), dt.datetime(2024, 1, 1), "m", False, "A")] * 3000 + \
           [(str(i), Decimal("1.00"), dt.datetime(2024, 1, 1), "m", False, "A") for i in range(1000, 2000)]
    pays = spark.createDataFrame(rows, PAYMENT)
    pages = D.parse_pages(D.build_payment_pages(pays, page_ids=500), D.PAYMENTS_PAGE)
    sizes = [r[0] for r in pages.select(F.size("page.data")).collect()]
    assert sum(sizes) == 4000
    assert max(sizes) <= 2 * 500 and len(sizes) >= 8
    assert D.flatten_payments(pages).count() == 4000


def test_read_mart_warns_when_empty(spark, caplog):
    d = tmp() + "/mart"
    spark.createDataFrame([], "branch string, revenue double").write.parquet(d)
    with caplog.at_level("WARNING", logger="branchlens"):
        assert readers.read_mart(spark, d, warn_if_empty=True).count() == 0
    assert "is empty" in caplog.text


def test_raw_lines_and_payments_csv(spark):
    from branchlens.schemas import LINE
    d = tmp()
    os.makedirs(f"{d}/items"); os.makedirs(f"{d}/pagos")
    with open(f"{d}/items/items.csv", "w") as f:
        f.write("sale_id,product_id,price,quantity,canceled,Sucursal\n")
        f.write("10,7,1500.5,2.0,False,A\n10,8,99,1,True,A\n11,7,10,1,,B\n")
    with open(f"{d}/pagos/pagos.csv", "w") as f:
        f.write("payment_id,amount,createdAt,paymentMethod,canceled\n")
        f.write("5,100.25,2025-01-03T23:30:00.000-03:00,12,False\n6,x,2025-01-04T00:10:00-03:00,3,True\n")
    lines = readers.read_raw_csv(spark, f"{d}/items", LINE)
    assert lines.schema == LINE
    got = sorted((r.sale_id, r.product_id, str(r.price), r.canceled, r.branch) for r in lines.collect())
    assert got == [("10", "7", "1500.50", False, "A"), ("10", "8", "99.00", True, "A"), ("11", "7", "10.00", None, "B")]
    pays = readers.read_raw_csv(spark, f"{d}/pagos", PAYMENT).orderBy("payment_id").collect()
    assert pays[0].amount == Decimal("100.25") and pays[0].method == "12" and pays[0].branch is None
    assert pays[0].created_at == dt.datetime(2025, 1, 3, 23, 30) and pays[1].amount is None
    from branchlens.operators.conform import live_payments
    assert [r.payment_id for r in live_payments(readers.read_raw_csv(spark, f"{d}/pagos", PAYMENT)).collect()] == ["5"]


def test_csv_as_written_by_a_data_frame_library(spark):
    """Quotes, separators and line ends inside cells survive."""
    import os
    import pandas as pd
    d = tmp()
    pd.DataFrame({"id": [1, 2], "name": ['Combo "XL", grande', "two\nlines, here"], "category": ["a", 'b "c"'],
                  "Sucursal": ["01", "02"]}).rename(columns={"id": "product_id", "name": "product_name",
                  "category": "product_category"}).to_csv(os.path.join(d, "p.csv"), index=False)
    from branchlens.schemas import PRODUCT
    rows = sorted(tuple(r) for r in readers.read_raw_csv(spark, d, PRODUCT).collect())
    assert rows == [("1", 'Combo "XL", grande', "a", "01"), ("2", "two\nlines, here", 'b "c"', "02")]


def test_report_scopes_keep_their_text(spark):
    d = tmp()
    rep = spark.createDataFrame([("today", "01", "p", 2.0, 1.0)],
                                "report string, scope string, product string, qty double, revenue double")
    sinks.publish_reports(rep, d + "/reports")
    assert sinks.read_published(spark, d + "/reports").first().scope == "01"


def test_stay_uses_instants(spark):
    import os
    from branchlens.operators.conform import dwell
    from branchlens.schemas import LANDED_SALE
    d = tmp()
    with open(os.path.join(d, "s.csv"), "w") as f:
        f.write("sale_id,total,saleType,createdAt,closedAt,Sucursal\n"
                "1,5,EAT-IN,2024-01-01T12:00:00-03:00,2024-01-01T16:00:00Z,A\n"
                "2,5,EAT-IN,2024-01-01T12:00:00-03:00,2024-01-01T12:10:00-03:00,A\n")
    out = dwell(readers.read_raw_csv(spark, d, LANDED_SALE)).collect()
    assert [(r.sale_id, r.dwell_seconds) for r in out] == [("1", 3600)]


def test_numbers_with_type_suffixes_and_oversized_amounts(spark):
    from branchlens.functions import semantics as S
    from branchlens.operators.bookings import booking_monthly, oversized_amounts
    row = spark.createDataFrame([("12d", "12f", "7.9", "1e30")], "a string, b string, c string, e string").select(
        S.parse_currency("a"), S.coerce_int("b"), S.numeric_id("a"), S.coerce_int("c"), S.numeric_id("c")).first()
    assert tuple(row) == (0.0, 0, None, 7, 7)
    clean = spark.createDataFrame([("A", "2024-01", "d", 1, 1e30), ("A", "2024-01", "d", 2, 2.5)],
                                  "branch string, month string, event_date string, guests int, total double")
    got = booking_monthly(clean).first()
    assert got.income == 1e30 + 2.5 and oversized_amounts(clean).count() == 1


def test_pages_are_filled_in_place_and_landed_compressed(spark, tmp_path):
    """No record is shuffled into its page, pages are bounded, and files are compressed."""
    import glob
    from pyspark.sql import functions as F
    from branchlens.sources import documents as D
    p = spark.range(1203).select(
        F.col("id").cast("string").alias("payment_id"), F.col("id").cast("decimal(18,2)").alias("amount"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("created_at"), F.lit('a"b,\\ñ').alias("method"),
        F.lit(None).cast("boolean").alias("canceled"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("B"), F.col("id") % 3)).alias("branch"))
    pages = D.build_payment_pages(p, 50)
    assert "Exchange" not in pages._jdf.queryExecution().executedPlan().toString()
    read = D.parse_pages(pages, D.PAYMENTS_PAGE)
    assert read.agg(F.max(F.size("page.data"))).first()[0] == 50
    D.write_pages(pages, f"{tmp_path}/landing")
    assert glob.glob(f"{tmp_path}/landing/branch=B1/*.gz")
    want = p.select("payment_id", "amount", "created_at", "method", "canceled", "branch")
    for got in (read, D.read_pages(spark, f"{tmp_path}/landing", D.PAYMENTS_PAGE)):
        got = D.flatten_payments(got).select(want.columns)
        assert got.count() == 1203 and got.exceptAll(want).count() == 0
