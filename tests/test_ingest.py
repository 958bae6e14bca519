"""Landing -> raw: bootstrap from the old slice, then one incremental run over all pages."""
import tempfile

import pytest
from pyspark.sql import functions as F

from branchlens.functions.semantics import numeric_id
from branchlens.operators import incremental as I
from branchlens.plans import ingest
from branchlens.sources import documents as D
from branchlens.sources import fixtures as fx


def land(spark, sf_dir, sales, lines, payments, catalog, folder):
    D.write_pages(D.build_sales_pages(sales, lines), f"{folder}/sales")
    D.write_pages(D.build_payment_pages(payments), f"{folder}/payments")
    D.write_pages(D.build_product_pages(catalog), f"{folder}/products")
    D.write_pages(D.build_category_pages(catalog), f"{folder}/categories")


def test_bootstrap_then_incremental(spark, sf_dir):
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    sales, lines = fx.fx_sales(spark, sf_dir), fx.fx_lines(spark, sf_dir).drop("line_number", "ship_date")
    pays, cat = fx.fx_payments_ev(spark, sf_dir), fx.fx_catalog(spark, sf_dir)
    old_sales = sales.filter(F.col("created_at") < F.lit(fx.SPLIT_DATE))
    old_lines = lines.join(old_sales.select("sale_id", "branch"), ["sale_id", "branch"], "left_semi")
    old_pays = pays.filter(F.col("created_at") < F.lit(fx.EVENTS_SPLIT_DATE))
    land(spark, sf_dir, old_sales, old_lines, old_pays, cat, f"{root}/landing0")
    land(spark, sf_dir, sales, lines, pays, cat.withColumn("product_name", F.upper("product_name")),
         f"{root}/landing1")

    counts = ingest.bootstrap(spark, f"{root}/landing0", f"{root}/raw")
    assert counts == {"sales": old_sales.count(), "lines": old_lines.count(), "payments": old_pays.count(),
                      "products": cat.filter("product_category IS NOT NULL").count(), "rejected_pages": 0}

    # the lookback tail are the sales that landed last, so the marks follow the landing order
    table = ingest.raw_store(spark, f"{root}/raw").read
    s_marks, p_marks = (spark.createDataFrame(m.collect(), m.schema)
                        for m in I.incremental_marks(table("sales"), table("payments")))
    got = ingest.incremental(spark, f"{root}/landing1", f"{root}/raw", seq=1)
    sel_sales = I.select_after_marks(sales, s_marks, "sale_id")
    sel_pays = I.select_after_marks(pays, p_marks, "payment_id")
    assert got["sales"] == sel_sales.count() > 0 and got["payments"] == sel_pays.count() > 0
    assert got["products"] == cat.count()

    raw_sales = table("sales")
    keys = ["sale_id", "branch"]
    assert raw_sales.groupBy(*keys).count().filter("count > 1").count() == 0
    assert raw_sales.count() == old_sales.select(*keys).union(sel_sales.select(*keys)).distinct().count()
    # re-fetched sales of the lookback tail were replaced by the newer run
    assert raw_sales.filter("ingest_seq = 1").count() == sel_sales.count()
    raw_pays = table("payments")
    assert raw_pays.count() == old_pays.select("payment_id").union(sel_pays.select("payment_id")).distinct().count()
    raw_lines = table("lines")
    assert raw_lines.join(sel_sales.select(*keys), keys, "left_semi").count() \
        == lines.join(sel_sales.select(*keys), keys, "left_semi").select("sale_id", "product_id", "branch").distinct().count()
    raw_products = table("products")
    assert raw_products.count() == cat.count()  # refreshed: uncategorised products now present
    assert raw_products.filter(F.col("product_name") != F.upper("product_name")).count() == 0
    assert raw_sales.agg(F.max(numeric_id("sale_id"))).first()[0] == sales.agg(F.max(numeric_id("sale_id"))).first()[0]


# ---------------------------------------------------------------- small landings by hand

def page(**doc):
    import json
    return json.dumps(doc)


def sale(i, total=10.0, branch_closed="2024-01-01T13:00:00.000000-03:00", created="2024-01-01T12:00:00.000000-03:00"):
    return {"id": str(i), "attributes": {"total": total, "people": 2, "saleType": "EAT-IN", "createdAt": created,
                                         "closedAt": branch_closed}, "relationships": {}}


def item(s, p, price=5.0):
    return {"attributes": {"price": price, "quantity": 1.0, "canceled": False},
            "relationships": {"sale": {"data": {"id": str(s)}}, "product": {"data": {"id": str(p)}}}}


def payment(i, amount=1.0):
    return {"id": str(i), "attributes": {"amount": amount, "createdAt": "2024-01-01T12:00:00.000000-03:00",
                                         "canceled": False}, "relationships": {"paymentMethod": {"data": {"id": "m"}}}}


def write(folder, feed, pages, branch="01"):
    import os
    d = f"{folder}/{feed}/branch={branch}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/page-{len(os.listdir(d)):05d}.json", "w") as f:
        f.write("\n".join(pages) + "\n")


def landing(folder, n, branch="01", extra=()):
    write(folder, "sales", [page(data=[sale(i) for i in range(1, n + 1)],
                                 included=[item(i, 7) for i in range(1, n + 1)]), *extra], branch)
    write(folder, "payments", [page(data=[payment(i) for i in range(1, n + 1)])], branch)
    write(folder, "products", [page(data=[{"id": "7", "attributes": {"name": "Flan"}}])], branch)
    write(folder, "categories", [page(data=[{"id": "c", "attributes": {"name": "Dulces"}, "relationships": {
        "products": {"data": [{"id": "7"}]}}}])], branch)


def counts(spark, raw):
    store = ingest.raw_store(spark, raw)
    at = store.snapshot()
    return {n: store.read(n, at).count() for n in ("sales", "lines", "payments", "products")}


def test_incremental_keeps_all_lines_and_can_run_again(spark):
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    landing(f"{root}/l0", 100)
    landing(f"{root}/l1", 300)
    ingest.bootstrap(spark, f"{root}/l0", f"{root}/raw")
    assert counts(spark, f"{root}/raw") == {"sales": 100, "lines": 100, "payments": 100, "products": 1}
    first = ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)
    assert first["sales"] == first["lines"] == 220 and first["payments"] == 200  # 20 rows of lookback
    want = {"sales": 300, "lines": 300, "payments": 300, "products": 1}
    assert counts(spark, f"{root}/raw") == want
    again = ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 2)
    assert again["payments"] == 0 and counts(spark, f"{root}/raw") == want
    assert {r.branch for r in ingest.raw_store(spark, f"{root}/raw").read("products").collect()} == {"01"}


def test_bootstrap_with_repeated_sale_null_branch_and_corrupt_page(spark):
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    twice = page(data=[sale(1, 99.0), sale(2)], included=[])
    landing(f"{root}/l", 10, extra=[twice, '{"data": [{"id": "11", "attr'])
    landing(f"{root}/l", 5, branch="__HIVE_DEFAULT_PARTITION__")
    got = ingest.bootstrap(spark, f"{root}/l", f"{root}/raw")
    assert got == {"sales": 17, "lines": 15, "payments": 15, "products": 2, "rejected_pages": 1}
    lines = ingest.raw_store(spark, f"{root}/raw").read("lines")
    assert lines.filter("month = '2024-01'").count() == 15 and lines.filter("branch IS NULL").count() == 5


def test_last_delivery_wins(spark):
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    landing(f"{root}/l0", 1)
    ingest.bootstrap(spark, f"{root}/l0", f"{root}/raw")
    write(f"{root}/l1", "sales", [page(data=[sale(50), sale(50, 7.0)], included=[item(50, 7, 50.0), item(50, 7, 20.0)])])
    landing(f"{root}/l1", 1)
    ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)
    line = ingest.raw_store(spark, f"{root}/raw").read("lines").filter("sale_id = '50'").collect()
    assert [float(r.price) for r in line] == [20.0]
    one = ingest.raw_store(spark, f"{root}/raw").read("sales").filter("sale_id = '50'").collect()
    assert [float(r.total) for r in one] == [7.0]


def dies_at(monkeypatch, table):
    """A run that is killed while it writes ``table``."""
    from branchlens.sources.snapshots import SnapshotStore
    write = SnapshotStore.write

    def dies(self, name, df, gone):
        change = write(self, name, df, gone)
        if name == table:
            raise KeyboardInterrupt
        return change
    monkeypatch.setattr(SnapshotStore, "write", dies)
    return lambda: monkeypatch.setattr(SnapshotStore, "write", write)


def test_run_that_died_has_changed_nothing(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    landing(f"{root}/l0", 30)
    landing(f"{root}/l1", 60)
    ingest.bootstrap(spark, f"{root}/l0", f"{root}/raw")
    before = counts(spark, f"{root}/raw")
    heal = dies_at(monkeypatch, "payments")
    with pytest.raises(KeyboardInterrupt):
        ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)
    heal()
    assert counts(spark, f"{root}/raw") == before
    ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)
    assert counts(spark, f"{root}/raw") == {"sales": 60, "lines": 60, "payments": 60, "products": 1}
    # a number that is published is not run again, an older one is refused
    assert ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)["sales"] == 50
    with pytest.raises(ValueError):
        ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 0)


def test_bootstrap_after_a_dead_upsert_is_not_undone(spark, monkeypatch):
    """The operator rebuilds after a run that died; nothing of that run comes back, even if
    the scratch folder is cleaned between the runs."""
    import shutil
    from branchlens.session import checkpoint_dir
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    landing(f"{root}/l0", 2)
    landing(f"{root}/l1", 40)
    ingest.bootstrap(spark, f"{root}/l0", f"{root}/raw")
    heal = dies_at(monkeypatch, "sales")
    with pytest.raises(KeyboardInterrupt):
        ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)
    heal()
    for name in __import__("os").listdir(checkpoint_dir(spark)):
        if name.startswith("ingest-"):
            shutil.rmtree(f"{checkpoint_dir(spark)}/{name}")
    write(f"{root}/l2", "sales", [page(data=[sale(i, 77.0) for i in range(1, 4)], included=[])])
    write(f"{root}/l2", "payments", [page(data=[payment(1)])])
    write(f"{root}/l2", "products", [page(data=[])])
    write(f"{root}/l2", "categories", [page(data=[])])
    ingest.bootstrap(spark, f"{root}/l2", f"{root}/raw")
    ingest.incremental(spark, f"{root}/l2", f"{root}/raw", 1)
    rows = ingest.raw_store(spark, f"{root}/raw").read("sales").collect()
    assert sorted((r.sale_id, float(r.total)) for r in rows) == [("1", 77.0), ("2", 77.0), ("3", 77.0)]


def test_readers_see_one_version_of_all_tables(spark):
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    landing(f"{root}/l0", 30)
    landing(f"{root}/l1", 90)
    ingest.bootstrap(spark, f"{root}/l0", f"{root}/raw")
    store = ingest.raw_store(spark, f"{root}/raw")
    at = store.snapshot()
    early = {n: store.read(n, at) for n in ("sales", "lines")}
    ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)
    assert [early[n].count() for n in early] == [30, 30]  # planned before, run after the upsert
    assert [store.read(n, store.snapshot(at.version)).count() for n in early] == [30, 30]
    assert [store.read(n).count() for n in early] == [90, 90]


def test_single_record_documents_equal_pages(spark):
    """An incremental run over one document per sale and payment gives the rows of pages."""
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    landing(f"{root}/l0", 5)
    landing(f"{root}/pages", 30)
    landing(f"{root}/single", 0)
    for i in range(1, 31):
        only = [{**item(i, 7), "relationships": {"product": {"data": {"id": "7"}}}}]
        write(f"{root}/single", "sales", [page(data=sale(i), included=only)])
        write(f"{root}/single", "payments", [page(data=payment(i))])
    write(f"{root}/single", "sales", ['{"data": {"id": "1', page(data=None), page(errors=["gone"])])
    got, rows = {}, {}
    for form in ("pages", "single"):
        raw = f"{root}/raw-{form}"
        ingest.bootstrap(spark, f"{root}/l0", raw)
        got[form] = ingest.incremental(spark, f"{root}/{form}", raw, 1)
        store = ingest.raw_store(spark, raw)
        rows[form] = {n: sorted(map(str, store.read(n).drop("landed_at").collect())) for n in ingest.KEYS}
    assert rows["pages"] == rows["single"]
    assert got["single"] == {**got["pages"], "rejected_pages": 1}
    bad = ingest.raw_store(spark, f"{root}/raw-single").read("rejects").collect()
    assert [(r.feed, r.branch, r.run) for r in bad] == [("sales", "01", "1")]


def test_sale_that_moves_to_another_month(spark):
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    landing(f"{root}/l0", 30)
    moved = sale(30, 5.0, created="2024-02-03T12:00:00.000000-03:00", branch_closed="2024-02-03T13:00:00.000000-03:00")
    landing(f"{root}/l1", 29)
    write(f"{root}/l1", "sales", [page(data=[moved], included=[item(30, 7, 9.0)])])
    ingest.bootstrap(spark, f"{root}/l0", f"{root}/raw")
    ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)
    store = ingest.raw_store(spark, f"{root}/raw")
    assert [(r.month, float(r.total)) for r in store.read("sales").filter("sale_id = '30'").collect()] == [("2024-02", 5.0)]
    assert [(r.month, float(r.price)) for r in store.read("lines").filter("sale_id = '30'").collect()] == [("2024-02", 9.0)]
    assert store.read("sales").count() == 30


def test_configured_branches_have_a_mark(spark):
    root = tempfile.mkdtemp(prefix="branchlens-ingest-")
    landing(f"{root}/l0", 30)
    ingest.bootstrap(spark, f"{root}/l0", f"{root}/raw")
    landing(f"{root}/l1", 3, branch="02")
    ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1, branches=["01", "02", "03"])
    marks = ingest.raw_store(spark, f"{root}/raw").read("marks").collect()
    assert {(r.source, r.branch): r.last_id for r in marks} == {
        ("sales", "01"): 10, ("sales", "02"): 0, ("sales", "03"): 0,
        ("payments", "01"): 30, ("payments", "02"): 0, ("payments", "03"): 0}


def test_single_record_documents(spark):
    import json
    one = sale(9, 30.0)
    it = [{**item(0, 7), "relationships": {"product": {"data": {"id": "7"}}}}]
    docs = spark.createDataFrame([("A", json.dumps({"data": one, "included": it})), ("A", json.dumps({"data": sale(10)}))],
                                 "branch string, doc string")
    parsed = D.parse_pages(docs, D.SALE_DOC)
    assert [(r.sale_id, float(r.total), r.stay_seconds) for r in D.flatten_sale_docs(parsed).collect()] == \
        [("9", 30.0, 3600), ("10", 10.0, 3600)]
    assert [(r.sale_id, r.product_id) for r in D.flatten_sale_doc_items(parsed).collect()] == [("9", "7")]
    pays = D.parse_pages(spark.createDataFrame([("A", json.dumps({"data": payment(4)}))], "branch string, doc string"),
                         D.PAYMENT_DOC)
    assert [(r.payment_id, r.method) for r in D.flatten_payment_docs(pays).collect()] == [("4", "m")]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_deliveries_do_not_bind_the_tables_anew(spark, sf_dir):
    """Every delivery takes its sales and lines from rows written once (F18, F19)."""
    from branchlens.plans import raw_queries
    from branchlens.plans.catalog import Inputs
    x = Inputs(spark, sf_dir)
    first, second = raw_queries.deliveries(x)
    batches = raw_queries.mart_batches(x)
    for d in (first, second, *batches):
        for name in ("sales", "lines"):
            assert "o_orderkey" not in _plan(d[name]) and "l_orderkey" not in _plan(d[name])
    assert second["sales"].count() == x.sales.count() == batches[1]["sales"].count() + batches[2]["sales"].count()
    assert 0 < first["lines"].count() < second["lines"].count() == x.lines.select("sale_id", "product_id", "branch").distinct().count()


def test_documents_of_one_record_are_not_tried_as_pages(spark):
    """Text that begins like a document of one record is parsed once (F18); what is read stays."""
    texts = {
        "page": '{"data":[{"id":"1"},{"id":"2"}],"included":[]}', "page, later record": '{"included":[],"data":[{"id":"3"}]}',
        "one": '{"data":{"id":"4"}}', "one, spaces": ' \t{ "data"\t: {"id":"5"} , "included":[]}',
        "one, other order": '{"included":[],"data":{"id":"6"}}', "one, quotes": "{'data':{'id':'7'}}",
        "both": '{"data":{"id":"8"},"data":[{"id":"9"}]}', "page text in a page": '{"data":[{"id":"{\\"data\\":{"}]}',
        "cut": '{"data":{"id":"10"', "cut page": '{"data":[{"id":"11"', "text": "data", "form feed": '\f{"data":{"id":"12"}}',
        "empty object": '{"data":{}}', "nothing": "{}", "null": '{"data":null}',
    }
    folder = tempfile.mkdtemp(prefix="branchlens-forms-")
    spark.createDataFrame([(t, "A") for t in texts.values()], "value string, branch string") \
        .write.mode("overwrite").partitionBy("branch").text(folder)
    got = D.parse_feed(spark, folder, "sales")
    assert "RLIKE" in _plan(got)
    lines = spark.read.schema("value string, branch string").text(folder)
    corrupt = D._CORRUPT
    both = lines.select("value", D._parsed("value", D.SALES_PAGE).alias("p"), D._parsed("value", D.SALE_DOC).alias("o")).select(
        "value", (F.col("p").isNotNull() & F.col(f"p.{corrupt}").isNull()).alias("page"),
        (F.col("o").isNotNull() & F.col(f"o.{corrupt}").isNull()).alias("one"), F.col("p.data.id").alias("ids"),
        F.when(F.col("o.data").isNotNull(), F.array("o.data.id")).alias("id"))
    want = sorted([(None if r.page or r.one else r.value, r.page or r.one, (r.ids if r.page else r.id) if r.page or r.one else None)
                   for r in both.collect()], key=repr)
    found = sorted([(r.doc, r.page is not None, r.page and (r.page.data and [s.id for s in r.page.data]))
                    for r in got.collect()], key=repr)
    assert found == want
    assert len([r for r in found if r[0] is not None]) >= 3
