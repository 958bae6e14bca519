"""Marts kept up to date by deltas: a refresh costs what has changed, not what there is.

The raw tables are snapshots, so the months that changed since the last refresh are those
whose folders differ between two manifests: no data is compared. For these months only,

* the daily summaries (lines by branch, day, product and category; payments by branch and
  day) are computed again and replace the months' partitions;
* the sums per product and per category, which run over all months, are patched: the months'
  old contribution is subtracted, the new one added (quantity, revenue and number of active
  days are additive, and decimals are exact). Sums are dealt to hash buckets, and only the
  buckets that a delta touches are written again. A product whose days are used up leaves.

Means, rounding and HAVING are applied when a mart is read, so they are those of a full
refresh, digit for digit. A line lies in the month of its sale, so a month is joined with
itself only. When the catalogue changes, names may change in every month, and all months are
computed again.

The state and the raw version it was made from are published in one commit. A refresh that
dies has changed nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.operators import conform as C
from branchlens.operators import marts as M
from branchlens.operators.incremental import keep_last
from branchlens.plans import ingest
from branchlens.session import drop_folder, scratch_path, shuffles_freed
from branchlens.sources.snapshots import COMPRESSION, Change, Snapshot, SnapshotStore, slice_count, sliced

BUCKETS = 16  # as for KeyIndex
SLICES = 3  # every slice joins the names of the whole catalogue, so fewer than of a merge
_SUM = T.DecimalType(38, 2)


def _fields(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_TEXT = T.StringType()
_SUMS = (("qty", _SUM), ("revenue", _SUM), ("days", T.LongType()), ("bucket", _TEXT))
STATE = {
    "items_daily": (_fields(("branch", _TEXT), ("day", T.DateType()), ("product_name", _TEXT), ("product_category", _TEXT),
                            ("quantity", _SUM), ("price", _SUM), ("month", _TEXT)), "month"),
    "payments_daily": (_fields(("branch", _TEXT), ("day", T.DateType()), ("amount", T.DecimalType(38, 4)), ("month", _TEXT)),
                       "month"),
    "product_sums": (_fields(("branch", _TEXT), ("product", _TEXT), *_SUMS), "bucket"),
    "category_sums": (_fields(("branch", _TEXT), ("category", _TEXT), *_SUMS), "bucket"),
}


def changed_folders(before: dict, now: dict) -> list[str]:
    """Partitions that were added, removed or written again between two manifests of a table."""
    return sorted(p for p in before.keys() | now.keys() if before.get(p) != now.get(p))


class DeltaMarts:
    """``out``: where the state lives; ``raw``: the store of ``ingest``."""

    def __init__(self, spark: SparkSession, out: str, raw: SnapshotStore):
        self.spark, self.raw = spark, raw
        self.store = SnapshotStore(spark, out, dict(STATE))

    def _rows(self, table: str, at: Snapshot, folders: list[str] | None) -> DataFrame:
        return keep_last(self.raw.read(table, at, folders), ingest.KEYS[table], ingest.ORDER)

    def _summed(self, items: DataFrame) -> DataFrame:
        return items.groupBy("branch", "day", "month", "product_name", "product_category").agg(
            F.sum("quantity").alias("quantity"), F.sum("price").alias("price"))

    def _items(self, lines: DataFrame, sales: DataFrame, names: DataFrame) -> DataFrame:
        last = [keep_last(df, ingest.KEYS[t], ingest.ORDER) for t, df in (("lines", lines), ("sales", sales))]
        return self._summed(C.enrich_lines(*last, names, named=True))

    def _write_items(self, at: Snapshot, months: list[str]) -> Change:
        """The daily summary of the lines of some months. Many lines are joined and summed in
        slices of sales, whose sums are added up: the shuffle files of one slice at a time are on
        the disks. (Not by groups of months: a line that is delivered no more stays in the month
        that its sale has left.)"""
        names = C.catalog_for_join(self._rows("products", at, None))
        lines, sales = (self.raw.read(t, at, months) for t in ("lines", "sales"))
        n = slice_count(lines, SLICES)
        if n == 1:
            return self.store.write("items_daily", self._items(lines, sales, names), months)
        scratch = scratch_path(self.spark, "mart-items")

        def kept(name: str, df: DataFrame) -> DataFrame:
            df.write.option("compression", COMPRESSION).parquet(f"{scratch}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

        names, parts = kept("names", names), None
        for at_slice, (l, s) in enumerate(zip(*[sliced(df, ingest.KEYS["sales"], n) for df in (lines, sales)])):
            part = kept(f"slice{at_slice}", self._items(l, s, names))
            parts = part if parts is None else parts.unionByName(part)
        change = self.store.write("items_daily", self._summed(parts), months)
        drop_folder(self.spark, scratch)
        return change

    def _payments(self, at: Snapshot, folders: list[str]) -> DataFrame:
        live = C.live_payments(self._rows("payments", at, folders))
        return live.groupBy("branch", "day", "month").agg(F.sum("amount").alias("amount"))

    def _patched(self, name: str, key: str, daily, state: Snapshot, old: DataFrame, new: DataFrame) -> Change | None:
        """The sums with the old contribution of the changed months replaced by the new one."""
        def signed(items: DataFrame, sign: int) -> DataFrame:
            sums = M.daily_sums(daily(items), key)
            return sums.select("branch", key, *[(F.col(c) * sign).alias(c) for c in ("qty", "revenue", "days")])

        total = [F.sum(c).alias(c) for c in ("qty", "revenue", "days")]
        bucket = F.format_string("%04d", F.pmod(F.xxhash64("branch", key), F.lit(BUCKETS))).alias("bucket")
        delta = signed(new, 1).unionByName(signed(old, -1)).groupBy("branch", key).agg(*total) \
            .filter("qty <> 0 OR revenue <> 0 OR days <> 0").select("*", bucket)
        touched = [r[0] for r in delta.select("bucket").distinct().collect()]  # at most BUCKETS
        if not touched:
            return None
        folders = self.store.touched(name, state, touched)
        both = self.store.read(name, state, folders).select("branch", key, "qty", "revenue", "days", "bucket").unionByName(delta)
        sums = both.groupBy("branch", key, "bucket").agg(*total).filter("days > 0")
        return self.store.write(name, sums, folders)

    def refresh(self) -> dict[str, int]:
        """Bring the state to the raw tables' current version; returns the changed months."""
        with shuffles_freed(self.spark):
            return self._refresh()

    def _refresh(self) -> dict[str, int]:
        at = self.raw.snapshot()
        for index in ingest.indexes(self.raw).values():  # every key in one month from here on
            at = index.ensure(at, order=ingest.ORDER)
        state = self.store.snapshot()
        seen = state.meta.get("raw", {})
        changed = {t: changed_folders(seen.get(t, {}), at.tables.get(t, {})) for t in ingest.KEYS}
        months = sorted({*changed["lines"], *changed["sales"]})
        if changed["products"]:
            months = sorted({*at.tables.get("lines", {}), *state.tables.get("items_daily", {}), *months})
        changes = {}
        if months:
            # A line without a sale has no day and no month: it is in the null partition.
            items = self._write_items(at, months)
            old = self.store.read("items_daily", state, months)
            new = self.store.read("items_daily", Snapshot(0, {"items_daily": {p: [items.commit] for p in items.folders}}))
            changes["items_daily"] = items
            for name, key, daily in (("product_sums", "product", M.product_daily), ("category_sums", "category", M.category_daily)):
                change = self._patched(name, key, daily, state, old, new)
                if change is not None:
                    changes[name] = change
        if changed["payments"]:
            changes["payments_daily"] = self.store.write("payments_daily", self._payments(at, changed["payments"]),
                                                         changed["payments"])
        raw = {t: at.tables.get(t, {}) for t in ingest.KEYS}
        if changes or raw != seen:
            self.store.commit(state, changes, raw=raw, raw_version=at.version)
        return {"items": len(months), "payments": len(changed["payments"])}

    def marts(self) -> dict[str, DataFrame]:
        """The marts of the state's current version."""
        at = self.store.snapshot()
        items, pay = self.store.read("items_daily", at), self.store.read("payments_daily", at)
        return {
            "daily_revenue_all": M.daily_revenue_all(pay),
            "daily_revenue_branch": M.daily_revenue_branch(pay),
            "monthly_revenue": M.monthly_revenue(pay),
            "product_daily": M.product_daily(items),
            "category_daily": M.category_daily(items),
            "product_totals": M.product_totals_of(self.store.read("product_sums", at).drop("bucket")),
            "category_totals": M.category_totals_of(self.store.read("category_sums", at).drop("bucket")),
            "monthly_line_revenue": M.monthly_line_revenue(items),
        }
