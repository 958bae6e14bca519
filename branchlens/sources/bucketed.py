"""Sales and lines bucketed by sale, so that joining them moves nothing.

Both tables are written in the same number of hash buckets of ``sale_key`` (branch and sale id
in one text, so that one column is the whole null-safe key), one sorted file per bucket. The
join of lines with their sales is then planned without an exchange on either side; only the
small catalogue is shuffled or broadcast. Bucketing is a property of catalog tables; their
files lie where ``path`` says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchlens.operators import conform as C

KEY = "sale_key"


def sale_key(sale_id: str = "sale_id", branch: str = "branch") -> Column:
    """Text that is equal for equal sale ids in equal branches, null branches included; null
    for a null id, which joins with nothing."""
    return F.concat(F.col(sale_id), F.lit("@"), F.coalesce(F.concat(F.lit("="), F.col(branch)), F.lit("")))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """``df`` with its ``sale_key`` as the bucketed and sorted table ``table`` under ``path``."""
    keyed = df.withColumn(KEY, sale_key())
    # Dealt like the buckets, so that each task writes one file.
    keyed.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path) \
        .mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def enrich_bucketed(lines: DataFrame, sales: DataFrame, catalog: DataFrame) -> DataFrame:
    """``conform.enrich_lines`` on bucketed tables: J1 on the bucket column."""
    l = C.live(lines).select(KEY, "sale_id", "product_id", "branch", "price", "quantity").alias("l")
    s = sales.select(KEY, "created_at", "closed_at", "sale_type").alias("s")
    j = l.join(s, F.col(f"l.{KEY}") == F.col(f"s.{KEY}"), "left").drop(KEY)
    return C.with_catalog(j, catalog)
