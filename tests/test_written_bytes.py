"""What a build writes is packed: its CSV files and the tables of its layers."""

import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from checks.queries import _write_csv
from creditlake.sources.csv import load_csv
from creditlake.sources.layers import Layer


def _rows(spark, n=3000):
    rows = spark.range(n, numPartitions=2)
    status = F.when(F.col("id") % 19 != 0, "currency, \"1\"")
    return rows.select(F.col("id").alias("sk_id_bureau"), status.alias("status"), (F.col("id") % 7).cast("double").alias("amt_x"))


def test_csv_files_are_packed_and_hold_all_rows(spark, tmp_path):
    df, path = _rows(spark), str(tmp_path / "bureau.csv")
    _write_csv(df, path)
    names = [n for n in os.listdir(path) if n.startswith("part-")]
    assert len(names) == 2 and all(n.endswith(".csv.gz") for n in names)
    stored = sum(os.path.getsize(f"{path}/{n}") for n in names)
    assert 3 * stored < sum(len(f"{r[0]},{r[1]},{r[2]}") for r in df.collect())
    assert sorted(load_csv(spark, path).collect(), key=lambda r: r[0]) == df.orderBy("sk_id_bureau").collect()


def test_tables_of_a_layer_are_packed(spark, tmp_path):
    layer = Layer(spark, path=str(tmp_path))
    layer.write(_rows(spark), "bureau")
    folder = layer.location("bureau")
    files = [f"{folder}/{n}" for n in os.listdir(folder) if n.endswith(".parquet")]
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    assert layer.read("bureau").count() == 3000
