"""Both sides of a split are stored in little space and come back whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairstats.sinks.stage import KEPT, read_split, write_split


def size(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_split_lines_take_less_than_plain_ones(spark, tmp_path):
    number = lambda shift: F.crc32(((F.col("id") + shift) % 99_991).cast("string")) % 4000
    word = lambda shift: F.translate(number(shift).cast("string"), "0123456789", "etaoinshrd")
    period = (F.lit(1900) + F.col("id") % 400_000 / 4000).cast("int")
    lines = spark.range(0, 100_000, 1, 1).select(
        F.concat(period, F.lit(" "), word(0), F.lit(" "), word(1), F.lit("\t7 7")).alias("value"),
        F.when(F.col("id") % 5 > 0, "bad_value").alias("reason"),
    )
    kept = F.coalesce("reason", F.lit(KEPT))
    plain = lines.withColumn("reason", kept).write.partitionBy("reason").option("compression", "zstd")
    plain.parquet(str(tmp_path / "plain"))
    write_split(lines, "reason", str(tmp_path / "split"))
    assert size(tmp_path / "split") < 0.9 * size(tmp_path / "plain")
    good, rejects = read_split(lines, "reason", str(tmp_path / "split"))
    assert sorted(good.collect()) == sorted(lines.where("reason IS NULL").select("value").collect())
    assert sorted(rejects.collect()) == sorted(lines.where("reason IS NOT NULL").collect())


def test_values_of_all_kinds_come_back(spark, tmp_path):
    rows = [(None, None, None, None, None, None), ("", -1, 2**62, 0.5, True, "x"), ("a\tb\n", 7, -5, -0.0, False, None)]
    table = spark.createDataFrame(rows * 3, "s string, i int, l bigint, d double, b boolean, reason string")
    table = table.withColumns({"m": F.col("i").cast("decimal(30,2)"), "y": F.col("s").cast("binary"),
                               "t": F.timestamp_seconds("i"), "e": F.expr("date_add(DATE'2000-01-01', i)")})
    write_split(table, "reason", str(tmp_path / "kinds"))
    good, rejects = read_split(table, "reason", str(tmp_path / "kinds"))
    want = table.select(rejects.columns)
    assert sorted(map(str, rejects.collect())) == sorted(map(str, want.where("reason IS NOT NULL").collect()))
    assert sorted(map(str, good.collect())) == sorted(map(str, want.where("reason IS NULL").drop("reason").collect()))
