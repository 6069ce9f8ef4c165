"""Tables in versions, and tiles that several tasks write."""

from pathlib import Path

from astroloom.sinks import tables


def rows(df) -> list:
    return sorted(tuple(r) for r in df.collect())


def test_readers_find_a_whole_table_at_every_moment(spark, tmp_path):
    path = str(tmp_path / "master")
    made = lambda *ids: spark.createDataFrame([(k, float(k)) for k in ids], "ID long, ra double")
    assert tables.current(spark, path) is None
    tables.upsert(made(1, 1, 2), path)
    before = tables.current(spark, path)
    tables.upsert(made(2, 3), path)
    assert rows(before) == [(1, 1.0), (2, 2.0)]  # who reads the version before goes on
    assert rows(tables.current(spark, path)) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    left = Path(path) / "version-3"  # of a driver that died while it wrote
    left.mkdir()
    (left / "part-0.parquet").write_bytes(b"half")
    assert rows(tables.current(spark, path)) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    tables.upsert(made(4), path)
    assert [n for n, _ in tables.versions(spark, path)] == [2, 4]
    assert len(rows(tables.current(spark, path))) == 4
    tables.versioned(made(), path)
    assert rows(tables.current(spark, path)) == []


def test_a_tile_in_several_files(spark, tmp_path):
    path = str(tmp_path / "cutouts")
    df = spark.createDataFrame([(k, 7, k % 2, [float(k)]) for k in range(200)], "ID long, xxx int, yyy int, images array<double>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else what is small goes to one task
    try:
        tables.cutouts(df, path, files=3)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 1 < len(list(Path(path).glob("xxx=7/yyy=1/*.parquet"))) <= 3
    tables.cutouts(df.where("yyy = 1 and ID < 100"), path)
    assert len(list(Path(path).glob("xxx=7/yyy=1/*.parquet"))) == 1
    assert sorted(r.ID for r in spark.read.parquet(path).select("ID").collect()) == [k for k in range(200) if k % 2 == 0 or k < 100]
