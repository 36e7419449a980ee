import pytest

from lodestone import catalog


def test_stage_cuts_lineage_and_discard_deletes(spark):
    df = catalog.stage(spark.range(5), "t")
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().toString()
    files = df.inputFiles()
    catalog.discard(df)
    with pytest.raises(Exception):
        spark.read.parquet(files[0].rsplit("/", 1)[0]).count()


def test_working_tables_go_to_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark, "_lodestone_shared", f"{tmp_path}/", raising=False)
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        assert catalog.shared_dir(spark) == str(tmp_path)
        assert catalog.stage(spark.range(2), "t").inputFiles()[0].startswith(f"file://{tmp_path}/lodestone/{spark.sparkContext.applicationId}/t-")


def test_tables_by_value_and_cleaning(spark, tmp_path, monkeypatch):
    if spark.conf.get("spark.checkpoint.dir", None) is not None:
        pytest.skip("the folder is the session's")
    monkeypatch.setattr(spark, "_lodestone_shared", str(tmp_path), raising=False)
    monkeypatch.setattr(spark, "_lodestone_run", None, raising=False)
    df = catalog.stage(spark.range(10).selectExpr("id", "CAST(id % 3 AS INT) AS part"), "t", by="part")
    assert df.filter("part = 1").count() == 3 and len(df.filter("part = 1").inputFiles()) >= 1
    assert sorted(r.id for r in df.collect()) == list(range(10))
    other = catalog.stage(spark.range(4), "u")
    catalog.discard(df)
    assert other.count() == 4 and not any("/t-" in str(p) for p in tmp_path.rglob("*.parquet"))
    catalog.clean(spark)
    assert not list(tmp_path.rglob("*.parquet"))
