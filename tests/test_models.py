import pytest
from pyspark.sql import functions as F

from lodestone.operators import minimise, models
from lodestone.operators.boosting import boost


def test_counts_and_months(spark):
    df = spark.createDataFrame([("1/5/2024", "2.0", " a "), ("bad", "", "")], "d string, n string, s string")
    out = minimise.minimise(df, ["s"], {"d": "month"}, ["n"]).collect()
    assert [tuple(r) for r in out] == [("a", "2024-01", 2), (None, None, None)]
    for bad in ("-1", "1.5", "x"):
        with pytest.raises(Exception, match="not a whole count"):
            spark.createDataFrame([(bad,)], "n string").select(minimise.whole_count(F.col("n"))).collect()


def test_failing_calls_stay_in_their_rows(spark):
    df = spark.createDataFrame([("a",), ("boom",), (None,)], "r string")

    def call(x):
        if x == "boom":
            raise RuntimeError("down")
        return x * 2

    got = {r.r: tuple(r.response) for r in models.call_model(df, "r", call, parallel=2).collect()}
    assert got == {"a": ("aa", None), "boom": (None, "RuntimeError: down"), None: (None, None)}


def test_damped_counts_weigh_their_logarithm(spark):
    from pyspark.ml.linalg import Vectors

    from lodestone.operators import gates

    df = spark.createDataFrame([(Vectors.sparse(9, [1, 4], [1.0, 8.0]),)], ["_c"])
    got = gates.damped(df).first()[0]
    assert list(got.indices) == [1, 4] and list(got.values) == pytest.approx([1.0, 1 + 3 * 0.6931471805599453])
    rows = [(f"good fine words number {i % 7}", "1") if i % 2 else (f"bad poor terms number {i % 5}", "0") for i in range(60)] + [(None, "1"), ("x", None)]
    train = spark.createDataFrame(rows, "t string, y string").na.fill("", ["t"])
    model, majority = gates.text_baseline(train, "t", "y")
    out = model.transform(train.filter("y IS NOT NULL AND t <> ''")).select("_p", "_y").collect()
    assert majority == "1" and all(r[0] == r[1] for r in out)


def test_texts_are_split_once_and_models_keep_no_training_state(spark, monkeypatch):
    from lodestone.operators import gates

    rows = [(i, f"good fine words number {i % 7}" if i % 2 else f"bad poor terms number {i % 5}", str(i % 2)) for i in range(60)]
    train = spark.createDataFrame(rows, "i int, t string, y string")
    model, _ = gates.text_baseline(train, "t", "y")
    assert not model.rest.stages[-1].hasSummary
    monkeypatch.setattr(F, "udf", None)
    out = model.transform(train)
    assert "PythonUDF" not in out._jdf.queryExecution().toString() and "_t" not in out.columns
    assert {r.i for r in out.filter("_p = _y").collect()} == set(range(60))


def test_scoring_twice_appends_nothing(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i), 2.0 * i) for i in range(60)], "id int, x double, y double")
    model = boost(df, ["x"], "y", [3], trees=3, least=5)[0]
    log = spark.createDataFrame([], "id int, model_version string, predicted double, scored_at timestamp, actual double")
    first = models.score_new(model, df, log, ["id"], "7")
    first.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 60 and models.score_new(model, df, log, ["id"], "7").count() == 0
    assert models.score_new(model, df, log, ["id"], "8").count() == 60
    assert '"enum": ["a", "b"]' in models.label_schema({"k": ["a", "b"]})
