"""Replayed logs, refreshed units, and rules that are counted by the write itself."""

import hashlib
import os
import shutil

import pytest
from pyspark.sql import functions as F

from lodestone.operators import checks, refresh
from lodestone.operators.expect import Rules, StreamCounts
from lodestone.operators.features import causal_features, with_cycle
from lodestone.sources import files as files_of
from lodestone.streaming import ingest, replay


def appended(spark, path, ids, first=None):
    rows = spark.createDataFrame([(i, i % 3) for i in ids], "id long, p int")
    key, body = F.col("p").cast("string"), F.to_json(F.struct("id"))
    replay.append_to_log(rows, path, F.col("p"), ["id"], key, body, "t", F.lit("2024-01-01 00:00:00"), first)


def test_a_log_is_replayed_from_its_beginning_and_never_twice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "SEGMENT", 7)
    path, run = str(tmp_path / "log"), lambda: ingest.ingest(replay.log_stream(spark, path), str(tmp_path / "out"), str(tmp_path / "cp"))
    appended(spark, path, range(60))
    assert run() == 60 and run() == 0
    appended(spark, path, range(60, 100), replay.next_offsets(path))
    assert run() == 40 and run() == 0
    got = sorted((r.partition, r.offset, r.payload) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = [(p, k, f'{{"id":{i}}}') for p in range(3) for k, i in enumerate([i for i in range(100) if i % 3 == p])]
    assert got == want
    assert ingest.ingest(replay.log_stream(spark, path), str(tmp_path / "other"), str(tmp_path / "cp2")) == 100


def test_lost_offsets_raise(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "SEGMENT", 5)
    path = str(tmp_path / "log")
    appended(spark, path, range(60))
    folders = replay._folders(path)[1]
    run = lambda name: ingest.ingest(replay.log_stream(spark, path), str(tmp_path / f"out{name}"), str(tmp_path / f"cp{name}"))
    assert run("a") == 60
    # A segment from the middle is gone: a new stream can't have it, the old one doesn't want it.
    shutil.rmtree(folders[1][3])
    with pytest.raises(Exception, match="of partition 0 are gone"):
        run("b")
    assert run("a") == 0
    # What is at the start may be deleted, until a stream that hasn't read it yet comes back for it.
    shutil.rmtree(folders[0][3])
    assert run("c") == 50
    reader = replay.LogReader(path)
    with pytest.raises(ValueError, match="offsets 0 to 9 of partition 0 are gone"):
        reader.partitions({"0": 0}, {"0": 10})
    # A segment with fewer events than its name says.
    name = folders[2][3]
    rows = spark.read.parquet(name).filter("offset > 11").collect()
    shutil.rmtree(name)
    spark.createDataFrame(rows, "key string, payload string, topic string, offset long, enqueued_at timestamp").write.parquet(name)
    with pytest.raises(Exception, match="2 of the offsets 10 to 14 are gone"):
        run("d")


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.join(folder, n)] = hashlib.sha256(open(os.path.join(folder, n), "rb").read()).hexdigest()
    return out


def test_late_rows_refresh_their_units_only(spark, tmp_path):
    make = lambda rows: causal_features(with_cycle(rows, "u", ["t"]), "u", "cycle", ["v"])
    bronze, gold, whole = (str(tmp_path / n) for n in ("bronze", "gold", "whole"))
    rows = [(u, t, float(u * t % 17)) for u in range(40) for t in range(12)] + [(None, 1, 2.0)]
    late = [r for r in rows if r[0] in (3, 11) and r[1] == 2] + [(77, 1, 5.0)]
    df = lambda x: spark.createDataFrame(x, "u int, t int, v double")
    refresh.append_rows(df([r for r in rows if r not in late]), bronze, "u", 16)
    refresh.rebuild(spark, bronze, make, gold, "u", 16)
    before = files(gold)
    refresh.append_rows(df(late), bronze, "u", 16)
    assert refresh.refresh_units(df(late), bronze, make, gold, "u", 16) == 3
    after = files(gold)
    refresh.rebuild(spark, bronze, make, whole, "u", 16)
    key = lambda r: str(tuple(r))
    columns = ["u", "t", "v", "cycle", "v_mean_10", "v_delta_5", "bucket"]
    got, want = (sorted(map(key, spark.read.parquet(p).select(columns).collect())) for p in (gold, whole))
    assert got == want and len(got) == len(rows) + 1
    touched = {r[0] for r in df(late).select(refresh.bucket_of(F.col("u"), 16)).distinct().collect()}
    same = {p: d for p, d in before.items() if int(p.split("bucket=")[1].split("/")[0]) not in touched}
    assert same and all(after[p] == d for p, d in same.items()) and set(after) - set(before) and len(touched) < 16
    assert refresh.refresh_units(df([]), bronze, make, gold, "u", 16) == 0 and files(gold) == after
    refresh.append_rows(df([(None, 0, 1.0)]), bronze, "u", 16)
    assert refresh.refresh_units(df([(None, 0, 1.0)]), bronze, make, gold, "u", 16) == 1
    assert sorted(r.cycle for r in spark.read.parquet(gold).filter("u IS NULL").collect()) == [1, 2]


RULES = Rules({"positive": "v > 0", "small": "v < 8", "known": "k IS NOT NULL"})
ROWS = [(1.0, "a"), (0.0, "b"), (9.0, None), (None, "c"), (5.0, "d")]


def test_rules_are_counted_by_the_write(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(ROWS, "v double, k string").mapInArrow(count, "v double, k string")
    valid, quarantine, metrics = RULES.write_split(df, str(tmp_path / "t"))
    assert sorted(map(tuple, metrics.collect())) == sorted(map(tuple, RULES.metrics(spark.createDataFrame(ROWS, "v double, k string")).collect()))
    assert sorted(r.k for r in valid.collect()) == ["a", "d"] and valid.columns == ["v", "k"]
    assert {(r.k, tuple(r.failed_rules)) for r in quarantine.collect()} == {("b", ("positive",)), (None, ("small", "known")), ("c", ("positive", "small"))}
    # The rows came by once: for the write, its counts and both sides.
    assert seen.value == len(ROWS)
    _, _, none = RULES.write_split(spark.createDataFrame([], "v double, k string"), str(tmp_path / "none"))
    assert sorted(map(tuple, none.collect())) == [("known", 0, 0), ("positive", 0, 0), ("small", 0, 0)]


def test_rules_are_counted_in_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame(ROWS, "v double, k string")
    df.write.parquet(source)
    df.filter("v > 0").write.mode("append").parquet(source)
    counts = StreamCounts("rules")
    spark.streams.addListener(counts)
    try:
        stream = ingest.parquet_stream(spark, source, df.schema)
        added = ingest.ingest(RULES.observed(stream.repartition(2), "rules").filter("size(failed_rules) = 0"), str(tmp_path / "out"), str(tmp_path / "cp"))
        assert added == 4
        got = {r.rule: (r.passed, r.failed) for r in counts.metrics(spark).collect()}
    finally:
        spark.streams.removeListener(counts)
    assert got == {"positive": (6, 2), "small": (5, 3), "known": (6, 2)}


def test_overwritten_files_are_refused(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    folder.mkdir()
    put = lambda name, text, at: ((folder / name).write_text(text), os.utime(folder / name, (at, at)))
    run = lambda: (files_of.landed(spark, str(folder), ledger), ingest.ingest(files_of.text_lines(spark, str(folder), stream=True).select("raw_line"), str(tmp_path / "out"), str(tmp_path / "cp")))
    put("a.txt", "1\n2\n", 1_700_000_000)
    put("b.txt", "3\n", 1_700_000_100)
    put("c.csv", "4\n", 1_700_000_100)
    assert run() == (2, 3) and run() == (0, 0)
    put("d.txt", "5\n6\n", 1_700_000_050)
    assert run() == (1, 2)
    # Written again with the same content: nothing new.
    put("a.txt", "1\n2\n", 1_700_000_500)
    assert files_of.landed(spark, str(folder), ledger) == 0
    put("b.txt", "9\n", 1_700_000_900)
    put("e.txt", "7\n", 1_700_000_900)
    for _ in range(2):
        with pytest.raises(ValueError, match="overwritten after they had landed: .*b.txt"):
            files_of.landed(spark, str(folder), ledger)
    put("b.txt", "3\n", 1_700_000_950)
    (folder / "d.txt").unlink()
    assert files_of.landed(spark, str(folder), ledger) == 1 and files_of.landed(spark, str(folder), ledger) == 0


def test_recomputed_layers_find_what_differs(spark):
    silver = spark.createDataFrame([(i, i % 3, i / 7) for i in range(60)], "id int, g int, v double")
    raw = silver.select(F.to_json(F.struct("*")).alias("raw"))
    refine = lambda r: r.select(F.from_json("raw", silver.schema).alias("r")).select("r.*")
    total = lambda d: d.groupBy("g").agg(F.sum("v").alias("s"), F.max("v").alias("m"))
    run = lambda s, g: {r.layer: (r.compared, r.mismatches) for r in checks.recomputed(raw, refine, s, ["id"], ["g", "v"], total, g, ["g"], ["s", "m"]).collect()}
    assert run(silver, total(silver)) == {"silver": (60, 0), "gold": (6, 0)}
    off = silver.withColumn("v", F.when(F.col("id") == 5, F.col("v") + 1e-12).otherwise(F.col("v"))).filter("id <> 9")
    assert run(off, total(silver).withColumn("s", F.col("s") + 1e-10)) == {"silver": (60, 2), "gold": (6, 0)}
    assert run(silver, total(silver).withColumn("m", F.col("m") + 1e-6).filter("g > 0")) == {"silver": (60, 0), "gold": (6, 4)}


def test_exact_means_do_not_depend_on_the_order_of_rows(spark):
    rows = [(i, (i * 7919 % 100003) * 123.37 + 1e10 / (i % 97 + 1)) for i in range(4000)]
    made = lambda by: spark.createDataFrame(rows, "i int, v double").coalesce(1).sortWithinPartitions(by).agg(checks.exact_mean("v"), F.avg("v")).first()
    up, down = made("v"), made(F.desc("v"))
    assert up[0] == down[0] and up[1] != down[1] and up[0] == pytest.approx(up[1])
    odd = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert odd.agg(checks.exact_mean("v")).first()[0] != odd.filter("v = 1").agg(checks.exact_mean("v")).first()[0] == 1.0
    assert odd.limit(0).agg(checks.exact_mean("v")).first()[0] is None
