"""The store of results in snapshots, the pool of predictors, and worker states that end."""

import contextlib
import json
import os
import threading
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from annospark.operators import infer
from annospark.operators.predictors import Pool, gpu_profile, session_profile
from annospark.sources import files, snapshots
from annospark.streaming import stream


def rows(spark, *triples):
    return spark.createDataFrame([(v, m, s) for m, s, v in triples], "value int, model string, split string")


def held(frame):
    return sorted((r.model, r.split, r.value) for r in frame.collect())


def test_a_write_replaces_its_partitions_and_old_frames_stay(spark, tmp_path):
    path = str(tmp_path / "s")
    assert snapshots.read(spark, path) is None and not files.has_results(spark, path)
    files.write_results(rows(spark, ("a", "x", 1), ("a", "y", 2), ("b/=%é [1]", "01", 3)), path)
    first = snapshots.read(spark, path)
    files.write_results(rows(spark, ("a", "x", 4)).withColumn("more", F.lit(1.5)), path)
    assert held(first) == [("a", "x", 1), ("a", "y", 2), ("b/=%é [1]", "01", 3)]
    now = files.read_results(spark, path)
    assert held(now) == [("a", "x", 4), ("a", "y", 2), ("b/=%é [1]", "01", 3)]
    assert {r.value: r.more for r in now.collect()} == {4: 1.5, 2: None, 3: None}
    assert files.has_results(spark, path, "b/=%é [1]", "01") and not files.has_results(spark, path, "a", "01")
    with pytest.raises(ValueError, match="two types"):
        files.write_results(rows(spark, ("c", "x", 1)).withColumn("more", F.lit("text")), path)
        files.read_results(spark, path)


def test_a_failing_writer_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    files.write_results(rows(spark, ("a", "x", 1), ("a", "y", 2)), path)
    broken = rows(spark, *[("a", "x", n) for n in range(40)]).repartition(8).withColumn("value", F.when(F.col("value") == 39, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        files.write_results(broken, path)
    assert held(files.read_results(spark, path)) == [("a", "x", 1), ("a", "y", 2)]
    assert len(os.listdir(tmp_path / "s/data")) == 1 and snapshots.current(spark, path).number == 1


def test_writers_beside_each_other_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "s")
    threads = [threading.Thread(target=files.write_results, args=(rows(spark, (f"m{k}", "x", k)), path)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert held(files.read_results(spark, path)) == [(f"m{k}", "x", k) for k in range(4)]
    assert snapshots.current(spark, path).number == 4


def test_a_taken_number_is_committed_after(spark, tmp_path):
    path = str(tmp_path / "s")
    files.write_results(rows(spark, ("a", "x", 1)), path)
    meanwhile = []

    def change(folders):
        if not meanwhile:  # another writer commits while this one makes its manifest
            meanwhile.append(files.write_results(rows(spark, ("b", "x", 2)), path))
        return {f: v for f, v in folders.items() if "model=a" not in f}

    assert snapshots.commit(spark, path, change).number == 3
    assert held(files.read_results(spark, path)) == [("b", "x", 2)]
    assert not [n for n in os.listdir(tmp_path / "s/manifests") if n.startswith("_")]


def test_vacuum_deletes_what_only_old_manifests_name(spark, tmp_path):
    path, data = str(tmp_path / "s"), tmp_path / "s/data"
    for value in (1, 2, 3):
        files.write_results(rows(spark, ("a", "x", value)), path)
    files.write_results(rows(spark, ("a", "x", 4), ("a", "y", 5)), path)
    previous = snapshots.read(spark, path)
    files.write_results(rows(spark, ("a", "y", 6)), path)
    os.makedirs(data / f"version={uuid.uuid4().hex}/model=a")  # a writer that has not committed
    assert len(snapshots.vacuum(spark, path, keep=2)) == 3
    assert held(previous) == [("a", "x", 4), ("a", "y", 5)] and len(os.listdir(data)) == 3
    assert len(snapshots.vacuum(spark, path, keep=1)) == 1
    assert held(files.read_results(spark, path)) == [("a", "x", 4), ("a", "y", 6)] and len(os.listdir(data)) == 3
    assert len(snapshots.vacuum(spark, path, keep=1, hours=-1)) == 1 and len(os.listdir(data)) == 2


def test_a_computed_split_without_rows(spark, tmp_path):
    found = files.load_or_compute(spark, str(tmp_path / "s"), "a", "x", lambda: spark.range(0))
    assert found.count() == 0 and found.columns == ["id", "model", "split"]


def test_a_worker_holds_one_predictor(spark, tmp_path):
    folder = str(tmp_path)

    class Counted:
        """Leaves a file when it is made and one when it is closed; answers with its worker."""

        def __init__(self, folder):
            self.folder, self.name = folder, f"{os.getpid()}-{uuid.uuid4().hex}"
            open(f"{folder}/made-{self.name}", "w").close()

        def __call__(self, pairs):
            live = {n.split("-", 1)[1] for n in os.listdir(self.folder) if n.startswith(f"made-{os.getpid()}-")} - {n.split("-", 1)[1] for n in os.listdir(self.folder) if n.startswith(f"closed-{os.getpid()}-")}
            return [str(len(live))] * len(pairs)

        def close(self):
            open(f"{self.folder}/closed-{self.name}", "w").close()

    make = lambda: Counted(folder)
    records = spark.range(12).select(F.col("id").alias("index"), F.element_at(F.array(*map(F.lit, ("train", "valid", "test"))), (F.col("id") % 3 + 1).cast("int")).alias("split"), F.lit("i").alias("image_path"), F.lit("q").alias("query"), F.from_json(F.lit("[]"), "array<struct<bbox:array<int>,label:string>>").alias("gts"))
    for _ in range(3):  # three calls, each with a predictor of its own
        assert {r.raw_response for r in infer.predict(records.repartition(4), make).collect()} == {"1"}
    infer.evaluate_models(records, {"a": make, "b": make}, F.lit(10), F.lit(10), store=f"{folder}/store")
    names = [n for n in os.listdir(folder) if n.startswith("made")]
    workers = {n.split("-")[1] for n in names}
    assert len(names) <= 5 * len(workers)  # one a call, one a model for its three splits
    assert len(names) - len([n for n in os.listdir(folder) if n.startswith("closed")]) <= len(workers)


def test_pool_lets_go_of_the_one_unused_for_the_longest():
    gone = []

    class Model:
        def __init__(self, name):
            self.name = name

        def close(self):
            gone.append(self.name)
            if self.name == "b":
                raise RuntimeError("stuck")

    pool = Pool()
    for name in "abac":
        with pytest.warns(UserWarning, match="stuck") if name == "c" else contextlib.nullcontext():
            assert pool.get(name, lambda name=name: Model(name), most=2).name == name
    assert gone == ["b"] and len(pool) == 2
    pool.release("none")
    pool.release("a")
    assert gone == ["b", "a"] and len(pool) == 1
    with pytest.raises(ValueError):
        pool.get("d", object, most=0)


def test_rows_without_image_or_query_are_no_ones_work(spark):
    made = spark.createDataFrame([(1, "i", "q"), (2, None, "q"), (3, "i", ""), (4, "i", None), (5, "bad", "q")], "index int, image_path string, query string").coalesce(1).withColumn("worker", F.lit(0))

    def make():
        def model(pairs):
            if any(p == "bad" for p, _ in pairs):
                raise RuntimeError("unreadable")
            return [q.upper() for _, q in pairs]

        return model

    found = infer.predict(made, make)
    assert [(r["index"], r.raw_response, r.error) for r in found.orderBy("index").collect()] == [(1, "Q", None), (2, None, "no image or no query"), (3, None, "no image or no query"), (4, None, "no image or no query"), (5, None, "unreadable")]
    r = infer.shard_stats(found).first()
    assert (r.samples, r.unprepared, r.failed, r.processed) == (5, 3, 1, 1)


def test_gpu_profile_only_where_executors_have_gpus(spark):
    assert session_profile(spark) is None
    profile = gpu_profile(0.5, cpus=2)
    assert profile.taskResources["gpu"].amount == 0.5 and profile.taskResources["cpus"].amount == 2


def test_worker_states_end_and_survive_a_restart(spark, tmp_path):
    start, source = datetime(2024, 5, 1, 12), str(tmp_path / "in")
    schema = "worker int, status string, ts timestamp, sample_index long"

    def batch(*events):
        """New events, then a stream that begins anew from its checkpoint: what it gave."""
        spark.createDataFrame([(w, s, None if m is None else start + timedelta(minutes=m), i) for w, s, m, i in events], schema).coalesce(1).write.mode("append").parquet(source)
        name = f"states_{uuid.uuid4().hex}"
        out = str(tmp_path / name)
        states = stream.worker_states(spark.readStream.schema(schema).parquet(source), "5 minutes", "1 minute", ended=("stopped",))
        query = states.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).foreachBatch(lambda df, n: df.write.mode("append").parquet(out)).start()
        query.awaitTermination()
        kept = [p.get("stateOperators")[0]["numRowsTotal"] for p in (json.loads(p.json) for p in query.recentProgress) if p.get("stateOperators")]
        given = spark.read.schema(schema).parquet(out).collect()
        return sorted((r.worker, r.status, (r.ts - start).total_seconds() / 60, r.sample_index) for r in given), kept[-1]

    assert batch((1, "busy", 0, 1), (1, "idle", 0, 2), (2, "busy", 1, 3), (3, "stopped", 1, 4), (None, "busy", 1, 5), (4, "busy", None, 6), (5, None, 1, None)) == ([(1, "idle", 0, 2), (2, "busy", 1, 3), (3, "stopped", 1, 4), (5, None, 1, None)], 3)
    # 1 tells the same again, 2 goes on, 5 is silent: with the watermark at 9 it is lost, and 1 too
    assert batch((1, "idle", 0, 2), (2, "busy", 10, 7)) == ([(1, "lost", 0, 2), (2, "busy", 10, 7), (5, "lost", 1, None)], 1)
    # 5 comes back; events behind the watermark don't count
    assert batch((5, "busy", 11, 8), (2, "failed", 2, 9)) == ([(5, "busy", 11, 8)], 2)
    assert batch((6, "busy", 60, 10)) == ([(2, "lost", 10, 7), (5, "lost", 11, 8), (6, "busy", 60, 10)], 1)
