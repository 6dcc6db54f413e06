import os
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import Row

from riverbend.session import ship_package
from riverbend.sources.readers import file_stream
from riverbend.streaming import effects


def feed(spark, path, ids):
    spark.createDataFrame([(i, f"t{i}" if i % 2 else None) for i in ids], "id long, title string").repartition(3).write.mode("append").json(path)
    return file_stream(spark, path, "id long, title string", max_files_per_trigger=None)


def lines(spark, root):
    return sorted(r.value for r in effects.rendered(spark, root).collect())


def test_every_record_once_over_two_runs(spark, tmp_dir):
    path, root = os.path.join(tmp_dir, "feed"), "file:" + os.path.join(tmp_dir, "out")
    assert lines(spark, root) == []
    effects.run_effects(feed(spark, path, range(50)), root)
    effects.run_effects(feed(spark, path, range(50, 70)), root)
    want = [effects.as_json(Row(id=i, title=f"t{i}" if i % 2 else None)) for i in range(70)]
    assert lines(spark, root) == sorted(want)
    assert effects.rendered(spark, root).select("epoch").distinct().count() == 2


def write(root, rows, partition=0, epoch=0, error=None, fail_at=None):
    writer = effects.RecordFiles(root)
    assert writer.open(partition, epoch)
    for i, row in enumerate(rows):
        if i == fail_at:
            return writer  # the executor is lost here: close is never called
        writer.process(row)
    writer.close(error)


def test_a_retried_batch_leaves_each_record_once(spark, tmp_dir):
    root, rows = tmp_dir + "/records", [Row(id=i) for i in range(10)]
    write(root, rows, fail_at=6)
    write(root, rows, error=RuntimeError("failed"))
    assert lines(spark, tmp_dir) == []
    write(root, rows)
    write(root, rows)            # the partition is run again after it was done
    write(root, rows[:3], partition=1)
    write(root, rows[:2], epoch=1)
    assert len(lines(spark, tmp_dir)) == 15
    names = sorted(f for _, _, files in os.walk(root) for f in files if not f.startswith("."))
    assert names == ["part-00000.txt", "part-00000.txt", "part-00001.txt"]


def test_empty_partitions_and_odd_records(spark, tmp_dir):
    root = tmp_dir + "/records"
    write(root, [])
    write(root, [Row(id=1, title="a\nb é"), Row(id=None, title=None)], partition=1)
    assert lines(spark, tmp_dir) == sorted(['{"id": 1, "title": "a\\nb é"}', '{"id": null, "title": null}'])


@pytest.mark.parametrize("root", ["/tmp/x/", "file:/tmp/x", "file:///tmp/x"])
def test_local_roots(root):
    assert effects.file_system(root)[1] == "/tmp/x"


def test_the_package_is_shipped(spark, tmp_dir):
    name = ship_package(spark)
    assert name in spark.sparkContext._python_includes

    def found(batches):
        import sys
        yield from ([any(p.endswith(name) for p in sys.path)] for _ in [list(batches)])

    assert spark.sparkContext.parallelize(range(2), 2).mapPartitions(found).collect() == [[True], [True]]
    from pyspark import SparkFiles
    with zipfile.ZipFile(SparkFiles.get(name)) as zipped:
        zipped.extractall(tmp_dir)
    code = "import riverbend.operators.vault as v, riverbend.streaming.effects; print(v.__file__)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env={**os.environ, "PYTHONPATH": tmp_dir}, capture_output=True, text=True, check=True)
    assert out.stdout.strip().startswith(tmp_dir)
