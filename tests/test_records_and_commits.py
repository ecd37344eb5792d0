"""Fixed-length records by byte ranges, and the sink that commits by epoch."""

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sources.records import read_records
from millrace.streaming import commits as sc, sources as ss


def test_records_by_ranges(spark, tmp_path):
    data = {f"f{i}.bin": bytes((7 * i + j) % 251 for j in range(n * 5)) for i, n in enumerate((0, 1, 100, 37))}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "_hidden").write_bytes(b"x")
    df = read_records(spark, str(tmp_path), 5, range_bytes=60, chunk_bytes=17)
    assert df.rdd.getNumPartitions() == 1 + 9 + 4
    want = sorted((name, i, content[5 * i : 5 * i + 5]) for name, content in data.items() for i in range(len(content) // 5))
    assert sorted((r["path"].rpartition("/")[2], r["record_no"], bytes(r["record"])) for r in df.collect()) == want
    assert read_records(spark, f"file://{tmp_path}/f2.bin", 5).count() == 100
    assert read_records(spark, str(tmp_path), 5, glob="none*").count() == 0


def test_short_tail(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"0123456789012")
    with pytest.raises(Exception, match="no multiple"):
        read_records(spark, str(tmp_path), 5).collect()
    assert read_records(spark, str(tmp_path), 5, short_tail="drop").count() == 2
    kept = read_records(spark, str(tmp_path), 5, short_tail="keep", range_bytes=5)
    assert sorted(bytes(r["record"]) for r in kept.collect()) == [b"012", b"01234", b"56789"]


def test_a_repeated_epoch_leaves_one_copy(spark, tmp_path):
    batches = [spark.range(a, a + 50).coalesce(2) for a in (0, 50, 100)]
    inbox, folder = ss.queue(batches, "epochs"), str(tmp_path / "out")
    stream = lambda: ss.file_stream(spark, inbox, batches[0].schema, 2)
    sc.run_epochs(stream(), folder, f"{scratch_path(spark, 'a')}")
    want = list(range(150))
    read = lambda: sorted(r["id"] for r in sc.read_epochs(spark, folder, batches[0].schema).collect())
    assert read() == want and sc.committed(spark, folder).select("epoch").distinct().count() > 1
    files = len(list((tmp_path / "out" / "files").glob("*.parquet")))
    sc.run_epochs(stream(), folder, f"{scratch_path(spark, 'b')}")  # a lost checkpoint: every epoch comes again
    assert read() == want and len(list((tmp_path / "out" / "files").glob("*.parquet"))) == files


def test_epochs_without_rows(spark, tmp_path):
    batch = spark.range(5).where("id > 9")
    inbox = ss.queue([spark.range(5)], "none")
    sc.run_epochs(ss.file_stream(spark, inbox, batch.schema).where("id > 9"), str(tmp_path / "o"))
    assert sc.read_epochs(spark, str(tmp_path / "o"), batch.schema).collect() == []
    assert sc.committed(spark, str(tmp_path / "o")).agg(F.sum("rows")).first()[0] == 0
