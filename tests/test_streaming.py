"""Filter and group over a stream."""

import pytest

from larkspur import col
from larkspur.streaming import stream


def test_stream(spark, tmp_path):
    events = "/root/testdata/sf0.001/events.parquet"
    whole = spark.read.parquet(events)
    source = spark.readStream.schema(whole.schema).parquet(os_dir(tmp_path, events))
    out = stream.grouped(stream.filtered(source, col("value") > 10), ["event_type"], [col("value").count()])
    query = out.writeStream.outputMode("complete").format("memory").queryName("counts").start()
    query.processAllAvailable()
    query.stop()
    want = {r[0]: r[1] for r in whole.where("value > 10").groupBy("event_type").count().collect()}
    assert {r.event_type: r.value_count for r in spark.table("counts").collect()} == want
    with pytest.raises(TypeError):
        stream.grouped(source, [], [col("value").first()])


def os_dir(tmp_path, path):
    import shutil

    shutil.copy(path, tmp_path / "events.parquet")
    return str(tmp_path)
