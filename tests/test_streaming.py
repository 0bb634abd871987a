import random

from funnelspark.streaming import cycle


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    data = [(f"k{rng.randint(0, 5)}", i, rng.choice(["failed", "running", "done"])) for i in range(60)]
    schema = "key string, seq long, state string"
    for i in range(3):
        spark.createDataFrame(data[i * 20 : i * 20 + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    cycle.run_cycles(feed, str(tmp_path / "state"), str(tmp_path / "c1"), "key", "seq", ["state"]).awaitTermination()
    batch = spark.createDataFrame(data, schema)
    got = cycle.state_of(spark, str(tmp_path / "state")).select("key", "seq", "state")
    assert cycle.state_of(spark, str(tmp_path / "none")) is None
    assert cycle.state_of(spark, str(tmp_path / "state"), 2).count() == len({k for k, _, _ in data[:40]})  # what a batch that is run again starts from
    assert got.exceptAll(cycle.fold(batch, "key", "seq", ["state"])).isEmpty() and got.count() == len({k for k, _, _ in data})

    ladder = cycle.retry_ladder(feed).writeStream.format("memory").queryName("ladder").option("checkpointLocation", str(tmp_path / "c2")).outputMode("append").trigger(availableNow=True).start()
    ladder.awaitTermination()
    assert sorted(map(tuple, spark.table("ladder").collect()), key=str) == sorted(map(tuple, cycle.retry_ladder_batch(batch).collect()), key=str)


def test_transitions(spark):
    df = spark.createDataFrame([(None, "screening"), ("new", "done"), ("running", "queued")], "a string, b string")
    assert [r[0] for r in df.select(cycle.allowed(df.a, df.b)).collect()] == [True, False, True]
