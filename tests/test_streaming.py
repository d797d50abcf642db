"""Streaming forms: same results as the batch, idempotent on replay."""

from pyspark.sql import functions as F

from kinfold.operators import linkage
from kinfold.plans.customer import AS_OF, CUSTOMER
from kinfold.sources.tables import Layers
from kinfold.streaming import micro_batch
from test_linkage import COLUMNS, frame, make


def test_replayed_epoch_overwrites_itself(spark, tmp_path):
    """A checkpoint lost after the sink wrote: the same epoch runs again and changes nothing."""
    records = frame(spark, make(9, 40)).withColumns({"source_id": F.lit("S"), "source_record_id": F.col("record_uid"),
                                                     "source_updated_at": F.lit("2026-07-01"), "city": F.lit("x"), "state": F.lit("y")})
    records.write.parquet(str(tmp_path / "in"))
    layers = Layers(spark, str(tmp_path / "tables"))
    results = []
    for attempt in ("one", "two"):
        stream = spark.readStream.schema(records.schema).parquet(str(tmp_path / "in"))
        micro_batch.check(stream, CUSTOMER, layers, str(tmp_path / f"checkpoint-{attempt}"), AS_OF).awaitTermination()
        results.append(sorted(tuple(map(str, r)) for r in layers.read("silver", "customer_checked").select(
            "record_uid", "batch_id", "dq_status").collect()))
    assert results[0] == results[1] and len(results[0]) == 40


def test_matching_epoch_by_epoch_equals_one_batch(spark, tmp_path):
    data = make(21, 45)
    schema = frame(spark, data).schema
    layers = Layers(spark, str(tmp_path / "tables"))
    for i in range(3):
        frame(spark, data[i * 15:(i + 1) * 15]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        micro_batch.match(stream, CUSTOMER, layers, str(tmp_path / "checkpoint")).awaitTermination()
    last = layers.read("gold", "entity_clusters", micro_batch.epoch_id(2)).select("record_uid", "root_uid", "cluster_id")
    whole = linkage.clusters(frame(spark, data), CUSTOMER.matching).select("record_uid", "root_uid", "cluster_id")
    assert {tuple(r) for r in last.collect()} == {tuple(r) for r in whole.collect()}
    assert set(COLUMNS) <= set(layers.read("silver", "customer_store").columns)


def test_repeated_keys_across_micro_batches(spark, tmp_path):
    rows = [(1, "2026-01-01 00:00:00"), (2, "2026-01-01 00:10:00"), (1, "2026-01-01 00:20:00")]
    for i, row in enumerate(rows):
        spark.createDataFrame([row], "k int, t string").withColumn("t", F.to_timestamp("t")).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, t timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    (micro_batch.distinct_within(stream, ["k"], "t", "1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out"))
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination())
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_uniqueness_across_epochs(spark, tmp_path):
    """A key fails where it was in an earlier epoch or is repeated in its own; a replayed epoch sees those before it only."""
    epochs = [["a", "b", None], ["a", "c", "c"], ["b", "d", None, "a"], ["c", "e"]]
    rule = {"rule_id": "E1", "rule_type": "unique", "columns": ["email"], "severity": "WARN", "description": "once"}
    base = frame(spark, make(9, 1)).withColumns({
        "source_id": F.lit("S"), "source_record_id": F.lit("r"), "source_updated_at": F.lit("2026-07-01"), "city": F.lit("x"), "state": F.lit("y")})
    layers, n = Layers(spark, str(tmp_path / "tables")), 0
    for i, keys in enumerate(epochs):
        rows = spark.createDataFrame([(f"u{n + k}", e and f"{e}@x.org") for k, e in enumerate(keys)], "uid string, mail string")
        n += len(keys)
        (base.crossJoin(rows).withColumns({"record_uid": F.col("uid"), "source_record_id": F.col("uid"), "email": F.col("mail")})
         .drop("uid", "mail").write.mode("append").parquet(str(tmp_path / "in")))
        stream = spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
        micro_batch.check(stream, CUSTOMER, layers, str(tmp_path / "checkpoint"), AS_OF, [rule]).awaitTermination()
    failed = F.exists("dq_failures", lambda f: f["rule_id"] == "E1")

    def flagged():
        return {r[0] for r in layers.read("silver", "customer_checked").filter(failed).select("record_uid").collect()}
    assert flagged() == {"u3", "u4", "u5", "u6", "u8", "u9", "u10"}
    # All epochs in one, from a lost checkpoint: the store starts again, nothing of the first run is seen.
    again = spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
    micro_batch.check(again, CUSTOMER, layers, str(tmp_path / "lost"), AS_OF, [rule]).awaitTermination()
    first = layers.read("silver", "customer_checked", micro_batch.epoch_id(0)).filter(failed)
    assert {r[0] for r in first.select("record_uid").collect()} == {"u0", "u1", "u2", "u3", "u4", "u5", "u6", "u8", "u9", "u10"}
