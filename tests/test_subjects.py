"""Erasure reaches every layer and nobody else."""

from pyspark.sql import functions as F

from kinfold.operators.ingest import record_uid
from kinfold.operators.subjects import SubjectIndex
from kinfold.plans.customer import CUSTOMER
from kinfold.sources.tables import Layers

#: name, key, e-mail, status, entity: Ann is linked; Ann's spoiled copy and dead letters are in no entity.
PEOPLE = {"b1": [("C1", "ann@x.org", "VALID", "g1"), ("C2", "bob@x.org", "VALID", "g1"), ("C3", "cy@x.org", "VALID", "g3")],
          "b2": [("C1", "Ann@x.org ", "VALID", "g1"), ("C2", "bob@x.org", "VALID", "g2"), ("C9", "ann@x.org", "QUARANTINED", None),
                 ("C8", None, "QUARANTINED", None)]}
DEAD = {"b1": ["C1;torn line", "C11;torn line", None], "b2": ['{"CUST_ID": "C7", "EMAIL": "ANN@x.org"}', '{"CUST_ID": "C3"}', ""]}


def stored(spark, root):
    layers = Layers(spark, root)
    for batch, rows in PEOPLE.items():
        df = spark.createDataFrame([("CRM", *r) for r in rows], "source_id string, source_record_id string, email string, dq_status string, golden_id string")
        df = df.withColumn("record_uid", record_uid(F.col("source_id"), F.col("source_record_id")))
        layers.write(df.select("record_uid", "source_id", "source_record_id", "email"), "bronze", "customer_raw", batch)
        layers.write(df.drop("golden_id"), "silver", "customer_checked", batch)
        placed = df.filter("golden_id IS NOT NULL")
        layers.write(placed.select("golden_id", "record_uid", "source_id", "source_record_id"), "gold", "crosswalk", batch)
        layers.write(placed.select("golden_id", "email").dropDuplicates(["golden_id"]), "gold", "golden_customer", batch)
        dead = spark.createDataFrame([("CRM", p, "torn") for p in DEAD[batch]], "source_id string, payload string, reason string")
        layers.write(dead, "bronze", "dead_letters", batch)
    return layers


def test_an_erased_person_is_in_no_layer(spark, tmp_path):
    layers = stored(spark, str(tmp_path))
    index = SubjectIndex(layers, CUSTOMER)
    index.index_batch("b1")
    index.index_batch("b1")
    index.index_batch("b2")
    present = layers.read("gold", "crosswalk").groupBy("record_uid").agg(F.max_by(F.struct("golden_id"), "batch_id").alias("r")).select(
        "record_uid", "r.golden_id")
    present = spark.createDataFrame(present.collect(), "record_uid string, golden_id string")
    subjects = spark.createDataFrame([("g1",), ("g1",), (None,)], "golden_id string")

    def left(layer, name, column):
        return sorted((r["batch_id"], r[column] or "") for r in layers.read(layer, name).collect())
    done = index.erase(subjects, present, "b2-erased")
    for attempt in range(2):
        assert left("bronze", "customer_raw", "source_record_id") == [("b1", "C2"), ("b1", "C3"), ("b2", "C2"), ("b2", "C8")]
        assert left("silver", "customer_checked", "source_record_id") == [("b1", "C2"), ("b1", "C3"), ("b2", "C2"), ("b2", "C8")]
        assert left("bronze", "dead_letters", "payload") == [("b1", ""), ("b1", "C11;torn line"), ("b2", ""), ("b2", '{"CUST_ID": "C3"}')]
        assert left("gold", "crosswalk", "source_record_id") == [("b1", "C2"), ("b1", "C3"), ("b2", "C2")]
        # The entity that Ann and Bob once shared holds Ann's values; Bob's own one stays.
        assert left("gold", "golden_customer", "golden_id") == [("b1", "g3"), ("b2", "g2")]
        assert index.erase(subjects, present, "b2-erased-again") == [] or attempt
    assert ("silver", "customer_checked", "b2") in done and ("bronze", "dead_letters", "b2") in done


def test_only_batches_that_hold_the_person_are_rewritten(spark, tmp_path):
    layers = stored(spark, str(tmp_path))
    index = SubjectIndex(layers, CUSTOMER)
    for batch in PEOPLE:
        index.index_batch(batch)
    present = spark.createDataFrame([(layers.read("silver", "customer_checked").filter("source_record_id = 'C3'").first()["record_uid"], "g3")],
                                    "record_uid string, golden_id string")
    done = index.erase(spark.createDataFrame([("g3",)], "golden_id string"), present, "b3")
    assert sorted(done) == [("bronze", "customer_raw", "b1"), ("bronze", "dead_letters", "b2"), ("gold", "crosswalk", "b1"),
                            ("gold", "golden_customer", "b1"), ("silver", "customer_checked", "b1")]
