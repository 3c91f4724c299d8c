import json

import pytest
from pyspark.sql import functions as F

from tallyfold import session
from tallyfold.schema import FEATURE_SCHEMA, RAW_SCHEMA, STATE, YEAR
from tallyfold.sources import documents, gazetteer, tables


def facts(spark):
    return spark.range(60).select(
        F.concat(F.lit("A/B & "), F.col("id") % 3).alias("STATE_UT"), F.concat(F.lit("D"), "id").alias("DISTRICT"),
        (F.col("id") % 4 + 2001).cast("int").alias("YEAR"),
        *[F.col("id").alias(f.name) for f in RAW_SCHEMA.fields[3:]])


def test_partitioned_write_prunes_and_keeps_names(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.audited_write(facts(spark), path) == {"rows": 60, "columns": 22}
    one = tables.read_table(spark, path, RAW_SCHEMA).filter((F.col(YEAR) == 2001) & (F.col(STATE) == "A/B & 0"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in plan
    assert one.count() == 5


def test_external_table_finds_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(facts(spark), path)
    assert tables.register_external(spark, "facts_ext_test", RAW_SCHEMA, path).count() == 60
    spark.sql("DROP TABLE facts_ext_test")


def test_gazetteer_keeps_document_order(spark, tmp_path):
    doc = {"districts": {"Zed": {"lat": 1.0, "lon": 2.0, "state": "Bihar"}, "Ab": {"lat": 3.0, "lon": 4.0, "state": "Goa"}},
           "state_fallbacks": {"Bihar": [25.0, 85.0]}}
    (tmp_path / "g.json").write_text(json.dumps(doc, indent=2))
    districts, states = gazetteer.read_gazetteer(spark, str(tmp_path / "g.json"))
    assert [tuple(r) for r in districts.orderBy("position").collect()] == [
        (0, "ZED", "BIHAR", 1.0, 2.0), (1, "AB", "GOA", 3.0, 4.0)]
    assert tuple(states.first()) == ("BIHAR", 25.0, 85.0)


def test_document_keeps_growing_sections_beside(spark, tmp_path):
    small = spark.range(3).select("id")
    path = str(tmp_path / "d")
    large = spark.range(10_001).select("id")
    documents.write_document({"a": small, "b": small, "c": large}, path, {"a": [-F.col("id")], "c": ["id"]}, growing=("c",))
    doc = json.loads(spark.read.text(path).first()[0])
    assert [r["id"] for r in doc["a"]] == [2, 1, 0] and len(doc["b"]) == 3
    assert documents.read_section(spark, path, "b", "struct<id:bigint>").count() == 3
    assert documents.read_section(spark, path, "c", "struct<id:bigint>").distinct().count() == 10_001


def test_scratch_follows_the_session_setting(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "hdfs://shared/check" if key == "spark.checkpoint.dir" else default

    class Context:
        def __init__(self, master, conf):
            self.master, self._conf, self.applicationId = master, conf, "app"

        def getConf(self):
            return self._conf

    class Empty:
        def get(self, key, default=None):
            return default

    class Fake:
        def __init__(self, master, conf):
            self.sparkContext, self.conf = Context(master, conf), conf

    assert session.scratch_root(Fake("yarn", Conf())) == "hdfs://shared/check"
    with pytest.raises(ValueError):
        session.scratch_root(Fake("yarn", Empty()))
    assert session.scratch_root(Fake("local[2]", Empty()))


def test_feature_schema_has_the_full_width():
    assert len(FEATURE_SCHEMA.fields) == 29
