from difframe import schema
from difframe.runtime import table


def test_given_tables_conform(spark, sf):
    for name in ("cod_data", "reference_patterns", "reference_patterns_pymatgen", "atomic_sites", "failed_patterns_pymatgen"):
        assert schema.differences(table(spark, sf, name), name) == [], name


def test_every_schema_reads(spark):
    for name in schema.TABLES:
        assert schema.empty(spark, name).columns == schema.schema(name).names


def test_conformed(spark):
    df = spark.createDataFrame([("7", "x", 1), ("bad", "y", 2)], "cod_id string, label string, extra int")
    got = schema.conformed(df, "atomic_sites")
    assert schema.differences(got, "atomic_sites") == [] and got.columns == schema.schema("atomic_sites").names
    assert [(r.cod_id, r.label, r.occupancy) for r in got.collect()] == [(7, "x", None), (None, "y", None)]
    assert len(schema.differences(df, "atomic_sites")) == 9
