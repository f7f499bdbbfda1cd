"""Views that last beyond a session, and tables by tenant."""

import uuid

import pytest
from conftest import SF, got
from pyspark.sql import functions as F

from checks.testbed import PARAMS, sources
from crewlens import plans, publish


@pytest.fixture
def name(spark):
    name = f"default.v_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for table in publish.versions(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def data(spark, rows):
    return spark.createDataFrame(rows, "label string, company_id bigint, `odd name` int")


FIRST = [("a", 1, 1), ("b", 2, 2), ("b2", 2, None), ("c", 3, 3)]


def test_another_session_reads_rows_description_and_tags(spark, name, tmp_path):
    publish.publish(data(spark, FIRST), name, str(tmp_path), description="The tenant's rows", tags=["dashboards", "x"], properties={"owner": "me"})
    other = spark.newSession()
    assert got(other.table(name)) == got(data(spark, FIRST)) and other.table(name).dtypes == data(spark, FIRST).dtypes
    described = {r[0]: r[1] for r in other.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert described["Comment"] == "The tenant's rows" and described["Type"] == "VIEW"
    properties = {r[0]: r[1] for r in other.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["tags"] == "dashboards,x" and properties["owner"] == "me"


def test_only_the_tenants_of_a_run_change_and_empty_ones_go(spark, name, tmp_path):
    first = publish.publish(data(spark, FIRST), name, str(tmp_path))
    publish.publish(data(spark, [("new", 1, 9)]), name, str(tmp_path), tenants=[1, 2])
    assert got(spark.newSession().table(name)) == got(data(spark, [("new", 1, 9), ("c", 3, 3)]))
    # The version before still has its rows; tenant 3 is listed from its folder.
    assert got(spark.table(first), "label", "company_id") == got(data(spark, FIRST), "label", "company_id")
    publish.publish(data(spark, []), name, str(tmp_path), tenants=[3])
    assert got(spark.table(name)) == got(data(spark, [("new", 1, 9)]))
    publish.publish(data(spark, FIRST[:1]), name, str(tmp_path))
    assert got(spark.table(name)) == got(data(spark, FIRST[:1]))
    publish.publish(data(spark, []), name, str(tmp_path))
    assert got(spark.table(name)) == []


def test_one_tenant_reads_its_folder_alone(spark, name, tmp_path):
    publish.publish(data(spark, FIRST), name, str(tmp_path))
    one = spark.table(name).where("company_id = 2")
    assert {f.rsplit("/", 2)[1] for f in one.inputFiles()} == {"company_id=2"}
    assert "PartitionFilters: [isnotnull(company_id" in one._jdf.queryExecution().executedPlan().toString()


def test_a_run_that_fails_leaves_the_old_rows(spark, name, tmp_path):
    publish.publish(data(spark, FIRST), name, str(tmp_path))
    broken = data(spark, FIRST).withColumn("label", F.when(F.col("company_id") == 3, F.raise_error(F.lit("stop"))).otherwise("x"))
    with pytest.raises(Exception, match="stop"):
        publish.publish(broken, name, str(tmp_path), tenants=[1, 2, 3])
    with pytest.raises(ValueError, match="does not stand for: 3"):
        publish.publish(data(spark, FIRST), name, str(tmp_path), tenants=[1, 2])
    with pytest.raises(ValueError, match="None"):
        publish.publish(data(spark, [("n", None, 1)]), name, str(tmp_path))
    with pytest.raises(ValueError, match="other columns"):
        publish.publish(data(spark, FIRST[:1]).drop("label"), name, str(tmp_path), tenants=[1])
    assert got(spark.table(name)) == got(data(spark, FIRST))


def test_old_versions_are_forgotten_and_their_folders_named(spark, name, tmp_path):
    publish.publish(data(spark, FIRST), name, str(tmp_path))
    publish.publish(data(spark, [("new", 1, 9)]), name, str(tmp_path), tenants=[1, 2])
    folders = [str(p) for p in tmp_path.glob("*/*/company_id=*")]
    assert len(folders) == 4 and publish.unlisted(spark, name, folders) == []
    assert len(publish.forget_versions(spark, name)) == 1 and len(publish.versions(spark, name)) == 1
    gone = publish.unlisted(spark, name, folders)
    assert sorted(f.rsplit("=")[-1] for f in gone) == ["1", "2"]
    assert got(spark.table(name)) == got(data(spark, [("new", 1, 9), ("c", 3, 3)]))


def test_jobs_are_published_for_some_tenants(spark, tmp_path):
    src = sources(spark, SF)
    jobs = ["technicians_employees", "wip_appointments"]
    prefix = f"p{uuid.uuid4().hex[:6]}_"
    names = publish.publish_all(src, str(tmp_path), PARAMS, prefix=prefix, jobs=jobs)
    try:
        assert got(spark.newSession().table(names[1])) == got(plans.wip_appointments(src, PARAMS))
        publish.publish_all(src, str(tmp_path), PARAMS, prefix=prefix, jobs=jobs[1:], tenants=[2])
        assert got(spark.table(names[1])) == got(plans.wip_appointments(src, PARAMS))
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {names[1]}").collect()}
        assert described["Comment"] == "View WIP APPOINTMENTS"
    finally:
        for n in names:
            tables = publish.versions(spark, n)
            spark.sql(f"DROP VIEW {n}")
            for t in tables:
                spark.sql(f"DROP TABLE {t}")


def test_a_table_loses_tenants_that_became_empty(spark):
    table = f"t_{uuid.uuid4().hex[:8]}"
    try:
        publish.write_table(spark, data(spark, FIRST), table)
        publish.write_table(spark, data(spark, [("new", 1, 9), ("four", 4, 4)]), table, tenants=[1, 2, 4])
        assert got(spark.table(table).select("label", "company_id")) == [("c", 3), ("four", 4), ("new", 1)]
        assert len(spark.sql(f"SHOW PARTITIONS {table}").collect()) == 3
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
