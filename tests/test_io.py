"""Readers and sinks: declared-schema reads, seed load, versioned commits,
materialisation, observed counts."""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from rosterline.sources.sinks import commit, commit_counted, materialize, version_path
from rosterline.sources.tables import TableSpec, load_seed, read_table

SEED = StructType([StructField("serial_number", IntegerType()), StructField("employee_id", StringType()),
                   StructField("group_name", StringType())])


def test_csv_seed_with_declared_schema(spark, tmp_path):
    p = tmp_path / "seed.csv"
    p.write_text("serial_number,employee_id,group_name\n1,E1,G1\n2,E2,G1\n")
    df = load_seed(spark, str(p), SEED)
    assert df.schema == SEED and df.count() == 2


def test_parquet_spec_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.col("id").cast("int").alias("a"), (F.col("id") * 2).alias("b")).write.parquet(path)
    df = read_table(spark, TableSpec(path=path)).select("a").where(F.col("a") > 5)
    assert sorted(r.a for r in df.collect()) == [6, 7, 8, 9]


def test_commit_versions_and_observed_count(spark, tmp_path):
    base = str(tmp_path)
    df = spark.range(5).withColumnRenamed("id", "k")
    v1 = commit(df, spark, "t", "1", base)
    paths = {}
    v2, n = commit_counted(v1.where(F.col("k") > 1), spark, "t", "2", base, paths=paths)
    assert n == 3 and v2.count() == 3 and v1.count() == 5          # v1 untouched
    assert paths["t"] == version_path(spark, "t", "2", base)


def test_materialize_registers_a_view(spark):
    df = materialize(spark.range(3), "tmp_three")
    assert spark.sql("SELECT count(*) AS n FROM tmp_three").first().n == 3
    df.unpersist()


def test_commit_refuses_to_overwrite_its_own_input(spark, tmp_path):
    import pytest
    base = str(tmp_path)
    v1 = commit(spark.range(3), spark, "t", "1", base)
    with pytest.raises(ValueError):
        commit(v1, spark, "t", "1", base)
    assert v1.count() == 3


def test_cli_sync_and_query(spark, sf_small, tmp_path, capsys):
    import json
    from rosterline.__main__ import main
    from rosterline.sources.standins import Tables
    T = Tables(spark, sf_small)
    conf = {"tables": {}, "params": {"dept_map": [{"dept": "BUILDING", "factory": "1060"}], "default_secret": "s", "run_salt": "r"},
            "out": str(tmp_path / "out")}
    for name in ("roster", "accounts", "logons", "people"):
        path = str(tmp_path / name)
        getattr(T, name).write.parquet(path)
        conf["tables"][name] = {"path": path}
    cfg = tmp_path / "conf.json"
    cfg.write_text(json.dumps(conf))
    assert main(["--master", "local[8]", "sync", "--config", str(cfg)]) == 0
    out = capsys.readouterr().out
    assert "1 acct_insert_missing: ok" in out and "accounts:" in out
    assert spark.read.parquet(str(tmp_path / "out" / "results")).count() == 8
    assert main(["--master", "local[8]", "query", "link_profile", "--data", sf_small,
                 "--out", str(tmp_path / "q")]) == 0
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1


def test_tables_notice_a_replaced_file(spark, sf_small, tmp_path):
    import os
    import shutil
    from rosterline.sources.standins import Tables
    for name in ("customer", "supplier"):
        shutil.copy(f"{sf_small}/{name}.parquet", tmp_path)
    first = Tables(spark, str(tmp_path))
    n = first.roster.count()
    assert Tables(spark, str(tmp_path)).roster is first.roster
    spark.read.parquet(f"{sf_small}/customer.parquet").limit(7).coalesce(1).write.parquet(str(tmp_path / "new"))
    part = next(f for f in os.listdir(tmp_path / "new") if f.endswith(".parquet"))
    os.replace(tmp_path / "new" / part, tmp_path / "customer.parquet")
    assert n > 7 and Tables(spark, str(tmp_path)).roster.count() == 7
