"""The command line, end to end on small tables."""

import uuid

from tidemark import cli
from tidemark.operators import conform
from tidemark.plans.schemas import NARROW_FACT, WIDE_FACT
from tidemark.session import work_root


def test_sync_check_migrate_monitor(spark, sf, capsys):
    root = f"{work_root(spark)}/cli-{uuid.uuid4().hex}"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    orders.write.parquet(f"{root}/src/dwh/FactOrders")
    spark.read.parquet(f"{sf}/nation.parquet").write.parquet(f"{root}/src/dwh/DimNation")
    rows = [("dwh", "FactOrders", "stg", "FactOrders", "o_orderdate", "o_orderkey", "Y"), ("dwh", "DimNation", "stg", "DimNation", None, "n_nationkey", "y")]
    spark.createDataFrame(rows, ["Source_Schema", "Source_table_name", "Target_Schema", "Target_Table_Name", "Date_Column_Name", "PK_Column_Name", "Enabled "]
                          ).coalesce(1).write.option("header", True).csv(f"{root}/control.csv")
    sync = ["sync", "--control", f"{root}/control.csv", "--source", f"{root}/src", "--target", f"{root}/stage", "--meta", f"{root}/meta", "--as-of", "2002-01-01 00:00:00"]
    assert cli.main(sync, spark) == 0
    assert cli.main(["monitor", "--meta", f"{root}/meta"], spark) == 0
    assert "FactOrders" in capsys.readouterr().out

    migrate = ["migrate", "--source", f"{root}/src/dwh/FactOrders", "--key", "o_orderkey", "--staged", f"{root}/staged", "--target", f"{root}/moved",
               "--log", f"{root}/ranges", "--target-rows", "4000"]
    assert cli.main(migrate, spark) == 0
    check = ["check", "--source", f"{root}/src/dwh/FactOrders", "--target", f"{root}/moved", "--table", "FactOrders", "--key", "o_orderkey",
             "--not-null", "o_custkey", "--numeric", "o_totalprice", "--meta", f"{root}/meta"]
    assert cli.main(check, spark) == 0
    orders.filter("o_orderkey % 3 > 0").write.parquet(f"{root}/short")
    check[4] = f"{root}/short"
    assert cli.main(check, spark) == 1


def test_declared_schemas(spark):
    wide, narrow = conform.as_schema(WIDE_FACT), conform.as_schema(NARROW_FACT)
    assert (len(wide), len(narrow)) == (42, 14)
    row = spark.createDataFrame([(1, 250, 0.15, "x" * 40)], "FactSalesID bigint, VATApplicable int, VATPercentage double, StoreProductDesc string")
    got = conform.conform(row, wide).first()
    assert (got.VATApplicable, str(got.VATPercentage), len(got.StoreProductDesc), got.FileId) == (250, "0.15000", 30, None)
