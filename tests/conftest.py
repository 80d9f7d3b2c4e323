import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(table):
    names = sorted(table.column_names)

    def one(v):
        return int(v) if type(v).__name__ == "Decimal" and v == int(v) else v

    return names, sorted((tuple(repr(one(v)) for v in row) for row in zip(*[table.column(n).to_pylist() for n in names], strict=True)))


@pytest.fixture(scope="session")
def same(spark, duck):
    def check(name):
        import __spark_entry__ as entry

        assert plain(entry.queries()[name](spark, SF).toArrow()) == plain(duck.sql(entry.oracle_sql()[name]).to_arrow_table())

    return check
