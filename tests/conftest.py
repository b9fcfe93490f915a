from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("keyferry-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def store(spark):
    from keyferry.session import fresh_path, unique_name
    from keyferry.sinks.keyed import KeyedStore

    st = KeyedStore(spark, unique_name("t_ks"), fresh_path(spark, "test-store"))
    st.create_keyspace()
    return st


@pytest.fixture()
def workdir(spark):
    from keyferry.session import fresh_path

    return fresh_path(spark, "test-work")
