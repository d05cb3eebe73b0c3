"""Working tables go when their user is done with them."""

import os

from lumetry.llm import near_duplicates
from lumetry.llm.common import fresh, settled, working_tables

from .conftest import prose


def test_working_tables_go(spark):
    docs = spark.createDataFrame([(i, prose(i % 3, 60)) for i in range(9)], "doc_id LONG, text STRING")

    def root():
        return spark.sparkContext.getConf().get("spark.checkpoint.dir")

    before = set(os.listdir(root()))
    with working_tables(spark):
        found = settled(near_duplicates.near_duplicates(docs), "found", keep=True)
        inside = set(os.listdir(root())) - before
        assert len(inside) > 5
    left = set(os.listdir(root())) - before
    assert len(left) == 1 and found.count() == 9
    settled(docs)
    assert len(set(os.listdir(root())) - before) == 2  # outside, nothing is deleted


def test_fresh_names():
    assert fresh("id", ["text"]) == "id" and fresh("id", ["ID", "_id"]) == "__id"
