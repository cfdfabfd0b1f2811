"""Whole barcodes in the report of types; pieces of a read that meet without being dealt out."""

import os
import re

import pytest
from pyspark.sql import functions as F
from test_queries import DIR

from quillon.plans import catalogue, fixtures

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


def test_types_are_of_whole_barcodes(spark):
    got = catalogue.QUERIES["barcode_types"](spark, DIR).first()
    assert got.types == fixtures.derived(spark, DIR, "reads").agg(F.count_distinct("barcode")).first()[0] > 256


@pytest.mark.parametrize("name", ["alignment_scores", "alignment_validity", "cigar_forms"])
def test_lines_are_dealt_out_and_not_their_pieces(spark, name):
    plan = catalogue.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert [c.split("#")[0] for c in re.findall(r"Exchange hashpartitioning\((\w+#)", plan)] == ["l_orderkey"]
