"""Queries on keys of larger tables than the given ones, against DuckDB with wider numbers in its SQL."""

import os
import re

import duckdb
import pytest
from test_queries import DIR, plain

from quillon.plans import catalogue

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


@pytest.fixture(scope="module")
def far(tmp_path_factory):
    """The smallest tables with part keys from 200 000 on, whose products with the codes' factor are over 64 bits."""
    out, c = tmp_path_factory.mktemp("far"), duckdb.connect()
    for f in os.listdir(DIR):
        key = {"part.parquet": "p_partkey", "lineitem.parquet": "l_partkey"}.get(f)
        c.execute(f"copy (select *{f' replace ({key} + 200000 as {key})' if key else ''} from '{DIR}/{f}') to '{out}/{f}' (format parquet)")
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{out}/{f}'")
    return str(out), c


@pytest.mark.parametrize("name", ["adapter_clip", "aligner_loader", "bam_files", "barcode_exact_counts", "barcode_n_rescue", "barcode_neighbor_join_k2", "chimera_breakpoints", "clip_extension", "fasta_chromosomes"])
def test_codes_of_large_keys(spark, far, name):
    path, c = far
    wide = re.sub(r"\((\w+) \* 98245165300007( \+ 57885161)?\) % 1125899906842624", r"cast((\1::hugeint * 98245165300007\2) % 1125899906842624 as bigint)", catalogue.ORACLE[name])
    assert wide != catalogue.ORACLE[name]
    assert plain(catalogue.QUERIES[name](spark, path).toPandas()) == plain(c.execute(wide).fetchdf())
