import os

from pyspark.sql import functions as F

from ledgerlight.checks.inputs import Inputs
from ledgerlight.checks.registry import QUERIES
from ledgerlight.operators.facts import flatten_facts
from ledgerlight.session import scratch_path

FOLDER = "/root/testdata/sf0.001"


def test_packed_documents_take_a_fraction_of_their_text(spark):
    found = QUERIES["src1_read_company_facts"](spark, FOLDER)
    blobs = Inputs(spark, FOLDER).blobs
    assert sorted(map(str, found.collect())) == sorted(map(str, flatten_facts(blobs).collect()))
    path = scratch_path(spark, "facts-documents").removeprefix("file:")
    written = sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path) if name.startswith("part-"))
    assert 0 < 3 * written < blobs.agg(F.sum(F.octet_length("raw"))).first()[0]
