"""Operators in a session in which others have run before."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from fixtures_llm import documents
from tickloom.llm import secret_scan


def test_a_scan_follows_an_observation(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 3
    rows = [(i, f'text {i} token = "{"%032x" % (i * 7919**7)}" and path/of/the/file/number/{i}') for i in range(60)]
    found = secret_scan.scan(documents(spark, rows)).collect()
    assert {r.doc_id for r in found} == set(range(60))
