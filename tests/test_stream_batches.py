"""A stream hands its arrivals to ``upload`` in as few batches as that takes them in passes."""

from reportlake.operators import load as L
from reportlake.plans.fixtures import LANDING_SPEC, write_named_gzip
from reportlake.session import shared_dir
from reportlake.streaming import ingest


def test_1100_arrivals_are_one_batch(spark):
    root, lake = shared_dir(spark, "many-arrivals"), shared_dir(spark, "many-lake")
    files = [(f"ledger__199501__o{k}__d1.csv.gz", f"key,price\n{k},1.00\n") for k in range(1100)]
    write_named_gzip(spark.createDataFrame(files, "name string, content string"), root)
    ingest.run_uploads(spark, root, [LANDING_SPEC], lake, shared_dir(spark, "many-checkpoint"))
    log = L.read_log(spark, lake)
    assert log.where("status = 'ok'").count() == 1100
    assert {r["load_id"][: len("stream-") + 9] for r in log.select("load_id").distinct().collect()} == {"stream-000000000"}
