"""A batch in which every first attempt of a Python task dies: python -m tests.lossy_run folder"""

import os
import sys

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from pagemill.functions.html import EXTRACT_TYPE, page_text
from pagemill.plans.batch import LEDGER_DDL, Layout, clean_corpus, read_table, run_batch
from pagemill.session import session
from pagemill.sources.warc import archive_listing
from tests.archives import members, page, put, response



def main(folder: str) -> None:
    spark = session(
        "local[4,4]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    spark.sparkContext.setLogLevel("OFF")

    @F.arrow_udf(EXTRACT_TYPE)
    def dying(pages: pa.Array) -> pa.Array:
        context = TaskContext.get()
        if context.attemptNumber() == 0:
            if context.partitionId() % 2:
                os._exit(1)  # the worker process is gone
            raise RuntimeError("first attempt")
        rows = [(None, None, None) if p is None else page_text(p.decode()) for p in pages.to_pylist()]
        return pa.array([dict(zip(("text", "route", "n_segments"), r)) for r in rows], pages_type())

    def pages_type() -> pa.DataType:
        return pa.struct([("text", pa.string()), ("route", pa.string()), ("n_segments", pa.int32())])

    layout = Layout(folder)
    for n in range(6):
        put(layout.landing, f"f{n}.warc.gz", members(*(response(page(100 * n + i)) for i in range(5))))
    files = archive_listing(spark, layout.landing)
    run_batch(spark, files, layout, extractor=dying)
    got = sorted((r.basename, r.value) for r in clean_corpus(spark, layout).collect())
    want = sorted(
        (f"f{n}.warc.gz", page_text(page(100 * n + i).decode())[0]) for n in range(6) for i in range(5)
    )
    assert got == want
    assert read_table(spark, layout.ledger, LEDGER_DDL).count() == 6
    print("same result")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
