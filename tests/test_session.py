"""Settings that registered queries run under."""

import __spark_entry__ as entry


def test_queries_bound_what_a_worker_is_handed(spark):
    """A session's own batches of 10,000 rows would be hundreds of megabytes of documents."""
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(name) for name in names]
    try:
        spark.conf.set(names[0], "10000")
        entry.queries()["field_fill"](spark, "/root/testdata/sf0.001").collect()
        rows, size = (int(spark.conf.get(name).removesuffix("b")) for name in names)
        assert rows <= 1000 and size <= 4 << 20
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
