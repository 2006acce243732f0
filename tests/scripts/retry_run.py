"""Run queries twice in a session that retries failed tasks: once plain and
once with the first attempt of some input tasks failing; print whether the
results are identical.  Started as a subprocess by test_retry.py (a task
retry budget needs its own SparkContext)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import knn as K  # noqa: E402
from tessera.plans import reconcile as rec  # noqa: E402
from tessera.plans import views  # noqa: E402
from tessera.session import get_session, scratch_dir, table  # noqa: E402

SF = "/root/testdata/sf0.001"


def flaky(df):
    """Pass rows through; the first attempt of every even partition fails
    after reading its input (a lost task)."""
    def run(batches):
        ctx = TaskContext.get()
        rows = list(batches)
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected task loss")
        yield from rows
    return df.repartition(4).mapInPandas(run, df.schema)


def snapshot(spark, wrap):
    probes, auth = views.normalized(spark, SF), views.authority(spark, SF)
    r = rec.reconcile(wrap(probes), wrap(auth)).withColumn("_o", F.col("irn").cast("bigint"))
    return sorted(map(tuple, rec.batch_snapshots(r, 20, "_o").drop("_o").collect()))


def knn(spark, wrap):
    e = table(spark, SF, "embeddings").select("vec_id", "embedding")
    out = K.knn_join(wrap(e), wrap(e), 3, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding",
                     exclude_self=True)
    return sorted(map(tuple, out.collect()))


def retrieval(spark, wrap):
    from tessera.operators.chunking import fixed_chunks
    from tessera.plans import retrieve as R
    docs = wrap(table(spark, SF, "documents").select("doc_id", "source", "text"))
    qs = table(spark, SF, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    out = R.retrieve(qs, fixed_chunks(docs, 300, 100), 3, 64, min_relevance=0.5)
    return sorted(map(tuple, out.collect()))


def main():
    spark = get_session("local[4,3]", app="tessera-retry", shuffle_partitions=4)
    scratch_dir(spark)
    same = lambda df: df.repartition(4)
    ok = (snapshot(spark, same) == snapshot(spark, flaky) and knn(spark, same) == knn(spark, flaky)
          and retrieval(spark, same) == retrieval(spark, flaky))
    print("RETRY_SAME" if ok else "RETRY_DIFF")
    spark.stop()


if __name__ == "__main__":
    main()
