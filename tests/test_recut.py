"""Hits fetch their text from their own documents only, whatever the ids."""

from tessera.operators.chunking import fixed_chunks
from tessera.plans import retrieve as R
from tessera.session import table

SF = "/root/testdata/sf0.001"


def test_recut_hits_equal_a_join_with_all_chunks(spark):
    docs = table(spark, SF, "documents").select("doc_id", "source", "text").limit(80)
    odd = [(-7, "s", "negative ids cut from the corpus " * 30), (1 << 50, "s", "hashed chunk ids of large documents " * 30), (-(1 << 60), "s", "another large id " * 40), (9_999_999, "s", None),
           (9_999_998, "s", "word " * 230_000 + "needle in a very long document")]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    asked = [(1, "negative ids cut"), (2, "hashed chunk ids"), (3, "another large id"), (4, "needle in a very long document"), (5, "the and of"), (6, "")]
    questions = spark.createDataFrame(asked, "query_id long, text string")

    def cut(d):
        return fixed_chunks(d, 300, 100)

    def rows(df):
        return sorted(map(tuple, df.select("query_id", "rk", "chunk_id", "doc_id", "start_index", "chunk", "source", "distance").collect()), key=repr)

    want = rows(R.hits_for(questions, cut(docs)))
    assert rows(R.hits_for(questions, cut(docs), cut=(docs, cut))) == want and len(want) >= 15
    assert {r[3] for r in want} >= {-7, 1 << 50, -(1 << 60)}
