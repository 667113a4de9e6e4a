from pyspark.sql import functions as F

from tillroll.llm import quality as Q


def test_held_out_accuracy(spark):
    d, s = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), "/root/testdata/sf0.1/labels.parquet"
    got = Q.report(d, spark.read.parquet(s)).join(spark.read.parquet(s), "doc_id").filter("held_out and quality is not null")
    r = got.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right")).collect()
    right = {x.quality: x.right for x in r}
    print(right)
    assert right[1] > 0.97 and right[0] > 0.9


def test_cases(spark):
    rows = [(k, "plain words go here " * 5 if k % 2 else "BAD!! BAD!! $$$ " * 5, "x") for k in range(80)]
    rows += [(None, "plain words", "x"), (200, None, "x"), (201, "", "x"), (1, "plain words", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)] + [(None, 1), (3, None), (5, 1)], "doc_id long, quality int")
    got = Q.report(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and 1 < r.doc_id < 80)
    assert Q.keep(docs, labels).columns == docs.columns
    assert {r.score for r in Q.report(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.report(docs.limit(0), labels).count() == 0


def test_keep_returns_columns_of_clashing_names(spark):
    rows = [(k, "good words here " * 9 if k % 2 else "x1 !! zz " * 9, -7.0, "p") for k in range(200)] + [(3, "another text", -7.0, "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, predicted string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    kept = Q.keep(docs, labels)
    got = kept.collect()
    assert kept.columns == docs.columns and got and {(r.score, r.predicted) for r in got} == {(-7.0, "p")}
    assert sorted(map(tuple, got)) == sorted(map(tuple, Q.keep(docs.orderBy(F.rand(1)), labels).collect()))  # whatever the order of the rows
