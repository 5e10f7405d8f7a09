import glob
import os

import pytest
from pyspark.sql import functions as F

from scoreline.llm import base as B
from scoreline.llm.graph import components


def test_words_split_alike(spark):
    text = "a\tb\nc\x0bd\x0ce\rf  g\xa0h\x85i j\x1ck "
    assert len(text.encode().split()) == spark.createDataFrame([(text,)], "t string").select(F.regexp_count("t", F.lit(B.WORD))).first()[0] == 7


def test_work_folder_is_the_cluster_s_own(spark, tmp_path, monkeypatch):
    class Far:
        conf = type("C", (), {"get": staticmethod(lambda k, d: f"file://{tmp_path}/shared/" if k == "spark.checkpoint.dir" else d)})

    assert B.shared_dir(Far) == f"file://{tmp_path}/shared"
    monkeypatch.setattr(B, "shared_dir", lambda s: f"file://{tmp_path}/shared")
    w = B.Workspace(spark, "t")
    df = w.put(spark.range(10).withColumn("k", F.col("id") % 2), partition_by="k")
    assert df.count() == 10 and glob.glob(f"{tmp_path}/shared/t-*/1")
    w.drop(df)
    assert not glob.glob(f"{tmp_path}/shared/t-*/1")


def test_local_mode_has_a_folder_of_its_own(spark):
    assert os.path.isdir(B.shared_dir(spark)) and B.shared_dir(spark) == B.shared_dir(spark)


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    class Far:
        conf = type("C", (), {"get": staticmethod(lambda k, d: d)})
        sparkContext = type("S", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        B.shared_dir(Far)


def test_boxed_columns_come_back(spark):
    df = spark.createDataFrame([(1, "a", 2, 3)], "id long, text string, row int, `x.y` int")
    got = df.select(B.boxed(df, "text"), F.lit("new").alias("t")).select(*B.unboxed(df, text=F.col("t")))
    assert got.columns == df.columns and tuple(got.first()) == (1, "new", 2, 3)


@pytest.mark.parametrize("edges, want", [
    ([], {}),
    ([(1, 1)], {}),
    ([(5, 4), (4, 3), (9, 8), (3, 5)], {3: 3, 4: 3, 5: 3, 8: 8, 9: 8}),
    ([(k, k + 1) for k in range(40)], {k: 0 for k in range(41)}),
    ([(100, k) for k in range(30)] + [(200, 29)], {**{k: 0 for k in range(30)}, 100: 0, 200: 0}),
    ([(-(2**63), 2**63 - 1)], {-(2**63): -(2**63), 2**63 - 1: -(2**63)}),
])
def test_components(spark, edges, want):
    df = spark.createDataFrame(edges, "a long, b long")
    got = components(B.Workspace(spark, "t"), df).collect()
    assert {r.node: r.root for r in got} == want and len(got) == len(want)


def test_release_removes_what_was_staged_since(spark):
    import os

    from scoreline.llm import base as B

    kept = B.Workspace(spark, "kept")
    a = kept.put(spark.range(3))
    mark = B.made()
    gone = B.Workspace(spark, "gone")
    b, c = gone.put(spark.range(2)), gone.put_bucketed(spark.range(5), "id")
    assert b.count() == 2 and c.count() == 5
    B.release(mark)
    assert B.made() == mark and a.count() == 3
    assert not os.path.exists(gone.root) and os.path.exists(kept.root)
