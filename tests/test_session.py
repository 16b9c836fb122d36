"""Tables that jobs write on their way."""

import pytest

from playtrail.operators import state as st
from playtrail.session import fresh_path, intermediate, shared_folder


def folders(spark, label):
    place = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    fs = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return {f.getPath().getName() for f in fs.listStatus(place) if f.getPath().getName().startswith(label)} if fs.exists(place) else set()


def test_intermediate_tables_go_with_the_block(spark, tmp_path):
    rows = spark.range(5).toDF("n")
    with intermediate(spark):
        st.settled(rows, "kept-outer").write.parquet(str(tmp_path / "out"))
        with intermediate(spark):
            st.settled(rows, "gone-inner")
            assert len(folders(spark, "gone-inner")) == 1
        assert not folders(spark, "gone-inner") and len(folders(spark, "kept-outer")) == 1
    assert not folders(spark, "kept-outer") and spark.read.parquet(str(tmp_path / "out")).count() == 5
    with pytest.raises(ZeroDivisionError), intermediate(spark):
        st.settled(rows, "gone-failed")
        1 / 0
    assert not folders(spark, "gone-failed")


def test_outside_a_block_tables_stay(spark):
    path = fresh_path(spark, "stays")
    spark.range(3).write.parquet(path)
    with intermediate(spark):
        pass
    assert spark.read.parquet(path).count() == 3
