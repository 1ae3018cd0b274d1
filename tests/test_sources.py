"""Sources, sinks, the shared folder."""

import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from roomsight import constants as K, session
from roomsight.plans import features, training
from roomsight.sources import files, sqlite


@pytest.fixture()
def database(tmp_path):
    path = str(tmp_path / "gas.db")
    with sqlite3.connect(path) as con:
        names = ", ".join(
            f'"{c}" ' + ("INTEGER" if K.SOURCE_COLUMNS[c] == K.SESSION else
                         "REAL" if K.SOURCE_COLUMNS[c] in K.NUMERIC else "TEXT")
            for c in K.SOURCE_COLUMNS)
        con.execute(f"CREATE TABLE readings ({names})")
        marks = ", ".join("?" * len(K.SOURCE_COLUMNS))
        for i in range(101):
            row = [i % 4 if o == K.SESSION else
                   (None if i % 10 == 0 else i + 0.5) if o in K.NUMERIC else f"v{i}"
                   for o in K.SOURCE_COLUMNS.values()]
            con.execute(f"INSERT INTO readings VALUES ({marks})", row)
        con.execute("CREATE TABLE blank (a INTEGER)")
    return path


@pytest.mark.parametrize("tasks", [1, 7, 500])
def test_sqlite_scan(spark, database, tasks):
    df = sqlite.read_sqlite(spark, database, "readings", tasks)
    assert df.columns == ["reading_seq", *K.SOURCE_COLUMNS]
    assert df.rdd.getNumPartitions() == min(tasks, 101)
    bound = files.bind_columns(df)
    assert bound.columns == ["reading_seq", *K.SOURCE_COLUMNS.values()]
    assert bound.count() == 101 and bound.select("reading_seq").distinct().count() == 101
    assert bound.where(F.col("humidity").isNull()).count() == 11
    row = bound.where("reading_seq = 2").first()
    assert (row["session_id"], row["temperature"], row["hvac_mode"]) == (1, 1.5, "v1")


def test_sqlite_empty_and_unknown(spark, database):
    assert sqlite.read_sqlite(spark, database, "blank").count() == 0
    with pytest.raises(Exception, match="no table"):
        sqlite.read_sqlite(spark, database, "other")


def test_binding_needs_every_column(spark):
    with pytest.raises(ValueError, match="missing columns"):
        files.bind_columns(spark.createDataFrame([(1,)], "a int"))


def test_csv(spark, tmp_path):
    schema = StructType([StructField("a", DoubleType()), StructField("b", StringType())])
    df = spark.createDataFrame([(1.5, "x,y"), (None, None), (float("nan"), 'q"z')], schema)
    path = str(tmp_path / "csv")
    files.write_csv(df, path)
    files.write_csv(df, path)
    back = files.read_csv(spark, path, schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        [(1.5, "x,y"), (None, None), (None, 'q"z')], key=repr)
    (tmp_path / "bad.csv").write_text("a,b\nword,x\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()


def test_csv_keeps_texts_as_they_are(spark, tmp_path):
    texts = ["  a b ", "two\nlines", "cr\r\nlf", "bare\rcr", 'say "x", \\ and \\"', "", " ", '"', "\t",
             "\n", None, "ü,é", "#c", "\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    path = str(tmp_path / "texts")
    files.write_csv(df, path)
    back = files.read_csv(spark, path, df.schema)
    assert [r["t"] for r in back.orderBy("i").collect()] == [t or None for t in texts]


def test_params(spark, tmp_path):
    files.save_params(spark, {"C": 0.1, "depth": None}, str(tmp_path), "Random Forest")
    assert (tmp_path / "Random_Forest_best_params").exists()
    assert files.load_params(spark, str(tmp_path), "Random Forest") == {"C": 0.1, "depth": None}


def test_cut_lineage_uses_the_shared_folder(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    cut = session.cut_lineage(df)
    assert cut.exceptAll(df).isEmpty() and cut.count() == 10
    shared = session.shared_dir(spark).split(":")[-1]
    assert any(shared in f for f in cut.inputFiles())


def test_from_sqlite_to_training_data(spark, raw, tmp_path):
    """The whole chain on a table as it comes: source names, no time column, file order."""
    path = str(tmp_path / "raw.db")
    pdf = raw.orderBy("ts", "reading_id").select(*K.SOURCE_COLUMNS.values()).toPandas()
    pdf.columns = list(K.SOURCE_COLUMNS)
    with sqlite3.connect(path) as con:
        pdf.to_sql("gas_monitoring", con, index=False)
    source = files.bind_columns(sqlite.read_sqlite(spark, path, "gas_monitoring", 3))
    order = ["reading_seq"]
    made = features.features_full(source, order_by=order, ignore=order)
    first = made.groupBy(K.SESSION).agg(F.min_by("Temp_Diff", "reading_seq").alias("d"))
    assert first.where("d <> 0").isEmpty()
    data = training.training_data(made, "reading_seq")
    assert "reading_seq" not in data.names
    assert data.train.count() + data.test.count() == made.count() == pdf.drop_duplicates().shape[0]
