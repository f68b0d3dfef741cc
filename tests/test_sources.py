"""CSV, parquet, stage tables and input balance."""

from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from reviewsent.operators import cleaning
from reviewsent.operators.profile import schema_table
from reviewsent.schema import CLEANED, REVIEWS
from reviewsent.sources import files, shared
from reviewsent.sources.tables import ingest

CSV = '''"1","Bad, very","Line one
line two ""quoted"""
"2","Good","Fine <br /> item"
"2","","empty summary"
"1",,"null summary"
"2","Good","Fine <br /> item"
'''


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_without_header(spark, csv_path):
    df = files.read_csv(spark, csv_path)
    assert df.schema == REVIEWS
    rows = sorted(df.collect(), key=str)
    assert len(rows) == 5
    assert 'Line one\nline two "quoted"' in [r["Text"] for r in rows]
    assert sum(r["Summary"] is None for r in rows) == 2
    complete = cleaning.drop_incomplete(df)
    assert complete.count() == 3 and complete.dropDuplicates().count() == 2


def test_inferred_schema_gives_the_same_rows(spark, csv_path):
    inferred = files.rename_columns(files.read_csv(spark, csv_path, schema=None), "Score", "Summary", "Text")
    assert inferred.schema == REVIEWS
    assert inferred.exceptAll(files.read_csv(spark, csv_path)).count() == 0


def test_csv_to_parquet_adds_a_lasting_key(spark, csv_path, tmp_path):
    out = str(tmp_path / "out")
    df = files.csv_to_parquet(spark, csv_path, out)
    keys = sorted(r["doc_id"] for r in df.collect())
    assert len(set(keys)) == 5
    assert sorted(r["doc_id"] for r in files.read_stage(spark, out, "doc_id").collect()) == keys


def test_csv_keeps_quotes_line_breaks_and_outer_blanks(spark, tmp_path):
    rows = [(1, ' lead, "q" ', "a\nb\\"), (2, "\ttab", 'x"'), (2, None, "#c")]
    path = str(tmp_path / "csv")
    files.write_csv(spark.createDataFrame(rows, REVIEWS), path)
    assert sorted(map(tuple, files.read_csv(spark, path).collect()), key=str) == sorted(rows, key=str)


def test_csv_with_header(spark, tmp_path):
    path = tmp_path / "cleaned.csv"
    path.write_text("label,summary,text\n1,good book,great great\n0,,waste of money\n")
    df = files.csv_to_parquet(spark, str(path), str(tmp_path / "out"), CLEANED, header=True, key=None)
    assert sorted(map(tuple, df.collect())) == [(0, None, "waste of money"), (1, "good book", "great great")]


def test_write_replaces_and_verifies(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.write_verified(spark.range(10), path).count() == 10
    assert files.write_verified(spark.range(3), path).count() == 3
    assert files.write_verified(spark.range(0), path).count() == 0


def test_stage_table_is_written_to_the_shared_folder(spark):
    df = shared.stage_table(spark.range(5).withColumn("x", F.lit("a")), "numbers")
    assert df.count() == 5
    assert shared.shared_folder(spark).removeprefix("file:") in df.inputFiles()[0]


def _session(folder, checkpoint_dir, master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint_dir)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)


def test_shared_folder_is_the_one_the_cluster_names():
    assert shared.shared_folder(_session("hdfs://host/shared/", None, "yarn")) == "hdfs://host/shared"
    assert shared.shared_folder(_session(None, "hdfs://host/set", "yarn")) == "hdfs://host/set"
    with pytest.raises(ValueError):
        shared.shared_folder(_session(None, None, "yarn"))


def test_ingest_deals_rows_out(spark, tmp_path):
    table = ingest(spark.range(10_000).coalesce(1), str(tmp_path / "table"), 8)
    assert len(table.inputFiles()) == 8 and table.count() == 10_000
    assert max(r["n"] for r in table.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) < 1300


def test_run_folder_is_removed_by_its_owner(spark):
    with shared.run_folder(spark) as folder:
        table = shared.stage_table(spark.range(5), "numbers")
        assert folder in table.inputFiles()[0] and table.count() == 5
        assert Path(folder.removeprefix("file:")).exists()
    assert not Path(folder.removeprefix("file:")).exists()
    assert folder not in shared.new_path(spark, "later")


def test_schema_table(spark):
    rows = schema_table(spark.createDataFrame([], CLEANED)).collect()
    assert [tuple(r) for r in rows] == [("label", "int", True), ("summary", "string", True), ("text", "string", True)]
