"""The splitting CSV reader against Spark's own, with cuts in all places."""

import random
from collections import Counter

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from reviewsent.sources import files
from reviewsent.sources.shared import new_path

SCHEMA = StructType([StructField("Score", IntegerType()), StructField("Summary", StringType()), StructField("Text", StringType())])
FIELDS = ["plain", "", "two words", "a,b", 'say ""hi""', "line one\nline two", "\n", "\n\n\n", '""', '""\n""', "é東\n\U0001F600,", "x" * 150, '\n""\n,', " "]


def content(seed, end):
    rng = random.Random(seed)
    quoted = lambda f: f'"{f}"'.replace("\n", end)
    bare = [f for f in FIELDS if not set(f) & set('",\n')]
    field = lambda: rng.choice([quoted(rng.choice(FIELDS)), rng.choice(bare)])
    return "".join(f"{rng.choice(['1', '2', '', 'x'])},{field()},{field()}{end}" for _ in range(60))


@pytest.fixture
def cut(spark):
    """Cut files into ranges of so many bytes."""
    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    yield at
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_reader_of_whole_files(spark, tmp_path, cut, seed, end):
    for k in range(2):
        (tmp_path / f"{k}.csv").write_bytes(content(10 * seed + k, end).encode())
    whole = bag(files.read_csv(spark, str(tmp_path), SCHEMA))
    assert sum(whole.values()) >= 119
    for size in (7, 40, 333, 1 << 20):
        cut(size)
        assert bag(files.read_csv_split(spark, str(tmp_path), SCHEMA)) == whole


def test_one_file_is_many_tasks(spark, tmp_path, cut):
    (tmp_path / "one.csv").write_text(content(5, "\n"))
    cut(200)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    assert files.read_csv(spark, str(tmp_path), SCHEMA).rdd.getNumPartitions() == 1


def test_header_empty_lines_and_no_last_line_break(spark, tmp_path, cut):
    (tmp_path / "a.csv").write_text('Score,Summary,"Te\nxt"\n1,a,b\n\n2,"c\n\nd",e')
    (tmp_path / "b.csv").write_text("Score,Summary,Text\n")
    (tmp_path / "c.csv").write_text("")
    for size in (5, 1000):
        cut(size)
        assert bag(files.read_csv_split(spark, str(tmp_path), SCHEMA, header=True)) == Counter([(1, "a", "b"), (2, "c\n\nd", "e")])


def test_written_files_come_back(spark, tmp_path, cut):
    rows = [(1, "s", "t"), (2, 'q"q', "a\nb"), (None, None, "x"), (1, ",", "\r\n")]
    path = new_path(spark, "csv")
    files.write_csv(spark.createDataFrame(rows, SCHEMA).repartition(1), path)
    cut(6)
    assert bag(files.read_csv_split(spark, path, SCHEMA)) == bag(files.read_csv(spark, path, SCHEMA)) == Counter(rows)
    table = files.csv_to_parquet(spark, path, new_path(spark, "rows"), SCHEMA, split=True)
    assert table.count() == 4 and table.columns == ["doc_id", "Score", "Summary", "Text"]
