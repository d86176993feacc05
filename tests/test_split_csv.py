import csv
import random

import pytest
from pyspark.sql import functions as F

from stallwise import schema
from stallwise.sources import listings_io as io
from stallwise.sources import split_csv

NAMES = schema.RAW.names


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")

    def use(size, open_cost=0):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.files.openCostInBytes", opened)


def write(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", encoding="utf-8", newline="") as out:
        writer = csv.writer(out, lineterminator=end, quoting=quoting)
        writer.writerow(NAMES)
        writer.writerows(rows)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def messy(seed, n=300):
    pick = random.Random(seed)
    parts = ["a", "é", '"', '""', "\n", "\r\n", ",", "long text " * 8, "", " ", "\n\n\n", '","', "x\n" * 30]
    return [[f"r{i}", *("".join(pick.choice(parts) for _ in range(pick.randrange(4))) for _ in range(len(NAMES) - 1))] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [250, 2500])
def test_same_rows_as_one_task(spark, tmp_path, small_splits, size, end):
    for k in range(2):
        write(tmp_path / f"{k}.csv", messy(size + k, 40), end)
    plain = spark.read.options(**io._CSV).schema(", ".join(f"`{n}` STRING" for n in NAMES)).csv(str(tmp_path))
    want = rows_of(plain)
    small_splits(size)
    split = split_csv.read(spark, str(tmp_path), schema.RAW)
    assert rows_of(split) == want and len(want) == 80
    assert split_csv._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 5


def test_a_record_over_many_splits_and_odd_files(spark, tmp_path, small_splits):
    long = ["long", 'line "one"\n' * 400, *[""] * 8]
    write(tmp_path / "a.csv", [["first", *["x"] * 9], long, ["last", *["y"] * 9]])
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text(",".join(NAMES))
    (tmp_path / "open.csv").write_text(",".join(NAMES) + '\nz,1\n\n\nnever,"closed\nat all\n')
    small_splits(160)
    found = {r[0]: r[1] for r in split_csv.read(spark, str(tmp_path), schema.RAW).collect()}
    assert found.keys() == {"first", "long", "last", "z", "never"}
    assert found["long"] == long[1] and found["last"] == "y" and found["never"].startswith("closed\nat all")


def test_many_tasks_and_only_pieces_are_shuffled(spark, tmp_path, small_splits):
    write(tmp_path / "one.csv", messy(9, 600))
    size = (tmp_path / "one.csv").stat().st_size
    small_splits(size // 40 + 1)
    found = split_csv.read(spark, str(tmp_path), schema.RAW)
    assert split_csv._lines(spark, str(tmp_path)).rdd.getNumPartitions() >= 40
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # Counts of splits and pieces of records; no lines.
    assert exchanged and all("file" in line for line in exchanged) and "Exchange SinglePartition" not in plan
    assert found.agg(F.count("*")).first()[0] == 600


def test_raw_reader_types(spark, tmp_path):
    write(tmp_path / "raw.csv", [["Cafe", "NA", "4.1", "", "₹9", "2.0", "a\nb", "null", "Yes", "Goa"]])
    (row,) = io.read_raw_csv(spark, str(tmp_path / "raw.csv")).collect()
    assert tuple(row) == ("Cafe", None, "4.1", None, "₹9", 2.0, "a\nb", None, "Yes", "Goa")
    assert rows_of(io.read_raw_csv(spark, str(tmp_path), split=False)) == [tuple(row)]
