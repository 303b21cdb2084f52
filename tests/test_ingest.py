import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from lakepipe.layout import Layout
from lakepipe.operators.quality import QualityError
from lakepipe.plans import bronze, ledger, silver
from lakepipe.plans.bronze import FEATURE_COLUMNS, TRANSACTION_SOURCE, ingest_dataset, rejected, stamp_ingest
from lakepipe.plans.silver import (
    load_customers,
    load_transactions,
    silver_transactions,
    transform_customers,
    transform_transactions,
)
from lakepipe.sources import writers
from lakepipe.sources.readers import newer_than, read_csv, read_or_empty, read_table
from lakepipe.sources.state import (
    advance_high_mark,
    note_batch,
    pending_batches,
    read_high_mark,
    record_run,
    run_values,
)
from lakepipe.sources.writers import overwrite, remove, replace_folder, write_partitioned
from lakepipe.streaming.incremental import start_incremental_load, start_silver_load

SMALL = T.StructType().add("id", "integer").add("label", "string").add("amount", "double")


def csv(tmp_path, text, name="part.csv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_csv_quotes_and_delimiters(spark, tmp_path):
    path = csv(tmp_path, 'id;label;amount\n1;"a ""quoted"" word; and more";2.5\n2;;\n')
    got = [tuple(r) for r in read_csv(spark, path, SMALL, ";").collect()]
    assert got == [(1, 'a "quoted" word; and more', 2.5), (2, None, None)]
    inferred = read_csv(spark, path, delimiter=";")
    assert dict(inferred.dtypes) == {"id": "int", "label": "string", "amount": "double"}


def test_csv_bad_number_is_kept_as_bad_record(spark, tmp_path):
    path = csv(tmp_path, "id,label,amount\n1,a,1.0\nx,b,2.0\n")
    got = read_csv(spark, path, SMALL, keep_bad_records=True).cache()
    assert [r["_corrupt_record"] for r in got.orderBy("label").collect()] == [None, "x,b,2.0"]


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = csv(tmp_path, "id,amount,label\n1,2.0,a\n")
    with pytest.raises(Py4JJavaError, match="does not conform to the schema"):
        read_csv(spark, path, SMALL).collect()


def test_empty_csv(spark, tmp_path):
    assert read_csv(spark, csv(tmp_path, ""), SMALL).count() == 0


def test_every_file_of_a_day_is_kept_and_none_doubles(spark, tmp_path):
    target = str(tmp_path / "bronze")
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        csv(tmp_path / name, f"id,label,amount\n1,{name},1.0\n")
    for name, day in (("one", "2024-01-01"), ("one", "2024-01-02"), ("one", "2024-01-02"), ("two", "2024-01-02")):
        ingest_dataset(spark, str(tmp_path / name), target, schema=SMALL, as_of=day)
    got = read_table(spark, target).groupBy("ingest_date", "label").count().collect()
    assert sorted((str(r["ingest_date"]), r["label"], r["count"]) for r in got) == [
        ("2024-01-01", "one", 1),
        ("2024-01-02", "one", 1),
        ("2024-01-02", "two", 1),
    ]


def test_bad_rows_go_to_a_table_of_their_own(spark, tmp_path):
    source, target = tmp_path / "source", str(tmp_path / "bronze")
    source.mkdir()
    csv(source, "id,label,amount\n1,a,1.0\nx,b,2.0\n3,c,3.0\n")
    ingest_dataset(spark, str(source), target, schema=SMALL, as_of="2024-01-01")
    assert sorted(r["id"] for r in read_table(spark, target).collect()) == [1, 3]
    assert [r["_corrupt_record"] for r in read_table(spark, rejected(target)).collect()] == ["x,b,2.0"]


def test_ingest_date_defaults_to_today(spark):
    today = spark.range(1).select(F.current_date()).first()[0]
    assert stamp_ingest(spark.range(1)).first()["ingest_date"] == today


def test_unknown_write_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        write_partitioned(spark.range(1), str(tmp_path / "t"), ["id"], mode="merge")


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """One folder with almost all rows is split; small folders stay one file."""
    path = str(tmp_path / "hot")
    df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text")).withColumn(
        "part", F.when(F.col("id") < 10, F.col("id")).otherwise(99)
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_partitioned(df, path, ["part"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "hot").iterdir() if p.is_dir()}
    assert files["part=99"] > 1
    assert all(n == 1 for name, n in files.items() if name != "part=99")


def test_mark_is_a_partition_filter(spark, tmp_path, plan_text):
    path = str(tmp_path / "t")
    df = spark.range(10).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    write_partitioned(df, path, ["d"])
    fresh = newer_than(read_table(spark, path), "d", "2024-01-05")
    assert fresh.count() == 5
    assert "PartitionFilters: [isnotnull(d#" in plan_text(fresh).replace("\n", "")
    assert newer_than(df, "d", None).count() == 10


def test_high_marks(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert read_high_mark(spark, path, "a") is None
    df = spark.sql("SELECT DATE '2024-01-05' AS d UNION ALL SELECT DATE '2024-02-01'")
    advance_high_mark(df, "d", path, "a")
    advance_high_mark(df.filter("d < '2024-02-01'"), "d", path, "a")
    advance_high_mark(df.filter("false"), "d", path, "a")
    assert read_high_mark(spark, path, "a") == "2024-02-01"
    assert read_high_mark(spark, path, "b") is None


def test_run_registry(spark, tmp_path):
    path = str(tmp_path / "runs")
    record_run(spark, path, "r1", {"parameter": {"depth": 3, "kind": "trees"}})
    record_run(spark, path, "r2", {"parameter": {"depth": 5}})
    assert run_values(spark, path, "r1", "parameter") == {"depth": 3.0, "kind": "trees"}


def test_customers(spark, rows):
    raw = spark.createDataFrame(
        [(1, 1.5, "yes"), (2, 2.5, "no"), (2, 2.5, "no"), (3, None, None)], "age int, `emp.var.rate` double, y string"
    )
    for partitions in (1, 2, 7):
        silver = transform_customers(raw.repartition(partitions))
        assert silver.columns == ["customer_id", "age", "emp_var_rate", "response_flag"]
        assert sorted(r["customer_id"] for r in silver.collect()) == [0, 1, 2, 3]
        assert rows(silver.drop("customer_id")) == [(1, 1.5, 1), (2, 2.5, 0), (2, 2.5, 0), (3, None, 0)]


def bronze_rows(spark, data):
    """(time, first feature, amount, class, day) to full source rows."""
    return spark.createDataFrame(data, "Time double, V1 double, Amount double, Class int, day string").select(
        "Time",
        "V1",
        *[F.lit(0.0).alias(c) for c in FEATURE_COLUMNS[1:]],
        "Amount",
        "Class",
        F.col("day").cast("date").alias("ingest_date"),
    )


def test_transactions(spark):
    data = [
        (90000.0, 1.0, 5.0, 0, "2024-01-02"),
        (10.0, 1.0, 5.0, 0, "2024-01-01"),
        (20.0, 1.0, 5.0, 0, "2024-01-01"),
        (30.0, None, 5.0, 0, "2024-01-01"),
        (40.0, 1.0, 5.0, 1, "2024-01-01"),
    ]
    results = []
    for partitions in (1, 2, 7):
        silver = transform_transactions(bronze_rows(spark, data).repartition(partitions), 100)
        results.append(sorted(map(repr, silver.collect())))
    assert results[0] == results[1] == results[2]
    first = silver.filter("V1 = 1.0 AND fraud_flag = 0").collect()
    assert [(r["transaction_timestamp"], r["ingest_date"]) for r in first] == [
        (dt.datetime(2023, 1, 1, 0, 0, 10), dt.date(2024, 1, 1))
    ]
    assert silver.count() == 3
    assert silver.filter("customer_id BETWEEN 0 AND 99").count() == 3
    assert silver.columns == [
        "transaction_id",
        "customer_id",
        "transaction_timestamp",
        "transaction_date",
        *FEATURE_COLUMNS,
        "amount",
        "fraud_flag",
        "ingest_date",
    ]


@pytest.fixture
def lake(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    overwrite(spark.range(10).withColumnRenamed("id", "customer_id"), layout.silver("customers"))
    return layout


def add_bronze(spark, layout, data, batch):
    rows = bronze_rows(spark, data).withColumn("batch_id", F.lit(batch))
    write_partitioned(rows, layout.bronze("transactions"), ["ingest_date", "batch_id"], "replace")
    note_batch(spark, layout.batches, "transactions", batch, "ingested")


def test_incremental_load(spark, lake):
    add_bronze(spark, lake, [(1.0, 1.0, 5.0, 0, "2024-01-01"), (2.0, 2.0, 6.0, 1, "2024-01-01")], "a")
    assert load_transactions(spark, lake).count() == 2
    assert load_transactions(spark, lake) is None
    add_bronze(spark, lake, [(3.0, 3.0, 7.0, 0, "2024-01-01"), (9.0, 1.0, 5.0, 0, "2024-01-01")], "b")
    assert load_transactions(spark, lake).count() == 1
    assert read_table(spark, lake.silver("transactions")).count() == 3
    assert pending_batches(spark, lake.batches, "transactions") == []


def test_a_batch_ingested_again_is_loaded_again_and_adds_nothing(spark, lake):
    for _ in range(2):
        add_bronze(spark, lake, [(1.0, 1.0, 5.0, 0, "2024-01-01"), (2.0, 2.0, 6.0, 1, "2024-01-01")], "a")
        load_transactions(spark, lake)
    assert read_table(spark, lake.silver("transactions")).count() == 2


@pytest.mark.parametrize("step", ["note_batch", "remove"])
def test_a_load_that_broke_off_can_be_repeated(spark, lake, monkeypatch, step):
    add_bronze(spark, lake, [(1.0, 1.0, 5.0, 0, "2024-01-01"), (2.0, 2.0, 6.0, 1, "2024-01-01")], "a")

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(f"lakepipe.plans.silver.{step}", fail)
        with pytest.raises(OSError):
            load_transactions(spark, lake)
    add_bronze(spark, lake, [(1.0, 1.0, 5.0, 0, "2024-01-02"), (3.0, 4.0, 6.0, 1, "2024-01-02")], "b")
    assert load_transactions(spark, lake).count() == 3
    assert read_table(spark, lake.silver("transactions")).count() == 3


@pytest.mark.parametrize("amount,flag", [(None, 0), (5.0, 2), (5.0, None)])
def test_bad_rows_stop_the_load(spark, lake, amount, flag):
    add_bronze(spark, lake, [(1.0, 1.0, amount, flag, "2024-01-01")], "a")
    with pytest.raises(QualityError):
        load_transactions(spark, lake)
    assert pending_batches(spark, lake.batches, "transactions") == ["a"]


def test_a_row_without_a_time_stops_the_load(spark, lake):
    add_bronze(spark, lake, [(None, 1.0, 1.0, 0, "2024-01-01")], "a")
    with pytest.raises(QualityError, match="transaction_date"):
        load_transactions(spark, lake)


def people(spark, layout, rows, batch, day):
    df = spark.createDataFrame(rows, "id int, `a.b` double, y string")
    df = df.withColumn("ingest_date", F.lit(day).cast("date")).withColumn("batch_id", F.lit(batch))
    write_partitioned(df, layout.bronze("customers"), ["ingest_date", "batch_id"], "replace")


@pytest.mark.parametrize("key", ["id", None])
def test_customers_keep_their_ids(spark, lake, key):
    people(spark, lake, [(5, 1.0, "yes"), (7, 2.0, "no")], "a", "2024-01-01")
    load_customers(spark, lake, key)
    before = {r["id"]: r["customer_id"] for r in read_table(spark, lake.silver("customers")).collect()}
    people(spark, lake, [(1, 1.0, "no"), (7, 2.0, "no")], "b", "2024-01-02")
    for _ in range(2):
        load_customers(spark, lake, key)
        after = {r["id"]: r["customer_id"] for r in read_table(spark, lake.silver("customers")).collect()}
        assert after == {**before, 1: 2} and sorted(before.values()) == [0, 1]


def test_customers_that_are_equal_stay_several(spark, lake):
    people(spark, lake, [(5, 1.0, "yes")] * 3 + [(None, None, None)], "a", "2024-01-01")
    load_customers(spark, lake)
    people(spark, lake, [(5, 1.0, "yes")] * 2, "b", "2024-01-02")
    load_customers(spark, lake)
    assert sorted(r["customer_id"] for r in read_table(spark, lake.silver("customers")).collect()) == [0, 1, 2, 3]


def test_transaction_source_schema():
    assert TRANSACTION_SOURCE.names == ["Time", *FEATURE_COLUMNS, "Amount", "Class"]


def test_stream_reads_a_second_file_of_the_same_day(spark, tmp_path):
    source, target, progress = [str(tmp_path / n) for n in ("source", "target", "progress")]
    schema = T.StructType.fromDDL("id bigint, day date")
    seen = []

    def run():
        start_incremental_load(
            spark,
            source,
            schema,
            lambda b: b.filter("id >= 0"),
            target,
            progress,
            partition_by=["day"],
            max_files=1,
            check=lambda b: seen.append(b.count()),
        ).awaitTermination()

    def add(first, count):
        day = F.lit("2024-01-01").cast("date").alias("day")
        spark.range(first, first + count).coalesce(1).select("id", day).write.mode("append").parquet(source)

    add(0, 5)
    add(5, 5)
    run()
    add(10, 3)
    run()
    run()
    loaded = read_table(spark, target)
    assert sorted(r["id"] for r in loaded.collect()) == list(range(13))
    assert seen == [5, 5, 3]
    assert sorted({r["batch_id"] for r in loaded.collect()}) == [0, 1, 2]


def test_stream_check_keeps_a_batch_out(spark, tmp_path):
    source, target, progress = [str(tmp_path / n) for n in ("source", "target", "progress")]
    spark.range(3).write.parquet(source)

    def refuse(_):
        raise QualityError("no")

    schema = T.StructType.fromDDL("id bigint")
    query = start_incremental_load(spark, source, schema, lambda b: b, target, progress, check=refuse)
    with pytest.raises(PySparkException):
        query.awaitTermination()
    start_incremental_load(spark, source, schema, lambda b: b, target, progress).awaitTermination()
    assert read_table(spark, target).count() == 3


def silver_of(spark, lake):
    return sorted((r["V1"], r["batch_id"]) for r in read_table(spark, lake.silver("transactions")).collect())


def test_a_corrected_batch_gives_back_what_others_hold(spark, lake):
    row = lambda v, day=1: (float(v + 86_400 * day), float(v), 5.0, 0, "2024-01-01")
    add_bronze(spark, lake, [row(1), row(2), row(3)], "a")
    load_transactions(spark, lake)
    add_bronze(spark, lake, [row(1, 2), row(4, 2)], "b")
    add_bronze(spark, lake, [row(1, 3), row(2, 3)], "c")
    load_transactions(spark, lake)
    assert silver_of(spark, lake) == [(1.0, "a"), (2.0, "a"), (3.0, "a"), (4.0, "b")]
    for withdrawn, left in (("a", [(1.0, "b"), (2.0, "c"), (4.0, "b")]), ("b", [(1.0, "c"), (2.0, "c")]), ("c", [])):
        # A day with nothing left of the batch.
        remove(spark, f"{lake.bronze('transactions')}/ingest_date=2024-01-01/batch_id={withdrawn}")
        note_batch(spark, lake.batches, "transactions", withdrawn, "ingested")
        load_transactions(spark, lake)
        assert silver_transactions(spark, lake).count() == len(left)
        assert not left or silver_of(spark, lake) == left
    assert read_or_empty(spark, lake.silver("transaction_ledger"), ledger.SCHEMA).count() == 0


@pytest.mark.parametrize("step", ["write_partitioned", "note_batch"])
def test_a_correction_that_broke_off_is_finished(spark, lake, monkeypatch, step):
    add_bronze(spark, lake, [(1.0, 1.0, 5.0, 0, "2024-01-01"), (2.0, 2.0, 5.0, 0, "2024-01-01")], "a")
    add_bronze(spark, lake, [(90_000.0, 1.0, 5.0, 0, "2024-01-01")], "b")
    load_transactions(spark, lake)
    add_bronze(spark, lake, [(2.0, 2.0, 5.0, 0, "2024-01-01"), (200_000.0, 3.0, 5.0, 0, "2024-01-01")], "a")
    real = getattr(silver, step)
    calls = []

    def fail(*args, **named):
        calls.append(args)
        if len(calls) == (2 if step == "write_partitioned" else 1):
            raise OSError("lost")
        return real(*args, **named)

    with monkeypatch.context() as patch:
        patch.setattr(silver, step, fail)
        with pytest.raises(OSError):
            load_transactions(spark, lake)
    assert load_transactions(spark, lake).count() == 2
    assert silver_of(spark, lake) == [(1.0, "b"), (2.0, "a"), (3.0, "a")]
    assert load_transactions(spark, lake) is None


def test_a_batch_that_is_ingested_again_replaces_its_rejected_rows(spark, tmp_path):
    source, target = tmp_path / "source", str(tmp_path / "bronze")
    source.mkdir()
    for text, good, bad in (("x,b,2.0\n1,a,1.0\n", 1, 1), ("2,b,2.0\n1,a,1.0\n", 2, 0), ("", 0, 0)):
        csv(source, f"id,label,amount\n{text}")
        ingest_dataset(spark, str(source), target, schema=SMALL, as_of="2024-01-01", batch="d-1")
        counts = [read_or_empty(spark, p, SMALL).count() for p in (target, rejected(target))]
        assert counts == [good, bad]
    with pytest.raises(ValueError):
        ingest_dataset(spark, str(source), target, schema=SMALL, batch="d/1")


def test_a_broken_write_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    overwrite(spark.range(3), path)
    broken = spark.range(5).withColumn("id", F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(PySparkException):
        overwrite(broken, path)
    assert read_table(spark, path).count() == 3
    # A table may be replaced from itself.
    overwrite(read_table(spark, path).filter("id > 0"), path)
    assert read_table(spark, path).count() == 2
    moves, real = [], writers.move

    def fail(spark, *paths):
        moves.append(paths)
        if len(moves) == 2:
            raise OSError("lost")
        real(spark, *paths)

    with monkeypatch.context() as patch:
        patch.setattr(writers, "move", fail)
        with pytest.raises(OSError):
            overwrite(spark.range(7), path)
    assert not (tmp_path / "t").exists()
    assert read_table(spark, path).count() == 7
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    overwrite(spark.range(1), path)
    assert read_or_empty(spark, path, "id bigint").count() == 1


def ledger_rows(spark, ids):
    day = F.lit("2024-01-01").cast("date")
    return spark.createDataFrame([(f"t{i}", float(i)) for i in ids], "transaction_id string, V1 double").withColumn(
        "transaction_date", day
    )


@pytest.mark.parametrize("taken, most", [(range(0), 500), (range(3, 9), 500), (range(3, 9), 0), (range(9), 0), (range(9), 3)])
def test_rows_that_no_other_batch_owns(spark, monkeypatch, plan_text, taken, most):
    monkeypatch.setattr(ledger, "BROADCAST_KEYS", most)
    known = ledger_rows(spark, taken).select(
        "transaction_id", F.lit(True).alias("owned"), "transaction_date", F.lit("a").alias("batch_id")
    )
    change = ledger.addition(ledger_rows(spark, range(9)), "b", known)
    assert sorted(r["transaction_id"] for r in change.owned_rows.collect()) == [f"t{i}" for i in range(9) if i not in taken]
    owned = {r["transaction_id"]: r["owned"] for r in change.entries.collect()}
    assert owned == {f"t{i}": i not in taken for i in range(9)}
    if not taken:
        assert "Exchange" not in plan_text(change.owned_rows) and "Join" not in plan_text(change.owned_rows)


def test_rows_that_parse_are_written_as_they_are_read(spark, tmp_path, monkeypatch):
    shuffled = {}

    def noted(rows, path, folder, rebalance=True):
        shuffled[path] = rebalance
        replace_folder(rows, path, folder, rebalance)

    monkeypatch.setattr(bronze, "replace_folder", noted)
    spark.range(5).select("id").write.option("header", True).csv(f"{tmp_path}/source")
    schema = T.StructType().add("id", "long")
    bronze.ingest_dataset(spark, f"{tmp_path}/source", f"{tmp_path}/bronze", schema=schema, as_of="2024-01-01", batch="a")
    assert shuffled == {f"{tmp_path}/bronze": False, f"{tmp_path}/bronze_rejected": True}
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 5


def test_only_files_with_bad_rows_are_parsed_again(spark, tmp_path, monkeypatch):
    read = {}

    def noted(rows, path, folder, rebalance=True):
        read[path.rpartition("/")[2]] = len(rows.inputFiles())
        replace_folder(rows, path, folder, rebalance)

    monkeypatch.setattr(bronze, "replace_folder", noted)
    (tmp_path / "source").mkdir()
    path = csv(tmp_path / "source", "id,label,amount\n1,a,1.0\n")
    ingest_dataset(spark, path, str(tmp_path / "sound"), schema=SMALL, as_of="2024-01-01", batch="a")
    csv(tmp_path / "source", "id,label,amount\nx,a,1.0\n")
    ingest_dataset(spark, path, str(tmp_path / "broken"), schema=SMALL, as_of="2024-01-01", batch="a")
    assert read == {"sound": 1, "sound_rejected": 0, "broken": 1, "broken_rejected": 1}


def test_keys_of_a_batch_have_the_day_of_the_earliest_copy(spark):
    rows = [("t1", "2024-01-05", "2024-02-02"), ("t1", "2024-01-09", "2024-02-01"), ("t1", "2024-01-08", "2024-02-01")]
    rows += [("t2", "1969-12-30", "2024-02-01"), ("t3", None, "2024-02-01"), ("t3", "2024-01-01", "2024-02-01")]
    columns = "transaction_id string, transaction_date string, ingest_date string"
    df = spark.createDataFrame(rows, columns).selectExpr(
        "transaction_id", "CAST(transaction_date AS date) AS transaction_date", "CAST(ingest_date AS date) AS ingest_date"
    )
    got = {r["transaction_id"]: (str(r["transaction_date"]), r["copies"]) for r in ledger.distinct_keys(df).collect()}
    assert got == {"t1": ("2024-01-08", 3), "t2": ("1969-12-30", 1), "t3": ("None", 2)}


@pytest.mark.parametrize("most", [0, 2, 500_000])
def test_a_correction_adds_to_the_files_of_other_batches(spark, lake, monkeypatch, tmp_path, most):
    monkeypatch.setattr(ledger, "BROADCAST_KEYS", most)
    row = lambda v, time: (float(time), float(v), 5.0, 0, "2024-01-01")
    add_bronze(spark, lake, [row(1, 10), row(2, 10), row(3, 10), row(3, 5)], "a")
    load_transactions(spark, lake)
    # Two copies of 1 and 4, the later one a day later.
    add_bronze(spark, lake, [row(1, 20), row(1, 90_000), row(2, 20), row(4, 20), row(4, 90_000), row(5, 20)], "b")
    load_transactions(spark, lake)
    assert silver_of(spark, lake) == [(1.0, "a"), (2.0, "a"), (3.0, "a"), (4.0, "b"), (5.0, "b")]
    folder = f"{lake.silver('transactions')}/transaction_date=2023-01-01/batch_id=b"
    before = set(spark.read.parquet(folder).inputFiles())
    add_bronze(spark, lake, [row(3, 7)], "a")
    with monkeypatch.context() as patch:
        patch.setattr(silver, "publish_folders", _breaks_off_at(2))
        with pytest.raises(OSError):
            load_transactions(spark, lake)
    load_transactions(spark, lake)
    assert silver_of(spark, lake) == [(1.0, "b"), (2.0, "b"), (3.0, "a"), (4.0, "b"), (5.0, "b")]
    times = read_table(spark, lake.silver("transactions")).selectExpr("V1", "CAST(transaction_timestamp AS string) AS t")
    assert {r["V1"]: r["t"][-2:] for r in times.collect()} == {1.0: "20", 2.0: "20", 3.0: "07", 4.0: "20", 5.0: "20"}
    assert before < set(spark.read.parquet(folder).inputFiles())
    owners = read_table(spark, lake.silver("transaction_ledger")).filter("owned").groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in owners} == {"a": 1, "b": 4}


def _breaks_off_at(call):
    calls = []

    def publish(*args, **named):
        calls.append(args)
        if len(calls) == call:
            raise OSError("lost")
        writers.publish_folders(*args, **named)

    return publish


def test_the_stream_asks_files_only_for_their_batches(spark, lake, monkeypatch, tmp_path):
    seen, real = [], DataStreamWriter.foreachBatch

    def noted(writer, publish):
        return real(writer, lambda files, n: (seen.append(files.columns), publish(files, n))[1])

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", noted)
    add_bronze(spark, lake, [(1.0, 1.0, 5.0, 0, "2024-01-01"), (2.0, 1.0, 5.0, 0, "2024-01-01")], "a")
    start_silver_load(spark, lake, str(tmp_path / "progress")).awaitTermination()
    assert seen == [["batch_id"]]
    assert silver_of(spark, lake) == [(1.0, "a")]
