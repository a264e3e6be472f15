from pyspark.sql import functions as F

from retropanel.operators.aggregates import event_counts
from retropanel.operators.dedup import keep_last
from retropanel.sources.sinks import merge_buckets, read_merged
from retropanel.streaming import incremental as I

SCHEMA = "date_id int, dept string, is_pac int, is_clim int, is_classe_ab int"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_counts_follow_arriving_files(spark, tmp_path):
    src, table, mark = (str(tmp_path / n) for n in ("src", "table", "mark"))
    first = [(202301, "69", 1, 0, 1), (202301, "69", 0, 1, 0), (202302, "38", 1, 0, 0)]
    second = [(202301, "69", 1, 1, 1), (202303, "38", 0, 0, 0)]
    each = I.accumulate_counts(table, event_counts, ["date_id", "dept"])
    for rows in (first, second):
        write(spark, src, rows)
        stream = I.file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
        I.run_available(stream, mark, each)
    want = event_counts(spark.createDataFrame(first + second, SCHEMA))
    assert sorted(map(tuple, read_merged(spark, table).collect())) == sorted(map(tuple, want.collect()))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "latest")
    each = I.upsert_latest(table, ["k"], ["n"])
    a = spark.createDataFrame([("x", 1), ("y", 1)], "k string, n int")
    b = spark.createDataFrame([("x", 2)], "k string, n int")
    each(a, 0)
    each(b, 1)
    each(b, 1)
    assert sorted(map(tuple, read_merged(spark, table).collect())) == [("x", 2), ("y", 1)]


def test_windows_agree_with_the_batch_result(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    rows = spark.range(400).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id"))).alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("kind"),
        F.col("id").alias("value"),
    )
    rows.write.parquet(src)
    stream = I.daily_windows(I.file_stream(spark, src, rows.schema), "ts", ["kind"], "value")
    query = stream.writeStream.outputMode("append").option("checkpointLocation", mark).trigger(availableNow=True).format("parquet").start(out)
    query.awaitTermination()
    got = spark.read.parquet(out)
    closed = got.agg(F.max("day")).first()[0]
    batch = I.daily_windows(rows, "ts", ["kind"], "value").filter(F.col("day") <= F.lit(closed))
    assert got.count() == batch.count() > 20
    assert got.exceptAll(batch.select(*got.columns)).isEmpty()


def test_unseen(spark):
    want = spark.createDataFrame([("01",), ("69",)], "dept string")
    have = spark.createDataFrame([("69",), ("69",)], "dept string")
    assert [r[0] for r in I.unseen_entities(want, have, ["dept"]).collect()] == ["01"]


def test_a_batch_rewrites_its_own_buckets_only(spark, tmp_path):
    table = tmp_path / "latest"
    each = I.upsert_latest(str(table), ["k"], ["n"], bucket_rows=30)
    each(spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("n")), 0)
    before = {f: f.stat().st_mtime_ns for f in table.rglob("*.parquet")}
    each(spark.createDataFrame([(7, 2)], "k bigint, n int"), 1)
    after = set(table.rglob("*.parquet"))
    gone = {f.parent.name for f in before if f not in after}
    assert len(gone) == 1 and {f.parent.name for f in after - set(before)} == gone
    got = {r["k"]: r["n"] for r in read_merged(spark, str(table)).collect()}
    assert len(got) == 200 and got[7] == 2 and sum(got.values()) == 201


def largest_bucket(spark, table):
    newest = sorted(table.glob("buckets=*"), key=lambda f: int(f.name.split("=")[1]))[-1]
    return spark.read.parquet(str(newest)).groupBy("_bucket").count().agg(F.max("count")).first()[0], int(newest.name.split("=")[1])


def test_tables_grow_by_their_size(spark, tmp_path):
    """Batch after batch no bucket is over the limit, nothing is lost, and a replay adds nothing."""
    table, sizes = tmp_path / "grown", []
    each = I.upsert_latest(str(table), ["k"], ["n"], bucket_rows=50)
    for k in range(5):
        batch = spark.range(k * 60, k * 60 + 120 * (k + 1)).select(F.col("id").alias("k"), F.lit(k).alias("n"))
        each(batch, k)
        each(batch, k)
        most, buckets = largest_bucket(spark, table)
        assert most <= 50
        sizes.append(buckets)
    got = {r["k"]: r["n"] for r in read_merged(spark, str(table)).collect()}
    want = {}
    for k in range(5):
        want.update(dict.fromkeys(range(k * 60, k * 60 + 120 * (k + 1)), k))
    assert got == want and sizes == sorted(sizes) and sizes[-1] > sizes[0]
    assert len(list(table.glob("buckets=*"))) <= 2


def test_an_unfinished_move_is_not_read(spark, tmp_path):
    """A wider layout without its commit is left over by a failure: readers ignore it, the next move replaces it."""
    table = tmp_path / "left"
    each = I.upsert_latest(str(table), ["k"], ["n"], bucket_rows=40)
    each(spark.range(30).select(F.col("id").alias("k"), F.lit(0).alias("n")), 0)
    junk = table / "buckets=4" / "_bucket=1"
    junk.mkdir(parents=True)
    spark.createDataFrame([(999, 9)], "k bigint, n int").coalesce(1).write.mode("overwrite").parquet(str(junk))
    assert read_merged(spark, str(table)).count() == 30
    each(spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("n")), 1)
    got = read_merged(spark, str(table))
    assert got.count() == 200 and got.filter("k = 999").isEmpty() and largest_bucket(spark, table)[0] <= 40


def test_equal_keys_stay_together(spark, tmp_path):
    """Rows that no hash parts don't make a table grow for ever."""
    table = str(tmp_path / "equal")
    merge_buckets(spark.range(100).select(F.lit(1).alias("k"), "id"), table, ["k"], lambda old, new: new if old is None else old.unionByName(new), bucket_rows=10)
    assert read_merged(spark, table).count() == 100


def test_a_replayed_count_adds_nothing(spark, tmp_path):
    table = str(tmp_path / "counts")
    each = I.accumulate_counts(table, event_counts, ["date_id", "dept"])
    a = spark.createDataFrame([(202301, "69", 1, 0, 1), (202302, "38", 1, 0, 0)], SCHEMA)
    each(a, 0)
    each(a, 1)
    each(a, 1)
    want = event_counts(a.union(a))
    assert sorted(map(tuple, read_merged(spark, table).collect())) == sorted(map(tuple, want.collect()))


STAMPED = "id bigint, dept string, day string, pac int"


def feed(spark, src, rows):
    spark.createDataFrame(rows, STAMPED).selectExpr("id", "dept", "cast(day AS timestamp) AS ts", "pac").coalesce(1).write.mode("append").parquet(src)


def month_stream(spark, src, delay="40 days"):
    rows = I.file_stream(spark, src, spark.createDataFrame([], STAMPED).selectExpr("id", "dept", "cast(day AS timestamp) AS ts", "pac").schema, 1)
    return I.closed_months(I.distinct_within(rows, ["id"], "ts", delay), "ts", "dept", ["pac"])


def test_late_and_replayed_files_give_the_batch_answer(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    first = [(1, "69", "2023-01-05", 1), (2, "69", "2023-01-31", 0), (3, "38", "2023-02-03", 1)]
    late = [(4, "69", "2023-01-20", 1), (5, "38", "2023-02-27", None), (6, None, "2023-02-01", 1), (7, "38", None, 1)]
    end = [(8, "69", "2023-06-30", 1)]
    for rows in (first, late, first, end):
        feed(spark, src, rows)
    query = I.append_available(month_stream(spark, src), out, mark)
    want = [(202301, "69", 3, 2), (202302, "38", 2, 1)]
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == want
    # a second run with the same checkpoint: rows behind the watermark are dropped, closed months stay as they are
    feed(spark, src, [(9, "69", "2023-01-02", 1), (10, "69", "2023-07-02", 1), (11, "01", "2023-12-31", 1)])
    feed(spark, src, [(12, "01", "2024-03-31", 1)])
    query = I.append_available(month_stream(spark, src), out, mark)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [*want, (202306, "69", 1, 1), (202307, "69", 1, 1), (202312, "01", 1, 1)]
    held = [o.numRowsTotal for o in query.lastProgress.stateOperators] if query.lastProgress else []
    assert all(n <= 2 for n in held)  # the last month and its row


def test_a_month_that_ends_before_its_batch_is_given_once(spark, tmp_path):
    """Rows between the watermark of the batch before and the batch's own, with and without sums kept so far."""
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    first = [(1, "69", "2023-03-05", 1), (2, "69", "2023-07-30", 0)]
    behind = [(3, "69", "2023-03-20", 1), (4, "38", "2023-04-02", 1), (5, "38", "2023-04-30", 0)]
    late = [(6, "69", "2023-03-21", 1), (7, "38", "2023-04-03", 1), (8, "01", "2023-12-31", 1)]
    for rows in (first, behind, late):
        feed(spark, src, rows)
    I.append_available(month_stream(spark, src), out, mark)
    want = [(202303, "69", 2, 2), (202304, "38", 2, 1), (202307, "69", 1, 0)]
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == want


def test_arriving_files_follow_their_dates(spark, tmp_path):
    """Whatever the number of tasks: a file's dates are after those of the files before it, and all rows come."""
    from retropanel.queries.q_quality import arriving

    rows = spark.range(3000, numPartitions=7).select("id", F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("id") * 37, F.lit(400)).cast("int")).alias("ts"))
    rows = rows.unionByName(rows.select(F.col("id") + 3000, F.lit("2023-05-05").cast("date").alias("ts")).toDF("id", "ts")).withColumn("arrival", F.col("ts"))
    rows = rows.unionByName(rows.limit(1).withColumn("arrival", F.lit(None).cast("date")))
    path = tmp_path / "files"
    arriving(rows, "arrival", str(path), 8)
    spans = [spark.read.parquet(str(f)).agg(F.min("ts"), F.max("ts"), F.count("id")).first() for f in sorted(path.glob("part-*"), key=lambda f: f.stat().st_mtime_ns)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and len(spans) >= 5
    assert sum(s[2] for s in spans) == 6000 == spark.read.parquet(str(path)).select("id").distinct().count()
    small = tmp_path / "small"
    arriving(rows, "arrival", str(small), 8, 300)
    spans = [spark.read.parquet(str(f)).agg(F.min("ts"), F.max("ts"), F.count("id")).first() for f in sorted(small.glob("part-*"), key=lambda f: f.stat().st_mtime_ns)]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and sum(s[2] for s in spans) == 6000
    assert max(s[2] for s in spans) < 600 and sum(s[0] == s[1] for s in spans) >= 8  # 3,000 rows have one date
    arriving(rows.limit(0), "arrival", str(tmp_path / "none"))
    assert spark.read.schema("id bigint, ts date").parquet(str(tmp_path / "none")).count() == 0


def test_repeats_are_dropped_in_any_batch_with_bounded_state(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    schema = spark.createDataFrame([], STAMPED).selectExpr("id", "dept", "cast(day AS timestamp) AS ts", "pac").schema
    rows = [[(10 * k + i, "69", f"2023-{k + 1:02d}-{i + 1:02d}", i) for i in range(10)] for k in range(9)]
    for k, new in enumerate(rows):
        feed(spark, src, new + (rows[k - 1][5:] if k else []) + new[:3])
    stream = I.distinct_within(I.file_stream(spark, src, schema, 1), ["id"], "ts", "45 days")
    query = I.append_available(stream, out, mark)
    got = [r["id"] for r in spark.read.parquet(out).collect()]
    assert sorted(got) == list(range(0, 90))
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(held) <= 60  # ninety keys went by


def test_lineage_of_a_running_stage(spark, tmp_path):
    from retropanel.operators import quality as Q

    read = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(k, k % 3 or None) for k in range(100)], "k int, v int")

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    def write(df):
        df.write.parquet(str(tmp_path / "stage"))
        return spark.read.parquet(str(tmp_path / "stage"))

    source = rows.mapInArrow(counted, rows.schema)
    stored, record = Q.record_while_written("s", source, lambda df: df.filter("k >= 10"), write)
    assert read.value == 100  # one read of the source gives both counts
    got, want = record.first(), Q.stage_record("s", rows, stored).first()
    assert got == want and (got["rows_before"], got["rows_after"], got["completeness_pct"]) == (100, 90, 83.33)

    def write_none(df):
        df.write.parquet(str(tmp_path / "none"))
        return spark.read.schema(df.schema).parquet(str(tmp_path / "none"))

    _, none = Q.record_while_written("s", rows, lambda df: df.filter("k < 0"), write_none)
    assert none.first()["rows_after"] == 0 and none.first()["completeness_pct"] is None
