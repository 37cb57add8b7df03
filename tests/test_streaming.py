from pyspark.sql import functions as F

from vacancia import schema as S
from vacancia.operators import dedup, standardise as N
from vacancia.streaming import landing


def put(tmp_path, name, rows):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    lines = ["job_id,title,scraped_at", *[",".join(r) for r in rows]]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_landing_picks_up_only_new_files(spark, tmp_path):
    schema = S.strings(["job_id", "title", "scraped_at"])
    table, progress, rejects = (f"file://{tmp_path}/{n}" for n in ("table", "progress", "rejects"))

    def run():
        stream = landing.read_batches(spark, f"file://{tmp_path}/in")
        landing.land(stream, table, progress, rejects, N.by_name(schema))
        return spark.read.parquet(table).count()

    put(tmp_path, "1.csv", [("1", "a", "1")])
    assert run() == 1
    put(tmp_path, "2.csv", [("2", "b", "1"), ("3", "c", "1")])
    assert run() == 3
    assert run() == 3
    # Another column order, a short row and a row with a field too many.
    (tmp_path / "in" / "3.csv").write_text("title,job_id,scraped_at\nd,4,1\ne,5\nf,6,1,x\n")
    assert run() == 5
    got = {r.job_id: (r.title, r.scraped_at) for r in spark.read.parquet(table).collect()}
    assert got["4"] == ("d", "1") and got["5"] == ("e", None)
    assert [r.record for r in spark.read.parquet(f"{rejects}/rows").collect()] == ["f,6,1,x"]
    assert sum(r.bad_rows for r in spark.read.parquet(f"{rejects}/files").collect()) == 1


def test_upsert_stream_equals_batch_twin(spark, tmp_path):
    schema = S.strings(["job_id", "title", "scraped_at"])
    log, progress, rejects = (f"file://{tmp_path}/{n}" for n in ("log", "progress", "rejects"))
    source = f"file://{tmp_path}/in"
    for i in range(4):
        put(tmp_path, f"{i}.csv", [(str(j % 5), f"t{i}{j}", str((i * 7 + j) % 4)) for j in range(10)])
        stream = landing.read_batches(spark, source, max_files=1)
        landing.upsert_last(stream, log, progress, rejects, N.by_name(schema), ["job_id"], "scraped_at")
    now = landing.current(spark, log, schema, ["job_id"], "scraped_at")
    batch = dedup.last_by_id(spark.read.schema(schema).option("header", True).csv(source), "scraped_at")
    assert now.exceptAll(batch).count() == 0 and batch.exceptAll(now).count() == 0
    landing.compact(spark, log, schema, ["job_id"], "scraped_at")
    packed = landing.current(spark, log, schema, ["job_id"], "scraped_at")
    assert packed.exceptAll(now).count() == 0 and packed.count() == now.count()
    assert landing.live(landing.commits(spark, log)).count() == 1 and landing.retired(spark, log).count() == 4
    # The table read before the compaction still reads its own folders.
    assert now.count() == packed.count()


def test_compaction_beside_readers_and_batches(spark, tmp_path):
    schema = S.strings(["job_id", "title", "scraped_at"])
    log, keys = f"file://{tmp_path}/log", ["job_id"]

    def batch(number, *rows, buckets=3):
        df = spark.createDataFrame(rows, schema)
        landing._add(landing.newest(df, keys, "scraped_at"), log, keys, buckets, number, False)

    def now():
        return sorted((r.job_id or "", r.title) for r in landing.current(spark, log, schema, keys, "scraped_at").collect())

    assert now() == [] and landing.retired(spark, log).isEmpty()
    batch(0, ("a", "a0", "0"), ("b", "b0", "0"), (None, "n0", "0"))
    batch(1, ("a", "a1", "1"))
    seen = spark.createDataFrame(landing.commits(spark, log).collect(), landing._COMMITS)
    reader = landing.current(spark, log, schema, keys, "scraped_at")
    batch(2, ("c", "c2", "2"), ("b", "b2", "2"))  # committed while the compaction works
    landing.compact(spark, log, schema, keys, "scraped_at", seen=seen)
    want = [("", "n0"), ("a", "a1"), ("b", "b2"), ("c", "c2")]
    assert now() == want and {r.upto for r in landing.live(landing.commits(spark, log)).collect()} == {1, 2}
    assert sorted(r.title for r in reader.collect()) == ["a1", "b0", "n0"]
    # A second compactor that started from the same commits, and a batch written twice.
    landing.compact(spark, log, schema, keys, "scraped_at", seen=seen)
    batch(2, ("c", "c2", "2"), ("b", "b2", "2"))
    assert now() == want and landing.live(landing.commits(spark, log)).count() == 2
    # Another number of buckets, rows without a commit, one more round.
    batch(3, ("d", "d3", "3"), buckets=5)
    spark.createDataFrame([("a", "lost", "9", 0)], "job_id string, title string, scraped_at string, log_bucket int").write.partitionBy(
        "log_bucket").parquet(f"{log}/rows/log_folder=batch-4-dead")
    found = landing.lookup(spark, log, schema, keys, "scraped_at", spark.createDataFrame([("a",), (None,)], "job_id string"))
    assert sorted(r.title for r in found.collect()) == ["a1", "n0"]
    landing.compact(spark, log, schema, keys, "scraped_at", buckets=2)
    landing.compact(spark, log, schema, keys, "scraped_at")
    assert now() == [*want, ("d", "d3")] and landing.live(landing.commits(spark, log)).count() == 1


def test_newest_rows_move_once(spark):
    """The newest row of a key is shuffled by key, and not a second time by bucket."""
    rows = spark.createDataFrame([(str(i % 7), str(i)) for i in range(50)], "id string, stamp string")
    written = landing._bucketed(dedup.newest(rows, ["id"], "stamp"), ["id"], 4)
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    latest = {(str(k), max(str(i) for i in range(50) if i % 7 == k)) for k in range(7)}
    assert {(r.id, r.stamp) for r in written.collect()} == latest
    assert written.filter(F.col("log_bucket") != landing.bucket_of(["id"], 4)).isEmpty()
