import struct
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom import session
from promptloom.functions import moderation
from promptloom.models import standins
from promptloom.operators import images
from promptloom.schemas import ARTICLE, INSTRUCTION
from promptloom.sources import readers, writers
from promptloom.streaming import inference_log


class FakeContext:
    folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


@pytest.mark.parametrize("announced", [None, "hdfs://shared/ckpt/run-1"])
def test_shared_folder_follows_the_session(announced):
    class Session:
        conf = {"spark.checkpoint.dir": "hdfs://shared/ckpt/"}
        sparkContext = FakeContext()

    Session.sparkContext.folder = announced
    assert session.shared_dir(Session) == "hdfs://shared/ckpt"
    assert Session.sparkContext.folder == (announced or "hdfs://shared/ckpt/")


def test_own_folder_where_none_is_set(spark):
    own = session.shared_dir(spark)
    assert own == session.shared_dir(spark) and session.run_path(spark, "x") != session.run_path(spark, "x")
    assert session.run_path(spark, "x").startswith(own)


def test_broadcasts_are_measured(spark):
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) t")
    small = session.broadcast_if_small(wide)
    large = session.broadcast_if_small(wide, max_bytes=5000)

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(small) and not hinted(large)
    assert session.broadcast_if_small(wide.where("false")).count() == 0


def test_materialized_frames_are_tables_of_their_own(spark):
    frame = spark.range(5).selectExpr("id", "array(id) a", "named_struct('x', id) s", "CAST(NULL AS string) n")
    kept = session.materialize(frame)
    assert sorted(kept.collect()) == sorted(frame.collect()) and kept.schema.names == frame.schema.names
    assert session.materialize(frame.where("false")).count() == 0
    assert "Range" not in kept._jdf.queryExecution().toString()


def test_rows_paths_and_names(spark, tmp_path):
    rows = readers.from_rows(spark, [("1", "text")], ARTICLE)
    assert rows.schema == ARTICLE
    for fmt in ("parquet", "json", "csv"):
        path = str(tmp_path / fmt)
        rows.write.format(fmt).save(path)
        assert readers.load_dataset(spark, path, fmt, ARTICLE).collect() == rows.collect()
    rows.createOrReplaceTempView("named_rows")
    assert readers.load_dataset(spark, "named_rows").collect() == rows.collect()


def test_splits(spark):
    rows = readers.from_rows(spark, [("i", None, "r")] * 3, INSTRUCTION)
    both = readers.tagged({"train": rows, "test": rows.limit(1)})
    train, test = readers.load_or_split(both, "somewhere", "instruction")
    assert (train.count(), test.count()) == (3, 1) and train.columns == rows.columns
    with pytest.raises(ValueError, match="somewhere .* dev"):
        readers.load_split(both, "dev", "somewhere")
    numbers = spark.range(50)
    train, test = readers.load_or_split(numbers, "somewhere", "id")
    assert (train.count(), test.count()) == (40, 10) and train.intersect(test).count() == 0


def test_flatten(spark):
    nested = spark.sql("SELECT named_struct('question', 'q', 'answer', 'a') AS train")
    assert readers.flatten(nested, "train").columns == ["question", "answer"]
    schema = T.StructType([T.StructField("k", T.LongType())])
    texts = spark.createDataFrame([(1, '{"k": 5}'), (2, "broken")], "id int, j string").coalesce(1)
    assert [tuple(r) for r in readers.flatten_json(texts, "j", schema, ["id"]).collect()] == [(1, 5), (2, None)]


def test_balanced_leaves_big_inputs_alone(spark):
    slots = spark.sparkContext.defaultParallelism
    assert readers.balanced(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == slots
    assert readers.balanced(spark.range(0, 100, 1, slots + 3)).rdd.getNumPartitions() == slots + 3


def test_tables(spark, tmp_path):
    writers.use_database(spark, "loom_db", str(tmp_path / "db"))
    try:
        writers.drop_table(spark, "t")
        writers.save_table(spark.range(3), "t")
        with pytest.raises(Exception, match="(?i)exist"):
            writers.save_table(spark.range(3), "t")
        writers.save_table(spark.range(5), "t", overwrite=True)
        assert spark.sql("SELECT * FROM t").count() == 5
        writers.drop_table(spark, "t")
        assert not spark.catalog.tableExists("t")
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE IF EXISTS loom_db CASCADE")


def test_cache_and_bounded_rows(spark):
    cached = writers.cached(spark.range(5))
    assert cached.is_cached
    cached.unpersist()
    assert len(writers.bounded_rows(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        writers.bounded_rows(spark.range(6), 5)


def test_shards(spark, tmp_path):
    rows = spark.range(1000).withColumn("split", F.when(F.col("id") < 100, "test").otherwise("train"))
    manifest = writers.save_training_shards(rows, str(tmp_path / "s"), "id", rows_per_shard=100)
    per_split = {r["split"]: (r["n"], r["s"]) for r in
                 manifest.groupBy("split").agg(F.sum("n_rows").alias("n"), F.count("*").alias("s")).collect()}
    assert per_split == {"test": (100, 1), "train": (900, 9)}
    again = writers.save_training_shards(rows.repartition(3), str(tmp_path / "s2"), "id", rows_per_shard=100)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, manifest.collect()))
    shard = spark.read.parquet(str(tmp_path / "s" / "data")).where("split = 'train' AND shard = 3")
    assert shard.count() == manifest.where("split = 'train' AND shard = 3").first()["n_rows"]


def png(width):
    """A real one-row grey PNG of the given width."""

    def part(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, 1, 8, 0, 0, 0, 0)
    pixels = zlib.compress(b"\x00" + b"\x80" * width)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", pixels) + part(b"IEND", b"")


def test_image_folder(spark, tmp_path):
    said = [("Describe a: one, two: three",), ('Describe b: "x" ',), ("Describe b: \"x\" ",)]
    described = images.image_prompts(spark.createDataFrame(said, "description string"))
    assert sorted(r["id"] for r in described.collect()) == [0, 1]
    meta = images.image_metadata(described)
    folder = tmp_path / "images"
    folder.mkdir()
    (folder / "metadata.csv").write_text(meta.toPandas().to_csv(index=False))
    for i in range(2):
        (folder / f"{i}.png").write_bytes(png(i + 1))
    loaded = readers.image_folder(spark, str(folder))
    got = {r["file_name"]: (r["text"], bytes(r["content"])) for r in loaded.collect()}
    assert sorted(t for t, _ in got.values()) == [' "x" ', " one, two"]
    assert {n: c for n, (_, c) in got.items()} == {"0.png": png(1), "1.png": png(2)}
    writers.save_csv(meta, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, escape='"')
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, meta.collect()))


def test_images_are_opened_by_tasks(spark, tmp_path):
    """No folder is listed on the driver: files are opened where their captions are, many captions by several tasks."""
    names = [f"{i}.png" for i in range(300)] + ["gone.png", "_hidden.png", "x.txt", "../out.png", None, "0.png"]
    rows = spark.createDataFrame([(n, f"text of {n}") for n in names], "file_name string, text string")
    writers.save_csv(rows.coalesce(1), f"{tmp_path}/in/metadata.csv")
    files = [*names[:300], "_hidden.png", "x.txt", "uncaptioned.png"]
    frame = spark.createDataFrame([(n, n.encode()) for n in files], "name string, content binary")
    writers.save_files(frame, f"{tmp_path}/in", "name", "content")
    (tmp_path / "out.png").write_bytes(b"out")
    loaded = readers.image_folder(spark, f"{tmp_path}/in")
    old = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(f"{tmp_path}/in")
    old = old.select(F.substring_index("path", "/", -1).alias("file_name"), "path", "content").join(rows, "file_name")
    assert sorted(loaded.select(old.columns).collect()) == sorted(old.collect()) and loaded.count() == 301
    assert loaded.rdd.getNumPartitions() > 1 and "binaryFile" not in loaded._jdf.queryExecution().toString()


def test_inference_log_stream(spark, tmp_path):
    """Two runs over arriving files append each request once and equal the batch form."""
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "log", "ckpt"))
    first = spark.createDataFrame([(1, "user", "hello a@b.co"), (2, "user", "kill it")], "id int, role string, text string")
    second = spark.createDataFrame([(3, "assistant", "steal that"), (4, "user", "para")], first.schema)

    def run():
        requests = inference_log.read_requests(spark, folder, first.schema, files_per_batch=1)
        log = inference_log.judged(requests, "role", "text", standins.guard, F.lit(standins.TAXONOMY))
        inference_log.append(log, table, checkpoint).awaitTermination()
        return spark.read.parquet(table)

    first.coalesce(1).write.parquet(folder)
    assert run().count() == 2
    second.coalesce(1).write.mode("append").parquet(folder)
    log = run()
    batch = inference_log.judged(
        first.unionByName(second), "role", "text", standins.guard, F.lit(standins.TAXONOMY)
    )
    assert sorted(map(tuple, log.select("id", "text", "code").collect())) == sorted(
        map(tuple, batch.select("id", "text", "code").collect())
    )
    assert {r["id"]: r["text"] for r in log.collect()}[1] == "hello <EMAIL_ADDRESS>"
    counts = {r["code"]: (r["category"], r["n_messages"]) for r in inference_log.monitor(log).collect()}
    unknown = "Unknown category: code not in taxonomy."
    assert counts == {"O1": ("Violence.", 1), "O3": ("Crime planning!", 1), "O9": (unknown, 1)}
    assert moderation.VIOLATION


@pytest.mark.parametrize("as_folder", [True, False])
def test_a_table_is_a_folder_of_files_or_a_file(spark, tmp_path, as_folder):
    """Requests of a table that Spark has written, a folder, are streamed as those of a single file are."""
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "id long, text string")
    rows.repartition(4).write.parquet(f"{tmp_path}/in/log.parquet") if as_folder else rows.toPandas().to_parquet(
        (tmp_path / "in").mkdir() or f"{tmp_path}/in/log.parquet"
    )
    stream = inference_log.read_requests(spark, f"{tmp_path}/in", rows.schema, "log.parquet")
    inference_log.append(stream, f"{tmp_path}/table", f"{tmp_path}/checkpoint").awaitTermination()
    assert sorted(r["id"] for r in spark.read.schema(rows.schema).parquet(f"{tmp_path}/table").collect()) == list(range(40))


def test_shards_of_many_splits(spark, tmp_path):
    """More splits than could be listed in a plan, one of them with rows that share a key."""
    rows = spark.range(3000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("split"))
    rows = rows.union(spark.range(40).select(F.lit(7).cast("long"), F.lit("hot")))
    manifest = writers.save_training_shards(rows, str(tmp_path / "shards"), "k", rows_per_shard=10)
    assert manifest.agg(F.sum("n_rows")).first()[0] == 3040 and manifest.select("split").distinct().count() == 3001


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from promptloom import session

    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda name, default=None: default)

    class Cluster:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_stages_can_be_removed(spark, monkeypatch):
    from promptloom import session

    monkeypatch.setattr(session, "_STAGES", [])
    kept = session.materialize(spark.range(5))
    assert kept.count() == 5 and session.remove_stages(spark) == 1 and session._STAGES == []


def test_failed_verdicts_are_reported(spark):
    from promptloom.streaming import inference_log

    rows = [(True, None, None, "ok"), (False, "O1", "Violence.", "ok"), (None, None, None, "oom")]
    log = spark.createDataFrame(rows, "is_safe boolean, code string, category string, status string")
    assert {tuple(r) for r in inference_log.monitor(log).collect()} == {("O1", "Violence.", 1), ("not judged", "oom", 1)}
