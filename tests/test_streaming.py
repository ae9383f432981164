import json
from datetime import datetime

from pyspark.sql import functions as F

from faultloom.schemas import RAW_ISSUE
from faultloom.sources import fs, payloads
from faultloom.streaming import intake as live


def write(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def payload(node_id, updated, title="crash on start", **over):
    return {
        "number": 1, "node_id": node_id, "title": title, "html_url": "https://github.com/openai/swarm/issues/1",
        "labels": [], "state": "open", "created_at": "2026-04-20T00:00:00Z", "updated_at": updated,
    } | over


def drain(spark, tmp_path):
    landing = payloads.stream_landing(spark, str(tmp_path / "landing"), 1)
    live.start_intake(
        landing, str(tmp_path / "table"), str(tmp_path / "state"),
        quarantine_path=str(tmp_path / "bad"),
    ).awaitTermination()
    return live.read_upserted(spark, str(tmp_path / "table"))


def test_intake_upserts_over_restarts(spark, tmp_path):
    landing = tmp_path / "landing"
    write(landing, "1.json", payload("a", "2026-04-21T00:00:00Z"), payload("b", "2026-04-21T00:00:00Z"), "{bad")
    write(landing, "2.json", payload("a", "2026-04-22T00:00:00Z", title="crash again"))
    rows = {r.node_id: r for r in drain(spark, tmp_path).collect()}
    assert set(rows) == {"a", "b"} and rows["a"].title == "crash again"
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    # A restart reads only new files; an older version of an issue does not win.
    write(landing, "3.json", payload("a", "2026-04-01T00:00:00Z", title="crash old"), payload("c", "2026-04-23T00:00:00Z"), payload("d", "2026-04-23T00:00:00Z", labels=[{"name": "docs"}]))
    rows = {r.node_id: r for r in drain(spark, tmp_path).collect()}
    assert set(rows) == {"a", "b", "c"} and rows["a"].title == "crash again"


def raw(spark, rows):
    df = spark.createDataFrame(rows, "node_id string, updated_at timestamp, title string")
    missing = {f.name: F.lit(None).cast(f.dataType) for f in RAW_ISSUE if f.name not in df.columns}
    return df.withColumns(missing)


def test_a_retried_batch_is_written_once(spark, tmp_path):
    table = str(tmp_path / "t")
    day = datetime(2026, 4, 20)
    live.write_batch(raw(spark, [("a", day, "one"), ("a", day.replace(day=21), "two")]), 0, table)
    live.write_batch(raw(spark, [("b", day, "x")]), 1, table)
    live.write_batch(raw(spark, [("b", day, "x")]), 1, table)
    assert spark.read.parquet(table).count() == 2
    assert {r.title for r in live.read_upserted(spark, table).collect()} == {"two", "x"}


def test_compaction_keeps_rows_and_the_last_batch(spark, tmp_path):
    table = str(tmp_path / "t")
    for i in range(4):
        live.write_batch(raw(spark, [("a", datetime(2026, 4, 20 + i), f"v{i}"), (f"n{i}", None, "x")]), i, table)
    before = sorted(live.read_upserted(spark, table).collect(), key=lambda r: r.node_id)
    live.compact(spark, table)
    names = fs.subdirs(spark, table)
    assert names[:4] == [f"batch_id={i}" for i in range(4)] and names[4].startswith("folded-2-")
    assert sorted(live.read_upserted(spark, table).collect(), key=lambda r: r.node_id) == before
    live.write_batch(raw(spark, [("z", None, "x")]), 4, table)
    live.compact(spark, table)
    assert [n for n in fs.subdirs(spark, table) if n.startswith("batch")] == ["batch_id=3", "batch_id=4"]
    assert {r.node_id for r in live.read_upserted(spark, table).collect()} == {r.node_id for r in before} | {"z"}
    live.write_batch(raw(spark, [("a", datetime(2026, 5, 1), "v9")]), 4, table)
    assert {r.node_id: r.title for r in live.read_upserted(spark, table).collect()}["a"] == "v9"


def test_a_compaction_may_stop_anywhere(spark, tmp_path):
    table = str(tmp_path / "t")
    for i in range(3):
        live.write_batch(raw(spark, [(f"n{i}", datetime(2026, 4, 20 + i), "x")]), i, table)

    def ids():
        return sorted(r.node_id for r in live.read_upserted(spark, table).collect())

    # Stopped while it writes: no success marker, so the directory does not count.
    raw(spark, [("junk", None, "x")]).write.parquet(f"{table}/folded-1-stopped")
    fs.delete(spark, f"{table}/folded-1-stopped/_SUCCESS")
    assert ids() == ["n0", "n1", "n2"]
    live.compact(spark, table)
    assert ids() == ["n0", "n1", "n2"]
    # Stopped while it deletes: what is left over is not read.
    fs.delete(spark, f"{table}/batch_id=0")
    assert ids() == ["n0", "n1", "n2"]
    for i in range(3, 6):
        live.write_batch(raw(spark, [(f"n{i}", None, "x")]), i, table)
        live.compact(spark, table)
    assert ids() == [f"n{i}" for i in range(6)]


def test_nothing_streamed_yet(spark, tmp_path):
    assert live.read_upserted(spark, str(tmp_path / "none")).count() == 0


def test_a_file_of_one_block_is_ranked_in_parts(spark):
    coalesce, day = "spark.sql.adaptive.coalescePartitions.enabled", datetime(2026, 4, 20)
    block = raw(spark, [("a", day, "same")] * 300 + [(f"n{i}", day, "x") for i in range(700)]).coalesce(1)
    parts = live._spread(block)
    spark.conf.set(coalesce, "false")  # so few rows would share a task
    try:
        sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(coalesce, "true")
    assert sum(sizes) == 1000 and max(sizes) < 400 and parts.columns == block.columns
