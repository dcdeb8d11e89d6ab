import os
import pickle

import pytest
from pyspark.sql import functions as F

from folio.operators.pages import replayed
from folio.sources import document_sink as sink
from folio.sources import files, ledger, listing
from folio.sources.page_store import PageStore
from folio.sources.versioned import VersionConflict, VersionedTable


def test_versions_compare_and_set(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "k string, v long", ["k"])
    rows = lambda *r: spark.createDataFrame(r, "k string, v long")
    assert (t.version(), t.latest().collect()) == (0, [])
    assert t.append(rows(("a", 1), ("b", 1)), 0) == 1
    assert t.append(rows(("a", 2), ("a", 3), (None, 5))) == 2
    with pytest.raises(VersionConflict):
        t.append(rows(("b", 9)), 1)
    assert {(r.k, r.v, r.version) for r in t.latest().collect()} == {("a", 3, 2), ("b", 1, 1), (None, 5, 2)}
    assert os.listdir(tmp_path / "t" / "staged") == []  # the loser's rows are gone
    assert t.compact() == 3 and t.append(rows(("c", 7))) == 4
    assert {(r.k, r.v) for r in t.latest().collect()} == {("a", 3), ("b", 1), (None, 5), ("c", 7)} and t.changes().count() == 4
    assert t.vacuum() == 2 and t.versions() == [3, 4] and t.latest().count() == 4


def test_two_writers_race(spark, tmp_path):
    a, b = (VersionedTable(spark, str(tmp_path / "t"), "k string", ["k"]) for _ in range(2))
    a.append(spark.createDataFrame([("x",)], "k string"))
    b.version = lambda: 0  # b has looked before a wrote
    with pytest.raises(VersionConflict):
        b.append(spark.createDataFrame([("y",)], "k string"))
    assert [r.k for r in a.latest().collect()] == ["x"]


WINDOWS = "job_id string, window_index long, start_page long, end_page long, result_dir string, engine_used string, backend_used string, completed_at string"


def window(job, k, end=None):
    return (job, k, 8 * k + 1, end or 8 * k + 8, f"w{k}", "mineru", "pipeline", "2024-01-01T00:00:00")


def test_ledger_tells_missing_from_corrupt(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path / "ledger"))
    jobs = spark.createDataFrame([(j,) for j in ("a", "b", "c", "d", "e", "f", "none", "a")], "job_id string")
    assert {r.status for r in book.load(jobs).collect()} == {"missing"}
    states = ledger.checkpoint_states(spark.createDataFrame([window("a", 0), window("a", 1), window("a", 2, 20), window("b", 0)], WINDOWS))
    version = book.save(states, 0)
    whole = dict(states.collect())["b"]
    broken = {"c": whole[:60], "d": whole.replace('"schema_version":1', '"schema_version":2').replace('"b"', '"d"'), "e": whole, "f": whole.replace('"b"', '"f"').replace('"start_page":1', '"start_page":0')}
    version = book.save(spark.createDataFrame(list(broken.items()), "job_id string, state string"), version)
    with pytest.raises(VersionConflict):
        book.save(states, version - 1)
    got = {r.job_id: r for r in book.load(jobs).collect()}
    assert {k: r.status for k, r in got.items()} == {"a": "ok", "b": "ok", "c": "corrupt", "d": "corrupt", "e": "corrupt", "f": "corrupt", "none": "missing"}
    assert got["d"].error["class"] == "CheckpointCorruptedError" and got["d"].error["context"]["found_schema_version"] == "2" and got["e"].error["context"]["found_job_id"] == "b"
    present = spark.createDataFrame([("a", 0), ("a", 2), ("b", 0), ("c", 0)], "job_id string, window_index long")
    plans = {r.job_id: (r.is_resume, r.resume_from_page, r.discarded_windows) for r in ledger.resume_plans(jobs, book, present).collect()}
    assert plans == {"a": (True, 9, 2), "b": (True, 9, 0), **{j: (False, 1, 0) for j in ("c", "d", "e", "f", "none")}}
    book.delete(spark.createDataFrame([("a",), ("none",)], "job_id string"))
    book.compact()
    assert {r.job_id for r in book.exists(jobs).filter("is_present").collect()} == {"b", "c", "d", "e", "f"}
    assert {r.status for r in book.load(jobs.filter("job_id = 'a'")).collect()} == {"missing"}


def test_page_store_replays_files_of_whole_windows(spark, tmp_path):
    schema = "job_id string, window_index long, page_number long, markdown string"
    store = PageStore(spark, str(tmp_path / "store"), schema)
    assert store.pages().collect() == [] and store.present().collect() == []
    windows = spark.createDataFrame([window("a", 0, 2)[:4], ("a", 1, 3, 4), ("a", 2, 5, 5)], "job_id string, window_index long, start_page long, end_page long")
    rows = [("a", 0, 1, "one"), ("a", 0, 2, "two"), ("a", 1, 3, "three"), ("a", 2, 5, "five"), ("a", 2, 5, "five")]
    store.write(spark.createDataFrame(rows, schema), windows)
    assert sorted((r.job_id, r.window_index) for r in store.present().collect()) == [("a", 0), ("a", 2)]  # page 4 is missing
    assert [r.markdown for r in store.pages().orderBy("page_number").collect()] == ["one", "two", "five"]
    store.write(spark.createDataFrame([("a", 1, 3, "three again"), ("a", 1, 4, "four")], schema), windows.filter("window_index = 1"))
    store.write(spark.createDataFrame([("a", 0, 1, "new one"), ("a", 0, 2, "new two")], schema), windows.filter("window_index = 0"))
    assert [r.markdown for r in store.pages().orderBy("page_number").collect()] == ["new one", "new two", "three again", "four", "five"]
    assert store.pages(spark.createDataFrame([("a", 1)], "job_id string, window_index long")).count() == 2
    plan = spark.createDataFrame([("a", 4)], "job_id string, last_completed_page long")
    fresh = spark.createDataFrame([("a", 2, 5, "extracted anew")], schema)
    got = replayed(store.pages(), fresh, plan).orderBy("position").collect()
    assert [(r.markdown, r.is_replayed) for r in got] == [("new one", True), ("new two", True), ("three again", True), ("four", True), ("extracted anew", False)]


def names(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs)


def test_documents_are_published_whole(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    rows = [("j1/output/a.md", "é" * 700_000, 1), ("j1/output/a.md", "end", 2), ("j2/output/b.md", None, 1), ("c.md", "third", 1)]
    sink.publish_pages(spark.createDataFrame(rows, "name string, text string, page_number long").repartition(3), out, "page_number")
    assert names(out) == ["c.md", "j1/output/a.md", "j2/output/b.md"]
    assert open(f"{out}/j1/output/a.md", encoding="utf-8").read() == "é" * 700_000 + "end" and os.path.getsize(f"{out}/j2/output/b.md") == 0
    sink.publish(spark.createDataFrame([("c.md", "replaced")], "name string, text string"), out)
    assert open(f"{out}/c.md").read() == "replaced"
    sink.publish(spark.createDataFrame([("p/figure_p003_1.png", b"\x89PNG")], "name string, data binary"), out)
    assert open(f"{out}/p/figure_p003_1.png", "rb").read() == b"\x89PNG"
    assert spark.range(1).select(sink.figure_file(F.lit(3), F.lit(1))).first()[0] == "figure_p003_1.png"
    assert {r.source_path.rsplit("/", 1)[1]: r.md for r in files.scan_markdown(spark, out).collect()} == {"c.md": "replaced"}


@pytest.mark.parametrize("bad", ["fails", "outside", "apart", "twice"])
def test_a_failed_job_leaves_no_file(spark, tmp_path, bad):
    out = str(tmp_path / "out")
    rows = spark.range(40).select(F.format_string("d%02d.md", "id").alias("name"), F.repeat(F.lit("x"), 10).alias("text"), "id").repartition(4, "id")
    if bad == "fails":
        rows = rows.withColumn("text", F.when(F.col("id") == 17, F.raise_error(F.lit("no text"))).otherwise(F.col("text")))
    elif bad == "outside":
        rows = rows.withColumn("name", F.when(F.col("id") == 17, "../x.md").otherwise(F.col("name")))
    elif bad == "apart":
        rows = rows.coalesce(1).withColumn("name", F.when(F.col("id") % 2 == 0, "same.md").otherwise(F.col("name")))
    else:
        rows = rows.withColumn("name", F.when(F.col("id") % 20 == 17, "same.md").otherwise(F.col("name"))).repartition(40)
    with pytest.raises(Exception):  # noqa: B017
        sink.publish(rows.select("name", "text"), out)
    assert not os.path.exists(out) or names(out) == []
    assert not os.path.exists(tmp_path / "x.md")


def test_scan_reads_what_was_published(spark, tmp_path):
    rows = [("a.html", "<p>x</p>"), ("_b.pdf", ""), ("c/d.docx", "deep"), ("e.txt", "no")]
    sink.publish(spark.createDataFrame(rows, "name string, text string"), str(tmp_path))
    got = {r.path[len(f"file:{tmp_path}/") :]: r.reject_reason for r in files.scan_documents(spark, str(tmp_path), recursive=True).collect()}
    assert got == {"a.html": None, "_b.pdf": "empty", "c/d.docx": None, "e.txt": "unsupported"}
    assert listing.scheme("s3://b/x") == "s3" and listing.scheme("/a:b") == ""


def test_the_driver_holds_little_of_each_document(spark, tmp_path, monkeypatch):
    """No data source, for which Spark starts processes beside the driver; partitions with short names; nothing listed to read what was published."""
    for kind in ((sink, "DocumentSink"), (listing, "FileSource")):
        monkeypatch.delattr(*kind)
    root = str(tmp_path / ("long" * 20))
    sink.publish(spark.range(2000).select(F.format_string("d%04d/output/a.md", "id").alias("name"), F.concat(F.lit("é "), F.col("id").cast("string")).alias("text")), root)
    parts = listing.FileReader({"path": root, "recursive": "true"}).partitions()
    assert sum(len(p.rows) for p in parts) == 2000 and sum(len(pickle.dumps(p)) for p in parts) < 40 * 2000
    assert files.scan_documents(spark, root, recursive=True).filter("length > 0").count() == 2000
    wanted = spark.range(0, 2000, 500).select(F.format_string("d%04d/output/a.md", "id").alias("name"), "id")
    assert sorted((r.id, r.md) for r in files.read_markdown(wanted, root).collect()) == [(k, f"é {k}") for k in range(0, 2000, 500)]
    with pytest.raises(Exception, match="d9999"):
        files.read_markdown(wanted.limit(1).withColumn("name", F.lit("d9999/output/a.md")), root).collect()


def test_renames_go_on_where_a_task_was_broken_off(tmp_path):
    writer = sink.DocumentWriter(str(tmp_path), ["name", "text"])
    message = writer.write(iter([{"name": f"{k}/a.md", "text": str(k)} for k in range(4)]))
    (tmp_path / "0").mkdir()
    os.rename(f"{writer.hidden}/{message.attempt}-0", tmp_path / "0" / "a.md")
    writer.renamed(message)
    writer.done()
    assert names(tmp_path) == [f"{k}/a.md" for k in range(4)]
