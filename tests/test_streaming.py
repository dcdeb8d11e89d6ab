import glob
import json
import os
import pickle
import time
from types import SimpleNamespace

from pyspark.sql import Row
from pyspark.sql import functions as F

from folio.functions.text import PLACEHOLDER
from folio.operators import pages as P
from folio.plans import delivery
from folio.sources.page_store import PageStore
from folio.streaming import fanout
from folio.streaming.figures import resolved_figures
from folio.streaming.reorder import PROVIDER, Arrived, Buckets, PageOrder, TableMerge, merged_tables_stream, ordered_pages, rocksdb
from folio.streaming.windows import stream_windows


def stream_of(spark, path, schema, batches):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{k:03d}")
        time.sleep(0.02)  # files are read in the order of their times
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(path))


def finished(spark, df, path, name):
    with rocksdb(spark):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(path)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_pages_leave_in_order(spark, tmp_path):
    batches = [[("1", 2, 1), ("1", 1, 2), ("2", 1, 1)], [("1", 4, 3), ("1", 3, 4), ("2", 1, 2)], [("2", 2, 3), ("2", 2, 3)], [("1", None, 9), ("2", None, 9)]]
    stream = stream_of(spark, tmp_path / "in", "job_id string, page_number long, arrival long, text string", [[(*r, f"text {r[1]}") for r in rows] for rows in batches])
    out = finished(spark, ordered_pages(stream), tmp_path / "ck", "ordered")
    got = sorted((r.job_id, r.position, r.page_number, r.arrival) for r in out.collect())
    assert got == [("1", 1, 1, 2), ("1", 2, 2, 1), ("1", 3, 3, 4), ("1", 4, 4, 3), ("2", 1, 1, 1), ("2", 2, 1, 2), ("2", 3, 2, 3), ("2", 4, 2, 3)]
    assert all(r.text == f"text {r.page_number}" for r in out.collect())
    assert spark.conf.get(PROVIDER, "").endswith("RocksDBStateStoreProvider") is False


def test_job_ids_keep_their_type(spark, tmp_path):
    stream = stream_of(spark, tmp_path / "in", "job_id long, page_number int, arrival int", [[(7, 2, 1), (None, 1, 1)], [(7, 1, 2), (7, None, 3)]])
    out = finished(spark, ordered_pages(stream), tmp_path / "ck", "typed")
    assert out.dtypes[0] == ("job_id", "bigint") and sorted((r.job_id, r.position) for r in out.collect() if r.job_id) == [(7, 1), (7, 2)]


TABLES = "job_id string, page_number long, arrival long, tables array<struct<token:string,markdown:string,is_fragment:boolean,start_page:long>>"


def test_table_fragments_over_the_stream(spark, tmp_path):
    t = lambda token, md, fragment, start: (token, md, fragment, start)
    job = {
        1: [t("a", "| h |\n\n", True, 1)], 2: [t("b", "| 1 |", True, 1), t("c", "| x |", False, 2)], 3: [t("d", "| 2 |\n", False, 1), t("e", "| o |", True, 3)],
        4: None, 5: [t("f", "| again |", False, 1), t("g", "| p |", True, 3)], 6: [t("h", "| last |", True, 6)],
    }
    order = [3, 1, 6, 2, 5, 4]
    rows = [("j", p, k, job[p]) for k, p in enumerate(order)] + [("k", 1, 1, job[1])]
    stream = stream_of(spark, tmp_path / "in", TABLES, [rows[:2], rows[2:4], rows[4:], [("j", None, 99, None), ("k", None, 99, None)]])
    got = finished(spark, merged_tables_stream(stream), tmp_path / "ck", "merged")
    flat = spark.createDataFrame(rows, TABLES).select("job_id", "page_number", F.posexplode("tables").alias("idx", "t")).select("job_id", "page_number", "idx", "t.*")
    want = P.merged_tables(flat).select(*got.columns)
    key = lambda r: (r.job_id, r.start_page, r.chain)
    assert sorted(map(tuple, sorted(got.collect(), key=key))) == sorted(map(tuple, sorted(want.collect(), key=key)), key=lambda r: r[:3])
    assert {(r.token, r.markdown) for r in got.collect() if r.closed} == {("c", "| x |"), ("d", "| h |\n| 1 |\n| 2 |"), ("f", "| again |")}


def wait_for(query, check, seconds=150):
    until = time.time() + seconds
    while time.time() < until and not check():
        assert query.exception() is None, query.exception()
        time.sleep(0.3)
    assert check()


def test_figures_wait_for_summaries(spark, tmp_path):
    figures, summaries = "token string, job_id string, page_number long", "token string, is_informative boolean, markdown_result string"
    for name, schema in (("f", figures), ("s", summaries)):
        spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{tmp_path}/{name}/start")
    read = lambda name, schema: spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/{name}")
    put = lambda name, schema, batch, rows: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}/{batch}")
    put("s", summaries, "early", [("early", True, "known before"), ("plain", False, "logo")])
    put("f", figures, "one", [("early", "j", 1), ("plain", "j", 1), ("late", "j", 2), ("never", "j", 3), (None, "j", 4)])
    out = resolved_figures(read("f", figures), read("s", summaries), budget_ms=30_000)
    with rocksdb(spark):
        q = out.writeStream.format("memory").queryName("resolved").outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").trigger(processingTime="500 milliseconds").start()
    found = lambda: {r.token: (r.replacement, r.timed_out, r.error and r.error["class"]) for r in spark.table("resolved").collect()}
    wait_for(q, lambda: len(found()) == 2)
    assert found() == {"early": ("known before", False, None), "plain": ("", False, None)}
    put("s", summaries, "late", [("late", True, "came later")])
    wait_for(q, lambda: "late" in found())
    wait_for(q, lambda: "never" in found())
    assert found()["late"] == ("came later", False, None) and found()["never"] == (PLACEHOLDER, True, "TokenResolutionTimeoutError")
    put("s", summaries, "too-late", [("never", True, "after its time")])
    put("f", figures, "two", [("never", "k", 9)])
    wait_for(q, lambda: spark.table("resolved").filter("token = 'never' AND job_id = 'k'").count() == 1)
    q.stop()
    rows = sorted((r.token, r.job_id, r.page_number, r.replacement) for r in spark.table("resolved").collect())
    assert rows == [("early", "j", 1, "known before"), ("late", "j", 2, "came later"), ("never", "j", 3, PLACEHOLDER), ("never", "k", 9, "after its time"), ("plain", "j", 1, "")]


PAGES = "job_id string, page_number long, markdown string, figures array<struct<token:string,sha256:string>>"


def test_fan_out_is_idempotent(spark, tmp_path):
    rows = [("j", k, f"page {k}", [(f"f{k}{i}", f"s{i}") for i in range(k % 3)] or None) for k in range(1, 7)]
    stream = stream_of(spark, tmp_path / "in", PAGES, [rows[:3], rows[3:]])
    f, p, ck = (f"{tmp_path}/{x}" for x in ("figures", "pages", "ck"))
    fanout.fan_out(stream, f, p, ck, availableNow=True).awaitTermination(120)

    def state():
        return sorted(map(tuple, spark.read.parquet(p).collect())), sorted(map(tuple, spark.read.parquet(f).collect()))

    first = state()
    assert len(first[0]) == 6 and len(first[1]) == sum(k % 3 for k in range(1, 7))
    last = max(int(os.path.basename(x)) for x in glob.glob(f"{ck}/commits/[0-9]*"))
    for x in glob.glob(f"{ck}/commits/*{last}*") + glob.glob(f"{ck}/commits/.*{last}*"):
        os.remove(x)  # as if the driver had died before it could say that the batch was done
    fanout.fan_out(stream, f, p, ck, availableNow=True).awaitTermination(120)
    assert state() == first
    fanout.tee(spark.createDataFrame(rows[:3], PAGES), 0, f, p)
    assert state() == first


def test_windows_of_a_store_come_as_they_are_whole(spark, tmp_path):
    schema, window = "job_id string, window_index long, page_number long, markdown string", "job_id string, window_index long, start_page long, end_page long"
    store, seen = PageStore(spark, str(tmp_path / "store"), schema), []
    put = lambda pages, *windows: store.write(spark.createDataFrame(pages, schema), spark.createDataFrame(windows, window))
    handle = lambda pages, batch_id: seen.append(sorted((r.job_id, r.page_number, r.markdown) for r in pages.collect()))
    go = lambda: stream_windows(store, handle, str(tmp_path / "ck"), availableNow=True).awaitTermination(120)
    go()
    put([("a", 0, 1, "one"), ("a", 0, 2, "two"), ("a", 1, 3, "three")], ("a", 0, 1, 2), ("a", 1, 3, 4))
    go()
    put([("a", 1, 3, "three"), ("a", 1, 4, "four")], ("a", 1, 3, 4))
    put([("b", 0, 1, "other")], ("b", 0, 1, 1))
    go()
    go()
    assert [x for x in seen if x] == [[("a", 1, "one"), ("a", 2, "two")], [("a", 3, "three"), ("a", 4, "four"), ("b", 1, "other")]]


class Told:
    """A state that counts the messages to it."""

    def __init__(self):
        self.value, self.messages = None, 0

    def get(self):
        self.messages += 1
        return self.value if self.value is None or isinstance(self.value, tuple) else iter(list(self.value))

    def update(self, value):
        self.messages += 1
        self.value = value

    put = update

    def clear(self):
        self.update(None)

    def appendList(self, more):
        self.update([*(self.value or []), *more])

    def getValue(self, key):
        self.messages += 1

    def updateValue(self, key, value):
        self.messages += 1


def test_messages_to_the_state_do_not_grow_with_pages():
    row = Row("page_number", "arrival", "payload")
    seen = {}
    for n in (30, 3000):
        made = []
        handle = SimpleNamespace(**{name: lambda *a: made.append(Told()) or made[-1] for name in ("getValueState", "getListState", "getMapState")})
        order, out = PageOrder(), []
        order.init(handle)
        for part in range(3):  # the first page comes in the last part but one, the last ones wait for the end
            rows = [row(p, k, f"t{p}") for k, p in enumerate(reversed(range(1, n + 1))) if p % 3 == (2, 1, 0)[part] and p != n]
            out += order.handleInputRows(("j",), iter(rows), None)
        out += order.handleInputRows(("j",), iter([row(n + 2, 1, "late"), row(None, 2, None)]), None)
        assert [(r.position, r.page_number, r.text) for r in out] == [(p, p, f"t{p}") for p in range(1, n)] + [(n, n + 2, "late")]
        seen[n] = sum(s.messages for s in made)
    assert seen[30] == seen[3000] <= 20


def test_batches_are_made_once_and_are_micro_batches(spark):
    rows = spark.range(0, 600, 1, 90).selectExpr("cast(id % 3 AS string) AS job_id", "id AS page_number", "id AS arrival")
    batches = delivery.in_batches(rows)
    assert all(any("/arriving-" in f for f in b.inputFiles()) for b in batches)
    stream = delivery.streamed(spark, [b.repartition(90) for b in batches], "job_id string, page_number long, arrival long", "many")
    seen = []
    stream.writeStream.foreachBatch(lambda df, k: seen.append(df.count())).option("checkpointLocation", delivery.work_dir(spark, "many-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) <= len(batches) and sum(seen) == 603


class ToldList(Told):
    def get(self):
        return super().get() or iter(())


def test_messages_to_the_state_do_not_grow_with_jobs():
    seen = {}
    for jobs in (3, 300):
        made = ToldList()
        order, out = Buckets(TableMerge()), []
        order.init(SimpleNamespace(getListState=lambda *a: made))
        table = lambda j, p: json.dumps([{"token": f"{j}-{p}", "markdown": f"| {p} |\n", "is_fragment": p < 3, "start_page": 1}])
        for part in ([2, 3], [1], [None]):
            rows = [(str(j), *Arrived(p, p or 9, p and table(j, p))) for p in part for j in range(jobs)]
            out += order.handleInputRows((0,), iter([Row("rows")(pickle.dumps(rows[k::2])) for k in range(2)]), None)
        assert sorted((r.job_id, r.token, r.markdown, r.closed) for r in out) == sorted((str(j), f"{j}-3", "| 1 |\n| 2 |\n| 3 |", True) for j in range(jobs))
        seen[jobs] = made.messages
    assert seen[3] == seen[300] <= 6


def test_jobs_of_a_bucket_are_as_if_each_had_its_state(spark, tmp_path):
    t = lambda k, start, fragment: (f"t{k}", f"| {k} |\n", fragment, start)
    rows = [(f"j{j}", p, (j * 7 + p * 5) % 11, [t(j * 10 + p, (p - 1) // 2 * 2 + 1, (j + p) % 3 < 2)]) for j in range(7) for p in (1, 2, 3, 4, 4, 6)] + [(None, 1, 1, [t(1, 1, False)])]
    batches = [[r for r in rows if r[2] % 3 == k] for k in range(3)] + [[(r, None, 99, None) for r in [f"j{j}" for j in range(7)]], [("j1", 5, 100, [t(5, 5, False)]), ("j1", None, 101, None)]]
    stream = stream_of(spark, tmp_path / "in", TABLES, batches)
    own = sorted(map(repr, finished(spark, merged_tables_stream(stream), tmp_path / "own", "own").collect()))
    shared = sorted(map(repr, finished(spark, merged_tables_stream(stream, 3), tmp_path / "shared", "shared").collect()))
    assert len(own) > 20 and shared == own
