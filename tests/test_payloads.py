"""Response bodies: items, where a feed ends, paged sources."""

import json
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.payload import next_cursor, payload_items
from millrace.sources.extracts import register_extract
from millrace.sources.paged import paged_source
from millrace.sources.payloads import explode_items, take_pages, with_items


@pytest.mark.parametrize(
    "body, want",
    [
        ('{"data": [{"a": 1}, {"a": 2}]}', ['{"a":1}', '{"a":2}']),
        ('[{"a": 1}, 5]', ['{"a":1}', "5"]),
        ('{"other": [1]}', []),
        ('{"data": null}', []),
        ('{"data": []}', []),
        ('{"meta": {"data": [1]}}', []),
        ("7", []),
        ("not json", []),
    ],
)
def test_items(spark, body, want):
    df = spark.createDataFrame([(body,)], "body string")
    assert df.select(payload_items(F.col("body"))).first()[0] == want


@pytest.mark.parametrize(
    "body, want",
    [
        ('{"meta": {"next_cursor": "x"}}', "x"), ('{"meta": {"next_cursor": ""}}', None),
        ('{"meta": {"next_cursor": null}}', None), ('{"meta": 5}', None), ("{}", None), ('{"meta": {"next_cursor": 7}}', "7"),
    ],
)
def test_cursor(spark, body, want):
    df = spark.createDataFrame([(body,)], "body string")
    assert df.select(next_cursor(F.col("body"))).first()[0] == want


def kept_by_loop(bodies, strategy, limit):
    """What a client that fetches page after page would keep."""
    out = []
    for body in bodies:
        doc = json.loads(body)
        items = doc.get("data", [])
        if not items:
            break
        out += items
        if strategy == "page":
            if "next" in doc.get("meta", {}):
                more = bool(doc["meta"]["next"])
            elif "has_more" in doc:
                more = doc["has_more"]
            elif "next" in doc:
                more = bool(doc["next"])
            else:
                more = True
        elif strategy == "offset":
            more = len(items) >= limit
        else:
            more = bool(doc.get("meta", {}).get("next_cursor"))
        if not more:
            break
    return out


PAGE = st.fixed_dictionaries(
    {"data": st.lists(st.integers(0, 99).map(lambda i: {"v": i}), max_size=3)},
    optional={
        "meta": st.fixed_dictionaries(
            {}, optional={"next": st.sampled_from(["u", None, ""]), "next_cursor": st.sampled_from(["c", None, ""])}
        ),
        "has_more": st.booleans(),
        "next": st.sampled_from(["u", None, ""]),
    },
).map(json.dumps)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(PAGE, max_size=5), min_size=1, max_size=3), st.sampled_from(["page", "offset", "cursor"]))
def test_feeds_end_where_a_client_would_stop(spark, feeds, strategy):
    rows = [(f"f{i}", n, body) for i, bodies in enumerate(feeds) for n, body in enumerate(bodies, 1)]
    pages = with_items(spark.createDataFrame(rows, "feed string, page bigint, body string"))
    kept = explode_items(take_pages(pages, strategy, "feed", "page", limit=2), ["feed", "page"], "v int")
    got = {}
    for r in kept.sort("feed", "page", "item_no").collect():
        got.setdefault(r["feed"], []).append({"v": r["v"]})
    for i, bodies in enumerate(feeds):
        assert got.get(f"f{i}", []) == kept_by_loop(bodies, strategy, 2)


def test_page_cap(spark):
    pages = with_items(
        spark.range(1, 8).selectExpr("'f' AS feed", "id AS page", "concat('{\"data\": [', id, ']}') AS body")
    )
    assert take_pages(pages, "page", "feed", "page", max_pages=3).count() == 3
    assert take_pages(pages, "none", "feed", "page").count() == 7
    offsets = pages.withColumn("page", (F.col("page") - 1) * 1)
    assert take_pages(offsets, "offset", "feed", "page", limit=1, max_pages=4).count() == 4
    with pytest.raises(ValueError):
        take_pages(pages, "scroll", "feed", "page")
    with pytest.raises(ValueError):
        take_pages(pages, "page", [], "page")


def test_no_window_over_a_feed(spark, folder):
    spark.createDataFrame([("f", 1, "[1]")], "feed string, page bigint, body string").write.parquet(f"{folder}/p")
    pages = with_items(spark.read.parquet(f"{folder}/p"))
    plan = take_pages(pages, "page", "feed", "page")._jdf.queryExecution().executedPlan().toString()
    assert "Window [" not in plan and "partial_min" in plan and "BroadcastHashJoin" in plan


BODIES = {n: json.dumps({"data": [{"v": n * 10 + i} for i in range(2 if n < 7 else 1)],
                         "has_more": n < 7, "meta": {"next_cursor": str(n + 1) if n < 7 else None}}) for n in range(1, 8)}


@pytest.mark.parametrize("strategy, pages", [("page", 7), ("offset", 7), ("cursor", 7), ("none", 1)])
def test_paged_source(spark, strategy, pages):
    bodies = BODIES

    def fetch(feed, params):
        if "offset" in params:
            assert params["size"] == 2
            return bodies.get(params["offset"] // 2 + 1)
        return bodies.get(int(params.get("page") or params.get("cursor") or 1))

    spark.dataSource.register(paged_source(fetch, f"fetch_{strategy}"))
    got = (
        spark.read.format(f"fetch_{strategy}")
        .options(strategy=strategy, feeds='["a", "b"]', limit=2, limit_param="size", max_pages=20, tasks_per_feed=3)
        .load()
    )
    assert got.count() == 2 * pages
    kept = take_pages(with_items(got), strategy, "feed", "page", limit=2)
    values = [r["v"] for r in explode_items(kept, ["feed"], "v int").filter("feed = 'b'").sort("v").collect()]
    assert values == ([10, 11] if strategy == "none" else [*[n * 10 + i for n in range(1, 7) for i in (0, 1)], 70])


@pytest.mark.parametrize("strategy", ["cursor", "offset"])
def test_stream_of_spans(spark, folder, strategy):
    """Spans of two pages, restarts, a feed that grows after its end, and a batch that is read twice."""
    shown = f"{folder}/shown"
    with open(shown, "w") as file:
        file.write("4")

    def fetch(feed, params):
        if feed == "none":
            return None
        with open(shown) as file:
            last = int(file.read())
        number = params["offset"] // 2 + 1 if "offset" in params else int(params.get("page") or params.get("cursor") or 1)
        if number > last:
            return None
        return json.dumps({"data": [{"v": number}], "meta": {"next_cursor": str(number + 1) if number < last else None}})

    name = f"spans_{strategy}"
    spark.dataSource.register(paged_source(fetch, name))

    def run():
        stream = spark.readStream.format(name).options(
            strategy=strategy, feeds='["a", "none", "b"]', pages_per_batch=2, limit=2, marks=f"{folder}/marks",
        ).load()
        # A batch has its own folder, so one that is read again replaces what it stored before.
        stream.writeStream.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")).option(
            "checkpointLocation", f"{folder}/mark").trigger(availableNow=True).start().awaitTermination()
        step = 2 if strategy == "offset" else 1
        rows = spark.read.parquet(f"{folder}/out").collect()
        return {f: sorted(r["page"] // step + (strategy == "offset") for r in rows if r["feed"] == f) for f in "ab"}

    assert run() == {"a": [1, 2], "b": [1, 2]}
    assert run() == {"a": [1, 2, 3, 4], "b": [1, 2, 3, 4]}
    assert run() == {"a": [1, 2, 3, 4], "b": [1, 2, 3, 4]}
    with open(shown, "w") as file:
        file.write("5")
    assert run() == {"a": [1, 2, 3, 4, 5], "b": [1, 2, 3, 4, 5]}
    # A batch whose rows were stored but not committed is read once more: the same rows, though the feed has grown.
    newest = max((f for f in os.listdir(f"{folder}/mark/commits") if f.isdigit()), key=int)
    for gone in (newest, f".{newest}.crc"):
        os.unlink(f"{folder}/mark/commits/{gone}")
    with open(shown, "w") as file:
        file.write("9")
    assert run() == {"a": [1, 2, 3, 4, 5], "b": [1, 2, 3, 4, 5]}
    assert spark.read.parquet(f"{folder}/out/batch={newest}").count() == 2
    for _ in range(3):
        got = run()
    assert got == {"a": [*range(1, 10)], "b": [*range(1, 10)]}


def test_stream_bodies_are_fetched_by_executors_only(spark, folder):
    driver = os.getpid()

    def fetch(feed, params):
        assert os.environ.get("SPARK_EXECUTOR_DIRS") or os.getpid() != driver
        with open(f"{folder}/{feed}-{params.get('cursor') or 1}-{os.getppid()}", "w"):
            return BODIES.get(int(params.get("cursor") or 1))

    spark.dataSource.register(paged_source(fetch, "counted_stream"))
    stream = spark.readStream.format("counted_stream").options(
        strategy="cursor", feeds='["a", "b"]', pages_per_batch=0, marks=f"{folder}/marks").load()
    stream.writeStream.format("noop").option("checkpointLocation", f"{folder}/mark").trigger(availableNow=True).start().awaitTermination()
    fetched = sorted(f.rsplit("-", 1)[0] for f in os.listdir(folder) if f[1] == "-")
    assert fetched == sorted(f"{f}-{n}" for f in "ab" for n in range(1, 8))
    with pytest.raises(Exception, match="marks"):
        spark.readStream.format("counted_stream").options(strategy="cursor").load().writeStream.format("noop").option(
            "checkpointLocation", f"{folder}/mark2").trigger(availableNow=True).start().awaitTermination()


def test_extracts_called_from_sql(spark):
    def items(body):
        return json.loads(body)["rows"]

    register_extract(spark, "rows_of", items)
    register_extract(spark, "rows_of_good", items, skip_errors=True)
    bodies = [
        (1, '{"rows": [{"a": 1, "b": "x", "c": 2, "d": "2024-01-02", "e": {"f": [1, 2]}, "g": {"k": true}, "h": 1.5, "i": "2024-01-02T03:04:05"}, {"b": {"z": 1}}]}'),
        (2, None), (3, '{"rows": []}'), (4, '{"rows": [{"a": 1}, {"a": 1.5}]}'), (5, "no json"),
    ]
    spark.createDataFrame(bodies, "n int, body string").createOrReplaceTempView("bodies")
    columns = (
        "CAST(NULL AS STRUCT<a: BIGINT, b: STRING, c: DOUBLE, d: DATE, e: STRUCT<f: ARRAY<DOUBLE>>, g: MAP<STRING, BOOLEAN>, "
        "h: DECIMAL(5,2), i: TIMESTAMP_NTZ>)"
    )
    one = "CAST(NULL AS STRUCT<a: BIGINT>)"
    got = spark.sql(f"SELECT b.n, i.* FROM (SELECT * FROM bodies WHERE n < 4) b, LATERAL rows_of(b.body, {columns}) i")
    assert [f.dataType.simpleString() for f in got.schema.fields[1:]] == [
        "bigint", "string", "double", "date", "struct<f:array<double>>", "map<string,boolean>", "decimal(5,2)", "timestamp_ntz"]
    first, second = got.collect()
    assert tuple(first) == (1, 1, "x", 2.0, date(2024, 1, 2), ([1.0, 2.0],), {"k": True}, Decimal("1.50"), datetime(2024, 1, 2, 3, 4, 5))
    assert second["b"] == '{"z": 1}' and second["a"] is None
    assert spark.sql(f"SELECT count(*) FROM bodies b, LATERAL rows_of_good(b.body, {one}) i").first()[0] == 2
    for bad in (f"SELECT * FROM bodies b, LATERAL rows_of(b.body, {one}) i", "SELECT * FROM bodies b, LATERAL rows_of(b.body, b.body) i"):
        with pytest.raises(Exception):
            spark.sql(bad).collect()
    spark.catalog.dropTempView("bodies")


def test_served_files_are_opened_once_while_their_pages_are_asked_for(spark, folder, monkeypatch):
    import pyarrow.fs

    from contract import payloads

    monkeypatch.setattr(payloads, "_FILE_PAGES", 10, raising=False)
    pages = 43
    spark.range(pages * 100).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "cast(id AS double) AS o_totalprice", "'p' AS o_orderpriority"
    ).write.parquet(f"{folder}/orders.parquet")
    serve = payloads._served(spark, folder, 1, payloads._cursor_body())
    opened = []

    class Counted:
        @staticmethod
        def from_uri(uri):
            opened.append(uri)
            return real.from_uri(uri)

    real = pyarrow.fs.FileSystem
    monkeypatch.setattr(pyarrow.fs, "FileSystem", Counted)
    bodies = [json.loads(serve("feed-0", number)) for number in range(1, pages + 1)]
    assert serve("feed-0", pages + 1) is None and serve("feed-0", 10 * pages) is None and serve("feed-9", 1) is None
    assert [b["data"][0]["o_orderkey"] for b in bodies] == [100 * i for i in range(pages)]
    assert [b["page"]["after"] for b in bodies] == [f"at-{n}" for n in range(2, pages + 1)] + [None]
    assert len(opened) == 5 + 2
