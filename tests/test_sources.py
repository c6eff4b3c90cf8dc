import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import files, landing, pools, rpc
from ledgerlens.streaming.partials import DailyPartials


class FakeTransport:
    """Answers with one log for each even block; the first call of each range fails once."""

    seen: set = set()

    def __init__(self, url):
        self.url = url

    def __call__(self, method, params):
        start, stop = int(params[0]["fromBlock"], 16), int(params[0]["toBlock"], 16)
        if (start, stop) not in self.seen:
            self.seen.add((start, stop))
            raise rpc.RpcError("limit", retry=True)
        return [{"removed": False, "address": "0xab", "topics": ["0x1"], "data": "0x", "blockNumber": hex(b), "transactionIndex": "0x0", "logIndex": "0x0", "blockTimestamp": "0x0", "blockHash": "0x", "transactionHash": "0x"} for b in range(start, stop + 1) if b % 2 == 0]


def test_what_a_node_answers():
    assert rpc.result_of(b'{"result": null}', "u") is None
    for reply, again in ((b'{"error": {"code": 429, "message": "slow"}}', True), (b'{"error": {"code": -32005, "message": "limit"}}', True), (b'{"error": {"code": -32602, "message": "bad"}}', False), (b"<html>", True), (b"[]", True), (b'{"error": "text"}', False)):
        with pytest.raises(rpc.RpcError) as found:
            rpc.result_of(reply, "https://node/v2/abcdefghijklmnopqrst")
        assert found.value.retry == again and "abcdefghijklmnopqrst" not in str(found.value)
    assert rpc.seconds_of("3") == 3.0 and rpc.seconds_of(None) == rpc.seconds_of("soon") == 0.0
    assert rpc.seconds_of("Mon, 01 Jan 2024 00:00:30 GMT", now=1704067200.0) == 30.0
    busy = rpc.Client(lambda m, p: (_ for _ in ()).throw(rpc.RpcError("busy", retry=True)), retries=0)
    with pytest.raises(rpc.RpcError):
        rpc.safe_head(busy)

    def no_tag(method, params):
        if method == "eth_getBlockByNumber":
            raise rpc.RpcError("no such tag", code=-32602)
        return "0xc8"

    assert rpc.safe_head(rpc.Client(no_tag)) == 136


def test_pool_list():
    text = """# pools\npools:\n  - address: "0xABCDEFabcdefABCDEFabcdefABCDEFabcdefABCD"\n    token0: USDC # stable\n    token1: 'WETH'\n    decimals0: 6\n    decimals1: 18\n    fee: 500\n"""
    assert pools.pools_of(text) == [{"address": "0x" + "abcdef" * 6 + "abcd", "token0": "USDC", "token1": "WETH", "decimals0": 6, "decimals1": 18, "fee": 500}]
    for bad in (text.replace("fee: 500", ""), text.replace("    fee", "\tfee"), text.replace("fee: 500", "fee: {a: 1}"), text.replace("fee: 500", "fee: 500\n    fee: 3"), text.replace("0xAB", "0xZZ"), text.replace("fee: 500", "fee: 400"), text.replace("decimals0: 6", "decimals0: 256"), text.replace("decimals1: 18", "decimals1: -1"), text.replace("fee: 500", "fee: 500\n    note: x"), text + text[text.index("  - ") :]):
        with pytest.raises(ValueError):
            pools.pools_of(bad)


def test_a_row_that_looks_like_a_header_is_kept(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("a\tb\nString\tString\na\tb\n1\t\\N\n")
    assert [tuple(r) for r in files.read_tsv(spark, str(tmp_path / "x.tsv")).collect()] == [("a", "b"), ("1", None)]


def test_rpc_source(spark, monkeypatch):
    monkeypatch.setenv("PYTHONPATH", ".")
    spark.dataSource.register(rpc.LogSource)
    rows = spark.read.format("rpc_logs").options(start="1", stop="35", size="10", transport="tests.test_sources:FakeTransport", url="http://x").load()
    assert rows.rdd.getNumPartitions() == 4
    assert sorted(int(r["blockNumber"], 16) for r in rows.collect()) == list(range(2, 36, 2))


def test_retries_and_their_budget():
    calls, waits = [], []

    def failing(method, params):
        calls.append(method)
        if len(calls) < 4:
            raise rpc.RpcError("busy", retry=True, after=3.0)
        return "done"

    client = rpc.Client(failing, sleep=waits.append)
    assert client.call("x", []) == "done" and len(calls) == 4
    assert all(w >= 3.0 for w in waits) and len(waits) == 3
    assert client.over_budget(0.5, least=4) and not client.over_budget(0.9, least=4)
    with pytest.raises(rpc.RpcError):
        rpc.Client(lambda m, p: (_ for _ in ()).throw(rpc.RpcError("no"))).call("x", [])
    assert rpc.wait_before(3, draw=lambda: 0.0) == 2.0 and rpc.wait_before(3, draw=lambda: 1.0) == 4.0
    assert "abcdefghijklmnopqrst" not in rpc.redacted("https://node/v2/abcdefghijklmnopqrst failed")


def test_heads_blocks_and_windows():
    assert rpc.safe_head(rpc.Client(lambda m, p: {"number": "0x64"} if m == "eth_getBlockByNumber" else "0xc8")) == 100
    assert rpc.safe_head(rpc.Client(lambda m, p: None if m == "eth_getBlockByNumber" else "0xc8")) == 136
    assert rpc.first_block_at(lambda b: b * 12, 0, 100, 120) == 10 and rpc.first_block_at(lambda b: b, 0, 5, 99) == 6
    assert rpc.window_left(10, 20, [(10, 14)]) == (15, 20) and rpc.window_left(10, 20, [(5, 25)]) is None
    with pytest.raises(ValueError):
        rpc.window_left(10, 20, [(14, 16)])


def test_backfill_repeats_what_the_sink_did_not_take():
    table, done, broken = {}, set(), [True]

    def sink(a, b, batch):
        if a == 10 and broken.pop() if broken else False:
            raise OSError("disk full")
        table[a, b] = batch

    fetch = lambda a, b: [{"block": b, "log": 1}, {"block": a, "log": 0}]
    with pytest.raises(OSError):
        rpc.backfill([(0, 9), (10, 19)], fetch, sink, done, done.add)
    assert done == {(0, 9)}
    assert rpc.backfill([(0, 9), (10, 19)], fetch, sink, done, done.add) == 2 and done == {(0, 9), (10, 19)}
    assert [x["block"] for x in table[10, 19]] == [10, 19]


def test_chunk_ranges_cover_once(spark):
    got = [(r["from_block"], r["to_block"]) for r in landing.chunk_ranges(spark, 5, 27, 10).orderBy("from_block").collect()]
    assert got == [(5, 14), (15, 24), (25, 27)]
    with pytest.raises(ValueError):
        landing.chunk_ranges(spark, 5, 4, 10)


def test_coverage_finds_gaps_and_overlaps(spark):
    ranges = spark.createDataFrame([(0, 9), (10, 19), (25, 29), (28, 40)], "from_block long, to_block long")
    assert {(r["from_block"], r["problem"]) for r in landing.coverage_problems(ranges).collect()} == {(25, "gap"), (28, "overlap")}


def test_landing_round_trip_replaces_ranges(spark, tmp_path):
    from tests.test_decode_money import log

    raw = spark.createDataFrame([(n, log(blockNumber=hex(n))) for n in range(20)], f"n long, raw {landing.LOG}")
    from ledgerlens.functions import decode

    fields = {n: c for n, c in decode.trade_columns(F.col("raw")).items() if n != "error_reason"}
    lines = raw.select(F.col("n").alias("block_number"), F.struct(*[c.cast("string").alias(n) for n, c in fields.items()]).alias("decoded"), "raw")
    landing.write_landing(lines, str(tmp_path / "l"), 10)
    landing.write_landing(lines.filter("block_number < 10"), str(tmp_path / "l"), 10)
    rows = landing.read_landing(spark, str(tmp_path / "l"))
    assert rows.count() == 20 and rows.select("amount0").distinct().collect()[0][0] == "-5"
    again = landing.read_landing(spark, str(tmp_path / "l"), redecode=True)
    assert sorted(r["block_number"] for r in again.collect()) == list(range(20))
    target = str(tmp_path / "t")
    act = lambda: {r["from_block"]: r["action"] for r in landing.load(spark, str(tmp_path / "l"), target).collect()}
    assert act() == {0: "insert", 10: "insert"} and act() == {0: "skip", 10: "skip"}
    landing.write_landing(lines.filter("block_number between 10 and 14"), str(tmp_path / "l"), 10)
    assert act() == {0: "skip", 10: "replace"}
    assert spark.read.parquet(target).count() == 15


def test_malformed_landing_line_fails(spark, tmp_path):
    (tmp_path / "from_block=0").mkdir()
    (tmp_path / "from_block=0" / "x.json").write_text('{"decoded": {"pool": ')
    with pytest.raises(Exception):  # noqa: B017
        landing.read_landing(spark, str(tmp_path)).collect()


def test_tsv(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("a\tb\tc\nString\tNullable(UInt64)\tDecimal(18, 4)\nx\t\\N\t1.5\ny\t7\t2.0000\n")
    rows = files.read_tsv(spark, str(path)).orderBy("a").collect()
    assert [(r["a"], r["b"], str(r["c"])) for r in rows] == [("x", None, "1.5000"), ("y", 7, "2.0000")]
    for line in ("z\t1\n", "z\\t\t1\t2\n"):
        path.write_text(f"a\tb\tc\nString\tUInt64\tString\n{line}")
        with pytest.raises(Exception, match="ragged|escape"):
            files.read_tsv(spark, str(path)).collect()


def body(candles):
    return json.dumps({"data": {"attributes": {"ohlcv_list": candles}}})


def test_candles(spark):
    day = 86_400.0
    good = spark.createDataFrame([("p", body([[2 * day, 1, 1, 1, 5.0, 10.0], [day, 1, 1, 1, 4.0, 9.0], [day, 1, 1, 1, 4.0, 9.0]]))], "pool string, body string")
    assert sorted((r["close_usd"], r["volume_usd"]) for r in files.candles(good).collect()) == [(4.0, 9.0), (5.0, 10.0)]
    for bad in ([[day, 1, 1, 1, 4.0, 9.0], [day, 1, 1, 1, 4.0, 8.0]], [[day + 1, 1, 1, 1, 4.0, 9.0]]):
        with pytest.raises(Exception, match="candle"):
            files.candles(spark.createDataFrame([("p", body(bad))], "pool string, body string")).collect()


def test_small_groups_are_merged_or_dropped(spark):
    rows = spark.createDataFrame([("a", 9), ("b", 3), ("c", 2)], "g string, n long")
    assert {(r["g"], r["n"]) for r in files.k_anonymous(rows, "g", "n").collect()} == {("a", 9), ("other", 5)}
    rows = spark.createDataFrame([("a", 9), ("b", 3)], "g string, n long")
    assert {(r["g"], r["n"]) for r in files.k_anonymous(rows, "g", "n").collect()} == {("a", 9)}


def test_partials_survive_repeats_and_repairs(spark, tmp_path):
    rows = spark.createDataFrame([("p", "2024-01-01", 5), ("p", "2024-01-01", 6), ("q", "2024-01-02", 7)], "pool string, day string, raw long").withColumn("day", F.to_date("day"))
    kept = DailyPartials(spark, str(tmp_path))
    rows.filter("pool = 'q'").write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    kept.follow(read())
    kept.follow(read())
    assert kept.daily().count() == 1, "the stream never reads the past"
    kept.backfill(rows.filter("pool = 'p'"))
    kept.backfill(rows.filter("pool = 'p'"))
    assert kept.problems(rows).count() == 0
    repaired = rows.filter("raw != 6")
    assert [r["problem"] for r in kept.problems(repaired).collect()] == ["differs"]
    kept.rebuild(repaired)
    assert kept.problems(repaired).count() == 0


def test_batches_and_fixtures_are_written_side_by_side(spark, tmp_path):
    rows = spark.range(0, 1003, 1, 7).select("id", (F.col("id") * 3).alias("v")).filter("id % 10 != 4")
    files.write_batches(rows, f"file://{tmp_path}/batches", 100)
    back = spark.read.parquet(f"file://{tmp_path}/batches")
    sizes = {r["batch"]: r["count"] for r in back.groupBy("batch").count().collect()}
    assert sizes == {**{i: 100 for i in range(9)}, 9: 3} and back.select("id").distinct().count() == 903
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "batches").glob("batch=*"))
    files.write_tsv(rows, f"file://{tmp_path}/tsv", ["id"], {"id": "UInt64", "v": "UInt64"}, file_rows=50)
    parts = sorted((tmp_path / "tsv").glob("part-*"))
    lines = [line for p in parts for line in p.read_text().splitlines()]
    assert len(parts) > 5 and lines == ["id\tv", "UInt64\tUInt64", *(f"{i}\t{3 * i}" for i in range(1003) if i % 10 != 4)]
    assert sorted(map(tuple, files.read_tsv(spark, f"file://{tmp_path}/tsv").collect())) == [(i, 3 * i) for i in range(1003) if i % 10 != 4]
    files.write_tsv(rows.limit(0), f"file://{tmp_path}/none", ["id"], {"id": "UInt64", "v": "UInt64"})
    assert files.read_tsv(spark, f"file://{tmp_path}/none").count() == 0
    files.write_batches(rows.limit(0), f"file://{tmp_path}/empty")


def test_a_range_of_many_rows_is_written_by_several_tasks_in_order(spark, tmp_path):
    raw = spark.range(300).select(F.col("id").alias("n"), F.lit(None).cast(landing.LOG).alias("raw"))
    number = {"block_number": F.floor(F.col("n") / 100), "log_index": F.col("n") % 100}
    decoded = F.struct(*[number.get(c, F.lit("x")).cast("string").alias(c) for c in landing.DECODED])
    lines = raw.select(number["block_number"].cast("long").alias("block_number"), decoded.alias("decoded"), "raw").repartition(3)
    landing.write_landing(lines, str(tmp_path / "l"), 2, file_rows=40)
    rows = landing.read_landing(spark, str(tmp_path / "l")).select("from_block", (F.col("block_number").cast("long") * 100 + F.col("log_index").cast("long")).alias("n"), F.input_file_name().alias("file"))
    files = [r for r in rows.groupBy("file").agg(F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high")).orderBy("low").collect()]
    assert sum(r["rows"] for r in files) == 300 and max(r["rows"] for r in files) <= 120
    assert all(a["high"] < b["low"] for a, b in zip(files, files[1:]))


def test_raw_logs_are_dealt_alone_and_land_small(spark, tmp_path):
    from tests.test_decode_money import log

    one = spark.createDataFrame([(log(),)], f"raw {landing.LOG}")
    logs = one.crossJoin(spark.range(3000)).select(F.col("raw").withField("blockNumber", F.concat(F.lit("0x"), F.hex(F.floor(F.col("id") / 100)))).withField("logIndex", F.concat(F.lit("0x"), F.hex("id"))).alias("raw"))
    kept = spark.conf.get(landing.METHOD_BYTES)
    for _ in range(2):
        landing.write_logs(logs, str(tmp_path / "l"), 10, file_rows=500)
    assert spark.conf.get(landing.METHOD_BYTES) == kept
    rows = landing.read_landing(spark, str(tmp_path / "l"))
    assert {r["from_block"]: r["count"] for r in rows.groupBy("from_block").count().collect()} == {0: 1000, 10: 1000, 20: 1000}
    again = landing.read_landing(spark, str(tmp_path / "l"), redecode=True)
    same = again.select("from_block", *[F.col(c).cast("string").alias(c) for c in landing.DECODED])
    assert rows.exceptAll(same).count() == 0 and rows.select("log_index").distinct().count() == 3000
    found = [p for p in (tmp_path / "l").rglob("part-*")]
    assert len(found) >= 6 and all(p.name.endswith(".json.gz") for p in found)
    assert sum(p.stat().st_size for p in found) < 3000 * 150, "a line is some 1,400 bytes"
    lines = logs.select(F.lit(7).cast("long").alias("block_number"), landing.decoded(F.col("raw")).alias("decoded"), "raw")
    landing.write_landing(lines, str(tmp_path / "m"), 10)
    assert landing.read_landing(spark, str(tmp_path / "m")).count() == 3000
