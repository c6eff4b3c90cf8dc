import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerlens.sources import footers, rpc


def _logs(spark, path, blocks):
    fields = {"removed": F.lit(False), "topics": F.array(F.lit("t"), F.concat(F.lit("s"), F.col("id") % 2)), "address": F.lit("0xab"), "blockNumber": F.concat(F.lit("0x"), F.lower(F.hex("id"))), "logIndex": F.lit("0x0")}
    names = [c.split()[0] for c in rpc.SCHEMA.split(", ")]
    spark.range(blocks).select(F.col("id").alias("block"), *[fields.get(n, F.lit("0x")).alias(n) for n in names]).write.parquet(path)


def test_stream_of_blocks_goes_on_after_a_sink_that_failed(spark, tmp_path):
    url, home = f"file://{tmp_path}/logs", f"file://{tmp_path}"
    _logs(spark, url, 100)
    options = {"start": "5", "size": "4", "calls": "3", "transport": "ledgerlens.sources.rpc:TableTransport", "url": url}
    taken, tries = {}, []

    def sink(batch, n):
        tries.append(n)
        rows = [int(r["blockNumber"], 16) for r in batch.collect()]
        if tries == [0, 1]:
            raise OSError("full")
        taken[n] = (sorted(rows), batch.rdd.getNumPartitions())

    rpc.follow_blocks(spark, options | {"stop": "40"}, home, sink)
    with pytest.raises(StreamingQueryException):
        rpc.follow_blocks(spark, options | {"stop": "60"}, home, sink)
    assert taken == {0: (list(range(5, 41)), 3)}
    # the head has moved on: the failed batch keeps its blocks, the next call has the rest
    rpc.follow_blocks(spark, options | {"stop": "99"}, home, sink)
    assert tries == [0, 1, 1] and 2 not in taken
    rpc.follow_blocks(spark, options | {"stop": "99"}, home, sink)
    assert {n: rows for n, (rows, _) in taken.items()} == {0: list(range(5, 41)), 1: list(range(41, 61)), 2: list(range(61, 100))}
    rpc.follow_blocks(spark, options | {"stop": "99"}, home, sink)
    assert tries == [0, 1, 1, 2]
    with pytest.raises(StreamingQueryException, match="behind block 99"):
        rpc.follow_blocks(spark, options | {"stop": "80"}, home, sink)


def test_stream_offsets_and_partitions():
    stream = rpc.LogStream({"start": "10", "size": "10", "calls": "2", "stop": "55"})
    assert stream.initialOffset() == {"block": 9} and stream.latestOffset() == {"block": 55}
    assert stream.partitions({"block": 9}, {"block": 55}) == [rpc.BlockRange(10, 29), rpc.BlockRange(30, 49), rpc.BlockRange(50, 55)]
    assert list(stream.partitions({"block": 55}, {"block": 55})) == []


def test_logs_of_a_table_by_topic_and_address(spark, tmp_path):
    _logs(spark, f"file://{tmp_path}/logs", 20)
    table = rpc.Client(rpc.TableTransport(f"file://{tmp_path}/logs"))
    found = lambda *asked: [int(r["blockNumber"], 16) for r in table.logs(*asked)]
    assert sorted(found(3, 9, [], ["t", ["s1"]])) == [3, 5, 7, 9]
    assert found(3, 9, ["0xcd"], []) == [] and len(found(3, 9, ["0xab"], [None])) == 7
    assert found(3, 9, [], ["t", "s1", "more"]) == []
    with pytest.raises(rpc.RpcError):
        table.call("eth_blockNumber", [])


def test_footers_of_several_files_and_row_groups(spark, tmp_path):
    home = tmp_path / "t.parquet"
    home.mkdir()
    first = pa.table({"a": pa.array([3, None, 1, 9], pa.int64()), "s": ["b", "a", None, "c"], "none": pa.array([None] * 4, pa.int32()), "x": [-0.0, 2.5, 1.0, 0.5]})
    pq.write_table(first, home / "1.parquet", row_group_size=2)
    pq.write_table(first.slice(0, 1), home / "2.parquet")
    pq.write_table(first.slice(0, 0), home / "3.parquet")
    groups = footers.row_groups(spark, f"file://{home}")
    assert groups.count() == 16  # the empty file has a row group too
    rows = {r["column"]: tuple(r)[1:] for r in footers.columns(groups).collect()}
    assert rows["a"] == (5, 1, 1.0, 9.0, None, None) and rows["s"] == (5, 1, None, None, "a", "c")
    assert rows["none"] == (5, 5, None, None, None, None) and rows["x"] == (5, 0, 0.0, 2.5, None, None)
    whole = footers.tables(groups).first()
    assert (whole["row_groups"], whole["rows"], whole["largest"]) == (4, 5, 2) and whole["packed"] > 0


def test_footers_without_statistics_say_nothing(spark, tmp_path):
    table = pa.table({"a": [1, 2]})
    pq.write_table(table, tmp_path / "1.parquet", write_statistics=False)
    pq.write_table(table, tmp_path / "2.parquet")
    row = footers.columns(footers.row_groups(spark, f"file://{tmp_path}")).first()
    assert (row["rows"], row["nulls"], row["low"], row["high"]) == (4, None, None, None)
    pq.write_table(table.slice(0, 0), tmp_path / "0.parquet")
    assert footers.tables(footers.row_groups(spark, f"file://{tmp_path}/0.parquet")).first()["rows"] == 0


def test_calls_of_a_task_read_each_row_group_once(spark, tmp_path, monkeypatch):
    url = f"file://{tmp_path}/logs"
    _logs(spark.newSession(), f"{url}/all", 400)
    spark.read.parquet(f"{url}/all").repartitionByRange(2, "block").sortWithinPartitions("block").write.option("parquet.block.row.count.limit", 50).parquet(f"{url}/cut")
    table, read = rpc.TableTransport(f"{url}/cut"), []
    assert len(table.groups) >= 8

    class Counted:
        def __init__(self, n, group):
            self.n, self.group = n, group

        def to_table(self, **asked):
            read.append(self.n)
            return self.group.to_table(**asked)

    table.groups = [(low, high, Counted(n, group)) for n, (low, high, group) in enumerate(table.groups)]
    found = [int(r["blockNumber"], 16) for a in range(0, 400, 7) for r in rpc.Client(table).logs(a, a + 6, [], [])]
    assert found == list(range(400)) and sorted(read) == list(range(len(table.groups)))
    table.groups = [(None, None, group) for _, _, group in table.groups]  # without statistics
    assert sorted(int(r["blockNumber"], 16) for r in rpc.Client(table).logs(45, 52, [], [])) == list(range(45, 53))
