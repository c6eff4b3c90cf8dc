"""Raw logs over JSON-RPC as a PySpark data source: one input partition for each block range; as a
batch between two blocks, or as a stream whose offsets are blocks.

The transport is a class named by the option ``transport`` ("module:Class"), called with a method
and its parameters; the one here posts over HTTP. Retries wait exponentially longer with a random
part; what the server asks for with Retry-After counts as the least wait. Messages never hold the
key that is part of the address.
"""

from __future__ import annotations

import importlib
import json
import random
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

RETRY_HTTP = {429, 500, 502, 503, 504}
#: The JSON-RPC error codes for "limit exceeded", also as some nodes give it, after HTTP.
RETRY_RPC = {-32005, 429}
#: JSON-RPC error codes for a method or parameters that a node does not know.
UNKNOWN_RPC = {-32601, -32602}
SCHEMA = "removed boolean, address string, topics array<string>, data string, blockNumber string, transactionIndex string, logIndex string, blockTimestamp string, blockHash string, transactionHash string"
FIELDS = [c.split()[0] for c in SCHEMA.split(", ")]


class RpcError(Exception):
    def __init__(self, message: str, retry: bool = False, after: float = 0.0, code: int | None = None):
        super().__init__(message)
        self.retry, self.after, self.code = retry, after, code


def seconds_of(header: str | None, now: float | None = None) -> float:
    """What a Retry-After header asks for: seconds or a date; 0 if it says neither."""
    text = (header or "").strip()
    try:
        return max(0.0, float(text))
    except ValueError:
        pass
    try:
        at = parsedate_to_datetime(text).timestamp()
    except (TypeError, ValueError):
        return 0.0
    return max(0.0, at - (time.time() if now is None else now))


def result_of(reply: bytes, url: str):
    """The result in a JSON-RPC reply; an error in it, or what is no reply, raises."""
    try:
        held = json.loads(reply)
    except ValueError:
        raise RpcError(redacted(f"no JSON from {url}"), True) from None
    if not isinstance(held, dict) or "error" not in held and "result" not in held:
        raise RpcError(redacted(f"no JSON-RPC reply from {url}"), True)
    if held.get("error") is not None:
        error = held["error"] if isinstance(held["error"], dict) else {"message": held["error"]}
        raise RpcError(redacted(str(error.get("message"))), error.get("code") in RETRY_RPC, code=error.get("code"))
    return held.get("result")


def redacted(text: str) -> str:
    """Without anything that looks like a key in a path or query."""
    return re.sub(r"(?<=[/=])[A-Za-z0-9_-]{16,}", "***", text)


def wait_before(attempt: int, base: float = 0.5, most: float = 30.0, draw: Callable[[], float] = random.random) -> float:
    """Seconds before a repetition: doubled each time, of which half is random."""
    whole = min(most, base * 2**attempt)
    return whole * (0.5 + 0.5 * draw())


class HttpTransport:
    def __init__(self, url: str, timeout: float = 30.0):
        self.url, self.timeout = url, timeout

    def __call__(self, method: str, params: list):
        body = json.dumps({"jsonrpc": "2.0", "id": 1, "method": method, "params": params}).encode()
        request = urllib.request.Request(self.url, body, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                reply = answer.read()
        except urllib.error.HTTPError as error:
            raise RpcError(redacted(f"HTTP {error.code} of {self.url}"), error.code in RETRY_HTTP, seconds_of(error.headers.get("Retry-After"))) from None
        except (urllib.error.URLError, TimeoutError) as error:
            raise RpcError(redacted(f"{error} of {self.url}"), True) from None
        return result_of(reply, self.url)


@dataclass
class Client:
    """Calls with retries, pacing and a budget for retries."""

    transport: Callable
    retries: int = 5
    per_second: float = 0.0
    sleep: Callable[[float], None] = time.sleep
    requests: int = 0
    repeated: int = 0
    _last: float = field(default=0.0, repr=False)

    def call(self, method: str, params: list):
        for attempt in range(self.retries + 1):
            if self.per_second:
                self.sleep(max(0.0, self._last + 1 / self.per_second - time.monotonic()))
                self._last = time.monotonic()
            self.requests += 1
            try:
                return self.transport(method, params)
            except RpcError as error:
                if not error.retry or attempt == self.retries:
                    raise
                self.repeated += 1
                self.sleep(max(error.after, wait_before(attempt)))

    def logs(self, start: int, stop: int, addresses: list[str], topics: list) -> list[dict]:
        return self.call("eth_getLogs", [{"fromBlock": hex(start), "toBlock": hex(stop), "address": addresses, "topics": topics}])

    def over_budget(self, ratio: float = 0.2, least: int = 200) -> bool:
        """Whether too many requests had to be repeated to go on."""
        return self.requests >= least and self.repeated / self.requests > ratio


def safe_head(client: Client, behind: int = 64) -> int:
    """The finalized block, or so many behind the tip where a node knows no such tag."""
    try:
        block = client.call("eth_getBlockByNumber", ["finalized", False])
        if block:
            return int(block["number"], 16)
    except RpcError as error:
        if error.retry or error.code not in UNKNOWN_RPC:
            raise  # the node did not say that it does not know the tag
    return int(client.call("eth_blockNumber", []), 16) - behind


def first_block_at(timestamp_of: Callable[[int], int], low: int, high: int, at: int) -> int:
    """The first block of [low, high] whose time is not before ``at``; high + 1 if there is none."""
    high += 1
    while low < high:
        middle = (low + high) // 2
        if timestamp_of(middle) < at:
            low = middle + 1
        else:
            high = middle
    return low


def window_left(start: int, stop: int, covered: list[tuple[int, int]]) -> tuple[int, int] | None:
    """What is left of a window after what is covered; None if nothing. Refuses gaps."""
    at = start
    for a, b in sorted(covered):
        if b < start or a > stop:
            continue
        if a > at:
            raise ValueError(f"blocks {at} to {a - 1} are missing before a covered range")
        at = max(at, b + 1)
    return (at, stop) if at <= stop else None


@dataclass(frozen=True)
class BlockRange(InputPartition):
    start: int
    stop: int


class LogSource(DataSource):
    """Options: url, transport, start, stop, size (blocks in a call, 10), calls (of one task, 1),
    addresses, topics (JSON), retries, per_second (calls of one task). A stream without stop follows
    the safe head, ``behind`` (64) the tip where a node knows no finalized block."""

    @classmethod
    def name(cls) -> str:
        return "rpc_logs"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LogReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogStream(dict(self.options))


class Blocks:
    """What the batch and the stream share: ranges as partitions, and how one is read."""

    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.size = int(self.options.get("size", 10))

    def client(self) -> Client:
        module, _, name = self.options.get("transport", f"{__name__}:HttpTransport").partition(":")
        return Client(getattr(importlib.import_module(module), name)(self.options.get("url", "")), int(self.options.get("retries", 5)), float(self.options.get("per_second", 0)))

    def between(self, start: int, stop: int) -> list[BlockRange]:
        """Ranges of a task each; all but the last ask for the same number of blocks."""
        step = self.size * int(self.options.get("calls", 1))
        return [BlockRange(a, min(a + step - 1, stop)) for a in range(start, stop + 1, step)]

    def read(self, partition: BlockRange) -> Iterator[tuple]:
        client = self.client()
        addresses, topics = json.loads(self.options.get("addresses", "[]")), json.loads(self.options.get("topics", "[]"))
        for start in range(partition.start, partition.stop + 1, self.size):
            stop = min(start + self.size - 1, partition.stop)
            for log in sorted(client.logs(start, stop, addresses, topics), key=lambda x: (int(x["blockNumber"], 16), int(x["logIndex"], 16))):
                if not start <= int(log["blockNumber"], 16) <= stop:
                    raise RpcError("a log outside the range that was asked for")
                yield tuple(log.get(c) for c in FIELDS)


class LogReader(Blocks, DataSourceReader):
    def partitions(self) -> list[BlockRange]:
        return self.between(int(self.options["start"]), int(self.options["stop"]))


class LogStream(Blocks, DataSourceStreamReader):
    """Offsets are the last block delivered. Spark keeps them in the query's checkpoint: a batch's
    end before it is read, its completion after the sink took it. So a batch that failed is read
    again between the same two blocks and with the same number."""

    def initialOffset(self) -> dict:
        return {"block": int(self.options.get("start", 0)) - 1}

    def latestOffset(self) -> dict:
        if "stop" in self.options:
            return {"block": int(self.options["stop"])}
        return {"block": safe_head(self.client(), int(self.options.get("behind", 64)))}

    def partitions(self, start: dict, end: dict) -> list[BlockRange]:
        if end["block"] < start["block"]:
            raise RpcError(f"the head {end['block']} lies behind block {start['block']}, which was delivered")
        return self.between(start["block"] + 1, end["block"])


def follow_blocks(spark: SparkSession, options: dict[str, str], home: str, sink: Callable[[DataFrame, int], None]) -> None:
    """Deliver the blocks that the checkpoint in ``home`` has not got yet, up to the option ``stop``
    or the safe head, as one batch read by many tasks. ``sink`` takes the batch and its number. If it
    fails, the next call delivers the same blocks under the same number, whatever the head is by
    then, and no others; so a sink that replaces what it wrote under a number ends with every log
    once. Nothing new: no batch. A head behind what was delivered raises."""
    spark.dataSource.register(LogSource)
    stream = spark.readStream.format("rpc_logs").options(**options).load()
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{home}/place").trigger(availableNow=True).start().awaitTermination()


class TableTransport:
    """Answers eth_getLogs from a Parquet table of logs with a column ``block`` beside those of
    SCHEMA; addresses and topics are taken as asked for. Only row groups that can hold the range are
    read, so the table should be ordered by block; those of the last call are kept, since the next
    one mostly asks for what follows, and small groups keep a task small."""

    def __init__(self, url: str):
        import pyarrow.dataset as ds

        table = ds.dataset(url, format="parquet")
        self.groups, self.held = [], {}
        for group in (g for f in table.get_fragments() for g in f.split_by_row_group()):
            span = (group.row_groups[0].statistics or {}).get("block") or {}
            self.groups.append((span.get("min"), span.get("max"), group))

    def __call__(self, method: str, params: list):
        import pyarrow.compute as pc

        if method != "eth_getLogs":
            raise RpcError("the table only has logs", code=-32601)
        asked = params[0]
        start, stop = (int(asked[k], 16) for k in ("fromBlock", "toBlock"))
        # a group without statistics may hold any block
        needed = [i for i, (low, high, _) in enumerate(self.groups) if low is None or high is None or low <= stop and high >= start]
        self.held = {i: self.held[i] if i in self.held else self.groups[i][2].to_table(columns=["block", *FIELDS]) for i in needed}
        inside = (pc.field("block") >= start) & (pc.field("block") <= stop)
        rows = [r for t in self.held.values() for r in t.filter(inside).drop_columns(["block"]).to_pylist()]
        allowed = [None if t is None else set([t] if isinstance(t, str) else t) for t in asked["topics"]]
        fits = lambda topics: all(a is None or i < len(topics) and topics[i] in a for i, a in enumerate(allowed))
        return [r for r in rows if (not asked["address"] or r["address"] in asked["address"]) and fits(r["topics"])]


def backfill(ranges: list[tuple[int, int]], fetch: Callable[[int, int], list], sink: Callable[[int, int, list], None], done: set[tuple[int, int]], save: Callable[[tuple[int, int]], None]) -> int:
    """Fetch the ranges that are not done; a range is saved as done only after the sink took it,
    so a crash repeats it (at least once) and the sink must replace. Returns the rows delivered."""
    rows = 0
    for a, b in ranges:
        if (a, b) in done:
            continue
        batch = sorted(fetch(a, b), key=lambda x: (x["block"], x["log"]))
        if any(not a <= x["block"] <= b for x in batch):
            raise ValueError("a row outside its range")
        sink(a, b, batch)
        save((a, b))
        rows += len(batch)
    return rows


class SampleTransport:
    """Answers without a network: one log for each block that is a multiple of three. Every first
    call is refused, by HTTP or, with the status 200, in the reply itself."""

    def __init__(self, url: str = ""):
        self.url, self.calls = url, 0

    def __call__(self, method: str, params: list):
        if method != "eth_getLogs":
            raise RpcError("the sample only has logs")
        self.calls += 1
        if self.calls == 1:
            limit = {"error": {"code": 429, "message": "limit exceeded"}} if int(params[0]["fromBlock"], 16) % 20 else {"error": {"code": -32005, "message": "limit exceeded"}}
            return result_of(json.dumps(limit).encode(), self.url)
        start, stop = (int(params[0][k], 16) for k in ("fromBlock", "toBlock"))
        one = {"removed": False, "address": "0x" + "ab" * 20, "topics": [], "data": "0x", "transactionIndex": "0x0", "logIndex": "0x0", "blockTimestamp": "0x0", "blockHash": "0x0", "transactionHash": "0x0"}
        return [one | {"blockNumber": hex(b)} for b in range(start, stop + 1) if b % 3 == 0]
