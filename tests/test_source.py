"""Options, schemas, values, the queue and the stream."""

import json
import random
import sqlite3
import time
import tracemalloc
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mqstream.functions import values
from mqstream.functions.decode import check, payload_field, payload_fields
from mqstream.functions.payload import Decoder
from mqstream.operators.admission import UNLIMITED, batches_by_bytes, in_order
from mqstream.plans import stream_queries
from mqstream.sources.avro import struct_of
from mqstream.sources.options import Options
from mqstream.sources.schema import METADATA, RAW, metadata_schema, registered_schema, table_schema
from mqstream.streaming import source, store
from mqstream.streaming.broker import LONGEST_LEASE_MS, Broker, Message
from mqstream.streaming.drain import drain, settle
from mqstream.streaming.errors import NotFoundError
from mqstream.streaming.source import StreamReader, read_metrics, read_stream, register, sliced, started

BASE = {"projectId": "p", "subscription": "s"}


def test_defaults_and_aliases():
    o = Options.of({"PROJECT": "p", "subscriptionname": "projects/x/subscriptions/y", "topicName": "t"})
    assert (o.subscription, o.topic) == ("projects/x/subscriptions/y", "projects/p/topics/t")
    assert (o.ack_mode, o.gather_mode, o.batch_size, o.batch_count, o.num_writers, o.schema_mode, o.metadata_mode, o.max_retry_ms) == ("afterCommit", "batch", 512 << 20, 0, 1, "basic", "none", 90_000)
    assert Options.of(BASE | {"ackDeadline": "30s"}).max_retry_ms == 30_000
    assert Options.of(BASE | {"ackMode": "after_checkpoint"}).ack_mode == "afterCheckpoint"
    assert Options.of(BASE | {"receiveTime": "auto"}).receive_ms is None
    assert Options.of(BASE | {"seek": "start"}).seek == "beginning"
    assert "secret" not in Options.of(BASE | {"credentialsFile": "/secret.json"}).summary()


@pytest.mark.parametrize("bad", [
    {"projectId": " "}, {"subscription": ""}, {"ackMode": "x"}, {"ackDeadline": "9s"}, {"ackDeadline": "601s"}, {"ackDeadline": "10500ms"}, {"maxRetryTime": "31m"},
    {"receiveTime": "0"}, {"batchSize": "1k"}, {"batchCount": "-1"}, {"numWriters": "0"}, {"seek": "timestamp"}, {"seek": "snapshot"}, {"seek": "no"},
    {"seek": "time", "seekTime": "2000", "limitTime": "2000"}, {"limitTime": "2024-01-01T00:00:00"}, {"schemaMode": "x"}, {"metadataMode": "x"},
])
def test_refused_options(bad):
    with pytest.raises(ValueError):
        Options.of(BASE | bad)


def test_values():
    assert [values.parse_duration(x) for x in ("250ms", " 2S ", "1m", "7")] == [250, 2000, 60_000, 7000]
    assert [values.parse_size(x) for x in ("", "3k", "2M", "1g", "5")] == [0, 3072, 2 << 20, 1 << 30, 5]
    assert values.parse_instant("2024-01-15T10:30:00+01:00") == 1705311000000
    for f, x in ((values.parse_duration, "1h"), (values.parse_duration, ""), (values.parse_size, "x"), (values.parse_size, "9999999999g"), (values.parse_instant, "2024-01-15T10:30:00")):
        with pytest.raises(ValueError):
            f(x)
    assert [values.elapsed(x) for x in (5, 99_999, 150_000, 725_000)] == ["5ms", "99999ms", "2.5m", "12:05"]
    assert values.time_iso(0) == "1970-01-01T00:00:00.000Z"


PAYLOAD = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("PublishTime", T.StringType())])


def test_schema_modes():
    assert table_schema("raw").names == ["body"]
    assert table_schema("slim").names == ["body", "messageid", "publishtime", "orderingkey"]
    assert table_schema("mixed", PAYLOAD).names == ["k", "PublishTime", "messageid"]
    assert table_schema("dynamic", PAYLOAD) == PAYLOAD
    with pytest.raises(ValueError, match="schemaMode=mixed"):
        table_schema("mixed")
    for mode in METADATA:
        for table in ("raw", "basic", "slim"):
            assert metadata_schema(mode, table_schema(table)).names == [n for n in METADATA[mode] if n not in table_schema(table).names]


def test_avro():
    s = struct_of('{"type":"record","name":"d","fields":[{"name":"deviceid","type":"string"},{"name":"eventtime","type":"long"},{"name":"label","type":["null","string"]}]}')
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in s] == [("deviceid", "string", False), ("eventtime", "bigint", False), ("label", "string", True)]
    for bad in ('"string"', "", "{", '{"type":"record","name":"r"}', '{"type":"record","name":"r","fields":[{"type":"int"}]}', '{"type":"record","name":"r","fields":[{"name":"x","type":["int","string"]}]}', '{"type":"record","name":"r","fields":[{"name":"x","type":{"type":"fixed","size":4,"name":"f"}}]}'):
        with pytest.raises(ValueError):
            struct_of(bad)


def test_registry(tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"encoding": "JSON", "type": "AVRO", "definition": '{"type":"record","name":"r","fields":[{"name":"x","type":"int"}]}'}))
    assert registered_schema("projects/p/topics/t", str(tmp_path)).names == ["x"]
    (tmp_path / "b.json").write_text(json.dumps({"encoding": "BINARY", "type": "AVRO", "definition": "{}"}))
    for name in ("b", "absent"):
        with pytest.raises(ValueError):
            registered_schema(name, str(tmp_path))


def read(spark, payload, schema):
    df = spark.createDataFrame([(payload.encode() if payload is not None else None,)], "body binary")
    fields = T._parse_datatype_string(schema).fields
    return df.select(*(payload_field(F.col("body"), f.name, f.dataType).alias(f.name) for f in fields)).first()


def test_decoding(spark):
    r = read(spark, '{"s":"x","b":true,"i":7,"l":9,"f":1.5,"d":2.5}', "s string, b boolean, i int, l long, f float, d double")
    assert tuple(r) == ("x", True, 7, 9, 1.5, 2.5)
    r = read(spark, '{"amount":3.14,"nested":{"id":"n1"},"tags":["a","b"],"stats":{"rebounds":2}}', "amount decimal(10,2), nested struct<id:string>, tags array<string>, stats map<string,int>")
    assert (str(r[0]), r[1].id, r[2], r[3]) == ("3.14", "n1", ["a", "b"], {"rebounds": 2})
    assert read(spark, '{"DeviceId":"abc"}', "deviceid string")[0] == "abc"
    for empty in ("{}", "", "  ", None, "[1]", "3"):
        assert read(spark, empty, "x int")[0] is None
    assert read(spark, '{"x":"7.9"}', "x int")[0] == 7
    assert read(spark, '{"x":{"a":1}}', "x array<struct<a:int>>")[0][0].a == 1
    with pytest.raises(Exception, match="(?i)malformed|invalid|json"):
        read(spark, "{not-json", "x int")
    with pytest.raises(Exception, match="not an instant"):
        read(spark, '{"t":"2024-01-15"}', "t timestamp")
    with pytest.raises(ValueError):
        check(T.DateType())


def test_byte_batches_on_one_stream(spark):
    df = spark.createDataFrame([(k, s) for k, s in enumerate([5, 5, 5, 50, 1, 0, 10, 3])], "id long, size long")
    got = [r["batch"] for r in batches_by_bytes(df, "id", F.col("size"), 10).orderBy("id").collect()]
    assert got == [0, 0, 1, 1, 2, 2, 2, 3]


def queue(path, messages, name="s", now=None):
    b = Broker(str(path / "q.db"), *([lambda: now[0]] if now else []))
    b.subscribe(name)
    b.publish(messages)
    return b


def test_byte_batches_by_brute_force(spark):
    draw = random.Random(4)
    sizes = [draw.choice([0, 1, 5, 40, 300]) for _ in range(700)]
    rows = [(2 * k, s, k % 3) for k, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "id long, size long, q int").repartition(7)

    def greedy(sizes, most, count):
        out, batch, n, held = [], 0, 0, 0
        for s in sizes:
            if n >= count or held >= most:
                batch, n, held = batch + 1, 0, 0
            n, held = n + 1, held + s
            out.append(batch)
        return out

    for most, count in ((100, UNLIMITED), (100, 4), (1, UNLIMITED), (UNLIMITED, 9)):
        got = [r["batch"] for r in batches_by_bytes(df, "id", F.col("size"), most, count).orderBy("id").collect()]
        assert got == greedy(sizes, most, count)
        got = {(r["q"], r["id"]): r["batch"] for r in batches_by_bytes(df, "id", F.col("size"), most, count, queue="q").collect()}
        for q in range(3):
            mine = [(i, s) for i, s, of in rows if of == q]
            assert [got[q, i] for i, _ in mine] == greedy([s for _, s in mine], most, count)
    assert [r["at"] for r in in_order(df, "id").orderBy("id").collect()] == list(range(700))


def test_slices_and_offsets(tmp_path):
    b = queue(tmp_path, [Message(f"m{k}") for k in range(5)])
    assert b.produce("s", "me", b.lease("s", "me", 5, 1000)) == 0
    parts = lambda writers: [[r[0] for rows in b.part_of_batch("s", s.owner, s.after, s.to, s.part, s.parts) for r in rows] for s in sliced("me", -1, 0, 5, writers)]
    assert parts(2) == [["m0", "m2", "m4"], ["m1", "m3"]] and [len(p) for p in parts(9)] == [1] * 5
    assert len(sliced("me", 0, 0, 0, 3)) == 1
    assert b.ranges(*b.waiting("s", None, None, 4), 2) == [(1, 2), (3, 4)]
    assert started(3, 3) and started(4, 3) and not started(2, 3) and not started(None, 0)


def ids(messages):
    return [m.messageid for m in messages]


def test_broker(tmp_path):
    now = [0]
    b = Broker(str(tmp_path / "q.db"), lambda: now[0])
    with pytest.raises(NotFoundError):
        b.check("s")
    b.subscribe("s")
    b.publish([Message(f"m{k}", b"x", publish_ms=k * 1000) for k in range(6)])
    b.publish([Message("m0")])  # known already
    first = b.lease("s", "a", 4, 1000)
    assert ids(first) == ["m0", "m1", "m2", "m3"] and b.outstanding("s") == (4, 4)
    b.ack("s", "a", [first[0].seq, 999])
    b.nack("s", "b", [first[1].seq])  # not b's
    assert b.outstanding("s", "a") == (3, 3)
    b.nack("s", "a", [first[1].seq])
    assert ids(b.lease("s", "b", 9, 1000)) == ["m1", "m4", "m5"]
    now[0] = 5000
    held = b.lease("s", "a", 2, 1000)  # the leases have run out
    assert ids(held) == ["m1", "m2"]
    assert b.produce("s", "a", held) == 0 and b.count("s", "a", -1, 0) == 2
    b.settle("s", 0)
    b.take_snapshot("s", "snap")
    b.seek("s", 4000)
    assert ids(b.lease("s", "a", 9, 1000)) == ["m4", "m5"]
    b.seek_snapshot("s", "snap")
    assert b.counts("s") == {"acked": 3, "ready": 3}
    with pytest.raises(NotFoundError):
        b.seek_snapshot("s", "none")


def test_leases_have_owners(tmp_path):
    now = [0]
    b = queue(tmp_path, [Message(f"m{k}") for k in range(6)], now=now)
    b.lease("s", "dead", 3, 1000)
    b.lease("s", "alive", 2, 1000)
    now[0] = 900
    b.extend("s", "alive", 1000)
    now[0] = 1000
    b.extend("s", "dead", 1000)  # too late: they have run out
    assert ids(b.lease("s", "new", 9, 1000)) == ["m0", "m1", "m2", "m5"]
    b.abandon("s", "new", -1)
    assert b.outstanding("s", "alive") == (2, 0) and b.counts("s") == {"leased": 2, "ready": 4}
    while now[0] < LONGEST_LEASE_MS:  # no lease is extended for ever
        now[0] += 900
        b.extend("s", "alive", 1000)
    assert set(ids(b.lease("s", "new", 9, 1000))) == {f"m{k}" for k in range(6)}
    assert b.produce("s", "alive", [Message("m3", seq=4)]) == 0 and b.count("s", "alive", -1, 0) == 0  # the lease is no longer alive's


def test_leases_are_bounded_in_bytes(tmp_path):
    b = queue(tmp_path, [Message(f"m{k}", b"x" * n) for k, n in enumerate([40, 40, 40, 500, 1])])
    assert ids(b.lease("s", "a", 9, 1000, 100)) == ["m0", "m1"]
    assert ids(b.lease("s", "a", 9, 1000, 100)) == ["m2"]
    assert ids(b.lease("s", "a", 9, 1000, 100)) == ["m3"]  # too large for any bound, so alone
    assert ids(b.lease("s", "a", 9, 1000, 0)) == ["m4"]


def test_what_is_done_to_many_messages_changes_few_rows(tmp_path):
    b = queue(tmp_path, [Message(f"m{k}", b"xy") for k in range(5000)])
    before = b.db.total_changes
    held = [m for _ in range(5) for m in b.lease("s", "a", 1000, 60_000)]
    assert b.outstanding("s", "a") == (5000, 10_000) and b.produce("s", "a", held) == 0
    b.settle("s", 0)
    assert b.counts("s") == {"acked": 5000} and b.db.total_changes - before < 50


def test_spans_stand_for_their_messages(tmp_path):
    """Leases, acknowledgements, batches and seeks in any order, against one state a message; ids that are known leave gaps."""
    rng, now = random.Random(7), [0]
    b = queue(tmp_path, [], now=now)
    for k in range(6):
        b.publish([Message(f"m{rng.randrange(400)}", b"x" * rng.randrange(5), publish_ms=rng.randrange(100)) for _ in range(30)])
    every = {seq: (size, ms) for seq, size, ms in b.db.execute("SELECT seq, size, publish_ms FROM message")}
    state = dict.fromkeys(every, ("ready", None))

    def take(owner, count, most):
        found, held = [], 0
        for seq in sorted(s for s in state if state[s][0] == "ready")[:count]:
            if found and held + every[seq][0] > most:
                break
            found.append(seq)
            held += every[seq][0]
        state.update(dict.fromkeys(found, ("leased", owner)))
        return found

    snapshot = None
    for _ in range(400):
        owner, some = rng.choice("ab"), rng.sample(sorted(every), rng.randrange(1, 20))
        mine = [s for s in some if state[s] == ("leased", owner)]
        act = rng.choice(["lease"] * 6 + ["ack", "nack"] * 3 + ["seek", "take", "back"])
        if act == "lease":
            count, most = rng.randrange(1, 40), rng.choice([3, 30, 2**40])
            assert [m.seq for m in b.lease("s", owner, count, 10**9, most)] == take(owner, count, most)
        elif act == "ack":
            b.ack("s", owner, some)
            state.update(dict.fromkeys(mine, ("acked", owner)))
        elif act == "nack":
            b.nack("s", owner, some)
            state.update(dict.fromkeys(mine, ("ready", None)))
        elif act == "seek":
            b.seek("s", at := rng.randrange(100))
            state = {s: ("ready" if every[s][1] >= at else "acked", None) for s in every}
        elif act == "take":
            b.take_snapshot("s", "snap")
            snapshot = {s for s in every if state[s][0] == "acked"}
        elif snapshot is not None:
            b.seek_snapshot("s", "snap")
            state = {s: ("acked" if s in snapshot else "ready", None) for s in every}
        told = {k: sum(x[0] == k for x in state.values()) for k in ("ready", "leased", "acked")}
        assert b.counts("s") == {k: n for k, n in told.items() if n}
        held = [s for s in every if state[s] == ("leased", owner)]
        assert b.outstanding("s", owner) == (len(held), sum(every[s][0] for s in held))
    b.abandon("s", "a", -1)
    b.abandon("s", "b", -1)
    held = b.lease("s", "c", 1000, 10**9)
    b.produce("s", "c", [m for m in held if m.seq % 3])
    for parts in (1, 4):
        got = [[x[0] for rows in b.part_of_batch("s", "c", -1, 0, k, parts) for x in rows] for k in range(parts)]
        want = [m.messageid for m in held if m.seq % 3]
        assert got == [want[k::parts] for k in range(parts)]


def test_a_queue_from_before_spans(tmp_path):
    b = queue(tmp_path, [Message(f"m{k}", b"x") for k in range(4)])
    b.db.execute("CREATE TABLE delivery (subscription TEXT, seq INTEGER, state TEXT DEFAULT 'ready', owner TEXT, since_ms INTEGER, until_ms INTEGER DEFAULT 0, batch INTEGER, PRIMARY KEY (subscription, seq)) WITHOUT ROWID")
    b.db.execute("CREATE TABLE snapshot (name TEXT, seq INTEGER, PRIMARY KEY (name, seq)) WITHOUT ROWID")
    b.db.execute("INSERT INTO delivery (subscription, seq, state) SELECT 's', seq, CASE WHEN seq = 2 THEN 'acked' ELSE 'ready' END FROM message")
    b.db.execute("INSERT INTO snapshot VALUES ('snap', -1), ('snap', 1)")
    b.db.execute("DELETE FROM span")
    b.close()
    b = Broker(str(tmp_path / "q.db"))
    assert b.counts("s") == {"acked": 1, "ready": 3}
    b.seek_snapshot("s", "snap")
    assert ids(b.lease("s", "a", 9, 1000)) == ["m1", "m2", "m3"]


def reader(path, **options):
    r = StreamReader(Options.of(BASE | {"subscription": "projects/x/subscriptions/s", "queue": str(path / "q.db"), "receiveTime": "100ms"} | options), False, RAW)
    r._open()
    return r


NAME = "projects/x/subscriptions/s"


def test_flow_is_bounded_and_follows_the_budget(tmp_path):
    b = queue(tmp_path, [Message(f"m{k:03}", b"x" * 100) for k in range(60)], NAME)
    r = reader(tmp_path, batchCount="5")
    assert r.room()[0] == 10
    r.budget = replace(r.budget, size=1000)
    b.lease(NAME, r.owner, 3, 60_000)  # held for no batch
    assert r.retarget() and r.flow == 1000 and not r.retarget() and b.outstanding(NAME, r.owner) == (0, 0)
    assert len(r._poll(0, 60)) == 10 and r.room() == (0, 1000) and r._poll(0, 60) == []  # twice batchCount are out
    b.abandon(NAME, r.owner, -1)
    r.options = replace(r.options, batch_count=0)
    assert len(r._poll(0, 60)) == 20 and r._poll(0, 60) == []  # twice the bytes
    b.abandon(NAME, r.owner, -1)
    r.flow = 1  # a batch of one message holds more than may be out, and the next one must come all the same
    for k in range(3):
        held = r._poll(0, 60)
        assert len(held) == 1 and r._poll(0, 60) == []
        r.produced = b.produce(NAME, r.owner, held)
        b.settle(NAME, k - 1)
    r.stop()


def test_a_gather_keeps_what_it_has_taken(tmp_path):
    """However long it takes: its leases are renewed while it polls."""
    queue(tmp_path, [Message(f"m{k}") for k in range(6)], NAME)
    r = reader(tmp_path, ackDeadline="180s")
    now = [r.renewed]
    r.broker.clock_ms = lambda: now[0]
    got = []
    for _ in range(6):
        got += ids(r._poll(0, 1))
        now[0] += 100_000
    assert got == [f"m{k}" for k in range(6)] and r.broker.outstanding(NAME, r.owner)[0] == 6
    r.stop()


def test_a_stream_that_stalls_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(stream_queries, "STALLED_S", 0)
    with pytest.raises(TimeoutError):
        stream_queries.stream_redelivery(spark, "/root/testdata/sf0.001")


def test_stop_and_failure_give_back(tmp_path):
    b = queue(tmp_path, [Message(f"m{k}") for k in range(6)], NAME)
    r = reader(tmp_path, batchCount="4")
    assert r.latestOffset() == {"batchId": 0} and b.counts(NAME) == {"leased": 4, "ready": 2}
    r.stop()  # the batch was not planned
    assert b.counts(NAME) == {"ready": 6}
    r = reader(tmp_path)
    r._hot = lambda: (_ for _ in ()).throw(OSError("no /proc"))
    with pytest.raises(OSError):
        r.latestOffset()
    assert b.counts(NAME) == {"ready": 6}
    r = reader(tmp_path, batchCount="4")
    polls = r._poll
    r._poll = lambda wait, count: (polls(wait, 2), setattr(r, "stopped", True))[0]  # stopped while it gathers
    assert r.latestOffset() == {"batchId": r.produced} and b.counts(NAME) == {"ready": 6}


def test_offsets_are_idempotent_and_replay_is_exact(tmp_path):
    b = queue(tmp_path, [Message(f"m{k}") for k in range(6)], NAME)
    r = reader(tmp_path, batchCount="3")
    start = r.initialOffset()
    end = r.latestOffset()
    assert r.latestOffset() == end  # not consumed yet
    held = lambda who, parts: [x[0] for p in parts for rows in b.part_of_batch(NAME, p.owner, p.after, p.to, p.part, p.parts) for x in rows]
    planned = held(r, r.partitions(start, end))
    assert planned == ["m0", "m1", "m2"]
    # The process dies after the offset was logged; the next one is asked for the same batch.
    again = reader(tmp_path, batchCount="3")
    assert held(again, again.partitions(start, end)) == planned and b.outstanding(NAME, r.owner) == (0, 0)
    after = again.latestOffset()
    again.commit(end)
    assert held(again, again.partitions(end, after)) == ["m3", "m4", "m5"] and b.counts(NAME) == {"acked": 3, "leased": 3}


def test_a_busy_queue_is_tried_again(tmp_path):
    b = queue(tmp_path, [Message("m0")], NAME)
    r, calls = reader(tmp_path), []
    lease = r.broker.lease

    def busy(*args):
        calls.append(1)
        if len(calls) < 3:
            raise sqlite3.OperationalError("database is locked")
        return lease(*args)

    r.broker.lease = busy
    assert ids(r._poll(0, 5)) == ["m0"] and r.retry.attempts == 2 and b.counts(NAME) == {"leased": 1}


PAYLOADS = [
    '{"s":"x","b":true,"i":7,"l":9,"d":2.5,"t":"2024-01-15T10:30:00.123456789+01:00","n":3.146,"a":[1,"2",null],"m":{"k":1},"r":{"X":5}}',
    '{"S":3,"B":"true","I":"7.9","L":"-12","D":"1e3","T":1705312200000,"N":"3.5","A":4,"M":3,"R":{"x":null}}',
    '{"s":1.50,"b":0,"i":3000000000,"l":1.9e3,"d":"x","t":1705312200,"n":12,"a":{"z":1},"m":{"k":"5","j":{}},"r":7}',
    '{"s":{"b":1,"a":[1.0,true,null,"é\\"q"]},"b":"yes","i":-1.9,"l":true,"d":false,"t":null,"n":99999999999,"a":[],"m":{},"r":{}}',
    '{"s":null,"b":[],"i":{"a":1},"l":"x","d":null,"n":-0.005,"S":"other"}', "{}", "", "   ", None, "[1]", "3", '"x"',
    '{"s":1e20,"i":1e12,"l":1e30,"d":1e400,"n":1e2}', '{"s":true,"i":" 12 ","l":"9223372036854775808","d":" 2 "}',
]
FIELDS = "s string, b boolean, i int, l long, d double, t timestamp, n decimal(8,2), a array<int>, m map<string,int>, r struct<x:int>"


def test_rows_decode_as_columns_do(spark):
    schema = T._parse_datatype_string(FIELDS)
    df = spark.createDataFrame([(k, p.encode() if p is not None else None) for k, p in enumerate(PAYLOADS)], "at int, body binary")
    rows, columns = payload_fields(df, [(f.name, f.dataType) for f in schema.fields])
    want = rows.select("at", *(c.alias(f.name) for f, c in zip(schema.fields, columns, strict=True))).orderBy("at").collect()
    decode = Decoder([(f.name, f.dataType) for f in schema.fields])
    for p, row in zip(PAYLOADS, want, strict=True):
        got = dict(zip(schema.names, decode(p.encode() if p is not None else None), strict=True))
        got["t"] = got["t"] and got["t"].astimezone().replace(tzinfo=None)
        told = row.asDict(recursive=True)
        told.pop("at")
        assert got == told, p
    for bad, kind in (("{not", T.StringType()), ('{"x":"2024-01-15"}', T.TimestampType()), ('{"x":NaN}', T.DoubleType())):
        with pytest.raises(ValueError):
            Decoder([("x", kind)])(bad.encode())
    with pytest.raises(ValueError):
        Decoder([("x", T.DateType())])


def test_the_format_takes_schema_modes_and_schemas(spark, tmp_path):
    queue(tmp_path, [Message(f"m{k}", b'{"K": %d, "x": "y"}' % k, {"a": "b"}, 1000 * k, "key") for k in range(4)], "projects/p/subscriptions/s")
    (tmp_path / "t.avsc").write_text('{"type":"record","name":"r","fields":[{"name":"k","type":"int"}]}')
    register(spark)
    load = lambda schema=None, **o: (spark.read.format("mq").schema(schema) if schema else spark.read.format("mq")).options(**BASE, queue=str(tmp_path / "q.db"), **o).load()
    assert load().columns == ["body", "messageid", "publishtime"] and load(schemaMode="raw").columns == ["body"]
    assert load(metadataMode="full").columns == ["body", "messageid", "publishtime", "orderingkey", "ackid", "attributes"]
    df = load(schemaMode="mixed", topic="t", registry=str(tmp_path))
    assert df.columns == ["k", "messageid", "publishtime"] and sorted(r.k for r in df.collect()) == [0, 1, 2, 3]
    mine = load("k long, Data binary, MessageId string, absent string", numWriters="3").orderBy("k").collect()
    assert [(r.k, r.Data, r.MessageId, r.absent) for r in mine] == [(k, b'{"K": %d, "x": "y"}' % k, f"m{k}", None) for k in range(4)]
    assert [r.messageid for r in load(seek="timestamp", seekTime="1000", limitTime="3000").collect()] == ["m1", "m2"]
    assert load(batchCount="3").count() == 3
    with pytest.raises(Exception, match="schema"):
        load(schemaMode="dynamic").count()


def test_a_seek_to_a_snapshot_reads_again(spark, tmp_path):
    b = queue(tmp_path, [Message(f"m{k}") for k in range(6)], "projects/p/subscriptions/s")
    name = "projects/p/subscriptions/s"
    b.ack(name, "x", [m.seq for m in b.lease(name, "x", 2, 60_000)])
    b.take_snapshot(name, "snap")
    b.ack(name, "x", [m.seq for m in b.lease(name, "x", 4, 60_000)])
    seen = []
    drain(spark, BASE | {"queue": str(tmp_path / "q.db"), "seek": "snapshot", "seekSnapshot": "snap"}, str(tmp_path / "c"), lambda df, _: seen.extend(r.messageid for r in df.collect()))
    assert sorted(seen) == ["m2", "m3", "m4", "m5"] and b.counts(name) == {"acked": 6}


def test_drain_splits_and_settles(spark, tmp_path):
    path = str(tmp_path / "q.db")
    b = Broker(path)
    b.subscribe("projects/p/subscriptions/s")
    b.publish([Message(f"m{k}", b'{"k": %d}' % k, {"a": "b"}, k, "key") for k in range(12)])
    seen = []
    runs = drain(spark, BASE | {"queue": path, "batchCount": "5", "schemaMode": "slim"}, str(tmp_path / "c"), lambda df, _: seen.append(sorted(r.messageid for r in df.collect())))
    assert runs == 3 and [len(x) for x in seen] == [5, 5, 2] and len({i for x in seen for i in x}) == 12
    assert b.counts("projects/p/subscriptions/s") == {"acked": 12}


def test_a_running_query_commits_the_batch_before(spark, tmp_path):
    path, checkpoint = str(tmp_path / "q.db"), str(tmp_path / "c")
    b = Broker(path)
    b.subscribe("projects/p/subscriptions/s")
    b.publish([Message(f"m{k}", b"{}", {}, k, "") for k in range(6)])
    options, seen = BASE | {"queue": path, "batchCount": "2", "receiveTime": "1s"}, []
    stream = read_stream(spark, options).writeStream.foreachBatch(lambda df, _: seen.extend(r.messageid for r in df.collect()))
    query = stream.option("checkpointLocation", checkpoint).trigger(processingTime="1 second").start()
    try:
        until = time.monotonic() + 90
        while len(seen) < 6 and time.monotonic() < until:
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted(seen) == [f"m{k}" for k in range(6)]
    assert b.counts("projects/p/subscriptions/s")["acked"] >= 4
    assert settle(spark, Options.of(options), checkpoint) == 2
    assert b.counts("projects/p/subscriptions/s") == {"acked": 6}
    assert {r["name"]: r["value"] for r in read_metrics(spark, options).where("batch = 2").collect()}["lastGatherMessageCount"] == "2"


def test_a_query_that_runs_once(spark, tmp_path, caplog):
    b = queue(tmp_path, [Message(f"m{k}") for k in range(3)], "projects/p/subscriptions/s")
    seen, options = [], BASE | {"queue": str(tmp_path / "q.db"), "receiveTime": "500ms", "emulatorHost": "localhost:1"}
    stream = read_stream(spark, options).writeStream.foreachBatch(lambda df, _: seen.extend(r.messageid for r in df.collect()))
    stream.option("checkpointLocation", str(tmp_path / "c")).trigger(once=True).start().awaitTermination()
    assert sorted(seen) == ["m0", "m1", "m2"] and "emulatorHost is ignored" in caplog.text
    assert settle(spark, Options.of(options), str(tmp_path / "c")) == 0 and b.counts("projects/p/subscriptions/s") == {"acked": 3}


def test_a_killed_query_loses_nothing(spark, tmp_path):
    """A sink that fails leaves a planned batch behind; the next run of the query writes it, and then the rest."""
    b = queue(tmp_path, [Message(f"m{k}") for k in range(6)], "projects/p/subscriptions/s")
    seen, options, broken = [], BASE | {"queue": str(tmp_path / "q.db"), "batchCount": "2"}, [True]

    def write(df, n):
        if n and broken[0]:
            raise RuntimeError("the sink is gone")
        seen.append(sorted(r.messageid for r in df.collect()))

    with pytest.raises(Exception, match="sink is gone"):
        drain(spark, options, str(tmp_path / "c"), write)
    assert seen == [["m0", "m1"]] and b.counts("projects/p/subscriptions/s") == {"acked": 2, "leased": 2, "ready": 2}
    broken[0] = False
    drain(spark, options, str(tmp_path / "c"), write)
    assert seen == [["m0", "m1"], ["m2", "m3"], ["m4", "m5"]] and b.counts("projects/p/subscriptions/s") == {"acked": 6}


def test_a_limit_in_time_whatever_the_ids(spark, tmp_path):
    """Ids that run against time, and more messages than a poll takes: all before the limit come."""
    at = F.timestamp_millis(F.lit(1_700_000_000_000) - F.col("id") * 1000).cast("timestamp_ntz")
    rows = spark.range(25_000).select(F.col("id").alias("event_id"), at.alias("ts"), F.lit(1).alias("user_id"), F.lit("x").alias("event_type"), F.lit("{}").alias("props"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    assert stream_queries.stream_limit_time(spark, str(tmp_path)).count() == 18750


def rows_of(b):
    """The rows of each of the queue's tables."""
    return {name: b.db.execute(f"SELECT count(*) FROM {name}").fetchone()[0] for (name,) in b.db.execute("SELECT name FROM sqlite_master WHERE type = 'table'").fetchall()}


def test_published_tables_are_few_rows_of_the_queue(spark):
    """What is published, leased, batched and read of a table costs some calls a chunk, none a message."""
    setup = stream_queries.Setup(spark, "/root/testdata/sf0.1")
    b, name = Broker(setup.queue), "projects/p/subscriptions/s"
    before, held = b.db.total_changes, []
    while part := b.lease(name, "me", 10_000, 60_000):
        held.append(part)
    assert b.produce(name, "me", held) == 0 and b.count(name, "me", -1, 0) == sum(map(len, held)) == 100_000
    assert sum(t.num_rows for t in b.tables_of_batch(name, "me", -1, 0, 0, 1)) == 100_000
    assert sum(rows_of(b).values()) < 100 and b.db.total_changes - before < 100


def table(rows):
    """(messageid, body, publish_ms) as a table to publish."""
    names, bodies, times = zip(*rows, strict=True) if rows else ((), (), ())
    columns = {"messageid": pa.array(names, pa.string()), "size": pa.array([len(x) for x in bodies], pa.int32()), "attributes": pa.array(["{}"] * len(names), pa.string())}
    return pa.RecordBatch.from_pydict(columns | {"ms": pa.array(times, pa.int64()), "orderingkey": pa.array([""] * len(names), pa.string()), "body": pa.array(bodies, pa.binary())})


@pytest.mark.parametrize("seed", range(6))
def test_tables_and_messages_are_one_queue(tmp_path, monkeypatch, seed):
    """Published as tables or one at a time, ids that are known are passed over and all else is as in a list; in small chunks."""
    monkeypatch.setattr(store, "AT_ONCE", 7)
    if seed % 2:  # whose hashes tell nothing
        monkeypatch.setattr(store, "hashed", lambda ids: np.zeros(len(ids), np.uint64))
    rng, known = random.Random(seed), {}
    b = queue(tmp_path, [])
    for k in range(12):
        rows = [(f"m{rng.randrange(300)}", b"x" * rng.randrange(5), rng.randrange(100)) for _ in range(rng.randrange(30))]
        fresh = {}
        for i, body, ms in rows:
            if i not in known:
                fresh.setdefault(i, (body, ms))
        known |= fresh
        if rng.random() < 0.6:
            assert b.publish_tables([table(rows[:9]), table(rows[9:])]) == len(fresh)
        else:
            b.publish([Message(i, body, publish_ms=ms) for i, body, ms in rows])
    names = list(known)
    told = [m for low, high in [(0, 10**6)] for m in b.store.messages(low, high)]
    assert [(m.messageid, m.publish_ms, m.size()) for m in told] == [(i, ms, len(body)) for i, (body, ms) in known.items()]
    bounds = b.waiting("s", 20, 80, 50)
    want = [m.messageid for m in told if 20 <= m.publish_ms < 80][:50]
    got = [[i for t in b.tables_in_range(*bounds, low, high) for i in t["messageid"].to_pylist()] for low, high in b.ranges(*bounds, 3)]
    assert [i for part in got for i in part] == want and max(map(len, got)) - min(map(len, got)) <= 1
    at = 0
    while at < len(names):
        count, most = rng.randrange(1, 20), rng.choice([0, 3, 25, 2**40])
        held, size = [], 0
        for i in names[at : at + count]:
            if held and size + len(known[i][0]) > most:
                break
            held.append(i)
            size += len(known[i][0])
        block = b.lease("s", "a", count, 10**9, most)
        assert ids(block) == held and (len(block), store.weight(block), store.newest(block)) == (len(held), size, max(known[i][1] for i in held))
        at += len(held)
    b.produce("s", "a", [m for m in told if m.seq % 3])
    for parts in (1, 4):
        got = [[x[0] for rows in b.part_of_batch("s", "a", -1, 0, k, parts) for x in rows] for k in range(parts)]
        assert got == [[m.messageid for m in told if m.seq % 3][k::parts] for k in range(parts)]
    assert b.publish_tables([table([(i, b"", 0) for i in names])]) == 0 and b.publish_tables([]) == 0
    b.seek("s", 50)
    later = [m for m in told if m.publish_ms >= 50]
    assert b.counts("s") == {"acked": len(told) - len(later), "ready": len(later)} and ids(b.lease("s", "b", 10**6, 1000)) == ids(later)


def test_a_message_without_a_time_is_refused(tmp_path):
    b = queue(tmp_path, [])
    with pytest.raises(ValueError):
        b.publish_tables([table([("m0", b"", 1)]), table([("m1", b"", None)])])
    assert b.counts("s") == {} and b.publish_tables([table([("m0", b"", 1)])]) == 1


def test_what_is_published_later_is_few_rows_too(spark):
    every = stream_queries.messages(spark, "/root/testdata/sf0.1")
    at = F.col("messageid").cast("long")
    setup = stream_queries.Setup(spark, "", every.where(at % 7 != 0))
    setup.drain()
    setup.publish(every.where(at % 7 == 0))
    setup.publish(every.where(at % 7 == 0))  # known already
    b = Broker(setup.queue)
    assert sum(rows_of(b).values()) < 100 and sum(setup.counts().values()) == 100_000 and setup.counts()["ready"] == 14_286


def opened(spark, **options):
    """A drain's reader of a queue of 100,000 events, and how many steps its queries have taken."""
    setup, steps = stream_queries.Setup(spark, "/root/testdata/sf0.1"), [0]
    r = StreamReader(Options.of(setup.options | options), True, RAW)
    r._open().db.set_progress_handler(lambda: steps.__setitem__(0, steps[0] + 100), 100)
    return r, steps


def test_a_seek_looks_at_no_message_alone(spark):
    r, steps = opened(spark)
    b, name = r.broker, r.options.subscription
    at = 1_705_276_800_000  # in the middle
    b.seek(name, at)
    later = sum(int((h.times >= at).sum()) for h in b.store.heads(0, 2**40))
    assert b.counts(name) == {"acked": 100_000 - later, "ready": later} and 0 < later < 100_000 and steps[0] < 20_000
    r.stop()


def test_a_batch_is_cut_without_a_look_at_each_message(spark):
    r, steps = opened(spark, batchCount="50001")
    assert r.latestOffset() == {"batchId": 0} and r.broker.count(r.options.subscription, r.owner, -1, 0) == 50_001
    assert steps[0] < 100_000
    r.stop()


def test_a_batch_is_read_by_whole_columns(spark):
    r, _ = opened(spark)
    start, end = r.initialOffset(), r.latestOffset()
    tables = [t for p in r.partitions(start, end) for t in r.read(p)]
    assert sum(t.num_rows for t in tables) == 100_000 and len(tables) < 20
    r.stop()


def test_a_gather_until_idle_holds_no_messages(spark):
    r, _ = opened(spark)
    tracemalloc.start()
    try:
        r.latestOffset()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert r.broker.outstanding(r.options.subscription, r.owner)[0] == 100_000 and r.broker.idle(r.options.subscription) and peak < 5e6
    r.stop()


def test_tasks_share_a_batch_by_whole_columns(spark):
    r, _ = opened(spark, numWriters="3")
    start, end = r.initialOffset(), r.latestOffset()
    parts = [list(r.read(p)) for p in r.partitions(start, end)]
    assert [sum(t.num_rows for t in part) for part in parts] == [33_334, 33_333, 33_333] and max(map(len, parts)) < 10
    assert len({i for part in parts for t in part for i in t["messageid"].to_pylist()}) == 100_000
    r.stop()


def test_attributes_are_parsed_once_a_chunk(spark, monkeypatch):
    r, _ = opened(spark)
    start, end = r.initialOffset(), r.latestOffset()
    parsed, loads = [], json.loads
    monkeypatch.setattr(json, "loads", lambda text: parsed.append(text) or loads(text))
    kinds = {tuple(m) for p in r.partitions(start, end) for t in r.read(p) for m in t["attributes"].to_pylist()}
    assert len(kinds) == len(set(parsed)) > 1 and len(parsed) <= 8 * len(kinds)
    r.stop()


def test_tasks_make_the_chunks(spark, monkeypatch):
    def fail(_):
        raise AssertionError("the driver hashes")

    monkeypatch.setattr(store, "hashed", fail)
    setup = stream_queries.Setup(spark, "/root/testdata/sf0.01")
    b = Broker(setup.queue)
    assert [m.messageid for m in b.store.messages(0, 2**40)] == [str(k) for k in range(10_000)]


def test_messages_are_put_in_order_by_several_keys(spark, monkeypatch):
    monkeypatch.setattr(stream_queries, "PART_ROWS", 10)
    rows = [(k % 7 if k % 5 else None, k) for k in range(997)]
    df = stream_queries.in_order(spark.createDataFrame(rows, "a int, b int"), "a", F.col("b"))
    assert [tuple(r) for r in df.collect()] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) and df.rdd.getNumPartitions() > 1
    assert stream_queries.in_order(df.where("false"), "a", "b").collect() == []


def test_large_messages_make_small_chunks(monkeypatch):
    monkeypatch.setattr(store, "CHUNK_BYTES", 1000)
    rows = [(f"m{k}", b"x" * 300, k) for k in range(50)]
    parts = list(store.regrouped(table(rows[k : k + 3]) for k in range(0, 50, 3)))
    assert [i for p in parts for i in p["messageid"].to_pylist()] == [i for i, _, _ in rows] and max(p.num_rows for p in parts) <= 6
    assert [p.num_rows for p in store.regrouped([table([(str(k), b"", k) for k in range(40_000)])])] == [16_384, 16_384, 7_232]


def test_a_drains_sink_is_written_by_all_cores(spark):
    out = stream_queries.Setup(spark, "/root/testdata/sf0.01").drain()
    assert out.count() == 10_000 and len(out.inputFiles()) == spark.sparkContext.defaultParallelism


def test_only_the_columns_of_the_table_are_read(spark, tmp_path):
    queue(tmp_path, [Message("m0", b'{"k": 1}', {"a": "b"}, 1000, "key")], "projects/p/subscriptions/s")
    asked = []

    class Reader:
        def format(self, _):
            return self

        def options(self, **options):
            asked.append(options["envelope"])
            return spark.read.format("mq").options(**options)

    session = type("Session", (), {"read": Reader(), "dataSource": spark.dataSource})()
    read = lambda schema=None, **o: source.read_batch(session, BASE | {"queue": str(tmp_path / "q.db")} | o, schema).first().asDict()
    assert read(schemaMode="slim") == {"body": b'{"k": 1}', "messageid": "m0", "publishtime": read()["publishtime"], "orderingkey": "key"}
    assert read(T.StructType([T.StructField("k", T.IntegerType()), T.StructField("MessageId", T.StringType())])) == {"k": 1, "MessageId": "m0"}
    assert read(schemaMode="raw", metadataMode="full")["attributes"] == {"a": "b"}
    assert asked == ["body,messageid,publishtime,orderingkey", "body,messageid,publishtime", "body,messageid", "body,messageid,publishtime,orderingkey,ackid,attributes"]


def test_packed_rows_are_the_messages(spark, monkeypatch):
    """What a task hands on as it lies holds the batch's messages, cut where the batch ends, in rows of a bounded size."""
    r, _ = opened(spark, batchCount="20001")
    start, end = r.initialOffset(), r.latestOffset()
    plain = [t for p in r.partitions(start, end) for t in r.read(p)]
    r.rows = source.Packed(["publishtime", "ackid", "messageid"])
    packed = [t for p in r.partitions(start, end) for t in r.read(p)]
    assert all(t.num_rows == 1 for t in packed) and len(packed) == 10
    back = [t for p in packed for t in source.Rows(T.StructType([RAW["messageid"], RAW["publishtime"], RAW["ackid"]]))(pa.ipc.open_stream(p["rows"][0].as_buffer()))]
    assert max(t.num_rows for t in back) == source.PACKED_ROWS
    assert pa.Table.from_batches(back) == pa.Table.from_batches(plain).select(["messageid", "publishtime", "ackid"])
    monkeypatch.setattr(source, "CHUNK_BYTES", 10_000)
    assert max(p["rows"].nbytes for p in r.rows(iter([rows for rows in [table([(f"m{k}", b"x" * 3000, k) for k in range(50)]).rename_columns(["messageid", "size", "attributes", "publish_ms", "orderingkey", "body"])]]))) < 12_000
    r.stop()


@pytest.mark.parametrize("writers", ["1", "3"])
def test_a_spread_stream_is_the_stream(spark, writers):
    setup = stream_queries.Setup(spark, "/root/testdata/sf0.01")
    found, tasks = {}, {}
    for spread in (False, True):
        setup.publish(stream_queries.messages(spark, "/root/testdata/sf0.001").withColumn("messageid", F.concat(F.lit(f"{1 + spread}0000"), "messageid")))
        given = setup.options | {"numWriters": writers, "schemaMode": "raw", "metadataMode": "full"}

        def keep(df, _, spread=spread):
            tasks[spread] = df.rdd.getNumPartitions()
            found[spread] = sorted((r["messageid"][5:], bytes(r["body"]), r["publishtime"], r["orderingkey"], r["ackid"][5:], tuple(r["attributes"].items())) for r in df.where(F.length("messageid") > 5).collect())

        stream_queries.drain(spark, given, f"{setup.folder}/checkpoint", keep, spread=spread)
    assert found[True] == found[False] and len(found[True]) > 100
    assert tasks == {False: int(writers), True: spark.sparkContext.defaultParallelism}


def test_parts_that_lie_in_order_stay_where_they_are(spark, monkeypatch):
    lie = lambda *parts: spark.createDataFrame(spark.sparkContext.parallelize(range(len(parts)), len(parts)).flatMap(lambda k: [(i,) for i in range(*parts[k])]), "id long")
    lies = lambda df, key=F.col("id"): stream_queries.lies_in_order(df, key)
    ranges = (300, 400), (0, 100), (100, 200)
    apart = lie(*ranges)
    assert lies(apart) and lies(apart.where("false")) and lies(apart.where("id < 50"))
    assert not lies(lie(*ranges, (50, 60))) and not lies(lie(*ranges, (399, 410))) and not lies(apart, F.when(F.col("id") != 7, F.col("id")))
    monkeypatch.setattr(stream_queries, "AT_ONCE", 60)
    assert not lies(lie(*ranges, (1000, 1500)))  # one part of much more than its share

    def rows(df):
        return df.select(F.col("id").cast("string").alias("messageid"), F.lit(b"x").alias("body"), F.timestamp_seconds("id").alias("publishtime"), F.lit("").alias("orderingkey"), F.create_map(F.lit("a"), F.lit("b")).alias("attributes"))

    def fed(df):
        folder = stream_queries.shared_folder(spark)
        return [i for c in stream_queries.feed(rows(df), f"{folder}/feed", F.col("messageid").cast("long")) for i in pa.ipc.open_stream(c.rows).read_next_batch()["messageid"].to_pylist()]

    expected = [str(k) for k in (*range(200), *range(300, 400))]
    dealt = stream_queries.in_order
    monkeypatch.setattr(stream_queries, "in_order", None)
    assert fed(apart) == expected
    monkeypatch.setattr(stream_queries, "lies_in_order", lambda *_: True)  # parts that lay otherwise when they were told
    monkeypatch.setattr(stream_queries, "in_order", dealt)
    assert fed(spark.range(0, 100, 1, 3).repartition(3).select("id")) == expected[:100]


def test_pairs_near_in_time_are_looked_for_within_an_hour(spark):
    """Many rows of one key: a pair comes once, over the ends of hours too, and what is compared is bounded by time."""
    left = [(k % 3, k, (k * 7919) % 20_000 - 9000) for k in range(600)]
    right = [(k % 3, k, (k * 104_729) % 20_000 - 9000) for k in range(600)] + [(0, 9000 + k, k * 3600 + d) for k in range(3) for d in (-1, 0, 1, 299, 300, 301)] + [(0, 9100 + d, 3600 + d) for d in (0, 300)]
    left += [(0, 8000, 0), (0, 8001, 3600), (0, 8002, 3300), (0, 8003, 3599)]
    frame = lambda rows, side: spark.createDataFrame(rows, f"{side}_key int, {side}_id int, s int").withColumn(f"{side}_time", F.timestamp_seconds("s")).drop("s")
    pairs = stream_queries.near_pairs(frame(left, "left"), frame(right, "right"))
    expected = sorted((a, b) for k, a, s in left for m, b, t in right if k == m and s <= t <= s + 300)
    assert sorted(tuple(r) for r in pairs.select("left_id", "right_id").collect()) == expected and len(expected) > 100
    assert "left_hour" in pairs.columns and pairs.where("left_hour <> right_hour").count() == 0


@pytest.mark.parametrize("most", [0, 90])
def test_a_join_takes_all_pairs(spark, tmp_path, monkeypatch, most):
    """Every message is on both sides, whatever its id, and however many batches they come in; ids do not run with time."""

    class Small(stream_queries.Setup):
        def __init__(self, *args, **options):
            super().__init__(*args, **options)
            self.options["batchCount"] = str(most)

    monkeypatch.setattr(stream_queries, "Setup", Small)
    rows = [(k * 77 % 201 - 50, k % 3, k * 97 - 9000) for k in range(201)] + [(1000, 0, 300), (1002, 0, 0), (1004, 1, 8000), (1005, 1, 8000)]
    table = spark.createDataFrame(rows, "event_id long, user_id long, s long").select("event_id", "user_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), F.lit("view").alias("event_type"), F.lit("{}").alias("props"))
    table.write.parquet(f"{tmp_path}/events.parquet")
    parts, told = spark.conf.get("spark.sql.shuffle.partitions"), stream_queries.stream_join(spark, str(tmp_path))
    expected = sorted((str(a), str(b)) for a, u, s in rows for b, v, t in rows if u == v and s <= t <= s + 300)
    assert sorted(tuple(r) for r in told.collect()) == expected and len(expected) > 2 * len(rows) - 10
    assert spark.conf.get("spark.sql.shuffle.partitions") == parts


def test_windows_read_their_time_alone(spark, monkeypatch):
    told, drain = [], stream_queries.drain
    monkeypatch.setattr(stream_queries, "drain", lambda *a, **k: told.append(k) or drain(*a, **k))
    assert stream_queries.stream_window_agg(spark, "/root/testdata/sf0.001").count() > 10
    assert told[0]["schema"].names == ["publishtime"] and told[0]["spread"]
