"""Envelopes, the wire, Avro, the schema contract and dead letters."""

import copy
import io
import json

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import avro, contract, dead_letters, envelope
from ledgerline.sources.registry import FolderRegistry

ROW = {
    "type": "record",
    "name": "Value",
    "fields": [
        {"name": "transaction_id", "type": "string"},
        {"name": "merchant_id", "type": "string"},
        {"name": "amount_minor", "type": "long"},
        {"name": "currency", "type": "string"},
        {"name": "status", "type": "string"},
        {"name": "event_type", "type": "string"},
        {"name": "created_at", "type": "string", "default": ""},
        {"name": "updated_at", "type": "string", "default": ""},
    ],
}


def schema(row=ROW):
    source = {"type": "record", "name": "Source", "fields": [{"name": "lsn", "type": ["null", "long"]}, {"name": "ts_ms", "type": "long"}]}
    fields = [{"name": "before", "type": ["null", row]}, {"name": "after", "type": ["null", row["name"]]}, {"name": "source", "type": source}, {"name": "op", "type": "string"}, {"name": "ts_ms", "type": ["null", "long"]}]
    return json.dumps({"type": "record", "name": "Envelope", "namespace": "x", "fields": fields})


def image(**more):
    return {"transaction_id": "t1", "merchant_id": "M", "amount_minor": -5, "currency": "USD", "status": "S", "event_type": "E", "created_at": "2024-05-06T07:08:09.123456Z", "updated_at": "bad"} | more


def test_avro_by_writer_schema(spark, tmp_path):
    registry = FolderRegistry(str(tmp_path))
    wider = copy.deepcopy(ROW)
    wider["fields"].append({"name": "channel", "type": ["null", "string"], "default": None})
    one, two = registry.register("changes", schema()), registry.register("changes", schema(wider))
    assert (one, two) == (1, 2) and registry.register("changes", schema()) == 1 and registry.latest("changes")[0] == 2
    wire = lambda i, s, v: b"\0" + i.to_bytes(4, "big") + avro.Codec(s).write(v)
    update = {"before": None, "after": image(), "source": {"lsn": 7, "ts_ms": 1_700_000_000_123}, "op": "u", "ts_ms": None}
    delete = {"before": image(transaction_id="t2", channel="web"), "after": None, "source": {"lsn": None, "ts_ms": 0}, "op": "d", "ts_ms": 1}
    rows = [(wire(1, schema(), update), 0, 1), (wire(2, schema(wider), delete), 0, 2), (None, 0, 3), (b"\0\0\0\0\1\xff", 0, 4), (b"\0\0\0\0\2", 0, 5)]
    raw = spark.createDataFrame([(bytearray(v) if v is not None else None, p, o) for v, p, o in rows], "value binary, partition int, offset long")
    got = {r["offset"]: r for r in envelope.flatten(avro.decode(raw, registry)).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert (got[1]["transaction_id"], got[1]["amount_minor"], got[1]["lsn"], got[1]["is_delete"], got[1]["updated_at"]) == ("t1", -5, 7, False, None)
    assert got[1]["created_at"].microsecond == 123456 and got[1]["source_ts"].microsecond == 123000
    assert (got[2]["transaction_id"], got[2]["is_delete"], got[2]["lsn"]) == ("t2", True, None)
    assert got[4]["transaction_id"] is None and got[4]["op"] is None
    one = envelope.flatten(avro.decode_single(raw.filter("offset in (1, 3)"), schema())).collect()
    assert [(r["transaction_id"], r["lsn"], r["offset"]) for r in one] == [("t1", 7, 1)]
    odd = json.loads(schema())
    odd["fields"][3]["type"] = "long"  # op is a number there: not an envelope of ours
    wrong = wire(1, odd, update | {"op": 5})
    raw = spark.createDataFrame([(bytearray(wrong), 0, 9)], "value binary, partition int, offset long")
    assert envelope.flatten(avro.decode_single(raw, json.dumps(odd))).first()["op"] is None


def test_codec_round_trip():
    s = {"type": "record", "name": "R", "fields": [
        {"name": "a", "type": {"type": "array", "items": "int"}}, {"name": "m", "type": {"type": "map", "values": "double"}}, {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["X", "Y"]}},
        {"name": "f", "type": {"type": "fixed", "name": "F", "size": 2}}, {"name": "b", "type": "boolean"}, {"name": "n", "type": ["null", "R"]}, {"name": "y", "type": "bytes"},
    ]}
    value = {"a": [1, -2, 2**40], "m": {"k": 1.5}, "e": "Y", "f": b"ab", "b": True, "y": b"\0", "n": {"a": [], "m": {}, "e": "X", "f": b"cd", "b": False, "y": b"", "n": None}}
    codec = avro.Codec(s)
    assert codec.read(io.BytesIO(codec.write(value))) == value
    with pytest.raises(EOFError):
        codec.read(io.BytesIO(codec.write(value)[:-3]))


def mutated(change):
    row = copy.deepcopy(ROW)
    change(row["fields"])
    return schema(row)


def named(fields, name):
    return next(f for f in fields if f["name"] == name)


CONTRACTS = {
    "optional field": (lambda f: f.append({"name": "channel", "type": ["null", "string"], "default": None}), contract.COMPATIBLE, ""),
    "removed field": (lambda f: f.remove(named(f, "event_type")), contract.COMPATIBLE, ""),
    "renamed field": (lambda f: named(f, "currency").update(name="ccy"), contract.BREAKING, "currency may have been renamed"),
    "changed type": (lambda f: named(f, "amount_minor").update(type="string"), contract.BREAKING, "was long"),
    "required field": (lambda f: f.append({"name": "risk_level", "type": "string"}), contract.BREAKING, "has no default"),
    "promoted type": (lambda f: named(f, "amount_minor").update(type="double"), contract.COMPATIBLE, ""),
}


@pytest.mark.parametrize("name", CONTRACTS)
def test_contract(spark, name):
    change, code, reason = CONTRACTS[name]
    got, why = contract.check(spark, schema(), mutated(change))
    assert got == code and (not reason or any(reason in w for w in why))


def test_contract_fails_closed(spark, tmp_path):
    for bad in (None, "", "not json", '{"type": "nonsense"}'):
        assert contract.check(spark, schema(), bad)[0] == contract.UNDECIDED
    assert contract.check_latest(spark, FolderRegistry(str(tmp_path)), "none", schema())[0] == contract.UNDECIDED


def test_wire_header(spark):
    df = spark.createDataFrame([(bytearray(b"\0\0\0\0\7\xaa\xbb"),), (bytearray(b"\1"),), (None,)], "value binary")
    ident, payload = envelope.header(F.col("value"))
    got = df.select(ident.alias("i"), F.hex(payload).alias("p")).collect()
    assert (got[0]["i"], got[0]["p"]) == (7, "AABB") and got[2]["i"] is None


LETTER = "offset long, transaction_id string, lsn long, rejection_reason string, op string, merchant_id string, amount_minor long, currency string"


def letters(spark, *rows):
    return spark.createDataFrame([(o, i, n, r, "c", "MERCH_001", 1, "USD") for o, i, n, r in rows], LETTER)


def lake(spark, **lsns):
    return spark.createDataFrame(list(lsns.items()), "transaction_id string, lsn long")


def test_parse(spark):
    rows = [(0, "key-1", "not json"), (1, None, '{"transaction_id": "a", "lsn": 5, "amount_minor": null, "op": ""}'), (2, "k", "[1, 2]"), (3, None, "7")]
    got = dead_letters.parse(spark.createDataFrame(rows, "offset long, key string, value string")).orderBy("offset").collect()
    assert [(r["transaction_id"], r["lsn"], r["op"]) for r in got] == [("key-1", 0, "c"), ("a", 5, "c"), ("k", 0, "c"), ("", 0, "c")]
    assert got[0]["payload"] == "not json"


def test_open_counts(spark):
    # p: held at an older lsn; q: never held, in the source, two letters of one change; r: held at the letter's lsn; s: never held, not in the source
    sent = letters(spark, (10, "p", 7, "A"), (11, "q", 3, "A"), (12, "q", 3, "B"), (13, "q", 4, "A"), (14, "r", 9, "A"), (15, "s", 1, "A"))
    own = lake(spark, p=0, q=0, r=0, z=0)
    got = dead_letters.open_counts(sent, lake(spark, p=6, r=9), own.union(own)).first()  # a source row twice counts once
    assert (got["messages"], got["open"], got["missing"]) == (6, 4, 1)
    assert {r["transaction_id"] for r in dead_letters.missing_open(sent, lake(spark, p=6, r=9), own).collect()} == {"q"}
    assert tuple(dead_letters.open_counts(sent.limit(0), lake(spark, p=6), own).first()) == (0, 0, 0)
    assert tuple(dead_letters.open_counts(sent, lake(spark, p=7).limit(0), own.limit(0)).first()) == (6, 5, 0)


def test_open_counts_read_each_side_once(spark, tmp_path):
    for name, df in (("x", letters(spark, (1, "p", 7, "A"))), ("l", lake(spark, p=6)), ("s", lake(spark, p=0))):
        df.write.parquet(str(tmp_path / name))
    sides = [spark.read.parquet(str(tmp_path / n)) for n in "xls"]
    plan = dead_letters.open_counts(*sides)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2 * 3 and "NestedLoop" not in plan  # adaptive plans print themselves twice


def test_pages(spark):
    rows = letters(spark, *((100 + 3 * i, f"id{i}", i, "UNKNOWN_MERCHANT,INVALID_UUID" if i % 3 else "NEGATIVE_AMOUNT") for i in range(9)))
    wanted = dead_letters.with_reason(rows, "uuid")  # offsets 103, 106, 112, 115, 121, 124
    pages, cursor = [], 0
    while True:
        found = dead_letters.page(wanted, cursor, 4).orderBy("offset").collect()
        pages.append([r["offset"] for r in found])
        if not found[0]["next_cursor"]:
            break
        cursor = int(found[0]["next_cursor"])
    assert pages == [[103, 106, 112, 115], [121, 124]]
    assert dead_letters.page(wanted, 0, 0).count() == 1  # limits are at least one
    again = letters(spark, (5, "x", 2, "A"), (4, "x", 2, "B"), (6, "x", 3, "A"))
    assert sorted(r["offset"] for r in dead_letters.collapsed(again).collect()) == [4, 6]


def test_reasons_that_cannot_be(spark):
    rows = letters(spark, (1, "x", 1, "INVALID_UUID"))
    for bad in ("a b", "x;y", "Ä", "A" * 65, "%"):
        with pytest.raises(ValueError, match="not a part"):
            dead_letters.with_reason(rows, bad)
    assert dead_letters.with_reason(rows, "").count() == 1


def test_scan_and_watermarks(spark):
    rows = spark.createDataFrame([(n, f"k{n}", json.dumps({"transaction_id": f"t{n}", "lsn": n})) for n in (20, 21, 23, 30)], "offset long, key string, value string")
    assert tuple(dead_letters.watermarks(rows).first()) == (20, 31, 11) and tuple(dead_letters.watermarks(rows.limit(0)).first()) == (0, 0, 0)
    assert [r["transaction_id"] for r in dead_letters.get(rows, 23).collect()] == ["t23"] and dead_letters.get(rows, 22).isEmpty()
    some = dead_letters.scan(rows, 21, 2).orderBy("offset").collect()
    assert [(r["offset"], r["next"], r["end"]) for r in some] == [(21, 24, 31), (23, 24, 31)]
    assert [r["next"] for r in dead_letters.scan(rows, 24, 9).collect()] == [31] and dead_letters.scan(rows, 31, 5).isEmpty()


def test_ids_that_a_source_can_be_asked_for(spark):
    good = ["3F2B8C1E-9D4A-1B6F-0A21-0C5D7E9F1A2B", "00000000-0000-0000-0000-000000000000"]
    ids = spark.createDataFrame([(x,) for x in (*good, "extra-1", None, good[0] + "0")], "transaction_id string")
    assert {r[0] for r in dead_letters.present(ids, ids).collect()} == set(good)


def test_contract_command(spark, tmp_path, capsys):
    old, new, bad = tmp_path / "old.avsc", tmp_path / "new.avsc", tmp_path / "bad.avsc"
    old.write_text(schema())
    new.write_text(mutated(lambda f: f.append({"name": "note", "type": "string", "default": ""})))
    bad.write_text(mutated(lambda f: f.append({"name": "note", "type": "string"})))
    registry = FolderRegistry(str(tmp_path / "registry"))
    registry.register("changes", schema())
    run = lambda *args: contract.main(list(map(str, args)), spark)
    assert run(old, new) == 0 and run(old, bad) == 1 and "note is new and has no default" in capsys.readouterr().out
    assert run(old, tmp_path / "none.avsc") == 2 and run(old) == 2 and run() == 2 and run("--registry", tmp_path / "registry", new) == 2
    from_registry = ("--registry", tmp_path / "registry", "--subject", "changes")
    assert run(*from_registry, new) == 0 and run(*from_registry, bad) == 1 and run("--registry", tmp_path / "registry", "--subject", "other", new) == 2
