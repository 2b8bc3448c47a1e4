"""Evolving append, several header layouts, schema versions with drift, one-pass JSON, counted batches."""

import json
import os
import random
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import types as T

from folio.sources import files, schemas, storage
from folio.streaming import ingest
from folio.streaming.sink import BatchSink


def _tmp():
    return tempfile.mkdtemp(prefix="folio-evo-")


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write("".join(f"{x}\n" for x in lines))


@pytest.fixture()
def place(spark):
    root = _tmp()
    db = "evo_" + os.path.basename(root).replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE {db}")
    yield os.path.join(root, "landing"), os.path.join(root, "ckpt"), db
    spark.sql(f"DROP DATABASE {db} CASCADE")


def _undo_commit(ckpt, feed, batch):
    """The state after a run that died before the stream committed ``batch``."""
    for name in (str(batch), f".{batch}.crc"):
        path = os.path.join(ckpt, feed, "commits", name)
        if os.path.exists(path):
            os.unlink(path)


# ------------------------------------------------------------ evolving append
def test_new_key_becomes_a_column_and_a_replayed_batch_adds_nothing(spark, place):
    landing, ckpt, db = place
    feed, table = os.path.join(landing, "open_library"), f"{db}.open_library"
    _write(feed, "a.jsonl", ['{"isbn": "1", "target": "orphan", "found": false}'])
    assert ingest.ingest_json(spark, landing, ckpt, table=table).rows == 1
    before = spark.table(table).columns
    _write(os.path.join(feed, "round-b"), "b.jsonl", ['{"isbn": "2", "found": true, "edition": 3, "tags": [{"k": "v"}]}', '{"isbn": "3", "broken'])
    assert ingest.ingest_json(spark, landing, ckpt, table=table).rows == 2
    after = spark.table(table)
    assert [c for c in after.columns if c not in before] == ["edition", "tags"]
    got = {r.isbn: (r.edition, r.tags, r._rescued_data) for r in after.collect()}
    assert got == {"1": (None, None, None), "2": (3, [Row(k="v")], None), None: (None, None, '{"isbn": "3", "broken')}
    for undo in (1, 1):
        _undo_commit(ckpt, "open_library", undo)
        assert ingest.ingest_json(spark, landing, ckpt, table=table).rows == 2  # counted by the run that commits it
        assert spark.table(table).count() == 3
    _write(feed, "c.jsonl", ['{"isbn": "4", "edition": 5}'])
    assert ingest.ingest_json(spark, landing, ckpt, table=table).rows == 1
    assert sorted(r.edition for r in spark.table(table).collect() if r.edition) == [3, 5]
    registry = ingest.json_registry(spark, ckpt)
    assert registry.current()[0] == 2 and registry.schema(1) == files.LOOKUP_SCHEMA


def test_evolution_of_a_path_sink(spark, place):
    landing, ckpt, _ = place
    out = os.path.join(os.path.dirname(landing), "out")
    _write(os.path.join(landing, "open_library"), "a.jsonl", ['{"isbn": "1"}'])
    ingest.ingest_json(spark, landing, ckpt, path=out)
    _write(os.path.join(landing, "open_library"), "b.jsonl", ['{"isbn": "2", "extra": 1.5}'])
    ingest.ingest_json(spark, landing, ckpt, path=out)
    sink = BatchSink(spark, os.path.join(ckpt, "open_library"), "open_library", path=out)
    assert {r.isbn: r.extra for r in sink.read().collect()} == {"1": None, "2": 1.5}


def test_reserved_and_clashing_names_stay_rescued(spark, place):
    landing, ckpt, db = place
    line = '{"isbn": "1", "ISBN": "x", "_batch": 7, "": 1, "_source_file": "f", "fine": true}'
    _write(os.path.join(landing, "open_library"), "a.jsonl", [line])
    ingest.ingest_json(spark, landing, ckpt, table=f"{db}.t")
    row = spark.table(f"{db}.t").collect()[0]
    assert (row.isbn, row.fine, row._rescued_data) == ("1", True, line)
    kinds = {r.column: r.kind for r in ingest.json_registry(spark, ckpt).drift().collect()}
    assert kinds == {"ISBN": "clash", "_batch": "clash", "": "clash", "_source_file": "clash", "fine": "added"}


@pytest.mark.parametrize("step", ["data", "entry", "partition"])
def test_a_run_that_dies_between_two_steps_is_finished_by_the_next(spark, place, step, monkeypatch):
    landing, ckpt, db = place
    table = f"{db}.ratings"
    _write(os.path.join(landing, "ratings"), "a.csv", ["User-ID,ISBN,Book-Rating", "1,A,5"])
    assert ingest.ingest_csv(spark, landing, "ratings", ckpt, table=table).rows == 1
    _write(os.path.join(landing, "ratings"), "b.csv", ["User-ID,ISBN,Book-Rating", "2,B,5", "3,C,5"])

    put = storage.put_if_absent

    def dies(s, path, text):
        if path.endswith("/batches/1.json"):
            if step == "data":
                raise OSError("lost before the entry")
            put(s, path, text)
            raise OSError("lost after the entry")
        return put(s, path, text)

    with monkeypatch.context() as patch:
        if step == "partition":
            patch.setattr(BatchSink, "_admit", lambda *a: (_ for _ in ()).throw(OSError("lost at the table")))
        else:
            patch.setattr("folio.streaming.sink.storage.put_if_absent", dies)
        with pytest.raises(Exception, match="lost"):
            ingest.ingest_csv(spark, landing, "ratings", ckpt, table=table)
    assert spark.table(table).count() == 1  # readers see whole batches only
    again = ingest.ingest_csv(spark, landing, "ratings", ckpt, table=table)
    assert (again.rows, again.batches) == (2, 1)
    assert sorted(r["User-ID"] for r in spark.table(table).collect()) == ["1", "2", "3"]
    assert ingest.ingest_csv(spark, landing, "ratings", ckpt, table=table).rows == 0


def test_counts_read_no_old_file(spark, place):
    landing, ckpt, db = place
    out = os.path.join(os.path.dirname(landing), "out")
    head = "User-ID,ISBN,Book-Rating"
    for k in range(4):
        _write(os.path.join(landing, "ratings"), f"r{k}.csv", [head] + [f"{k},K{i},1" for i in range(k + 1)])
    res = ingest.ingest_csv(spark, landing, "ratings", ckpt, path=out, max_files=2)
    assert (res.rows, res.batches) == (10, 2)
    for folder, _, names in os.walk(out):  # what was written before can't be read any more
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(folder, n), "wb") as f:
                    f.write(b"gone")
    _write(os.path.join(landing, "ratings"), "r9.csv", [head, "9,K,1"])
    assert ingest.ingest_csv(spark, landing, "ratings", ckpt, path=out).rows == 1
    ledger = BatchSink(spark, os.path.join(ckpt, "ratings"), "ratings", path=out)
    assert [ledger.entry(b)["rows"] for b in range(3)] and ledger.rows(-1, 2) == 11


# ------------------------------------------------------------ layouts
def test_files_of_several_layouts_stand_side_by_side(spark, place):
    landing, ckpt, db = place
    folder = os.path.join(landing, "users")
    _write(folder, "a.csv", ["User-ID,Age,Location", '1,20,"a, b"'])
    ingest.ingest_csv(spark, landing, "users", ckpt, table=f"{db}.users")
    _write(folder, "b.csv", ["User-ID,Location,Age,Extra", '2,"x, ""y""",30,e', "3,z,40,", "4,z,50,e,too many"])
    _write(folder, "c.csv", ["﻿Age,User-ID", "60,5"])
    _write(folder, "d[1] e.csv", ["Extra,,User-ID,Extra", "p,q,6,r"])
    _write(folder, "empty.csv", [])
    _write(folder, "head.csv", ["Location,User-ID"])
    res = ingest.ingest_csv(spark, landing, "users", ckpt, table=f"{db}.users", escape='"')
    assert (res.rows, res.batches) == (5, 1)
    got = {r["User-ID"]: (r.Age, r.Location, r._rescued_data) for r in spark.table(f"{db}.users").collect()}
    assert got == {"1": ("20", "a, b", None), "2": ("30", 'x, "y"', '{"Extra":"e"}'), "3": ("40", "z", None),
                   "4": ("50", "z", "4,z,50,e,too many"), "5": ("60", None, None), "6": (None, None, '{"Extra":"p","#1":"q","Extra#3":"r"}')}
    registry = ingest.csv_registry(spark, ckpt, "users")
    assert registry.current()[0] == 1
    assert {(r.column, r.kind) for r in registry.drift().collect()} >= {("Extra", "added")}


def test_layouts_cost_one_scan_each(spark):
    d = _tmp()
    for k in range(6):
        _write(d, f"{k}.csv", ["User-ID,Age" if k % 2 else "Age,User-ID", f"{k},{k}"])
    df = files.read_csv_files(spark, files.list_files(spark, d), "users")
    assert df.count() == 6
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def test_first_lines_through_a_codec(spark):
    import gzip

    d = _tmp()
    with gzip.open(os.path.join(d, "a.csv.gz"), "wt") as f:
        f.write("User-ID,Age\n1,2\n")
    path = os.path.join(d, "a.csv.gz")
    assert storage.first_lines(spark, [path]) == {path: "User-ID,Age"}
    assert files.read_csv_feed(spark, d, "users").collect()[0].Age == "2"


# ------------------------------------------------------------ schema versions
def test_type_change_is_reported_and_read_by_the_old_version(spark, place):
    landing, ckpt, db = place
    feed, table = os.path.join(landing, "open_library"), f"{db}.t"
    _write(feed, "a.jsonl", ['{"isbn": "1", "number_of_pages": 10}'])
    ingest.ingest_json(spark, landing, ckpt, table=table)
    changed = '{"isbn": "2", "number_of_pages": "10 p.", "authors": [{"name": "n", "born": 1900}]}'
    _write(feed, "b.jsonl", [changed, '{"isbn": "3", "number_of_pages": 12}'])
    ingest.ingest_json(spark, landing, ckpt, table=table)
    got = {r.isbn: (r.number_of_pages, r._rescued_data) for r in spark.table(table).collect()}
    assert got == {"1": (10, None), "2": (None, changed), "3": (12, None)}
    registry = ingest.json_registry(spark, ckpt)
    assert registry.current() == (1, files.LOOKUP_SCHEMA)
    drift = {r.column: (r.batch, r.kind, r.stored, r.observed, r.widened) for r in registry.drift().collect()}
    assert drift["number_of_pages"] == (1, "type", "bigint", "string", "string")
    assert drift["authors"][1] == "type" and "born" in drift["authors"][4]
    version, schema = registry.promote()
    assert version == 2 and schema["number_of_pages"].dataType == T.StringType()
    assert "born" in [f.name for f in schema["authors"].dataType.elementType.fields]
    # a replay into a new table reads everything by the promoted version
    ckpt2 = ckpt + "2"
    replay = schemas.SchemaRegistry(spark, os.path.join(ckpt2, "open_library_schema"), schema)
    replay.current()
    ingest.ingest_json(spark, landing, ckpt2, table=f"{db}.t2")
    assert {r.isbn: (r.number_of_pages, r._rescued_data) for r in spark.table(f"{db}.t2").collect()} == {"1": ("10", None), "2": ("10 p.", None), "3": ("12", None)}


def test_versions_are_written_once(spark):
    where = _tmp()
    one, two = (schemas.SchemaRegistry(spark, where, files.LOOKUP_SCHEMA) for _ in range(2))
    one.current()
    new = lambda name: T.StructType([T.StructField(name, T.LongType())])
    assert one.admit(new("a"), 1)[0] == 2 and two.admit(new("b"), 2)[0] == 3
    assert one.admit(new("a"), 3)[0] == 3 and one.admit(new("a"), 3)[2] == []
    assert [f.name for f in two.current()[1].fields][-2:] == ["a", "b"]
    path = os.path.join(where, "v000003.json")
    assert not storage.put_if_absent(spark, path, "other") and json.loads(storage.read_text(spark, path))["version"] == 3
    assert [n for n in os.listdir(where) if n.endswith(".json") and n.startswith(".v")] == []


def test_snapshot_of_the_earlier_format_is_kept(spark):
    where = _tmp()
    old = files.csv_schema("users", ["Age", "User-ID"])
    _write(where, "schema.json", [old.json()])
    assert schemas.SchemaRegistry(spark, where, files.csv_schema("users")).current() == (1, old)


_scalar = st.sampled_from([T.NullType(), T.BooleanType(), T.LongType(), T.DoubleType(), T.StringType()])
_kind = st.recursive(_scalar, lambda inner: st.one_of(
    inner.map(T.ArrayType), st.dictionaries(st.sampled_from("abc"), inner, max_size=3).map(lambda d: T.StructType([T.StructField(k, v) for k, v in sorted(d.items())]))), max_leaves=6)


def _sorted(kind):
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _sorted(f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)])
    return T.ArrayType(_sorted(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


@settings(max_examples=300, deadline=None, derandomize=True)
@given(_kind, _kind, _kind)
def test_widening_is_a_lattice(a, b, c):
    w = lambda x, y: _sorted(schemas.widen(x, y))
    assert w(a, a) == _sorted(a) and w(a, b) == w(b, a) and w(w(a, b), c) == w(a, w(b, c))
    assert schemas.holds(schemas.widen(a, b), a) and schemas.holds(schemas.widen(a, b), b) or w(a, b) != _sorted(schemas.widen(a, b))


# ------------------------------------------------------------ one-pass JSON
def _fits(value, kind):
    if value is None:
        return True
    if isinstance(kind, T.StructType):
        names = {f.name: f.dataType for f in kind.fields}
        return isinstance(value, dict) and all(k in names and _fits(v, names[k]) for k, v in value.items())
    if isinstance(kind, T.ArrayType):
        return isinstance(value, list) and all(_fits(v, kind.elementType) for v in value)
    if isinstance(kind, T.LongType):
        return isinstance(value, int) and not isinstance(value, bool)
    if isinstance(kind, T.BooleanType):
        return isinstance(value, bool)
    return isinstance(value, (str, int, bool, float))


def test_unfit_values_at_any_depth_are_found(spark):
    rng = random.Random(12)
    scalars = [None, "x", "12", 7, -3, 2.5, True, "", "OBJECT<", "isbn: STRING>"]

    def value(depth):
        if depth == 0 or rng.random() < .5:
            return rng.choice(scalars)
        if rng.random() < .5:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        return {rng.choice(["name", "key", "isbn", "a, b"]): value(depth - 1) for _ in range(rng.randrange(3))}

    good = {"isbn": ["9", 5, None], "target": ["orphan"], "found": [True, None], "title": ["t", 3], "number_of_pages": [4, None],
            "authors": [[], [{"name": "n", "key": "k"}], [{"name": None}, {}], None], "subjects": [["a", "b"], [], None], "publish_date": ["1999"]}
    docs = []
    for _ in range(800):
        doc = {k: rng.choice(v) for k, v in good.items() if rng.random() < .6}
        if rng.random() < .5:
            doc[rng.choice([*good, "more", "we ird"])] = value(2)
        docs.append(doc)
    lines = spark.createDataFrame([Row(_n=i, value=json.dumps(d)) for i, d in enumerate(docs)])
    rows = {r._n: r for r in files.parse_json_lines(lines).collect()}
    types = {f.name: f.dataType for f in files.LOOKUP_SCHEMA.fields}
    unfit = 0
    for i, doc in enumerate(docs):
        whole = _fits(doc, files.LOOKUP_SCHEMA)
        unfit += not whole
        assert rows[i]._rescued_data == (None if whole else json.dumps(doc)), doc
        for name, kind in types.items():
            want = doc.get(name)
            if want is None or not _fits(want, kind):
                assert rows[i][name] is None, (doc, name)
            elif isinstance(kind, T.StringType):
                assert rows[i][name] == (want if isinstance(want, str) else json.dumps(want))
            elif name == "authors":
                assert [None if a is None else (a.name if a.name is None else str(a.name), a.key) for a in rows[i][name]] == [
                    None if a is None else tuple(None if a.get(k) is None else a[k] if isinstance(a[k], str) else json.dumps(a[k]) for k in ("name", "key")) for a in want]
            else:
                assert rows[i][name] == ([None if x is None else x if isinstance(x, str) else json.dumps(x) for x in want] if isinstance(want, list) else want)
    assert 100 < unfit < 700


def test_each_line_is_parsed_once(spark):
    lines = spark.createDataFrame([Row(value='{"isbn": "1"}')])
    plan = files.parse_json_lines(lines)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson") + plan.count("parse_json") == 1 and "from_json" not in plan and "get_json_object" not in plan
