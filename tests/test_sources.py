"""Landing formats and streaming ingestion: quoting, rescue, tolerant reads, schema merge,
exactly-once, replay and the optional secondary source."""

import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F

from folio.operators import enrichment, silver
from folio.sources import files
from folio.streaming import ingest


def _tmp():
    return tempfile.mkdtemp(prefix="folio-src-")


def _write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_quoting_default_vs_doubled_quotes(spark):
    d = _tmp()
    _write_lines(d, "Books_1.csv", ['ISBN,Book-Title,Book-Author,Year-Of-Publication,Publisher,Image-URL-L',
                                    '1,"He said ""hi"", ok",A,1999,P,u'])
    default = files.read_csv_feed(spark, d, "books").collect()[0]
    assert default["_rescued_data"] is not None or default["Book-Title"] != 'He said "hi", ok'
    rfc = files.read_csv_feed(spark, d, "books", escape='"').collect()[0]
    assert rfc["Book-Title"] == 'He said "hi", ok' and rfc["_rescued_data"] is None


def test_csv_extra_field_is_rescued(spark):
    d = _tmp()
    _write_lines(d, "Ratings_1.csv", ["User-ID,ISBN,Book-Rating", "1,000000001X,5", "2,0000000022,7,extra"])
    rows = {r["User-ID"]: r for r in files.read_csv_feed(spark, d, "ratings").collect()}
    assert rows["1"]["_rescued_data"] is None
    assert rows["2"]["_rescued_data"] == "2,0000000022,7,extra"
    assert rows["2"]["Book-Rating"] == "7"


def test_json_rescue_unknown_keys_and_broken_lines(spark):
    lines = spark.createDataFrame([Row(value='{"isbn": "1", "target": "orphan", "found": false}'),
                                   Row(value='{"isbn": "2", "found": true, "extra": 1}'),
                                   Row(value='{"isbn": "3"')])
    got = {r["isbn"]: r["_rescued_data"] for r in files.parse_json_lines(lines).collect()}
    assert got["1"] is None
    assert got["2"] == '{"isbn": "2", "found": true, "extra": 1}'
    assert got[None] == '{"isbn": "3"'


def test_tolerant_reads_skip_bad_lines(spark):
    d = _tmp()
    _write_lines(d, "part-0.jsonl", ['{"isbn": "000000001X", "target": "orphan", "found": false}',
                                     '{"isbn": "0000', '{"title": "no key"}'])
    assert [r.isbn for r in files.read_json_tolerant(spark, d).where("isbn IS NOT NULL").collect()] == ["000000001X"]
    lines = spark.read.text(d)
    assert [r.isbn for r in enrichment.done_keys(lines).collect()] == ["000000001X"]


def test_stream_exactly_once_then_replay(spark):
    root = _tmp()
    landing, ckpt = os.path.join(root, "landing"), os.path.join(root, "ckpt")
    out = os.path.join(root, "bronze")
    head = "User-ID,ISBN,Book-Rating"
    _write_lines(os.path.join(landing, "ratings"), "Ratings_1.csv", [head, "1,A,1", "2,B,2"])
    first = ingest.ingest_csv(spark, landing, "ratings", ckpt, path=out, pattern="Ratings*.csv")
    _write_lines(os.path.join(landing, "ratings"), "Ratings_2.csv", [head, "3,C,3"])
    _write_lines(os.path.join(landing, "ratings"), "Other.csv", [head, "9,Z,9"])   # outside the glob
    second = ingest.ingest_csv(spark, landing, "ratings", ckpt, path=out, pattern="Ratings*.csv")
    third = ingest.ingest_csv(spark, landing, "ratings", ckpt, path=out, pattern="Ratings*.csv")
    assert (first.rows, second.rows, third.rows) == (2, 1, 0)
    table = spark.read.parquet(out)
    assert sorted(r["User-ID"] for r in table.collect()) == ["1", "2", "3"]
    assert all(r._source_file.endswith(".csv") for r in table.select("_source_file").collect())
    # Replay: a new checkpoint and a new table re-ingest everything.
    replay = ingest.ingest_csv(spark, landing, "ratings", os.path.join(root, "ckpt2"),
                               path=os.path.join(root, "bronze2"), pattern="Ratings*.csv")
    assert replay.rows == 3


def test_optional_secondary_source(spark):
    root = _tmp()
    assert ingest.ingest_json(spark, os.path.join(root, "landing"), os.path.join(root, "ckpt"),
                              path=os.path.join(root, "out")) is None
    empty = silver.silver_enrichment(None)
    assert empty.count() == 0 and "subjects" in empty.columns
    raw_books = spark.createDataFrame(
        [("1", "t", "a b", "1999", "p", "u", "f")],
        "ISBN string, `Book-Title` string, `Book-Author` string, `Year-Of-Publication` string, "
        "Publisher string, `Image-URL-L` string, _source_file string").withColumn("_ingested_at", F.current_timestamp())
    books = silver.silver_books(raw_books, None)
    assert [r.source for r in books.collect()] == ["kaggle"]


def test_bounded_batches_and_archive(spark):
    root = _tmp()
    landing = os.path.join(root, "landing")
    head = "User-ID,ISBN,Book-Rating"
    for i in range(3):
        _write_lines(os.path.join(landing, "ratings"), f"Ratings_{i}.csv", [head, f"{i},K{i},1"])
    res = ingest.ingest_csv(spark, landing, "ratings", os.path.join(root, "ckpt"), path=os.path.join(root, "out"),
                            max_files=1, archive_dir=os.path.join(root, "archive"))
    assert (res.rows, res.batches) == (3, 3)


def test_recommended_conf_bounds():
    from folio.session import recommended_conf

    small = recommended_conf(10 << 20, total_cores=8)
    big = recommended_conf(100 << 40, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert int(big["spark.sql.shuffle.partitions"]) == 32768


def test_flat_landing_globs_per_source(spark):
    root = _tmp()
    landing = os.path.join(root, "landing")
    _write_lines(landing, "Ratings.csv", ["User-ID,ISBN,Book-Rating", "1,A,1"])
    _write_lines(landing, "Ratings_2.csv", ["User-ID,ISBN,Book-Rating", "2,B,2"])
    _write_lines(landing, "Users.csv", ["User-ID,Age,Location", "1,25.0,x"])
    r = ingest.ingest_csv(spark, landing, "ratings", os.path.join(root, "ckpt"), path=os.path.join(root, "r"), flat=True)
    u = ingest.ingest_csv(spark, landing, "users", os.path.join(root, "ckpt"), path=os.path.join(root, "u"), flat=True)
    assert (r.rows, u.rows) == (2, 1)


def test_json_stream_rescues_and_reads_rounds_recursively(spark):
    root = _tmp()
    landing = os.path.join(root, "landing")
    feed = os.path.join(landing, "open_library")
    _write_lines(feed, "part-0.jsonl", ['{"isbn": "1", "target": "orphan", "found": false}',
                                        '{"isbn": "2", "target": "orphan", "found": true, "surprise": 1}'])
    _write_lines(os.path.join(feed, "round-a"), "part-0.jsonl", ['{"isbn": "3", "target": "catalog", "found": true}',
                                                               '{"isbn": "4"'])
    out = os.path.join(root, "bronze")
    res = ingest.ingest_json(spark, landing, os.path.join(root, "ckpt"), path=out, max_files=1, evolve=False)
    assert res.rows == 4 and res.batches == 2
    got = {r.isbn: r._rescued_data for r in spark.read.parquet(out).collect()}
    assert got["1"] is None and got["3"] is None
    assert '"surprise"' in got["2"] and got[None] == '{"isbn": "4"'


def test_recommended_conf_is_accepted_by_spark(spark):
    from folio.plans.model import Layers
    from folio.session import recommended_conf

    conf = recommended_conf(100 << 40, total_cores=8000)
    previous = {k: spark.conf.get(k, None) for k in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        assert Layers(spark, "/root/testdata/sf0.001").dataset("ds_kpi").count() == 1
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_csv_columns_are_taken_by_header_name(spark):
    root = _tmp()
    landing, ckpt, out = (os.path.join(root, d) for d in ("landing", "ckpt", "users"))
    _write_lines(os.path.join(landing, "users"), "a.csv", ["User-ID,Location,Age,Joined", '7,"nyc, new york, usa",25.0,2001'])
    assert ingest.ingest_csv(spark, landing, "users", ckpt, path=out).rows == 1
    row = spark.read.parquet(out).collect()[0]
    assert (row["User-ID"], row["Age"], row["Location"], row["Joined"]) == ("7", "25.0", "nyc, new york, usa", "2001")
    assert row["_rescued_data"] is None


def test_csv_missing_column_is_null_and_missing_key_fails(spark):
    d = _tmp()
    _write_lines(d, "a.csv", ["Age,User-ID", "30,1"])
    row = files.read_csv_feed(spark, d, "users").collect()[0]
    assert (row["User-ID"], row["Age"], row["Location"]) == ("1", "30", None)
    other = _tmp()
    _write_lines(other, "a.csv", ["Age,Location", "30,x"])
    with pytest.raises(ValueError, match="User-ID"):
        files.read_csv_feed(spark, other, "users")


def test_csv_file_without_a_key_column_fails_loudly(spark):
    root = _tmp()
    landing, ckpt, out = (os.path.join(root, d) for d in ("landing", "ckpt", "ratings"))
    _write_lines(os.path.join(landing, "ratings"), "a.csv", ["User-ID,ISBN,Book-Rating", "1,A,5"])
    ingest.ingest_csv(spark, landing, "ratings", ckpt, path=out)
    _write_lines(os.path.join(landing, "ratings"), "b.csv", ["ISBN,User-ID", "B,2"])
    with pytest.raises(StreamingQueryException, match="Book-Rating"):
        ingest.ingest_csv(spark, landing, "ratings", ckpt, path=out)
    assert spark.read.parquet(out).count() == 1


def test_counts_do_not_depend_on_the_progress_buffer(spark):
    root = _tmp()
    landing = os.path.join(root, "landing")
    for i in range(5):
        _write_lines(os.path.join(landing, "ratings"), f"r{i}.csv", ["User-ID,ISBN,Book-Rating", f"{i},K,1", f"{i},L,2"])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        res = ingest.ingest_csv(spark, landing, "ratings", os.path.join(root, "ckpt"), path=os.path.join(root, "out"), max_files=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (res.rows, res.batches) == (10, 5)


def test_new_checkpoint_over_an_old_sink_is_refused(spark):
    root = _tmp()
    landing, out = os.path.join(root, "landing"), os.path.join(root, "out")
    _write_lines(os.path.join(landing, "ratings"), "a.csv", ["User-ID,ISBN,Book-Rating", "1,A,1"])
    ingest.ingest_csv(spark, landing, "ratings", os.path.join(root, "c1"), path=out)
    with pytest.raises(RuntimeError, match="another checkpoint"):
        ingest.ingest_csv(spark, landing, "ratings", os.path.join(root, "c2"), path=out)


def test_json_rescue_keeps_values_that_do_not_fit(spark):
    bad = ['{"isbn": "1", "number_of_pages": "320 p."}', '{"isbn": "2", "authors": [{"name": "a", "born": 1900}]}',
           '{"isbn": "3", "authors": ["plain"]}', '{"isbn": "4", "found": "perhaps"}']
    good = ['{"isbn": "5", "authors": [{"name": "a", "key": "k"}], "subjects": ["s"], "number_of_pages": 3}',
            '{"isbn": "6", "authors": [], "title": null}']
    lines = spark.createDataFrame([Row(value=v) for v in bad + good])
    got = {r.isbn: r._rescued_data for r in files.parse_json_lines(lines).collect()}
    assert got == {**{str(i + 1): v for i, v in enumerate(bad)}, "5": None, "6": None}


def test_existence_uses_the_path_s_own_file_system(spark):
    from folio.sources import storage

    root = _tmp()
    assert storage.path_exists(spark, root) and storage.path_exists(spark, "file://" + root)
    assert not storage.path_exists(spark, os.path.join(root, "none"))
    with pytest.raises(Exception, match="nosuchscheme"):
        storage.path_exists(spark, "nosuchscheme://host/x")


def test_failed_lookups_stay_open(spark):
    requests = spark.createDataFrame([Row(isbn=k, target="orphan", batch_id=b) for k, b in
                                      (("A", 0), ("B", 0), ("C", 1), ("D", 2))])
    answers = spark.createDataFrame([Row(batch_id=0, body='{"ISBN:A": {"url": "u"}, "ISBN:B": {}}'),
                                     Row(batch_id=1, body='{"ISBN:C": {"ti')])
    answered = enrichment.answered_requests(requests, answers)
    got = {r.isbn: r.found for r in enrichment.shape_records(answered, answers).collect()}
    assert got == {"A": True, "B": False}   # C's body is broken, D's batch has no answer


def test_cli_types_parameters_as_declared():
    from folio.__main__ import _params

    assert _params("ds_top_by_genre", ["genre=1984"]) == {"genre": "1984"}
    assert _params("ds_top_by_period", ["year_min=1984"]) == {"year_min": 1984}


def test_key_format_refuses_a_trailing_newline(spark):
    from folio.functions import valid_key

    rows = spark.createDataFrame([Row(k="000000001X"), Row(k="000000001X\n")])
    assert [r.ok for r in rows.select(valid_key("k").alias("ok")).collect()] == [True, False]
