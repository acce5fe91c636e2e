"""Loading: reject reasons, exactly-once, what counts as new."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException

from tallylake.sources import tables
from tallylake.streaming import ingest
from tallylake.streaming.ingest import ingest_new

GOOD = '[{id},2,3,"u{id}",4,"USD",1.10,1746057600123]'


def document(*ids: int) -> str:
    return "[" + ",".join(GOOD.format(id=i) for i in ids) + "]"


def put(folder, **files: str) -> None:
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.json").write_text(text, encoding="utf-8")


def ids(spark, lake) -> list[int]:
    rows = tables.read_table(spark, tables.transactions(lake)).collect()
    return sorted(int(r.transaction_id) for r in rows)


def rejects(spark, lake) -> set[tuple]:
    rows = tables.read_table(spark, tables.rejects(lake)).collect()
    return {(r.file.removesuffix(".json"), r.pos, r.reason) for r in rows}


def test_bad_input(spark, tmp_path, lake):
    folder = tmp_path / "in"
    row = '[1,2,3,"u",4,"USD",1,5]'
    put(
        folder,
        root_object='{"not":"array"}',
        broken="[[1,2",
        empty="[]",
        shapes='[[1,2],{"x":1},null,[1,2,3,"u",4,"USD",1,5,9]]',
        cells='[[1,2,"x","u",4,"USD",1,5],[1,2,3,null,4,"USD",1,5],'
        '[1,2,3,"u",4.9,"USD",1,5],[1,2,3,"u",4,"USD",1,null]]',
        tail=f"[{row}] tail",
        tail_array=f"[{row}][3]",
        range='[[1,2,4294967296,"u",4,"USD",1,5],[1,2,-1,"u",4,"USD",1,5],'
        '[18446744073709551615,2,3,"u",4,"USD",1,5],[99999999999999999999999,2,3,"u",4,"USD",1,5]]',
        rounding='[[1,2,3,"u",4,"USD","12.345",5],[2,2,3,"u",4,"USD",0.29,5],'
        '[3,2,3,"u",4,"USD","1e2","1746057600456"]]',
        times='[[1,2,3,"u",4,"USD",1,9223372036854775807],[1,2,3,"u",4,"USD",1,"1.5"]]',
    )
    (folder / "other.txt").write_text(document(1))
    (folder / "below").mkdir()
    put(folder / "below", deep=document(1))
    put(folder / "k=1", partition=document(1))

    summary = ingest_new(spark, str(folder), lake, version=7)

    assert rejects(spark, lake) == {
        ("root_object", None, "ROOT_NOT_ARRAY"),
        ("broken", None, "BAD_JSON"),
        ("tail", None, "BAD_JSON"),
        ("tail_array", None, "BAD_JSON"),
        *[("shapes", i, "BAD_SHAPE") for i in range(4)],
        ("cells", 0, "BAD_CELL:site_id"),
        ("cells", 1, "BAD_CELL:username"),
        ("cells", 2, "BAD_CELL:item_id"),
        ("cells", 3, "BAD_CELL:transaction_time"),
        ("range", 0, "OUT_OF_RANGE"),
        ("range", 1, "OUT_OF_RANGE"),
        ("range", 3, "OUT_OF_RANGE"),
        ("times", 0, "BAD_CELL:transaction_time"),
        ("times", 1, "BAD_CELL:transaction_time"),
    }
    facts = tables.read_table(spark, tables.transactions(lake))
    stored = {(r.source_file, r.source_pos): r for r in facts.collect()}
    assert {k: r.transfer_amount for k, r in stored.items()} == {
        ("range.json", 2): Decimal("1.00"),
        ("rounding.json", 0): Decimal("12.35"),
        ("rounding.json", 1): Decimal("0.29"),
        ("rounding.json", 2): Decimal("100.00"),
    }
    assert stored["range.json", 2].transaction_id == 2**64 - 1
    assert {r._version for r in stored.values()} == {7}
    assert {r.yyyymm for r in stored.values()} == {197001, 202505}
    millis = facts.selectExpr("source_pos", "unix_millis(transaction_time) AS ms", "source_file")
    assert {r.ms for r in millis.collect() if r.source_file == "rounding.json"} == {5, 1746057600456}

    audit = {r.file: r for r in tables.read_table(spark, tables.ingest_audit(lake)).collect()}
    assert len(audit) == summary.files == 10
    assert (audit["empty.json"].status, audit["empty.json"].rows_ok) == ("LOADED", 0)
    assert (audit["range.json"].rows_ok, audit["range.json"].rows_rejected) == (1, 3)
    assert (summary.rows_ok, summary.rows_rejected) == (4, 13)


def test_null_as_text(spark, tmp_path, lake):
    put(tmp_path / "in", a='[[1,2,3,null,4,null,1,5]]')
    ingest_new(spark, str(tmp_path / "in"), lake, null_as_text=True)
    row = tables.read_table(spark, tables.transactions(lake)).first()
    assert (row.username, row.currency_code) == ("None", "None")


def test_only_new_names(spark, tmp_path, lake):
    folder = tmp_path / "in"
    put(folder, a=document(1, 2))
    assert ingest_new(spark, str(folder), lake).rows_ok == 2
    put(folder, a=document(8, 9), b=document(3))
    assert ingest_new(spark, str(folder), lake).rows_ok == 1
    assert ingest_new(spark, str(folder), lake).batches == 0
    assert ids(spark, lake) == [1, 2, 3]


def test_old_files_are_not_too_old(spark, tmp_path, lake):
    import os

    folder = tmp_path / "in"
    put(folder, a=document(1))
    ingest_new(spark, str(folder), lake)
    put(folder, b=document(2))
    long_ago = dt.datetime(2001, 1, 1).timestamp()
    os.utime(folder / "b.json", (long_ago, long_ago))
    ingest_new(spark, str(folder), lake)
    assert ids(spark, lake) == [1, 2]


def test_no_files(spark, tmp_path, lake):
    (tmp_path / "in").mkdir()
    assert ingest_new(spark, str(tmp_path / "in"), lake).rows_ok == 0
    assert ids(spark, lake) == []


@pytest.mark.parametrize("after_write", [False, True])
def test_crash_and_retry(spark, tmp_path, lake, monkeypatch, after_write):
    """Failing before or after the facts are written loads every row and reject once."""
    folder = tmp_path / "in"
    put(folder, a=document(1, 2), bad="[[1]]")
    write = tables.write_transactions

    def fail(*args):
        if after_write:
            write(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest.tables, "write_transactions", fail)
        with pytest.raises(StreamingQueryException):
            ingest_new(spark, str(folder), lake)
    put(folder, c=document(3))
    for _ in range(2):
        ingest_new(spark, str(folder), lake)
    assert ids(spark, lake) == [1, 2, 3]
    assert rejects(spark, lake) == {("bad", 0, "BAD_SHAPE")}
    assert tables.read_table(spark, tables.rejects(lake)).count() == 1


def test_several_batches(spark, tmp_path, lake):
    folder = tmp_path / "in"
    put(folder, a=document(1), b=document(2), c=document(3))
    summary = ingest_new(spark, str(folder), lake, max_bytes_per_batch="1")
    assert (summary.batches, summary.rows_ok) == (3, 3)
    assert ids(spark, lake) == [1, 2, 3]


def test_new_checkpoint_over_old_table(spark, tmp_path, lake):
    put(tmp_path / "in", a=document(1))
    ingest_new(spark, str(tmp_path / "in"), lake)
    put(tmp_path / "in2", b=document(2))
    with pytest.raises(StreamingQueryException, match="loaded from other files"):
        ingest_new(spark, str(tmp_path / "in2"), lake, checkpoint=str(tmp_path / "ck"))
    assert ids(spark, lake) == [1]


def test_rejects_of_a_failed_load_are_not_shown(spark, tmp_path, lake, monkeypatch):
    folder = tmp_path / "in"
    put(folder, a="[[1,2]," + GOOD.format(id=1) + "]")

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_transactions", fail)
        with pytest.raises(StreamingQueryException):
            ingest_new(spark, str(folder), lake)
    assert tables.rejected(spark, lake).isEmpty() and tables.audited_files(spark, lake).isEmpty()
    ingest_new(spark, str(folder), lake)
    assert tables.rejected(spark, lake).count() == tables.audited_files(spark, lake).count() == 1


def test_a_mended_file_is_loaded_once(spark, tmp_path, lake):
    folder = tmp_path / "in"
    put(folder, a=document(1), b=document(2, 3)[:-4], c='{"no": "array"}')
    assert ingest_new(spark, str(folder), lake).rows_ok == 1
    # Unchanged: not read again.
    assert ingest_new(spark, str(folder), lake).batches == 0
    put(folder, b=document(2, 3), c='{"still": "no array"}', d=document(4))
    assert ingest_new(spark, str(folder), lake).rows_ok == 3
    assert ingest_new(spark, str(folder), lake).batches == 0
    assert ids(spark, lake) == [1, 2, 3, 4]
    last = {r.file: r.status for r in tables.latest_audit(spark, lake).collect()}
    assert last == {f"{n}.json": "LOADED" for n in "abd"} | {"c.json": "ROOT_NOT_ARRAY"}


def test_empty_and_hidden_files_are_noted(spark, tmp_path, lake):
    folder = tmp_path / "in"
    put(folder, _hidden=document(8), empty="")
    (folder / ".dot.json").write_text(document(9))
    summary = ingest_new(spark, str(folder), lake)
    assert (summary.files, summary.rows_ok) == (3, 0)
    assert rejects(spark, lake) == {
        ("_hidden", None, "HIDDEN_NAME"),
        (".dot", None, "HIDDEN_NAME"),
        ("empty", None, "EMPTY_FILE"),
    }
    put(folder, empty=document(1))
    for _ in range(2):
        ingest_new(spark, str(folder), lake)
    put(folder, next=document(2))
    ingest_new(spark, str(folder), lake)
    assert ids(spark, lake) == [1, 2]


@pytest.mark.parametrize("after_write", [False, True])
def test_crash_while_loading_a_mended_file(spark, tmp_path, lake, monkeypatch, after_write):
    folder = tmp_path / "in"
    put(folder, a=document(1), b="[[1")
    ingest_new(spark, str(folder), lake)
    put(folder, b="[[1,2]," + document(2)[1:])
    write = tables.write_transactions

    def fail(*args):
        if after_write:
            write(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest.tables, "write_transactions", fail)
        with pytest.raises(RuntimeError):
            ingest_new(spark, str(folder), lake)
    # A batch of the stream takes a later number than the failed commit had.
    put(folder, c=document(3))
    for _ in range(2):
        ingest_new(spark, str(folder), lake)
    assert ids(spark, lake) == [1, 2, 3]
    found = tables.rejected(spark, lake).where("reason = 'BAD_SHAPE'").count()
    assert found == 1


def test_a_file_of_one_long_piece(spark, tmp_path, lake):
    """An array of objects has no inner bracket; its places are those of its objects."""
    folder = tmp_path / "in"
    put(folder, objects='[{"a":"' + "x" * (1 << 20) + '"},{"b":1}]', good=document(1))
    summary = ingest_new(spark, str(folder), lake)
    assert (summary.files, summary.rows_ok, summary.rows_rejected) == (2, 1, 2)
    assert rejects(spark, lake) == {("objects", i, "BAD_SHAPE") for i in range(2)}
    assert ingest_new(spark, str(folder), lake).batches == 0


def test_mended_files_are_loaded_by_bytes(spark, tmp_path, lake):
    """What the stream has passed over is split like what it loads."""
    folder = tmp_path / "in"
    names = [f"f{i}" for i in range(6)]
    put(folder, first=document(100), **{name: "[[1,2" for name in names})
    ingest_new(spark, str(folder), lake)
    put(folder, **{name: document(i, 10 + i) for i, name in enumerate(names)})
    size = len(document(0, 10))
    summary = ingest_new(spark, str(folder), lake, max_bytes_per_batch=str(2 * size + 5))
    assert summary.batches == 3 and summary.files == 6 and summary.rows_ok == 12
    assert ids(spark, lake) == sorted([*range(6), *range(10, 16), 100])
    assert ingest_new(spark, str(folder), lake).batches == 0


def test_files_in_groups_of_bytes():
    sized = [("a", 3), ("b", 3), ("c", 9), ("d", 1), ("e", 2), ("f", 0)]
    assert ingest._by_bytes(sized, 6) == [["a", "b"], ["c"], ["d", "e", "f"]]
    assert ingest._by_bytes(sized, None) == [["a", "b", "c", "d", "e", "f"]]
    assert ingest._by_bytes([], 6) == []
