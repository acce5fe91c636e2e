"""The split reader against Python's own JSON reader."""

from __future__ import annotations

import json
import random

import pytest

from pyspark.sql import functions as F

from tallylake.functions.cells import type_cells
from tallylake.sources import json_documents as jd
from tallylake.sources.paths import file_stamps
from tallylake.sources.staging import Staging

TRICKY = ["]", "[", "],[", "]]", '"', "\\", "\\\\", '\\"', ",", "{", "}", "é", "\n", "x", " ", ":"]


def random_text(rng: random.Random) -> str:
    return "".join(rng.choice(TRICKY) for _ in range(rng.randrange(8)))


def random_value(rng: random.Random, depth: int):
    kind = rng.randrange(9 if depth else 6)
    if kind < 2:
        return rng.randrange(1000)
    if kind < 4:
        return random_text(rng)
    if kind == 4:
        return None
    if kind == 5:
        return rng.random() < 0.5
    if kind < 8:
        return [random_value(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {random_text(rng): random_value(rng, depth - 1) for _ in range(rng.randrange(3))}


def random_document(rng: random.Random) -> str:
    style = rng.randrange(4)
    rows = []
    for i in range(rng.randrange(40)):
        plain = [i, str(i), 3, f"user{i}", 4, "USD", 1.5, 1746057600000 + i]
        if style == 1 and rng.random() < 0.3:
            plain[3] = random_text(rng)
        if style == 2 and rng.random() < 0.3:
            plain[rng.randrange(8)] = random_value(rng, 2)
        if style == 3:
            plain = random_value(rng, 3)
        rows.append(plain)
    separators = rng.choice([(",", ":"), (", ", ": "), (" ,\n", " : ")])
    ascii_only = rng.random() < 0.5
    text = json.dumps(rows, separators=separators, ensure_ascii=ascii_only)
    return rng.choice(["", " ", "\n"]) + text + rng.choice(["", "\n", " \n "])


def damage(rng: random.Random, text: str) -> str:
    """One small edit that usually breaks a document."""
    at = rng.randrange(len(text) + 1)
    how = rng.randrange(4)
    if how == 0:
        return text[:at]
    if how == 1:
        return text[:at] + text[at + 1 :]
    if how == 2:
        return text[:at] + rng.choice('[]{}",\\ 1x') + text[at:]
    return text + rng.choice(["]", "[3]", "x", ",", "[[1]]", "{}", '"'])


def no_constants(_):
    raise ValueError


def expected(text: str):
    """(status, cells per element); cells is None for an element that is no array."""
    body = text.strip(" \t\r\n")
    if not body.startswith("["):
        return "ROOT_NOT_ARRAY", []
    try:
        rows = json.loads(text)
    except ValueError:
        return "BAD_JSON", []
    return "LOADED", [row if isinstance(row, list) else None for row in rows]


def same_cell(cell: str | None, value) -> bool:
    if value is None or cell is None:
        return value is cell
    if isinstance(value, str):
        return cell == value
    if isinstance(value, (list, dict)):
        return json.loads(cell) == value
    if isinstance(value, bool):
        return cell == str(value).lower()
    return float(cell) == value


@pytest.mark.parametrize("split_bytes, count", [(64, 12), (300, 40), (1 << 27, 240)])
def test_random_documents(spark, tmp_path, split_bytes, count):
    rng = random.Random(split_bytes)
    documents = {}
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(count):
        text = random_document(rng)
        if i % 2:
            text = damage(rng, text)
        if not text.strip(" \t\r\n"):
            continue
        documents[f"f{i}.json"] = text
        (folder / f"f{i}.json").write_text(text, encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        pieces = jd.read_pieces(spark, jd.file_pattern(str(folder)))
        staging = Staging(spark, str(tmp_path / "staging"))
        parsed = jd.parse_documents(pieces, str(folder), staging, lambda r: r.drop("raw"))
        status = {r.file: r.status for r in parsed.files.collect()}
        found = {name: {} for name in documents}
        for r in parsed.rows.collect():
            assert r.pos not in found[r.file], (r.file, r.pos)
            found[r.file][r.pos] = r.cells
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

    assert set(status) == set(documents)
    kinds = set()
    for name, text in documents.items():
        want, rows = expected(text)
        kinds.add(want)
        assert status[name] == want, (name, text)
        assert sorted(found[name]) == list(range(len(rows))), (name, text)
        for pos, row in enumerate(rows):
            cells = found[name][pos]
            if row is None:
                assert cells is None, (name, pos, text)
            else:
                assert cells is not None and len(cells) == len(row), (name, pos, text)
                assert all(map(same_cell, cells, row)), (name, pos, text, cells, row)
    assert {"LOADED", "BAD_JSON"} <= kinds


def test_odd_file_names(spark, tmp_path):
    """Names with blanks, percent signs and glob characters, in a folder like that."""
    folder = tmp_path / "in {a,b} [1] %20"
    folder.mkdir()
    for name in ("a b", "100%", "%41", "x[1]", "{y,z}", "é", "q'1", "1+1 %2B"):
        (folder / f"{name}.json").write_text('[[1,"]"]]')
        (folder / f"{name} flat.json").write_text("[[1,2]]")
    rows = jd.read_json_rows(spark, str(folder)).collect()
    assert {r.file for r in rows} == {p.name for p in folder.iterdir()}
    assert len(rows) == 16


def test_a_large_element_is_rejected_alone(spark, tmp_path, monkeypatch):
    """Whether or not a bracket in it sends its file the longer way."""
    folder = tmp_path / "in"
    folder.mkdir()
    row = '[1,2,3,"{}",4,"USD",1,5]'
    for name, inner in (("brackets", "x],"), ("plain", "xx,")):
        rows = [row.format(inner * n) for n in (1, 400, 2)]
        (folder / f"{name}.json").write_text(f"[{','.join(rows)}, {{}}]")
    (folder / "uncut.json").write_text('[["' + "x" * 2000 + '"]]')
    monkeypatch.setattr(jd, "FLAT_PIECE_BYTES", 400)
    monkeypatch.setattr(jd, "MAX_TEXT_BYTES", 1000)
    pieces = jd.read_pieces(spark, jd.file_pattern(str(folder)))
    staging = Staging(spark, str(tmp_path / "staging"))
    listed = spark.createDataFrame(file_stamps(spark, f"{folder}/*"), jd.STAMPS)
    parsed = jd.parse_documents(pieces, str(folder), staging, type_cells, listed)
    status = {r.file: (r.status, r.rows_ok, r.rows_rejected) for r in parsed.files.collect()}
    assert status == {
        "brackets.json": (jd.LOADED, 2, 2),
        "plain.json": (jd.LOADED, 2, 2),
        "uncut.json": (jd.ELEMENT_TOO_LARGE, 0, 0),
    }
    for name, inner in (("brackets.json", "x],"), ("plain.json", "xx,")):
        rows = sorted(parsed.rows.where(F.col("file") == name).collect(), key=lambda r: r.pos)
        assert [r.reason for r in rows] == [None, jd.ELEMENT_TOO_LARGE, None, "BAD_SHAPE"]
        assert [rows[i].username for i in (0, 2)] == [inner, inner * 2]


def test_objects_are_parsed_in_many_tasks(spark, tmp_path):
    """A document without an inner bracket is cut like any other."""
    folder = tmp_path / "in"
    folder.mkdir()
    items = [{"id": i, "note": "x" * 40} for i in range(40_000)]
    (folder / "one.json").write_text(json.dumps(items))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        staging = Staging(spark, str(tmp_path / "staging"))
        rows = jd.read_json_rows(spark, str(folder), staging)
        assert rows.selectExpr("count(*)", "min(pos)", "max(pos)", "count(cells)").first()[:] == (
            40_000, 0, 39_999, 0
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    trace = spark.read.parquet(f"{staging.folder}/trace").where("whole")
    per_task = trace.groupBy(F.input_file_name()).count().collect()
    assert len(per_task) > 8 and max(r["count"] for r in per_task) < 8_000


def test_an_element_longer_than_many_batches(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    long = ["]" + "y" * 60] * 60_000
    rows = [[1, "a"], long, [2, "b"], {"k": long}, [3, "c"]]
    (folder / "one.json").write_text(json.dumps(rows))
    for batch in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            found = jd.read_json_rows(spark, str(folder)).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        cells = {r.pos: r.cells for r in found}
        assert sorted(cells) == [0, 1, 2, 3, 4]
        assert cells[1] == long and cells[3] is None and cells[4] == ["3", "c"]


def test_rows_of_one_file_are_parsed_in_many_tasks(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.json").write_text(json.dumps([[i, "x" * 50] for i in range(20_000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        pieces = jd.read_pieces(spark, jd.file_pattern(str(folder)))
        assert pieces.rdd.getNumPartitions() > 8
        rows = jd.read_json_rows(spark, str(folder))
        assert rows.selectExpr("count(*)", "min(pos)", "max(pos)").first()[:] == (20_000, 0, 19_999)
        assert rows.where("cells[0] <> cast(pos AS string)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
