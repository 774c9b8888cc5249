"""Exact deduplication by digest state against a plain grouping, with forced collisions and growing tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from larder.llm import exact_stream

LONG = "Long Text " * 200_000
ROWS = [(1, "Same text"), (2, "same TEXT"), (3, "other"), (4, None), (5, ""), (6, "ÄB"), (7, "äb"), (8, "Äb"), (9, LONG),
        (10, LONG.lower()), (11, "tie"), (11, "tie"), (None, "tie"), (None, "no id"), (None, "NO ID"), (12, " same text"), (13, "x\x00y"), (14, "X\x00y")]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    """Sorted rows (key, keep, size, kept): exactly one row of each group stays."""
    groups = {}
    for key, text in rows:
        groups.setdefault(lower(text), []).append(key)
    out = []
    for keys in groups.values():
        order = sorted(keys, key=lambda k: (k is not None, k or 0))
        out += [(k, order[-1], len(order), i == len(order) - 1) for i, k in enumerate(order)]
    return sorted(out, key=repr)


def write(spark, rows, path, mode="error"):
    frame = spark.createDataFrame([(k, t, "a", 1) for k, t in rows], "doc_id long, text string, digest string, file int")
    frame.repartition(3).write.mode(mode).parquet(str(path))


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "keep_id", "group_size", "kept").collect()), key=repr)


def test_against_a_plain_grouping(spark, tmp_path):
    write(spark, ROWS * 2, tmp_path / "docs")
    out = exact_stream.exact_duplicates(spark, str(tmp_path / "docs"))
    assert found(out) == brute(ROWS * 2)
    digests = {r.doc_id: bytes(r.digest) for r in out.filter("doc_id < 11").collect()}
    assert all(digests[k] == hashlib.sha256(lower(t).encode()).digest() for k, t in ROWS if k and k < 11)


def test_full_bytes_settle_colliding_digests(spark, tmp_path):
    write(spark, ROWS * 2, tmp_path / "docs")
    weak = lambda text: F.unhex(F.hex(F.length(text) % 2))
    assert found(exact_stream.exact_duplicates(spark, str(tmp_path / "docs"), digest=weak)) == brute(ROWS * 2)


def test_a_hot_group_is_cut_into_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_stream, "GROUP_SHARE", 7)
    rows = [(k, "Hot" if k % 2 else "hot") for k in range(200)] + [(k, f"text {k % 150}") for k in range(200, 400)]
    write(spark, rows, tmp_path / "docs")
    assert found(exact_stream.exact_duplicates(spark, str(tmp_path / "docs"))) == brute(rows)


def test_state_goes_on_after_files_were_added(spark, tmp_path):
    state, docs = str(tmp_path / "state"), tmp_path / "docs"
    write(spark, ROWS, docs)
    assert found(exact_stream.exact_duplicates(spark, str(docs), state)) == brute(ROWS)
    more = [(20, "SAME text"), (21, "new"), (0, "other")]
    write(spark, more, docs, "append")
    assert found(exact_stream.exact_duplicates(spark, str(docs), state)) == brute(ROWS + more)
    assert found(exact_stream.exact_duplicates(spark, str(docs), state)) == brute(ROWS + more)  # nothing new


@pytest.mark.parametrize("single", [True, False])
def test_an_empty_table_gives_no_rows(spark, tmp_path, single):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    path = str(next((tmp_path / "docs").glob("*.parquet"))) if single else str(tmp_path / "docs")
    out = exact_stream.exact_duplicates(spark, path)
    assert out.count() == 0 and out.columns == ["doc_id", "keep_id", "group_size", "kept", "digest"]


def test_the_plan_has_no_python(spark, tmp_path):
    write(spark, ROWS, tmp_path / "docs")
    plan = exact_stream.exact_duplicates(spark, str(tmp_path / "docs"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
