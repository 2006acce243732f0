"""Planned partitions over files: every byte once, rows and tasks bounded."""

import os
import random
from collections import defaultdict

import pytest

from tessera.session import new_scratch_path
from tessera.sources import packed


def _folder(spark, files):
    d = new_scratch_path(spark, "packed")
    for name, content in files.items():
        p = os.path.join(d, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(content)
    return d


def _random_text(rng, n):
    return "".join(rng.choice(["a", "b ", "\n", "\n\n", "\r\n", "é", "日本", "😀", "word"]) for _ in range(n))


@pytest.mark.parametrize("row_bytes", [4, 7, 50, 4096])
def test_rows_of_a_file_are_the_file(spark, row_bytes):
    rng = random.Random(row_bytes)
    texts = {f"f{k}.txt": _random_text(rng, n) for k, n in enumerate([0, 1, 3, 40, 500])} | {"long.txt": "日" * 300, "plain.txt": "x" * 300}
    d = _folder(spark, {k: t.encode() for k, t in texts.items()})
    rows = packed.read_text_parts(spark, d, "*.txt", row_bytes=row_bytes, task_bytes=300_000).collect()
    of = defaultdict(list)
    for r in rows:
        of[os.path.basename(r.source)].append(r)
    assert set(of) == set(texts)
    for name, parts in of.items():
        parts.sort(key=lambda r: r.part)
        assert "".join(r.text for r in parts) == texts[name]
        at = 0
        for r in parts:
            assert r.start == at and r.length == len(r.text.encode())
            at += r.length
            assert r.length <= 2 * row_bytes + 3
    assert len({r.doc_id for r in rows}) == len(rows)


def test_cuts_prefer_blank_lines_then_line_ends():
    def point(text, offset, window=100):
        b = text.encode()
        return packed.safe_point(lambda at, n: b[at:at + n], offset, len(b), window)
    assert point("ab\ncd\n\nef", 1) == 7 and point("ab\ncd\r\n\r\nef", 1) == 9
    assert point("ab\ncd\n\nef", 1, window=4) == 3
    assert point("日本", 1) == 3 and point("日本", 4) == 6 and point("abc", 2) == 2
    assert point("abc", 0) == 0 and point("abc", 3) == 3 and point("", 0) == 0


def test_small_files_share_tasks_and_large_ones_are_cut(spark):
    small = [(f"s{k:03}", 1000) for k in range(100)]
    tasks = packed.packed(packed.ranges(small, 1 << 20), 10 * (1000 + packed.OPEN_BYTES))
    assert len(tasks) == 10 and sum(len(t.ranges) for t in tasks) == 100
    units = list(packed.ranges([("big", (5 << 20) + 1)], 1 << 20))
    assert [(u.lo, u.hi) for u in units] == [(k << 20, min((k + 1) << 20, (5 << 20) + 1)) for k in range(6)]
    assert len(packed.packed(iter(units), 1)) == 6 and packed.packed(iter([]), 1) == []
    d = _folder(spark, {f"s{k:03}.txt": b"x" * 10 for k in range(40)})
    df = packed.read_text_parts(spark, d, task_bytes=10 * (10 + packed.OPEN_BYTES))
    assert df.rdd.getNumPartitions() == 4 and df.count() == 40


def test_binary_files_names_and_folders(spark):
    raw = bytes(range(256)) * 3
    d = _folder(spark, {"x.jpg": raw, "empty.jpg": b"", "y.png": b"no", "sub/z.jpg": b"deep", "_hidden.jpg": b"h", ".h.jpg": b"h", "_tmp/q.jpg": b"h"})
    top = {os.path.basename(r.path): r for r in packed.read_packed_binary(spark, d, "*.jpg").collect()}
    assert set(top) == {"x.jpg", "empty.jpg"} and bytes(top["x.jpg"].content) == raw and top["empty.jpg"].length == 0
    import base64
    assert top["x.jpg"].b64 == base64.b64encode(raw).decode()
    deep = packed.read_packed_binary(spark, "file://" + d, "*.jpg", recursive=True).collect()
    assert {os.path.basename(r.path) for r in deep} == {"x.jpg", "empty.jpg", "z.jpg"}
    assert packed.read_packed_binary(spark, d, "*.gif").count() == 0 == packed.read_text_parts(spark, d, "*.gif").count()


def test_bytes_that_are_no_text(spark):
    d = _folder(spark, {"bad.txt": b"ok \xff\xfe end" + b"\x80" * 20})
    rows = sorted(packed.read_text_parts(spark, d, row_bytes=8).collect(), key=lambda r: r.start)
    assert sum(r.length for r in rows) == 29 and "�" in rows[0].text


def test_wrong_options_are_errors(spark):
    with pytest.raises(Exception, match="row_bytes"):
        packed.read_text_parts(spark, _folder(spark, {"a.txt": b"a"}), row_bytes=1).collect()
    with pytest.raises(Exception, match="kind"):
        spark.read.format(packed.FORMAT).option("kind", "table").load("/tmp").collect()
