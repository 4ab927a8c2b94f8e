"""Tasks of the archive source do not grow with the files or ranges."""

from __future__ import annotations

import zipfile

from tidemark.sources import archive_source as op


def test_small_ranges_share_tasks(tmp_path):
    for i in range(200):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w") as z:
            for j in range(5):
                z.writestr(f"{j}.txt", "x" * (1000 * j))
    reader = op.MemberReader({"path": str(tmp_path), "rangeBytes": "700", "cellBytes": "900"})
    made = reader.partitions()
    assert len(made) <= 2 * op.TASKS
    parts = [r for task in made for b in reader.read(task) for r in b.to_pylist()]
    assert {(p["archive"], p["member"]): p["length"] for p in parts} == {(f"{i}.zip", f"{j}.txt"): 1000 * j for i in range(200) for j in range(5)}
    assert len(parts) == 200 * sum(max(1, -(-1000 * j // 900)) for j in range(5))
    digests = op.DigestReader({"path": str(tmp_path)})
    assert len(digests.partitions()) <= 2 * op.TASKS and sum(len(list(digests.read(t))) for t in digests.partitions()) == 200
