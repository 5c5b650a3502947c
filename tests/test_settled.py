"""Files that are whole (T1)."""

import os
import time

from logweave.streaming.settled import watch_settled
from logweave.streaming.watch import clean_watched


def wait_for(check, seconds=60):
    until = time.time() + seconds
    while not check() and time.time() < until:
        time.sleep(0.2)
    assert check()


def test_file_written_in_steps(spark, tmp_path):
    src, seen = tmp_path / "in", []
    (src / "sub").mkdir(parents=True)

    def handler(lines, batch_id):
        seen.extend((r.file.rsplit("/", 1)[1], r.line_num, r.line) for r in lines.collect())

    def start():
        return watch_settled(spark, str(src), handler, str(tmp_path / "check"), match=r"k \d%?\.log", settle_seconds=3.0,
                             trigger={"processingTime": "300 milliseconds"}, clean_source="delete")

    (src / "k 1.log").write_text("one\ntw")
    (src / "other.log").write_text("x\n")
    os.chmod(src / "other.log", 0)
    (src / "sub" / "k 2%.log").write_bytes("a\nb".encode())
    (src / ".k 3.log").write_text("hidden\n")
    (src / "k 4.log").write_text("")
    q = start()
    try:
        for step in ("o\nthree\n", "four\n"):
            time.sleep(1.0)
            with open(src / "k 1.log", "a") as f:
                f.write(step)
        wait_for(lambda: len(seen) == 6 and any(p["numInputRows"] for p in q.recentProgress))
    finally:
        q.stop()
    assert sorted(seen) == [("k 1.log", 1, "one"), ("k 1.log", 2, "two"), ("k 1.log", 3, "three"), ("k 1.log", 4, "four"), ("k 2%.log", 1, "a"), ("k 2%.log", 2, "b")]
    del seen[:]
    (src / "k 5.log").write_text("new\n")
    q = start()  # a restart takes only what is new
    try:
        wait_for(lambda: len(seen) == 1 and any(p["numInputRows"] for p in q.recentProgress))
        wait_for(lambda: not (src / "k 1.log").exists())
    finally:
        q.stop()
    clean_watched(spark, str(tmp_path / "check"))
    assert seen == [("k 5.log", 1, "new")]
    assert sorted(p for _, _, names in os.walk(src) for p in names) == [".k 3.log", "k 4.log", "other.log"] or (src / "k 5.log").exists()


def test_limit_and_runs_that_end(spark, tmp_path):
    src, seen = tmp_path / "in", []
    src.mkdir()
    for i in range(5):
        (src / f"{i}.log").write_text(f"{i}\n")

    def run():
        q = watch_settled(spark, str(src), lambda lines, i: seen.append(sorted(r.line for r in lines.collect())), str(tmp_path / "check"),
                          settle_seconds=0.0, max_files_per_trigger=2, trigger={"availableNow": True})
        q.awaitTermination(60)

    run()  # sees them for the first time
    assert seen == []
    for _ in range(4):
        run()
    assert seen == [["0", "1"], ["2", "3"], ["4"]]
