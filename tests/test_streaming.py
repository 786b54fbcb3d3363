import time

from shiplog.session import scratch_path
from shiplog.sources import ledger_store
from shiplog.streaming.ledger_feed import start_ledger_feed


def test_feed_merges_and_is_idempotent(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("app1\trel/20240101-1000/1;t1.sql\napp1\trel/20240101-1000/2;t1.sql\n")
    root = scratch_path(spark, "ledger")
    q = start_ledger_feed(spark, str(src), root, str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
        (src / "b.txt").write_text("app1\trel/20240101-1000/1;t1.sql\napp1\trel/20240102-1000/1;t2.sql\n")
        time.sleep(1)
        q.processAllAvailable()
    finally:
        q.stop()
    scripts = ledger_store.read_ledger(spark, root)["scripts"]
    assert sorted(r["id_script"] for r in scripts.collect()) == [1, 2, 3]
