"""Delivery with an outbox and a ledger (K2)."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logweave.operators.documents import to_documents
from logweave.sinks.outbox import _Writer, deliver_once


def docs(spark, n, parts):
    recs = spark.range(0, n, 1, parts).select(F.lit("f").alias("file"), (F.col("id") + 1).alias("line_num"), F.col("id").cast("string").alias("v"))
    return to_documents(recs)


def client(folder, fail=""):
    """Writes each post down; refuses payloads with the document ``fail``, while the folder has no file named ``up``."""
    def post(endpoint, payload):
        import os
        import uuid

        if fail and fail in payload and not os.path.exists(f"{folder}/up"):
            return 500
        with open(f"{folder}/{endpoint}-{uuid.uuid4().hex}.json", "w") as f:
            f.write(payload)
        return 204

    return post


def posted(folder):
    return [d["id"] for name in os.listdir(folder) if name.endswith(".json") for d in json.load(open(os.path.join(folder, name)))]


def test_goes_on_after_a_failure(spark, tmp_path):
    sent, run = tmp_path / "sent", str(tmp_path / "run")
    sent.mkdir()
    made = []

    def counted(df):
        made.append(1)
        return df

    with pytest.raises(Exception, match="could not be delivered"):
        deliver_once(counted(docs(spark, 1000, 3)), ["a", "b"], client(str(sent), fail='"f:777"'), run, batch_size=50, retry_wait_s=0.0, seed=1)
    before = posted(sent)
    assert 0 < len(before) < 1000 and "f:777" not in before
    (sent / "up").write_text("")
    log = deliver_once(docs(spark, 5, 1), ["a", "b"], client(str(sent), fail='"f:777"'), run, batch_size=50, retry_wait_s=0.0, seed=1)
    assert sorted(posted(sent)) == sorted(f"f:{i}" for i in range(1, 1001))  # each once, from the outbox of the first call
    assert log.agg(F.sum("n_docs")).first()[0] == 1000 and log.count() == log.select("batch_id").distinct().count() == 21
    deliver_once(docs(spark, 5, 1), ["a"], client(str(sent)), run)
    assert len(posted(sent)) == 1000


def test_retried_task_sends_only_what_is_not_entered(tmp_path):
    import base64

    from pyspark import cloudpickle

    sent = tmp_path / "sent"
    sent.mkdir()
    seen = []

    def post(endpoint, payload):
        seen.append(payload)
        if payload == "3" and seen.count("3") == 1:
            os.remove(str(tmp_path / "nothing-here"))  # the task dies
        return 200

    rows = pa.RecordBatch.from_pylist([{"batch_id": f"0-{i}", "n_docs": 2, "payload": str(i)} for i in range(6)])
    options = {"ledger": str(tmp_path / "ledger"), "batches": 6, "docs": 12, "endpoints": '["a"]', "wait": 0, "seed": "1", "every": 1,
               "post": base64.b64encode(cloudpickle.dumps(lambda e, p: 200)).decode()}
    first, second = _Writer(options), _Writer(options)

    def dies(endpoint, payload):
        if payload == "3":
            raise KeyboardInterrupt
        return post(endpoint, payload)

    first.post, second.post = dies, lambda e, p: seen.append(p) or 200
    with pytest.raises(KeyboardInterrupt):
        first.write(iter([rows]))
    message = second.write(iter([rows]))
    assert seen == ["0", "1", "2", "3", "4", "5"] and (message.batches, message.docs) == (6, 12)
    second.commit([message])
    with pytest.raises(Exception, match="handled"):
        second.commit([message, message])


def test_nothing_to_send(spark, tmp_path):
    log = deliver_once(docs(spark, 0, 1), ["a"], client(str(tmp_path)), str(tmp_path / "run"))
    assert log.count() == 0
    with pytest.raises(ValueError):
        deliver_once(docs(spark, 1, 1), [], client(str(tmp_path)), str(tmp_path / "run2"))
