"""Erase requests arriving as files are applied batch by batch."""

import json
import os
import tempfile

from tessera.streaming import start_erase_feed
from tests.test_erase_golden import make_table


def _drop(folder, name, rows):
    with open(os.path.join(folder, name), "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def test_feed_applies_each_batch_once(spark):
    t = make_table(spark)
    inbox = tempfile.mkdtemp(prefix="tessera-inbox-")
    ckpt = tempfile.mkdtemp(prefix="tessera-feed-ckpt-")
    schema = "nin bigint, name string, dob string"
    _drop(inbox, "a.json", [{"nin": 30234324, "name": "Andy", "dob": "1960"}])
    reports = []
    q = start_erase_feed(spark, t, inbox, schema, "nin", checkpoint=ckpt, reports=reports)
    q.awaitTermination(120)
    assert spark.table(t).count() == 11
    _drop(inbox, "b.json", [{"nin": 30234323, "name": "Peter", "dob": "1950"}])
    q = start_erase_feed(spark, t, inbox, schema, "nin", checkpoint=ckpt, reports=reports,
                         swap="files")
    q.awaitTermination(120)
    assert spark.table(t).count() == 10
    assert [r.erased_rows for _, r in reports] == [1, 1]   # file a was not replayed
