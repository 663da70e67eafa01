import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException

from starweave.plans.etl import load_warehouse
from starweave.streaming.arrival import reload_on_arrival


def test_reload_on_arrival_runs_load_once_per_arrival(spark, retail):
    root = tempfile.mkdtemp(prefix="sw-arrival-")
    landing = os.path.join(root, "landing")
    retail["sales_transaction_details"].write.parquet(os.path.join(landing, "day1"))
    loads = []

    def load(new_rows, batch_id):
        star, statuses, counts = load_warehouse(spark, retail, os.path.join(root, f"wh-{batch_id}"))
        loads.append((new_rows.count(), counts["fact_sales"], all(s.ok for s in statuses)))

    ckpt = os.path.join(root, "ckpt")
    assert reload_on_arrival(spark, landing, load, ckpt) == 1
    assert loads == [(11, 10, True)]   # the calendar covers every sale
    # nothing new: no load
    assert reload_on_arrival(spark, landing, load, ckpt) == 0


def test_a_replayed_batch_is_not_loaded_twice(spark, retail):
    """A run that ends after the load but before the checkpoint has the batch
    is started again with the same batch; a load that failed is repeated."""
    root = tempfile.mkdtemp(prefix="sw-replay-")
    landing, ckpt = os.path.join(root, "landing"), os.path.join(root, "ckpt")
    retail["sales_transaction_details"].write.parquet(os.path.join(landing, "day1"))
    loads, fail = [], [True]

    def load(new_rows, batch_id):
        if fail.pop() if fail else False:
            raise RuntimeError("half-way")
        loads.append((batch_id, new_rows.count()))

    with pytest.raises(StreamingQueryException):
        reload_on_arrival(spark, landing, load, ckpt)
    assert loads == [] and reload_on_arrival(spark, landing, load, ckpt) == 1
    assert loads == [(0, 11)]
    for name in ("0", ".0.crc"):     # the checkpoint never heard of the end of batch 0
        os.remove(os.path.join(ckpt, "commits", name))
    assert reload_on_arrival(spark, landing, load, ckpt) == 0
    assert loads == [(0, 11)]
    retail["sales_transaction_details"].limit(3).write.parquet(os.path.join(landing, "day2"))
    assert reload_on_arrival(spark, landing, load, ckpt) == 1
    assert loads == [(0, 11), (1, 3)]
