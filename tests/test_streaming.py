"""Requests served from a stream give the same answers as the batch job."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewise.operators.common import CATALOG_ROLES as R
from pricewise.operators.recommend import scenario_topn, scenarios_frame
from pricewise.plans import value_plan as vp
from pricewise.streaming.requests import scenario_stream, serve_recommendations


def test_stream_matches_batch(spark):
    vf = vp.value_frame(spark, SF_SMALL, "part")
    root = tempfile.mkdtemp(prefix="pw-stream-")
    inbox, out, ckpt = (os.path.join(root, d) for d in ("in", "out", "ckpt"))
    os.makedirs(inbox)
    rows = [*vp.PART_SCENARIOS, (9, "long_list", 1e9, None, None, 25)]
    reqs = [{"scenario": r[0], "scenario_label": r[1], "budget_eur": r[2], "segment": r[3], "brand": None, "top_n": r[5] if len(r) > 5 else 10}
            for r in rows]
    with open(os.path.join(inbox, "batch1.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in reqs))
    q = serve_recommendations(scenario_stream(spark, inbox), vf, out, ckpt, R, trigger_once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(out).drop("epoch")
    exp = scenario_topn(vf, scenarios_frame(spark, rows), R)
    cols = ["scenario", "recommendation_rank", "item_id", "recommendation_reason"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in exp.select(*cols).collect())
    assert a == b and sum(r[0] == 9 for r in a) == 25
