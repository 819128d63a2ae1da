"""Texts, CSV round trips, requests and storage rules."""

import os
import random
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from pricewise import session
from pricewise.functions.clean import fixed_text, format_reason
from pricewise.operators import guide as GD
from pricewise.operators.common import Roles
from pricewise.operators.profile import column_profile
from pricewise.operators.recommend import scenario_topn, scenarios_frame
from pricewise.sources import sinks, tables


def test_number_text_rounds_by_the_exact_value(spark):
    r = random.Random(2)
    xs = [0.125, 0.5, 1.5, 2.5, 2.675, 1.005, 12.25, -0.125, -2.5, 1e-9, 0.0, 1e15, 1e17, -0.04, None, float("nan"), 99.95]
    xs += [r.uniform(-1e4, 1e4) for _ in range(400)] + [r.randint(0, 10 ** 6) / 2 ** r.randint(0, 12) for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for p in (0, 1, 2, 3):
        for x, text in df.select("x", fixed_text("x", p)).collect():
            assert text == format(float("nan") if x is None else x, f".{p}f")


def test_reason_without_discount(spark):
    row = spark.createDataFrame([(0.5, 10.0, None, None, 8.0, 12.5)], "p double, v double, s double, d double, r double, c double")
    text = row.select(format_reason("p", "v", "s", "d", "r", "c")).first()[0]
    assert text == "PPR=0.500, value=10.00, spec=nan, RAM=8GB, camera=12MP"


def test_no_python_in_text_plans(spark):
    df = spark.range(3).select(F.col("id").cast("double").alias("x"))
    assert "Python" not in df.select(format_reason("x", "x", "x", "x", "x", "x"))._jdf.queryExecution().toString()


def test_topn_of_25(spark):
    roles = Roles(display_specs=["ram_gb"])
    cat = spark.range(200).selectExpr(
        "id as item_id", "'o' as oem", "'m' as model", "'b' as brand_group", "100.0 + id as price_eur", "50.0 as spec_score_0_100",
        "1.0 as value_score", "'t' as price_tier", "'s' as segment", "8.0 as ram_gb", "12.0 as main_camera_max_mp")
    out = scenario_topn(cat, scenarios_frame(spark, [(1, "a", 1e6, None, None, 25), (2, "b", 1e6, None, None, 3)]), roles)
    assert {r.scenario: r["count"] for r in out.groupBy("scenario").count().collect()} == {1: 25, 2: 3}


def test_csv_keeps_outer_spaces_and_line_feeds(spark):
    rows = [(1, " lead"), (2, "trail  "), (3, 'quote " and, comma'), (4, "two\nlines"), (5, " ")]
    path = tempfile.mkdtemp() + "/t"
    sinks.write_csv(spark.createDataFrame(rows, "id long, text string"), path)
    assert sorted((int(r.id), r.text) for r in tables.read_csv(spark, path).collect()) == rows


@pytest.mark.parametrize("name,encoding,text", [("cp949", "cp949", "스마트폰 가격"), ("latin", "ISO-8859-1", "café Ñandú ÿ"), ("utf", "utf-8", "스마트폰 é")])
def test_unknown_encodings(spark, name, encoding, text):
    path = os.path.join(tempfile.mkdtemp(), f"{name}.csv")
    with open(path, "wb") as f:
        f.write(f"id,text\n1,{text}\n2,plain\n".encode(encoding))
    for multi in (True, False):
        assert [r.text for r in tables.read_csv_fallback(spark, path, multi_line=multi).orderBy("id").collect()] == [text, "plain"]


def test_profile_shuffles_digests_of_long_values(spark):
    df = spark.createDataFrame([("a" * 500, "x"), ("a" * 500, "y"), ("a" * 499 + "b", None), ("=" + "a", "x")], "t string, s string")
    got = {r.column: (r.missing, r.unique) for r in column_profile(df).collect()}
    assert got == {"t": (0, 3), "s": (1, 2)}
    assert "sha2" in column_profile(df)._jdf.queryExecution().optimizedPlan().toString()


def test_request_features_of_premium_flag_and_brands(spark):
    feats = ["num__is_premium_brand", "num__has_5g", "cat__brand_group_A", "cat__brand_group_Other"]
    prefix = GD.BRAND_PREFIX
    feats = [f.replace("cat__brand_group_", prefix) for f in feats]
    req = spark.createDataFrame([(1, "A", None, None), (2, "Z", 0.0, 1.0), (3, "", None, None), (4, None, None, 0.0)],
                                "request_id long, brand string, is_premium_brand double, has_5g double")
    ref = spark.createDataFrame([("is_premium_brand", 0.0, 1.0), ("has_5g", 0.0, 1.0)], "raw_feature string, mean double, std double")
    med = spark.createDataFrame([(0.25, 0.5, 0.0, 0.0)], ", ".join(f"`{f}` double" for f in feats))
    bsum = spark.createDataFrame([("A", 1.0), ("Z", 0.75)], "brand_group string, avg_is_premium_brand double")
    out = {r.request_id: [r[f] for f in feats] for r in GD.request_features(req, ref, med, feats, [], bsum).collect()}
    assert out == {1: [1.0, 0.5, 1.0, 0.0], 2: [0.0, 1.0, 0.0, 1.0], 3: [0.25, 0.5, 0.0, 0.0], 4: [0.25, 0.0, 0.0, 0.0]}


def test_brand_notes(spark):
    req = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, ""), (5, None)], "request_id long, brand string")
    bsum = spark.createDataFrame([("A", 10.25, 3), ("C", 5.0, 1)], "brand_group string, avg_price_eur double, count long")
    adj = spark.createDataFrame([("A", -1.0)], "brand_group string, avg_adjusted_brand_premium_eur double")
    notes = {r.request_id: r.brand_premium_note for r in GD.brand_note(req, bsum, adj).collect()}
    assert notes == {1: "avg_price=10.2 EUR, count=3; adjusted_premium=-1.0 EUR", 2: "brand premium row unavailable",
                     3: "avg_price=5.0 EUR, count=1", 4: "no brand specified", 5: "no brand specified"}


def test_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_entry_from_another_folder():
    code = (f"import sys; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as E\n"
            "from pricewise.session import get_spark\ns = get_spark('local[2]', 2)\nprint('ROWS', E.entry(s).count())")
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
                         capture_output=True, text=True, timeout=300)
    assert "ROWS 5" in out.stdout, out.stderr[-2000:]


def test_optional_modules_may_be_missing():
    """Without the training-data subpackage and the pipeline the other queries stay."""
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith('pricewise.llm') or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError('gone', name=name)\n"
            "sys.meta_path.insert(0, Gone())\nimport __spark_entry__ as E\n"
            "q = E.queries(); assert 'pipeline' not in q and not [k for k in q if k.startswith('op')] and len(q) > 100 and set(E.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
