"""End-to-end jobs on the smallest data set."""

import os

import pytest

from moorline.plans import jobs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_weekly_job_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "weekly")
    first = jobs.weekly(spark, SF, out, scorer="linear")
    again = jobs.weekly(spark, SF, out, scorer="linear")
    assert first == again
    approved = spark.read.parquet(f"{out}/approved_outreach").count()
    queued = spark.read.parquet(f"{out}/compliance_review_queue").count()
    assert (approved, queued) == (first["approved"], first["queued"])   # rerun appended nothing
    batch = spark.read.option("header", True).csv(f"{out}/high_risk_batch").count()
    assert approved + queued + first["errors"] == batch
    assert spark.read.parquet(f"{out}/marts/customers").count() > 0


def test_train_job_numbers_versions_and_weekly_resolves_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs.K, "PRECISION_GATE", 0.0)
    out = str(tmp_path / "train")
    with pytest.raises(LookupError):
        jobs.weekly(spark, SF, out)                      # empty registry: no silent fallback
    for expected in ("1", "2"):
        res = jobs.train(spark, SF, out, params=jobs.B.Params(trees=3, patience=3))
        assert 0.0 <= res["precision"] <= 1.0 and res["version"] == expected
        assert os.path.isdir(f"{out}/models/{expected}") and os.path.isdir(f"{out}/metrics")
    assert jobs.resolve_model(spark, out) == f"{out}/models/2"
    res = jobs.weekly(spark, SF, out)
    assert set(res) == {"approved", "queued", "errors"}
