"""The reports as a whole, and the hand-over from cleaned files to training data."""

import pytest
from pyspark.sql import functions as F

from roomsight import constants as K
from roomsight.plans import clean, reports, training
from roomsight.sources import files


@pytest.fixture(scope="module")
def sane(raw):
    return clean.sanitise(clean.clean(raw)).persist()


def test_quality_before_and_after(raw, sane):
    before, after = reports.quality_report(raw), reports.quality_report(sane)
    assert before["missing"].count() == 4 and after["missing"].isEmpty()
    assert before["duplicates"].first()[0] > 0 and after["duplicates"].first()[0] == 0
    assert before["activity"].count() > 3 and after["activity"].count() == 3
    assert after["bounds"].agg(F.sum("below") + F.sum("above")).first()[0] == 0


@pytest.mark.parametrize("make,sizes", [
    (reports.univariate_report, {"summary": 9, "advice": 9, "histogram": 450, "density": 1800,
                                 "counts_activity_level": 3, "counts_time_of_day": 4}),
    (reports.bivariate_report, {"boxes": 27, "violins": 600, "means": 3, "mix_time_of_day": 4}),
    (reports.correlation_report, {"matrix": 100, "lower": 45, "ranked": 9}),
    (reports.session_report, {"overview": 1, "sizes": 30})])
def test_report_sizes(sane, make, sizes):
    tables = make(sane)
    assert {name: tables[name].count() for name in sizes} == sizes


def test_means_follow_the_canonical_order(sane):
    means = reports.bivariate_report(sane)["means"]
    assert [r[0] for r in means.collect()] == K.ACTIVITY_ORDER


def test_summary_saves(spark, sane, tmp_path):
    path = str(tmp_path / "cleaned")
    found = reports.final_summary(sane, path)
    assert found["missing"].first()[0] == 0
    back = files.read_csv(spark, path, sane.schema)
    assert back.count() == sane.count() == found["schema"].first()["rows"]


def test_handover(spark, sane, tmp_path):
    path = str(tmp_path / "cleaned.parquet")
    files.write_parquet(sane, path)
    data = training.data_for_training(spark, path, split="group")
    assert data.train.join(data.test, "reading_id").isEmpty()
    both = data.train.unionByName(data.test).join(sane.select("reading_id", K.SESSION), "reading_id")
    assert both.count() == sane.count()
    sides = data.test.join(sane.select("reading_id", K.SESSION), "reading_id").select(K.SESSION)
    rest = data.train.join(sane.select("reading_id", K.SESSION), "reading_id").select(K.SESSION)
    assert sides.intersect(rest).isEmpty()
