"""Every registered query against its SQL twin, on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools import check
from vacancia.catalog import fixtures, models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def db():
    connection = duckdb.connect()
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and abs(sum(r.demand_percent for r in rows) - 100) < 0.1


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    verdict = check.compare(df.columns, rows, columns, cursor.fetchall())
    assert verdict == "ok"


def test_approximate_search_finds_most_of_the_exact(spark):
    exact, approx = (
        {(r.query_id, r.doc_id) for r in entry.queries()[q](spark, SF).collect()}
        for q in ("vec_topk", "vec_topk_approx"))
    assert len(exact & approx) / len(exact) > 0.7


def test_classifier_metrics_in_range(spark):
    rows = entry.queries()["cls_nb"](spark, SF).collect()
    assert len(rows) > 1 and all(r.n for r in rows) and all(0.95 <= r.weighted_f1 <= 1 for r in rows)


def test_predictions_cover_every_profile(spark):
    predicted = entry.queries()["cls_predict"](spark, SF)
    assert predicted.filter("predicted_role IS NULL").count() == 0


def test_advice_is_for_every_hundredth_profile(spark):
    asked = {r.profile_id for r in fixtures.profiles(spark, SF).collect() if r.profile_id % 100 == 0}
    rows = entry.queries()["adv_batch"](spark, SF).collect()
    assert asked and {r.profile_id for r in rows} == asked and len(rows) == len(asked)
    assert all(r.role and r.recommended for r in rows)


def test_registered_families_run_the_library_defaults(monkeypatch):
    given = {}

    def train(*columns, **settings):
        given.update(settings)
        raise InterruptedError

    monkeypatch.setattr(models, "training_rows", lambda spark, sf: None)
    monkeypatch.setattr(models, "materialize", lambda rows, name: rows)
    monkeypatch.setattr(models.plan, "train", train)
    with pytest.raises(InterruptedError):
        models._prepared.__wrapped__("app", None, SF)
    assert given == {}
