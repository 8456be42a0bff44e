"""Training of all approaches."""

import threading

from conftest import rows

from panelweave.models.fit import TREE_GRID
from panelweave.plans import training
from queries import panels as panel_queries


def test_models_are_trained_side_by_side(spark, monkeypatch):
    """Tabular and sequence models of both panels run at the same time."""
    together = threading.Barrier(4, timeout=20)

    def fitted(approach, panel, base, kinds=training.KINDS, **settings):
        together.wait()
        return [(approach.name, kind, 1.0, str(settings)) for kind in kinds]

    monkeypatch.setattr(training, "train_approach", fitted)
    panels = {"individual": spark.range(1), "systematic": spark.range(1)}
    got = rows(training.train_all(panels, "unused", patience=2), "approach", "kind", "params")
    assert got == sorted((a, k, "{'patience': 2}") for a in panels for k in training.KINDS)


def test_training_reads_no_more_of_the_individual_panel_than_it_uses(spark):
    approach = training.APPROACHES["individual"]
    columns = training.training_columns(approach, None)
    assert {*approach.columns, *approach.numeric, training.TARGET} == set(columns)
    empty = spark.createDataFrame([], "a int, b int")
    assert training.training_columns(training.APPROACHES["systematic"], empty) == ["a", "b"]


def test_the_query_searches_every_setting_on_every_played_week(spark, monkeypatch):
    """No fewer settings, trees, rounds of patience or rows than the library's own defaults."""
    asked = []

    def fitted(approach, panel, base, **settings):
        asked.append((approach.name, settings))
        return [(approach.name, kind, 1.0, "") for kind in settings["kinds"]]

    monkeypatch.setattr(training, "train_approach", fitted)
    monkeypatch.setattr(panel_queries.league, "tables", lambda *_: None)
    panel = spark.createDataFrame([], ", ".join(f"{c} string" for c in training.training_columns(training.APPROACHES["individual"], None)))
    monkeypatch.setattr(panel_queries.individual, "individual_panel", lambda _: panel)
    monkeypatch.setattr(panel_queries.systematic, "systematic_panel", lambda _: panel)
    panel_queries.trained(spark, "unused", "unused")
    assert sorted(name for name, _ in asked) == ["individual"] * 2 + ["systematic"] * 2
    assert TREE_GRID["n_estimators"] == [100, 500] and len(training.models.expand_grid(TREE_GRID)) == 16
    for _, settings in asked:
        # min_streak=0 keeps every played week; all else is left to the defaults
        assert {k: v for k, v in settings.items() if k != "kinds"} == {"min_streak": 0}
