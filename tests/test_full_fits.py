"""The model queries ask for the whole job: learners, grids and folds of full size."""

from __future__ import annotations

import inspect
from types import SimpleNamespace

import pytest

from leadloom.catalog import models_q
from leadloom.models import folds, learners, selection


class Asked(Exception):
    pass


@pytest.fixture
def asked(monkeypatch):
    """The arguments of the first call of a function, defaults included; the call itself is not made."""
    def arguments(query, owner, name):
        shape = inspect.signature(getattr(owner, name))

        def stop(*args, **named):
            bound = shape.bind(*args, **named)
            bound.apply_defaults()
            raise Asked(bound.arguments)

        for part in ("split_table", "prepare_panel"):
            monkeypatch.setattr(models_q, part, lambda *_: (SimpleNamespace(columns=["a"]), None))
        monkeypatch.setattr(models_q, "fresh_path", lambda *_: "")
        monkeypatch.setattr(models_q, "Store", lambda *_: None)
        monkeypatch.setattr(owner, name, stop)
        session = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="none"))
        source = type("Source", (), {"spark": session, "sf_dir": "", "__call__": lambda *_: None})()
        with pytest.raises(Asked) as caught:
            query(source)
        return caught.value.args[0]

    return arguments


def test_ranking(asked):
    found = asked(models_q.m5, selection, "rfe_rank")
    assert (found["trees"], found["depth"], found["step"]) == (30, 10, 10)


def test_cuts(asked):
    options = asked(models_q.m7, models_q, "make_cuts")["options"]
    assert options.n_features == 300 and options.rfe == {}


@pytest.mark.parametrize("query", [models_q.m8, models_q.m9])
def test_search(asked, query):
    found = asked(query, folds, "tune")
    assert (found["iterations"], found["cv"]) == (10, 3) and not found["learner"].endswith("_small")


def test_calibration(asked):
    found = asked(models_q.m10, folds, "calibrate")
    assert (found["learner"], found["cv"], found["params"]) == ("forest", 3, {})


@pytest.mark.parametrize("query", [models_q.m11, models_q.m13])
def test_learners(asked, query):
    assert asked(query, learners, "fit")["name"] == "gbt"


def test_vote(asked):
    assert asked(models_q.m12_fit, learners, "soft_vote")["names"] == ["gbt", "forest", "logit"]


def test_automatic_fit(asked):
    found = asked(models_q.m22, models_q, "auto_fit")
    assert (found["learners"], found["cv"], found["max_fits"]) == (("gbt", "forest", "logit"), 3, None)


def test_full_run(asked):
    config = asked(models_q.m28, models_q, "train_score")["config"]
    assert config.estimators == ("gbt", "forest", "logit") and (config.iterations, config.cv) == (10, 3)
    assert config.cuts.n_features == 300 and config.cuts.rfe == {}
