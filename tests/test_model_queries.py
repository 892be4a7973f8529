"""The registered model queries: the operator's default model, and what they give with a small one."""

import pytest

from cargolume.operators import model
from cargolume.queries import REGISTRY
from cargolume.queries import job_queries as jq
from cargolume.schemas import FEATURES

SMALL = model.ModelSettings(trees=6, depth=6, members=2, folds=2, fit_rows=1500)
ROWS = {"walk_forward_scores": 6000, "walk_forward_quality": 2, "chronological_evaluation": 5, "split_strategies": 2, "scoring_regimes": 3,
        "feature_ablation": 7, "calibration_methods": 3, "impurity_importance": 6, "permutation_importance": 6, "saved_model_check": 1,
        "batch_scores": 6000, "raw_vehicle_guard": 1, "training_run": 1}


def test_queries_run_the_default_model():
    d = model.ModelSettings()
    assert jq.FULL == d
    assert (d.trees, d.depth, d.members, d.folds, d.method, d.features) == (300, 30, 5, 5, "isotonic", tuple(FEATURES))


@pytest.mark.parametrize("name", sorted(ROWS))
def test_rows_with_a_small_model(spark, folder, monkeypatch, name):
    monkeypatch.setattr(jq, "FULL", SMALL)
    rows = REGISTRY[name][0](spark, folder).collect()
    assert len(rows) == ROWS[name]
    for r in rows:
        for c in ("probability", "Delay_Risk_Probability", "roc_auc"):
            assert c not in r or 0 <= r[c] <= 1
