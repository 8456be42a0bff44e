from panelweave.models.features import PanelFeatures, PanelFeaturesModel
from panelweave.models.fit import (
    Fitted,
    expand_grid,
    fit_with_patience,
    linear_model,
    search,
    search_families,
    tree_model,
)
from panelweave.models.score import batch_score, flatten_sequences, score_sequences

__all__ = [
    "Fitted",
    "PanelFeatures",
    "PanelFeaturesModel",
    "batch_score",
    "expand_grid",
    "fit_with_patience",
    "flatten_sequences",
    "linear_model",
    "score_sequences",
    "search",
    "search_families",
    "tree_model",
]
