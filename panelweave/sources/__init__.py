from panelweave.sources.rankings import read_rankings
from panelweave.sources.store import cached_predictions, load_model, save_model
from panelweave.sources.tables import nan_to_null, read_periods, read_table

__all__ = [
    "cached_predictions",
    "load_model",
    "nan_to_null",
    "read_periods",
    "read_rankings",
    "read_table",
    "save_model",
]
