"""Constants and storage layout shared by all jobs."""

from __future__ import annotations

from dataclasses import dataclass

# Results depend on these being exactly so.
LINE_PATTERN = (
    r"([^\s]+)\s+"
    r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d+)\s+"
    r"(\d+)\s+"
    r"([A-Z]+)\s+"
    r"([^\[]+)\s*"
    r"(?:\[([^\]]+)\])?\s*"
    r"(.*)"
)
LINE_FIELDS = ("source", "timestamp", "pid", "level", "component", "request_id", "message")
MISSING_REQUEST = "-"
IMPUTED_REQUEST = "rca-system"
UNMAPPED = "UNMAPPED"
KEY_PREFIX = "LG_KEY_"
WILDCARD = "<*>"
TOP_VALUES = 50
HISTOGRAM_BINS = 30
WINDOW_LINES = 10
N_CLUSTERS = 5
KMEANS_SEEDS = (0, 1, 2, 3, 4)
MAX_FEATURES = 1000
DISTANCE_THRESHOLD = 0.5
LATENT_DIM = 32
HIDDEN_LAYERS = (512, 128)
EPOCHS = 30
BATCH_SIZE = 64
PATIENCE = 5
LATENT_SEED = 42
FOREST_SEED = 42
FOREST_TRIALS = 10
FOREST_TREES = (100, 300)
FOREST_CONTAMINATION = (0.01, 0.1)
FOREST_SAMPLES = ("auto", 0.8, 1.0)
TOKEN_LENGTH = 64
RETRAIN_MESSAGE = "retrain_model"
UPDATED_MESSAGE = "model_updated"
UPDATE_TASK = "airflow_trigger"
# End of fixed values.

SIMILARITY = 0.4
# Events of a row of exported session text; longer sessions come in pieces.
EXPORT_EVENTS = 100_000


@dataclass(frozen=True)
class Layout:
    """Where each layer of one log lives, below one base directory."""

    base: str

    def _at(self, *parts: str) -> str:
        return "/".join((self.base.rstrip("/"), *parts))

    @property
    def raw(self) -> str:
        return self._at("raw")

    @property
    def structured(self) -> str:
        return self._at("silver", "structured")

    @property
    def cleaned(self) -> str:
        return self._at("silver", "cleaned")

    @property
    def rejects(self) -> str:
        return self._at("silver", "rejects")

    @property
    def reports(self) -> str:
        return self._at("reports")

    @property
    def templates(self) -> str:
        return self._at("gold", "templates")

    @property
    def tagged(self) -> str:
        return self._at("gold", "structured_with_log_key")

    @property
    def sequences(self) -> str:
        return self._at("gold", "sequences")

    @property
    def structured_days(self) -> str:
        return self._at("silver", "structured_by_day")

    @property
    def tagged_days(self) -> str:
        return self._at("gold", "structured_with_log_key_by_day")

    @property
    def runs(self) -> str:
        return self._at("runs")

    @property
    def updates(self) -> str:
        return self._at("model_updates")

    def model(self, kind: str) -> str:
        return self._at("models", kind)
