"""What a workflow needs to know about its table, and where a run keeps its files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Defaults a run must share with earlier runs to be comparable.
#   70 % of rows train and 30 % test; a column may miss at most 20 % of its values;
#   text is hashed to 40 slots; a challenger must gain 0.002 F1; the unknown target is "N/A";
#   rejected columns and rows carry these reasons.
TEST_PERCENT = 30
MAX_MISSING_PERCENT = 20.0
TEXT_SLOTS = 40
MIN_F1_GAIN = 0.002
UNKNOWN_TARGET = "N/A"
HIGH_MISSING_REASON = "Contains many missing values"
UNKNOWN_TARGET_REASON = "Dropped row as target label is unknown"
# Names of prepared columns, which readers of a run's tables rely on.
VECTOR = "va_input_features"
FEATURES = "scaled_input_features"
WORD_COUNTS = "rawFeatures"


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of one table.

    ``categorical`` columns are mode-imputed, indexed and one-hot encoded; ``frequency`` columns
    are replaced by how often their value occurs (for columns with too many values to index: more than
    ``max_categories`` in a categorical column are an error);
    each ``(start, end)`` pair of ``date_pairs`` becomes a number of elapsed days; ``numeric``
    columns are mean-imputed; ``text`` becomes hashed TF-IDF.
    """

    target: str
    key: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    frequency: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    date_pairs: tuple[tuple[str, str, str], ...] = ()
    text: str | None = None
    always_drop: tuple[str, ...] = ()
    unknown_target: str = UNKNOWN_TARGET
    test_percent: int = TEST_PERCENT
    max_missing_percent: float = MAX_MISSING_PERCENT
    text_slots: int = TEXT_SLOTS
    min_doc_freq: int = 0
    max_categories: int = 10_000
    numeric_fallback: float = 0.0

    @property
    def date_columns(self) -> list[str]:
        return list(dict.fromkeys(c for pair in self.date_pairs for c in pair[:2]))

    @property
    def scoring_columns(self) -> list[str]:
        """Columns a file must have to be scored."""
        text = [self.text] if self.text else []
        return [*self.categorical, *self.frequency, *self.numeric, *text, *self.date_columns]

    @property
    def required_columns(self) -> list[str]:
        """Columns a file must have to be trained on."""
        return [self.target, *self.scoring_columns]

    @property
    def numbers(self) -> list[str]:
        """Numeric inputs of the imputer: plain numbers and elapsed days."""
        return [*self.numeric, *(pair[2] for pair in self.date_pairs)]

    @property
    def vector_inputs(self) -> list[str]:
        text = [f"tf_{self.text}"] if self.text else []
        return (
            [f"tf_{c}" for c in self.categorical]
            + [f"fe_{c}" for c in self.frequency]
            + [f"im_{c}" for c in self.numbers]
            + text
        )

    @property
    def vector(self) -> str:
        return VECTOR

    @property
    def features(self) -> str:
        return FEATURES

    @property
    def indexed_target(self) -> str:
        return f"indexed_{self.target}"

    @property
    def predicted_target(self) -> str:
        return f"prediction_{self.target}"

    def schema(self, types: dict[str, T.DataType] | None = None) -> T.StructType:
        """Declared read schema: dates as timestamps, numbers as doubles, the rest as strings.

        ``types`` overrides single columns. Columns outside every role are not read.
        """
        known = {c: T.TimestampType() for c in self.date_columns}
        known.update({c: T.DoubleType() for c in self.numeric})
        known.update(types or {})
        names = dict.fromkeys([*self.key, *self.required_columns])
        return T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])


@dataclass(frozen=True)
class RunPaths:
    """Folders of one run. ``root`` is shared by all runs and may be any Hadoop path."""

    root: str
    run_id: str

    def _in_run(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), "runs", self.run_id, *parts])

    def _shared(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # kept over all runs
    @property
    def feature_store(self) -> str:
        return self._shared("feature_store")

    @property
    def watermarks(self) -> str:
        return self._shared("watermarks")

    @property
    def evaluations(self) -> str:
        return self._shared("evaluations")

    @property
    def registry(self) -> str:
        return self._shared("registry")

    @property
    def saved_models(self) -> str:
        return self._shared("saved_models")

    # one set for each run
    @property
    def landing(self) -> str:
        return self._in_run("landing")

    @property
    def validated(self) -> str:
        return self._in_run("validated")

    @property
    def rejected_columns(self) -> str:
        return self._in_run("rejected", "columns")

    @property
    def transformed(self) -> str:
        return self._in_run("transformed")

    @property
    def stages(self) -> str:
        return self._in_run("stages")

    @property
    def category_counts(self) -> str:
        return self._in_run("category_counts")

    @property
    def confusion(self) -> str:
        return self._in_run("confusion")

    @property
    def label_indexer(self) -> str:
        return self._in_run("label_indexer")

    @property
    def trained_model(self) -> str:
        return self._in_run("trained_model")

    @property
    def predictions(self) -> str:
        return self._in_run("predictions")

    @property
    def archive(self) -> str:
        return self._in_run("archive")

    @property
    def failed(self) -> str:
        return self._in_run("failed")
