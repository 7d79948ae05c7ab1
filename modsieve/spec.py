"""Declared table layouts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from types import MappingProxyType

from pyspark.sql import types as T

# The type names a declared layout may use.
TEXT_NAMES = ("str", "string", "object")
INTEGER_NAMES = ("int", "int32", "int64", "integer", "natural")
SPARK_TYPES = {
    "str": T.StringType(),
    "string": T.StringType(),
    "object": T.StringType(),
    "int": T.LongType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "integer": T.LongType(),
    "natural": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class TableSpec:
    """Columns with their declared types, and the part each one plays."""

    columns: Mapping[str, str]
    features: tuple[str, ...]
    target: str | None = None
    categorical: tuple[str, ...] = ()
    filepath: tuple[str, ...] = ()
    key: tuple[str, ...] = ("row_id",)

    def __post_init__(self):
        object.__setattr__(self, "columns", MappingProxyType(dict(self.columns)))

    def for_test(self) -> TableSpec:
        """The layout of unlabelled files: a new spec, this one stays as it is."""
        kept = {c: t for c, t in self.columns.items() if c != self.target}
        return replace(self, columns=kept)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, SPARK_TYPES.get(t.lower(), T.StringType())) for c, t in self.columns.items()]
        )


@dataclass(frozen=True)
class ReviewColumns:
    """Names of the columns that augmentation, prompts and mining work on."""

    key: str = "row_id"
    body: str = "body"
    rule: str = "rule"
    community: str = "subreddit"
    label: str = "rule_violation"
    positive_examples: tuple[str, ...] = ("positive_example_1", "positive_example_2")
    negative_examples: tuple[str, ...] = ("negative_example_1", "negative_example_2")


COLUMNS = ReviewColumns()

# The two table layouts of the moderation data.
REVIEWS = TableSpec(
    columns={
        "row_id": "int64",
        "body": "str",
        "rule": "str",
        "subreddit": "str",
        "positive_example_1": "str",
        "positive_example_2": "str",
        "negative_example_1": "str",
        "negative_example_2": "str",
        "rule_violation": "int64",
    },
    features=("rule", "body"),
    target="rule_violation",
    categorical=("rule", "subreddit", "rule_violation"),
)
SYNTHETIC = TableSpec(
    columns={"body": "str", "rule": "str", "subreddit": "str", "rule_violation": "int64"},
    features=("rule", "body"),
    target="rule_violation",
    categorical=("rule", "subreddit", "rule_violation"),
    key=("rule", "body", "subreddit"),
)
