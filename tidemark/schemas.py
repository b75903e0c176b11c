"""Versioned schemas. A rule change is a new version, never an edit of an old one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The label vocabulary of schema v1, in the order that models index it.
LABELS = ["bullish", "bearish", "neutral"]
REPLACEMENT = "\ufffd"


@dataclass(frozen=True)
class TextSchema:
    """Columns with their types and, per column, the values it may hold (none: any).

    The columns in ``encoded`` may hold neither bytes that are no UTF-8 nor the replacement character that stands for
    such bytes once they have been read away.
    """

    name: str
    columns: T.StructType
    allowed: dict[str, tuple[str, ...]]
    encoded: tuple[str, ...] = ()

    def rules(self) -> dict[str, Column]:
        """Name of each rule and the condition under which a row breaks it."""
        out: dict[str, Column] = {}
        for field in self.columns.fields:
            if not field.nullable:
                out[f"{field.name}_null"] = F.col(field.name).isNull()
            if field.name in self.allowed:
                out[f"{field.name}_vocabulary"] = F.col(field.name).isNotNull() & ~F.col(field.name).isin(
                    list(self.allowed[field.name])
                )
            if field.name in self.encoded:
                text = F.col(field.name)
                out[f"{field.name}_encoding"] = F.coalesce(
                    ~F.is_valid_utf8(text) | F.contains(text, F.lit(REPLACEMENT)), F.lit(False)
                )
        return out

    def column_problems(self, found: T.StructType) -> list[str]:
        """Missing columns and wrong types; known without running a job."""
        types = {f.name: f.dataType for f in found.fields}
        problems = []
        for field in self.columns.fields:
            if field.name not in types:
                problems.append(f"column {field.name} is missing")
            elif types[field.name] != field.dataType:
                problems.append(
                    f"column {field.name} is {types[field.name].simpleString()}, "
                    f"not {field.dataType.simpleString()}"
                )
        return problems


def labelled_text(name: str, labels: list[str], encoded: tuple[str, ...] = ()) -> TextSchema:
    columns = T.StructType(
        [T.StructField("text", T.StringType(), False), T.StructField("label", T.StringType(), False)]
    )
    return TextSchema(name, columns, {"label": tuple(labels)}, encoded)


SCHEMA_V1 = labelled_text("v1", LABELS)
#: As v1, and texts must be whole UTF-8.
SCHEMA_V2 = labelled_text("v2", LABELS, ("text",))
SCHEMAS = {"v1": SCHEMA_V1, "v2": SCHEMA_V2}
