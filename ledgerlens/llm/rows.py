"""How operators keep a table's own columns apart from theirs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows_and_text(documents: DataFrame, text_col: str, carry: list[str] | None) -> DataFrame:
    """``row``: a struct of the columns to carry (all by default), so that no name can clash; ``text`` beside it."""
    names = documents.columns if carry is None else carry
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in names])
    return documents.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))


class Carried:
    """Like ``rows_and_text``, but a text that is carried, too, goes through Python once, beside the row."""

    def __init__(self, documents: DataFrame, text_col: str, carry: list[str] | None):
        self.names = list(documents.columns if carry is None else carry)
        rest = [c for c in self.names if c != text_col]
        self.apart = text_col if len(rest) < len(self.names) and rest and documents.schema[text_col].dataType == T.StringType() else None
        self.frame = rows_and_text(documents, text_col, rest if self.apart else self.names)
        self.columns = ["row", "text"] if self.apart else ["row"]
        self.schema = f"row {row_type(self.frame)}" + (", text string" if self.apart else "")

    def restored(self, df: DataFrame) -> DataFrame:
        if not self.apart:
            return df
        whole = F.struct(*[(F.col("text") if c == self.apart else F.col(f"row.`{c}`")).alias(c) for c in self.names])
        return df.select(whole.alias("row"), *[F.col(f"`{c}`") for c in df.columns if c not in ("row", "text")])


def row_type(df: DataFrame) -> str:
    return df.schema["row"].dataType.simpleString()
