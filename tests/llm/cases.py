"""Odd documents, and what several tests share."""

from __future__ import annotations

import duckdb
import pandas as pd

LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(10_000))

#: (doc_id, text, source): nulls, empty and very long texts, ties and repeated rows.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away today", "b"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away today", "b"),
    (3, "the quick  brown\tfox jumps over the lazy dog and runs far away today", "a"),
    (4, None, "a"),
    (5, "", None),
    (6, " \n\t ", None),
    (7, "one", "c"),
    (7, "one", "c"),
    (8, "two words", None),
    (None, "a text without an id that has some words of its own to count", "b"),
    (None, None, None),
    (9, LONG, "d"),
    (10, LONG + " end", "d"),
    (11, "Ünïcödé wörds – ñandú, 东京 and 𝔘𝔫𝔦 with \x00 a zero and \x1f marks", "é"),
    (12, "!!! ??? ...", "a"),
]


def odd_documents(spark, rows=ODD):
    """With columns whose names operators might use for themselves."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long,"
        " size string, shard string, _row string, copies string, score string, `a.b` string"
    )
    full = [(i, t, None, s, None, "x", None, "y", "z", None, "w") for i, t, s in rows]
    return spark.createDataFrame(full, schema)


def no_documents(spark):
    return odd_documents(spark, [])


def in_duckdb(sql: str, **tables: pd.DataFrame) -> pd.DataFrame:
    with duckdb.connect() as connection:
        for name, frame in tables.items():
            connection.register(name, frame)
        return connection.execute(sql).df()


def plain(df) -> pd.DataFrame:
    """A pandas frame in which numbers with nulls stay exact."""
    rows = df.collect()
    return pd.DataFrame({c: pd.Series([r[c] for r in rows], dtype=object) for c in df.columns})


def rows_of(frame: pd.DataFrame, columns: list[str]) -> list[tuple]:
    """Rows in a defined order; NaN and NaT count as null."""

    def value(v):
        if v is None or (not isinstance(v, (list, str)) and pd.isna(v)):
            return None
        return v.item() if hasattr(v, "item") else v

    found = [tuple(value(v) for v in row) for row in frame[columns].itertuples(index=False)]
    return sorted(found, key=repr)


def documents_frame(docs) -> pd.DataFrame:
    """doc_id, text and source with the types DuckDB needs."""
    frame = plain(docs.select("doc_id", "text", "source"))
    return pd.DataFrame(
        {
            "doc_id": frame["doc_id"].astype("Int64"),
            "text": frame["text"].astype("string"),
            "source": frame["source"].astype("string"),
        }
    )
