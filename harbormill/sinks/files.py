"""File sinks. Every write is a distributed directory of part files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbormill.sources.files import CSV_DIALECT


def append_history(new: DataFrame, path: str) -> None:
    """Add rows to a dataset, or start it; nothing already there is rewritten."""
    new.write.mode("append").parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Null becomes an empty field and the empty text a pair of quotes."""
    df.write.mode("overwrite").options(**CSV_DIALECT).csv(path)


def write_documents_json(df: DataFrame, document: str, chunks: Column, path: str, folders: bool = False) -> None:
    """One JSON array per source document.

    ``chunks`` is the document's own array of structs, so documents are written
    where they are, without gathering their chunks from elsewhere. By default a
    line holds a document and its array; ``folders`` puts every array into a
    folder named after its document, which suits thousands of documents, not billions.
    """
    if folders:
        body = df.select(F.col(document), F.to_json(chunks).alias("value"))
        body.write.mode("overwrite").partitionBy(document).text(path)
    else:
        df.select(F.col(document), chunks.alias("chunks")).write.mode("overwrite").json(path)
