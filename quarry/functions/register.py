"""The Python functions of the engine under SQL names: nfc, html_to_markdown and the table function chunk_document."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from quarry.functions.chunking import SCHEMA, chunks
from quarry.functions.html import markdown_of
from quarry.functions.text import nfc


class ChunkDocument:
    """chunk_document(text, max_tokens, overlap, min_tokens): the chunks of one text."""

    def eval(self, text: str, budget: int, overlap: int, least: int):
        yield from chunks(text, budget, overlap, least)


def register(spark: SparkSession) -> None:
    spark.udf.register("nfc", nfc)
    spark.udf.register("html_to_markdown", markdown_of)
    spark.udtf.register("chunk_document", udtf(ChunkDocument, returnType=SCHEMA))
