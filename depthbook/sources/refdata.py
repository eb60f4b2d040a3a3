"""JSON documents of market groups, types and structures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthbook.functions.schemas import MARKET_GROUP_DOC, STRUCTURE_DOC, TYPE_DOC


def group_types_flat(docs: DataFrame) -> DataFrame:
    """(body) of market groups to one row per group and type; nothing is folded."""
    doc = F.from_json("body", MARKET_GROUP_DOC)
    return (
        docs.select(doc.alias("doc"))
        .select("doc.market_group_id", F.explode_outer("doc.types").alias("type_id"))
        .where(F.col("type_id").isNotNull())
    )


def parse_types(docs: DataFrame) -> DataFrame:
    """(body) of type documents to records; documents without an id are left out."""
    # Expanded, not selected: a condition on the fields would else be pushed below and parse again.
    fields = F.inline_outer(F.array(F.from_json("body", TYPE_DOC)))
    return docs.select(fields).where(F.col("type_id").isNotNull())


def parse_structures(docs: DataFrame) -> DataFrame:
    """(structure_id, status, body) with the document's fields in place of the body."""
    fields = F.inline_outer(F.array(F.from_json("body", STRUCTURE_DOC)))
    return docs.select("structure_id", "status", fields)
