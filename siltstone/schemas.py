"""Declared schemas of the four layers and the field map between them."""

from __future__ import annotations

from pyspark.sql import types as T

# Source field names, target names, target types and comments.
PUBLICATION_FORMAT = "dd/MM/yyyy HH:mm:ss"
STAMP_FORMAT = "yyyyMMdd_HHmmss"
STAMP_LENGTH = 15

RECORD_FIELDS = [
    "id",
    "data_publicacao",
    "destaque",
    "editorias",
    "imagens",
    "introducao",
    "link",
    "produto_id",
    "produtos",
    "produtos_relacionados",
    "tipo",
    "titulo",
]

# source column -> target column, cast to string on the way
RENAMES = {
    "destaque": "newsHighlight",
    "editorias": "editorials",
    "imagens": "images",
    "introducao": "introduction",
    "link": "link",
    "produto_id": "product_id",
    "produtos": "products",
    "produtos_relacionados": "relatedProducts",
    "tipo": "type",
    "titulo": "title",
}

SILVER_COLUMNS = [
    ("referenceMonthDate", "date", "First day of the publication month"),
    ("id", "bigint", "Unique identifier of the item"),
    ("newsHighlight", "string", "Highlight flag"),
    ("editorials", "string", "Editorial"),
    ("images", "string", "Image description, JSON text"),
    ("publicationDate", "timestamp", "Publication time"),
    ("introduction", "string", "Introduction"),
    ("link", "string", "Link"),
    ("product_id", "string", "Product identifier"),
    ("products", "string", "Product"),
    ("relatedProducts", "string", "Related products"),
    ("type", "string", "Type"),
    ("title", "string", "Title"),
    ("dateIngestion", "timestamp", "Ingestion time"),
    ("dt", "string", "Run month, partition"),
]


_TYPES = {
    "date": T.DateType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: list[tuple[str, str, str]]) -> T.StructType:
    out = T.StructType()
    for name, kind, comment in columns:
        out.add(name, _TYPES[kind], True, {"comment": comment})
    return out


RECORD_SCHEMA = T.StructType(
    [T.StructField(f, T.LongType() if f == "id" else T.StringType()) for f in RECORD_FIELDS]
)
RAW_SCHEMA = T.StructType([*RECORD_SCHEMA.fields, T.StructField("PAGE", T.StringType())])
# Values of a landed item that no column holds, as a JSON object; a line that is no object, as it is.
UNFIT = "UNFIT"
BRONZE_SCHEMA = T.StructType(
    [*RAW_SCHEMA.fields, T.StructField(UNFIT, T.StringType()), T.StructField("DTPROC", T.StringType())]
)
SILVER_SCHEMA = _schema(SILVER_COLUMNS)
GOLD_BASE_SCHEMA = SILVER_SCHEMA
LEDGER_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in ("folder", "period", "DTPROC")]
)


# Holds the text of a JSON row that does not parse, or not with the declared types.
CORRUPT = "__corrupt"


def envelope_schema(record: T.DataType = RECORD_SCHEMA) -> T.StructType:
    """Page envelope: page number, page count, the records of the page, the text if malformed."""
    return T.StructType(
        [
            T.StructField("page", T.LongType()),
            T.StructField("totalPages", T.LongType()),
            T.StructField("items", T.ArrayType(record)),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )
