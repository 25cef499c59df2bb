"""Column functions and schema inference."""

from .columns import as_text, decode_json, encode_json, free_name, ingest_date, key_columns
from .inference import first_message_schema, found_schema, infer_schema, plain_schema, wider_schema

__all__ = [
    "as_text",
    "decode_json",
    "encode_json",
    "first_message_schema",
    "found_schema",
    "free_name",
    "infer_schema",
    "ingest_date",
    "key_columns",
    "plain_schema",
    "wider_schema",
]
