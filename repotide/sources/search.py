"""Search responses: the items of a response as repository records."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.contract import LANGUAGES, REPO_SCHEMA, WIRE_FIELDS
from repotide.functions.expressions import target_language

ITEM_SCHEMA = T.StructType([f for f in REPO_SCHEMA if f.name in WIRE_FIELDS])


def search_items(responses, item_schema=ITEM_SCHEMA, payload="payload"):
    """One row per element of each response's `items`."""
    response = T.StructType([T.StructField("items", T.ArrayType(item_schema))])
    return responses.select(F.inline(F.from_json(payload, response)["items"]))


def source_language_filter(items, languages=LANGUAGES):
    """Items in a target language; null never is."""
    return items.where(target_language(languages))


def project_repo_fields(items, fields=WIRE_FIELDS):
    return items.select(*fields)
