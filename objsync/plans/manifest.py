"""The dataset manifest: file format and field list as JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the manifest says about every dataset.
FILE_FORMAT = {
    "charsetName": "UTF-8",
    "fieldsDelimitedBy": ",",
    "numberOfLinesToIgnore": 0,
}
CONNECTOR = "AcmeCSVConnector"
TEXT_TYPE = "Text"
MAX_SCALE = 6

# How each Spark type is described unless the user's config says otherwise. Types
# that are not listed are text; so are dates, whose written form is not known.
DEFAULT_CONFIG: dict[str, dict[str, str]] = {
    "byte": {"type": "Numeric", "precision": "3", "scale": "0"},
    "short": {"type": "Numeric", "precision": "5", "scale": "0"},
    "integer": {"type": "Numeric", "precision": "10", "scale": "0"},
    "long": {"type": "Numeric", "precision": "18", "scale": "0"},
    "float": {"type": "Numeric", "precision": "16", "scale": "6"},
    "double": {"type": "Numeric", "precision": "16", "scale": "6"},
    "string": {"type": "Text"},
}


def merged_config(
    user: dict[str, dict[str, str]] | str | None = None,
) -> dict[str, dict[str, str]]:
    """The type map with the user's entries, each replacing a whole entry.

    ``user`` is a mapping or its JSON text.
    """
    if isinstance(user, str):
        user = json.loads(user)
    return {**DEFAULT_CONFIG, **(user or {})}


def _type_name(data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return data_type.simpleString()
    return data_type.typeName()


def type_part(
    data_type: T.DataType, config: dict[str, dict[str, str]], type_key: str = "type"
) -> dict:
    """The members of a field entry that describe its type."""
    entry = config.get(_type_name(data_type), {type_key: TEXT_TYPE})
    dataset_type = entry.get(type_key) or entry.get("type")
    if dataset_type is None:
        raise ValueError(f"the entry {_type_name(data_type)} of the type map has no member {type_key!r}")
    part: dict = {"type": dataset_type}
    if "precision" in entry:
        scale = int(entry.get("scale", 0))
        if scale > MAX_SCALE:
            raise ValueError(f"scale {scale} is above the limit of {MAX_SCALE}")
        part["precision"] = int(entry["precision"])
        part["defaultValue"] = json.loads(str(entry.get("defaultValue", 0)))
        part["scale"] = scale
    if "format" in entry:
        part["format"] = entry["format"]
    if "canTruncateValue" in entry:
        part["canTruncateValue"] = entry["canTruncateValue"]
    return part


def field_entries(
    schema: T.StructType,
    name: str,
    config: dict[str, dict[str, str]] | str | None = None,
    type_key: str = "type",
) -> list[dict]:
    """One entry per field of ``schema``."""
    types = merged_config(config)
    return [
        {
            "description": "",
            "fullyQualifiedName": f"{name}.{field.name}",
            "label": field.name,
            "name": field.name,
            "isSystemField": False,
            "isUniqueId": False,
            "isMultiValue": False,
            **type_part(field.dataType, types, type_key),
        }
        for field in schema.fields
    ]


def dataset_manifest(
    schema: T.StructType,
    name: str,
    config: dict[str, dict[str, str]] | str | None = None,
    type_key: str = "type",
) -> str:
    """The manifest as JSON text. A scale above the limit is refused.

    ``type_key`` is the member of a config entry that holds the dataset type, for
    configs written with another name for it.
    """
    return json.dumps(
        {
            "fileFormat": FILE_FORMAT,
            "objects": [
                {
                    "connector": CONNECTOR,
                    "description": "",
                    "fullyQualifiedName": name,
                    "label": name,
                    "name": name,
                    "fields": field_entries(schema, name, config, type_key),
                }
            ],
        }
    )


# one row per field, as read back from the manifest
_FIELD = (
    "fullyQualifiedName string, label string, name string, isSystemField boolean, "
    "isUniqueId boolean, isMultiValue boolean, type string, precision int, "
    "defaultValue string, scale int, format string, canTruncateValue string"
)


def manifest_fields(manifests: DataFrame, column: str) -> DataFrame:
    """The field entries of manifests held as JSON text in ``column``."""
    parsed = F.from_json(column, f"objects array<struct<fields:array<struct<{_FIELD}>>>>")
    return manifests.select(
        F.explode(F.flatten(parsed["objects"]["fields"])).alias("f")
    ).select("f.*")


def field_table(
    df: DataFrame,
    name: str,
    config: dict[str, dict[str, str]] | str | None = None,
    type_key: str = "type",
) -> DataFrame:
    """The manifest's field entries for ``df`` as a DataFrame."""
    text = dataset_manifest(df.schema, name, config, type_key)
    return manifest_fields(df.sparkSession.createDataFrame([(text,)], "m string"), "m")
