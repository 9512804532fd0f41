"""Deeply nested JSON records to flat child tables: one pass, each emitted row tagged with its table."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.runtime import ship_package

_KEYS = {"main_ingredients": ("main_ingredients", "mainIngredients"), "images": ("images",), "variants": ("variants",), "variant_options": ("variant_options", "variantOptions")}
_LABELS = {"main_ingredients": ("name", "value"), "images": ("url", "src"), "variants": ("id",), "variant_options": ("name", "label")}
#: An object with one of these keys is one entry; any other object of options maps names to values.
_ENTRY_KEYS = {"main_ingredients": (), "images": (), "variants": (), "variant_options": ("name", "label", "value", "selected", "position")}


class Pairs(list):
    """A JSON object as its (key, value) pairs in written order, repeated keys included."""

    def get(self, *names: str) -> object:
        found = None
        for key, value in self:
            if key in names and value is not None:
                found = value
        return found


def parse_record(payload: str | None) -> Pairs | None:
    """The record a payload holds: byte order marks dropped, text packed into strings and single-entry lists opened, however deep; None where it holds none."""
    value: object = payload
    while True:  # each round parses a shorter text or enters a smaller value
        if isinstance(value, str):
            try:
                value = json.loads(value.lstrip("\ufeff \t\r\n"), object_pairs_hook=Pairs)
            except (ValueError, RecursionError):
                return None
        elif isinstance(value, list) and not isinstance(value, Pairs) and len(value) == 1:
            value = value[0]
        else:
            break
    return value if isinstance(value, Pairs) and value else None


def _entries(value: object, kind: str) -> list[object]:
    if value is None:
        return []
    if isinstance(value, Pairs):
        if kind == "variant_options" and not any(k in _ENTRY_KEYS[kind] for k, _ in value):
            return [Pairs([("name", k), ("value", v)]) for k, v in value]
        return [value]
    return value if isinstance(value, list) else [value]


def _label(entry: object, kind: str) -> str | None:
    if isinstance(entry, Pairs):
        for name in _LABELS[kind]:
            if (found := _label(entry.get(name), kind)) is not None:
                return found
        return None
    if isinstance(entry, bool) or entry is None or isinstance(entry, list):
        return None
    text = entry if isinstance(entry, str) else json.dumps(entry)
    return text if text.strip(" \t\r\n\xa0\u202f\u200b\ufeff") else None


def visit(record: Pairs) -> Iterator[tuple[str, int, int, str, str]]:
    """Depth first: (child table, parent_no, item_no, label, entry as JSON) of each labelled entry below a record."""
    fields = record.get("fields")
    holders = [record, fields] if isinstance(fields, Pairs) else [record]

    def below(holder: Pairs, kind: str, parent: int) -> Iterator[tuple[str, int, int, str, str]]:
        for no, entry in enumerate(_entries(holder.get(*_KEYS[kind]), kind)):
            label = _label(entry, kind)
            if label is not None:
                yield kind, parent, no, label, json.dumps(_plain(entry), ensure_ascii=False)
            if kind == "variants" and isinstance(entry, Pairs):
                yield from below(entry, "variant_options", no)

    for kind in _KEYS:
        for holder in holders:
            yield from below(holder, kind, -1)


def _plain(value: object) -> object:
    if isinstance(value, Pairs):
        return {k: _plain(v) for k, v in value}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def flatten_records(records: DataFrame, id_col: str = "raw_id", payload_col: str = "payload") -> DataFrame:
    """(id, child, parent_no, item_no, label, payload): the child rows of all tables of nested records, tagged by `child`.

    Records are read once, in Arrow batches, and nothing is shuffled. Keys may be spelled with underscores or in camel case, stand in the
    record or in its `fields`; a lone entry counts as a list of one, an object of options as entries in written order; empty entries keep
    their place but give no row. Null, empty, cut-off or recordless payloads give no rows; of a repeated key the last value that isn't null counts.
    """
    ship_package(records.sparkSession)
    id_type = records.schema[id_col].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for key, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                record = parse_record(payload)
                if record is not None:
                    for row in visit(record):
                        for column, value in zip(out, (key, *row), strict=True):
                            column.append(value)
            types = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            names = [id_col, "child", "parent_no", "item_no", "label", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    rows = records.select(F.col(id_col), F.col(payload_col).cast("string").alias("payload")).filter(F.col("payload").isNotNull())
    return rows.mapInArrow(emit, f"{id_col} {id_type}, child string, parent_no int, item_no int, label string, payload string")


def child_tables(flat: DataFrame) -> dict[str, DataFrame]:
    """The child tables of flatten_records by tag, each with its own schema as `entry`.

    Entries that are bare strings or numbers have no fields: their `entry` is null and their text stands in `label`. To store them in one pass write `flat` partitioned by `child`.
    """
    schemas = {
        "main_ingredients": "name string, value string, substance string, form string, category string, taxonomy struct<substance string, form string, category string>",
        "images": "url string, src string, alt string, width int",
        "variants": "id string, sku string, price string, available boolean",
        "variant_options": "name string, label string, value string, selected string, position int",
    }
    return {tag: flat.filter(F.col("child") == tag).withColumn("entry", F.from_json("payload", schema)).drop("payload") for tag, schema in schemas.items()}


def write_partitioned(flat: DataFrame, path: str) -> None:
    """Write the tagged rows once, one folder per child table."""
    flat.write.mode("overwrite").partitionBy("child").parquet(path)
