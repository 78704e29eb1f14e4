"""Normalising names and building ids: ``Column -> Column`` only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineweft.functions import vocabulary as V

_RESOURCE_PUNCTUATION = " /\\.-:"


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def normalize_path(path: Column) -> Column:
    """``dbfs:/x`` becomes ``/dbfs/x``; anything else is unchanged."""
    return F.regexp_replace(path, "^dbfs:/", "/dbfs/")


def strip_quotes(name: Column) -> Column:
    """Back-ticks, then double quotes, then single quotes, off both ends; a name without any is left as it is."""
    quotes, bare = ("`", '"', "'"), name
    for quote in quotes:
        bare = F.btrim(bare, F.lit(quote))
    quoted = [F.contains(name, F.lit(quote)) for quote in quotes]
    return F.when(quoted[0] | quoted[1] | quoted[2], bare).otherwise(name)


def escape_resource(namespace: Column) -> Column:
    flat = F.translate(blank_to_null(namespace), _RESOURCE_PUNCTUATION, "_" * len(_RESOURCE_PUNCTUATION))
    return F.coalesce(flat, F.lit(V.DEFAULT_RESOURCE))


def _before_last(text: Column, delimiter: str) -> Column:
    tail = F.char_length(F.substring_index(text, delimiter, -1)) + F.lit(1)
    return F.left(text, F.char_length(text) - tail)


def split_container(name: Column) -> tuple[Column, Column]:
    """(source, table): cut at the last ``/``, else at the last ``.``, else the default source."""
    name = F.coalesce(blank_to_null(name), F.lit("_unknown"))
    source = (
        F.when(F.contains(name, F.lit("/")), _before_last(name, "/"))
        .when(F.contains(name, F.lit(".")), _before_last(name, "."))
        .otherwise(F.lit("_default"))
    )
    table = F.when(F.contains(name, F.lit("/")), F.substring_index(name, "/", -1)).otherwise(
        F.substring_index(name, ".", -1)
    )
    return source, table


def dataset_key(namespace: Column, name: Column) -> Column:
    source, table = split_container(name)
    return F.concat(escape_resource(namespace), F.lit("."), source, F.lit("/"), table)


def split_dataset_name(name: Column) -> tuple[Column, Column]:
    """Tolerant (db, table) split of a path, a one-, two- or three-part name."""
    name = F.trim(F.coalesce(name, F.lit("")))
    steps = F.filter(F.split(name, "/"), lambda part: part != "")
    dots = F.transform(F.split(name, r"\."), strip_quotes)
    is_path = F.contains(name, F.lit("/")) & ~F.contains(name, F.lit("."))
    db = (
        F.when(name == "", F.lit("_default"))
        .when(is_path & (F.size(steps) >= 2), F.get(steps, F.size(steps) - 2))
        .when(is_path, F.lit("_path"))
        .when(F.size(dots) >= 2, F.get(dots, F.size(dots) - 2))
        .otherwise(F.lit("_default"))
    )
    table = (
        F.when(name == "", F.lit("_unknown"))
        .when(is_path, F.get(steps, F.size(steps) - 1))
        .otherwise(F.get(dots, F.size(dots) - 1))
    )
    return db, table


def comparable(name: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"[^\p{L}\p{N}]", "")


def normalize_field(name: Column) -> Column:
    return F.when(comparable(name) == "timestamp", F.lit("timestamp")).otherwise(name)


def comparable_leaf(column: Column) -> Column:
    return comparable(F.substring_index(column, ".", -1))


def names_agree(wanted: Column, leaf: Column) -> Column:
    """On comparable names: equal, or ``...datetime`` fed by ``...timestamp``."""
    return (wanted == leaf) | (wanted.endswith("datetime") & leaf.endswith("timestamp"))


def is_column_match(target: Column, source: Column) -> Column:
    """Whether a source column, by the last part of its dotted name, can feed the target."""
    return names_agree(comparable(target), comparable_leaf(source))


def has_direct(transformations: Column) -> Column:
    return F.coalesce(
        F.exists(transformations, lambda t: F.coalesce(F.upper(t["type"]) == "DIRECT", F.lit(False))),
        F.lit(False),
    )


def parent_id(identifier: Column) -> Column:
    return _before_last(identifier, "/")


def leaf_name(identifier: Column) -> Column:
    return F.substring_index(identifier, "/", -1)


def resource_of(identifier: Column) -> Column:
    return F.substring_index(identifier, ".", 1)


def sanitize_upper(value: Column) -> Column:
    flat = F.btrim(F.regexp_replace(value, "[^A-Za-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(blank_to_null(F.upper(flat)), F.lit("UNNAMED"))


def transform_id(identifier: Column) -> Column:
    """Keep the first path segment, join the others with ``_``."""
    parts = F.split(identifier, "/")
    flat = F.concat(
        F.get(parts, 0), F.lit("/"), F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), "_")
    )
    return F.when(F.size(parts) <= 1, identifier).otherwise(flat)


def transform_name(identifier: Column) -> Column:
    return F.replace(identifier, F.lit("/"), F.lit("."))


def connection_id(source_id: Column) -> Column:
    """Published connection of a data source ``resource/path``."""
    parts = F.split(source_id, "/")
    path = F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), "_")
    return F.concat(F.lit("REFERENCE_"), F.translate(F.upper(path), "<>", ""), F.lit("_CONN"))


def star_ref(table: Column, column: Column) -> Column:
    return F.when(column == "*", F.concat(table, F.lit(".*"))).otherwise(column)


def report_sid(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, "[^A-Za-z0-9_-]", "_"), F.lit("_-"))


def report_uid(report_name: Column) -> Column:
    return F.concat(report_sid(report_name), F.lit("_"), F.left(F.md5(report_name), F.lit(8)))


def _lookup(key: Column, table: dict[str, str], default: str) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, F.coalesce(key, F.lit(""))), F.lit(default))


def classify_field_type(kind: Column) -> Column:
    return _lookup(kind, V.FIELD_TYPES, V.OTHER_FIELD_TYPE)


def node_type(xsi_type: Column) -> Column:
    return _lookup(F.substring_index(xsi_type, ":", -1), V.NODE_TYPES, V.SCRIPT_NODE)


def join_type(raw: Column) -> Column:
    """Looked up without regard to case; unknown spellings give an empty text."""
    return _lookup(F.lower(raw), {k.lower(): v for k, v in V.JOIN_TYPES.items()}, "")


def reason_text(reason: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in V.REASON_TEXT.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, reason), reason)


def split_uri(uri: Column) -> tuple[Column, Column]:
    """(schema, table) of ``SCHEMA/TABLE``, cut at the first ``/``."""
    uri = F.trim(F.coalesce(uri, F.lit("")))
    schema = F.substring_index(uri, "/", 1)
    return schema, F.substring(uri, F.char_length(schema) + 2, F.char_length(uri))
