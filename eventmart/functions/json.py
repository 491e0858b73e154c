"""JSON access: path to text, many paths in one pass, and string-only extraction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _keys(path: str) -> list[str]:
    if not path.startswith("$."):
        raise ValueError(f"not an object path: {path}")
    return path[2:].split(".")


def _struct(paths: list[list[str]]) -> T.StructType:
    nested: dict[str, list[list[str]]] = {}
    for head, *rest in paths:
        nested.setdefault(head, []).append(rest)
    fields = []
    for head, rests in nested.items():
        if any(rests) and not all(rests):
            raise ValueError(f"path is both a value and an object: {head}")
        fields.append(T.StructField(head, _struct(rests) if all(rests) else T.StringType()))
    return T.StructType(fields)


def parse_paths(column: str | Column, paths: list[str]) -> Column:
    """Parse a JSON text once, keeping only the given paths, as a nested struct of text."""
    return F.from_json(column, _struct([_keys(p) for p in paths]))


def at_path(parsed: str, path: str) -> Column:
    """The text at a path of a column made by `parse_paths`."""
    return F.col(".".join([parsed, *(f"`{k}`" for k in _keys(path))]))


def select_paths(parsed: str, fields: Mapping[str, str]) -> list[Column]:
    """Named columns for the paths of a column made by `parse_paths`."""
    return [at_path(parsed, path).alias(name) for name, path in fields.items()]


def json_get(column: str | Column, path: str) -> Column:
    """The value at a JSON path as text; null if absent or JSON null. Of a repeated key, the last counts."""
    value = parse_paths(column, [path])
    for key in _keys(path):
        value = value.getField(key)
    return value


def normalised(text: str | Column) -> Column:
    """A JSON text without the white space between its values."""
    return F.get_json_object(text, "$")


def once(column: Column) -> Column:
    """Keep an expensive column from being computed again by every filter and column that uses it.

    Catalyst moves filters below a projection by repeating its expressions, but not below a generator.
    """
    return F.explode(F.array(column))


# Follows a text while it is parsed, to tell whether the parser took all of it. Its value is a digest of the
# text, which no text can hold.
_END = "end-of-text"


def is_whole_json(text: str | Column) -> Column:
    """Is the whole text one JSON value? The parser alone stops after the first one."""
    value = F.col(text) if isinstance(text, str) else text
    mark = F.md5(value)
    pair = F.try_parse_json(F.concat(F.lit("["), value, F.lit(',"'), mark, F.lit('"]')))
    return F.coalesce(F.try_variant_get(pair, "$[1]", "string") == mark, F.lit(False))


def with_strings(rows: DataFrame, text: str, fields: Mapping[str, str], is_object: str) -> DataFrame:
    """Add the values at paths of a JSON text, kept only where they are JSON strings.

    Casts would turn numbers and objects into text, so the type is tested first. A path is null where
    a parent is not an object. The column named by `is_object` tells whether the whole text is valid
    UTF-8 and one JSON object; all values are null where it is not.

    The text is parsed once, and only the keys the paths begin with are kept.
    """
    tops = list(dict.fromkeys(_keys(path)[0] for path in fields.values()))
    element = ", ".join([*(f"`{top}`: VARIANT" for top in tops), f"`{_END}`: STRING"])
    # An array of the text and a mark: it has two elements, and the mark is the second.
    mark = F.md5(F.col(text))
    marked = F.concat(F.lit("["), F.col(text), F.lit(f',{{"{_END}":"'), mark, F.lit('"}]'))
    pair = F.from_json(marked, f"array<struct<{element}>>")
    first, second = F.get("_pair", F.lit(0)), F.get("_pair", F.lit(1))
    is_whole = (F.size("_pair") == 2) & (second.getField(_END) == mark) & first.isNotNull()

    def value(path: str) -> Column:
        top, *rest = _keys(path)
        found = first.getField(top)
        return F.try_variant_get(found, ".".join(["$", *rest]), "variant") if rest else found

    def string(name: str) -> Column:
        found = F.col(f"_found.{name}")
        return F.when(F.schema_of_variant(found) == "STRING", found.cast("string"))

    found = F.struct(*[value(path).alias(name) for name, path in fields.items()])
    return (
        rows.withColumn("_pair", once(F.when(F.is_valid_utf8(text), pair)))
        .withColumn(is_object, F.coalesce(is_whole, F.lit(False)))
        .withColumn("_found", once(F.when(F.col(is_object), found)))
        .withColumns({name: string(name) for name in fields})
        .drop("_pair", "_found")
    )
