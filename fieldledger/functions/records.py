"""JSON records: one object per line with the keys of `RECORD_KEYS`."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv


def encode_record(system: Column, instruction: Column, output: Column, input_text: Column | None = None) -> Column:
    """Compact JSON object with the four record keys; NULL without instruction or output."""
    fields = F.struct(
        system.alias("system"),
        instruction.alias("instruction"),
        (F.lit("") if input_text is None else input_text).alias("input"),
        output.alias("output"),
    )
    return F.when(instruction.isNotNull() & output.isNotNull(), F.to_json(fields))


def encode_record_spaced(system: Column, instruction: Column, output: Column, input_text: Column | None = None) -> Column:
    """The same object with a space after each comma and colon."""
    values = {
        "system": system,
        "instruction": instruction,
        "input": F.lit("") if input_text is None else input_text,
        "output": output,
    }
    parts = []
    for key, value in values.items():
        pair = F.to_json(F.struct(value.alias(key)))  # {"key":"text"}
        head = len(key) + 4
        quoted = F.substring(pair, F.lit(head + 1), F.length(pair) - F.lit(head + 1))
        parts.append(F.concat(F.lit(f'"{key}": '), quoted))
    line = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    return F.when(instruction.isNotNull() & output.isNotNull(), line)


PARSED = "_json"
_LINES, _END, _BROKEN = "lines", "end_of_line", "_broken"


def _enclosed(line: Column) -> Column:
    """The line as the first of two array elements, the second of which marks its end."""
    return F.concat(F.lit(f'{{"{_LINES}":['), line, F.lit(f',{{"{_END}":0}}]}}'))


def parse_line(line: Column, keys: Sequence[str]) -> Column:
    """The keys of a JSON line, typed, and a field that tells whether anything is broken.

    The line is read inside an enclosing object, so text after its own end
    cannot pass unseen. Numbers, NULL and nested values keep their type as
    variants; of a repeated key the last one counts.
    """
    fields = ", ".join(f"{key}: variant" for key in (*keys, _END))
    return F.from_json(
        _enclosed(line),
        f"{_LINES} array<struct<{fields}>>, {_BROKEN} string",
        {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": _BROKEN},
    )


class DecodedRecord:
    """Field access to one parsed JSON line with the type checks that strings would lose.

    A key that is missing reads as `''`; a line that is no JSON object, or a
    value that is no string, reads as NULL.
    """

    def __init__(self, line: Column, parsed: Column):
        elements = parsed[_LINES]
        self._record = F.get(elements, F.lit(0))
        ended = F.get(elements, F.lit(1))[_END].isNotNull() & (F.size(elements) == 2)
        whole = parsed[_BROKEN].isNull() & ended
        self.is_object = F.coalesce(whole & self._record.isNotNull(), F.lit(False))
        # An object is not read again: Spark works out what both parts of `other` share before
        # it knows whether it needs them.
        self.is_json = self.is_object | self._is_other_json(F.when(~self.is_object, line))

    @staticmethod
    def _is_other_json(line: Column) -> Column:
        other = F.try_parse_json(_enclosed(line))
        second, third = (F.try_variant_get(other, f"$.{_LINES}[{i}]", "variant") for i in (1, 2))
        return second.isNotNull() & third.isNull()

    def _kind(self, key: str) -> Column:
        return F.schema_of_variant(self._record[key])

    def has_text_or_nothing(self, key: str) -> Column:
        """True where the key is missing or holds a string."""
        return self.is_object & F.coalesce(self._kind(key) == "STRING", F.lit(True))

    def has_key(self, key: str) -> Column:
        return self.is_object & self._kind(key).isNotNull()

    def number(self, key: str) -> Column:
        """The value as a double, or NULL where it is none; numbers in quotes count."""
        return F.when(self.is_object, F.try_variant_get(self._record[key], "$", "double"))

    def given_text(self, key: str) -> Column:
        """The string of the key; NULL where the key is missing or holds something else."""
        return F.when(self.has_key(key), self.text(key))

    def text(self, key: str) -> Column:
        value = F.try_variant_get(self._record[key], "$", "string")
        return F.when(self.has_text_or_nothing(key), F.coalesce(value, F.lit("")))


def decoded(
    lines: DataFrame, column: str = "value", keys: Sequence[str] = fv.REQUIRED_RECORD_KEYS
) -> tuple[DataFrame, DecodedRecord]:
    """The lines with their parsed form in a column of its own, and access to its keys.

    Being a column, it is made once per line however often it is read.
    """
    parsed = lines.withColumn(PARSED, parse_line(F.col(column), keys))
    return parsed, DecodedRecord(F.col(column), F.col(PARSED))


def record_columns(record: DecodedRecord) -> dict[str, Column]:
    """The keys of a record: instruction and output are empty where their key is missing, the
    others NULL. A line that is no record (`unread_kind`) has NULL everywhere."""
    sound = unread_kind(record).isNull()
    value = {k: record.text(k) if k in fv.REQUIRED_RECORD_KEYS else record.given_text(k) for k in fv.RECORD_KEYS}
    return {key: F.when(sound, column) for key, column in value.items()}


def unread_kind(record: DecodedRecord) -> Column:
    """Why a line is no record: one object on its line whose instruction and output are texts.

    NULL for a record.
    """
    texts = record.has_text_or_nothing("instruction") & record.has_text_or_nothing("output")
    return F.when(~record.is_json, "not_json").when(~record.is_object, "not_object").when(~texts, "not_text")
