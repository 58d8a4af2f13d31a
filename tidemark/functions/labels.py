"""Label text: line splitting and the line grammar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import BLANK_CHARS

# Line separators, blank characters and number spelling of the label grammar.
LINE_SEPARATOR = "\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x85\\u2028\\u2029]"
BLANK = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_NUMBER = (
    r"[+-]?(?:(?:\d++(?:_\d+)*+\.?(?:\d+(?:_\d+)*+)?|\.\d+(?:_\d+)*+)(?:e[+-]?\d+(?:_\d+)*+)?"
    r"|inf(?:inity)?|nan)"
)
NUMBER = rf"(?i)^{_NUMBER}\z"
MIN_FIELDS = 5
# Plain lines, nearly all of them: decimal numbers between spaces, with room for a polygon. They
# are valid after one search; the tests below then need not run. The bound keeps the search flat.
_DECIMAL = r"[+-]?(?:\d++(?:\.\d*+)?|\.\d++)(?:[eE][+-]?\d++)?"
_PLAIN = rf"^[ \t]*+{_DECIMAL}(?:[ \t]++{_DECIMAL}){{{MIN_FIELDS - 1},64}}+[ \t]*+\z"
# The two tests a line must pass, each one search over the text: a blank-separated token that is
# no number, and the fifth token. Neither repeats a group per token, so long polygons are safe.
_NOT_NUMBER = rf"(?i)(?<![^{BLANK}])(?!{_NUMBER}(?![^{BLANK}]))[^{BLANK}]"
_ENOUGH_FIELDS = rf"^[{BLANK}]*+(?:[^{BLANK}]++[{BLANK}]++){{{MIN_FIELDS - 1}}}[^{BLANK}]"

# Finding codes and messages of the label rules.
INVALID_LABEL = "invalid_yolo_label"
INVALID_CLASS = "invalid_yolo_class"
UNKNOWN_CLASS = "unknown_yolo_class"
FIELDS_MESSAGE = "YOLO label rows must contain class plus coordinates"
NUMBER_MESSAGE = "YOLO label rows must be numeric"
NEGATIVE_MESSAGE = "YOLO class id must be non-negative"
UNKNOWN_MESSAGE = "YOLO class id is outside declared class names"


def split_lines(text: Column) -> Column:
    """All lines of a text, blank ones included."""
    return F.split(text, LINE_SEPARATOR)


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{BLANK}]")


def label_tokens(raw: Column) -> Column:
    """Tokens between blanks. Blanks become spaces first: Spark compiles any longer split pattern
    again for every row."""
    spaced = F.translate(raw, BLANK_CHARS, " " * len(BLANK_CHARS))
    return F.array_remove(F.split(spaced, " "), "")


def to_number(token: Column) -> Column:
    """Double value of a number token, NULL for anything else.

    Spark's own cast takes ``1f`` and ``0x1p3`` and refuses ``1_0``, so the spelling is checked
    first. A token of the right spelling that the cast refuses can only be a signed nan.
    """
    value = F.replace(token, F.lit("_"), F.lit("")).try_cast("double")
    return F.when(token.rlike(NUMBER), F.coalesce(value, F.lit(float("nan"))))


def label_numbers(tokens: Column) -> Column:
    return F.transform(tokens, to_number)


def label_coords(raw: Column) -> Column:
    """Numbers of a valid line after its class. The spelling was checked before, so one cast of
    the whole array does, but for signed nan, which the cast refuses."""
    tokens = label_tokens(F.replace(raw, F.lit("_"), F.lit("")))
    rest = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.when(raw.rlike("(?i)[+-]nan"), label_numbers(rest)).otherwise(
        rest.try_cast("array<double>")
    )


def line_facts(raw: Column) -> Column:
    """Struct of ``plain`` (a line that is valid by one look) and ``first``, the first token as a
    double."""
    token = F.replace(F.regexp_extract(raw, f"[^{BLANK}]+", 0), F.lit("_"), F.lit(""))
    return F.struct(raw.rlike(_PLAIN).alias("plain"), token.try_cast("double").alias("first"))


def is_short(raw: Column, plain: Column) -> Column:
    """Fewer tokens than a class and its coordinates."""
    return ~plain & ~raw.rlike(_ENOUGH_FIELDS)


def is_odd(raw: Column, plain: Column) -> Column:
    """Some token is no number."""
    return ~plain & raw.rlike(_NOT_NUMBER)


def class_value(odd: Column, first: Column) -> Column:
    """Class of a line as a double; NULL when any token is no number or the class not finite."""
    finite = ~F.isnan(first) & (F.abs(first) < float("inf"))
    return F.when(~odd & finite, first)


def label_code(short: Column, value: Column) -> Column:
    """Finding code of a line, NULL when it is valid."""
    return F.when(short | value.isNull(), INVALID_LABEL).when(value <= -1.0, INVALID_CLASS)


def label_message(short: Column, value: Column) -> Column:
    return (
        F.when(short, FIELDS_MESSAGE)
        .when(value.isNull(), NUMBER_MESSAGE)
        .when(value <= -1.0, NEGATIVE_MESSAGE)
    )


def parse_label_line(raw: Column) -> Column:
    """Struct of ``code``, ``message`` (NULL for a valid line), ``class_value``, ``class_id`` and
    ``coords`` of one non-blank line. Class ids beyond bigint keep ``class_value`` only.

    Over many lines use ``operators.verify.parse_labels``, which searches each line once.
    """
    facts = line_facts(raw)
    short = is_short(raw, facts["plain"])
    value = class_value(is_odd(raw, facts["plain"]), facts["first"])
    usable = ~short & value.isNotNull()
    return F.struct(
        label_code(short, value).alias("code"),
        label_message(short, value).alias("message"),
        F.when(usable, value).alias("class_value"),
        F.when(usable, value.try_cast("bigint")).alias("class_id"),
        F.when(usable, label_coords(raw)).alias("coords"),
    )
