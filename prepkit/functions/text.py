"""Text expressions: words, word pieces, and the printed form of a cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^ \t\n\x0B\f\r]+"


def words(text: Column | str) -> Column:
    """Maximal runs of non-blank characters, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def cut_word(word: Column, width: int) -> Column:
    """Consecutive pieces of at most ``width`` characters; none of an empty or missing word."""
    starts = F.sequence(F.lit(1), F.length(word), F.lit(width))
    return (
        F.when(F.length(word) > width, F.transform(starts, lambda s: F.substr(word, s, F.lit(width))))
        .when(F.length(word) > 0, F.array(word))
        .otherwise(F.array().cast("array<string>"))
    )


def text_pieces(text: Column | str, width: int) -> Column:
    """Pieces of all words of a text in one pass: no piece crosses a blank."""
    return F.regexp_extract_all(text, F.lit(f"{WORD[:-1]}{{1,{width}}}"), F.lit(0))


def piece_word_ids(tokens: Column, width: int | None) -> Column:
    """For each piece of each word, the 0-based index of the word it came from.

    Empty and missing words have no pieces.
    """
    if width is None:
        at = F.transform(tokens, lambda w, i: F.when(F.length(w) > 0, i))
        return F.filter(at, lambda i: i.isNotNull())
    count = lambda w: F.coalesce(F.ceil(F.length(w) / F.lit(width)).cast("int"), F.lit(0))
    return F.flatten(F.transform(tokens, lambda w, i: F.array_repeat(i, count(w))))


def pieces(tokens: Column, width: int | None) -> Column:
    """The words that are not empty, or all words cut into pieces."""
    if width is None:
        return F.filter(tokens, lambda w: F.length(w) > 0)
    return F.flatten(F.transform(tokens, lambda w: cut_word(w, width)))


# Characters Python prints escaped inside a string (everything it calls not printable).
UNPRINTABLE = r"[\p{Cc}\p{Cf}\p{Co}\p{Cn}\p{Cs}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"


def _escape_char(char: Column) -> Column:
    code = F.ascii(char)
    digits = F.lower(F.hex(code.cast("long")))
    numbered = (
        F.when(code <= 0xFF, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(code <= 0xFFFF, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )
    return (
        F.when(char == "\n", F.lit("\\n"))
        .when(char == "\r", F.lit("\\r"))
        .when(char == "\t", F.lit("\\t"))
        .when(char.rlike(UNPRINTABLE), numbered)
        .otherwise(char)
    )


def _quoted(value: Column) -> Column:
    escaped = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    escaped = F.when(
        value.rlike(UNPRINTABLE),
        F.array_join(F.transform(F.split(escaped, ""), _escape_char), ""),
    ).otherwise(escaped)
    has_single = F.contains(value, F.lit("'"))
    has_double = F.contains(value, F.lit('"'))
    return (
        F.when(has_single & ~has_double, F.concat(F.lit('"'), escaped, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def _float_text(value: Column) -> Column:
    """A number as Python prints a float: the shortest digits, an exponent from 1e16 on and below 1e-4."""
    size = F.abs(value)
    forms = [F.format_string(f"%.{n}e", size) for n in range(17)]
    # The first form that reads back as the same number has the fewest digits.
    text = F.coalesce(*[F.when(f.cast("double") == size, f) for f in forms])
    exponent = F.regexp_extract(text, "e([+-][0-9]+)$", 1).try_cast("int")
    mantissa = F.regexp_replace(F.regexp_replace(text, "e.*$", ""), r"\.", "")
    digits = F.regexp_replace(mantissa, "(?<=.)0+$", "")
    padded = F.rpad(digits, F.greatest(exponent + 1, F.length(digits)), F.lit("0"))
    rest = F.substr(padded, exponent + 2)
    large = F.concat(F.substr(padded, F.lit(1), exponent + 1), F.lit("."), F.when(rest == "", F.lit("0")).otherwise(rest))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    point = F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise("")
    power = F.abs(exponent).cast("string")
    power = F.concat(F.when(exponent < 0, F.lit("e-")).otherwise("e+"), F.when(F.length(power) < 2, F.lit("0")).otherwise(""), power)
    shown = (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.lit("inf"))
        .when(exponent.between(0, 15), large)
        .when(exponent.between(-4, -1), small)
        .otherwise(F.concat(F.substr(digits, F.lit(1), F.lit(1)), point, power))
    )
    negative = F.startswith(value.cast("string"), F.lit("-"))
    return F.when(value.isNotNull(), F.concat(F.when(negative, F.lit("-")).otherwise(""), shown))


def _printed(value: Column, dtype: T.DataType, inner: bool) -> Column:
    if isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda v: _printed(v, dtype.elementType, True))
        shown = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.StringType):
        shown = _quoted(value) if inner else value
    elif isinstance(dtype, T.BooleanType):
        shown = F.initcap(value.cast("string"))
    elif isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        shown = _float_text(value.cast("double"))
    elif isinstance(dtype, T.IntegralType):
        shown = value.cast("string")
    else:
        raise ValueError(f"a cell of type {dtype.simpleString()} has no printed form here")
    return F.coalesce(shown, F.lit("None"))


def to_text(value: Column, dtype: T.DataType, mode: str = "repr") -> Column:
    """A cell as caption text.

    ``repr`` prints lists the way Python does, with quotes and escapes, and a missing cell as
    ``None``; ``join`` puts the elements of a list side by side with ", ".
    """
    if mode not in ("repr", "join"):
        raise ValueError(f"unknown caption mode {mode!r}; use repr or join")
    if mode == "join" and isinstance(dtype, T.ArrayType):
        return F.array_join(value.cast("array<string>"), ", ")
    return _printed(value, dtype, False)
