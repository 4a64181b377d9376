"""Value tests for type inference and column-name normalisation, as Column expressions.

The class of a value is decided by the first test that passes, in the order
INT64, BOOL, BIGNUMERIC, TIMESTAMP, DATE, else STRING. All tests run on the
value trimmed of surrounding whitespace; null tokens are removed before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
NULL_TOKENS = ["", "null", "none"]
BOOL_TOKENS = ["true", "false", "yes", "no", "1", "0"]
INT_PATTERN = r"^[+-]?[0-9]+$"
LEADING_ZERO_PATTERN = r"^0[0-9]"
NUMERIC_PATTERN = r"(?i)^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?|inf(inity)?|nan)$"
TIMESTAMP_PATTERN = r"^[0-9]{4}(-[0-9]{2}-|/[0-9]{2}/)[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?$"
DATE_PATTERN = r"^[0-9]{4}(-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}$"
# Characters mapped to "_" and characters dropped in column names.
NAME_TO_UNDERSCORE = " .-/("
NAME_DROPPED = ")?:"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ASCII whitespace: space, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE = " \t\n\x0b\f\r"


def strip_ws(v: Column | str) -> Column:
    """Trim leading/trailing ASCII whitespace: a character-set trim, no regex per cell."""
    return F.trim(_c(v), F.lit(WHITESPACE))


def null_if_token(v: Column | str) -> Column:
    """Trimmed value, or NULL for '', 'null', 'none' in any case."""
    t = strip_ws(v)
    return F.when(~F.lower(t).isin(*NULL_TOKENS), t)


def is_int64(v: Column | str) -> Column:
    """Whole number in the signed 64-bit range, no leading zero ("00123" fails, "-007" passes)."""
    t = _c(v)
    return t.rlike(INT_PATTERN) & ~t.rlike(LEADING_ZERO_PATTERN) & t.try_cast("bigint").isNotNull()


def is_bool(v: Column | str) -> Column:
    return F.lower(_c(v)).isin(*BOOL_TOKENS)


def is_numeric(v: Column | str) -> Column:
    return _c(v).rlike(NUMERIC_PATTERN)


def is_timestamp(v: Column | str) -> Column:
    return _c(v).rlike(TIMESTAMP_PATTERN)


def is_date(v: Column | str) -> Column:
    return _c(v).rlike(DATE_PATTERN)


_SIGNS = [ord(c) for c in "+-"]
_BOOL_STARTS = sorted({ord(c) for token in BOOL_TOKENS for c in (token[0], token[0].upper())})
_NUMERIC_STARTS = [ord(c) for c in "+-.iInN"]
CLASS_NAMES = ["STRING", "INT64", "BOOL", "BIGNUMERIC", "TIMESTAMP", "DATE"]  # index = class code


def class_code(v: Column | str, leading_zero: str = "decimal") -> Column:
    """Class of one cleaned value as a small int (index into ``CLASS_NAMES``); NULL stays NULL.

    ``leading_zero='decimal'`` keeps the reference's outcome ("00123" fails the
    int test and then passes the number test); ``'string'`` keeps such IDs text.
    """
    t = _c(v)
    numeric = is_numeric(t)
    if leading_zero == "string":
        numeric = numeric & ~t.rlike(r"^[+-]?0[0-9]")
    first = F.ascii(t)  # every test but is_bool is anchored, so the first character rules most out
    digit = first.between(48, 57)
    return (
        F.when(t.isNull(), F.lit(None).cast("int"))
        .when((digit | first.isin(*_SIGNS)) & is_int64(t), F.lit(1))
        .when(first.isin(*_BOOL_STARTS) & is_bool(t), F.lit(2))
        .when((digit | first.isin(*_NUMERIC_STARTS)) & numeric, F.lit(3))
        .when(digit & is_timestamp(t), F.lit(4))
        .when(digit & is_date(t), F.lit(5))
        .otherwise(F.lit(0))
    )


#: As Java's ``$``: one line terminator may follow. ``(?i)`` in ASCII, spelled out.
_END = r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])?$"
_ARROW_NUMERIC = NUMERIC_PATTERN.removeprefix("(?i)").replace("(e[", "([eE][").replace("inf(inity)?", "[iI][nN][fF]([iI][nN][iI][tT][yY])?").replace("nan", "[nN][aA][nN]")
_ARROW_TESTS = [(code, p.removesuffix("$") + _END) for code, p in ((3, _ARROW_NUMERIC), (4, TIMESTAMP_PATTERN), (5, DATE_PATTERN))]
_INT64_DIGITS = 18  # that fit in any case


def class_counts(cells: pa.Array, leading_zero: str = "decimal") -> np.ndarray:
    """Cells of each class, index as in ``CLASS_NAMES``, of an Arrow array of raw text: what ``class_code``
    of ``null_if_token`` gives, null tokens left out. Each distinct value is tested once."""
    return class_counts_of(cells, np.zeros(len(cells), np.int64), 1, leading_zero)[0]


def class_counts_of(cells: pa.Array, group: np.ndarray, n_groups: int, leading_zero: str = "decimal") -> np.ndarray:
    """The same for each group of cells, one row a group."""
    found = pc.dictionary_encode(cells, null_encoding="encode")
    codes = _codes_of(found.dictionary, leading_zero)[found.indices.to_numpy()]
    width = len(CLASS_NAMES)
    known = codes >= 0
    return np.bincount(group[known] * width + codes[known], minlength=n_groups * width).reshape(n_groups, width)


def _codes_of(values: pa.Array, leading_zero: str) -> np.ndarray:
    """The class code of each value, -1 for a null token."""
    text = pc.utf8_trim(values, characters=WHITESPACE)
    lower = pc.utf8_lower(text)
    keep = pc.fill_null(pc.invert(pc.is_in(lower, value_set=pa.array(NULL_TOKENS, text.type))), False)
    keep = pc.and_(keep, pc.is_valid(text))
    text, lower = text.filter(keep), lower.filter(keep)
    codes = np.zeros(len(text), np.int64)

    def match(some: pa.Array, pattern: str) -> np.ndarray:
        return pc.match_substring_regex(some, pattern).to_numpy(zero_copy_only=False).astype(bool)

    whole = match(text, INT_PATTERN) & ~match(text, LEADING_ZERO_PATTERN)
    for i in np.flatnonzero(whole & (pc.utf8_length(text).to_numpy() > _INT64_DIGITS)).tolist():
        whole[i] = -(1 << 63) <= int(text[i].as_py()) < 1 << 63
    codes[whole] = 1
    is_token = pc.is_in(lower, value_set=pa.array(BOOL_TOKENS, text.type)).to_numpy(zero_copy_only=False).astype(bool)
    codes[~whole & is_token] = 2
    for code, pattern in _ARROW_TESTS:
        left = np.flatnonzero(codes == 0)
        some = text.take(pa.array(left))
        hit = match(some, pattern)
        if code == 3 and leading_zero == "string":
            hit &= ~match(some, r"^[+-]?0[0-9]")
        codes[left[hit]] = code
    out = np.full(len(values), -1)
    out[keep.to_numpy(zero_copy_only=False).astype(bool)] = codes
    return out


def value_class(v: Column | str, leading_zero: str = "decimal") -> Column:
    """Class name of one cleaned value (INT64, BOOL, BIGNUMERIC, TIMESTAMP, DATE, STRING); NULL stays NULL."""
    code = class_code(v, leading_zero)
    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    return F.when(code.isNotNull(), F.element_at(names, code + 1))


def normalize_name(name: Column | str) -> Column:
    """One header cell to a lower-case, warehouse-safe name (no de-duplication)."""
    n = _c(name)
    n = F.translate(n, NAME_TO_UNDERSCORE, "_" * len(NAME_TO_UNDERSCORE))
    n = F.translate(n, NAME_DROPPED, "")
    return F.lower(n)


def normalize_names(names: Column | str) -> Column:
    """Header array to normalised names; a repeat gets the smallest free ``_1``, ``_2``... suffix.

    A fold over the array keeps the names emitted so far, so ``id,a,id,id_1,id``
    becomes ``id,a,id_1,id_1_1,id_2``.
    """
    arr = F.transform(_c(names), normalize_name)

    def step(acc: Column, x: Column) -> Column:
        free = F.filter(
            F.sequence(F.lit(1), F.size(acc) + 1),
            lambda s: ~F.array_contains(acc, F.concat(x, F.lit("_"), s.cast("string"))),
        )
        chosen = F.when(
            F.array_contains(acc, x), F.concat(x, F.lit("_"), F.array_min(free).cast("string"))
        ).otherwise(x)
        return F.concat(acc, F.array(chosen))

    return F.aggregate(arr, F.array().cast("array<string>"), step)
