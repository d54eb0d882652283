"""Character references of HTML, decoded as column expressions by the rules of the standard."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what may be a reference; the standard's names end by themselves or by a semicolon.
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACEMENT = "\ufffd"
#: The references that make up nearly all of those in pages: they are told without the whole table.
FREQUENT = ("nbsp;", "amp;", "lt;", "gt;", "quot;")


def _table(names: dict[str, str]) -> Column:
    """A map as one JSON text, which the optimizer turns into one constant."""
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _windows(code: int) -> str:
    """The numbers 128 to 159 stand for the characters that they are in the Windows code page, if they are any."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def _numeric(ref: Column) -> Column:
    digits = F.rtrim(F.substring(ref, 2, 1 << 20), F.lit(";"))
    bare = F.ltrim(F.substring(digits, 2, 1 << 20), F.lit("0"))
    hexadecimal = F.when(F.length(bare) <= 6, F.coalesce(F.conv(F.concat(F.lit("0"), bare), 16, 10).try_cast("long"), F.lit(0)))
    code = F.when(digits.rlike("^[xX]"), hexadecimal).otherwise(digits.try_cast("long"))  # NULL: too great a number
    special = _table({str(c): _windows(c) for c in range(0x80, 0xA0)} | {"0": REPLACEMENT, "13": "\r"})
    nothing = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code.isNull() | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit(REPLACEMENT))
        .when((code == 0) | (code == 13) | code.between(0x80, 0x9F), F.try_element_at(special, code.cast("string")))
        .when(nothing, F.lit(""))
        .otherwise(plain)
    )


def _named(ref: Column) -> Column:
    """A name as a whole, else its longest beginning that is a name without a semicolon, else as it stands."""
    out = F.when(F.lit(False), F.lit(""))
    for name in FREQUENT:
        out = out.when(ref == name, F.lit(html5[name]))
    whole = F.try_element_at(_table(html5), ref)
    open_names = _table({k: v for k, v in html5.items() if not k.endswith(";")})
    ends = F.when(F.length(ref) >= 3, F.sequence(F.length(ref) - 1, F.lit(2), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    first = F.get(F.filter(ends, lambda n: F.try_element_at(open_names, F.substring(ref, F.lit(1), n)).isNotNull()), F.lit(0))
    begun = F.concat(F.try_element_at(open_names, F.substring(ref, F.lit(1), first)), F.substring(ref, first + 1, F.length(ref)))
    return out.otherwise(F.coalesce(whole, begun, F.concat(F.lit("&"), ref)))


def unescaped(text: Column) -> Column:
    """The text with its references decoded; texts without any are left alone."""
    between = F.split(text, REFERENCE, -1)
    decoded = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)), lambda r: F.when(F.startswith(r, F.lit("#")), _numeric(r)).otherwise(_named(r)))
    joined = F.array_join(F.flatten(F.zip_with(between, decoded, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)
