"""Text columns: trimming, previews, plain text of markup, e-mail addresses."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything a full-Unicode trim removes; the built-in trim drops only spaces.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# starts only where a run of address characters starts, and never gives characters back: one pass over the text
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
_SPECIAL = {"nbsp": " "}  # a break that running text treats as a space
_NAMES = "\n".join(f"{name}\t{_SPECIAL.get(name, chr(code))}" for name, code in name2codepoint.items())
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def preview(text: Column, width: int = 200) -> Column:
    """The first ``width`` characters, marked with dots when something was cut."""
    return F.when(F.length(text) > width, F.concat(F.left(text, F.lit(width)), F.lit("..."))).otherwise(text)


def cut(text: Column, width: int) -> Column:
    return F.left(text, F.lit(width))


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """A regex group, NULL (not '') when the pattern does not occur."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def first_email(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("@")), matched(text, EMAIL, 0))


def mailto_address(html: Column) -> Column:
    return matched(html, r"(?i)href\s*=\s*[\"']mailto:([^\"']*)", 1)


def decoded(text: Column) -> Column:
    """Character references, decimal, hexadecimal or by a name of HTML 4, as their characters; unknown ones stay.

    The text is cut at its references and each is read once, so an escaped
    reference is not decoded twice.
    """
    names = F.str_to_map(F.lit(_NAMES), F.lit("\n"), F.lit("\t"))  # a constant: the plan holds it folded

    def character(code: Column) -> Column:
        """The character of a code; NULL outside the range of characters."""
        good = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        return F.when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def read(part: Column) -> Column:
        name = F.substring(part, 2, 32)
        body = F.regexp_extract(part, "^&#?[xX]?([^;]*);$", 1)
        found = (
            F.when(part.rlike("^&#[xX][0-9A-Fa-f]+;$"), character(F.conv(body, 16, 10).cast("bigint")))
            .when(part.rlike("^&#[0-9]+;$"), character(body.cast("bigint")))
            .when(part.rlike("^&[A-Za-z0-9]+;$"), F.try_element_at(names, F.rtrim(name, F.lit(";"))))
        )
        return F.coalesce(found, part)

    parts = F.regexp_extract_all(text, F.lit(f"{_REFERENCE}|[^&]+|&"), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, read), "")).otherwise(text)


def label_text(html: Column) -> Column:
    """Text of a short piece of markup on one line: tags vanish, references are decoded."""
    return strip(decoded(F.regexp_replace(html, r"(?s)<[^>]*>", "")))


def plain_text(html: Column) -> Column:
    """Visible text of a page, one line per text run, without leaving the JVM."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>", "")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", "\n")
    text = decoded(text)
    text = F.regexp_replace(text, r"[ \t\r\x0b\f ]*\n[\s ]*", "\n")
    return strip(text)
