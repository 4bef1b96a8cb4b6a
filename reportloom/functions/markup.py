"""HTML to plain text as one chain of built-in string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportloom.functions.text import strip

# Fixed values: (pattern, replacement), applied in this order.
HTML_RULES = [
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?is)<head\b.*?</head\s*>", ""),
    (r"(?i)<li\b[^>]*>", "\n- "),
    (r"(?i)<br\b[^>]*>", "\n"),
    (r"(?i)</?(?:address|article|aside|blockquote|body|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|html"
     r"|main|nav|ol|p|pre|section|table|tr|ul)\b[^>]*>", "\n"),
    (r"(?i)</t[dh]\s*>", "\t"),
    (r"<[^>]*>", ""),
]
# Named characters; the ampersand comes last so that nothing is decoded twice.
ENTITIES = [
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&copy;", "©"), ("&reg;", "®"),
    ("&trade;", "™"), ("&middot;", "·"), ("&bull;", "•"), ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&laquo;", "«"), ("&raquo;", "»"), ("&deg;", "°"), ("&times;", "×"), ("&plusmn;", "±"),
]
SPACE_RULES = [(r"[ \t\r\f]+", " "), (r" ?\n ?", "\n"), (r"\n{3,}", "\n\n")]


def _numeric(text: Column) -> Column:
    """Decode &#65; and &#x41; forms, each distinct one once."""

    def decode(acc: Column, entity: Column) -> Column:
        body = F.lower(F.substring(entity, F.lit(3), F.length(entity) - 3))
        code = F.when(body.startswith("x"), F.conv(F.ltrim(body, F.lit("x")), 16, 10)).otherwise(body).cast("bigint")
        ok = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(ok, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")
        return F.replace(acc, entity, char)

    pattern = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.when(text.contains("&#"), F.aggregate(found, text, decode)).otherwise(text)


def html_to_text(html: Column) -> Column:
    out = F.coalesce(html, F.lit(""))
    for pattern, new in HTML_RULES:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(new))
    out = _numeric(out)
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    out = F.replace(out, F.lit("&amp;"), F.lit("&"))
    for pattern, new in SPACE_RULES:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(new))
    return F.when(html.isNotNull(), strip(out))
