"""String functions: text clean-up, price/brand/category extraction from
captured product pages, URL ids and the encoded category list.

All are built-in Spark expressions (Java regex); the patterns are also valid
RE2, so the SQL oracle can evaluate the same rules.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the capture rules of the original pipeline.
# Price: first "digits,digits" group; unit label: from the euro sign to the end;
# discount: a whole number followed by a percent sign; brand: the second
# capitalised word of the product title; product URLs contain "/p/<digits>".
PRICE_PATTERN = r"\d+,\d+"
UNIT_LABEL_PATTERN = r"€.+$"
DISCOUNT_PATTERN = r"\b(\d+)%"
BRAND_PATTERN = r"[A-Z][\p{L}\p{N}_]+"
PRODUCT_URL_PATTERN = r".+/p/\d+"
# ---------------------------------------------------------------------------

# Thousands-aware alternative to PRICE_PATTERN: "1.234,56" -> 1234.56.
PRICE_PATTERN_THOUSANDS = r"\d{1,3}(?:\.\d{3})*,\d+|\d+,\d+"

_EDGE_SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_all(col) -> Column:
    """Strip leading/trailing whitespace of any kind (Python ``str.strip``);
    Spark's ``trim`` only removes spaces."""
    return F.regexp_replace(_c(col), _EDGE_SPACE, "")


#: the characters of ``_EDGE_SPACE``
_SPACES = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def trim_decoded(col) -> Column:
    """``trim_all`` of text that a reader decoded (no invalid bytes), without an expression at work on
    every value; one that ends with a next-line character, before which an expression's ``$`` matches, gets it."""
    c = _c(col)
    return F.when(~F.endswith(c, F.lit("\x85")), F.btrim(c, F.lit(_SPACES))).otherwise(trim_all(c))


def clean_text(col) -> Column:
    """Drop CR/LF/TAB, turn commas into dots, strip surrounding whitespace."""
    c = F.regexp_replace(_c(col), r"[\r\n\t]", "")
    c = F.replace(c, F.lit(","), F.lit("."))
    return trim_all(c)


def brand_token(col) -> Column:
    """Brand = second capitalised word of the cleaned title; null if fewer than two.

    Unicode letters count as word characters (``Nestlé`` stays whole)."""
    return F.get(F.regexp_extract_all(clean_text(col), F.lit(BRAND_PATTERN), 0), 1)


def first_match_price(col, pattern: str = PRICE_PATTERN) -> Column:
    """First decimal-comma number in the text as double; null when absent.

    With ``PRICE_PATTERN_THOUSANDS`` the thousands dots are removed first."""
    m = F.nullif(F.regexp_extract(_c(col), pattern, 0), F.lit(""))
    m = F.regexp_replace(m, r"\.", "")
    return F.replace(m, F.lit(","), F.lit(".")).try_cast("double")


def unit_label(col, strip_paren: bool = False) -> Column:
    """Unit label from the euro sign to the end of the line (``€/KILO``)."""
    m = F.nullif(trim_all(F.regexp_extract(_c(col), UNIT_LABEL_PATTERN, 0)), F.lit(""))
    if strip_paren:
        m = F.regexp_replace(m, r"\)+$", "")
    return m


def discount_percent(col) -> Column:
    """Promotion percent as a number (``20%`` -> 20.0); null when absent."""
    m = F.nullif(F.regexp_extract(_c(col), DISCOUNT_PATTERN, 1), F.lit(""))
    return m.try_cast("double")


def first_category(col) -> Column:
    """First element of a list encoded as text (``['a. b', 'c']`` -> ``a. b``).

    Parses both quote styles of a Python list repr; null for an empty list,
    null input or an unquoted/malformed list. Never evaluates the text."""
    return F.get(F.from_json(_c(col), "array<string>"), 0)


def encode_list(col) -> Column:
    """Encode ``array<string>`` like Python's list repr: ``['a', "b'c"]``."""
    def quote(x):
        has_sq = F.instr(x, "'") > 0
        has_dq = F.instr(x, '"') > 0
        escaped = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
        return (F.when(has_sq & ~has_dq, F.concat(F.lit('"'), x, F.lit('"')))
                .otherwise(F.concat(F.lit("'"), escaped, F.lit("'"))))
    return F.concat(F.lit("["), F.array_join(F.transform(_c(col), quote), ", "), F.lit("]"))


def url_last_segment(col, strip_query: bool = True) -> Column:
    """Product id = last path segment of the URL (after dropping ``?…``/``#…``)."""
    u = _c(col)
    if strip_query:
        u = F.regexp_replace(u, r"[?#].*$", "")
    return F.nullif(F.element_at(F.split(u, "/"), -1), F.lit(""))


def url_digits_tail(col) -> Column:
    """Product id = from the first digit of the URL to its end (null if no digit)."""
    return F.nullif(F.regexp_extract(_c(col), r"\d.*", 0), F.lit(""))


def is_product_url(col) -> Column:
    return F.coalesce(_c(col).rlike(PRODUCT_URL_PATTERN), F.lit(False))


# --- HTML -------------------------------------------------------------------

def element_start(tag: str, css_class: str | None = None) -> str:
    """Regex of the start tag ``<tag class="… css_class …">``; the class must be
    one whole item of the class attribute (several classes allowed)."""
    if css_class is None:
        return rf"(?is)<{tag}(?:\s[^>]*)?>"
    cls = css_class.replace(".", r"\.").replace("-", r"\-")
    dq = rf'"(?:[^"]*\s)?{cls}(?:\s[^"]*)?"'
    sq = rf"'(?:[^']*\s)?{cls}(?:\s[^']*)?'"
    return rf"(?is)<{tag}(?:\s[^>]*)?\sclass\s*=\s*(?:{dq}|{sq})[^>]*>"


def element_pattern(tag: str, css_class: str | None = None) -> str:
    """Regex capturing the inner HTML of an element up to the next closing tag
    of its name. Valid in Java regex and RE2."""
    return rf"{element_start(tag, css_class)}(.*?)</{tag}\s*>"


_NUM_ENTITY = r"&#(?:[0-9]+|[xX][0-9a-fA-F]+);"
_NUM_ENTITY_BODY = r"&#([0-9]+|[xX][0-9a-fA-F]+);"
_NAMED_ENTITY = r"&[A-Za-z][A-Za-z0-9]*;"
_NAMED_ENTITY_BODY = r"&([A-Za-z][A-Za-z0-9]*);"


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def _decoded(c: Column, pattern: str, body: str, decode) -> Column:
    """The text split at the entities and joined again with what ``decode`` makes of their bodies (null: as written)."""
    parts = F.split(c, pattern, -1)
    bodies = F.regexp_extract_all(c, F.lit(body), 1)
    return F.array_join(F.zip_with(parts, F.transform(bodies, decode), lambda p, ch: F.concat(p, F.coalesce(ch, F.lit("")))), "")


def decode_numeric_entities(col) -> Column:
    """Decode ``&#NNN;`` / ``&#xHH;`` of any length to the character (via UTF-32
    bytes of the code point); invalid code points stay as written."""
    c = _c(col)

    def to_char(b):
        is_hex = F.lower(F.substring(b, 1, 1)) == "x"
        digits = F.regexp_replace(b, "^[xX]?0*", "")
        # longer ones are beyond the last code point
        code = F.when(F.length(digits) <= 7, F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits)).try_cast("int")
        valid = (code.isNotNull() & (code > 0) & (code <= 0x10FFFF)
                 & ~((code >= 0xD800) & (code <= 0xDFFF)))
        ch = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(valid, ch).otherwise(F.concat(F.lit("&#"), b, F.lit(";")))

    return F.when(F.instr(c, "&#") > 0, _decoded(c, _NUM_ENTITY, _NUM_ENTITY_BODY, to_char)).otherwise(c)


#: the entities that most pages use, replaced without a lookup
_COMMON = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&euro;", "€"))


def _named_entities() -> Column:
    """All named character references that end in a semicolon, as one constant map."""
    table = [f"{name[:-1]}\2{ch}" for name, ch in html5.items() if name.endswith(";") and name != "amp;"]
    return F.str_to_map(F.lit("\1".join(table)), F.lit("\1"), F.lit("\2"))


def decode_entities(col) -> Column:
    """Decode all named and numeric entities; ``&amp;`` last, so that
    ``&amp;lt;`` becomes ``&lt;`` and ``&amp;#39;`` stays ``&#39;``. Names that
    are none stay as written."""
    c = _c(col)
    for ent, ch in _COMMON:
        c = F.replace(c, F.lit(ent), F.lit(ch))

    def named(x: Column) -> Column:
        look_up = lambda b: F.coalesce(F.element_at(_named_entities(), b), F.concat(F.lit("&"), b, F.lit(";")))
        rare = F.regexp_replace(x, "&amp;", "").rlike(_NAMED_ENTITY)
        return F.when(rare, _decoded(x, _NAMED_ENTITY, _NAMED_ENTITY_BODY, look_up)).otherwise(x)

    def decoded(x: Column) -> Column:
        return F.replace(_let(named(x), decode_numeric_entities), F.lit("&amp;"), F.lit("&"))
    return _let(c, lambda x: F.when(F.instr(x, "&") > 0, decoded(x)).otherwise(x))


def html_text(col) -> Column:
    """Visible text of an HTML fragment: comments and tags removed, entities decoded."""
    return decode_entities(F.regexp_replace(_c(col), r"(?s)<!--.*?-->|<[^>]*>", ""))


#: tags of a chunk whose depths are added up together
_CHUNK = 64


def running_sums(values: Column) -> Column:
    """Running sums of an array of integers.

    A higher-order function copies the array it appends to, so the sums are
    worked out in chunks and the sums of the chunks before are added: the work
    is near n, not n squared."""
    def running(part: Column, start: Column) -> Column:
        sums = F.aggregate(part, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return _let(sums, lambda s: F.slice(s, F.lit(2), F.size(s)))

    zero = F.lit(0)
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(_CHUNK))).otherwise(F.array().cast("array<int>"))
    chunks = F.transform(starts, lambda i: F.slice(values, i, F.lit(_CHUNK)))

    def add_up(c: Column) -> Column:
        before = F.concat(F.array(zero), running(F.transform(c, lambda x: F.aggregate(x, zero, lambda acc, y: acc + y)), zero))
        return _let(before, lambda b: F.flatten(F.transform(c, lambda x, i: running(x, F.element_at(b, i + 1)))))
    return _let(chunks, add_up)


def html_bare(html) -> Column:
    """HTML without comments and without the contents of scripts and styles, which hold no tags."""
    return _let(_c(html), lambda raw: F.when(
        raw.rlike(r"(?i)<!--|<script|<style"),
        F.regexp_replace(raw, r"(?is)<!--.*?-->|(<(script|style)\b[^>]*>).*?(?=</\2\s*>)", "$1")).otherwise(raw))


def html_inner(html, tag: str, css_class: str | None = None, bare: bool = False) -> Column:
    """Inner HTML of every ``<tag class="… css_class …">`` in document order (array<string>).

    An element ends at its own closing tag: start and end tags of the same name
    are counted, and the end is the first one behind the start at which the
    depth is that before it. Comments and the contents of scripts and styles
    hold no tags. An element whose end tag is missing is left out, and so are
    void elements. All in expressions; the plain pattern serves texts in which
    no start tag of the name follows another. With ``bare`` the text is what
    ``html_bare`` returned, so that several elements are searched in it at the cost of one."""
    text = _c(html) if bare else html_bare(html)
    tag_pattern = rf"(?is)<{tag}(?:\s[^>]*)?>|</{tag}\s*>"
    start_pattern = element_start(tag, css_class)

    def elements(t: Column) -> Column:
        tags, closing, sums, between = t["tags"], t["closing"], t["sums"], t["between"]

        def inner(x: Column, i: Column) -> Column:
            # the first tag behind it at which the depth is that before the element; what lies between them
            end = F.array_position(F.slice(sums, i + 2, F.size(sums)), F.element_at(sums, i + 1) - 1).cast("int")
            held = F.concat(F.array_join(F.zip_with(F.slice(between, i + 2, end - 1), F.slice(tags, i + 2, end - 1), lambda b, y: F.concat(b, y)), ""),
                            F.element_at(between, i + end + 1))
            return F.when(F.element_at(closing, i + 1) | ~x.rlike(start_pattern), F.lit(None)).when(end > 0, held)
        return F.filter(F.transform(tags, inner), lambda x: x.isNotNull())

    def by_depth(t: Column) -> Column:
        signs = F.transform(t["closing"], lambda e: F.when(e, F.lit(-1)).otherwise(F.lit(1)))
        return _let(F.struct(t["tags"].alias("tags"), t["closing"].alias("closing"), running_sums(signs).alias("sums"),
                             F.split(t["text"], tag_pattern, -1).alias("between")), elements)

    def found(t: Column) -> Column:
        follows = F.exists(F.zip_with(t["closing"], F.slice(t["closing"], F.lit(2), F.size(t["closing"])), lambda a, b: ~a & ~b), lambda x: F.coalesce(x, F.lit(False)))
        return F.when(follows, by_depth(t)).otherwise(F.regexp_extract_all(t["text"], F.lit(element_pattern(tag, css_class)), 1))

    def closings(t: Column) -> Column:
        ends = F.transform(t["tags"], lambda y: F.startswith(y, F.lit("</")))
        return _let(F.struct(t["text"].alias("text"), t["tags"].alias("tags"), ends.alias("closing")), found)

    return _let(text, lambda x: _let(F.struct(x.alias("text"), F.regexp_extract_all(x, F.lit(tag_pattern), 0).alias("tags")), closings))


def html_elements(html, tag: str, css_class: str | None = None) -> Column:
    """Inner text of every matching element, in document order (array<string>)."""
    return F.transform(html_inner(html, tag, css_class), lambda x: html_text(x))


def html_first_text(html, tag: str, css_class: str | None = None) -> Column:
    """Inner text of the first matching element, or null."""
    return F.get(html_elements(html, tag, css_class), 0)
