"""HTML to text and line cleaning, one row at a time without a shuffle."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import bind
from .strings import strip

# Elements that begin and end a line of their own.
BLOCKS = (
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul"
)

# The ordered clean-up steps (pattern -> replacement) for a fetched page. Tags inside a line add nothing to the text.
HTML_STEPS = [
    (r"(?is)<script\b[^>]*>.*?</script\s*>", ""),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", ""),
    (r"(?s)<!--.*?-->", ""),
    (rf"(?i)</?({'|'.join(BLOCKS.split())})\b[^>]*>", "\n"),
    (r"</?[A-Za-z!][^>]*>", ""),
]

# Names of entities that are decoded, the ampersand last so that nothing is decoded twice.
ENTITY_NAMES = (
    "lt gt quot nbsp apos copy reg trade hellip mdash ndash lsquo rsquo sbquo ldquo rdquo bdquo laquo raquo bull middot deg euro pound yen cent "
    "sect para plusmn times divide frac12 frac14 frac34 szlig agrave aacute acirc atilde auml aring aelig ccedil egrave eacute ecirc euml igrave "
    "iacute icirc iuml ntilde ograve oacute ocirc otilde ouml oslash ugrave uacute ucirc uuml Agrave Aacute Acirc Auml Ccedil Egrave Eacute Ecirc "
    "Ouml Uuml Ntilde amp"
)
ENTITIES = [(f"&{name};", html5[f"{name};"]) for name in ENTITY_NAMES.split()]
NUMERIC = r"&#(?=[0-9]{1,7};|[xX][0-9a-fA-F]{1,6};)"


def numeric_entities(text: Column) -> Column:
    """Decimal and hexadecimal character references decoded; one that names no character becomes U+FFFD."""

    def decoded(piece: Column, i: Column) -> Column:
        decimal, hexadecimal = F.regexp_extract(piece, "^([0-9]{1,7});", 1), F.regexp_extract(piece, "^[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("int")).otherwise(decimal.try_cast("int"))
        known = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
        safe = F.when(known, code).otherwise(F.lit(0xFFFD))
        # the ampersand stays an entity until the end, so that what follows it is not decoded again
        character = F.when(safe == 38, "&amp;").otherwise(F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32"))
        return F.when(i == 0, piece).otherwise(F.concat(character, F.regexp_replace(piece, "^[0-9xXa-fA-F]+;", "")))

    return F.when(text.rlike(NUMERIC), F.array_join(F.transform(F.split(text, NUMERIC, -1), decoded), "")).otherwise(text)


def html_text(html: Column) -> Column:
    """Visible text: scripts, styles and comments go, block tags end lines, other tags vanish, entities are decoded."""
    for pattern, replacement in HTML_STEPS:
        html = F.regexp_replace(html, pattern, replacement)

    def decoded(plain: Column) -> Column:
        named = numeric_entities(plain)
        for entity, character in ENTITIES:
            named = F.replace(named, F.lit(entity), F.lit(character))
        return F.when(plain.contains("&"), named).otherwise(plain)

    # bound, so that the steps run once per page and not once per mention
    return bind(html, decoded)


def word_count(text: Column) -> Column:
    """Pieces between single spaces, so two spaces in a row count one empty piece more."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def body_lines(text: Column, min_words: int = 10) -> Column:
    """Stripped lines with at least ``min_words`` pieces, joined by blank lines."""
    lines = F.transform(F.split(text, "\n"), lambda line: strip(line))
    return F.array_join(F.filter(lines, lambda line: word_count(line) >= min_words), "\n\n")


def document_piece(line: Column, min_length: int = 10) -> Column:
    """What a line adds to its document: null if short, glued on if it ends in a hyphen."""

    def piece(clean: Column) -> Column:
        glued = F.when(clean.endswith("-"), F.rtrim(clean, F.lit("-"))).otherwise(F.concat(clean, F.lit(" ")))
        return F.when(F.length(clean) >= min_length, glued)

    return bind(strip(line), piece)
