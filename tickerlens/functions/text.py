"""String scalars: Column -> Column, all JVM-side (regexp / string built-ins).

Python's ``str.split()`` / ``str.strip()`` / ``re`` ``\\s`` treat every Unicode
whitespace character as whitespace, Spark's ``trim`` only the space. The class
``WS`` below spells out Python's whitespace set so the same pattern works in
Java regex (Spark) and RE2 (the DuckDB oracle).
"""
from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference job's behaviour)
# ---------------------------------------------------------------------------
# Characters removed from a headline before it is matched to a company name:
#   - = + , # / ? : ^ $ . @ * " ※ ~ & % ㆍ ! 』 ‘ | ( ) [ ] < > ` ' … 》
# Backslash, underscore, braces, semicolon and spaces are kept.
CLEAN_CHARS = "-=+,#/?:^$.@*\"※~&%ㆍ!』‘|()[]<>`'…》"
# Characters kept by the filing-text cleaner: ASCII letters and digits, Hangul
# syllables 가-힣, Hangul jamo ㄱ-ㅎ and ㅏ-ㅣ, whitespace.
HANGUL_KEEP = "A-Za-z0-9가-힣ㄱ-ㅎㅏ-ㅣ"
# Python's str.isspace() set.
WS = (r"\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# Sentence patterns: shortest run ending in . ? or ! (no newline inside), and the
# split rule "after . or ? plus whitespace unless an abbreviation precedes".
SENTENCE_FINDALL = r"(?d).+?[.?!]"
SENTENCE_SPLIT = r"(?dU)(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<=\.|\?)\s"
# ---------------------------------------------------------------------------


def _char_class(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "\\-^[]" else c for c in chars) + "]"


CLEAN_PATTERN = _char_class(CLEAN_CHARS)
WS_RUN = f"[{WS}]+"
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
NOT_HANGUL_ALNUM = f"[^{HANGUL_KEEP}{WS}]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_text(col) -> Column:
    """Drop the fixed punctuation set (one regex class, one pass)."""
    return F.regexp_replace(_c(col), CLEAN_PATTERN, "")


def headline_key(col) -> Column:
    """Clean text of the part before the first comma (whole text if none); not trimmed."""
    return clean_text(F.substring_index(_c(col), ",", 1))


def strip_hyphen(col) -> Column:
    """Content is stored without '-'."""
    return F.replace(_c(col), F.lit("-"), F.lit(""))


def has_paren(col) -> Column:
    return F.instr(_c(col), "(") > 0


def ticker_of(col) -> Column:
    """P4 value: text between the first '(' and the next ')' (or the end)."""
    return F.regexp_extract(_c(col), r"\(([^)]*)", 1)


def truncate_words(col, n: int) -> Column:
    """P5: at most n whitespace words -> original string untouched; else the first
    n words joined by one space, with '...' attached. Two regexes (codegen'd, no
    word arrays): "is there an (n+1)-th word" and "the first n words"."""
    c = _c(col)
    if n <= 0:
        return F.when(c.rlike(f"[^{WS}]"), F.lit("...")).otherwise(c)
    word, gap = f"[^{WS}]+", f"[{WS}]+"
    more = c.rlike(f"^[{WS}]*(?:{word}{gap}){{{n}}}[^{WS}]")
    head = F.regexp_extract(c, f"^[{WS}]*((?:{word}{gap}){{{n - 1}}}{word})", 1)
    return F.when(more, F.concat(F.regexp_replace(head, WS_RUN, " "), F.lit("..."))).otherwise(c)


def normalise_ws(col) -> Column:
    """Newline -> space, then every whitespace run -> one space (ends kept)."""
    return F.regexp_replace(F.replace(_c(col), F.lit("\n"), F.lit(" ")), WS_RUN, " ")


def section_after(col, delimiter: str) -> Column:
    """The part between the 1st and 2nd occurrence of ``delimiter``
    (``text.split(d)[1]``); null when the delimiter is absent."""
    c = _c(col)
    return F.when(F.instr(c, delimiter) > 0,
                  F.substring_index(F.substring_index(c, delimiter, 2), delimiter, -1))


def keep_alnum_hangul(col) -> Column:
    """Keep ASCII letters/digits, Hangul, whitespace."""
    return F.regexp_replace(_c(col), NOT_HANGUL_ALNUM, "")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once (a one-element transform binds it)."""
    return F.get(F.transform(F.array(value), body), 0)


def strip_ws(col) -> Column:
    """``py_strip`` by a set of characters instead of a pattern."""
    return F.trim(_c(col), F.lit(WS_CHARS))


def py_strip(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), f"^[{WS}]+|[{WS}]+$", "")


def last_paragraph(col, sep: str = "\n\n") -> Column:
    """Last block after splitting on ``sep``, stripped."""
    c = _c(col)
    return py_strip(F.substring_index(c, sep, -1))


def sentences(col) -> Column:
    """All non-overlapping 'shortest run ending in .?!' matches (no newline inside)."""
    return F.regexp_extract_all(_c(col), F.lit(SENTENCE_FINDALL), 0)


def first_sentence(col) -> Column:
    return py_strip(F.get(sentences(col), 0))


def sentence_split(col) -> Column:
    """Split after '.'/'?' + whitespace unless an abbreviation precedes."""
    return F.split(_c(col), SENTENCE_SPLIT, -1)


def fmt_int(col) -> Column:
    """P17 ints: truncate toward zero, thousands separators (Python ``format(int(x), ',')``);
    null beyond the range of a long."""
    return F.format_number(_c(col).try_cast("bigint"), 0)


def _scientific(x: Column, digits: Column) -> Column:
    """``x`` (not negative) rounded to so many significant digits, as d.ddde+xx."""
    return F.call_function("format_string", F.concat(F.lit("%."), (digits - 1).cast("string"), F.lit("e")), x)


def _plain_digits(scientific: Column) -> Column:
    """The significant digits of d.ddde+xx, without trailing zeros but for the first digit."""
    return F.regexp_replace(F.regexp_replace(F.substring_index(scientific, "e", 1), r"\.", ""), r"(?<=.)0+$", "")


def shortest(x: Column) -> Column:
    """The fewest digits that read back to the same double, as d.ddde+xx (``x`` finite, not
    negative). The string of a double is mostly the shortest already: only if it reads back
    with one digit less are all lengths tried, the shortest first."""
    def search(long_: Column) -> Column:
        def found(n: Column) -> Column:
            less = _scientific(x, F.greatest(n - 1, F.lit(1)))
            tried = F.filter(F.transform(F.sequence(F.lit(1), n), lambda k: _scientific(x, k)), lambda c: c.cast("double") == x)
            return F.when((n > 1) & (less.cast("double") == x), F.get(tried, 0)).otherwise(_scientific(x, n))
        return let(F.length(_plain_digits(long_)), found)
    return let(_scientific(x, F.lit(17)), search)


def fmt_float(col) -> Column:
    """P17 floats, Python's ``format(x, ',')``: the digits of the shortest string that reads back
    to the same double, thousands separators, at least one decimal; below 1e-4 and from 1e16 on
    with an exponent of two digits or more. ``nan``, ``inf``; null stays null."""
    def text(x: Column) -> Column:
        def of(sci: Column) -> Column:
            digits, e = _plain_digits(sci), F.substring_index(sci, "e", -1).cast("int")
            size = F.length(digits)
            whole = F.when(e >= 0, F.rpad(F.substring(digits, F.lit(1), e + 1), e + 1, "0")).otherwise(F.lit("0"))
            part = F.when(e >= 0, F.substring(digits, e + 2, F.greatest(size, F.lit(1)))).otherwise(
                F.concat(F.repeat(F.lit("0"), -e - 1), digits))
            fixed = F.concat(F.format_number(whole.cast("bigint"), 0), F.lit("."), F.when(part == "", F.lit("0")).otherwise(part))
            mantissa = F.when(size > 1, F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, F.lit(2), size))).otherwise(digits)
            exponent = F.concat(F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(e).cast("string"), F.greatest(F.length(F.abs(e).cast("string")), F.lit(2)), "0"))
            return F.when(e.between(-4, 15), fixed).otherwise(F.concat(mantissa, exponent))

        minus = F.when((x < 0) | x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))  # also before -0.0
        return (F.when(F.isnan(x), F.lit("nan")).when(F.abs(x) == float("inf"), F.concat(minus, F.lit("inf")))
                .when(x == 0, F.concat(minus, F.lit("0.0"))).when(x.isNotNull(), F.concat(minus, let(shortest(F.abs(x)), of))))
    return let(_c(col).cast("double"), text)


def parse_shares(col) -> Column:
    """P18: 'a/b' -> the part before '/', commas removed, as bigint (null if unparsable)."""
    head = F.replace(F.substring_index(_c(col), "/", 1), F.lit(","), F.lit(""))
    return py_strip(head).try_cast("bigint")


def _code_point(n: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def unescape_html(col) -> Column:
    """Decode character references: the named ones of HTML 4 (the standard library's table)
    and decimal or hexadecimal ones; what is not a reference stays."""
    names = F.create_map(*[F.lit(x) for name, cp in sorted(name2codepoint.items()) for x in (name, chr(cp))], F.lit("apos"), F.lit("'"))

    def value(ref):
        hex_ = F.conv(F.regexp_extract(ref, "^#[xX](.*)", 1), 16, 10).try_cast("bigint")
        n = F.coalesce(F.regexp_extract(ref, "^#([0-9]+)$", 1).try_cast("bigint"), hex_)
        valid = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        return F.when(ref.startswith("#"), F.when(valid, _code_point(n))).otherwise(F.try_element_at(names, ref))

    def decoded(c):
        found = F.array_distinct(F.regexp_extract_all(c, F.lit(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"), 1))
        # an ampersand's own reference comes last, so that no reference is decoded twice
        pairs = F.array_sort(F.transform(found, lambda r: let(value(r), lambda v: F.struct((v == "&").alias("last"), r.alias("ref"), v.alias("to")))))
        known = F.filter(pairs, lambda p: p["to"].isNotNull())
        return F.aggregate(known, c, lambda acc, p: F.replace(acc, F.concat(F.lit("&"), p["ref"], F.lit(";")), p["to"]))
    return let(_c(col), lambda c: F.when(c.contains("&"), decoded(c)).otherwise(c))


def strip_tags(col) -> Column:
    """Element text: drop tags, decode entities."""
    return unescape_html(F.regexp_replace(_c(col), r"<[^>]*>", ""))
