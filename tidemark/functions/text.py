"""Text functions on columns, with the Unicode white space and word classes of Python's `re` and `str`."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what Python counts as white space, spelled out; an explicit class is also the fastest in the JVM.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: What Python's \w matches: letters, all kinds of numbers, and the underscore.
WORD = r"[\p{L}\p{N}_]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value), the value worked out once: an expression inside a lambda would be worked out for every element."""
    return F.transform(F.array(value), body)[0]


def falsy_to_null(c) -> Column:
    """Null for the empty string, as a Python `or` would skip it."""
    return F.nullif(_col(c), F.lit(""))


def first_truthy(*cols) -> Column:
    return F.coalesce(*map(falsy_to_null, cols))


def strip(c) -> Column:
    return F.btrim(_col(c), F.lit(SPACES))


def collapse_space(c) -> Column:
    return F.regexp_replace(_col(c), f"{SPACE}+", " ")


def strip_tags(c) -> Column:
    return F.regexp_replace(_col(c), "<[^>]+>", "")


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def unescape_html(c) -> Column:
    """HTML entities replaced; only texts with an ampersand leave the JVM."""
    c = _col(c)
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


_LINE = re.compile(r"[^\n\r]+")


@F.pandas_udf(T.StringType())
def _unescape_lines(s: pd.Series) -> pd.Series:
    return s.map(lambda x: _LINE.sub(lambda m: re.sub("[\n\r]", " ", html.unescape(m[0])) if "&" in m[0] else m[0], x), na_action="ignore")


def unescape_lines(c, source) -> Column:
    """The same of each line of a text that comes from the text `source`; line ends that entities stand for become spaces."""
    c = _col(c)
    return F.coalesce(_unescape_lines(F.when(F.contains(_col(source), F.lit("&")), c)), c)


def watched_title(c) -> Column:
    """A title without its leading "Watched "."""
    c = _col(c)
    return F.when(c.startswith("Watched "), F.substr(c, F.lit(9))).otherwise(c)


def page_title(c) -> Column:
    """A browser title without the site's name at its end."""
    return F.regexp_replace(_col(c), rf"{SPACE}*-{SPACE}*YouTube(?=\n?\z)", "")


def channel_slug(c) -> Column:
    dashed = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "-")
    return F.coalesce(falsy_to_null(F.btrim(dashed, F.lit("-"))), F.lit("channel"))


def _ascii_slug(c: Column) -> Column:
    dashed = F.btrim(F.regexp_replace(c, "[^A-Za-z0-9]+", "-"), F.lit("-"))
    return F.coalesce(falsy_to_null(F.substr(F.lower(dashed), F.lit(1), F.lit(80))), F.lit("doc"))


@F.pandas_udf(T.StringType())
def _decomposed(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode(), na_action="ignore")


def doc_slug(c) -> Column:
    """A document's slug; only titles beyond ASCII leave the JVM for compatibility decomposition."""
    c = _col(c)
    beyond = c.rlike(r"[^\x00-\x7F]")
    return _ascii_slug(F.coalesce(_decomposed(F.when(beyond, c)), c))


def channel_tab_url(url, tab: str = "videos") -> Column:
    """A channel's address with one tab at its end, in place of any other."""
    bare = F.regexp_replace(_col(url), "/+$", "")
    return F.concat(F.regexp_replace(bare, "/(videos|shorts|streams|playlists)$", ""), F.lit("/" + tab))


def channel_handle(url) -> Column:
    """The handle in an address, or its last path segment."""
    url = _col(url)
    found = falsy_to_null(F.regexp_extract(url, "@([A-Za-z0-9_.-]+)", 1))
    return F.coalesce(found, F.substring_index(url, "/", -1))


_AUTHOR = r"(?s)\A(.*?)\(([^()]+)\)[^()]*\z"


def title_of(stem) -> Column:
    """A file stem's title: what stands before a last (...) group, or the whole stem."""
    stem = _col(stem)
    before = F.btrim(F.regexp_extract(stem, _AUTHOR, 1), F.lit(" -."))
    return F.when(stem.rlike(_AUTHOR), F.coalesce(falsy_to_null(before), stem)).otherwise(stem)


def author_of(stem) -> Column:
    """The text of a file stem's last (...) group, or null."""
    stem = _col(stem)
    return F.when(stem.rlike(_AUTHOR), strip(F.regexp_extract(stem, _AUTHOR, 2)))


def clean_text(c) -> Column:
    """Soft hyphens out, hyphenated line breaks joined, blanks collapsed, at most one empty line, one line feed at the end."""
    c = F.replace(_col(c), F.lit("\u00ad"), F.lit(""))
    c = F.regexp_replace(c, f"({WORD})-\n({WORD})", "$1$2")
    c = F.regexp_replace(c, "[ \t]+", " ")
    c = F.regexp_replace(c, "\n{3,}", "\n\n")
    return F.concat(strip(c), F.lit("\n"))


def word_count(c) -> Column:
    parts = F.split(_col(c), f"{SPACE}+")
    return F.size(F.filter(parts, lambda x: x != "")).cast("long")


def sentences(c) -> Column:
    return F.split(_col(c), rf"(?<=[.!?]){SPACE}+")


def universal_newlines(c) -> Column:
    """Line ends of any system as line feeds."""
    return F.regexp_replace(_col(c), "\r\n?", "\n")


def split_lines(c) -> Column:
    """Lines as str.splitlines gives them: any line boundary, and no empty line at the end."""
    lines = F.split(_col(c), "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\u0085\u2028\u2029]")
    return let(lines, lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts))


def split_pages(c) -> Column:
    return F.split(_col(c), "\f")


def is_page_number(c) -> Column:
    return _col(c).rlike(r"(?iu)\A(?:[ivxlcdm]+|\p{Nd}{1,4})\z")


def is_timing_line(c) -> Column:
    return _col(c).rlike(rf"^\d{{2}}:\d{{2}}:\d{{2}}[,.]\d{{3}}{SPACE}*-->")


def file_stem(name) -> Column:
    """A file name up to its first dot."""
    return F.substring_index(_col(name), ".", 1)


def without_suffix(name, n: int = 4) -> Column:
    """A file name without its last n characters."""
    name = _col(name)
    return F.substr(name, F.lit(1), F.greatest(F.length(name) - n, F.lit(0)))


def suffix(path) -> Column:
    """The extension in lower case with its dot, or an empty string; a leading dot alone makes no extension."""
    leaf = F.substring_index(_col(path), "/", -1)
    return F.lower(F.regexp_extract(leaf, r"(?s)^.+?(\.[^.]+)$", 1))


def _digits() -> tuple[str, str]:
    import sys
    import unicodedata

    other = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(other), "".join(str(unicodedata.decimal(c)) for c in other)


def whole_number(c) -> Column:
    """A number in decimal digits of any script; null where there is none."""
    c = _col(c)
    return F.when(c.rlike("^[0-9]*$"), c).otherwise(F.translate(c, *_digits())).try_cast("int")


def decoded(binary) -> Column:
    """Bytes as text, replacement characters where they are not UTF-8."""
    return F.make_valid_utf8(_col(binary).cast("string"))


#: Without regard to case, Unicode classes, and the line feed as the only line end: as Python's patterns are read.
JAVA_FLAGS = "(?iuUd)"
_PYTHON_ONLY = re.compile(r"\(\?\(|\\[NZAbB]?\{|\(\?[a-zA-Z]*[Lx]")
_PARTS = re.compile(r"(?s)\\.|\(\?P<(\w+)>|\(\?P=(\w+)\)|\[\^?\]?|.")


def java_pattern(pattern: str) -> str | None:
    """A Python pattern, searched without regard to case, for the JVM; None where only Python can run it."""
    re.compile(pattern)  # a broken taxonomy fails when it is read
    if _PYTHON_ONLY.search(pattern.replace("\\\\", "")):
        return None
    out, inside, names = [], False, {}
    for m in _PARTS.finditer(pattern):
        x = m[0]
        if x[0] == "[":
            # in a class a bracket is a plain character to Python, and the start of a nested class to Java
            out.append((r"\[" if inside else "[") + x[1:].replace("]", r"\]") if not inside or x == "[" else None)
            if out[-1] is None:  # "[]" or "[^]" inside a class: a bracket, and the end of the class
                out[-1], inside = r"\[" + x[1:], not x.endswith("]")
            else:
                inside = True
        elif x == "]" and inside:
            inside = False
            out.append(x)
        elif inside:
            out.append(r"\&" if x == "&" else x)
        elif m[1] or m[2]:
            name = names.setdefault(m[1] or m[2], f"g{len(names)}")
            out.append(f"(?<{name}>" if m[1] else rf"\k<{name}>")
        else:
            out.append(r"\z" if x == r"\Z" else x)
    return JAVA_FLAGS + "".join(out)


def searches(c, pattern: str) -> Column:
    """Whether a Python pattern is found, without regard to case."""
    translated = java_pattern(pattern)
    if translated is not None:
        return F.coalesce(_col(c), F.lit("")).rlike(translated)
    found = re.compile(pattern, re.IGNORECASE)

    @F.pandas_udf(T.BooleanType())
    def search(s: pd.Series) -> pd.Series:
        return s.map(lambda x: found.search(x or "") is not None)

    return search(F.coalesce(_col(c), F.lit("")))
