"""Text cleaning and tokenising as native Column expressions (JVM-side, inside whole-stage codegen).

Patterns avoid ``\\w`` and ``\\s`` shorthands because they differ between Java, RE2 and Python; the explicit classes
below behave the same in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (patterns and entity table shared with the SQL oracle) ----
TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"  # corpus tokens: runs of letters, digits, underscore
SPACE_CLASS = r"\t\n\x0B\f\r "  # whitespace characters
WS_RUN = r"[\t\n\x0B\f\r ]+"
NON_WORD = r"[^\p{L}\p{N}_\t\n\x0B\f\r ]"  # punctuation: neither word character nor whitespace
DELIMITERS = r"[\[\]\"',]"  # brackets, double quote, single quote, comma
HTML_BLOCKS = r"(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>"
HTML_TAG = r"<[^>]*>"
HTML_TITLE = r"(?is)<title[^>]*>(.*?)</title>"
HTML_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),  # last, so '&amp;lt;' unescapes once to '&lt;'
]
# Windows-1252 characters of the bytes 80-9F (five bytes have none) and the control characters of the same bytes
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_CONTROLS = "".join(chr(ch.encode("cp1252")[0]) for ch in CP1252_CHARS)
_CONT = "[\x80-\xBF" + CP1252_CHARS + "]"
UTF8_SEQUENCE = f"(?:[\xC2-\xDF]{_CONT}|[\xE0-\xEF]{_CONT}{{2}}|[\xF0-\xF4]{_CONT}{{3}})"
UTF8_RUN = f"^{UTF8_SEQUENCE}+$"
# a text is cut into runs of sequences, runs without lead characters, and single lead characters
UTF8_PIECES = f"{UTF8_SEQUENCE}+|[^\xC2-\xF4]+|[\xC2-\xF4]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def corpus_tokens(text, min_len: int = 2) -> Column:
    """lower-case, split on non-word runs, keep tokens of at least ``min_len`` characters (array<string>)."""
    return F.filter(F.split(F.lower(_c(text)), TOKEN_SPLIT), lambda t: F.length(t) >= min_len)


def first_line(text) -> Column:
    """Text before the first newline (the whole text when there is none)."""
    return F.substring_index(_c(text), "\n", 1)


def after_first_line(text) -> Column:
    """Text after the first newline, '' when there is none."""
    t = _c(text)
    nl = F.instr(t, "\n")
    return F.when(nl > 0, F.substr(t, nl + 1)).otherwise(F.lit(""))


def repair_encoding(text) -> Column:
    """Undo UTF-8 read as Latin-1 or Windows-1252 ('cafÃ©' -> 'café', 'itâ€™s' -> 'it’s').

    Only runs of characters that form UTF-8 sequences are changed, so other characters of the text, whatever they
    are, neither block the repair nor change. A run that is no valid UTF-8 stays."""
    t = _c(text)

    def mend(piece: Column) -> Column:
        raw = F.encode(F.translate(piece, CP1252_CHARS, CP1252_CONTROLS), "ISO-8859-1")
        return F.when(piece.rlike(UTF8_RUN), F.coalesce(F.try_validate_utf8(raw.cast("string")), piece)).otherwise(piece)

    pieces = F.regexp_extract_all(t, F.lit(UTF8_PIECES), F.lit(0))
    return F.when(t.rlike(UTF8_SEQUENCE), F.array_join(F.transform(pieces, mend), "")).otherwise(t)


def strip_delimiters(text) -> Column:
    """Brackets, quotes and commas become spaces."""
    return F.regexp_replace(_c(text), DELIMITERS, " ")


def remove_punctuation(text) -> Column:
    """Every character that is neither a word character nor whitespace becomes a space; runs of whitespace
    become one space."""
    return F.regexp_replace(F.regexp_replace(_c(text), NON_WORD, " "), WS_RUN, " ")


def whitespace_tokens(text) -> Column:
    """C4: split on whitespace runs, no empty tokens (array<string>)."""
    return F.filter(F.split(_c(text), WS_RUN), lambda t: t != "")


def clean_text(text) -> Column:
    """Repair -> strip delimiters -> remove punctuation -> whitespace tokens; case is preserved."""
    return whitespace_tokens(remove_punctuation(strip_delimiters(repair_encoding(text))))


def unescape_entities(text) -> Column:
    out = _c(text)
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def let(value, fn) -> Column:
    """``fn`` of a value that is computed once per row, also below functions that Spark interprets (array functions), where
    every mention of an expression is computed again."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def without_tags(html) -> Column:
    """The text of ``strip_html`` before white space is collapsed. Texts without ``<`` or ``&`` skip the patterns."""
    tags = lambda t: F.when(F.contains(t, F.lit("<")), F.regexp_replace(F.regexp_replace(t, HTML_BLOCKS, " "), HTML_TAG, " ")).otherwise(t)
    return let(let(_c(html), tags), lambda t: F.when(F.contains(t, F.lit("&")), unescape_entities(t)).otherwise(t))


def strip_html(html) -> Column:
    """Comments, script and style bodies dropped; every tag becomes a space (no glued words); common
    entities unescaped; whitespace collapsed and trimmed."""
    return F.trim(F.regexp_replace(without_tags(html), WS_RUN, " "))


def word_tokens(text) -> Column:
    """``whitespace_tokens(remove_punctuation(text))`` in one pass: what is neither word character nor white space becomes
    white space there, so tokens are the runs of word characters."""
    return F.filter(F.split(_c(text), TOKEN_SPLIT), lambda t: t != "")


def html_title(html) -> Column:
    return F.trim(F.regexp_replace(unescape_entities(F.regexp_extract(_c(html), HTML_TITLE, 1)), WS_RUN, " "))


def joined(tokens, sep: str = " ") -> Column:
    """array<string> -> string for reporting; an empty or null array gives ''."""
    return F.coalesce(F.array_join(_c(tokens), sep), F.lit(""))


def run_lengths(tokens) -> Column:
    """array<struct<term, tf>>: the distinct elements of an array with their frequencies, in sorted order. Sorting
    brings equal elements together; a run ends where the next begins, so the row needs no other row and no shuffle."""
    let = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  evaluates value once

    def entries(s):
        first = lambda i: (i == 0) | ~F.get(s, i).eqNullSafe(F.get(s, i - 1))
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), first)
        return let(starts, lambda at: F.transform(at, lambda i, j: F.struct(
            F.get(s, i).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(s)) - i).cast("bigint").alias("tf"))))

    # sequence(0, -1) would count down: empty arrays have no runs
    return F.when(F.size(_c(tokens)) > 0, let(F.sort_array(_c(tokens)), entries))
